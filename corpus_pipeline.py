"""The corpus pipeline: toxic documents go, then boilerplate lines, then near copies; what is left is mixed and encoded."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import jaccard, lines, mixing, tokens, toxicity
from rollcall.session import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from the labelled ones among ``docs``."""
    return toxicity.stage_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the lines that many sites share."""
    return lines.stage_line_dedup(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return jaccard.stage_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixing.stage_mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of ids and decoded text of every row; a document taken twice has two rows."""
    return tokens.op1_sentencepiece(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]

#: a trained classifier and a tokenizer are no SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each result written as Parquet and read again as the next one's documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, last = [functools.partial(stage, spark) for _, stage in STAGES]
    docs = functools.reduce(lambda d, stage: stored(stage(d, sf_dir), "pipeline"), first, documents)
    return last(docs, sf_dir)
