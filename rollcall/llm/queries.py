"""The operators bound to the tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import fingerprints, hyperminhash, jaccard, lines, lm, mixing, quality, runs, spelling, tokens, toxicity, urls, warc


def _table(name: str, run: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _labelled(name: str, run: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    read = lambda spark, sf_dir, table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return lambda spark, sf_dir: run(read(spark, sf_dir, name), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": _table("documents", tokens.op1_sentencepiece),
    "op2_fingerprints": _table("documents", fingerprints.op2_fingerprints),
    "op3_toxicity": _labelled("documents", toxicity.op3_toxicity),
    "op4_warc": _table("pages", warc.op4_warc),
    "op5_mixing": _table("documents", mixing.op5_mixing),
    "op6_line_dedup": _table("documents", lines.op6_line_dedup),
    "op7_quality_rules": _table("documents", quality.op7_quality_rules),
    "op8_url_filters": _labelled("pages", urls.op8_url_filters),
    "op9_class_model": _table("documents", lm.op9_class_model),
    "op10_jaccard_join": _table("documents", jaccard.op10_jaccard_join),
    "op11_hyperminhash": _table("documents", hyperminhash.op11_hyperminhash),
    "op12_spelling_variants": _table("documents", spelling.op12_spelling_variants),
    "op13_periodic_runs": _table("documents", runs.op13_periodic_runs),
}

SQL: dict[str, str] = {
    "op4_warc": warc.SQL,
    "op5_mixing": mixing.SQL,
    "op6_line_dedup": lines.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_periodic_runs": runs.SQL,
}
