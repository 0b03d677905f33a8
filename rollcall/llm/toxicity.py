"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import remainder, texts

SIZES = (4, 5, 6)
BITS = 20
#: at most about so many labelled rows of each class are fitted, chosen by a hash of the id
SAMPLE_ROWS = 5_000
#: n-grams kept for the classifier: the most telling ones by chi-square
FEATURES = 8_192
LEAST_CHI2 = 20.0
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    """Buckets of the kept n-grams, their weights (log-count ratio times coefficient) and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def buckets(text: str) -> np.ndarray:
    """The buckets of all n-grams of the text, lower-cased and with a space at either end; repeats included."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, last = [], max(SIZES)
    rolled = np.zeros(len(code), np.uint64)
    for n in range(1, last + 1):
        if len(code) < n:
            break
        width = len(code) - n + 1
        rolled = rolled[:width] * np.uint64(1_000_003) + code[n - 1:]
        if n in SIZES:
            mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
            found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """``text, label`` of labelled rows, about ``sample_rows`` for each class at most.

    A row takes part if the hash of its id is below the class's share; a doc_id labelled twice is toxic if any label says so.
    """
    marks = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    sizes = marks.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1_000_000))
    chosen = marks.join(F.broadcast(sizes), "label").where(place < F.lit(sample_rows) / F.col("n") * 1_000_000)
    # bounded by sample_rows for each class
    return texts(docs, "doc_id").join(F.broadcast(chosen.select("doc_id", "label")), "doc_id").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """Learns from the texts of ``docs`` whose doc_id ``labels`` marks (``toxic`` 0 or 1).

    Naive Bayes part: for each n-gram, the log of its share of toxic documents over its share of
    the others, counted over the sampled rows.  Linear part: logistic regression on the presence
    of the most telling n-grams, each scaled by its log ratio.  Rows without a label, or with a
    null one, teach nothing; without both classes every text scores 0.5.
    """
    rows = training_rows(docs, labels, sample_rows).repartition(8).persist()
    try:
        classes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        empty = Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
        if not classes.get(0) or not classes.get(1):
            return empty

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            seen = np.zeros((2, 1 << BITS), np.int32)
            for batch in batches:
                for text, label in zip(batch["text"], batch["label"]):
                    seen[int(label), np.unique(buckets(text))] += 1
            there = np.flatnonzero(seen.sum(axis=0))
            yield pd.DataFrame({"bucket": there, "clean": seen[0, there], "toxic": seen[1, there]})

        counts = rows.mapInPandas(count, "bucket long, clean long, toxic long").groupBy("bucket").agg(
            F.sum("clean").cast("double").alias("a"), F.sum("toxic").cast("double").alias("b"))
        n0, n1 = F.lit(float(classes[0])), F.lit(float(classes[1]))
        c, d = n0 - F.col("a"), n1 - F.col("b")
        a, b = F.col("a"), F.col("b")
        chi2 = (n0 + n1) * (a * d - b * c) ** 2 / (n0 * n1 * (a + b) * F.greatest(c + d, F.lit(0.5)))
        ratio = F.log((b + 1) / (n1 + 2)) - F.log((a + 1) / (n0 + 2))
        kept = counts.select("bucket", ratio.alias("ratio"), chi2.alias("chi2")).where(F.col("chi2") >= LEAST_CHI2)
        kept = kept.orderBy(F.desc("chi2"), "bucket").limit(features).collect()
        if not kept:
            return empty
        kept.sort(key=lambda r: r["bucket"])
        places = np.array([r["bucket"] for r in kept], np.int64)
        ratios = np.array([r["ratio"] for r in kept])
        slots = slot_table(places)

        def vector(text: str) -> SparseVector:
            own = present(slots, text)
            return SparseVector(len(ratios), own.tolist(), ratios[own].tolist())

        points = rows.select(F.udf(vector, VectorUDT())("text").alias("features"), F.col("label").cast("double").alias("label"),
                             F.when(F.col("label") == 1, classes[0] / classes[1]).otherwise(1.0).alias("weight"))
        # both classes weigh alike; toxic documents are the rarer ones
        model = LogisticRegression(weightCol="weight", regParam=1e-4, standardization=False, maxIter=100).fit(points)
        return Model(places, model.coefficients.toArray() * ratios, float(model.intercept))
    finally:
        rows.unpersist()


def slot_table(places: np.ndarray) -> np.ndarray:
    """For each bucket the number of its feature, or -1."""
    table = np.full(1 << BITS, -1, np.int32)
    table[places] = np.arange(len(places))
    return table


def present(slots: np.ndarray, text: str) -> np.ndarray:
    own = slots[buckets(text)]
    return np.unique(own[own >= 0])


def score(docs: DataFrame, model: Model, *keep: str, name: str = "score") -> DataFrame:
    """Adds ``name``, a probability, to the columns in ``keep`` (all columns if none are named).

    Null and empty texts score like a text without any n-gram the model knows.
    """

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slots = slot_table(model.buckets)
        for batch in batches:
            sums = [model.weights[present(slots, t)].sum() if t else 0.0 for t in batch]
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(np.array(sums, float) + model.intercept, -500, 500))))

    columns = [F.col(f"`{c}`") for c in (keep or docs.columns)]
    return docs.select(*columns, probability(F.coalesce(F.col("text"), F.lit(""))).alias(name))


def learnable(labels: DataFrame) -> DataFrame:
    """The labels that a model may learn from: those whose crc32 of the id leaves no remainder 1 by 3."""
    return labels.select("doc_id", "toxic").where(remainder(F.col("doc_id"), 3) != 1)


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, learnable(labels)), "doc_id")
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't toxic, columns unchanged."""
    scored = score(docs, fit(docs, learnable(labels)), name="__score")
    return scored.where(F.col("__score") < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
