"""Language-model scoring: Brown classes from exchange clustering, class bigrams, word emissions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import remainder, texts
from rollcall.llm.shingles import mix, word_spans
from rollcall.session import stored

CLASSES = 64
ROUNDS = 6
#: words with this share of all training tokens or more move between classes by themselves: 20,000 at most.
#: The others move together with all words that end alike.
OWN_SHARE = 1 / 20_000
GROUPS = 1024
#: words with this share or more have their counts and classes sent to every task: a million at most, 24 bytes each.
#: Counts of the others are joined to the documents.
SENT_SHARE = 1 / 1_000_000
#: of the words that are sent, those seen so often move by themselves at last, all of them once.
#: Further rounds fit the training texts more closely and others less (README).
LEAST_COUNT = 5
#: token at the end of a text
END = 0
SMOOTH = 0.5
CHUNK = 2_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Training totals, and hash, count and element of the frequent tokens, sorted by hash; bounded by 1 / SENT_SHARE."""

    tokens: int
    types: int
    hashes: np.ndarray
    counts: np.ndarray
    elements: np.ndarray
    n_elements: int


@dataclass(frozen=True)
class Model:
    """Class of each ending group and of each word that is sent, log10 of transitions between classes and of each class's emission denominator."""

    endings: np.ndarray
    classes: np.ndarray
    steps: np.ndarray
    sizes: np.ndarray


def tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and ending group of every token; the last one is the end."""
    data, starts, ends, hashes = word_spans(text)
    last = data[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    group = (mix(last * np.uint64(256) + before) % np.uint64(GROUPS)).astype(np.int64)
    return np.append(hashes, np.uint64(END)), np.append(group, 0)


def _summed(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(keys), return_counts=True)


def count_tokens(train: DataFrame) -> DataFrame:
    """``hash, ending, n``: every distinct token of the training texts and its count, over all of them.

    Tasks count chunks of tokens before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held, axis=1)
            own, first, n = np.unique(rows[0], return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(own), pa.array(rows[1][first]), pa.array(n)], ["hash", "ending", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                h, g = tokens(text)
                held.append(np.stack([h.view(np.int64), g]))
                size += len(h)
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counted = train.mapInArrow(count, "hash long, ending long, n long")
    return stored(counted.groupBy("hash").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "token-counts")


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = total["n"] or 0, total["v"]
    # as many rows as the reciprocal of the share at most, and the end
    sent = counts.where((F.col("n") >= n * SENT_SHARE) | (F.col("hash") == END)).toPandas()
    hashes = sent["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    own = sent["n"].to_numpy(np.int64)[order]
    by_itself = (own >= n * OWN_SHARE) | (hashes[order] == END)
    rank = np.argsort(np.argsort(np.where(by_itself, -own, 1), kind="stable"), kind="stable")
    elements = np.where(by_itself, rank + GROUPS, sent["ending"].to_numpy(np.int64)[order])
    return Vocabulary(n, v, hashes[order], own, elements, GROUPS + int(by_itself.sum()))


def placed(words: Vocabulary, h: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the tokens whose counts were sent (-1 for others), and every token's element."""
    if not len(words.hashes):
        return np.full(len(h), -1), group
    at = np.minimum(np.searchsorted(words.hashes, h), len(words.hashes) - 1)
    known = words.hashes[at] == h
    return np.where(known, words.counts[at], -1), np.where(known, words.elements[at], group)


def count_pairs(train: DataFrame, words: Vocabulary) -> DataFrame:
    """``a, b, n``: how often element b follows element a in the training texts; a text begins after an end."""
    sent = train.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = sent.value, [], 0

        def flush() -> pa.RecordBatch:
            key, n = _summed(held)
            return pa.RecordBatch.from_arrays([pa.array(key // words.n_elements), pa.array(key % words.n_elements), pa.array(n)], ["a", "b", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                _, element = placed(words, *tokens(text))
                held.append(np.concatenate([element[-1:], element[:-1]]) * words.n_elements + element)
                size += len(element)
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    pairs = train.mapInArrow(count, "a long, b long, n long")
    return stored(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")


def class_table(pairs: DataFrame, assigned: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """Neighbour counts ``element, side, class, n`` under an assignment, and the class transition counts."""
    spark = pairs.sparkSession
    # bounded: a row for each element
    names = spark.createDataFrame(pd.DataFrame({"element": np.arange(len(assigned)), "class": assigned}))
    after = pairs.join(F.broadcast(names), pairs["b"] == names["element"]).groupBy(F.col("a").alias("e"), "class").agg(F.sum("n").alias("n"))
    before = pairs.join(F.broadcast(names), pairs["a"] == names["element"]).groupBy(F.col("b").alias("e"), "class").agg(F.sum("n").alias("n"))
    sides = stored(after.select("e", F.lit(0).alias("side"), "class", "n").unionByName(before.select("e", F.lit(1).alias("side"), "class", "n")), "sides")
    moves = sides.where("side = 0").join(F.broadcast(names.withColumnRenamed("class", "own")), F.col("e") == F.col("element"))
    table = np.zeros((CLASSES, CLASSES))
    for r in moves.groupBy("own", "class").agg(F.sum("n").alias("n")).collect():  # at most CLASSES squared rows
        table[r["own"], r["class"]] = r["n"]
    return sides, table


def best_classes(out: np.ndarray, into: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class in which each element's tokens are likeliest, the others staying where they are.

    ``out[e, c]`` and ``into[e, c]`` count the classes after and before an element.  Its own
    counts leave its class's row and column before its present class is judged.
    """
    followers, size = table.sum(axis=1), table.sum(axis=0)
    forward = np.log((table + SMOOTH) / (followers + SMOOTH * CLASSES)[:, None])
    total = into.sum(axis=1)
    value = out @ forward.T + into @ forward - total[:, None] * np.log(size + 1)
    for e, c in enumerate(own):
        rest = table.copy()
        rest[c, :] = np.maximum(rest[c, :] - out[e], 0)
        rest[:, c] = np.maximum(rest[:, c] - into[e], 0)
        row, column = rest[c, :], rest[:, c]
        value[e, c] = (out[e] @ np.log((row + SMOOTH) / (row.sum() + SMOOTH * CLASSES))
                       + into[e] @ np.log((column + SMOOTH) / (followers + SMOOTH * CLASSES)) - total[e] * np.log(column.sum() + total[e] + 1))
    return np.argmax(value, axis=1)


def exchange(pairs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each element, and the transition counts.

    Exchange clustering in rounds: every other element moves to the class in which the training
    text is likeliest, all judged by one table of class transitions.  The most frequent elements
    start in classes of their own.
    """
    element = np.arange(words.n_elements)
    assigned = np.where(element >= GROUPS, element - GROUPS, element) % CLASSES
    sides, table = class_table(pairs, assigned)
    for turn in range(rounds):
        def move(batches: Iterator[pd.DataFrame], own=assigned, table=table, turn=turn) -> Iterator[pd.DataFrame]:
            held = list(batches)
            if not held:
                return
            rows = pd.concat(held, ignore_index=True)
            here, at = np.unique(rows["e"].to_numpy(), return_inverse=True)
            counts = np.zeros((2, len(here), CLASSES))
            np.add.at(counts, (rows["side"].to_numpy(), at, rows["class"].to_numpy()), rows["n"].to_numpy())
            yield pd.DataFrame({"e": here, "class": best_classes(counts[0], counts[1], own[here], table)})

        # a task holds about 1,000 elements with two rows of classes each
        dealt = sides.where(F.col("e") % 2 == turn % 2).repartition(math.ceil(words.n_elements / 1000), "e")
        for e, c in dealt.mapInPandas(move, "e long, class long").toPandas().itertuples(index=False, name=None):
            assigned[e] = c
        sides, table = class_table(pairs, assigned)
    return assigned, table


def token_classes(words: Vocabulary, endings: np.ndarray, classes: np.ndarray, h: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token the number of its word among those sent (-1 for others), and its class."""
    if not len(words.hashes):
        return np.full(len(h), -1), endings[group]
    at = np.minimum(np.searchsorted(words.hashes, h), len(words.hashes) - 1)
    known = words.hashes[at] == h
    return np.where(known, at, -1), np.where(known, classes[at], endings[group])


def class_steps(train: DataFrame, words: Vocabulary, endings: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """How often one class follows another in the training texts, a row of CLASSES squared counts from each task."""
    sent = train.sparkSession.sparkContext.broadcast((words, endings, classes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                _, own = token_classes(*sent.value, *tokens(text))
                table += np.bincount(np.concatenate([own[-1:], own[:-1]]) * CLASSES + own, minlength=len(table))
        there = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(table[there])], ["cell", "n"])

    table = np.zeros(CLASSES * CLASSES)
    for r in train.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most CLASSES squared rows
        table[r["cell"]] = r["n"]
    return table.reshape(CLASSES, CLASSES)


def word_neighbours(train: DataFrame, words: Vocabulary, endings: np.ndarray, classes: np.ndarray, least_count: int) -> DataFrame:
    """``word, cell, n``: how often each class stands after (cell = class) and before (cell = CLASSES + class) a word seen ``least_count`` times.

    Tasks add up chunks of tokens, and what they have added up, before anything is shuffled.
    """
    sent = train.sparkSession.sparkContext.broadcast((words, endings, classes))
    cells = 2 * CLASSES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, endings, classes = sent.value
        free = may_move(words, least_count)
        sums, held, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0

        def add() -> tuple[np.ndarray, np.ndarray]:
            keys, n = _summed(held)
            both, at = np.unique(np.concatenate([sums[0], keys]), return_inverse=True)
            return both, np.bincount(at, np.concatenate([sums[1], n])).astype(np.int64)

        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys // cells), pa.array(keys % cells), pa.array(n)], ["word", "cell", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                at, own = token_classes(words, endings, classes, *tokens(text))
                some = (at >= 0) & free[at]
                held.append(np.concatenate([(at * cells + np.append(own[1:], own[:1]))[some], (at * cells + CLASSES + np.append(own[-1:], own[:-1]))[some]]))
                size += len(at)
                if size >= CHUNK:
                    sums, held, size = add(), [], 0
                    # a task's sums are bounded too
                    if len(sums[0]) >= 4 * CHUNK:
                        yield rows(*sums)
                        sums = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if held:
            sums = add()
        for i in range(0, len(sums[0]), CHUNK):
            yield rows(sums[0][i:i + CHUNK], sums[1][i:i + CHUNK])

    return train.mapInArrow(count, "word long, cell long, n long")


def may_move(words: Vocabulary, least_count: int) -> np.ndarray:
    return (words.counts >= least_count) & (words.hashes != END)


def settle(train: DataFrame, words: Vocabulary, endings: np.ndarray, classes: np.ndarray, table: np.ndarray,
           least_count: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the words that are sent, and the transition counts, after each word seen ``least_count`` times has moved by itself.

    The words' neighbours are counted by class in one pass over the texts and dealt out by word, and each word moves
    to the class in which its tokens are likeliest, the others staying where they are.
    """
    movable = int(may_move(words, least_count).sum())
    if not movable:
        return classes, table

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        here, at = np.unique(rows["word"].to_numpy(), return_inverse=True)
        counts = np.zeros((len(here), 2 * CLASSES))
        np.add.at(counts, (at, rows["cell"].to_numpy()), rows["n"].to_numpy())
        for i in range(0, len(here), 1000):
            part = slice(i, i + 1000)
            best = best_classes(counts[part, :CLASSES], counts[part, CLASSES:], classes[here[part]], table)
            other = best != classes[here[part]]
            yield pd.DataFrame({"word": here[part][other], "class": best[other]})

    # a task holds some 2,000 words with two rows of classes each
    counted = word_neighbours(train, words, endings, classes, least_count).repartition(math.ceil(movable / 2000), "word")
    counted = counted.groupBy("word", "cell").agg(F.sum("n").alias("n"))
    # a row for each word that moves: a million at most
    moved = counted.mapInPandas(move, "word long, class long").toPandas()
    settled = classes.copy()
    settled[moved["word"].to_numpy(np.int64)] = moved["class"].to_numpy(np.int64)
    return settled, class_steps(train, words, endings, settled)


def train(docs: DataFrame, least_count: int = LEAST_COUNT) -> tuple[DataFrame, Vocabulary, Model]:
    """Counts of all tokens of the training texts, the frequent ones, and the class model."""
    rows = texts(docs)
    counts = count_tokens(rows)
    words = vocabulary(counts)
    if not words.tokens:
        return counts, words, Model(np.arange(GROUPS) % CLASSES, np.zeros(0, np.int64), np.full((CLASSES, CLASSES), -math.log10(CLASSES)), np.full(CLASSES, math.log10(SMOOTH)))
    assigned, table = exchange(count_pairs(rows, words), words)
    endings = assigned[:GROUPS]
    classes, table = settle(rows, words, endings, assigned[words.elements], table, least_count)
    # tokens and types of each class: words that are sent by themselves, the others by ending
    rare = counts.where((F.col("n") < words.tokens * SENT_SHARE) & (F.col("hash") != END)).groupBy("ending").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # at most GROUPS rows
    size, types = np.zeros(CLASSES), np.zeros(CLASSES)
    np.add.at(size, classes, words.counts)
    np.add.at(types, classes, 1)
    for r in rare:
        size[endings[r["ending"]]] += r["n"]
        types[endings[r["ending"]]] += r["v"]
    steps = np.log10((table + SMOOTH) / (table.sum(axis=1) + SMOOTH * CLASSES)[:, None])
    return counts, words, Model(endings, classes, steps, np.log10(size + SMOOTH * (types + 1)))


def score(docs: DataFrame, counts: DataFrame, words: Vocabulary, model: Model) -> DataFrame:
    """Every text's tokens and log10 probabilities: ``doc_id, n_tokens, n_known, base_score, score``.

    The probability of a token is that of its class after the class before it, times that of the
    token in its class; a text begins after an end.  Counts of frequent tokens are at hand in
    each task; the others leave as (row, token, times) and meet the table of counts in a join.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((words, model))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = sent.value
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(1).to_pylist():
                h, group = tokens(text)
                at, own = token_classes(words, model.endings, model.classes, h, group)
                count = np.where(at >= 0, words.counts[at], -1) if len(words.counts) else at
                steps = model.steps[np.concatenate([own[-1:], own[:-1]]), own].sum() - model.sizes[own].sum()
                known = count >= 0
                rare, times = np.unique(h[~known], return_counts=True)
                out.append((len(h), int((count > 0).sum()), float(np.log10(count[known] + SMOOTH).sum()), float(steps),
                            rare.view(np.int64), times.astype(np.int64)))
            column = lambda i, kind: pa.array([r[i] for r in out], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), column(0, pa.int64()), column(1, pa.int64()), column(2, pa.float64()), column(3, pa.float64()),
                 column(4, pa.list_(pa.int64())), column(5, pa.list_(pa.int64()))],
                ["doc_id", "n_tokens", "known", "counted", "steps", "rare", "times"])

    rows = texts(docs, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    local = rows.mapInArrow(measure, f"doc_id {kind}, n_tokens long, known long, counted double, steps double, rare array<long>, times array<long>")
    # the number of a row is stored with it, since it differs between evaluations
    local = stored(local.withColumn("row", F.monotonically_increasing_id()), "texts")
    rare = local.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("hash"), F.col("x.times").alias("times"))
    found = rare.join(counts.select("hash", "n"), "hash", "left")
    n = F.coalesce("n", F.lit(0))
    joined = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(n + SMOOTH)).alias("more"),
                                      F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"))
    both = local.drop("rare", "times").join(joined, "row", "left")
    known = F.col("known") + F.coalesce("more_known", F.lit(0))
    counted = F.col("counted") + F.coalesce("more", F.lit(0.0))
    whole = math.log10(words.tokens + SMOOTH * (words.types + 1))
    return both.select("doc_id", "n_tokens", known.cast("long").alias("n_known"),
                       (counted - F.col("n_tokens") * whole).alias("base_score"), (counted + F.col("steps")).alias("score"))


def class_model_scores(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Scores every row of ``docs`` by a model of the texts of ``training``; adds ``train_tokens``.

    Words are runs of anything but white space (9-13, 32), A-Z lower-cased; each text ends with an
    end token.  Classes are made by exchange: first of the most frequent words and of groups of words that end alike, then
    of each word seen LEAST_COUNT times and with a millionth of all tokens or more (``settle``); rarer words keep their group's class.  ``base_score`` is the add-half unigram score, ``score`` the class model's; perplexity
    is 10 ** (-score / n_tokens).  Words are told apart by 64-bit hashes.

    Null and empty texts are one end token.  Without training texts both models are uniform.
    Repeated rows and rows with equal or null ids all stay and all count; other columns go.
    """
    counts, words, model = train(training)
    return score(docs, counts, words, model).withColumn("train_tokens", F.lit(words.tokens).cast("long"))


def op9_class_model(docs: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 1
    scored = class_model_scores(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
