"""Near duplicates by HyperMinHash: compressed registers in bands, corrected estimates, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.common import texts
from rollcall.llm.jaccard import components, set_digest
from rollcall.llm.shingles import mix, shingle_set
from rollcall.session import stored

#: registers of a sketch; a register has six bits for leading zeros (0: empty) and the first MANTISSA bits behind the first one
REGISTERS, MANTISSA = 512, 10
#: registers in a band, and bands: texts of similarity 0.8 share no band at odds of (1 - 0.8 ** 7) ** 73 = 4e-8
ROWS, BANDS = 7, 73
#: a bucket of a sketch holds so many shingles at least
FULL = 4
#: an estimate may miss by so many standard errors
ERRORS = 5.5
#: texts below this estimate meet by chance and tie no texts together
CHANCE = 0.3
#: members and shingles of a block; a task holds two
BLOCK_SETS, BLOCK_SHINGLES = 256, 2_000_000


def bucket_count(n: int) -> int:
    """How many buckets each hash function has for a set of ``n`` shingles: a power of two."""
    return min(max(1 << max(n // FULL, 1).bit_length() - 1, 1), REGISTERS)


def also_below(n: int, percent: int) -> bool:
    """Whether a linked set may have half the buckets."""
    k = bucket_count(n)
    return k > 1 and 100 * (FULL * k - 1) >= percent * n


def sketch_sizes(n: int, percent: int) -> list[int]:
    """The numbers of buckets that a set of ``n`` shingles is sketched with."""
    return [bucket_count(n), bucket_count(n) // 2] if also_below(n, percent) else [bucket_count(n)]


def sketch(shingles: np.ndarray, k: int) -> np.ndarray:
    """The registers of a set with ``k`` buckets: REGISTERS / k hash functions deal it into k buckets each.

    A register compresses the lowest hash of a bucket: how many zeros it begins with, and its next bits.
    """
    bits = k.bit_length() - 1
    seeds = mix(np.arange(1, REGISTERS // k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    hashes = np.sort(mix(shingles[None, :] ^ seeds[:, None]), axis=1)
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(hashes.shape, np.int64)
    lowest = np.concatenate([np.ones((len(seeds), 1), bool), bucket[:, 1:] != bucket[:, :-1]], axis=1)
    function, at = np.nonzero(lowest)
    value = hashes[function, at] << np.uint64(bits)
    zeros = 53 - np.frexp((value >> np.uint64(11)).astype(np.float64))[1].astype(np.uint64)
    mantissa = (value << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(REGISTERS, np.uint16)
    out[function * k + bucket[function, at]] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa
    return out


def band_keys(registers: np.ndarray, k: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch (a row of ``registers`` with ``k`` buckets)."""
    bands = registers[:, :ROWS * BANDS].reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    odd = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    place = mix(np.arange(BANDS, dtype=np.uint64)[None, :] + (k.astype(np.uint64) << np.uint64(8))[:, None])
    return mix((mix(bands + np.uint64(1)) * odd).sum(axis=2, dtype=np.uint64) ^ place)


def chance_matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The odds that the registers of two unrelated buckets of ``a`` and ``b`` shingles are equal.

    For each number of leading zeros: the odds that both lowest hashes lie there, times a mantissa's share of the interval.
    """
    a, b = np.maximum(a, 1.0)[..., None], np.maximum(b, 1.0)[..., None]
    power = np.maximum(a + b - 1, 1.0)
    zeros = np.arange(40)
    inside = np.power(1 - 2.0 ** -(zeros + 1), power) - np.power(1 - 2.0 ** -zeros, power)
    return (a * b / power * inside * 2.0 ** -(zeros + 1 + MANTISSA)).sum(axis=-1)


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two sketches each (last axis: registers): equal registers less those that are equal by chance."""
    used = ((left > 0) | (right > 0)).sum(axis=-1)
    share = ((left == right) & (left > 0)).sum(axis=-1) / np.maximum(used, 1)
    chance = chance_matches(n_left / k, n_right / k)
    return (share - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    """Linked texts are estimated at least so alike."""
    j = percent / 100
    return j - ERRORS * math.sqrt(j * (1 - j) / REGISTERS)


def sketched_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class, keys`` of each row: equal sets have one class; null for texts without words.

    ``keys`` are those of the bands of the set's sketches; a class that repeats in a batch of rows has them once.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, places, registers, buckets = [], [], [], [], []
            seen: set[int] = set()
            for at, text in enumerate(batch.column(2).to_pylist()):
                own = shingle_set(text, words)
                sizes.append(len(own))
                classes.append(set_digest(own) if len(own) else None)
                if len(own) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    for k in sketch_sizes(len(own), percent):
                        places.append(at)
                        registers.append(sketch(own, k))
                        buckets.append(k)
            keys = [[] for _ in sizes]
            for i in range(0, len(places), 1000):
                made = band_keys(np.stack(registers[i:i + 1000]), np.array(buckets[i:i + 1000])).view(np.int64)
                for at, row in zip(places[i:i + 1000], made):
                    keys[at].append(row)
            bounds = np.cumsum([0, *(BANDS * len(k) for k in keys)])
            flat = np.concatenate([*(row for k in keys for row in k), np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))],
                ["doc_id", "text_hash", "n_shingles", "class", "keys"])

    rows = texts(docs, "doc_id").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(build, f"doc_id {kind}, text_hash long, n_shingles long, class long, keys array<long>"), "rows")


def band_members(rows: DataFrame) -> DataFrame:
    """``key, class, low``: the classes that share a band with others, and the lowest class of each band's key.

    Keys are dealt out once, for finding the lowest class and for joining it.
    """
    dealt = rows.select(F.explode("keys").alias("key"), "class").repartition("key")
    several = dealt.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key", "low")
    return stored(dealt.join(several, "key").distinct(), "members")


def class_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, words: int, percent: int) -> DataFrame:
    """``class, n, k, own, lower, shingles`` of the classes in ``wanted``: sketches and sets.

    ``own`` is the sketch of a class, ``lower`` one with half the buckets where linked sets may have that.  A set is made
    from one row's text, whether that row has an id or not.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(2).to_pylist()]
            made = [[sketch(own, k).tobytes() for k in sketch_sizes(len(own), percent)] for own in sets]
            bounds = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate([*(own.view(np.int64) for own in sets), np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(own) for own in sets], pa.int64()), pa.array([bucket_count(len(own)) for own in sets], pa.int64()),
                 pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] if len(m) > 1 else None for m in made], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))],
                ["class", "times", "n", "k", "own", "lower", "shingles"])

    # a text stands for its class: the one of the lowest hash, in the row of the lowest id, which may repeat
    known = rows.join(wanted, "class").groupBy("class", "text_hash", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    chosen = known.groupBy("class").agg(F.min(F.struct("text_hash", "doc_id", "times")).alias("row"))
    chosen = chosen.select("class", F.col("row.times").alias("times"), F.col("row.text_hash").alias("__hash"), F.col("row.doc_id").alias("__id"))
    found = texts(docs, "doc_id").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = found.join(chosen, (F.col("text_hash") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    kind = "class long, times long, n long, k long, own binary, lower binary, shingles array<long>"
    made = stored(found.select("class", "times", "text").mapInArrow(build, kind), "sets")
    return made.where("times = 1").unionByName(made.where("times > 1").dropDuplicates(["class"])).drop("times")


def estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` with ``alike``, their estimated similarity (0 where their sizes rule out a link)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(c) for c in ("a", "b", "n_a", "n_b", "k_a", "k_b")}
            out = np.zeros(batch.num_rows)
            k_a, k_b = rows["k_a"].to_numpy(), rows["k_b"].to_numpy()
            for i in range(batch.num_rows):
                k = min(k_a[i], k_b[i])
                x = batch.column("own_a" if k_a[i] == k else "lower_a")[i].as_py()
                y = batch.column("own_b" if k_b[i] == k else "lower_b")[i].as_py()
                if x is not None and y is not None and max(k_a[i], k_b[i]) <= 2 * k:
                    out[i] = estimate(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16), *(np.float64(rows[c][i].as_py()) for c in ("n_a", "n_b")), k)
            yield pa.RecordBatch.from_arrays([rows["a"], rows["b"], pa.array(out)], ["a", "b", "alike"])

    side = lambda s: sets.select(F.col("class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "k", "own", "lower")])
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "a long, b long, alike double")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are linked."""
    side = lambda s: sets.select(F.col("class").alias(s), F.col("shingles").alias(f"s{s}"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("sizes"))
    return both.where(100 * F.col("common") >= percent * (F.col("sizes") - F.col("common"))).select("a", "b")


def labelled(rows: DataFrame, labels: DataFrame, *names: str) -> DataFrame:
    """Adds ``label_x`` for each class column x: its label, or itself."""
    for name in names:
        own = labels.select(F.col("node").alias(name), F.col("root").alias(f"__{name}"))
        rows = rows.join(own, name, "left").withColumn(f"label_{name}", F.coalesce(f"__{name}", name)).drop(f"__{name}")
    return rows


def blocks(members: DataFrame) -> DataFrame:
    """``cluster, class, label, block, own``: members of clusters (with size ``n``) in blocks of bounded size.

    A label with many members has blocks of its own, whose members needn't be compared with each other.
    """
    parts = lambda count, size: F.ceil(F.greatest(F.col(count) / BLOCK_SETS, F.col(size) / BLOCK_SHINGLES)).cast("int")
    by_label = members.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("size"))
    by_label = by_label.withColumn("own", (F.col("count") >= BLOCK_SETS // 2))
    pooled = by_label.where("NOT own").groupBy("cluster").agg(F.sum("count").alias("pooled"), F.sum("size").alias("pooled_size"))
    sized = by_label.join(pooled, "cluster", "left").select(
        "cluster", "label", "own", F.when(F.col("own"), parts("count", "size")).otherwise(parts("pooled", "pooled_size")).alias("parts"))
    dealt = members.join(sized, ["cluster", "label"]).withColumn("part", F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts")))
    return dealt.select("cluster", "class", "label", "own", F.concat_ws(":", F.when(F.col("own"), F.col("label").cast("string")).otherwise(F.lit("pool")), "part").alias("block"))


def compare_blocks(clustered: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that connect the labels inside each cluster; as many as there are classes at most, for each two blocks.

    ``clustered`` has ``cluster, class, label, n``.  Two blocks meet in one task, which holds their sketches and
    sets: all pairs of different labels are estimated, and those near enough are compared in full unless they are connected by then.
    """
    least = least_estimate(percent)

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("class").reset_index(drop=True)
        up: dict[int, int] = {int(x): int(x) for x in rows["label"]}

        def top(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        label, n, k = (rows[c].to_numpy(np.int64) for c in ("label", "n", "k"))
        sets = [np.asarray(s, np.int64) for s in rows["shingles"]]
        found = []
        for level in np.unique(k):
            here = [i for i in range(len(rows)) if k[i] == level or k[i] == 2 * level and rows["lower"][i] is not None]
            registers = np.stack([np.frombuffer(rows["own" if k[i] == level else "lower"][i], np.uint16) for i in here])
            size, groups = n[here].astype(np.float64), label[here]
            for x in range(1, len(here)):
                other = np.flatnonzero(groups[:x] != groups[x])
                if not len(other):
                    continue
                alike = estimate(registers[other], registers[x][None, :], size[other], np.full(len(other), size[x]), np.full(len(other), float(level)))
                for y in other[alike >= least][np.argsort(-alike[alike >= least], kind="stable")].tolist():
                    a, b = here[x], here[y]
                    la, lb = top(int(label[a])), top(int(label[b]))
                    if la != lb and 100 * min(n[a], n[b]) >= percent * max(n[a], n[b]):
                        common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                            up[max(la, lb)] = min(la, lb)
                            found.append((int(rows["class"][a]), int(rows["class"][b])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    dealt = stored(blocks(clustered), "blocks")
    kinds = dealt.groupBy("cluster", "block").agg(F.first("own").alias("own"), F.min("label").alias("label"))
    right = kinds.select("cluster", F.col("block").alias("block_b"), F.col("own").alias("own_b"), F.col("label").alias("label_b"))
    meet = kinds.join(right, "cluster").where("block < block_b AND NOT (own AND own_b AND label = label_b) OR block = block_b AND NOT own")
    tasks = meet.select("cluster", F.xxhash64("cluster", "block", "block_b").alias("task"), F.explode(F.array_distinct(F.array("block", "block_b"))).alias("block"))
    rows = dealt.join(tasks, ["cluster", "block"]).select("task", "class", "label").join(sets, "class")
    return rows.groupBy("task").applyInPandas(link, "a long, b long")


def class_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of the classes that links connect.

    Every class is compared with the lowest one of one of its keys first: estimated, and in full where near enough.
    Where a key still holds several groups, its members are compared with its lowest one.  Those that are no
    chance meeting with it form clusters, in which all pairs of different groups are estimated, block by
    block (``compare_blocks``).  So two linked classes are compared wherever a key that they share has a lowest class
    like both of them (they are like it alike, by the triangle inequality), or is one of them.
    """
    least = least_estimate(percent)

    def test(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        alike = stored(estimated(pairs, sets), "estimates")
        return alike, stored(verified(alike.where(F.col("alike") >= least), sets, percent), "links")

    others = members.where("class <> low")
    tried, links = test(others.groupBy(F.col("class").alias("a")).agg(F.min("low").alias("b")))
    labels = components(links)
    apart = labelled(others.select("class", "low").distinct(), labels, "class", "low").where("label_class <> label_low")
    more, joined = test(apart.select(F.col("class").alias("a"), F.col("low").alias("b")).join(tried, ["a", "b"], "left_anti"))
    links = stored(links.unionByName(joined), "links")
    if joined.take(1):
        labels = components(links)
    # near ones are estimated to be so, or tied together by links already
    alike = tried.unionByName(more).select(F.col("a").alias("class"), F.col("b").alias("low"), "alike")
    placed = labelled(others.join(alike, ["class", "low"], "left"), labels, "class", "low")
    near = placed.where((F.coalesce(F.col("alike"), F.lit(1.0)) >= CHANCE) | (F.col("label_class") == F.col("label_low")))
    near = stored(near.select("key", "class", "low", "label_class", "label_low"), "near")
    # a key of two classes is done; one of several is looked at again if they have different labels
    mixed = near.groupBy("key").agg(F.min(F.least("label_class", "label_low")).alias("l"), F.max(F.greatest("label_class", "label_low")).alias("h"), F.count(F.lit(1)).alias("size"))
    mixed = mixed.where("l <> h AND size > 1").select("key")
    ties = stored(near.join(mixed, "key").select(F.col("class").alias("a"), F.col("low").alias("b")).distinct(), "ties")
    if not ties.take(1):
        return labels
    roots = components(ties)
    inside = roots.select(F.col("node").alias("class"), F.col("root").alias("cluster")).unionByName(
        roots.select(F.col("root").alias("class"), F.col("root").alias("cluster")).distinct())
    clustered = labelled(inside, labels, "class").join(sets.select("class", "n"), "class").withColumnRenamed("label_class", "label")
    joined = stored(compare_blocks(clustered, sets, percent), "links")
    return components(stored(links.unionByName(joined), "links"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents that chains of links connect: ``doc_id, n_shingles, class, component_id, kept``.

    A document is the set of its distinct runs of ``words`` words (A-Z lower-cased; a shorter text is one run).
    Two link when 100 * intersection >= percent * union, confirmed on the full sets.  ``component_id`` is the
    smallest doc_id reached, ``kept`` whether it is the document's own.

    Equal sets are one class, sketched once: registers of leading zeros and mantissa (``sketch``).  Hash functions
    and buckets share out a fixed number of registers by the size of the set, so small sets have full
    buckets too, and a set near a step of that scale is sketched on both sides of it.  Classes that share
    a band of registers are candidates (``class_links``).  A link of two classes can only be missed if no band is shared, or the estimate
    is off by 5.5 standard errors: less than one in ten million at the least similarity, less above it; or if
    every band they share, 15 on average, has a lowest class unlike them that fell into it by chance.

    Texts without words, null ones too, have no shingles and link with nothing.  Each row is a document:
    rows of equal doc_id link like others, by their texts.  A row with a null doc_id counts in the links of others,
    and has a null component and ``kept``.  All rows stay; other columns go.
    """
    named = sketched_rows(docs, words, percent)
    members = band_members(named)
    sets = class_sets(docs, named, members.select("class").distinct(), words, percent)
    roots = class_links(members, sets, percent)
    named = named.drop("keys")
    lowest = named.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("lowest"))
    groups = labelled(lowest, roots, "class")
    reached = groups.groupBy("label_class").agg(F.min("lowest").alias("component"))
    found = groups.join(reached, "label_class").select(F.col("class").alias("__class"), "component")
    joined = named.join(found, named["class"] == found["__class"], "left")
    own: Column = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "n_shingles", "class", own.alias("component_id"), (F.col("doc_id") == own).alias("kept"))


def op11_hyperminhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")
