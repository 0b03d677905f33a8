"""Jaccard join on word shingles in its metric space: pivots, regions, windows, recursion."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from rollcall.llm.common import running_before, texts
from rollcall.llm.shingles import mix, shingle_set
from rollcall.session import stored

#: shingles of about so many texts or more come last in the order, the most frequent FREQUENT ones at most (4 MB)
FREQUENT_TEXTS, FREQUENT = 20, 500_000
COUNTED = 4_000_000
#: in a region up to this size all pairs are candidates, so each member meets a bounded number
SMALL_REGION = 100
#: a cluster within these bounds is joined in one task: 96 MB of shingles at most
SMALL_SETS, SMALL_SHINGLES = 5_000, 12_000_000


def order_keys(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The global order of shingles as whole numbers: by hash, the frequent ones after all others."""
    keys = (shingles >> np.uint64(2)).astype(np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        keys = keys | ((frequent[at] == shingles).astype(np.int64) << np.int64(62))
    return keys


def set_pivots(shingles: np.ndarray, percent: int, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """The pivots of a set, and the order key of the last one.

    Pivots are single shingles.  In Jaccard distance a set is as near to each of its own shingles
    as to any other, and at distance 1 from the rest: it lies in the cell of its first shingle in the
    global order, and its window reaches as many cells further as a linked set may lack of its
    shingles.  A linked set shares at least ``percent`` of the shingles, so two linked sets meet
    in a cell of the window of both.  Any order gives this; rare shingles first keeps cells small.
    """
    keys = order_keys(shingles, frequent)
    count = len(shingles) - (percent * len(shingles) + 99) // 100 + 1
    first = np.argsort(keys, kind="stable")[:count]
    return shingles[first].view(np.int64), int(keys[first[-1]])


def set_digest(shingles: np.ndarray) -> int:
    """A 64-bit digest of a set, the id of its class of equal sets."""
    with np.errstate(over="ignore"):
        sums = np.array([mix(shingles).sum(dtype=np.uint64), np.bitwise_xor.reduce(shingles), np.uint64(len(shingles))], np.uint64)
        mixed = mix(sums[:1] * np.uint64(7) + mix(sums[1:2]) + sums[2:])
    return int(mixed.view(np.int64)[0])


def frequent_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """Shingles of many texts, sorted; a bounded number.  They only order pivots and change no result.

    Tasks count chunks of texts, each distinct set once, and pass on what occurs twice in a chunk.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            own, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(own[n > 1].view(np.int64)), pa.array(n[n > 1])], ["shingle", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = shingle_set(text, words)
                if len(own) and (name := set_digest(own)) not in seen:
                    seen.add(name)
                    held.append(own)
                    size += len(own)
                if size >= COUNTED:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counted = texts(docs).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    most = counted.where(F.col("n") >= FREQUENT_TEXTS).orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toPandas()
    return np.sort(most["shingle"].to_numpy(np.int64).view(np.uint64))


def set_classes(docs: DataFrame, words: int, percent: int, frequent: Broadcast) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class, last``: equal sets have one class; null for texts without words."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_digest(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([set_pivots(s, percent, frequent.value)[1] if len(s) else None for s in sets], pa.int64())],
                ["doc_id", "text_hash", "n_shingles", "class", "last"])

    rows = hashed_texts(docs)
    return rows.mapInArrow(digest, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, n_shingles long, class long, last long")


def hashed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, text``: what tells rows apart, whether they have an id or not."""
    return texts(docs, "doc_id").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def regions(docs: DataFrame, words: int, percent: int, frequent: Broadcast) -> DataFrame:
    """``pivot, class, rank, size``: the members of every region with several classes, ranked by class (0, else 1, in large ones).

    Each task gives out a class once, so copies combine before the shuffle.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            pivots, owners = [], []
            for text in batch.column(0).to_pylist():
                own = shingle_set(text, words)
                if len(own) and (name := set_digest(own)) not in seen:
                    seen.add(name)
                    pivots.append(set_pivots(own, percent, frequent.value)[0])
                    owners.append(np.full(len(pivots[-1]), name, np.int64))
            if pivots:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(pivots)), pa.array(np.concatenate(owners))], ["pivot", "class"])

    dealt = stored(texts(docs).mapInArrow(deal, "pivot long, class long"), "dealt")
    # combined before the shuffle, so the members of a large region never meet
    mixed = dealt.groupBy("pivot").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("pivot", "low")
    members = stored(dealt.join(mixed, "pivot").select("pivot", "class", "low").distinct(), "members")
    sized = members.join(members.groupBy("pivot").agg(F.count(F.lit(1)).alias("size")), "pivot")
    # only small regions are ranked; in a large one the first is told from the others
    region = Window.partitionBy("pivot").orderBy("class")
    small = sized.where(F.col("size") <= SMALL_REGION).withColumn("rank", F.row_number().over(region) - 1)
    large = sized.where(F.col("size") > SMALL_REGION).withColumn("rank", F.when(F.col("class") == F.col("low"), 0).otherwise(1))
    return stored(small.unionByName(large).select("pivot", "class", "rank", "size"), "regions")


def clusters(members: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """``class, cluster``: what chains of possible links connect; every link lies inside a cluster.

    In a small region all pairs are candidates.  Linked sets share at least so many shingles
    that, beyond those after the last pivot, some number of pivots must be common; the pairs with
    fewer common regions, or with sizes too far apart, go.  A large region is one cluster as it is.
    """
    # regions that both share but that are large aren't among the common ones below: they count for both
    large = members.where(F.col("size") > SMALL_REGION).groupBy("class").agg(F.count(F.lit(1)).alias("large"))
    info = named.where("class IS NOT NULL").groupBy("class").agg(F.first("n_shingles").alias("n"), F.first("last").alias("last"))
    info = members.select("class").distinct().join(info, "class").join(large, "class", "left").na.fill(0, ["large"])
    # sizes in steps of the similarity: linked sets are at most one step apart
    step = F.floor(F.log(F.col("n")) / (math.log(100 / percent) * (1 + 1e-9))).cast("int")
    small = members.where(F.col("size") <= SMALL_REGION).join(info, "class").withColumn("step", step)
    side = lambda c, *more: small.select("pivot", *more, *[F.col(x).alias(f"{x}_{c}") for x in ("class", "rank", "n", "last", "large")])
    lower = side("b", F.col("step").alias("own"), F.explode(F.array(F.col("step"), F.col("step") - 1)).alias("step"))
    pairs = side("a", "step").join(lower, ["pivot", "step"]).where((F.col("own") != F.col("step")) | (F.col("rank_a") < F.col("rank_b")))
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    known = pairs.groupBy(F.col("class_a").alias("a"), F.col("class_b").alias("b")).agg(
        F.count(F.lit(1)).alias("common"), *[F.first(f"{x}_{c}").alias(f"{x}_{c}") for x in ("n", "last", "large") for c in "ab"])
    least = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    beyond = F.when(F.col("last_a") < F.col("last_b"), F.col("n_a")).otherwise(F.col("n_b"))
    beyond = F.ceil(percent * beyond / 100) - 1
    shared = F.col("common") + F.least("large_a", "large_b")
    possible = known.where(shared >= least - beyond).select("a", "b")
    first = members.where((F.col("rank") == 0) & (F.col("size") > SMALL_REGION)).select("pivot", F.col("class").alias("b"))
    whole = members.where("rank > 0").join(first, "pivot").select(F.col("class").alias("a"), "b")
    roots = stored(components(possible.unionByName(whole).distinct()), "roots")
    # a root is a member too
    return roots.select(F.col("node").alias("class"), F.col("root").alias("cluster")).unionByName(
        roots.select(F.col("root").alias("class"), F.col("root").alias("cluster")).distinct())


def member_sets(docs: DataFrame, named: DataFrame, clustered: DataFrame, words: int) -> DataFrame:
    """``class, cluster, n, shingles array<long>`` for the clustered classes, from the text of one row of each, with an id or without."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(name, group, shingle_set(text, words).view(np.int64)) for name, group, text in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            bounds = np.cumsum([0, *(len(s) for _, _, s in own)])
            flat = np.concatenate([*(s for _, _, s in own), np.zeros(0, np.int64)])
            column = lambda i: pa.array([r[i] for r in own], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column(0), column(1), pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))],
                ["class", "cluster", "n", "shingles"])

    # the text of a class: that of the lowest hash, in the row of the lowest id; equal rows give one set
    chosen = named.join(clustered, "class").groupBy("class", "cluster").agg(F.min(F.struct("text_hash", "doc_id")).alias("row"))
    chosen = chosen.select("class", "cluster", F.col("row.text_hash").alias("__hash"), F.col("row.doc_id").alias("__id"))
    rows = hashed_texts(docs).join(chosen, (F.col("text_hash") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    made = rows.select("class", "cluster", "text").mapInArrow(build, "class long, cluster long, n long, shingles array<long>")
    return stored(made.dropDuplicates(["class"]), "sets")


def joined_cluster(names: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The label of each set of one small cluster: the smallest name that links reach.

    Regions are formed again from the sets.  In a region only members of different components
    are compared, and only if their sizes allow a link; a pair is compared once.
    """
    up = list(range(len(names)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    none = np.zeros(0, np.uint64)
    pivots = [set_pivots(own.view(np.uint64), percent, none)[0] for own in sets]
    owners = np.repeat(np.arange(len(sets)), [len(p) for p in pivots])
    dealt = np.concatenate([*pivots, np.zeros(0, np.int64)])
    order = np.argsort(dealt, kind="stable")
    cuts = np.flatnonzero(np.diff(dealt[order])) + 1
    tried: set[bytes | tuple[int, int]] = set()
    for region in np.split(owners[order], cuts):
        if len(region) < 2 or (alike := region.tobytes()) in tried:
            continue
        tried.add(alike)
        parts: dict[int, list[int]] = {}
        for i in region.tolist():
            parts.setdefault(top(i), []).append(i)
        before: list[int] = []
        for part in parts.values():
            for a in part:
                for b in before:
                    x, y = top(a), top(b)
                    if x == y or (min(a, b), max(a, b)) in tried:
                        continue
                    tried.add((min(a, b), max(a, b)))
                    small, large = sorted((len(sets[a]), len(sets[b])))
                    if 100 * small < percent * large:
                        continue
                    common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if 100 * common >= percent * (small + large - common):
                        up[max(x, y)] = min(x, y)
            before += part
    return names[[top(i) for i in range(len(names))]]


def small_components(sets: DataFrame, small: DataFrame, percent: int) -> DataFrame:
    """``class, label`` for the clusters in ``small``, each joined in one task."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("class").sort_values("class")
        names = rows["class"].to_numpy(np.int64)
        return pd.DataFrame({"class": names, "label": joined_cluster(names, [np.asarray(s) for s in rows["shingles"]], percent)})

    joined = sets.join(small, "cluster").select("cluster", "class", "shingles").groupBy("cluster").applyInPandas(join, "class long, label long")
    return joined.distinct()


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` with their exact Jaccard ``distance`` and ``linked``."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return both.select("a", "b", (1 - F.col("common") / union).alias("distance"), (100 * F.col("common") >= percent * union).alias("linked"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of the edges ``a, b`` reaches.

    Alternates two steps that hang neighbours under the smallest of them, first larger, then
    smaller ones, until all edges point at roots.  Each step is a grouping with one row per
    edge, and writes its edges, so a lost executor costs one step.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        now = stored(small.where("a <> b").distinct(), "edges")
        after = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if after == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = after


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining what the links ``a, b`` (classes) connect."""
    name = lambda side: labels.select(F.col("class").alias(side), F.col("label").alias(f"label_{side}"))
    edges = links.join(name("a"), "a").join(name("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    roots = components(edges)
    joined = labels.join(roots, labels["label"] == roots["node"], "left")
    return stored(joined.select("class", F.coalesce("root", "label").alias("label"), "n", "near", "distance"), "labels")


def class_components(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``class, label``: connected classes share a label.

    Clusters of up to SMALL_SETS classes and SMALL_SHINGLES shingles are joined in one task each, to
    which every set goes once.  Larger ones, whatever their size, are joined by ``large_components``.
    """
    totals = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("total"))
    fits = (F.col("sets") <= SMALL_SETS) & (F.col("total") <= SMALL_SHINGLES)
    sizes = stored(totals.select("cluster", fits.alias("fits")), "clusters")
    labels = stored(small_components(sets, sizes.where("fits").select("cluster"), percent), "small")
    large = sizes.where("NOT fits").select("cluster")
    if not large.take(1):
        return labels
    rest = sets.join(large, "cluster")
    own = members.join(rest.select("class").distinct(), "class").select("pivot", "class", "rank")
    # regions of any size are ranked by running counts over stored ranges
    ranked = running_before(own.withColumn("rank", F.lit(1)), "pivot", [F.col("class")], "rank", "ranks")
    ranked = ranked.select("pivot", "class", F.col("__before").alias("rank"))
    return labels.unionByName(large_components(stored(ranked, "large"), rest, percent))


def large_components(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``class, label`` where a cluster is too large for one task.

    First each class is compared with one pivot document, the lowest class of all its regions;
    near copies of one text come together here, with one comparison each.  Then the regions that
    still hold several components recur: the members of next ranks are pivots, twice as many
    each time, and are compared with the later members of their region, unless both are
    connected already, or the triangle inequality rules the pair out: their known distances to
    one pivot differ by more than linked documents are apart.  Every pair of a region is thereby
    linked, connected, ruled out or compared.
    """
    apart = (100 - percent) / 100 + 1e-9
    first = members.where("rank = 0").select("pivot", F.col("class").alias("b"))
    nearest = members.where("rank > 0").join(first, "pivot").groupBy(F.col("class").alias("a")).agg(F.min("b").alias("b"))
    seen = stored(compared(nearest, sets, percent), "compared")
    known = seen.select(F.col("a").alias("class"), F.col("b").alias("near"), "distance").distinct()
    labels = sets.select("class", "n").distinct().join(known, "class", "left")
    labels = stored(labels.select("class", F.col("class").alias("label"), "n", "near", "distance"), "labels")
    labels = relabelled(labels, seen.where("linked"))
    tried = seen.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low, high, each, active = 0, 1, 1, members
    while True:
        placed = active.join(labels, "class")
        mixed = placed.groupBy("pivot").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("pivot")
        placed = stored(placed.join(mixed, "pivot"), "active")
        most = placed.agg(F.max("rank")).first()[0]
        if most is None or most <= low:
            return labels.select("class", "label")
        take = lambda side, kind: placed.where(kind).select(
            "pivot", *[F.col(c).alias(f"{c}_{side}") for c in ("class", "label", "n", "near", "distance", "rank")])
        pairs = take("b", f"rank >= {low} AND rank < {high}").join(take("a", f"rank > {low}"), "pivot")
        pairs = pairs.where("rank_a > rank_b AND label_a <> label_b")
        pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        ruled_out = (F.col("near_a") == F.col("near_b")) & (F.abs(F.col("distance_a") - F.col("distance_b")) > apart)
        pairs = pairs.where(~F.coalesce(ruled_out, F.lit(False)))
        pairs = pairs.select(F.greatest("class_a", "class_b").alias("a"), F.least("class_a", "class_b").alias("b")).distinct()
        # a few pairs of each class at a time: what links makes most of the others needless
        turn = F.row_number().over(Window.partitionBy("a").orderBy("b"))
        chosen = stored(pairs.join(tried, ["a", "b"], "left_anti").withColumn("turn", turn).where(F.col("turn") <= each).select("a", "b"), "pairs")
        if not chosen.take(1):
            active = placed.select("pivot", "class", "rank")
            low, high = high, 2 * high + 1
            continue
        tried, each = stored(tried.unionByName(chosen), "tried"), 2 * each
        links = stored(compared(chosen, sets, percent).where("linked").select("a", "b"), "links")
        if links.take(1):
            labels = relabelled(labels, links)


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents that chains of links connect: ``doc_id, n_shingles, class, component_id``.

    A document is the set of its distinct runs of ``words`` words (A-Z lower-cased; a shorter
    text is one run).  Two link when their Jaccard similarity is ``percent`` / 100 or more:
    100 * intersection >= percent * union.  ``component_id`` is the smallest doc_id that links
    reach.  Equal sets are one class, compared once; the join between classes is exact.

    Pivots are single shingles (``set_pivots``): a region is the cell of a pivot, and sets are
    replicated into the cells that a linked set may lie in.  What possible links connect (``clusters``)
    is joined in one task where it is small, and recurs with documents as pivots where it isn't
    (``class_components``).

    Texts without words, null ones too, have no shingles and link with nothing.  Each row is a document:
    rows of equal doc_id link like others, by their texts, and each has the component of its own text.  A
    row with a null doc_id ties others together like any, and its own component is null.  All rows
    stay; other columns go.
    """
    named, roots = class_groups(docs, words, percent)
    lowest = named.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("lowest"))
    groups = lowest.join(roots, "class", "left").withColumn("group", F.coalesce("label", "class"))
    reached = groups.groupBy("group").agg(F.min("lowest").alias("component"))
    found = groups.join(reached, "group").select(F.col("class").alias("__class"), "component")
    joined = named.join(found, named["class"] == found["__class"], "left")
    return joined.select("doc_id", "n_shingles", "class", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def class_groups(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The class of each row (``set_classes``), and ``class, label``: classes that links connect share a label."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, words))
    named = stored(set_classes(docs, words, percent, frequent), "classes")
    members = regions(docs, words, percent, frequent)
    sets = member_sets(docs, named, clusters(members, named, percent), words)
    return named, class_components(members, sets, percent)


def op10_jaccard_join(docs: DataFrame) -> DataFrame:
    return jaccard_join(docs, words=3, percent=90).select("doc_id", "n_shingles", "component_id")


def stage_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, columns unchanged: that of the smallest doc_id, rows without an id last.

    Rows of equal id go by a hash of their text; of rows equal in both, whatever their other columns hold, one
    stays.  So a table appended twice, with ids or without, is deduplicated.  Documents without words all stay.
    """
    named, roots = class_groups(docs, 5, 80)
    rows = named.where("class IS NOT NULL").join(roots, "class", "left").withColumn("group", F.coalesce("label", "class"))
    # false sorts before true: a null id comes last
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = rows.groupBy("group").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    several = rows.join(first.where("n > 1").select("group", "first"), "group")
    copies = several.groupBy("doc_id", "text_hash").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"))
    keeps = (F.col("text_hash") == F.col("first.text_hash")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    # rows to drop, and rows of which one stays
    marks = copies.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.when(keeps, F.col("n")).otherwise(0).alias("__n"))
    marks = marks.where("__n <> 1")
    own = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = (own["__own"] == marks["__hash"]) & own["doc_id"].eqNullSafe(marks["__id"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = own.join(marks, same, "left_anti").select(*columns)
    equal = own.join(marks.where("__n > 1"), same).groupBy("__id", "__hash").agg(F.first(F.struct(*columns)).alias("__row"))
    return single.unionByName(equal.select("__row.*"))
