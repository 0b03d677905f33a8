"""Sessions, lagged means, ranking and key numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.session import stored


def island_sessions(
    blocks: DataFrame, keys: list[str], start: str, end: str, max_gap: int, out: str = "SessionNumber"
) -> DataFrame:
    """Number the sessions of each group: a gap above ``max_gap`` starts a new one.

    A group holds the blocks of one day, which bounds it; equal blocks get one number.
    """
    ordered = Window.partitionBy(*keys).orderBy(start, end)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(end).over(before)
    opens = F.when(reach.isNull() | (F.col(start) - reach > max_gap), 1).otherwise(0)
    return blocks.withColumn("_opens", opens).withColumn(
        out, F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    ).drop("_opens")


def bounded_sessions(
    blocks: DataFrame,
    keys: list[str],
    start: str,
    end: str,
    max_gap: int,
    max_length: int,
    out: str = "SessionNumber",
) -> DataFrame:
    """Sessions that stop growing at ``max_length``.

    Whether a block joins depends on where the current session began, so each group is
    folded in order.  Only the first block of every session is kept while folding; a
    block then belongs to the last session that began at or before it.  Blocks must be
    distinct, which bounds a group by the minutes of a day.
    """
    block = F.struct(F.col(start).alias("s"), F.col(end).alias("e"))
    kind = blocks.schema[start].dataType.simpleString()
    seed = F.struct(
        F.lit(None).cast(kind).alias("s"),
        F.lit(None).cast(kind).alias("e"),
        F.array().cast(f"array<struct<s:{kind},e:{kind}>>").alias("firsts"),
    )

    def step(state: Column, b: Column) -> Column:
        reach = F.greatest(state["e"], b["e"])
        joins = (b["s"] - state["e"] <= max_gap) & (reach - state["s"] <= max_length)
        grown = F.struct(state["s"].alias("s"), reach.alias("e"), state["firsts"].alias("firsts"))
        opened = F.struct(
            b["s"].alias("s"), b["e"].alias("e"), F.array_append(state["firsts"], b).alias("firsts")
        )
        return F.when(state["s"].isNotNull() & joins, grown).otherwise(opened)

    days = blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(block)).alias("_blocks"))
    folded = days.withColumn("_firsts", F.aggregate("_blocks", seed, step, lambda s: s["firsts"]))
    rows = folded.withColumn("_block", F.explode("_blocks"))
    number = F.size(F.filter("_firsts", lambda f: f <= F.col("_block")))
    return rows.select(
        *keys, F.col("_block.s").alias(start), F.col("_block.e").alias(end), number.alias(out)
    )


def in_ranges(df: DataFrame, order: list[str], name: str = "ranges", ranges: int | None = None) -> DataFrame:
    """The rows, written once, with ``_range``: ranges follow each other in ``order``.

    The split points are Spark's own range sample.  They may differ between two evaluations,
    so the number of each row's range is stored with it.  There are as many ranges as shuffle
    partitions, or ``ranges``.  ``order`` should tell all rows apart, so that no range has to stay large.
    """
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return stored(dealt.withColumn("_range", F.spark_partition_id()), name)


def _range_tails(rows: DataFrame, group: list[str], order: list[str], value: str, n: int) -> DataFrame:
    """Per (group, range) the last ``n`` values of the ranges before it, oldest first."""
    backwards = Window.partitionBy(*group, "_range").orderBy(*[F.desc(c) for c in order])
    tails = (
        rows.select(*dict.fromkeys([*group, "_range", *order, value]))
        .withColumn("_back", F.row_number().over(backwards))
        .where(F.col("_back") <= n)
        .groupBy(*group, "_range")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("p"), F.col(value).alias("v")))).alias("_t"))
        .withColumn("_t", F.transform("_t", lambda x: x["v"]))
    )
    # every listed range has a row, so n ranges back are enough for n rows
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(-n, -1)
    return tails.select(*group, "_range", F.flatten(F.collect_list("_t").over(before)).alias("_halo"))


def lagged_mean(ranged: DataFrame, group: list[str], order: list[str], value: str, n: int, out: str, rows: DataFrame | None = None) -> DataFrame:
    """Mean of the ``n`` rows before the current one, null on the first row of a group.

    ``ranged`` comes from ``in_ranges`` with the same ``order``.  Windows run per (group, range),
    so a group with a third of the table is spread over the ranges; the first ``n`` rows
    of a range take what they miss from the last rows of the ranges before it.  ``rows``
    is the table to take those from; give the stored one when several lagged columns are
    added in a row, so that the earlier steps are not run again.
    """
    inside = Window.partitionBy(*group, "_range").orderBy(*order)
    frame = inside.rowsBetween(-n, -1)
    base = ranged.withColumns({
        "_rn": F.row_number().over(inside),
        "_sum": F.coalesce(F.sum(value).over(frame), F.lit(0.0)),
        "_cnt": F.count(value).over(frame),
    })
    halo = _range_tails(ranged if rows is None else rows, group, order, value, n)
    joined = base.join(halo, [*group, "_range"], "left")
    need = F.greatest(F.lit(n) - (F.col("_rn") - 1), F.lit(0))
    take = F.least(need, F.size("_halo"))
    part = F.when(take > 0, F.slice("_halo", F.size("_halo") - take + 1, take)).otherwise(
        F.slice("_halo", 1, 0)
    )
    filled = F.filter(part, lambda x: x.isNotNull())
    total = F.col("_sum") + F.aggregate(filled, F.lit(0.0), lambda a, x: a + x)
    count = F.col("_cnt") + F.size(filled)
    return joined.withColumn(out, F.when(count > 0, total / count)).drop("_rn", "_sum", "_cnt", "_halo")


def running_before(ranged: DataFrame, group: list[str], order: list[str], amount: str, out: str, size: str | None = None) -> DataFrame:
    """Sum of ``amount`` over the earlier rows of the same group; ``ranged`` comes from ``in_ranges``.

    Sums run inside a range, and only one total per (group, range) passes on to later ranges.  ``size`` names a column
    for the sum of the whole group, from the same totals.  The group passes as one struct, in which nulls are equal, so
    rows are dealt out once, for the window and the join, without a second copy of it.
    """
    key = F.struct(*(group or [F.lit(0)])).alias("_g")
    totals = ranged.groupBy(key, "_range").agg(F.sum(amount).alias("_total"))
    whole = Window.partitionBy("_g")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    more = [F.sum("_total").over(whole).alias(size)] if size else []
    offsets = totals.select("_g", "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"), *more)
    inside = Window.partitionBy("_g", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(key, *[c for c in ranged.columns if c not in group]).withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    added = local.join(offsets, ["_g", "_range"]).withColumn(out, F.col("_offset") + F.col("_inside"))
    return added.select(*[F.col("_g")[c].alias(c) if c in group else c for c in ranged.columns], out, *([size] if size else []))


def with_share(counts: DataFrame, key: list[str], count: str) -> DataFrame:
    """Total of the key and the share of each candidate."""
    per_key = Window.partitionBy(*key)
    return counts.withColumn("TotalEvidence", F.sum(count).over(per_key)).withColumn(
        "Confidence", F.col(count) / F.col("TotalEvidence")
    )


def best_candidate(counts: DataFrame, key: list[str], candidate: str, count: str) -> DataFrame:
    """Top candidate per key (first by name on equal counts) and how many share the top."""
    top = Window.partitionBy(*key)
    ranked = counts.withColumns({
        "_top": F.max(count).over(top),
        "_rank": F.row_number().over(top.orderBy(F.desc(count), F.asc(candidate))),
    }).withColumn("TopCandidateCount", F.sum((F.col(count) == F.col("_top")).cast("int")).over(top))
    return ranked.where("_rank = 1").drop("_rank", "_top")


def best_two(counts: DataFrame, key: list[str], count: str) -> DataFrame:
    """Best and second-best count per key with the confidence (best - second) / best."""
    w = Window.partitionBy(*key).orderBy(F.desc(count))
    ranked = counts.withColumn("_rank", F.row_number().over(w))
    best = F.max(F.when(F.col("_rank") == 1, F.col(count)))
    second = F.coalesce(F.max(F.when(F.col("_rank") == 2, F.col(count))), F.lit(0))
    return ranked.groupBy(*key).agg(best.alias("Best"), second.alias("SecondBest")).withColumn(
        "Confidence", (F.col("Best") - F.col("SecondBest")) / F.col("Best")
    )


def number_rows(df: DataFrame, key: str, out: str, start: int = 1, ranges: int | None = None) -> DataFrame:
    """Dense numbers from ``start`` in key order; keys must be distinct.

    Keys are numbered inside ranges and shifted by the sizes of the ranges before them,
    whatever the size of the table.
    """
    ranged = in_ranges(df.withColumn("_one", F.lit(1)), [key], "keys", ranges)
    before = running_before(ranged, [], [key], "_one", "_before")
    return before.withColumn(out, (F.col("_before") + start).cast("bigint")).drop("_range", "_one", "_before")


def rolling_mean_by_week(df: DataFrame, keys: list[str], week: str, value: str, weeks: int, out: str) -> DataFrame:
    """Mean over this and the rows before it, per key on a dense weekly grid."""
    w = Window.partitionBy(*keys).orderBy(week).rowsBetween(-(weeks - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))
