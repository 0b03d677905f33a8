"""Mixing sources to target weights: weighted sampling without replacement up to word budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.common import running_before, word_count

MOST_EPOCHS = 3


def source_targets(sizes: DataFrame, weight: Column, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Word budget of every source.

    ``sizes`` has ``source`` and ``source_size`` (words), a row for each source.  Sources
    share the sum of all sizes by ``weight``; no budget exceeds ``most_epochs`` times its
    source, and what is above goes to the others by weight, until none is above.  The
    result of that exchange is a water level L: the budget is min(cap, L * weight).  Sorted
    by cap / weight, the capped sources come first, so L follows from two running sums.
    The table of sources is small: a weight is set for each of them.
    """
    caps = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.lit(most_epochs) * F.col("source_size"))
    rank = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    after = rank.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(rank.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # the level if every source before this one is capped; the first source that stays below its cap sets it
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = caps.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    whole = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chosen = levels.withColumn("rank", F.row_number().over(rank)).withColumn(
        "water", F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(whole))
    target = F.when(F.col("water").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight")))
    return chosen.select("source", "source_size", target.alias("target"))


def quality(text: Column, size: Column) -> Column:
    """Default document weight, over 0 and up to 1: words of about five and a half letters weigh most."""
    mean = (F.length(text) + 1) / F.greatest(size, F.lit(1))
    return 1.0 / (1.0 + F.abs(mean - 6.5))


def sampling_key(seed: str, doc_id: Column, weight: Column) -> Column:
    """Exponential variable with rate ``weight``: taking the smallest keys samples by weight.

    The uniform variable comes from a digest of seed and id, so a rerun draws the same documents.
    """
    bits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    uniform = (F.conv(bits, 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.log(uniform) / weight


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[float, ...] = (1.0, 2.0, 3.0),
        most_epochs: int = MOST_EPOCHS, weight: Column | None = None) -> DataFrame:
    """How often a mix takes each document: ``doc_id, source, size, source_size, target, copies, taken``.

    Sources in code point order, null last, weigh ``weights``, repeating.  Where a budget holds
    a source's words several times, complete epochs take every document that often; the rest is
    sampled: documents sorted by exponential keys scaled by ``weight`` (an expression over the
    documents' columns; ``quality`` by default) are taken while the words before them leave
    room for at least half of the document.

    Null texts and texts without words have size 0 and are taken in complete epochs only.  A
    null source is a source.  Documents of one id draw the same number; equal rows are told
    apart by their order only.  A mix of no words at all takes nothing.  Other columns go.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = word_count(text)
    rows = docs.select("doc_id", "source", size.alias("size"), (quality(text, size) if weight is None else weight).alias("w"))
    rows = rows.select("doc_id", "source", "size", sampling_key(seed, F.col("doc_id"), F.col("w")).alias("key"))
    order = [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("size")]
    placed = running_before(rows, "source", order, "size", "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    budgets = source_targets(sizes.withColumn("place", place), cycle, most_epochs)
    budgets = budgets.select(F.col("source").alias("__source"), "source_size", "target")
    rows = placed.join(budgets, placed["source"].eqNullSafe(budgets["__source"]))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
    rows = rows.withColumn("epochs", epochs)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = (F.col("size") > 0) & (2 * F.col("__before") + F.col("size") <= 2 * rest) & (F.col("epochs") < most_epochs)
    copies = (F.col("epochs") + extra.cast("long")).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


SIZE_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

SQL = f"""
WITH rows AS (
  SELECT doc_id, source, {SIZE_SQL}::BIGINT AS size, length(coalesce(text, '')) AS chars FROM documents),
keyed AS (
  SELECT *, -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
    / (1.0 / (1.0 + abs((chars + 1) / greatest(size, 1) - 6.5))) AS key FROM rows),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM rows GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS rank FROM sizes),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sizes) - coalesce(sum(cap) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
water AS (SELECT (SELECT level FROM levels WHERE level * weight <= cap ORDER BY rank LIMIT 1) AS water),
budgets AS (
  SELECT source, source_size, CASE WHEN water IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, water * weight) END AS target FROM levels, water),
placed AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12) ELSE 0 END::BIGINT AS epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN size > 0 AND epochs < 3 AND 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""


def op5_mixing(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def stage_mix(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, columns unchanged.

    Rows are told apart by source, id and number of words, nulls like values.  Rows equal in all three are interchangeable
    for the mix: together they are taken as often as it takes them, one of them once more where it takes some only.
    """
    key = [F.col("source").alias("__source"), F.col("doc_id").alias("__id"), F.col("size").alias("__size")]
    copies = mix(docs).groupBy(*key).agg(F.min("copies").alias("__copies"), F.sum("copies").alias("__all"), F.count(F.lit(1)).alias("__rows"))
    sized = docs.withColumn("__words", word_count(F.coalesce(F.col("text"), F.lit(""))))
    same = sized["source"].eqNullSafe(copies["__source"]) & sized["doc_id"].eqNullSafe(copies["__id"]) & (sized["__words"] == copies["__size"])
    joined = sized.join(copies, same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    extra = F.col("__all") - F.col("__copies") * F.col("__rows")
    taken = lambda rows, n: rows.withColumn("__again", F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select(*columns)
    # a group of equal rows of which the mix takes some: those are numbered, in ranges of a stored order
    alike = joined.where((F.col("__rows") == 1) | (extra == 0))
    some = joined.where((F.col("__rows") > 1) & (extra > 0)).withColumn("__one", F.lit(1)).withColumn(
        "__group", F.xxhash64(F.struct("__source", "__id", "__size")))
    numbered = running_before(some, "__group", [F.col("__words"), F.xxhash64("text")], "__one", "extra")
    more = F.col("__copies") + (F.col("__before") < F.col("__all") - F.col("__copies") * F.col("__rows")).cast("long")
    return taken(alike, F.col("__copies")).unionByName(taken(numbered, more))
