"""Head counts from words of 64 members: who was there is a bit, and counting is adding up bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions import clock
from rollcall.functions.clock import whole

#: members that one whole number holds
WORD = 64
#: members of a part of a large group, about; a part has far fewer words than this
PART = 4096


def numbered_members(pairs: DataFrame, group: str, member: str = "UserKey") -> DataFrame:
    """Distinct (group, member) with ``_word`` and ``_bit``: the place of the member among those of its group.

    Members are numbered densely, so a group of thirty is one word, however its keys are spread.  A
    group of more than PART members is dealt out by a hash into parts of about so many, numbered for
    themselves, so a group may be any share of the table.
    """
    listed = pairs.select(group, member).dropna().distinct()
    sizes = listed.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    part = F.pmod(F.xxhash64(member), F.ceil(F.col("_size") / PART))
    dealt = listed.join(sizes, group).withColumn("_part", part)
    at = F.row_number().over(Window.partitionBy(group, "_part").orderBy(member)) - 1
    placed = dealt.withColumn("_at", at)
    word = F.col("_part") * PART + whole(F.col("_at"), WORD)
    return placed.select(group, member, word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_at") % WORD).cast("int")).alias("_bit"))


def count_members(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Distinct members per key from rows with ``_word`` and ``_bits``; bits combine before the shuffle."""
    words = rows.groupBy(*keys, "_word").agg(F.bit_or("_bits").alias("_bits"))
    return words.groupBy(*keys).agg(F.sum(F.bit_count("_bits")).alias(out))


def cut_points(spans: DataFrame) -> DataFrame:
    """Per date the seconds at which a span (``_from`` to ``_until``, both included) begins or is over, sorted.

    They cut the day into segments that each span holds whole or not at all.  A date has at most as
    many as the day has seconds, and as a rule a few dozen.
    """
    ends = spans.select("DateKey", F.explode(F.array(F.col("_from"), F.col("_until") + 1)).alias("_cut"))
    return ends.groupBy("DateKey").agg(F.array_sort(F.collect_set("_cut")).alias("_cuts"))


def _segment(second: Column) -> Column:
    return F.array_max(F.filter("_cuts", lambda c: c <= second))


def heads_in_spans(spans: DataFrame, keys: list[str], wifi: DataFrame, members: DataFrame, group: str, out: str) -> DataFrame:
    """Distinct members seen per span and group: ``keys``, the group (once) and ``out``; spans without any are absent.

    ``spans`` has distinct ``keys`` with DateKey, ``_from`` and ``_until``.  If the group is one of the keys, a
    span counts the members of its group; else it counts those of every group.  ``members`` comes from
    ``numbered_members``.

    A connection only names its segment of the day, and a member is one bit there.  A span unites
    the words of its segments: no row is written for a span and a member, and spans that overlap share
    their segments.
    """
    cuts = cut_points(spans)
    seen = wifi.join(cuts, "DateKey").select("UserKey", "DateKey", _segment(clock.key_seconds("TimeKey")).alias("_segment"))
    seen = seen.where("_segment IS NOT NULL").distinct().join(members, "UserKey")
    bits = seen.groupBy("DateKey", "_segment", group, "_word").agg(F.bit_or("_bit").alias("_bits"))
    inside = F.filter("_cuts", lambda c: (c >= F.col("_from")) & (c <= F.col("_until")))
    parts = spans.join(cuts, "DateKey").select(*keys, F.explode(inside).alias("_segment"))
    on = [c for c in ("DateKey", group, "_segment") if c in keys or c == "_segment"]
    return count_members(parts.join(bits, on), list(dict.fromkeys([*keys, group])), out)
