"""Line dedup: lines that many sites share are boilerplate and go."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.common import trimmed, word_count
from rollcall.session import stored

#: least words of a line, and the distinct sites that make such a line boilerplate; the same for every corpus.
#: Few sites repeat a long passage by chance, short sentences need more of them.
LEAST_SITES = ((20, 3), (8, 4), (0, 6))
#: a line of fewer distinct texts, on whatever sites, belongs to whole copies, which are the Jaccard join's work
LEAST_TEXTS = 3
#: binary logarithm of a sketch's registers
LG_REGISTERS = 10


def line_hash(line: Column) -> Column:
    """Hash of a line without the white space around it."""
    return F.xxhash64(trimmed(line))


def sites_asked(line: Column, least_sites: int | None) -> Column:
    """Distinct sites that make the line boilerplate: ``least_sites``, or by the number of its words."""
    if least_sites is not None:
        return F.lit(least_sites)
    words = word_count(line)
    return F.coalesce(*[F.when(words >= least, F.lit(sites)) for least, sites in LEAST_SITES])


def line_sites(docs: DataFrame, least_sites: int | None = None) -> DataFrame:
    """``line, asked, content, source``: each distinct line of each distinct text on each of its sites, with the sites asked for.

    Equal rows combine before the shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("source", F.xxhash64(text).alias("content"), F.split(text, "\n").alias("lines"))
    full = F.filter("lines", lambda x: trimmed(x) != "")
    own = lambda x: F.struct(line_hash(x).alias("line"), sites_asked(x, least_sites).alias("asked"))
    rows = rows.select("source", "content", F.explode(F.array_distinct(F.transform(full, own))).alias("own"))
    return rows.select("own.line", "own.asked", "content", "source").distinct()


def boilerplate(found: DataFrame, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """``line``: the hashes of the lines of several distinct texts that as many distinct sites have as are asked for (``line_sites``).

    HyperLogLog sketches of sites and texts for each line merge by aggregation, whatever their number.
    Lines of which an estimate lies within three standard errors (and one) of its threshold are counted exactly.
    """
    site = F.xxhash64("source")
    sketch = lambda c: F.hll_sketch_agg(c, F.lit(lg_registers))
    sketches = found.groupBy("line", "asked").agg(sketch(site).alias("sites"), sketch(F.col("content")).alias("texts"), F.count(F.lit(1)).alias("n"))
    # a line with fewer (text, site) rows than sites asked for can't reach the threshold
    several = sketches.where(F.col("n") >= F.col("asked"))
    margin = lambda least: F.ceil(3 * 1.04 / math.sqrt(2**lg_registers) * least) + 1
    asked, texts = F.col("asked"), F.lit(LEAST_TEXTS)
    clear = (F.col("sites") > asked + margin(asked)) & (F.col("texts") > texts + margin(texts))
    possible = (F.col("sites") >= asked - margin(asked)) & (F.col("texts") >= texts - margin(texts))
    spread = several.select("line", "asked", F.hll_sketch_estimate("sites").alias("sites"), F.hll_sketch_estimate("texts").alias("texts"))
    spread = stored(spread.where(possible), "spread")
    exact = found.join(spread.where(~clear).select("line"), "line").groupBy("line", "asked").agg(
        F.count_distinct(site).alias("sites"), F.count_distinct("content").alias("texts"))
    return spread.where(clear).select("line").unionByName(exact.where((F.col("sites") >= asked) & (F.col("texts") >= texts)).select("line"))


def dedup_lines(docs: DataFrame, least_sites: int | None = None) -> DataFrame:
    """The documents without boilerplate lines, in their own columns, and ``__removed``, the number of lines that went.

    A line is boilerplate on ``least_sites`` distinct sites; without that, on as many as LEAST_SITES
    asks of its words; and in LEAST_TEXTS distinct texts.  It is compared without the white space around it; blank lines stay.  ``text`` is
    rebuilt from the lines that stay; ``n_chars``, where there is such a column, follows.
    Boilerplate goes whatever share of a document it makes up; only a document without a line
    of its own stays whole.

    Null and empty texts stay as they are; a null source is a site.  Equal texts get equal
    results; rows with equal or null ids all stay; other columns pass unchanged, but may not be named ``__own``,
    ``__content``, ``__flagged``, ``__lines``, ``__kept``, ``__rest`` or ``__removed``.
    """
    # lines are split and hashed once; what is stored are numbers
    found = stored(line_sites(docs, least_sites), "lines")
    carriers = found.join(boilerplate(found), "line").select("content", "line").distinct()
    # stored, so that the join with the texts can split a text that a third of all rows have; the table grows with the
    # corpus, and is merged at every size
    flagged = stored(carriers.groupBy(F.col("content").alias("__content")).agg(F.collect_set("line").alias("__flagged")), "flagged")
    rows = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    joined = rows.join(flagged.hint("merge"), F.col("__own") == F.col("__content"), "left")
    gone = lambda x: (trimmed(x) != "") & F.array_contains("__flagged", line_hash(x))
    split = joined.withColumn("__lines", F.when(F.col("__flagged").isNotNull(), F.split("text", "\n")))
    split = split.withColumn("__kept", F.filter("__lines", lambda x: ~gone(x)))
    rest = F.array_join("__kept", "\n")
    some = F.exists("__kept", lambda x: trimmed(x) != "")
    split = split.withColumn("__rest", F.when(some, rest))
    changed = F.col("__rest").isNotNull()
    columns = []
    for c in docs.columns:
        own = F.col(f"`{c}`")
        if c == "text":
            own = F.when(changed, F.col("__rest")).otherwise(own)
        elif c == "n_chars":
            own = F.when(changed, F.length("__rest")).otherwise(own).cast(docs.schema[c].dataType)
        columns.append(own.alias(c))
    removed = F.when(changed, F.size("__lines") - F.size("__kept")).otherwise(0).cast("long")
    return split.select(*columns, removed.alias("__removed"))


def op6_line_dedup(docs: DataFrame) -> DataFrame:
    cleaned = dedup_lines(docs.select("doc_id", "source", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return cleaned.select("doc_id", (F.size(F.split(text, "\n")) + F.col("__removed")).cast("long").alias("n_lines"),
                          F.col("__removed").alias("removed_lines"), F.length(text).cast("long").alias("kept_chars"),
                          F.sha2(text, 256).alias("kept_sha256"))


def stage_line_dedup(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).drop("__removed")


_ASKED = " ".join(f"WHEN len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {least} THEN {sites}" for least, sites in LEAST_SITES)

SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
space AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS space),
t AS (SELECT DISTINCT text, source FROM d),
l AS (SELECT DISTINCT text, source, line FROM (
  SELECT text, source, trim(x, space) AS line FROM (SELECT text, source, unnest(string_split(text, chr(10))) AS x FROM t), space) WHERE line <> ''),
b AS (SELECT coalesce(list(line), []) AS lines FROM (
  SELECT line FROM l GROUP BY line HAVING count(DISTINCT coalesce('s' || source, '')) >= CASE {_ASKED} END AND count(DISTINCT text) >= {LEAST_TEXTS})),
s AS (SELECT doc_id, text, string_split(text, chr(10)) AS own,
  list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(lines, trim(x, space))) AS kept, space FROM d, b, space),
c AS (SELECT doc_id, text, own, kept, CASE WHEN len(list_filter(kept, lambda x: trim(x, space) <> '')) > 0 THEN array_to_string(kept, chr(10)) END AS rest FROM s)
SELECT doc_id, len(own)::BIGINT AS n_lines, CASE WHEN rest IS NULL THEN 0 ELSE len(own) - len(kept) END::BIGINT AS removed_lines,
  length(coalesce(rest, text))::BIGINT AS kept_chars, sha256(coalesce(rest, text)) AS kept_sha256
FROM c
"""
