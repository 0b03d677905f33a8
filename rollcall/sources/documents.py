"""Lists of rows in JSON documents whose wrapper varies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.session import stored

#: entries of one object; those behind a key of the right name come first
_LATER = 2**40


def _kind(value: Column) -> Column:
    """First letter of a variant's type: A for a list, O for an object."""
    return F.upper(F.left(F.schema_of_variant(value), F.lit(1)))


def _entries(node: str, name: str, mark: str) -> Column:
    """The entries of an object in their order: ``place``, ``text`` of the value, ``found`` (a list of rows) and ``wraps`` (an object)."""
    # texts keep the order of keys inside a value, variants tell a list from a text that looks like one
    texts = F.map_entries(F.from_json(node, "map<string,string>"))
    kinds = F.map_values(F.from_json(node, "map<string,variant>"))

    def entry(pair: Column, i: Column) -> Column:
        named = F.lower(F.trim(pair["key"])) == name
        kind = _kind(F.get(kinds, i))
        marked = F.try_variant_get(F.get(kinds, i), f"$[0].{mark}", "variant").isNotNull()
        return F.struct(
            F.when(named, i.cast("bigint")).otherwise(i + F.lit(_LATER)).alias("place"), pair["value"].alias("text"),
            ((kind == "A") & (named | marked)).alias("found"), (kind == "O").alias("wraps"), (named & (kind == "A")).alias("ends"))

    return F.transform(texts, entry)


def find_rows(docs: DataFrame, keys: list[str], doc: str, name: str, mark: str, row_type: str) -> DataFrame:
    """``keys`` and ``row`` for the rows of the first list that each document holds.

    A list counts if it stands under the key ``name`` (case and outer blanks don't matter), or if its first
    element has the key ``mark``.  An object is searched entry by entry, first those under ``name``, then
    all, each on downwards before the next one; a list under ``name``, even an empty one, ends the search of
    its object.  Documents that aren't JSON, or in which nothing is found, have no rows.

    Each round unwraps one level of all documents at once.  What is passed on are the objects
    still to be searched, so rounds are as many as the deepest document has levels of objects.
    """
    parsed = docs.select(*keys, F.ltrim(doc).alias("node")).where(F.try_parse_json("node").isNotNull())
    bare = parsed.where(F.col("node").startswith("[") & F.try_variant_get(F.try_parse_json("node"), f"$[0].{mark}", "variant").isNotNull())
    path = F.array().cast("array<bigint>")
    found = bare.select(*keys, path.alias("path"), F.col("node").alias("list"))
    level = parsed.where(F.col("node").startswith("{")).select(*keys, path.alias("path"), "node")
    while True:
        entries = level.select(*keys, "path", _entries("node", name, mark).alias("e"))
        end = F.array_min(F.transform(F.filter("e", lambda x: x["ends"]), lambda x: x["place"]))
        entries = entries.withColumn("end", end).select(*keys, "path", F.explode(F.filter("e", lambda x: F.col("end").isNull() | (x["place"] <= F.col("end")))).alias("x"))
        entries = stored(entries.where("x.found OR x.wraps").select(*keys, F.concat("path", F.array("x.place")).alias("path"), "x.text", "x.found"), "entries")
        found = found.unionByName(entries.where("found").select(*keys, "path", F.col("text").alias("list")))
        level = entries.where("NOT found").select(*keys, "path", F.col("text").alias("node"))
        if not level.take(1):
            break
    rows = found.select(*keys, "path", F.from_json("list", f"array<{row_type}>").alias("rows")).where(F.size("rows") > 0)
    first = rows.groupBy(*keys).agg(F.min_by("rows", "path").alias("rows"))
    return first.select(*keys, F.explode("rows").alias("row")).where("row IS NOT NULL")
