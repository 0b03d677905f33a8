"""Loads of users, bridge, wifi connections and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions import clock, text
from rollcall.operators.columns import require, to_number
from rollcall.operators.dedupe import keep_one
from rollcall.operators.joins import only_new
from rollcall.operators.windows import number_rows

USER_NAME_WIDTH = 70
NETWORK = "eduroam"
# --- fixed values: words of the course catalogue -----------------------------------
STAGE_WORD = "trajectschijf"
CREDIT_WORDS = ["studiepunten", "studiepunt"]
SECOND_CHANCE = {"wel mogelijk.": True, "niet mogelijk.": False}
# --- fixed values: columns of the room table ----------------------------------------
ROOM_COLUMNS = ["RoomKey", "Building", "RoomFloor", "Code", "RoomName", "Category", "Capacity", "Area"]
# -------------------------------------------------------------------------------------


# --- users and bridge ----------------------------------------------------------------


def student_links(students: DataFrame, name: str = "EMAIL", subgroup: str = "SUBGROEPID") -> DataFrame:
    """Distinct (UserName, SubgroupKey) with a trimmed name and a numeric subgroup."""
    rows = students.select(
        F.substring(text.strip(name), 1, USER_NAME_WIDTH).alias("UserName"), F.col(subgroup).alias("SubgroupKey")
    ).dropna()
    return to_number(rows, ["SubgroupKey"]).dropna().where("UserName <> ''").distinct()


def new_users(names: DataFrame, users: DataFrame, ranges: int | None = None) -> DataFrame:
    """Users for names not known yet; keys continue after the highest one in use."""
    fresh = only_new(names.select("UserName").distinct(), users, ["UserName"])
    last = users.agg(F.coalesce(F.max("UserKey"), F.lit(0)).alias("m")).first()["m"]
    return number_rows(fresh, "UserName", "UserKey", start=last + 1, ranges=ranges).select("UserKey", "UserName")


def add_users(names: DataFrame, users: DataFrame, ranges: int | None = None) -> DataFrame:
    return users.select("UserKey", "UserName").unionByName(new_users(names, users, ranges))


def user_map(users: DataFrame) -> DataFrame:
    """One key per name; the lowest key of equal names counts."""
    return keep_one(users.select("UserName", "UserKey"), ["UserName"], ["UserKey"])


def add_bridge(links: DataFrame, users: DataFrame, bridge: DataFrame) -> DataFrame:
    keyed = links.join(user_map(users), "UserName").select("UserKey", "SubgroupKey").distinct()
    return bridge.unionByName(only_new(keyed, bridge, ["UserKey", "SubgroupKey"]))


def subgroups_per_user(links: DataFrame) -> DataFrame:
    """Sorted distinct subgroup ids per user; a user has few."""
    return links.groupBy("UserName").agg(F.array_sort(F.collect_set("SubgroupKey")).alias("Subgroups"))


# --- wifi ----------------------------------------------------------------------------


def wifi_points(
    feed: DataFrame,
    name: str = "username",
    step_seconds: int = 60,
    source_timezone: str | None = None,
    local_timezone: str = "Europe/Brussels",
    network: str = NETWORK,
    keep: list[str] | None = None,
) -> DataFrame:
    """(UserName, DateKey, TimeKey) of each connection to the campus network.

    With ``source_timezone='UTC'`` times are moved to local time first; without it the
    times are local already.  The date is taken after rounding.  No state, no shuffle:
    the same expression serves a table and a stream.
    """
    rows = feed.where((F.col("ssid") == network) & (F.length(name) > 0) & F.col("timestamp").isNotNull())
    ts = F.col("timestamp").cast("timestamp_ntz")
    if source_timezone:
        ts = F.convert_timezone(F.lit(source_timezone), F.lit(local_timezone), ts)
    day, time = clock.rounded_keys(ts, step_seconds)
    user = F.substring(F.col(name), 1, USER_NAME_WIDTH)
    return rows.select(user.alias("UserName"), day.alias("DateKey"), time.alias("TimeKey"), *(keep or []))


def wifi_rows(feed: DataFrame, **options) -> DataFrame:
    """Distinct connections, see ``wifi_points``."""
    return wifi_points(feed, **options).distinct()


def wifi_fact(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Connections of known users, one row per (date, time, user)."""
    return rows.join(user_map(users), "UserName").select("DateKey", "TimeKey", "UserKey").distinct()


def add_wifi(fact: DataFrame, rows: DataFrame, users: DataFrame) -> DataFrame:
    keys = ["DateKey", "TimeKey", "UserKey"]
    return fact.select(*keys).unionByName(only_new(wifi_fact(rows, users), fact, keys))


# --- dimensions ----------------------------------------------------------------------


def first_literal(c: str):
    """First item of a list literal such as ``['a', "b"]``, null when unreadable or empty."""
    return F.get(literal_list(c), F.lit(0))


# an item of a list literal: text in single or double quotes with escapes, a constant, a number
_ITEM = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|None|True|False|[-+0-9.eE]+"""
_LIST = rf"^\s*\[\s*(?:(?:{_ITEM})\s*(?:,\s*(?:{_ITEM})\s*)*+,?)?\s*\]\s*$"


def literal_list(c: str):
    """Array from a list literal; null when the cell is not one.

    Items are texts in single or double quotes with their escapes, numbers, True, False and
    None, which becomes a null item.  Other cells that begin like a list are tried as JSON.
    """
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    # two-digit escapes don't exist in JSON; four-digit ones do
    escaped = F.regexp_replace(F.col(c), r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    items = F.regexp_extract_all(escaped, F.lit(f"({_ITEM})"), 1)
    json = F.transform(items, lambda x: F.when(x == "None", "null").when(x.isin("True", "False"), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x))
    literal = F.from_json(F.concat(F.lit("["), F.array_join(json, ","), F.lit("]")), "array<string>", options)
    parsed = F.from_json(F.col(c), "array<string>", {"allowSingleQuotes": "true"})
    return F.when(F.col(c).rlike(_LIST), literal).when(F.trim(c).startswith("["), parsed)


def class_rows(courses: DataFrame, order: list[str]) -> DataFrame:
    """Class attributes, one row per code; the first row by ``order`` counts."""
    require(courses, ["title", "code", "credits", "faculties", "second_chance"], "course table")
    single = keep_one(courses, ["code"], order)
    stage = F.regexp_extract(first_literal("faculties"), rf"{STAGE_WORD} (\d+)", 1)
    return single.select(
        F.substring(F.col("title").cast("string"), 1, 150).alias("ClassName"),
        F.trim(F.col("code").cast("string")).try_cast("bigint").alias("ClassCode"),
        text.first_number(F.col("credits").cast("string")).alias("ClassCredits"),
        F.coalesce(text.value_map("second_chance", SECOND_CHANCE), F.lit(False)).alias("ClassSecondChance"),
        stage.try_cast("int").alias("ClassProgramStage"),
    )


def room_rows(rooms: DataFrame, prefix: str) -> DataFrame:
    """Rooms of a building that state a capacity."""
    require(rooms, ROOM_COLUMNS, "room table")
    cleaned = rooms.select(*[F.when(~F.col(c).isin("NULL", ""), F.col(c)).alias(c) for c in ROOM_COLUMNS])
    named = cleaned.where(F.coalesce(F.col("RoomName").startswith(prefix), F.lit(False)))
    typed = to_number(to_number(named, ["RoomKey"]), ["Building", "RoomFloor", "Capacity"], "int")
    return typed.withColumn(
        "Area", F.round(F.col("Area").try_cast("double"), 2).try_cast("decimal(10,2)")
    ).where("Capacity is not null")


def subgroup_rows(students: DataFrame, order: list[str]) -> DataFrame:
    """Subgroups with a numeric id; the programme is the code before the first slash."""
    numbered = to_number(students, ["SUBGROEPID"]).where("SUBGROEPID is not null")
    single = keep_one(numbered, ["SUBGROEPID"], order)
    return single.select(
        F.col("SUBGROEPID").alias("SubgroupKey"),
        F.substring("SUBGROEPCODE", 1, 50).alias("SubgroupCode"),
        F.substring(F.get(F.split("SUBGROEPCODE", "/"), F.lit(0)), 1, 50).alias("ProgramName"),
    )


# --- older paths ---------------------------------------------------------------------


def catalogue_rows(courses: DataFrame) -> DataFrame:
    """One row per course and faculty, stage split off, credits as a number."""
    exploded = courses.withColumn("faculties", F.explode_outer(literal_list("faculties")))
    split = text.split_pair(exploded, "faculties", "faculty", "program_stage", f", {STAGE_WORD} ")
    return split.withColumns({
        "credits": F.trim(text.plain_text("credits", *CREDIT_WORDS)).try_cast("int"),
        "second_chance": F.coalesce(text.value_map("second_chance", SECOND_CHANCE), F.lit(False)),
    })


def room_names(rooms: DataFrame, building: str, name: str, phrase: str) -> DataFrame:
    """Distinct room names of the buildings whose text holds the phrase; null holds nothing."""
    return rooms.where(F.coalesce(F.col(building).contains(phrase), F.lit(False))).select(name).distinct()


def unique_class_groups(schedule: DataFrame, column: str = "Classgroups") -> DataFrame:
    return text.explode_items(schedule.select(column), column, "Classgroup", keep_empty=False).select("Classgroup").distinct()
