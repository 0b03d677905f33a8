"""Quality rules: robust multivariate outliers by minimum covariance determinant."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.common import texts, words
from rollcall.session import stored

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20
#: statistics become whole numbers of 1 / UNIT, so that sums are exact in any order
UNIT = 256
#: share of a group that the estimate is made from
CORE = 0.75
#: steps end where no group's core changes, as a rule after five to ten; rounded distances could let one go round in circles
MOST_STEPS = 40
#: a table of so many groups at most (3 MB) is sent to the rows; with more of them it is joined
SENT_GROUPS = 10_000
#: so many documents of its own weigh as much in a group's centre and covariance as its language's, and in a language's as all documents'
SHRINK = 20
#: standard deviation of every statistic that all documents' covariance is drawn to by the same weight
BROAD = 1.0
#: chance of a clean vector to be rejected, were the transformed statistics normal
TAIL = 1e-9
#: name, expression, and the least standard deviation that counts: steps below it mean nothing
STATS = (
    ("word_length", lambda: F.log2((F.col("word_chars") + 1) / (F.col("n_words") + 1)), 0.15),
    ("symbols", lambda: 4 * F.sqrt(F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1))), 0.25),
    ("dup_lines", lambda: 2 * F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))), 0.25),
    ("repeats", lambda: 4 * F.sqrt(F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))), 0.25),
)
NAMES = [name for name, _, _ in STATS]
FLOORS = [floor for _, _, floor in STATS]
#: columns of a centre, of a covariance and of its diagonal
CENTRES = [f"m{i}" for i in range(len(STATS))]
SPREADS = [f"v{i}_{j}" for i in range(len(STATS)) for j in range(i + 1)]
DIAGONAL = [f"v{i}_{i}" for i in range(len(STATS))]


def repeat_words(hashes: Column, n: int = WINDOW) -> Column:
    """Words inside windows of ``n`` words that occur twice or more; ``hashes`` has a hash for each word.

    Windows are sorted by (hash, place), so repeats are neighbours; the places of repeated
    windows, sorted again, cover min(n, distance to the next) words each.
    """
    count = F.size(hashes) - (n - 1)
    window = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)])
    plain = F.transform(F.sequence(F.lit(0), count - 1), window)
    placed = F.array_sort(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(window(i).alias("h"), i.alias("i"))))

    def repeated(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        kept = F.filter(ordered, lambda x, k: same(x, F.get(ordered, k - 1)) | same(x, F.get(ordered, k + 1)))
        return F.array_sort(F.transform(kept, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(places, k + 1) - x, F.lit(n))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    # binding a value once: an array of one element, transformed, is worked out a single time
    once = lambda value, use: F.get(F.transform(F.array(value), use), 0)
    several = once(placed, lambda ordered: once(repeated(ordered), covered))
    distinct = once(plain, lambda w: F.size(F.array_distinct(w)))
    return F.when(count < 2, F.lit(0)).when(distinct == count, F.lit(0)).otherwise(several).cast("long")


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Base statistics of every whole text: ``n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words``."""
    rows = texts(docs, *keep)
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(*keep, words(F.col("text")).alias("words"), lines.alias("lines"),
                       F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return rows.select(*keep, F.size("words").cast("long").alias("n_words"),
                       F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.size("lines").cast("long").alias("n_lines"), repeat_words(F.col("hashes")).alias("n_repeat_words"))


def chi_square_quantile(p: float, freedom: int) -> float:
    """Quantile for an even number of degrees of freedom, where the tail is a finite sum."""
    tail = lambda x: math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > 1 - p else (low, middle)
    return high


def squared_distance(values: list[Column], mean: list[Column], factor: dict[tuple[int, int], Column]) -> Column:
    """Mahalanobis distance by forward substitution with the Cholesky factor (lower triangle)."""
    solved: list[Column] = []
    for i, x in enumerate(values):
        rest = reduce(lambda a, k: a - factor[i, k] * solved[k], range(i), x - mean[i])
        solved.append(rest / factor[i, i])
    return reduce(lambda a, b: a + b, [s * s for s in solved])


def moments(sums: DataFrame) -> DataFrame:
    """Means and covariance ``m*, v*`` from exact sums, with the floors added on the diagonal."""
    p, n = len(NAMES), F.col("n").cast("double")
    mean = lambda i: F.col(f"s{i}") / n / UNIT
    cell = lambda i, j: F.col(f"s{i}_{j}") / n / UNIT**2 - mean(i) * mean(j) + F.lit(FLOORS[i] ** 2 if i == j else 0.0)
    return sums.select("level", "group", *[mean(i).alias(f"m{i}") for i in range(p)],
                       *[cell(i, j).alias(f"v{i}_{j}") for i in range(p) for j in range(i + 1)])


def factored(shapes: DataFrame) -> DataFrame:
    """The Cholesky factor ``l*`` of the covariance in the place of ``v*``."""
    p, out = len(NAMES), shapes
    for i in range(p):
        for j in range(i + 1):
            c = reduce(lambda a, k: a - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}"), range(j), F.col(f"v{i}_{j}"))
            out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(c, F.lit(1e-6))) if i == j else c / F.col(f"l{j}_{j}"))
    return out.drop(*SPREADS)


def sums(rows: DataFrame) -> DataFrame:
    p = len(NAMES)
    columns = [F.count(F.lit(1)).alias("n")] + [F.sum(f"q{i}").alias(f"s{i}") for i in range(p)]
    columns += [F.sum((F.col(f"q{i}") * F.col(f"q{j}")).cast("decimal(19,0)")).cast("double").alias(f"s{i}_{j}") for i in range(p) for j in range(i + 1)]
    return rows.groupBy("level", "group").agg(*columns)


def with_groups(rows: DataFrame, table: DataFrame, groups: int) -> DataFrame:
    """Rows with their group's row of the table; its size, ``groups``, is known, so the rows of a group needn't meet."""
    return rows.join(F.broadcast(table) if groups <= SENT_GROUPS else table, ["level", "group"])


def measured(rows: DataFrame, shapes: DataFrame, groups: int) -> DataFrame:
    """Rows with ``d2``, the squared distance to their group's centre."""
    p = len(NAMES)
    d2 = squared_distance([F.col(f"q{i}") / UNIT for i in range(p)], [F.col(f"m{i}") for i in range(p)],
                          {(i, j): F.col(f"l{i}_{j}") for i in range(p) for j in range(i + 1)})
    joined = with_groups(rows, shapes, groups)
    # distances in steps of a 64th of an octave: the cut of a group needs a bounded number of counters
    return joined.withColumn("d2", d2).withColumn("step", F.floor(64 * F.log2(F.col("d2") + 1e-6)).cast("int"))


def estimate(rows: DataFrame, groups: int) -> DataFrame:
    """Centre and covariance of each of the ``groups`` groups: ``level, group, m*, v*``.

    Minimum covariance determinant by concentration steps: start from the centre of medians with
    median deviations, then again and again estimate mean and covariance from the core, the
    share of rows nearest to the last centre, until the cores stay the same.  All sums are exact whole numbers, medians and cuts
    come from bounded counters, and both combine before any shuffle, so a group may be any share of the table.
    """
    p = len(NAMES)
    medians = stored(rows.groupBy("level", "group").agg(*[F.percentile(f"q{i}", 0.5).alias(f"c{i}") for i in range(p)]), "mcd-medians")
    spread = with_groups(rows, medians, groups).groupBy("level", "group").agg(
        *[F.first(f"c{i}").alias(f"c{i}") for i in range(p)],
        *[F.percentile(F.abs(F.col(f"q{i}") - F.col(f"c{i}")), 0.5).alias(f"a{i}") for i in range(p)])
    scale = lambda i: F.sqrt((1.4826 * F.col(f"a{i}") / UNIT) ** 2 + FLOORS[i] ** 2)
    shapes = spread.select("level", "group", *[(F.col(f"c{i}") / UNIT).alias(f"m{i}") for i in range(p)],
                           *[(scale(i) if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i in range(p) for j in range(i + 1)])
    shapes, before = stored(shapes, "mcd-start"), None
    for _ in range(MOST_STEPS):
        near = measured(rows, shapes, groups)
        cut = stored(near.groupBy("level", "group").agg(F.percentile("step", CORE).alias("cut")), "mcd-cut")
        core = with_groups(near.drop(*[c for c in shapes.columns if c not in ("level", "group")]), cut, groups).where("step <= cut")
        found = stored(moments(sums(core)), "mcd-step")
        now = found.agg(F.bit_xor(F.xxhash64(*found.columns)), F.count(F.lit(1))).first()
        if now == before:
            break
        shapes, before = factored(found), now
    return found


def drawn(own: DataFrame, parents: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``own``, a row for each group with its ``weight``, with ``columns`` drawn to those of the parent named by ``key``."""
    above = parents.select(F.col("group").alias(key), *[F.col(c).alias(f"__{c}") for c in columns])
    rest = [c for c in own.columns if c not in columns]
    return own.join(above, key).select(*rest, *[(F.col("weight") * F.col(c) + (1 - F.col("weight")) * F.col(f"__{c}")).alias(c) for c in columns])


def judge(docs: DataFrame, tail: float = TAIL, shrink: int = SHRINK) -> DataFrame:
    """Statistics of every document and whether it is kept: ``doc_id, n_words, ..., base_failed, distance, kept``.

    ``base_failed``: fewer than ten words, or over 20% of the words in repeated windows.  The others are held
    against the robust centre and covariance of their language and source, drawn to those of the language,
    which are drawn to those of all documents, whose covariance is drawn to a broad one.  ``n`` such documents
    weigh n / (n + ``shrink``) each time, so verdicts change smoothly with a group's size.  Distances are scaled so that the core of a group reaches as far
    as it would under normal values (never less than its floors); a document is rejected beyond the
    distance that normal values pass with chance ``tail``, if it lies on the worse side:
    a vector without symbols, repeated lines or repeated windows beyond its group's is never rejected for that.

    Null texts have no words and fail the base rules.  Null languages and sources are groups of
    their own.  Equal rows get equal verdicts; rows with equal or null ids all stay; other columns go.
    """
    p = len(NAMES)
    base = statistics(docs, "doc_id", "lang", "source")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    base = base.withColumn("base_failed", failed)
    whole = [F.round(UNIT * F.least(F.greatest(expr(), F.lit(-40.0)), F.lit(40.0))).cast("long").alias(f"q{i}") for i, (_, expr, _) in enumerate(STATS)]
    base = stored(base.select("*", *whole), "statistics")
    passed = base.where(~F.col("base_failed"))
    group = lambda *names: F.to_json(F.struct(*names))
    keys = {0: group("lang", "source"), 1: group("lang"), 2: F.lit("all")}
    narrow = passed.select("lang", "source", *[f"q{i}" for i in range(p)])
    levels = [narrow.select(F.lit(k).alias("level"), own.alias("group"), *[f"q{i}" for i in range(p)]) for k, own in keys.items()]
    rows = reduce(DataFrame.unionByName, levels)
    # a row for each group of each level, with the group above it
    weight = lambda n: n / (n + shrink)
    counted = passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    tree = stored(reduce(DataFrame.unionByName, [
        counted.groupBy(F.lit(k).alias("level"), keys[k].alias("group"), keys[min(k + 1, 2)].alias("above")).agg(
            weight(F.sum("n")).alias("weight"), F.any_value("lang").alias("lang"), F.any_value("source").alias("source")) for k in keys]), "tree")
    groups = tree.count()
    found = tree.join(estimate(rows, groups), ["level", "group"])
    at = lambda table, k: table.where(F.col("level") == k)
    broad = [(F.col("weight") * F.col(c) + (1 - F.col("weight")) * F.lit(BROAD**2 if c in DIAGONAL else 0.0)).alias(c) for c in SPREADS]
    top = at(found, 2).select(*[c for c in found.columns if c not in SPREADS], *broad)
    middle = drawn(at(found, 1), top, "above", CENTRES + SPREADS)
    shapes = factored(reduce(DataFrame.unionByName, [top, middle, drawn(at(found, 0), middle, "above", CENTRES + SPREADS)]))
    shapes = stored(shapes, "mcd")
    normal = chi_square_quantile(CORE, p)
    plain = shapes.drop("above", "weight", "lang", "source")
    reach = stored(measured(rows, plain, groups).groupBy("level", "group").agg(F.pow(F.lit(2.0), F.percentile("step", CORE) / 64).alias("core")), "mcd-reach")
    cores = tree.join(reach, ["level", "group"])
    top = at(cores, 2).withColumn("core", F.col("weight") * F.col("core") + (1 - F.col("weight")) * F.lit(normal))
    middle = drawn(at(cores, 1), top, "above", ["core"])
    own = drawn(at(cores, 0), middle, "above", ["core"]).select("group", "core")
    own = stored(at(shapes, 0).join(own, "group").drop("level", "group", "above", "weight").withColumnsRenamed({"lang": "__lang", "source": "__source"}), "mcd-own")
    own = F.broadcast(own) if groups <= SENT_GROUPS else own
    far = base.join(own, base["lang"].eqNullSafe(own["__lang"]) & base["source"].eqNullSafe(own["__source"]), "left").drop("__lang", "__source")
    d2 = squared_distance([F.greatest(F.col(f"q{i}") / UNIT, F.col(f"m{i}")) if i else F.col("q0") / UNIT for i in range(p)],
                          [F.col(f"m{i}") for i in range(p)], {(i, j): F.col(f"l{i}_{j}") for i in range(p) for j in range(i + 1)})
    stretch = F.greatest(F.col("core") / normal, F.lit(1.0))
    distance = F.when(~F.col("base_failed"), F.sqrt(d2 / stretch))
    limit = math.sqrt(chi_square_quantile(1 - tail, p))
    return far.select("doc_id", *COLUMNS, distance.alias("distance"),
                      (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= limit)).alias("kept"))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def op7_quality_rules(docs: DataFrame) -> DataFrame:
    return judge(docs)
