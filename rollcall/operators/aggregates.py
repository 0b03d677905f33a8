"""Grouped statistics and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.windows import in_ranges, running_before
from rollcall.session import stored


def percentiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Exact percentiles per group with linear interpolation: the keys and a column per wanted (column, share).

    Equal values are counted first.  The distinct (group, column, value) are sorted in ranges and
    numbered by running counts, and each percentile picks the values at the two ranks around
    it, so no task holds the values of a group, whatever their number.  Groups without any
    value are absent; a column without any value is null.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    names = [f"_k{i}" for i in range(len(keys))]
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    values = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], stacked.alias("_x"))
    values = values.select(*names, F.col("_x.column").alias("_column"), F.col("_x.value").alias("_value")).where("_value IS NOT NULL")
    counted = values.groupBy(*names, "_column", "_value").agg(F.count(F.lit(1)).alias("_times"))
    group = [*names, "_column"]
    ranked = running_before(in_ranges(counted, [*group, "_value"], "values"), group, ["_value"], "_times", "_before", "_size")

    def at(column: str, share: float) -> Column:
        rank = F.lit(share) * (F.col("_size") - 1)
        pick = lambda r: F.max(F.when((F.col("_column") == column) & (F.col("_before") <= r) & (r < F.col("_before") + F.col("_times")), F.col("_value")))
        low, high = pick(F.floor(rank)), pick(F.ceil(rank))
        part = F.max(F.when(F.col("_column") == column, rank - F.floor(rank)))
        return low + (high - low) * part

    picked = ranked.groupBy(*names).agg(*[at(c, p).alias(n) for n, (c, p) in wanted.items()])
    return picked.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], *wanted)


def with_percentiles(stats: DataFrame, df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Grouped statistics with percentiles of the same groups; null where a group has no values."""
    if not keys:  # one row on either side
        one = with_percentiles(stats.withColumn("_all", F.lit(1)), df.withColumn("_all", F.lit(1)), ["_all"], wanted)
        return one.drop("_all")
    found = percentiles(df, keys, wanted).select(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)], *wanted)
    same = reduce(lambda a, b: a & b, [stats[k].eqNullSafe(found[f"_p{i}"]) for i, k in enumerate(keys)])
    return stats.join(found, same, "left").drop(*[f"_p{i}" for i in range(len(keys))])


def quantile(c: str | Column, p: float) -> Column:
    """Percentile as an aggregate, for groups of bounded size such as the weeks of a slot; else see ``percentiles``."""
    return F.percentile((F.col(c) if isinstance(c, str) else c).cast("double"), F.lit(p))


def describe(df: DataFrame, value: str, percentiles: list[float] | None = None, keys: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, the percentiles, max."""
    ps = percentiles or [0.25, 0.5, 0.75]
    keys = keys or []
    c = F.col(value).cast("double")
    stats = df.groupBy(*keys).agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )
    named = {f"p{p * 100:g}".replace(".", "_"): (value, p) for p in ps}
    return with_percentiles(stats, df, keys, named).select(*keys, "count", "mean", "std", "min", *named, "max")


_SHARES = {"Percentile10": 0.1, "Quartile1": 0.25, "MedianAttendanceRate": 0.5, "Quartile3": 0.75, "Percentile90": 0.9}


def _rate_block(rate: str) -> dict[str, Column]:
    r = F.col(rate)
    return {
        "ValidAttendanceRates": F.count(r),
        "MeanAttendanceRate": F.avg(r),
        "StandardDeviation": F.stddev_samp(r),
        "Variance": F.var_samp(r),
        "Minimum": F.min(r),
        "Maximum": F.max(r),
    }


def _rate_columns() -> dict[str, Column]:
    usable = (F.col("ValidAttendanceRates") > 1) & (F.col("MeanAttendanceRate") != 0)
    return {
        "InterquartileRange": F.col("Quartile3") - F.col("Quartile1"),
        "CoefficientOfVariation": F.when(usable, F.col("StandardDeviation") / F.col("MeanAttendanceRate")),
    }


def session_metrics(
    df: DataFrame,
    keys: list[str],
    session: str = "SessionID",
    expected: str = "ExpectedStudents",
    present: str = "PresentStudents",
    rate: str = "AttendanceRate",
) -> DataFrame:
    """The metric block per group of sessions; rows must be one per session.

    Sums and percentiles read the rows, which are stored first, with the columns that they need.
    """
    df = stored(df.select(*dict.fromkeys([*keys, session, expected, present, rate])), "metrics")
    grouped = df.groupBy(*keys).agg(
        F.count(session).alias("SessionCount"),
        F.sum(expected).alias("ExpectedStudentsSum"),
        F.sum(present).alias("PresentStudentsSum"),
        F.avg(expected).alias("MeanExpectedStudents"),
        F.avg(present).alias("MeanPresentStudents"),
        *[c.alias(n) for n, c in _rate_block(rate).items()],
    )
    medians = {"MedianExpectedStudents": (expected, 0.5), "MedianPresentStudents": (present, 0.5)}
    ranked = with_percentiles(grouped, df, keys, medians | {n: (rate, p) for n, p in _SHARES.items()})
    whole = F.col("ExpectedStudentsSum")
    return ranked.withColumns({"WeightedAttendanceRate": F.when(whole > 0, F.col("PresentStudentsSum") / whole), **_rate_columns()})


def lesson_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """The block at lecture grain; sums stay null when every value is null.  Rows are stored as in ``session_metrics``."""
    df = stored(df.select(*dict.fromkeys([*keys, "TotalStudents", "UserCount", "AttendanceRate"])), "metrics")
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("LessonCount"),
        F.sum("TotalStudents").alias("TotalStudentsSum"),
        F.sum("UserCount").alias("UserCountSum"),
        F.avg("TotalStudents").alias("MeanStudents"),
        F.avg("UserCount").alias("MeanPresent"),
        *[c.alias(n) for n, c in _rate_block("AttendanceRate").items()],
    )
    ranked = with_percentiles(grouped, df, keys, {n: ("AttendanceRate", p) for n, p in _SHARES.items()})
    whole = F.col("TotalStudentsSum")
    return ranked.withColumns({"WeightedAttendanceRate": F.when(whole > 0, F.col("UserCountSum") / whole), **_rate_columns()})


def value_counts(df: DataFrame, columns: list[str], keep_null: bool = True, out: str = "Rows") -> DataFrame:
    rows = df if keep_null else df.dropna(subset=columns)
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(out))


def distinct_list(c: str | Column, sep: str = ", ") -> Column:
    """Sorted distinct texts of a group, joined.  For columns of dimension codes only."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.array_join(F.array_sort(F.collect_set(text)), sep)


def distinct_texts(df: DataFrame, keys: list[str], value: str, count: str, out: str, sep: str = ", ") -> DataFrame:
    """Per key the number of distinct non-null values and their sorted texts, joined; keys without any are absent.

    For groups of any size, where ``distinct_list`` holds a group in one buffer: the distinct (key, value)
    rows are sorted in ranges, each range joins its own texts of a key, and only these parts are put together,
    in the order of the ranges.
    """
    listed = df.select(*keys, F.col(value).cast("string").alias("_text")).where("_text IS NOT NULL").distinct()
    ranged = in_ranges(listed, [*keys, "_text"], "texts")
    parts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.array_join(F.array_sort(F.collect_list("_text")), sep).alias("_part"))
    ordered = F.array_sort(F.collect_list(F.struct("_range", "_part")))
    return parts.groupBy(*keys).agg(F.sum("_n").alias(count), F.array_join(F.transform(ordered, lambda p: p["_part"]), sep).alias(out))


def share(predicate: Column) -> Column:
    return F.avg(predicate.cast("double"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with its number of nulls, in one pass."""
    names = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return unpivot_row(wide, names, "Column", "Nulls")


def unpivot_row(wide: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """Rows (label, value) from the columns of a one-row frame."""
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names]))
    )


def labelled_counts(df: DataFrame, checks: dict[str, Column], label: str = "Check", value: str = "Rows") -> DataFrame:
    """One labelled count per condition, all in one pass; a null condition counts as no."""
    wide = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(n) for n, cond in checks.items()])
    return unpivot_row(wide, list(checks), label, value)


def profile(df: DataFrame, column: str, value: str = "AttendanceRate") -> DataFrame:
    """mean, median and count of a value per group; groups with a null key are left out."""
    c = F.col(value).cast("double")
    rows = df.where(F.col(column).isNotNull())
    stats = rows.groupBy(column).agg(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.count(c).alias("count"))
    return with_percentiles(stats, rows, [column], {"median": (value, 0.5)}).select(column, "mean", "median", "std", "count")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the top edge is in the last bin.

    The bounds are a scalar subquery.  Values are counted first, so the bins are
    assigned to distinct values and not to rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # the sum makes the counts of the subquery the same exchange as the counts below
    edges = F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"), F.sum("_n").alias("rows"))
    bounds = counts.agg(edges.alias("e")).select("e").scalar()
    placed = counts.withColumn("_e", bounds).withColumns({"_low": F.col("_e.low"), "_high": F.col("_e.high")})
    width = (F.col("_high") - F.col("_low")) / bins
    bin_no = F.when(F.col("_high") > F.col("_low"), F.floor((F.col("_v") - F.col("_low")) / width)).otherwise(0)
    placed = placed.withColumn("Bin", F.least(bin_no, F.lit(bins - 1)).cast("int"))
    return placed.groupBy("Bin").agg(
        F.sum("_n").alias("Rows"),
        F.min(F.col("_low") + F.col("Bin") * width).alias("LowerEdge"),
    )


def box_plot(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Quartiles, mean, whiskers at 1.5 IQR, number of outliers per group."""
    on = keys or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(1))
    counts = rows.where(F.col(value).isNotNull()).groupBy(*on, F.col(value).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    quartiles = percentiles(rows, on, {"Quartile1": (value, 0.25), "Median": (value, 0.5), "Quartile3": (value, 0.75)})
    reach = 1.5 * (F.col("Quartile3") - F.col("Quartile1"))
    inside = F.col("_v").between(F.col("Quartile1") - reach, F.col("Quartile3") + reach)
    return counts.join(quartiles, on).groupBy(*on, "Quartile1", "Median", "Quartile3").agg(
        F.sum("_n").alias("Rows"),
        (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("Mean"),
        F.min(F.when(inside, F.col("_v"))).alias("WhiskerLow"),
        F.max(F.when(inside, F.col("_v"))).alias("WhiskerHigh"),
        F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("Outliers"),
    ).drop("_all")


def contrast(df: DataFrame, key: str, left: str, right: str, metrics: dict[str, str], names: tuple[str, str, str]) -> DataFrame:
    """Metric rows against two groups and their difference."""
    long = df.where(F.col(key).isin(left, right)).select(
        key,
        F.inline(F.array(*[
            F.struct(F.lit(label).alias("Metric"), F.col(c).cast("double").alias("_value"))
            for label, c in metrics.items()
        ])),
    )
    wide = long.groupBy("Metric").agg(
        F.max(F.when(F.col(key) == left, F.col("_value"))).alias(names[0]),
        F.max(F.when(F.col(key) == right, F.col("_value"))).alias(names[1]),
    )
    return wide.withColumn(names[2], F.col(names[0]) - F.col(names[1]))


def weekly_mean(df: DataFrame, day: str, value: str) -> DataFrame:
    """Mean per week ending on Sunday; weeks without rows appear with a null mean."""
    from rollcall.functions.clock import week_sunday

    means = df.groupBy(week_sunday(day).alias("WeekEnd")).agg(F.avg(value).alias("Mean"))
    bounds = means.agg(F.min("WeekEnd").alias("a"), F.max("WeekEnd").alias("b"))
    spine = bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("WeekEnd"))
    return spine.join(means, "WeekEnd", "left")
