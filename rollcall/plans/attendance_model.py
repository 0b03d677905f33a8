"""Features, training and evaluation of the attendance predictor."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions import clock
from rollcall.operators import aggregates
from rollcall.operators.windows import in_ranges, lagged_mean

# --- fixed values: inputs of the model -------------------------------------------------
NUMERIC = [
    "TotalStudents", "Hour", "Month", "LectureLength", "ClassCredits", "avg_attendance_class_5",
    "avg_attendance_subgroup_5", "avg_attendance_weekday",
]
CATEGORICAL = [
    "Weekday", "Season", "ActivityDomain", "ProgramName", "ClassProgramStage", "IsExam", "IsPractical",
    "IsDigitalPossible",
]
TARGET = "AttendanceRate"
# derived from the target or identifying one lecture, class, room or date
LEAKS = [
    "UserCount", "OccupancyRate", "LectureID", "DateKey", "ClassKey", "SubgroupKey", "RoomKey", "ActivityKey",
    "FromTimeKey", "UntilTimeKey", "FullDate", "ClassCode",
]
# -----------------------------------------------------------------------------------------

ROW = ["LectureID", "SubgroupKey"]
BY_CLASS = ["ClassKey", "DateKey", "FromTimeKey", *ROW]
BY_DATE = ["DateKey", "FromTimeKey", "ClassKey", *ROW]


def lagged_features(rows: DataFrame, chronological: bool = False, ranges: int | None = None) -> DataFrame:
    """Means of earlier rates per class (5), subgroup (5) and weekday (10).

    Rows are ordered by class first unless ``chronological`` is set, and the order ends with
    the key of the row.  There are only seven weekdays, so the table is written once in ranges
    of that order (``in_ranges``), from which all three means are taken.
    """
    order = BY_DATE if chronological else BY_CLASS
    ranged = in_ranges(rows, order, "lecture-ranges", ranges)
    out = lagged_mean(ranged, ["ClassKey"], order, TARGET, 5, "avg_attendance_class_5")
    out = lagged_mean(out, ["SubgroupKey"], order, TARGET, 5, "avg_attendance_subgroup_5", ranged)
    return lagged_mean(out, ["Weekday"], order, TARGET, 10, "avg_attendance_weekday", ranged).drop("_range")


def features(facts: DataFrame, non_group_classes: DataFrame, chronological: bool = False) -> DataFrame:
    """Finished lectures of non-group courses with somebody present: keys, inputs and target only."""
    needed = dict.fromkeys([*ROW, *BY_CLASS, "Weekday", TARGET, *[c for c in [*NUMERIC, *CATEGORICAL] if c in facts.columns]])
    times = [c for c in ("FromTimeKey", "UntilTimeKey") if c not in needed]
    kept = facts.select(*needed, *times).join(non_group_classes.select("ClassKey").distinct(), "ClassKey", "left_semi").where(
        F.col(TARGET) != 0
    )
    length = clock.minutes_between(clock.key_seconds("FromTimeKey"), clock.key_seconds("UntilTimeKey"))
    return lagged_features(kept, chronological).withColumn("LectureLength", length.cast("int"))


def model_columns(rows: DataFrame) -> DataFrame:
    """The allowed inputs and the target, nothing that leaks it."""
    return rows.select(*NUMERIC, *CATEGORICAL, TARGET)


def unused_columns(rows: DataFrame) -> list[str]:
    return sorted(set(rows.columns) - {*NUMERIC, *CATEGORICAL, TARGET})


def split_by_time(rows: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Earlier rows to train on, later rows to test on.

    The cut is the exact quantile of the dates, a scalar subquery over one counter per
    calendar day.
    """
    day = F.unix_date(clock.key_date("DateKey"))
    per_day = rows.groupBy(day.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    cut = per_day.agg(F.percentile("_d", F.lit(share), F.col("_n")).alias("c")).select("c").scalar()
    marked = rows.withColumn("_train", day <= cut)
    return marked.where("_train").drop("_train"), marked.where("not _train").drop("_train")


def _preparation(impute: bool = True) -> list:
    """Scaled numbers and one-hot categories; unknown categories become all zeros."""
    numbers = NUMERIC
    stages = []
    if impute:
        numbers = [f"{c}_filled" for c in NUMERIC]
        stages.append(Imputer(inputCols=NUMERIC, outputCols=numbers, strategy="mean"))
    indexed, encoded = [f"{c}_index" for c in CATEGORICAL], [f"{c}_hot" for c in CATEGORICAL]
    return [
        *stages,
        VectorAssembler(inputCols=numbers, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
    ]


def as_inputs(rows: DataFrame) -> DataFrame:
    """Numbers as doubles and categories as text, as the estimators expect."""
    return rows.withColumns({
        **{c: F.col(c).cast("double") for c in [*NUMERIC, TARGET]},
        **{c: F.col(c).cast("string") for c in CATEGORICAL},
    })


def preparation(rows: DataFrame) -> PipelineModel:
    return Pipeline(stages=_preparation()).fit(as_inputs(rows))


def random_forest(trees: int = 100, depth: int = 10, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=TARGET, numTrees=trees, maxDepth=depth, seed=seed, predictionCol="Predicted",
        # room for the statistics of many tree nodes per pass over the data
        maxMemoryInMB=1024,
    )


def boosted_trees(rounds: int = 200, rate: float = 0.1, depth: int = 6, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(
        labelCol=TARGET, maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed, predictionCol="Predicted",
        # the tree lineage is cut in the shared checkpoint folder, when one is set
        checkpointInterval=10,
    )


def train(rows: DataFrame, estimator) -> PipelineModel:
    return Pipeline(stages=[*_preparation(), estimator]).fit(as_inputs(rows))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the predicted rate and the head count it means."""
    scored = model.transform(as_inputs(rows))
    return scored.withColumn("PredictedUserCount", F.col("Predicted") * F.col("TotalStudents"))


def evaluate(scored: DataFrame, label: str = TARGET, prediction: str = "Predicted") -> DataFrame:
    """RMSE, mean absolute percentage error and R2 in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    # smallest denominator of the percentage error: the spacing of doubles at 1
    eps = F.lit(2.220446049250313e-16)
    sums = scored.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("Rows"),
        F.avg((y - p) * (y - p)).alias("_mse"),
        F.avg(F.abs(y - p) / F.greatest(F.abs(y), eps)).alias("MAPE"),
        F.var_pop(y).alias("_var"),
    )
    return sums.select(
        "Rows", F.sqrt("_mse").alias("RMSE"), "MAPE",
        F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var")).alias("R2"),
    )


def feature_names(model: PipelineModel) -> list[str]:
    """Input names in vector order, categories as name_value."""
    names = list(NUMERIC)
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    for column, labels in zip(CATEGORICAL, indexer.labelsArray):
        names += [f"{column}_{label}" for label in labels]
    return names


def importances(model: PipelineModel, top: int = 30) -> DataFrame:
    """Largest feature importances; as many rows as the model has inputs at most."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(feature_names(model), values)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "Feature string, Importance double").orderBy(
        F.desc("Importance"), "Feature"
    ).limit(top)


def naive_against_corrected(naive: DataFrame, corrected: DataFrame, rate: str = TARGET) -> DataFrame:
    """Mean, median and count of the stored and of the corrected rate."""
    def line(df: DataFrame, label: str) -> DataFrame:
        c: Column = F.col(rate).cast("double")
        stats = df.agg(F.avg(c).alias("Mean"), F.count(c).alias("Rows"))
        return aggregates.with_percentiles(stats, df, [], {"Median": (rate, 0.5)}).select(F.lit(label).alias("View"), "Mean", "Median", "Rows")

    return line(naive, "Naive").unionByName(line(corrected, "Corrected"))
