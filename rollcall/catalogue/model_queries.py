"""Attendance prediction.  Trained models have no SQL; everything around them has."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rollcall.catalogue.registry import query
from rollcall.catalogue.views import CTES, r9
from rollcall.plans import attendance_model as model, slots, tree_tables
from rollcall.session import stored

_LAG = "avg(AttendanceRate) OVER (PARTITION BY {g} ORDER BY ClassKey, DateKey, FromTimeKey, LectureID, SubgroupKey ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
CTES.setdefault("features", f"""
SELECT *, FromHour AS Hour, CAST(120 AS INTEGER) AS LectureLength, {_LAG.format(g='ClassKey', n=5)} AS avg_attendance_class_5,
  {_LAG.format(g='SubgroupKey', n=5)} AS avg_attendance_subgroup_5, {_LAG.format(g='Weekday', n=10)} AS avg_attendance_weekday
FROM facts_wide WHERE AttendanceRate <> 0 AND ClassName NOT LIKE '%widget%' AND ClassName NOT LIKE '%gizmo%' AND ClassName NOT LIKE '%anvil%'""")
_COLUMNS = ", ".join(
    f"{r9(c)} AS {c}" if c.startswith("avg") or c == model.TARGET else c
    for c in [*model.NUMERIC, *model.CATEGORICAL, model.TARGET]
)


def features(v):
    regular = v.regular_titles.withColumnRenamed("NormalizedClassName", "ClassName")
    classes = v.classes.join(regular, "ClassName", "left_semi")
    return model.features(v.facts_wide.withColumnRenamed("FromHour", "Hour"), classes)


@query("ml_01_features", f"SELECT LectureID, SubgroupKey, {_COLUMNS} FROM features")
def ml_01(v):
    return features(v).select("LectureID", "SubgroupKey", *model.NUMERIC, *model.CATEGORICAL, model.TARGET)


@query("ml_02_model_columns", f"SELECT {_COLUMNS} FROM features")
def ml_02(v):
    return model.model_columns(features(v))


@query("ml_03_time_split", """
WITH c AS (SELECT quantile_cont(CAST(epoch(CAST(FullDate AS TIMESTAMP)) AS DOUBLE), 0.8) AS cut FROM features)
SELECT epoch(CAST(FullDate AS TIMESTAMP)) <= cut AS Train, count(*) AS Rows, min(DateKey) AS FirstDate, max(DateKey) AS LastDate FROM features, c GROUP BY 1""")
def ml_03(v):
    train, test = model.split_by_time(stored_features(v))
    part = lambda df, flag: df.agg(
        F.lit(flag).alias("Train"), F.count(F.lit(1)).alias("Rows"), F.min("DateKey").alias("FirstDate"), F.max("DateKey").alias("LastDate")
    )
    return part(train, True).unionByName(part(test, False))


def _scaled_sql(c: str) -> str:
    filled = f"coalesce(CAST({c} AS DOUBLE), avg({c}) OVER ())"
    return f"({filled} - avg({c}) OVER ()) / m_{c}"


CTES.setdefault("feature_spread", "SELECT " + ", ".join(
    f"sqrt(sum((coalesce(CAST({c} AS DOUBLE), a_{c}) - a_{c}) ** 2) / (count(*) - 1)) AS m_{c}" for c in model.NUMERIC
) + " FROM features, (SELECT " + ", ".join(f"avg({c}) AS a_{c}" for c in model.NUMERIC) + " FROM features)")


@query("ml_04_scaled_inputs", "SELECT LectureID, SubgroupKey, " + ", ".join(
    f"{r9('CASE WHEN m_' + c + ' > 0 THEN ' + _scaled_sql(c) + ' ELSE 0.0 END')} AS {c}" for c in model.NUMERIC
) + " FROM features, feature_spread")
def ml_04(v):
    rows = stored_features(v)
    prepared = model.preparation(rows).transform(model.as_inputs(rows))
    values = vector_to_array("scaled")
    return prepared.select(
        "LectureID", "SubgroupKey", *[(values[i] + 0.0).alias(c) for i, c in enumerate(model.NUMERIC)]
    )


def stored_features(v):
    """Features as a table: every stage of a training run reads them again."""
    return stored(features(v), "features")


def _scored(v, estimator):
    train, test = model.split_by_time(stored_features(v))
    return model.predict(model.train(train, estimator), test)


@query("ml_05_random_forest")
def ml_05(v):
    return _scored(v, model.random_forest()).select("LectureID", "SubgroupKey", "Predicted", "PredictedUserCount")


@query("ml_06_boosted_trees")
def ml_06(v):
    return _scored(v, model.boosted_trees()).select("LectureID", "SubgroupKey", "Predicted", "PredictedUserCount")


CTES.setdefault("feature_cut", "SELECT quantile_cont(CAST(epoch(CAST(FullDate AS TIMESTAMP)) AS DOUBLE), 0.8) AS cut FROM features")
_TEST_ROWS = "SELECT LectureID, SubgroupKey, true AS InRange FROM features, feature_cut WHERE epoch(CAST(FullDate AS TIMESTAMP)) > cut"


@query("ml_05_forest_in_range", _TEST_ROWS)
def ml_05_range(v):
    """Every test row has a prediction, and a mean of training targets can't leave their range."""
    train, test = model.split_by_time(stored_features(v))
    edges = train.agg(F.struct(F.min(model.TARGET).alias("low"), F.max(model.TARGET).alias("high")).alias("e")).select("e").scalar()
    scored = model.predict(model.train(train, model.random_forest()), test).withColumn("_e", edges)
    return scored.select("LectureID", "SubgroupKey", F.col("Predicted").between(F.col("_e.low") - 1e-9, F.col("_e.high") + 1e-9).alias("InRange"))


def _beats_the_mean(v, estimator):
    train, _ = model.split_by_time(stored_features(v))
    mean = train.agg(F.avg(model.TARGET).alias("m")).select("m").scalar()
    scored = model.predict(model.train(train, estimator), train).withColumn("_m", mean)
    square = lambda c: F.sum((F.col(model.TARGET) - F.col(c)) ** 2)
    return scored.agg(F.count("Predicted").alias("Rows"), (square("Predicted") <= square("_m")).alias("BetterThanMean"))


_TRAIN_ROWS = "SELECT count(*) AS Rows, true AS BetterThanMean FROM features, feature_cut WHERE epoch(CAST(FullDate AS TIMESTAMP)) <= cut"


@query("ml_05_forest_beats_mean", _TRAIN_ROWS)
def ml_05_mean(v):
    return _beats_the_mean(v, model.random_forest())


@query("ml_06_boosted_beats_mean", _TRAIN_ROWS)
def ml_06_mean(v):
    return _beats_the_mean(v, model.boosted_trees())


@query("ml_09_importances_add_up", "SELECT true AS AddUp, true AS NoneNegative, true AS InOrder")
def ml_09_sum(v):
    train, _ = model.split_by_time(stored_features(v))
    top = model.importances(model.train(train, model.random_forest()), top=10_000)
    order = F.collect_list("Importance")
    return top.agg((F.abs(F.sum("Importance") - 1) < 1e-6).alias("AddUp"), (F.min("Importance") >= 0).alias("NoneNegative"),
                   (F.reverse(F.array_sort(order)) == order).alias("InOrder"))


def _walk_agrees(v, estimator):
    """The score of the fitted model and that of a walk through the table of its nodes."""
    train, test = model.split_by_time(stored_features(v))
    fitted = model.train(train, estimator)
    keys = ["LectureID", "SubgroupKey"]
    walked = tree_tables.walked(tree_tables.tree_nodes(fitted), fitted, test, keys)
    scored = model.predict(fitted, test).select(*keys, "Predicted")
    return scored.join(walked, keys, "left").select(*keys, F.coalesce(F.abs(F.col("Predicted") - F.col("Score")) < 1e-9, F.lit(False)).alias("Same"))


_SAME_ROWS = _TEST_ROWS.replace("InRange", "Same")


@query("ml_05_forest_walk", _SAME_ROWS)
def ml_05_walk(v):
    return _walk_agrees(v, model.random_forest())


@query("ml_06_boosted_walk", _SAME_ROWS)
def ml_06_walk(v):
    return _walk_agrees(v, model.boosted_trees(rounds=20))


_TRAIN_FEATURES = "(SELECT * FROM features, feature_cut WHERE epoch(CAST(FullDate AS TIMESTAMP)) <= cut)"


@query("ml_09_importance_of_nodes", " UNION ALL ".join(
    [f"SELECT '{c}' AS Feature, true AS Same" for c in model.NUMERIC]
    + [f"SELECT DISTINCT '{c}_' || CAST({c} AS VARCHAR), true FROM {_TRAIN_FEATURES} WHERE {c} IS NOT NULL" for c in model.CATEGORICAL]))
def ml_09_nodes(v):
    """Every input's importance follows from the gains of the nodes that split on it."""
    train, _ = model.split_by_time(stored_features(v))
    fitted = model.train(train, model.random_forest())
    known = model.importances(fitted, top=10_000).withColumnRenamed("Importance", "Known")
    both = tree_tables.gains(tree_tables.tree_nodes(fitted), fitted).join(known, "Feature", "left")
    return both.select("Feature", F.coalesce(F.abs(F.col("Importance") - F.col("Known")) < 1e-9, F.lit(False)).alias("Same"))


@query("ml_07_predicted_users", f"SELECT LectureID, SubgroupKey, {r9('avg_attendance_subgroup_5 * TotalStudents')} AS PredictedUserCount FROM features")
def ml_07(v):
    # the lagged mean of the subgroup as the predicted rate
    return features(v).select(
        "LectureID", "SubgroupKey", (F.col("avg_attendance_subgroup_5") * F.col("TotalStudents")).alias("PredictedUserCount")
    )


@query("ml_08_evaluation", f"""
SELECT count(*) AS Rows, {r9('sqrt(avg((y - p) ** 2))')} AS RMSE, {r9('avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16))')} AS MAPE, {r9('1 - avg((y - p) ** 2) / var_pop(y)')} AS R2
FROM (SELECT AttendanceRate AS y, avg_attendance_subgroup_5 AS p FROM features) WHERE p IS NOT NULL""")
def ml_08(v):
    return model.evaluate(features(v), prediction="avg_attendance_subgroup_5")


@query("ml_09_feature_importance")
def ml_09(v):
    train, _ = model.split_by_time(stored_features(v))
    return model.importances(model.train(train, model.random_forest()))


@query("ml_10_naive_against_corrected", f"""
SELECT 'Naive' AS View, {r9('avg(AttendanceRate)')} AS Mean, {r9('quantile_cont(AttendanceRate, 0.5)')} AS Median, count(AttendanceRate) AS Rows FROM facts_wide WHERE ClassName LIKE '%widget%' OR ClassName LIKE '%gizmo%'
UNION ALL SELECT 'Corrected', {r9('avg(AttendanceRate)')}, {r9('quantile_cont(AttendanceRate, 0.5)')}, count(AttendanceRate) FROM lab_results""")
def ml_10(v):
    group = v.group_titles.withColumnRenamed("NormalizedClassName", "ClassName")
    naive = v.facts_wide.join(group, "ClassName", "left_semi")
    corrected = slots.corrected_attendance(v.lab_sessions, v.lab_presence, v.lab_assigned)
    return model.naive_against_corrected(naive, corrected)
