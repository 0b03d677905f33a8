"""A small training run end to end."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.plans import attendance_model as model, tree_tables


@pytest.fixture(scope="module")
def facts(spark):
    r = random.Random(1)
    data = []
    for i in range(600):
        c, s, d = i % 6, i % 4, 1 + i % 28
        data.append((
            i, s, 20240100 + d, 81500, 101500, c, 30 + s, 8, 1, "Winter", "Course" if c else None, f"P{s}", 1 + c % 3, False, c == 1, False,
            1 + (d - 1) % 7, 6, 0.05 + 0.1 * c + r.random() / 50,
        ))
    return spark.createDataFrame(data, (
        "LectureID bigint, SubgroupKey bigint, DateKey int, FromTimeKey int, UntilTimeKey int, ClassKey bigint, TotalStudents bigint, Hour int,"
        " Month int, Season string, ActivityDomain string, ProgramName string, ClassProgramStage int, IsExam boolean, IsPractical boolean,"
        " IsDigitalPossible boolean, Weekday int, ClassCredits int, AttendanceRate double"
    ))


def test_training_run(spark, facts):
    rows = model.features(facts, facts.select("ClassKey"))
    assert rows.count() == 600
    assert set(model.LEAKS).isdisjoint([*model.NUMERIC, *model.CATEGORICAL])
    assert "LectureID" in model.unused_columns(rows)
    train, test = model.split_by_time(rows)
    assert train.count() + test.count() == 600
    assert train.agg(F.max("DateKey")).first()[0] < test.agg(F.min("DateKey")).first()[0]
    fitted = model.train(train, model.random_forest(trees=20, depth=5))
    scored = model.predict(fitted, test.withColumn("Season", F.lit("Fall")))
    result = model.evaluate(scored).first()
    assert result.R2 > 0.8 and result.RMSE < 0.1
    names = model.feature_names(fitted)
    assert len(names) == fitted.stages[-1].featureImportances.size
    top = model.importances(fitted, 5).collect()
    assert len(top) == 5 and top[0].Importance >= top[-1].Importance
    boosted = model.train(train, model.boosted_trees(rounds=5, depth=3))
    assert model.evaluate(model.predict(boosted, test)).first().R2 > 0.5


def test_chronological_order_is_an_option(facts):
    by_date = model.features(facts, facts.select("ClassKey"), chronological=True)
    first = by_date.where("DateKey = 20240101").orderBy("LectureID").first()
    assert first.avg_attendance_weekday is None


@pytest.mark.parametrize("boosted", [False, True])
def test_nodes_walked_in_sql(spark, facts, tmp_path, boosted):
    """Scores from the table of nodes: in another engine by a recursive query, in Spark level by level."""
    import duckdb

    rows = model.features(facts, facts.select("ClassKey"))
    train, test = model.split_by_time(rows)
    fitted = model.train(train, model.boosted_trees(rounds=6, depth=4) if boosted else model.random_forest(trees=7, depth=6))
    nodes = tree_tables.tree_nodes(fitted)
    known = {r.LectureID: r.Predicted for r in model.predict(fitted, test).collect()}
    nodes.write.parquet(str(tmp_path / "nodes"))
    tree_tables.input_cells(fitted, test, "LectureID").write.parquet(str(tmp_path / "cells"))
    con = duckdb.connect()
    for name in ("nodes", "cells"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    other = dict(con.execute(tree_tables.WALK_SQL).fetchall())
    walked = {r.LectureID: r.Score for r in tree_tables.walked(nodes, fitted, test, ["LectureID"]).collect()}
    assert known.keys() == other.keys() == walked.keys()
    assert all(abs(known[i] - other[i]) < 1e-9 and abs(known[i] - walked[i]) < 1e-9 for i in known)
    roots = con.execute("SELECT count(*), count(DISTINCT Tree) FROM nodes WHERE Node = 0").fetchone()
    assert roots == (len(fitted.stages[-1].treeWeights),) * 2
    # every node but the roots has one parent
    assert con.execute("""SELECT count(*) FROM nodes n WHERE Node > 0 AND 1 <> (
        SELECT count(*) FROM nodes p WHERE p.Tree = n.Tree AND (p.LeftNode = n.Node OR p.RightNode = n.Node))""").fetchone() == (0,)


def test_importances_follow_from_nodes(spark, facts):
    rows = model.features(facts, facts.select("ClassKey"))
    fitted = model.train(rows, model.random_forest(trees=9, depth=5))
    known = {r.Feature: r.Importance for r in model.importances(fitted, top=1000).collect()}
    found = {r.Feature: r.Importance for r in tree_tables.gains(tree_tables.tree_nodes(fitted), fitted).collect()}
    assert known.keys() == found.keys() and all(abs(known[k] - found[k]) < 1e-9 for k in known)


def test_walks_stay_inside_the_row(spark, facts):
    """No row is joined, exploded or grouped for a tree or a level, and no saved table holds more than one tree."""
    rows = model.features(facts, facts.select("ClassKey"))
    train, test = model.split_by_time(rows)
    fitted = model.train(train, model.random_forest(trees=3, depth=4))
    nodes = tree_tables.tree_nodes(fitted)
    assert nodes.select("Tree", F.input_file_name().alias("f")).groupBy("f").agg(F.count_distinct("Tree").alias("n")).agg(F.max("n")).first()[0] == 1
    stored = test.localCheckpoint()
    plan = tree_tables.walked(nodes, fitted, stored, ["LectureID"])._jdf.queryExecution().optimizedPlan().toString()
    # lines with a colon belong to the subquery
    own = [line for line in plan.splitlines() if not line.lstrip().startswith(":")]
    assert not any(word in line for line in own for word in ("Join", "Generate", "Aggregate [")), plan
