"""Readers and writers on hand-made files."""

import json

import pytest
from pyspark.sql import functions as F

from rollcall import schemas, session
from rollcall.plans import loads
from rollcall.sources import files, pages, sinks
from tests.conftest import rows


def test_export_lines(spark, tmp_path):
    head = "Id;Start;Rooms;Status"
    (tmp_path / "a.csv").write_text("﻿" + head + '\n1;x;R"1;ok\n2;y\n3;y;R;ok;te veel\n4;;R2;\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("Id,Status,Rooms\n5,open,R5\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text(head + "\n", encoding="utf-8")
    out = files.schedule_exports(spark, str(tmp_path), ["Id", "Start", "Rooms", "Status"])
    got = {r.Id: (r.Start, r.Rooms, r.Status, r.source_file) for r in out.collect()}
    assert got == {
        "1": ("x", 'R"1', "ok", "a.csv"), "2": ("y", None, None, "a.csv"), "4": (None, "R2", None, "a.csv"),
        "5": (None, "R5", "open", "b.csv"),
    }


@pytest.mark.parametrize("sep", [";", ",", "\t"])
def test_separator_is_found(spark, tmp_path, sep):
    (tmp_path / "x.csv").write_text(f"﻿ a {sep}b\n1{sep}2\n", encoding="utf-8")
    assert [r.asDict() for r in files.delimited(spark, str(tmp_path)).collect()] == [{"a": "1", "b": "2"}]


def test_files_of_a_folder_order_columns_differently(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k;n\nx;"1;1"\nlate\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("n,k\r\n2,y\r\n", encoding="utf-8")
    wide = ";".join(f"column_{i}" for i in range(1500))
    (tmp_path / "c.csv").write_text(wide + ";k\n" + ";" * 1500 + "z\n", encoding="utf-8")
    got = {r.k: r.n for r in files.delimited(spark, str(tmp_path)).select("k", "n").collect()}
    assert got == {"x": "1;1", "late": None, "y": "2", "z": None}


def test_list_literals(spark):
    cells = [r"['Bachelor\xa0TI, trajectschijf 2', 'b']", "['a', None]", "[]", "['it\\'s', \"x\", 3, True]", r"['\\x41', 'a, None, b']", "['a' 'b'", "text", None]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = {r.i: r.a for r in rows.select("i", loads.literal_list("c").alias("a")).collect()}
    assert got == {0: ["Bachelor\xa0TI, trajectschijf 2", "b"], 1: ["a", None], 2: [], 3: ["it's", "x", "3", "True"],
                   4: ["\\x41", "a, None, b"], 5: None, 6: None, 7: None}


def test_documents_in_three_shapes(spark, tmp_path):
    row = lambda n: {"SUBGROEPID": 1, "SUBGROEPCODE": "x", "DEELGROEPID": 2, "NAAM": "n", "EMAIL": n}
    shapes = [{"students": [row("a"), row("a")], "count": 2}, {"students": {"students": [row("b")], "count": 1}}, [row("c")],
              {"students": [], "count": 0}, {"students": [{"SUBGROEPID": 3}]}]
    for i, doc in enumerate(shapes):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=2))
    assert sorted(r.EMAIL for r in files.student_documents(spark, str(tmp_path)).collect()) == ["a", "a", "b", "c"]


COURSE = f"""<html><body><span id="{pages.YEAR_ID}"> 2025-26 </span><h2 id="{pages.TITLE_ID}">Web &amp; Data</h2>
<span id="{pages.CREDITS_ID}">6 studiepunten</span><u>Komt voor in:</u><ul><li>Bachelor TI, trajectschijf 1<div>weg</div></li><li>IC IT</li></ul>
<h4>Evaluatie</h4><table><tr><th>a</th></tr><tr><td>Binnen examenrooster</td><td>Schriftelijk examen</td><td>60</td></tr><tr><td>kort</td></tr></table>
<span>Tweede examenkans: </span><span>wel mogelijk.</span></body></html>"""


def test_course_page(spark):
    df = spark.createDataFrame([("http://x/y.aspx?a=193745&b=5", COURSE), ("http://x/z", "<html></html>")], "url string, html string")
    page, empty = pages.course_pages(df).collect()
    assert (page.year, page.title, page.code, page.credits, page.second_chance) == ("2025-26", "Web & Data", "193745", "6 studiepunten", "wel mogelijk.")
    assert page.faculties == ["Bachelor TI, trajectschijf 1", "IC IT"]
    assert [r.asDict() for r in page.evaluation_methods] == [{"moment": "Binnen examenrooster", "format": "Schriftelijk examen", "percentage": "60"}]
    assert (empty.title, empty.code, empty.faculties) == (None, None, [])


def test_private_columns_stay_inside(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "UserKey int, n int")
    with pytest.raises(ValueError, match="UserKey"):
        sinks.export_aggregates(df, ["UserKey", "n"], str(tmp_path / "a"))
    sinks.export_aggregates(df, ["UserKey", "n"], str(tmp_path / "b"), allow_private=True)
    sinks.export_aggregates(df, ["n"], str(tmp_path / "c"))


def test_split_write_loses_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, ok boolean")
    good, bad = sinks.split_write(df, F.col("ok"), str(tmp_path / "good"), str(tmp_path / "bad"))
    read = lambda p: sorted(r.i for r in spark.read.csv(p, sep=";", header=True).collect())
    assert (read(good), read(bad)) == (["1"], ["2", "3"])


def test_snapshot_replaces_its_own_batch_only(spark, tmp_path):
    one, two = spark.range(1), spark.range(5)
    sinks.snapshot(one, str(tmp_path), "a")
    sinks.snapshot(two, str(tmp_path), "b")
    sinks.snapshot(one, str(tmp_path), "b")
    assert rows(spark.read.parquet(str(tmp_path)).groupBy("batch").count()) == [("a", 1), ("b", 1)]


def test_scratch_folder_comes_from_the_cluster(spark):
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


class Cluster:
    """A session as a cluster's master would show it, with the settings given."""

    def __init__(self, spark, **settings):
        self.real, self.conf, self.settings = spark, self, {"spark.master": "spark://host:7077", "spark.checkpoint.dir": None, **settings}
        self.sparkContext, self.range, self.read, self.master = self, spark.range, spark.read, self.settings["spark.master"]
        self.applicationId = spark.sparkContext.applicationId
        self.defaultParallelism, self._jsc = spark.sparkContext.defaultParallelism, spark.sparkContext._jsc

    def get(self, key, *default):
        return self.settings[key] if key in self.settings else self.real.conf.get(key, *default)

    def getCheckpointDir(self):
        return self.settings.get("set")


def test_a_cluster_may_share_a_mounted_folder_or_the_warehouse(spark, tmp_path):
    mounted, warehouse = f"file://{tmp_path}/mounted", f"file:{tmp_path}/warehouse"
    assert session.scratch_root(Cluster(spark, **{"spark.checkpoint.dir": mounted + "/"})) == mounted
    assert session.scratch_root(Cluster(spark, **{"spark.sql.warehouse.dir": warehouse})) == warehouse
    assert session.scratch_root(Cluster(spark, **{"spark.sql.warehouse.dir": warehouse, "set": f"{tmp_path}/set"})) == f"{tmp_path}/set"
    # executors that are processes of their own have temporary folders of their own
    assert session.scratch_root(Cluster(spark, **{"spark.master": "local-cluster[3,4,1024]", "spark.sql.warehouse.dir": warehouse})) == warehouse


def test_a_cluster_is_refused_a_folder_that_is_not_shared(spark, tmp_path):
    one = Cluster(spark, **{"spark.checkpoint.dir": f"file://{tmp_path}/own"})
    one.range = lambda start, end, step, parts: spark.range(start, end - 1, step, parts)  # as if a file stayed elsewhere
    with pytest.raises(RuntimeError, match="don't share"):
        session.scratch_root(one)


def test_schemas_parse(spark):
    for name in ("DIM_DATE", "DIM_TIME", "DIM_ROOM", "DIM_SUBGROUP", "DIM_CLASS", "FACT_LECTURE", "DIM_USER", "BRIDGE", "FACT_WIFI"):
        assert spark.createDataFrame([], getattr(schemas, name)).columns
