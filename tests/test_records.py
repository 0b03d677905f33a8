"""Delimited records across lines and splits, and student documents in any wrapper, against plain Python."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from rollcall.sources import files
from rollcall.sources.documents import find_rows
from rollcall.sources.records import lines_of, records
from tests.conftest import rows


def cells(df, names):
    return sorted(([r[n] for n in names] for r in df.collect()), key=str)


def python_rows(text, sep, names):
    """The rows of a file below its header: none with too many fields, short ones filled up."""
    read = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r]
    head = [h.strip() for h in read[0]]
    full = [r + [""] * (len(head) - len(r)) for r in read[1:] if len(r) <= len(head)]
    return [[dict(zip(head, r)).get(n) or None for n in names] for r in full]


def random_file(rng, sep, names, n):
    """Cells with separators, quotes and line breaks; unquoted cells with a quote inside; lines with a field too many."""
    def cell():
        text = "".join(rng.choice(["a", "b", " ", '"', sep, "\n", "é", ""]) for _ in range(rng.randrange(6)))
        if any(c in text for c in ('"', sep, "\n")) or rng.random() < 0.2:
            return '"' + text.replace('"', '""') + '"'
        return text + (rng.choice(['"', 'x"y"']) if text and rng.random() < 0.1 else "")
    out = [sep.join(names)]
    for _ in range(n):
        out.append(sep.join([f"k{rng.randrange(10**6)}", *[cell() for _ in range(len(names) - 1 + (rng.random() < 0.1))]]))
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("split_bytes", ["100", "1k", "128m"])
def test_records_across_lines_and_splits(spark, tmp_path, split_bytes):
    """Two files with other separators and orders of columns, read in splits that cut through cells."""
    rng = random.Random(11)
    shapes = {"one.csv": (";", ["k", "x", "y"]), "two.csv": (",", ["y", "k", "x"])}
    expected = []
    for name, (sep, names) in shapes.items():
        text = random_file(rng, sep, names, 300)
        (tmp_path / name).write_text(text, newline="")
        expected += python_rows(text, sep, ["k", "x", "y"])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = files.delimited(spark, str(tmp_path), candidates=";,")
        got = cells(df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in ("k", "x", "y")]), ["k", "x", "y"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(expected, key=str)


def test_a_row_equal_to_the_header_stays(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿k;n\n1;a\n2;b;c\nk;n\n3;"x\ny"\n\n4\n')
    assert cells(files.delimited(spark, str(tmp_path)), ["k", "n"]) == sorted([["1", "a"], ["k", "n"], ["3", "x\ny"], ["4", None]], key=str)


def test_a_quote_that_is_never_closed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k;n\n1;"a\n' + "2;b\n" * 400)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        with pytest.raises(Exception, match="never closed"):
            files.delimited(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_files_without_open_cells_are_not_sorted(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k;n\n1;"a;b"\n2;c\n')
    lines = lines_of(spark, str(tmp_path)).withColumn("sep", F.lit(";"))
    assert sorted(r.record for r in records(lines, ";").collect()) == ['1;"a;b"', "2;c", "k;n"]


def reference_rows(data):
    """The list of a document, searched by hand."""
    if isinstance(data, list):
        return data if data and isinstance(data[0], dict) and "EMAIL" in data[0] else []
    if not isinstance(data, dict):
        return []
    for key, value in data.items():
        if key.strip().lower() == "students":
            if isinstance(value, list):
                return value
            if isinstance(value, dict) and reference_rows(value):
                return reference_rows(value)
    return next((found for found in map(reference_rows, data.values()) if found), [])


def test_documents_in_any_wrapper(spark, tmp_path):
    someone = lambda i: {"EMAIL": f"e{i}", "NAAM": None, "SUBGROEPID": i}
    documents = [
        [someone(1), someone(1)], {"students": [someone(2)]}, {"students": {"students": [someone(3)], "count": 1}},
        {" Students ": [someone(4)]}, {"data": {"page": 1, "STUDENTS": {"students": [someone(5)]}}},
        {"count": 2, "result": [someone(6)]}, {"z": {"deep": {"deeper": {"list": [someone(7)]}}}, "a": [someone(8)]},
        {"text": '[{"EMAIL": "no"}]', "a": {"b": "{}"}}, {"students": []}, {"students": [], "other": [someone(9)]},
        {"x": {"students": []}, "y": {"students": [someone(10)]}}, {"students": {"page": 1}, "more": {"students": [someone(11)]}},
        {"list": [{"NAAM": "no mail"}], "students": [{"NAAM": "none"}, someone(12)]}, [1, 2], {}, [], {"list": ["EMAIL"]}, 7,
        {"b": {"students": [someone(13)]}, "a": {"students": [someone(14)]}},
    ]
    for i, data in enumerate(documents):
        (tmp_path / f"d{i}.json").write_text(("﻿" if i % 3 == 0 else "") + json.dumps(data, indent=i % 2 or None), encoding="utf-8")
    (tmp_path / "broken.json").write_text('{"students": [')
    expected = [(r["EMAIL"], f"d{i}.json") for i, d in enumerate(documents) for r in reference_rows(d) if r.get("EMAIL") is not None]
    got = files.student_documents(spark, str(tmp_path)).select("EMAIL", "source_file")
    assert sorted((r.EMAIL, r.source_file) for r in got.collect()) == sorted(expected)


def test_documents_without_anything(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "null"), (4, '"students"')], "id int, doc string")
    assert find_rows(docs, ["id"], "doc", "students", "EMAIL", "struct<EMAIL string>").count() == 0
    assert find_rows(docs.limit(0), ["id"], "doc", "students", "EMAIL", "struct<EMAIL string>").count() == 0
    one = spark.createDataFrame([(1, '{"a": {"Students": [{"EMAIL": "e"}]}}')], "id int, doc string")
    assert rows(find_rows(one, ["id"], "doc", "students", "EMAIL", "struct<EMAIL string>").select("id", "row.EMAIL")) == [("e", 1)]
