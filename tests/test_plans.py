"""Shapes of the plans and rules of the code base."""

import pathlib
import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
PACKAGE = pathlib.Path(entry.__file__).parent / "rollcall"
QUERIES = entry.queries()


@pytest.mark.parametrize("name", [
    "dom_03_user_count", "dom_06_program_inference", "dom_17_corrected_attendance", "dom_19_session_results",
    "dom_20_lecture_results", "jn_10_interval_join", "jn_18_first_filled_lookup", "ag_21_histogram", "mut_06_guarded_delete_done",
])
def test_no_nested_loops(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["dom_24_presence_by_minute"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "events.parquet" in line)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in scan
    assert "In(event_type" in scan


def test_code_keeps_to_the_rules():
    code = {p.name: p.read_text() for p in PACKAGE.rglob("*.py") if "llm" not in p.relative_to(PACKAGE).parts}
    for word in (r"localCheckpoint", r"crossJoin", r"F\.broadcast", r"\.rdd\b", r"toPandas", r"F\.udf\b"):
        assert [n for n, t in code.items() if re.search(word, t)] == [], word
