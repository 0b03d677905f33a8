"""Queries with stored tables on a master that isn't local, with a mounted folder as spark.checkpoint.dir."""

import pytest

from rollcall.catalogue.registry import runner
from tests.conftest import rows

DATA = "/root/testdata/sf0.001"
NAMES = [
    "ag_06_session_metrics",
    "ag_07_lesson_metrics",
    "ag_14_row_of_group_maximum",
    "ag_18_weekly_weighted_rate",
    "ag_19_two_level",
    "ag_22_box_plot",
    "ag_25_profile_activitydomain",
    "ag_25_profile_classprogramstage",
    "ag_25_profile_fromhour",
    "ag_25_profile_numbersemester",
    "ag_25_profile_namedaydutch",
    "dom_12_session_attendance",
    "dom_13_corrected_sessions",
    "ag_26_contrast",
    "dom_13_slot_comparison",
    "dom_13_slot_expectation",
    "dom_14_first_week_sensitivity",
    "dom_13_slot_summary",
    "dom_15_slot_assignment",
    "dom_15_latest_on_tie",
    "dom_16_group_sizes",
]


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session, which takes its master for a cluster's."""
    own = spark.conf.get("spark.master")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    spark.conf.set("spark.master", "spark://host:7077")
    yield spark
    spark.conf.set("spark.master", own)


@pytest.mark.parametrize("name", NAMES)
def test_runs_with_a_mounted_folder(cluster, name):
    assert rows(runner(name)(cluster, DATA))
