"""Ratios and bands that stay defined for empty denominators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(part: str | Column, whole: str | Column, on_empty=None) -> Column:
    """part / whole where whole is positive, else ``on_empty``."""
    w = _col(whole)
    return F.when(w > 0, _col(part).cast("double") / w).otherwise(F.lit(on_empty).cast("double"))


def attendance_rate(present: str | Column, roster: str | Column) -> Column:
    """0 for an empty roster; null while the head count is unknown."""
    r = _col(roster)
    safe = F.when(r != 0, r)
    return F.when(r == 0, F.lit(0.0)).otherwise(_col(present).cast("double") / safe)


def occupancy_rate(present: str | Column, capacity: str | Column) -> Column:
    return ratio(present, capacity)


def cap_at_one(c: str | Column) -> Column:
    """Keeps nulls; ``least`` would turn a null into 1."""
    return F.when(_col(c) > 1, F.lit(1.0)).otherwise(_col(c))


def differs(a: str | Column, b: str | Column, tolerance: float = 1e-4) -> Column:
    return F.abs(_col(a) - _col(b)) > tolerance


# --- fixed values: upper edges and labels of the attendance bands ---------------
ATTENDANCE_BANDS = [(0.05, "<= 5%"), (0.20, "5–20%"), (0.50, "20–50%"), (0.90, "50–90%")]
TOP_BAND = "> 90%"
# --------------------------------------------------------------------------------


def attendance_band(c: str | Column) -> Column:
    """Right-closed bands; null stays null."""
    value = _col(c)
    out = F.when(value.isNotNull(), F.lit(TOP_BAND))
    for edge, label in reversed(ATTENDANCE_BANDS):
        out = F.when(value <= edge, F.lit(label)).otherwise(out)
    return out
