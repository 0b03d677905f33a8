"""Head counts, roster sizes, rates: the interval-join family."""

from __future__ import annotations

from rollcall.catalogue.registry import query
from rollcall.catalogue.views import r9, secs
from rollcall.plans import presence

OVER = f"(f.DateKey < 20240125 OR (f.DateKey = 20240125 AND {secs('f.UntilTimeKey')} <= 43200))"


DOM_03_SQL = f"""
SELECT f.LectureID, f.SubgroupKey, f.DateKey, f.FromTimeKey, f.UntilTimeKey, f.ClassKey, f.RoomKey, f.ActivityKey,
       CASE WHEN {OVER} THEN coalesce(w.n, 0) END AS UserCount, coalesce(r.TotalStudents, 0) AS TotalStudents,
       {r9("CASE WHEN coalesce(r.TotalStudents, 0) = 0 THEN 0.0 WHEN " + OVER + " THEN coalesce(w.n, 0) / CAST(r.TotalStudents AS DOUBLE) END")} AS AttendanceRate
FROM fact_base f
LEFT JOIN (SELECT l.LectureID, l.SubgroupKey, count(DISTINCT c.UserKey) AS n
           FROM fact_base l JOIN dim_subgroup s ON s.SubgroupKey = l.SubgroupKey
           JOIN bridge b ON b.SubgroupKey = l.SubgroupKey
           JOIN fact_wifi c ON c.UserKey = b.UserKey AND c.DateKey = l.DateKey
             AND {secs('c.TimeKey')} BETWEEN {secs('l.FromTimeKey')} + 900 AND {secs('l.UntilTimeKey')}
           GROUP BY 1, 2) w ON w.LectureID = f.LectureID AND w.SubgroupKey = f.SubgroupKey
LEFT JOIN roster r ON r.SubgroupKey = f.SubgroupKey"""


@query("dom_03_user_count", DOM_03_SQL)
def dom_03(v):
    return v.counted


@query("dom_04_total_students", "SELECT SubgroupKey, TotalStudents FROM roster")
def dom_04(v):
    return presence.roster_sizes(v.bridge, v.users, v.subgroups)


@query("dom_05_occupancy_rate", f"""
SELECT LectureID, SubgroupKey, RoomKey, UserCount, {r9('OccupancyRate')} AS OccupancyRate FROM fact_lecture""")
def dom_05(v):
    return v.fact.select("LectureID", "SubgroupKey", "RoomKey", "UserCount", "OccupancyRate")
