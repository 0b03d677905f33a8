"""Explicit schemas of the warehouse tables and of the raw inputs."""

from __future__ import annotations

DIM_DATE = (
    "DateKey int, FullDate date, NameDay string, NameMonthDutch string, NameMonthEN string,"
    " NameDayDutch string, NameDayEN string, NameQuarter string, NumberQuarter int,"
    " NumberSemester int, Month int, Year int, Weekday int, DayOfYear int, Season string"
)
DIM_TIME = ("TimeKey int, Hour int, Minutes int, Seconds int, FullTime string, TimeAM_PM string")
DIM_ROOM = (
    "RoomKey bigint, Building int, RoomFloor int, Code string, RoomName string, Category string,"
    " Capacity int, Area decimal(10,2)"
)
DIM_SUBGROUP = ("SubgroupKey bigint, SubgroupCode string, ProgramName string")
DIM_CLASS = (
    "ClassKey bigint, ClassName string, ClassCode bigint, ClassCredits int,"
    " ClassSecondChance boolean, ClassProgramStage int"
)
FACT_LECTURE = (
    "LectureID bigint, DateKey int, FromTimeKey int, UntilTimeKey int, ClassKey bigint,"
    " SubgroupKey bigint, RoomKey bigint, ActivityKey int, UserCount bigint, TotalStudents bigint,"
    " AttendanceRate double, OccupancyRate double"
)
DIM_USER = ("UserKey bigint, UserName string")
BRIDGE = ("UserKey bigint, SubgroupKey bigint")
FACT_WIFI = ("DateKey int, TimeKey int, UserKey bigint")
WIFI_FEED = ("username string, timestamp timestamp_ntz, ssid string")
STUDENT = (
    "SUBGROEPID bigint, SUBGROEPCODE string, DEELGROEPID bigint, NAAM string, EMAIL string"
)

# --- fixed values: the usual columns of a timetable export, in file order --------
SCHEDULE_EXPORT_COLUMNS = [
    "Id", "Start", "End", "Updated", "UpdatedBy", "Status", "ReasonTeacher", "ReasonRoom",
    "InternExtern", "Department", "User", "CoordinationService", "ContactPerson",
    "WorkFormCourse", "WorkFormExam", "WorkFormEvaluation", "LearningEnvironment",
    "ExamEnvironment", "EducationActivity", "MobileEquipment", "Classgroups", "TeacherIds",
    "OlodPointers", "Rooms", "TrajectoryPart", "Person", "Student", "Invigilator",
]
# columns a formatted lecture does not carry
SCHEDULE_DROP_COLUMNS = [
    "Updated", "UpdatedBy", "Status", "ReasonTeacher", "ReasonRoom", "InternExtern", "Department",
    "User", "CoordinationService", "ContactPerson", "MobileEquipment", "Person",
    "Student", "Invigilator",
]
SCHEDULE_REQUIRED = ["Id", "Start", "End", "OlodPointers", "Rooms", "Classgroups"]
# activity columns in search order
ACTIVITY_COLUMNS = [
    "WorkFormCourse", "WorkFormExam", "WorkFormEvaluation", "EducationActivity",
    "LearningEnvironment", "ExamEnvironment",
]
# columns kept by the older reservation clean-up
RESERVATION_COLUMNS = [
    "Id", "Start", "End", "Updated", "UpdatedBy", "Status", "WorkFormCourse", "WorkFormExam",
    "WorkFormEvaluation", "LearningEnvironment", "ExamEnvironment", "Classgroups", "TeacherIds",
    "OlodPointers", "Rooms", "TrajectoryPart",
]
# --------------------------------------------------------------------------------
