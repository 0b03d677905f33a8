"""Dates, times of day and their integer keys.

A time of day is a number of seconds since midnight, never a timestamp on a made-up
date.  Wall-clock values are ``timestamp_ntz``, so no result depends on the zone of
the session.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: export date formats, the first one is the usual --------------
EXPORT_FORMATS = [
    "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm",
    "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
]
DAY_SECONDS = 86400
# calendar words
MONTHS_DUTCH = [
    "Januari", "Februari", "Maart", "April", "Mei", "Juni", "Juli", "Augustus", "September",
    "Oktober", "November", "December",
]
MONTHS_ENGLISH = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
]
DAYS_DUTCH = ["Maandag", "Dinsdag", "Woensdag", "Donderdag", "Vrijdag", "Zaterdag", "Zondag"]
DAYS_ENGLISH = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# semester of each month, January first: first, second and summer
SEMESTER_OF_MONTH = [1, 2, 2, 2, 2, 2, 3, 3, 1, 1, 1, 1]
# first day (month * 100 + day) of each season
SPRING_FROM, SUMMER_FROM, FALL_FROM, WINTER_FROM = 321, 621, 923, 1221
# --------------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _word(index: Column, words: list) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), index.cast("int"))


def parse_datetime(c: str | Column, formats: list[str] | None = None) -> Column:
    """First format that fits, else null."""
    text = F.trim(_col(c))
    tries = [
        F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats or EXPORT_FORMATS
    ]
    return F.coalesce(*tries)


def date_key(c: str | Column) -> Column:
    day = _col(c)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def time_key(c: str | Column) -> Column:
    ts = _col(c)
    return (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).cast("int")


def whole(c: Column, by: int) -> Column:
    """Whole-number division."""
    return F.call_function("div", c, F.lit(by))


def key_date(c: str | Column) -> Column:
    return F.to_date(_col(c).cast("string"), "yyyyMMdd")


def key_seconds(c: str | Column) -> Column:
    """Seconds since midnight of an HHmmss key.

    10000 h + 100 m + s, less 40 per hundred and 2400 per ten thousand, is
    3600 h + 60 m + s.
    """
    key = _col(c)
    return (key - whole(key, 100) * 40 - whole(key, 10000) * 2400).cast("int")


def seconds_key(c: str | Column) -> Column:
    """HHmmss key of seconds since midnight, the reverse of ``key_seconds``."""
    s = _col(c)
    return (s + whole(s, 60) * 40 + whole(s, 3600) * 4000).cast("int")


def at_second(day: str | Column, seconds: str | Column) -> Column:
    """Wall-clock time of a date and seconds since midnight."""
    s = _col(seconds).cast("int")
    return F.make_timestamp_ntz(
        F.year(_col(day)), F.month(_col(day)), F.dayofmonth(_col(day)),
        whole(s, 3600).cast("int"), (whole(s, 60) % 60).cast("int"),
        (s % 60).cast("decimal(8,6)"),
    )


def hhmm(seconds: str | Column) -> Column:
    s = _col(seconds).cast("int")
    hours = F.lpad(whole(s, 3600).cast("string"), 2, "0")
    minutes = F.lpad((whole(s, 60) % 60).cast("string"), 2, "0")
    return F.concat(hours, F.lit(":"), minutes)


def key_clock_text(c: str | Column) -> Column:
    """``HH:mm:ss`` text of an HHmmss key."""
    padded = F.lpad(_col(c).cast("string"), 6, "0")
    return F.concat_ws(":", padded.substr(1, 2), padded.substr(3, 2), padded.substr(5, 2))


def local_time(c: str | Column, zone: str = "Europe/Brussels") -> Column:
    """Wall-clock time in ``zone`` of a UTC wall-clock time, daylight saving included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(c).cast("timestamp_ntz"))


def _epoch_micros(ts: Column) -> Column:
    """Microseconds of the wall clock since 1970, whatever the session zone."""
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * DAY_SECONDS + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def rounded(c: str | Column, step_seconds: int) -> Column:
    """Wall-clock time at the nearest step, ties to the even step.

    The quotient is exact enough for any date of this century: a tie is exact in binary
    and the nearest other value is further from it than the precision of a double.
    """
    ts = _col(c).cast("timestamp_ntz")
    steps = F.rint(_epoch_micros(ts) / F.lit(step_seconds * 1_000_000)).cast("bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (steps * step_seconds).cast("decimal(18,6)"))


def rounded_keys(c: str | Column, step_seconds: int) -> tuple[Column, Column]:
    """(DateKey, TimeKey) after rounding; the last half step of a day is in the next date."""
    ts = rounded(c, step_seconds)
    return date_key(ts), time_key(ts)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minutes between two seconds-of-day columns."""
    return (_col(end) - _col(start)) / 60


def iso_year_week(day: str | Column) -> Column:
    d = _col(day)
    year = F.extract(F.lit("YEAROFWEEK"), d).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def weekday_number(day: str | Column) -> Column:
    """0 is Monday."""
    return F.weekday(_col(day))


def weekday_name(day: str | Column) -> Column:
    return _word(F.weekday(_col(day)), DAYS_ENGLISH)


def week_monday(day: str | Column) -> Column:
    d = _col(day)
    return F.date_sub(d, F.weekday(d))


def week_sunday(day: str | Column) -> Column:
    d = _col(day)
    return F.date_add(d, F.lit(6) - F.weekday(d))


def semester(day: str | Column) -> Column:
    return _word(F.month(_col(day)) - 1, SEMESTER_OF_MONTH)


def season(day: str | Column) -> Column:
    mmdd = F.month(_col(day)) * 100 + F.dayofmonth(_col(day))
    return (
        F.when((mmdd >= WINTER_FROM) | (mmdd < SPRING_FROM), "Winter")
        .when(mmdd < SUMMER_FROM, "Spring")
        .when(mmdd < FALL_FROM, "Summer")
        .otherwise("Fall")
    )


def finished(date_key_col: str | Column, until_key_col: str | Column, now: Column) -> Column:
    """A lecture counts as over on an earlier date, or today once its end has come."""
    today = date_key(now)
    clock = F.hour(now) * 3600 + F.minute(now) * 60 + F.second(now)
    day = _col(date_key_col)
    return (day < today) | ((day == today) & (key_seconds(until_key_col) <= clock))


def calendar_columns(day: str | Column) -> dict[str, Column]:
    """All attributes of a calendar row."""
    d = _col(day)
    return {
        "DateKey": date_key(d),
        "FullDate": d,
        "NameDay": weekday_name(d),
        "NameMonthDutch": _word(F.month(d) - 1, MONTHS_DUTCH),
        "NameMonthEN": _word(F.month(d) - 1, MONTHS_ENGLISH),
        "NameDayDutch": _word(F.weekday(d), DAYS_DUTCH),
        "NameDayEN": weekday_name(d),
        "NameQuarter": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "NumberQuarter": F.quarter(d),
        "NumberSemester": semester(d),
        "Month": F.month(d),
        "Year": F.year(d),
        "Weekday": F.weekday(d) + 1,
        "DayOfYear": F.dayofyear(d),
        "Season": season(d),
    }


def half_of_day(hour: str | Column) -> Column:
    return F.when(_col(hour) < 12, "AM").otherwise("PM")
