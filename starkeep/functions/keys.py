"""Smart keys and derived measures."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved members and the triage partition.
UNKNOWN_KEY = 0
NOT_APPLICABLE_KEY = -1
TRIAGE_YEAR = 9999


def day(value: date) -> Column:
    """A date literal; from text, because year 1 does not survive ``F.lit``."""
    return F.lit(value.isoformat()).cast("date")


def date_key(col: Column, default: int | None = UNKNOWN_KEY) -> Column:
    """``YYYYMMDD`` as an int."""
    key = (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")
    return key if default is None else F.coalesce(key, F.lit(default))


def hour_key(col: Column, default: int | None = UNKNOWN_KEY) -> Column:
    key = F.hour(col).cast("smallint")
    return key if default is None else F.coalesce(key, F.lit(default).cast("smallint"))


def elapsed_hours(start: Column, end: Column) -> Column:
    """Whole hours on the clock between two times, cut toward zero; may be negative."""
    seconds = _wall_seconds(end) - _wall_seconds(start)
    return F.try_divide(seconds, F.lit(3600)).cast("int")


def _wall_seconds(time: Column) -> Column:
    """Seconds since 1970 on the clock, from its fields: no time zone is involved."""
    days = F.unix_date(F.to_date(time)).cast("bigint")
    return days * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def flag_measure(col: Column) -> Column:
    """Boolean to an additive 0/1; NULL counts as 0."""
    return F.coalesce(col.cast("int"), F.lit(0)).cast("smallint")


def partition_year(col: Column) -> Column:
    """Year of the event; rows without a time go to the triage partition."""
    return F.coalesce(F.year(col), F.lit(TRIAGE_YEAR)).cast("smallint")
