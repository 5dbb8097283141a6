"""Tolerant parsing: a value that cannot be read becomes NULL, never an error.

Wall-clock times are TIMESTAMP_NTZ, so no session time zone moves them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two wire formats of event times, and the hourly feed's format.
ISO_MILLIS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$"
US_TWELVE_HOUR = r"(?i)^\d{2}/\d{2}/\d{4} (0[1-9]|1[0-2]):\d{2}:\d{2} [AP]M$"
ISO_MINUTES = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$"


def _digits(col: Column, start: int, length: int) -> Column:
    return F.substring(col, start, length).try_cast("int")


def _iso(col: Column, pattern: str) -> Column:
    return F.when(col.rlike(pattern), col.try_cast("timestamp_ntz"))


def _twelve_hour(col: Column) -> Column:
    afternoon = F.when(F.upper(F.substring(col, 21, 2)) == "PM", 12).otherwise(0)
    return F.when(
        col.rlike(US_TWELVE_HOUR),
        F.try_make_timestamp_ntz(
            _digits(col, 7, 4),
            _digits(col, 1, 2),
            _digits(col, 4, 2),
            _digits(col, 12, 2) % 12 + afternoon,
            _digits(col, 15, 2),
            _digits(col, 18, 2).cast("decimal(16,6)"),
        ),
    )


def parse_event_time(col: Column) -> Column:
    """ISO with milliseconds first, then ``MM/dd/yyyy hh:mm:ss a``, else NULL."""
    return F.coalesce(_iso(col, ISO_MILLIS), _twelve_hour(col))


def parse_iso_minutes(col: Column) -> Column:
    return _iso(col, ISO_MINUTES)


def parse_bool(col: Column) -> Column:
    """``true`` / ``false`` in any case and with blanks around, else NULL."""
    word = F.lower(F.trim(col))
    return F.when(word == "true", True).when(word == "false", False)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast each named column; bad values become NULL."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})
