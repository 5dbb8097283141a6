"""Which days a load covers."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import TypeVar
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

# Fixed value: the feed publishes a day about a week late.
LOOKBACK_DAYS = 8


@dataclass(frozen=True)
class DayRange:
    """Whole days, both ends included."""

    first: date
    last: date

    def __post_init__(self):
        if self.last < self.first:
            raise ValueError(f"range ends {self.last}, before it starts {self.first}")

    @property
    def label(self) -> str:
        if self.first == self.last:
            return self.first.isoformat()
        return f"{self.first.isoformat()}_to_{self.last.isoformat()}"

    def holds(self, col: Column) -> Column:
        """Half-open, so times within the last day are in."""
        after = self.last + timedelta(days=1)
        return (col >= F.lit(self.first)) & (col < F.lit(after))


def resolve_range(
    start: date | None = None,
    end: date | None = None,
    day: date | None = None,
    *,
    now: datetime | None = None,
    zone: str = "UTC",
    lookback: int = LOOKBACK_DAYS,
) -> DayRange:
    """An explicit range, one day, or the day ``lookback`` days before ``now``."""
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is not None:
        return DayRange(start, end)
    if day is None:
        if now is None:
            raise ValueError("without a range or day, now is needed")
        day = now.astimezone(ZoneInfo(zone)).date() - timedelta(days=lookback)
    return DayRange(day, day)


def slice_days(df: DataFrame, column: str, days: DayRange) -> DataFrame:
    """All rows of the range, no cap; the comparison reaches the Parquet scan."""
    return df.filter(days.holds(F.col(column)))


def month_chunks(spark: SparkSession, days: DayRange, months: int = 1) -> DataFrame:
    """``(chunk_start, chunk_end)``: so many months each, counted from the first day."""
    one = spark.range(1).select(
        F.lit(days.first).alias("first"), F.lit(days.last).alias("last")
    )
    return chunk_months(one, "first", "last", months)


def backfill(
    spark: SparkSession, days: DayRange, load: Callable[[DayRange], T], months: int = 1
) -> list[tuple[DayRange, T]]:
    """Run one load for each chunk of months, in order; what each returned.

    A chunk that fails ends the run: those before it are loaded, and loading a chunk again
    changes nothing, so the run can be started anew from any chunk.
    """
    chunks = month_chunks(spark, days, months).orderBy("chunk_start").collect()
    ranges = [DayRange(r["chunk_start"], r["chunk_end"]) for r in chunks]
    return [(chunk, load(chunk)) for chunk in ranges]


def chunk_months(df: DataFrame, first: str, last: str, length: int = 1) -> DataFrame:
    """As :func:`month_chunks`, for every row's range; the last chunk may be short.

    A next chunk starts where the one before ended, so a range that starts on the
    31st goes on from the day after its (shorter) first month.
    """
    months = F.floor(F.months_between(F.col(last), F.col(first)) / length).cast("int")
    step = F.sequence(F.lit(0), months)
    starts = F.add_months(F.col(first), F.col("_month") * length)
    next_start = F.add_months(F.col(first), (F.col("_month") + 1) * length)
    return (
        df.select(first, last, F.explode(step).alias("_month"))
        .select(
            starts.alias("chunk_start"),
            F.least(F.date_sub(next_start, 1), F.col(last)).alias("chunk_end"),
        )
        .filter(F.col("chunk_start") <= F.col("chunk_end"))
    )
