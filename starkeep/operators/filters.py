"""Report filters. A filter without a value lets every row through."""

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have all the columns, e.g. both coordinates of a map point."""
    return df.dropna(how="any", subset=list(columns))


def in_days(
    df: DataFrame, column: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Whole days, both ends included; rows without a day stay.

    The bounds are put on the column itself (a date or a time), so they reach the scan.
    """
    day = F.col(column)
    inside = F.lit(True)
    if first is not None:
        inside = inside & (day >= F.lit(first))
    if last is not None:
        inside = inside & (day < F.lit(last + timedelta(days=1)))
    return df.filter(day.isNull() | inside)


def in_categories(
    df: DataFrame, column: str, values: Sequence | None = None
) -> DataFrame:
    if values is None:
        return df
    return df.filter(F.col(column).isin(list(values)))
