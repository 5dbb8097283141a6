"""Generated and reserved dimension members."""

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.functions.calendar import calendar_columns, clock_columns, holiday_names
from starkeep.functions.keys import UNKNOWN_KEY
from starkeep.operators.scd import scd0_insert

# The range of the default calendar and its unknown member.
CALENDAR_FIRST = date(2018, 1, 1)
CALENDAR_LAST = date(2030, 12, 31)
UNKNOWN_DAY = {
    "date_key": UNKNOWN_KEY,
    "full_date": date(1, 1, 1),
    "day_of_week": 0,
    "day_name": "Unknown",
    "is_weekend": False,
    "is_us_holiday": False,
    "month_num": 0,
    "month_name": "Unknown",
    "quarter": 0,
    "year": 0,
    "iso_week": 0,
}


def with_reserved(dimension: DataFrame, rows: Sequence[Mapping]) -> DataFrame:
    """Add reserved members; columns a row does not name are NULL.

    Inserted by key like a seed: a dimension that has the members is not changed.
    """
    spark = dimension.sparkSession
    key = dimension.columns[0]
    nullable = T.StructType(
        [T.StructField(f.name, f.dataType) for f in dimension.schema.fields]
    )
    values = [tuple(r.get(c) for c in dimension.columns) for r in rows]
    return scd0_insert(dimension, spark.createDataFrame(values, nullable), [key])


def days_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.date_add(F.lit(first), F.col("id").cast("int"))
    return spark.range((last - first).days + 1).select(days.alias("full_date"))


def days_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last event, gaps filled."""
    day = F.to_date(column)
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    ends = ends.filter(F.col("first").isNotNull())
    step = F.make_dt_interval(F.lit(1))
    return ends.select(F.explode(F.sequence("first", "last", step)).alias("full_date"))


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of every ``full_date``."""
    columns = calendar_columns(F.col("full_date"))
    return days.select(*[col.alias(name) for name, col in columns.items()])


def calendar_dimension(
    spark: SparkSession, first: date = CALENDAR_FIRST, last: date = CALENDAR_LAST
) -> DataFrame:
    """All days of the range and the unknown day."""
    return with_reserved(describe_days(days_between(spark, first, last)), [UNKNOWN_DAY])


def holidays(days: DataFrame) -> DataFrame:
    """``(full_date, holiday)``: the union of all fixed and floating rules."""
    names = F.explode(holiday_names(F.col("full_date")))
    return days.select("full_date", names.alias("holiday")).distinct()


def time_of_day_dimension(spark: SparkSession) -> DataFrame:
    """The 24 hours."""
    columns = clock_columns(F.col("id").cast("int"))
    return spark.range(24).select(*[col.alias(n) for n, col in columns.items()])


def junk_dimension(
    spark: SparkSession, key: str, labels: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Every combination of flags, numbered; key 0 is the all-unknown one.

    ``labels`` maps a flag to its words for false and true. The first flag varies
    fastest.
    """
    flags = list(labels)
    combinations = [c[::-1] for c in product((False, True), repeat=len(flags))]
    rows = [(UNKNOWN_KEY, *[None] * len(flags), "Unknown")]
    for number, values in enumerate(combinations, start=1):
        words = [labels[f][int(v)] for f, v in zip(flags, values)]
        rows.append((number, *values, ", ".join(words)))
    fields = [T.StructField(key, T.ShortType(), False)]
    fields += [T.StructField(f, T.BooleanType()) for f in flags]
    fields += [T.StructField("label", T.StringType(), False)]
    return spark.createDataFrame(rows, T.StructType(fields))


def observed_combinations(
    df: DataFrame, key: str, flags: Sequence[str], values: Sequence[Sequence]
) -> DataFrame:
    """Junk dimension of the combinations that occur in ``df``.

    ``values`` lists each flag's domain: the key is the combination's number in the
    whole domain, so it is the same for every load. A NULL in any flag is key 0.
    """
    seen = df.select(*flags).distinct()
    width = 1
    number: Column = F.lit(1)
    for flag, domain in zip(flags, values):
        place = F.array_position(F.array(*[F.lit(v) for v in domain]), F.col(flag)) - 1
        number = number + place * width
        width *= len(domain)
    known = reduce(lambda a, f: a & F.col(f).isNotNull(), flags, F.lit(True))
    numbered = seen.withColumn(key, F.when(known, number).otherwise(UNKNOWN_KEY))
    return numbered.select(F.col(key).cast("bigint").alias(key), *flags)
