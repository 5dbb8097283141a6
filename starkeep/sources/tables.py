"""Cleaned tables: typed Parquet, partitioned by event year."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.functions.keys import TRIAGE_YEAR

YEAR_COLUMN = "_ingest_year"


def without_triage(df: DataFrame) -> DataFrame:
    """Drop the triage partition; a table without the column passes unchanged.

    On a partitioned table this is a partition filter, the files are not read.
    """
    if YEAR_COLUMN not in df.columns:
        return df
    return df.filter(F.col(YEAR_COLUMN) != TRIAGE_YEAR)


def newest_snapshot(df: DataFrame) -> DataFrame:
    """Only the latest snapshot year, for tables whose year is the year of the run.

    A reload in a new year leaves the old partition behind; reading both would give
    a lookup two rows per key.
    """
    latest = df.agg(F.max(YEAR_COLUMN)).scalar()
    return df.filter(F.col(YEAR_COLUMN) == latest)


def write_cleaned(df: DataFrame, path: str) -> None:
    """Replace only the year partitions that occur in ``df``."""
    (
        df.hint("rebalance", YEAR_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(YEAR_COLUMN)
        .parquet(path)
    )


def read_cleaned(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table without its triage partition."""
    return without_triage(spark.table(table))


def optional_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The catalog table, or None where the source has not arrived yet."""
    if not spark.catalog.tableExists(table):
        return None
    return read_cleaned(spark, table)


def typed_nulls(df: DataFrame, fields: Mapping[str, str | T.DataType]) -> DataFrame:
    """Add NULL columns of the given types: what a missing optional source provides."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in fields.items()})


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    pushdown: bool = True,
) -> DataFrame:
    """A warehouse table kept in a relational database.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in
    ``options`` for a parallel read. ``pushdown=False`` keeps filters and aggregates
    in Spark.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    flag = str(pushdown).lower()
    return reader.options(pushDownPredicate=flag, pushDownAggregate=flag).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None
) -> None:
    """Replace a relational table's rows in one write, keeping the table itself."""
    writer = df.write.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    writer.option("truncate", "true").mode("overwrite").save()
