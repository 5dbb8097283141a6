"""Registration of queries and access to the sample tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    """Register the function under its name, with its SQL counterpart."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


class Tables:
    """``Tables(spark, folder).orders`` reads one table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def money(name: str):
    """Two-decimal amounts stored as doubles, made exact so sums do not depend on order."""
    return F.col(name).cast("decimal(12,2)")
