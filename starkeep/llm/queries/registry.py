"""Registration of this package's queries."""

from pyspark.sql import DataFrame, SparkSession

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    """Register the function under its name, with its SQL counterpart where there is one."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
