"""What landed: one entry a batch, with its rows counted while they were written.

Entries lie in ``<root>/_manifest`` and are only ever added. They name the batch's files, so whoever reads files can tell
how many rows there must be without reading anything twice.
"""

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.operators.quality import GateError
from starkeep.sources.files import glob
from starkeep.sources.landing import land, landed_files
from starkeep.sources.windows import DayRange

FOLDER = "_manifest"
ENTRY = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("label", T.StringType()),
        T.StructField("run_time", T.TimestampNTZType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("files", T.ArrayType(T.StringType())),
    ]
)


def relative(file: str) -> str:
    """A landed file's path from its feed's folder on, however the root is written."""
    return "/".join(file.rsplit("/", 3)[1:])


class Counted:
    """Counts the rows that flow through a frame while something else uses them."""

    def __init__(self, df: DataFrame):
        self._seen = Observation()
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("n_rows"))

    @property
    def rows(self) -> int:
        """Known once a job has used ``df``."""
        return self._seen.get["n_rows"]


def land_batch(
    df: DataFrame,
    root: str,
    source: str,
    ingest_date: date,
    days: DayRange,
    run_time: datetime,
    fmt: str = "csv",
    **options,
) -> int:
    """Land one batch and enter it in the manifest; returns its number of rows.

    ``days`` is the range the batch covers. One writer per source and date. A run that ends between both
    leaves files that no entry names (``unlisted``).
    """
    spark = df.sparkSession
    counted = Counted(df)
    suffix = f".{fmt}"
    before = landed_files(spark, root, source, suffix, [ingest_date]).get(ingest_date, [])
    land(counted.df, root, source, ingest_date, fmt, **options)
    after = landed_files(spark, root, source, suffix, [ingest_date]).get(ingest_date, [])
    files = sorted(relative(f) for f in set(after) - set(before))
    entry = (source, ingest_date, days.label, run_time, counted.rows, files)
    rows = spark.createDataFrame([entry], ENTRY).coalesce(1)
    rows.write.mode("append").parquet(f"{root.rstrip('/')}/{FOLDER}")
    return counted.rows


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All entries; none where nothing was entered."""
    folder = f"{root.rstrip('/')}/{FOLDER}"
    if not glob(spark, folder):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(folder)


def unlisted(spark: SparkSession, root: str, files: Sequence[str]) -> DataFrame:
    """``(file)``: those of the files that no entry names."""
    asked = spark.createDataFrame([(relative(f),) for f in files], "file string")
    known = manifest(spark, root).select(F.explode("files").alias("file"))
    return asked.join(known, "file", "left_anti")


def require_complete(
    spark: SparkSession, root: str, source: str, files: Sequence[str], n_read: int
) -> None:
    """Raise where fewer or more rows were read from the files than landed in them.

    Batches the manifest does not know, or that are read in part, cannot be compared and pass.
    """
    asked = spark.createDataFrame([(relative(f),) for f in files], "file string")
    entries = manifest(spark, root).filter(F.col("source") == source)
    named = entries.select("run_time", "label", "n_rows", F.size("files").alias("n"), F.explode("files").alias("file"))
    found = named.join(asked, "file").groupBy("run_time", "label", "n_rows", "n").agg(F.count("*").alias("here"))
    n_files, n_rows, whole = found.agg(
        F.coalesce(F.sum("here"), F.lit(0)),
        F.coalesce(F.sum("n_rows"), F.lit(0)),
        F.coalesce(F.bool_and(F.col("here") == F.col("n")), F.lit(True)),
    ).first()
    if n_files == len(files) and whole and n_rows != n_read:
        raise GateError(f"{source}: {n_rows} rows landed, {n_read} were read")
