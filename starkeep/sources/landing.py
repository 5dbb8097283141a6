"""Raw landing area: ``<root>/<source>/ingest_date=<day>/<files>``.

Files are only ever added. CSV columns are read as text and typed later; a source
without files yields an empty frame, and the reader is not called.
"""

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.sources.files import first_line, glob, java_texts

# The CSV dialect.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"'}
HEADER_THREADS = 16


def source_folder(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}"


def has_files(spark: SparkSession, root: str, source: str, suffix: str) -> bool:
    pattern = f"{source_folder(root, source)}/ingest_date=*/*{suffix}"
    return bool(glob(spark, pattern))


def landed_files(
    spark: SparkSession, root: str, source: str, suffix: str, days: Sequence[date] | None = None
) -> dict[date, list[str]]:
    """Files by ingest date, of all dates or of ``days``."""
    folder = source_folder(root, source)
    dates = ["*"] if days is None else sorted({day.isoformat() for day in days})
    out: dict[date, list[str]] = {}
    for day in dates:
        for file in glob(spark, f"{folder}/ingest_date={day}/*{suffix}"):
            value = file.rsplit("/", 2)[1].removeprefix("ingest_date=")
            out.setdefault(date.fromisoformat(value), []).append(file)
    return out


def landed_days(spark: SparkSession, root: str, source: str) -> list[date]:
    """Ingest dates that have a folder; files are not listed."""
    found = glob(spark, f"{source_folder(root, source)}/ingest_date=*")
    return [date.fromisoformat(path.rsplit("=", 1)[1]) for path in found]


def _reader(spark: SparkSession, suffix: str):
    return spark.read.option("mode", "PERMISSIVE").option("pathGlobFilter", f"*{suffix}")


def _csv_layouts(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header; empty files have none and are left out."""
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = list(pool.map(partial(first_line, spark), files))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line:
            header = tuple(next(csv.reader([line.removeprefix("\ufeff")])))
            layouts.setdefault(header, []).append(file)
    return layouts


def read_csv(
    spark: SparkSession,
    root: str,
    source: str,
    schema: T.StructType | None = None,
    days: Sequence[date] | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame | None:
    """All landed CSV files as text columns plus ``ingest_date``; None without files.

    Names come from each file's own header: files are grouped by header, each group is
    read by it, and the groups are joined by name, with NULL for columns a file lacks. With ``schema`` no header is read ahead, and a
    file whose header differs fails instead of shifting columns. With ``days`` only files
    of these ingest dates are listed and read, with ``files`` just these.
    """
    folder = source_folder(root, source)
    if files is None:
        files = [f for found in landed_files(spark, root, source, ".csv", days).values() for f in found]
    if not files:
        return None
    reader = _reader(spark, ".csv").options(**CSV_DIALECT, enforceSchema=False)
    reader = reader.option("basePath", folder)
    if schema is not None:
        return reader.schema(schema).csv(files)
    parts = []
    for header, group in sorted(_csv_layouts(spark, files).items()):
        text = T.StructType([T.StructField(name, T.StringType()) for name in header])
        parts.append(reader.schema(text).csv(group))
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts) if parts else None


def read_json(
    spark: SparkSession,
    root: str,
    source: str,
    schema: T.StructType | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame | None:
    """All landed multi-line JSON files, or just ``files``, plus ``ingest_date``; None without files.

    Where ``files`` are all there are of their dates, as in a daily run, these folders are listed, each by one call. Spark
    has a task for every single file it is given.
    """
    if not (has_files(spark, root, source, ".json") if files is None else files):
        return None
    folder = source_folder(root, source)
    reader = _reader(spark, ".json").option("multiLine", True).option("basePath", folder)
    if schema is not None:
        reader = reader.schema(schema)
    if files is None:
        return reader.json(folder)
    whole = reader.json(sorted({file.rsplit("/", 1)[0] for file in files}))
    listed = map(unquote, java_texts(spark, whole._jdf.inputFiles()))
    if _names(listed) == _names(files):
        return whole
    return reader.json(list(files))


def _names(files: Iterable[str]) -> list[str]:
    """The files by folder and name, however their root is written."""
    return sorted(file.split("/ingest_date=", 1)[-1] for file in files)


def land(
    df: DataFrame,
    root: str,
    source: str,
    ingest_date: date,
    fmt: str = "csv",
    **options,
) -> str:
    """Append one batch under its ingest date; returns the source's folder.

    Spark gives every file a unique name. Landed rows are counted where they are
    read (see ``operators.quality.reconcile``), not in a side file.
    """
    day = F.lit(ingest_date.isoformat())
    writer = df.withColumn("ingest_date", day).write.mode("append")
    if fmt == "csv":
        writer = writer.options(**CSV_DIALECT)
    folder = source_folder(root, source)
    writer.options(**options).partitionBy("ingest_date").format(fmt).save(folder)
    return folder


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
