"""Folders and small files through Hadoop's file system, so any URI Spark reads works."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Schemes of stores that have no atomic rename.
OBJECT_STORES = {"s3", "s3a", "s3n", "gs", "wasb", "wasbs", "cosn", "oss", "obs"}


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, sorted; empty when there are none."""
    path, fs = _path(spark, pattern)
    found = fs.globStatus(path)
    if not found:
        return []
    return sorted(java_texts(spark, spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)))


def java_texts(spark: SparkSession, array) -> list[str]:
    """The elements of a Java array as text, brought over in one call; a call for each takes minutes for many files."""
    if not len(array):
        return []
    return spark._jvm.scala.collection.mutable.ArraySeq.make(array).mkString("\0").split("\0")


def read_text(spark: SparkSession, uri: str) -> str | None:
    """Content of a small file, or None when it does not exist."""
    path, fs = _path(spark, uri)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, uri: str) -> str | None:
    """The first line of a text file without its end; None for an empty file."""
    path, fs = _path(spark, uri)
    jvm = spark._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def replace_text(spark: SparkSession, uri: str, text: str) -> None:
    """Replace a small file in one step, so readers see the old text or the new.

    File systems that rename atomically get it written aside and renamed over the old one. On
    object stores a rename is a copy and a delete, while an object appears as a whole when
    its stream is closed: there it is overwritten.
    """
    jvm = spark._jvm
    target, fs = _path(spark, uri)
    if fs.getScheme() in OBJECT_STORES:
        stream = fs.create(target, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        return
    aside, fs = _path(spark, f"{uri}.{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(aside, target, options)


def delete(spark: SparkSession, uri: str) -> None:
    path, fs = _path(spark, uri)
    fs.delete(path, True)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Only a local session without one gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = found.get() if found.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="starkeep-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/starkeep/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for one run; nothing exists there yet."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate results, when nothing reads them any more."""
    delete(spark, _application_folder(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    Later uses neither recompute them nor depend on an executor that may be lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
