"""Published warehouse tables.

A table is a Parquet folder ``<root>/<table>/[<partition>=<value>/]_load=<id>/``. A small
pointer file names the loads that are current. A publish writes new folders beside the
old ones and then replaces the pointer: readers see the old state or the new, never a
mix, and a plan that reads the table may be published to it. One writer per table.

The pointer also keeps what the state was made from (``made_from``): loads of other tables, landed files. So a
later run can tell what has changed since, also after one that ended halfway.
"""

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.sources.files import delete, glob, read_text, replace_text

LOAD = "_load"
# Fixed value: Spark's folder name for rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder_value(spark: SparkSession, value) -> str:
    """A partition value as Spark writes it in a folder's name."""
    if value is None or value == "":
        return NO_VALUE
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.escapePathName(str(value))


def in_values(column: str, values: Sequence) -> Column:
    """``isin`` that finds NULL as well, where it is among the values."""
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _pointer(self, table: str) -> dict | None:
        text = read_text(self.spark, f"{self._folder(table)}/_current.json")
        return None if text is None else json.loads(text)

    def exists(self, table: str) -> bool:
        return self._pointer(table) is not None

    def read(self, table: str) -> DataFrame:
        pointer = self._pointer(table)
        if pointer is None:
            raise LookupError(f"{table} has not been published under {self.root}")
        return self._frame(table, pointer, pointer["folders"])

    def _frame(self, table: str, pointer: dict, folders: Mapping[str, str]) -> DataFrame:
        schema = T.StructType.fromJson(pointer["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = self._folder(table)
        paths = [f"{base}/{folder}" for folder in folders.values()]
        with_load = T.StructType(schema.fields + [T.StructField(LOAD, T.StringType())])
        df = self.spark.read.schema(with_load).option("basePath", base).parquet(*paths)
        return df.select(*schema.names)

    def state(self, table: str) -> dict[str, str]:
        """The current loads by partition value; empty when nothing is published."""
        pointer = self._pointer(table)
        return dict(pointer["folders"]) if pointer else {}

    def made_from(self, table: str) -> dict:
        """What was recorded with the table's state; empty when nothing was."""
        pointer = self._pointer(table)
        return pointer.get("made_from") or {} if pointer else {}

    def record(self, table: str, made_from: Mapping) -> None:
        """Note that the table, as it is, is up to date with these."""
        pointer = self._pointer(table)
        if pointer.get("made_from") != made_from:
            pointer["made_from"] = dict(made_from)
            replace_text(self.spark, f"{self._folder(table)}/_current.json", json.dumps(pointer))

    def changed_since(self, table: str, consumer: str, but: Sequence[str] = ()) -> DataFrame | None:
        """Rows of the table that ``consumer`` was not made from, columns in ``but`` aside.

        None when that is not known: nothing was recorded, or its loads are deleted.
        """
        before = self.made_from(consumer).get(table)
        pointer = self._pointer(table)
        if before is None or pointer is None:
            return None
        gone = [f for f in before.values() if f not in pointer["folders"].values()]
        if not all(glob(self.spark, f"{self._folder(table)}/{f}") for f in gone):
            return None
        new = {v: f for v, f in pointer["folders"].items() if before.get(v) != f}
        old = {v: f for v, f in before.items() if pointer["folders"].get(v) != f}
        now, then = (self._frame(table, pointer, folders).drop(*but) for folders in (new, old))
        return now.exceptAll(then)

    def publish(
        self,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        replacing: Iterable | None = None,
        sort_by: Sequence[str] = (),
        made_from: Mapping | None = None,
    ) -> DataFrame:
        """Make ``df`` the table's state and return the published table.

        With ``replacing`` (values of ``partition_by``, NULL among them) only those
        partitions change: they become what ``df`` holds of them, the others keep their files.

        Rows of one partition value are brought together before the write, in several
        tasks where they are many, so neither many small files nor one huge task arises.
        """
        load = uuid.uuid4().hex
        base = self._folder(table)
        layout = [partition_by, LOAD] if partition_by else [LOAD]
        rows = df.hint("rebalance", partition_by) if partition_by else df
        if sort_by:
            prefix = [partition_by] if partition_by else []
            rows = rows.sortWithinPartitions(*prefix, *sort_by)
        (
            rows.withColumn(LOAD, F.lit(load))
            .write.mode("append")
            .partitionBy(*layout)
            .parquet(base)
        )
        written = self._written(base, load, partition_by)
        if replacing is not None:
            before = self._pointer(table)
            gone = {_folder_value(self.spark, value) for value in replacing}
            kept = before["folders"] if before else {}
            written = {v: f for v, f in kept.items() if v not in gone} | written
        pointer = {
            "schema": df.schema.jsonValue(),
            "partition_by": partition_by,
            "folders": written,
            "made_from": dict(made_from or {}),
        }
        replace_text(self.spark, f"{base}/_current.json", json.dumps(pointer))
        return self.read(table)

    def drop_old_loads(self, table: str, needed_by: Iterable[str] = ()) -> int:
        """Delete folders the pointer does not name; how many. Not while others read.

        Those stay that the tables in ``needed_by`` were made from: their next run compares with them.
        """
        pointer = self._pointer(table)
        base = self._folder(table)
        layout = [f"{pointer['partition_by']}=*"] if pointer["partition_by"] else []
        found = glob(self.spark, "/".join([base, *layout, f"{LOAD}=*"]))
        named = set(pointer["folders"].values())
        for consumer in needed_by:
            named |= set(self.made_from(consumer).get(table, {}).values())
        current = tuple(f"/{folder}" for folder in named)
        old = [path for path in found if not path.endswith(current)]
        for path in old:
            delete(self.spark, path)
        return len(old)

    def _written(self, base: str, load: str, partition_by: str | None) -> dict[str, str]:
        """Folders of one load by partition value."""
        leaf = f"{LOAD}={load}"
        if partition_by is None:
            return {"": leaf} if glob(self.spark, f"{base}/{leaf}") else {}
        found = glob(self.spark, f"{base}/{partition_by}=*/{leaf}")
        names = [path.rsplit("/", 2)[1] for path in found]
        return {name.split("=", 1)[1]: f"{name}/{leaf}" for name in names}
