"""Which keys a published table holds, without reading the table.

Beside a table lies ``<table>_keys``: for each row its key, its surrogate, its partition and a digest of its other columns,
partitioned by ranges of the key (by hash where the key is no whole number). A load looks its keys up
there: it reads the ranges its keys fall into, and learns which rows are new, which differ and where they lie.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.functions.hashing import change_hash_json
from starkeep.operators.joins import sized
from starkeep.sources.store import TableStore, in_values

RANGE = "key_range"
#: Binary digits of the keys of one range; number of ranges by hash.
RANGE_BITS, HASH_RANGES = 20, 256


class KeyIndex:
    def __init__(self, store: TableStore, table: str, key: str, surrogate: str, partition: str):
        self.store, self.table, self.name = store, table, f"{table}_keys"
        self.key, self.surrogate, self.partition = key, surrogate, partition

    def range_of(self, df: DataFrame) -> Column:
        if isinstance(df.schema[self.key].dataType, T.IntegralType):
            return F.shiftright(F.col(self.key).cast("long"), RANGE_BITS)
        return F.pmod(F.xxhash64(self.key), F.lit(HASH_RANGES))

    def ranges(self, keys: DataFrame) -> list:
        """The ranges the keys lie in: at most one for each 2**20 keys there can be."""
        return [r[0] for r in keys.select(self.range_of(keys)).distinct().collect()]

    def entries(self, df: DataFrame) -> DataFrame:
        columns = sorted(c for c in df.columns if c not in (self.key, self.surrogate))
        digest = change_hash_json(columns).alias("digest")
        return df.select(self.key, self.surrogate, self.partition, digest, self.range_of(df).alias(RANGE))

    def read(self, keys: DataFrame | None = None) -> DataFrame:
        """The entries; with ``keys`` only the ranges these lie in are read.

        An index that does not belong to the table's state (a run ended between both) is made anew.
        """
        made_from = self.store.made_from(self.name)
        if made_from.get(self.table) != self.store.state(self.table):
            self.rebuild()
        found = self.store.read(self.name)
        return found if keys is None else found.filter(in_values(RANGE, self.ranges(keys)))

    @property
    def top(self) -> int:
        """The highest surrogate given so far."""
        return self.store.made_from(self.name)["top"]

    def rebuild(self) -> None:
        rows = self.store.read(self.table)
        top = rows.agg(F.coalesce(F.max(self.surrogate), F.lit(0))).first()[0]
        self._publish(self.entries(rows), None, top)

    def update(self, rows: DataFrame, top: int, n: int | None = None) -> None:
        """Replace the entries of ``rows`` (``n`` of them), which the table holds by now; only their ranges are rewritten."""
        fresh = self.entries(rows)
        ranges = self.ranges(rows)
        kept = self.store.read(self.name).filter(in_values(RANGE, ranges))
        kept = kept.join(sized(fresh.select(self.key), n), self.key, "left_anti")
        self._publish(kept.unionByName(fresh), ranges, top)

    def _publish(self, entries: DataFrame, ranges, top: int) -> None:
        made_from = {self.table: self.store.state(self.table), "top": top}
        self.store.publish(self.name, entries, RANGE, ranges, [self.key], made_from)
