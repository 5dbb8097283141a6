"""Fingerprints of a published table by partition, kept beside it, and where two tables differ.

A fingerprint is a count, an XOR and a sum over row hashes, so fingerprints of parts merge into that of the whole and none
depends on the order of rows. Two tables are compared by the kept fingerprints first; only partitions that
differ are read, and told apart by buckets of the key.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.sources.store import NO_VALUE, TableStore, in_values

VALUES = ("n_rows", "hash_xor", "hash_sum")
BUCKETS = 64


def part_prints(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """A fingerprint of each group over ``columns`` (all others by default), whatever their order."""
    row = F.xxhash64(*sorted(columns if columns is not None else [c for c in df.columns if c not in by]))
    return merge_prints(
        df.select(*by, F.lit(1).alias("n_rows"), row.alias("hash_xor"), row.cast("decimal(38,0)").alias("hash_sum")), by
    )


def merge_prints(prints: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fingerprints of coarser groups, or of everything, from those of finer ones."""
    return prints.groupBy(*by).agg(
        F.sum("n_rows").cast("long").alias("n_rows"),
        F.bit_xor("hash_xor").alias("hash_xor"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
    )


def published_prints(store: TableStore, table: str, partition: str) -> DataFrame:
    """``(partition, fingerprint)`` of a table published by an integer column; only partitions with new loads are read."""
    name = f"{table}_prints"
    now, before = store.state(table), store.made_from(name).get(table, {})
    new = {v for v in now.keys() | before.keys() if now.get(v) != before.get(v)}
    if new or not store.exists(name):
        values = [None if v == NO_VALUE else int(v) for v in new]
        rows = store.read(table).filter(in_values(partition, values))
        store.publish(name, part_prints(rows, [partition]), partition, values, made_from={table: now})
    return store.read(name)


def differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by, n_left, n_right)`` of the groups whose fingerprints differ; a group one side lacks has 0 rows there."""
    same = reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by])
    both = left.alias("l").join(right.alias("r"), same, "full_outer")
    prints = [F.struct(*[F.col(f"{s}.{v}") for v in VALUES]) for s in "lr"]
    rows = both.filter(~prints[0].eqNullSafe(prints[1]))
    counts = [F.coalesce(F.col(f"{s}.n_rows"), F.lit(0)).alias(n) for s, n in (("l", "n_left"), ("r", "n_right"))]
    return rows.select(*[F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in by], *counts)


def bucket_of(df: DataFrame, key: str, buckets: int = BUCKETS) -> Column:
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    return F.pmod(F.col(key).cast("long") if whole else F.xxhash64(key), F.lit(buckets).cast("long"))


def where_different(
    left: tuple[TableStore, str], right: tuple[TableStore, str], partition: str, key: str, buckets: int = BUCKETS
) -> DataFrame:
    """``(partition, key_bucket, n_left, n_right)``: in which partitions, and there in which buckets of the key, two tables differ."""
    prints = [published_prints(store, table, partition) for store, table in (left, right)]
    parts = [r[0] for r in differing(*prints, [partition]).select(partition).collect()]  # one row a partition

    def finer(store: TableStore, table: str) -> DataFrame:
        rows = store.read(table)
        columns = [c for c in rows.columns if c != partition]
        rows = rows.filter(in_values(partition, parts))
        return part_prints(rows.withColumn("key_bucket", bucket_of(rows, key, buckets)), [partition, "key_bucket"], columns)

    return differing(finer(*left), finer(*right), [partition, "key_bucket"])
