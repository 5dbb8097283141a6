"""One row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank__"


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """The first row of each key in ``order``; the caller gives the direction.

    Equal rows in ``order`` are told apart by all other columns, so every run picks
    the same row. ``row_number() = 1`` lets Spark keep one row per key and task before
    it shuffles, so a key with very many rows costs one row per task.
    """
    if RANK in df.columns:
        raise ValueError(f"column {RANK} is reserved")
    sortable = [n for n, t in df.dtypes if n not in keys and not t.startswith("map")]
    ties = [F.col(n).desc_nulls_last() for n in sortable]
    if not order and not ties:
        return df.distinct()  # the key is the whole row
    ranked = Window.partitionBy(*keys).orderBy(*order, *ties)
    rows = df.withColumn(RANK, F.row_number().over(ranked))
    return rows.filter(F.col(RANK) == 1).drop(RANK)


def latest_or_keyless(
    df: DataFrame, key: str, order: Sequence[Column] = ()
) -> DataFrame:
    """As :func:`latest_per_key`, but rows without a key all stay.

    They are told apart by a 256-bit digest of the whole row, which also spreads them
    over the tasks; only an exact copy of a keyless row counts as a repeat.
    """
    digest = "__keyless__"
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    marked = df.withColumn(digest, F.when(F.col(key).isNull(), F.sha2(text, 256)))
    return latest_per_key(marked, [key, digest], order).drop(digest)
