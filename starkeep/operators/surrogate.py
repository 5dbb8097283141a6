"""Surrogate keys without a single-task numbering."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkeep.sources.files import materialize

ROW_BITS = 33  # monotonically_increasing_id: task number above, row number below


def fill_keys(
    df: DataFrame, key: str, order: Sequence[str], start: int = 1
) -> DataFrame:
    """Number the rows without a key, in the order of ``order`` (unique columns).

    Numbers follow the highest key there is, or begin at ``start``; rows with a key keep
    it. Rows are range-partitioned and sorted, those without a key first, each with its
    position in its partition. They are written once, so a lost executor cannot change a
    position. The offsets are sums over one row per partition and are broadcast.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(
        F.col(key).isNotNull(), *order
    )
    placed = sorted_rows.select(
        "*",
        F.shiftright(place, ROW_BITS).alias("_part"),
        place.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )
    placed = materialize(placed, "keys")
    sizes = placed.groupBy("_part").agg(
        F.count(F.when(F.col(key).isNull(), 1)).alias("_size"), F.max(key).alias("_top")
    )
    every = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.greatest(F.max("_top").over(every) + 1, F.lit(start))
    offset = first + F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    offsets = sizes.select("_part", offset.cast("bigint").alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_part")
    value = F.coalesce(F.col(key), F.col("_offset") + F.col("_row"))
    return numbered.withColumn(key, value).select(*df.columns)


def assign_keys(
    df: DataFrame, key: str, order: Sequence[str], start: int = 1
) -> DataFrame:
    """Consecutive keys from ``start`` for all rows; see :func:`fill_keys`."""
    columns = df.columns if key in df.columns else [key, *df.columns]
    blank = df.withColumn(key, F.lit(None).cast("bigint")).select(*columns)
    return fill_keys(blank, key, order, start)
