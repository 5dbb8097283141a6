"""Multi-valued dimensions: several members per parent row."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.sources.files import materialize

#: Members of a parent that one task pairs with the others.
SPLIT = 1024


def bridge_from_columns(
    df: DataFrame, parent: str, groups: Sequence[Mapping[str, str]], member: str
) -> DataFrame:
    """Repeated column groups to ``(parent, position, fields)``.

    Each group maps output field to source column; a group without a ``member`` gives no
    row but keeps its position.
    """
    structs = [F.struct(*[F.col(c).alias(f) for f, c in g.items()]) for g in groups]
    rows = df.select(parent, F.posexplode(F.array(*structs)).alias("_pos", "_item"))
    return rows.filter(F.col(f"_item.{member}").isNotNull()).select(
        parent, (F.col("_pos") + 1).cast("int").alias("position"), "_item.*"
    )


def bridge_from_list(
    df: DataFrame, parent: str, column: str, member: str, delimiter: str = "|"
) -> DataFrame:
    """A delimited list to ``(parent, position, member)``; empty entries give no row."""
    entries = F.split(F.col(column), f"\\Q{delimiter}\\E")
    rows = df.select(parent, F.posexplode(entries).alias("_pos", "_item"))
    value = F.trim("_item")
    return rows.filter(value != "").select(
        parent, (F.col("_pos") + 1).cast("int").alias("position"), value.alias(member)
    )


def bridge_from_lists(
    df: DataFrame,
    parent: str,
    lists: Mapping[str, str],
    member: str,
    delimiter: str = "|",
) -> DataFrame:
    """Delimited lists side by side to ``(parent, position, fields)``.

    ``lists`` maps output field to source column; entries of one place belong together. Empty
    entries are NULL, an entry without a ``member`` gives no row but keeps its place, and there may be any number.
    """
    split = [F.split(F.col(c), f"\\Q{delimiter}\\E").alias(f) for f, c in lists.items()]
    rows = df.select(parent, *split)
    rows = rows.select(parent, F.posexplode(F.arrays_zip(*lists)).alias("_pos", "_item"))
    fields = [F.nullif(F.trim(F.col(f"_item.{f}")), F.lit("")).alias(f) for f in lists]
    number = (F.col("_pos") + 1).cast("int").alias("position")
    return rows.select(parent, number, *fields).filter(F.col(member).isNotNull())


def count_members(
    parents: DataFrame, bridge: DataFrame, parent: str, into: str
) -> DataFrame:
    """Parent rows with their number of bridge rows; 0 without any."""
    counts = bridge.groupBy(parent).agg(F.count("*").alias(into))
    joined = parents.join(counts.hint("merge"), parent, "left")
    number = F.coalesce(F.col(into), F.lit(0)).cast("int")
    return joined.withColumn(into, number)


def pair_counts(bridge: DataFrame, parent: str, member: str) -> DataFrame:
    """``(member_a, member_b, n_parents)`` for members of the same parent, a < b.

    Distinct members meet in a join by parent. A parent of many members is split: one side's
    rows get one of several salts, the other side's all of them, so a task forms at most
    ``SPLIT`` times as many pairs as it reads rows. NULL parents and members take no part.
    """
    distinct = materialize(
        bridge.select(parent, member).dropna().distinct(), "bridge-members"
    )
    salts = F.ceil(F.count("*") / SPLIT).cast("int").alias("_salts")
    sizes = distinct.groupBy(parent).agg(salts, F.count("*").alias("_n"))
    sized = distinct.join(sizes.filter("_n > 1").drop("_n"), parent)
    one = F.pmod(F.xxhash64(member), F.col("_salts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    a = sized.select(parent, F.col(member).alias("member_a"), one.alias("_salt"))
    b = sized.select(parent, F.col(member).alias("member_b"), every.alias("_salt"))
    pairs = a.join(b, [parent, "_salt"]).filter("member_a < member_b")
    return pairs.groupBy("member_a", "member_b").agg(F.count("*").alias("n_parents"))
