"""Data-quality gates. Each returns a small DataFrame; nothing is repaired."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.functions.hashing import fingerprint
from starkeep.operators.scd import VersionSpec


@dataclass(frozen=True)
class Contract:
    """A table's schema (``nullable=False`` is enforced) and its unique keys."""

    schema: T.StructType
    unique: tuple[tuple[str, ...], ...] = ()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)``, one row per table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile(landed: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Landed rows against loaded rows: how many, and how many distinct keys are lost."""
    have = landed.groupBy(key).agg(F.count("*").alias("_landed"))
    got = loaded.groupBy(key).agg(F.count("*").alias("_loaded"))
    both = have.join(got, have[key].eqNullSafe(got[key]), "full_outer")
    missing = F.col("_landed").isNotNull() & F.col("_loaded").isNull()
    extra = F.col("_landed").isNull() & F.col("_loaded").isNotNull()
    return both.agg(
        F.coalesce(F.sum("_landed"), F.lit(0)).alias("n_landed"),
        F.coalesce(F.sum("_loaded"), F.lit(0)).alias("n_loaded"),
        F.count(F.when(missing, 1)).alias("n_missing"),
        F.count(F.when(extra, 1)).alias("n_extra"),
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL keys are not compared."""
    counts = df.dropna(how="any", subset=list(keys)).groupBy(*keys)
    return counts.agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def orphans(facts: DataFrame, key: str, dimension: DataFrame, member: str) -> DataFrame:
    """Foreign keys without a member, NULL included, and how many rows have them.

    Facts are counted per key before the join, so a hot key is one row in it. Both sides are grouped by the key
    by then and are merged as they lie; a dimension may have as many members as there are facts.
    """
    used = facts.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n_rows"))
    members = dimension.select(F.col(member).alias("_member")).distinct()
    return used.join(members.hint("merge"), F.col("key") == F.col("_member"), "left_anti")


def version_faults(dimension: DataFrame, spec: VersionSpec) -> DataFrame:
    """Natural keys whose versions are not one gap-free chain with one current row."""
    rows = dimension.filter(~spec.reserved())
    chain = Window.partitionBy(*spec.keys).orderBy(spec.start)
    following = F.lead(spec.start).over(chain)
    rows = rows.withColumn("_following", following)
    broken = F.col("_following").isNotNull() & (F.col("_following") != F.col(spec.end))
    return (
        rows.groupBy(*spec.keys)
        .agg(
            F.count(F.when(F.col(spec.current), 1)).alias("n_current"),
            F.count(F.when(broken, 1)).alias("n_broken"),
        )
        .filter("n_current <> 1 OR n_broken > 0")
    )


def schema_drift(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """``(column, expected, found)`` for each difference in order or type."""
    want = [(f.name, f.dataType.simpleString()) for f in contract.schema.fields]
    width = max(len(want), len(df.dtypes))
    padded = [
        pairs + [("", "absent")] * (width - len(pairs)) for pairs in (want, df.dtypes)
    ]
    return [
        (w[0] or f[0], " ".join(w).strip(), " ".join(f).strip())
        for w, f in zip(*padded)
        if w != f
    ]


def drift(df: DataFrame, contract: Contract) -> DataFrame:
    """:func:`schema_drift` as ``(column, expected, found)`` rows."""
    rows = schema_drift(df, contract)
    return df.sparkSession.createDataFrame(rows, "column string, expected string, found string")


class GateError(ValueError):
    """A table that breaks its contract; it is not published."""


def require(table: str, *reports: DataFrame) -> None:
    """Raise for any report ``(rule, n_violations)`` with violations."""
    rows = reduce(DataFrame.unionByName, reports).filter("n_violations > 0")
    found = [f"{r['rule']} ({r['n_violations']})" for r in rows.limit(20).collect()]
    if found:
        raise GateError(f"{table}: {'; '.join(sorted(found))}")


def version_violations(dimension: DataFrame, spec: VersionSpec) -> DataFrame:
    """How many natural keys have a broken chain of versions, as ``(rule, n_violations)``."""
    faults = version_faults(dimension, spec).agg(F.count("*").alias("n_violations"))
    return faults.select(F.lit("versions").alias("rule"), "n_violations")


def orphan_violations(
    facts: DataFrame, members: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """How many rows have a foreign key without a member, as ``(rule, n_violations)``."""
    parts = []
    for key, (dimension, member) in members.items():
        rows = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_violations")
        lost = orphans(facts, key, dimension, member).agg(rows)
        parts.append(lost.select(F.lit(f"member: {key}").alias("rule"), "n_violations"))
    return reduce(DataFrame.unionByName, parts)


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``(rule, n_violations)`` for every not-null column and unique key.

    All not-null rules share one scan; each unique key is one grouping.
    """
    required = [f.name for f in contract.schema.fields if not f.nullable]
    parts = []
    spark = df.sparkSession
    if not required and not contract.unique:
        return spark.createDataFrame([], "rule string, n_violations long")
    if required:
        nulls = df.agg(
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required]
        )
        pairs = [
            F.struct(F.lit(f"not null: {c}").alias("rule"), F.col(c).alias("n_violations"))
            for c in required
        ]
        parts.append(nulls.select(F.inline(F.array(*pairs))))
    for keys in contract.unique:
        rule = F.lit(f"unique: {', '.join(keys)}").alias("rule")
        parts.append(
            duplicates(df, keys).agg(F.count("*").alias("n_violations")).select(
                rule, "n_violations"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def same_content(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: both counts, and whether the tables hold the same rows."""
    a = fingerprint(left).select(F.struct("*").alias("a"))
    b = fingerprint(right.select(*left.columns)).select(F.struct("*").alias("b"))
    both = a.select("a", b.scalar().alias("b"))
    return both.select(
        F.col("a.n_rows").alias("n_left"),
        F.col("b.n_rows").alias("n_right"),
        (F.col("a") == F.col("b")).alias("same"),
    )
