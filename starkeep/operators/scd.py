"""Slowly changing dimensions as DataFrame -> DataFrame merges.

A merge takes the current table and the incoming rows and returns the table's next
state; publishing it is a separate step (``sources.store``). ``run_date`` is always given.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkeep.functions.hashing import change_hash
from starkeep.functions.keys import day
from starkeep.operators.dedup import latest_per_key
from starkeep.operators.joins import left_lookup

# The open ends of a version's validity.
OPEN_START = date(1, 1, 1)
OPEN_END = date(9999, 12, 31)


@dataclass(frozen=True)
class VersionSpec:
    """Columns of a versioned dimension."""

    surrogate: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...] = ()
    others: tuple[str, ...] = ()
    start: str = "scd_start_date"
    end: str = "scd_end_date"
    current: str = "is_current"
    version: str = "scd_version"
    hash: str = "scd_hash"

    @property
    def attributes(self) -> tuple[str, ...]:
        return (*self.keys, *self.others, *self.tracked)

    @property
    def columns(self) -> tuple[str, ...]:
        life = (self.start, self.end, self.current, self.version, self.hash)
        return (self.surrogate, *self.attributes, *life)

    def reserved(self) -> Column:
        """Unknown and not-applicable members; new rows have no key yet."""
        return F.coalesce(F.col(self.surrogate) <= 0, F.lit(False))

    def has_key(self) -> Column:
        return reduce(or_, [F.col(k).isNotNull() for k in self.keys])


def _stage(incoming: DataFrame, spec: VersionSpec) -> DataFrame:
    """Incoming rows with their hash. All-NULL keys belong to the unknown member."""
    rows = incoming.filter(spec.has_key()).select(*spec.attributes)
    return rows.withColumn(spec.hash, change_hash(spec.tracked))


def classify_changes(
    current: DataFrame, incoming: DataFrame, spec: VersionSpec
) -> DataFrame:
    """Incoming rows with their hash and ``change``: new, changed or unchanged."""
    live = current.filter(F.col(spec.current) & ~spec.reserved()).select(
        *[F.col(k).alias(f"_{k}") for k in spec.keys], F.col(spec.hash).alias("_live")
    )
    staged = _stage(incoming, spec)
    same = [staged[k].eqNullSafe(live[f"_{k}"]) for k in spec.keys]
    joined = staged.join(live, reduce(and_, same), "left")
    change = (
        F.when(F.col("_live").isNull(), "new")
        .when(F.col("_live") != F.col(spec.hash), "changed")
        .otherwise("unchanged")
    )
    return joined.select(*staged.columns, change.alias("change"))


def change_counts(
    current: DataFrame, incoming: DataFrame, spec: VersionSpec
) -> DataFrame:
    """Rows per change class, one pass."""
    classes = classify_changes(current, incoming, spec).groupBy("change")
    return classes.agg(F.count("*").alias("n_rows"))


def scd2_merge(
    current: DataFrame,
    incoming: DataFrame,
    spec: VersionSpec,
    run_date: date,
    expire_missing: bool = False,
) -> DataFrame:
    """Next state of a versioned dimension. New versions have no surrogate yet.

    ``incoming`` has one row per natural key. A key's first version is open to the past;
    a changed key's current version ends on the run date and the next one starts there. A
    second change on the same day replaces that day's version and keeps its surrogate.
    Keys that are not in ``incoming`` stay, or expire with ``expire_missing``.

    Both tables go through one shuffle on the natural key (grouping is null-safe), where
    a key's few versions meet its incoming row. Reserved members do not take part.
    """
    today = day(run_date)
    old = current.filter(~spec.reserved()).select(*spec.columns)
    rows = old.withColumn("_staged", F.lit(False)).unionByName(
        _stage(incoming, spec).withColumn("_staged", F.lit(True)),
        allowMissingColumns=True,
    )
    key = Window.partitionBy(*spec.keys)
    is_live = ~F.col("_staged") & F.col(spec.current)

    def of_live(name: str) -> Column:
        return F.max(F.when(is_live, F.col(name))).over(key)

    rows = rows.withColumns(
        {
            "_live_hash": of_live(spec.hash),
            "_live_start": of_live(spec.start),
            "_live_version": of_live(spec.version),
            "_live_key": of_live(spec.surrogate),
            "_next_hash": F.max(F.when(F.col("_staged"), F.col(spec.hash))).over(key),
            "_top": F.max(spec.version).over(key),
        }
    )
    fresh = F.col("_staged") & ~F.col("_live_hash").eqNullSafe(F.col(spec.hash))
    same_day = F.coalesce(F.col("_live_start") == today, F.lit(False))
    superseded = is_live & (F.col("_next_hash") != F.col("_live_hash"))
    if expire_missing:
        superseded = superseded | (is_live & F.col("_next_hash").isNull())
    superseded = F.coalesce(superseded, F.lit(False))
    replaced = superseded & same_day & F.col("_next_hash").isNotNull()

    rows = rows.filter(F.when(F.col("_staged"), fresh).otherwise(~replaced))
    too_early = F.raise_error("run date lies before the current version's start")
    first_day = (
        F.when(F.col("_top").isNull(), day(OPEN_START))
        .when(F.col("_live_start") > today, too_early.cast("date"))
        .otherwise(today)
    )
    number = F.when(same_day, F.col("_live_version")).otherwise(
        F.coalesce(F.col("_top"), F.lit(0)) + 1
    )
    staged = F.col("_staged")
    end = F.when(staged, day(OPEN_END)).when(superseded, today)
    updates = {
        spec.surrogate: F.when(staged & same_day, F.col("_live_key")).otherwise(
            F.col(spec.surrogate)
        ),
        spec.start: F.when(staged, first_day).otherwise(F.col(spec.start)),
        spec.end: end.otherwise(F.col(spec.end)),
        spec.current: staged | (F.col(spec.current) & ~superseded),
        spec.version: F.when(staged, number).otherwise(F.col(spec.version)),
    }
    types = {f.name: f.dataType for f in old.schema.fields}
    rows = rows.select(
        *[
            updates.get(c, F.col(c)).cast(types[c]).alias(c)
            for c in spec.columns
        ]
    )
    return current.filter(spec.reserved()).select(*spec.columns).unionByName(rows)


def scd2_history(
    snapshots: DataFrame, spec: VersionSpec, snapshot_date: str
) -> DataFrame:
    """All versions in one pass from dated snapshots (one row per key and day).

    The same result as merging the snapshots day by day. Per key there are at most as
    many rows as days. No surrogate is assigned.
    """
    timeline = Window.partitionBy(*spec.keys).orderBy(snapshot_date)
    staged = snapshots.filter(spec.has_key()).select(
        *spec.attributes, F.col(snapshot_date), change_hash(spec.tracked).alias(spec.hash)
    )
    before = F.lag(spec.hash).over(timeline)
    points = staged.filter(F.col(snapshot_date).isNotNull()).withColumn("_before", before)
    points = points.filter(~F.col("_before").eqNullSafe(F.col(spec.hash)))
    number = F.row_number().over(timeline)
    following = F.lead(snapshot_date).over(timeline)
    points = points.withColumns({"_number": number, "_following": following})
    start = F.when(F.col("_number") == 1, day(OPEN_START))
    return points.select(
        *spec.attributes,
        start.otherwise(F.col(snapshot_date)).alias(spec.start),
        F.coalesce("_following", day(OPEN_END)).alias(spec.end),
        F.col("_following").isNull().alias(spec.current),
        F.col("_number").cast("smallint").alias(spec.version),
        spec.hash,
    )


def new_rows(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Incoming rows, one per key, whose key the target does not have."""
    known = target.select(*[F.col(k).alias(f"_{k}") for k in keys])
    rows = latest_per_key(incoming, keys)
    same = reduce(and_, [rows[k].eqNullSafe(known[f"_{k}"]) for k in keys])
    return rows.join(known, same, "left_anti")


def scd0_insert(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Add rows whose key is not there yet; existing rows stay as they are.

    Columns that ``incoming`` lacks (a surrogate) are NULL in the new rows.
    """
    new = new_rows(target, incoming, keys)
    return target.unionByName(new, allowMissingColumns=True).select(*target.columns)


def scd1_upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Insert or overwrite by natural key (unique on both sides).

    ``update`` names the overwritten columns, by default all non-key columns of
    ``incoming``. Columns that only ``target`` has (a surrogate) are kept, and are NULL
    in new rows.
    """
    update = set(incoming.columns) - set(keys) if update is None else set(update)
    old = target.withColumn("_old", F.lit(True)).alias("t")
    new = incoming.withColumn("_new", F.lit(True)).alias("s")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    joined = old.join(new, reduce(and_, same), "full_outer")
    arrived = F.col("s._new").isNotNull()
    inserted = F.col("t._old").isNull()

    def value(name: str) -> Column:
        if name not in incoming.columns:
            return F.col(f"t.{name}")
        take_new = arrived if name in update else inserted
        return F.when(take_new, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))

    types = dict(target.dtypes)
    return joined.select(*[value(c).cast(types[c]).alias(c) for c in target.columns])


def changed_rows(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Incoming rows that are new or differ from the target's row of the same key."""
    columns = [c for c in incoming.columns if c not in keys]
    old = target.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.struct(*columns).alias("_old")
    )
    same = [incoming[k].eqNullSafe(old[f"_{k}"]) for k in keys]
    joined = incoming.join(old, reduce(and_, same), "left")
    equal = F.struct(*columns).eqNullSafe(F.col("_old"))
    return joined.filter(~equal).select(*incoming.columns)


def spread_attribute(
    dimension: DataFrame, source: DataFrame, on: str, column: str
) -> DataFrame:
    """Give every version of a member the source's value: overwrite inside history.

    A NULL value, or a member the source lacks, changes nothing; repeating it changes
    nothing either.
    """
    known = source.filter(F.col(on).isNotNull() & F.col(column).isNotNull())
    names = latest_per_key(known.select(on, column), [on])
    found = left_lookup(dimension, names, {on: on}, {column: "_spread"})
    value = F.coalesce("_spread", F.col(column))
    return found.withColumn(column, value).select(*dimension.columns)
