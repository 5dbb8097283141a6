"""Snapshots that arrive late: spliced into chains of versions that are there already.

A chain alone does not say on which days its key was seen unchanged, and a late snapshot may end a version only up
to the next such day. So the days on which keys were seen are kept beside the dimension (``sightings``:
key, day and change hash, no attributes). Only chains of keys that arrive late are derived again.
"""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkeep.functions.hashing import change_hash
from starkeep.functions.keys import day
from starkeep.operators.asof import valid_on
from starkeep.operators.scd import OPEN_END, OPEN_START, VersionSpec


def sightings(snapshots: DataFrame, spec: VersionSpec, snapshot_date: str) -> DataFrame:
    """``(keys, day, hash)`` of dated snapshots, one row a key and day; NULL days and all-NULL keys have none."""
    rows = snapshots.filter(spec.has_key() & F.col(snapshot_date).isNotNull())
    return rows.select(*spec.keys, snapshot_date, change_hash(spec.tracked).alias(spec.hash))


def _matched(left: DataFrame, right: DataFrame, columns, how: str) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in columns], *[c for c in right.columns if c not in columns])
    same = reduce(and_, [left[c].eqNullSafe(renamed[f"_{c}"]) for c in columns])
    joined = left.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_{c}" for c in columns])


def add_sightings(
    seen: DataFrame, late: DataFrame, spec: VersionSpec, snapshot_date: str
) -> DataFrame:
    """The sightings after ``late`` was loaded; a key's day that is delivered again counts as delivered last."""
    new = sightings(late, spec, snapshot_date)
    kept = _matched(seen, new, [*spec.keys, snapshot_date], "left_anti")
    return kept.unionByName(new)


def scd2_splice(
    current: DataFrame,
    seen: DataFrame,
    late: DataFrame,
    spec: VersionSpec,
    snapshot_date: str,
) -> DataFrame:
    """Next state of a versioned dimension after dated snapshots that may lie anywhere in time.

    ``late`` has one row a key and day with the spec's attributes, ``seen`` the sightings the current state was made
    from. The result is the one that loading all snapshots in the order of their days gives: a late snapshot splits the version
    it falls into, moves a neighbour's bounds, or changes nothing. A version that is still there keeps its surrogate; of the
    pieces of a split one the earliest keeps it; new ones have none yet. A version whose every day was
    delivered again with other values is gone. Keys that ``late`` does not hold, and reserved members, stay as they are.
    """
    keys = list(spec.keys)
    late = late.filter(spec.has_key() & F.col(snapshot_date).isNotNull())
    late = late.select(*spec.attributes, snapshot_date, change_hash(spec.tracked).alias(spec.hash))
    touched = late.select(*keys).distinct()
    chains = current.filter(~spec.reserved())
    apart = _matched(chains, touched, keys, "left_anti").select(*spec.columns)
    old = _matched(chains, touched, keys, "left_semi")

    # what was seen before takes its attributes from the version that shows it
    before = _matched(seen, touched, keys, "left_semi")
    before = _matched(before, late.select(*keys, snapshot_date), [*keys, snapshot_date], "left_anti")
    shown = [F.col(f"o.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, spec.hash)]
    inside = valid_on(F.col(f"s.{snapshot_date}"), F.col(f"o.{spec.start}"), F.col(f"o.{spec.end}"))
    attributes = [c for c in spec.attributes if c not in keys]

    def with_version(rows: DataFrame) -> DataFrame:
        names = [F.col(f"s.{c}") for c in rows.columns]
        version = F.struct(*[F.col(f"o.{c}") for c in attributes]).alias("_shown")
        joined = rows.alias("s").join(old.alias("o"), reduce(and_, shown) & inside, "left")
        return joined.select(*names, F.col(f"o.{spec.surrogate}").alias("_key"), version)

    kept = with_version(before).select(
        *keys, snapshot_date, spec.hash, "_key", *[F.col(f"_shown.{c}").alias(c) for c in attributes]
    )
    days = kept.unionByName(with_version(late).drop("_shown"))

    timeline = Window.partitionBy(*keys).orderBy(snapshot_date)
    changed = ~F.lag(spec.hash).over(timeline).eqNullSafe(F.col(spec.hash))
    days = days.withColumn("_point", changed.cast("int"))
    days = days.withColumn("_number", F.sum("_point").over(timeline))
    first = F.struct(snapshot_date, *attributes, spec.hash)
    points = days.groupBy(*keys, "_number").agg(
        F.min_by(first, snapshot_date).alias("_first"),
        F.min_by("_key", F.when(F.col("_key").isNotNull(), F.col(snapshot_date))).alias("_key"),
    )
    order = Window.partitionBy(*keys).orderBy("_number")
    earlier = Window.partitionBy(*keys, "_key").orderBy("_number")
    points = points.withColumns(
        {
            "_following": F.lead(f"_first.{snapshot_date}").over(order),
            "_claims": F.row_number().over(earlier),
        }
    )
    types = dict(current.dtypes)
    values = {
        spec.surrogate: F.when(F.col("_claims") == 1, F.col("_key")),
        spec.start: F.when(F.col("_number") == 1, day(OPEN_START)).otherwise(F.col(f"_first.{snapshot_date}")),
        spec.end: F.coalesce("_following", day(OPEN_END)),
        spec.current: F.col("_following").isNull(),
        spec.version: F.col("_number"),
        spec.hash: F.col(f"_first.{spec.hash}"),
    } | {c: F.col(f"_first.{c}") for c in attributes}
    spliced = points.select(
        *[values.get(c, F.col(c)).cast(types[c]).alias(c) for c in spec.columns]
    )
    reserved = current.filter(spec.reserved()).select(*spec.columns)
    return reserved.unionByName(apart).unionByName(spliced)
