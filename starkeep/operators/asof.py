"""Surrogate keys of the dimension version that was valid on the event's day."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkeep.functions.keys import UNKNOWN_KEY
from starkeep.operators.joins import BROADCAST_ROWS, left_lookup
from starkeep.operators.scd import VersionSpec
from starkeep.sources.files import materialize

RANGE_VERSIONS = 64


def valid_on(day: Column, start: Column, end: Column, closed: str = "left") -> Column:
    """Half-open by default; ``closed="both"`` lets the end day count as well."""
    if closed not in ("left", "both"):
        raise ValueError("closed is 'left' or 'both'")
    return (start <= day) & ((day <= end) if closed == "both" else (day < end))


def active_on(df: DataFrame, day: Column, ranges: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows whose every ``(start, end)`` holds the day; a NULL bound does not exclude."""
    tests = []
    for start, end in ranges:
        tests.append(F.col(start).isNull() | (F.col(start) <= day))
        tests.append(F.col(end).isNull() | (F.col(end) > day))
    return df.filter(reduce(and_, tests))


def asof_key(
    facts: DataFrame,
    dimension: DataFrame,
    spec: VersionSpec,
    event_date: str,
    *,
    on: Mapping[str, str] | None = None,
    default: int = UNKNOWN_KEY,
    broadcast_rows: int = BROADCAST_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Add ``spec.surrogate`` to every fact row; no row is lost or repeated.

    Keys match null-safely. Reserved members never match: a fact whose key is all NULL,
    or whose day lies before the first version, gets ``default``. Of versions that overlap
    the later start counts, and of equal starts the larger surrogate, whichever way is taken.

    A small dimension is broadcast and the day range is checked on the fly, which costs a
    fact one comparison per version of its key. A large dimension, or one with many
    versions per key, is resolved once per distinct (key, day), which a hot key has only
    as many of as there are days, and the answers are looked up by equality. ``probe`` is a cheaper
    frame with the same keys and days, where ``facts`` is the outcome of earlier joins.
    """
    on = dict(on or {k: k for k in spec.keys})
    versions = _apart(dimension.filter(F.col(spec.surrogate) > 0), spec)
    if _few(versions, spec.keys, broadcast_rows):
        return _by_range(facts, versions, spec, on, event_date, default)
    probe = facts if probe is None else probe
    answers = materialize(_answers(probe, versions, spec, on, event_date), "answers")
    return left_lookup(
        facts,
        answers,
        {fact: fact for fact in (*on, event_date)},
        {spec.surrogate: spec.surrogate},
        null_safe=True,
        defaults={spec.surrogate: default},
        broadcast_rows=broadcast_rows,
        probe=probe,
    )


def _apart(versions: DataFrame, spec: VersionSpec) -> DataFrame:
    """One version per key and start, each ending where the next one starts at the latest."""
    last = F.max_by(F.struct(spec.end, spec.surrogate), spec.surrogate).alias("_v")
    one = versions.groupBy(*spec.keys, spec.start).agg(last)
    following = F.lead(spec.start).over(Window.partitionBy(*spec.keys).orderBy(spec.start))
    end = F.least(F.col(f"_v.{spec.end}"), following).alias(spec.end)
    return one.select(*spec.keys, spec.start, end, f"_v.{spec.surrogate}")


def _few(versions: DataFrame, keys: Sequence[str], rows: int) -> bool:
    """At most ``rows`` versions in all and ``RANGE_VERSIONS`` of any key."""
    sizes = versions.limit(rows + 1).groupBy(*keys).agg(F.count("*").alias("n"))
    n, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
    return n <= rows and (most or 0) <= RANGE_VERSIONS


def _by_range(facts, versions, spec, on, event_date, default) -> DataFrame:
    same = [F.col(f"f.{a}").eqNullSafe(F.col(f"d.{b}")) for a, b in on.items()]
    inside = valid_on(
        F.col(f"f.{event_date}"), F.col(f"d.{spec.start}"), F.col(f"d.{spec.end}")
    )
    joined = facts.alias("f").join(
        F.broadcast(versions).alias("d"), reduce(and_, same) & inside, "left"
    )
    key = F.coalesce(F.col(f"d.{spec.surrogate}"), F.lit(default).cast("bigint"))
    return joined.select("f.*", key.alias(spec.surrogate))


def _answers(facts, versions, spec, on, event_date) -> DataFrame:
    """The valid version for every distinct (key, day) asked for, one row each."""
    names = list(on)
    asked = facts.select(*names, event_date).distinct()
    starts = versions.select(
        *[F.col(b).alias(a) for a, b in on.items()],
        F.col(spec.start).alias(event_date),
        F.struct(spec.end, spec.surrogate).alias("_version"),
    )
    # A version that starts on the asked day counts, so it sorts before the question.
    timeline = starts.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True
    )
    so_far = Window.partitionBy(*names).orderBy(event_date, "_asked")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("_version", ignorenulls=True).over(so_far)
    return (
        timeline.withColumn("_last", last)
        .filter(F.col("_asked") & (F.col(event_date) < F.col(f"_last.{spec.end}")))
        .select(*names, event_date, F.col(f"_last.{spec.surrogate}"))
    )


def asof_key_closed(
    facts: DataFrame,
    dimension: DataFrame,
    spec: VersionSpec,
    event_date: str,
    default: int = UNKNOWN_KEY,
) -> DataFrame:
    """The original's reading, both ends included: an event on the day a version ended
    matches two versions and is repeated. Only for comparison; facts use :func:`asof_key`.
    """
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"d.{k}")) for k in spec.keys]
    inside = valid_on(
        F.col(f"f.{event_date}"),
        F.col(f"d.{spec.start}"),
        F.col(f"d.{spec.end}"),
        closed="both",
    )
    versions = dimension.select(*spec.keys, spec.start, spec.end, spec.surrogate)
    joined = facts.alias("f").join(
        versions.alias("d"), reduce(and_, same) & inside, "left"
    )
    key = F.coalesce(F.col(f"d.{spec.surrogate}"), F.lit(default).cast("bigint"))
    return joined.select("f.*", key.alias(spec.surrogate))
