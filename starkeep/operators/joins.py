"""Left lookups that stay balanced when one key holds a large share of the rows."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkeep.sources.files import materialize

BROADCAST_ROWS = 100_000
HOT_SHARE = 1000  # a key with more than one row in this many is hot, at the least


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most ``rows + 1`` rows; use on published or materialized tables."""
    return df.limit(rows + 1).count() <= rows


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A side of a join, marked by its number of rows: broadcast if these are few, merged otherwise.

    Unmarked, Spark goes by the bytes of the files and the share of the columns in a row's assumed width. By that
    one key of a wide, well compressed table is a few megabytes, and millions of rows are built into a
    hash table on the driver. ``rows`` is their number (or a bound) where it is known; published or materialized tables are
    counted.
    """
    few = fits_broadcast(df, BROADCAST_ROWS) if rows is None else rows <= BROADCAST_ROWS
    return F.broadcast(df) if few else df.hint("merge")


def _match(left: str, right: str, on: Mapping[str, str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{a}"), F.col(f"{right}.{b}")) for a, b in on.items()]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def left_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    *,
    null_safe: bool = False,
    defaults: Mapping[str, object] | None = None,
    bounded: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Add columns of ``lookup`` to every fact row; no fact row is lost or repeated.

    ``on`` maps fact columns to lookup columns, ``take`` maps lookup columns to the new
    names, ``defaults`` fills the new columns on a miss. Of lookup rows with the same key
    the one with the smallest values counts.

    A lookup that is small by count, or ``bounded`` by its making, is broadcast.
    Beyond that both sides are shuffled, with hot keys spread by a salt. ``probe`` is a
    cheaper frame with the same keys to find hot ones in, where ``facts`` is the outcome
    of earlier joins.
    """
    columns = {b: f"_k{i}" for i, b in enumerate(on.values())}
    slim = lookup.select(
        *[F.col(c).alias(k) for c, k in columns.items()],
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(take)],
    )
    keyed = {a: columns[b] for a, b in on.items()}
    values = F.struct(*[f"_t{i}" for i in range(len(take))])
    slim = slim.groupBy(*columns.values()).agg(F.min(values).alias("_v"))
    slim = slim.select(*columns.values(), "_v.*")
    if bounded or fits_broadcast(slim, broadcast_rows):
        condition = _match("f", "l", keyed, null_safe)
        joined = facts.alias("f").join(F.broadcast(slim).alias("l"), condition, "left")
    else:
        hot = hot_keys(facts if probe is None else probe, list(keyed))
        joined = _salted_join(facts, slim, keyed, null_safe, hot)
    defaults = defaults or {}

    def value(i: int, name: str) -> Column:
        col = F.col(f"l._t{i}")
        if name in defaults:
            fill = F.lit(defaults[name]).cast(slim.schema[f"_t{i}"].dataType)
            col = F.coalesce(col, fill)
        return col.alias(name)

    kept = [F.col(f"f.{c}") for c in facts.columns if c not in take.values()]
    return joined.select(*kept, *[value(i, n) for i, n in enumerate(take.values())])


def hot_keys(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that hold more than a thousandth of all rows, or than half a fair partition.

    So there are fewer than a thousand, or than twice the shuffle partitions. Counted once
    and written, because both sides of the join use them.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = facts.count() / max(HOT_SHARE, 2 * partitions)
    counts = facts.groupBy(*keys).agg(F.count("*").alias("_n"))
    return materialize(counts.filter(F.col("_n") > least).select(*keys), "hot-keys")


def _salted_join(
    facts: DataFrame,
    slim: DataFrame,
    on: Mapping[str, str],
    null_safe: bool,
    hot: DataFrame,
) -> DataFrame:
    """Hot facts get one of ``n`` salts from their content, hot lookup rows all ``n``.

    The salt depends on the row alone, so a task that runs again sends each row to the
    same place. Rows with a NULL key, which an ordinary join would send to one task,
    are spread the same way.
    """
    n = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot.withColumn("_hot", F.lit(True))
    marked = facts.alias("f").join(
        F.broadcast(hot).alias("h"), _match("f", "h", {a: a for a in on}, True), "left"
    )
    spread = F.col("h._hot").isNotNull()
    if not null_safe:
        spread = spread | reduce(or_, [F.col(f"f.{a}").isNull() for a in on])
    content = [F.col(f"f.{c}") for c, t in facts.dtypes if not t.startswith("map")]
    salt = F.when(spread, F.pmod(F.xxhash64(*content), F.lit(n))).otherwise(0)
    marked = marked.select("f.*", salt.cast("int").alias("_salt"))

    copies = slim.alias("l").join(
        F.broadcast(hot).alias("h"), _match("h", "l", on, True), "left"
    )
    salts = F.when(F.col("h._hot"), F.sequence(F.lit(0), F.lit(n - 1)))
    copies = copies.select(
        "l.*", F.explode(F.coalesce(salts, F.array(F.lit(0)))).alias("_salt")
    )
    condition = _match("f", "l", on, null_safe)
    condition = condition & (F.col("f._salt") == F.col("l._salt"))
    return marked.alias("f").join(copies.alias("l"), condition, "left")


def enrich(
    base: DataFrame,
    lookup: DataFrame | None,
    on: Mapping[str, str],
    fields: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left enrichment by an optional lookup.

    ``fields`` maps column names to types. Without the lookup they are typed NULLs, or
    their default.
    """
    if lookup is not None:
        take = {name: name for name in fields}
        return left_lookup(base, lookup, on, take, defaults=defaults)
    defaults = defaults or {}
    missing = {n: F.lit(defaults.get(n)).cast(t) for n, t in fields.items()}
    return base.withColumns(missing)
