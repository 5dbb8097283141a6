"""A run that costs what has changed, with the result of a whole one.

A ledger lists the landed files that earlier runs have worked through. A run reads the new ones, merges them into
the cleaned tables and finds the facts they can change:

* incidents that were reported or corrected;
* incidents of hours that were observed;
* incidents whose key and day lie in a version that is new to the facts.

Only these are assembled again, and only the years are written in which one of them differs from its published fact.
What each table was made from is kept in its pointer, and the ledger is written last: a run that ends halfway
is made good by the next one.
"""

from collections.abc import Mapping
from datetime import date, timedelta
from functools import partial, reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.functions.keys import date_key, day, hour_key
from starkeep.operators.asof import valid_on
from starkeep.operators.dedup import latest_per_key
from starkeep.operators.joins import sized
from starkeep.operators.scd import OPEN_START, VersionSpec
from starkeep.plans import cleaning, schemas
from starkeep.plans.warehouse import (
    VERSIONED,
    incoming_locations,
    incoming_types,
    load_incident_facts,
    load_versioned,
    load_weather,
    seed,
    together,
)
from starkeep.sources.files import materialize
from starkeep.sources.landing import empty, landed_days, landed_files, read_csv
from starkeep.sources.manifest import Counted, relative, require_complete
from starkeep.sources.store import TableStore, in_values
from starkeep.sources.tables import YEAR_COLUMN, newest_snapshot, without_triage
from starkeep.sources.windows import LOOKBACK_DAYS

LEDGER = "ledger"
NEWEST_TYPES = "newest_types"
# The feeds and how their files end.
SUFFIXES = {"incidents": ".csv", "codes": ".csv", "areas": ".csv", "weather": ".json"}
SPECS = {"dim_location": schemas.LOCATION, "dim_crime_type": schemas.INCIDENT_TYPE}


# The ledger.


def pending_files(
    store: TableStore, landing: str, lookback: int = LOOKBACK_DAYS
) -> dict[str, dict[date, list[str]]]:
    """Landed files by source and ingest date that the ledger does not list.

    Files may still land under a date that was worked through: dates up to ``lookback`` days before the
    source's last one are listed again, older ones are not. Without a ledger everything is pending.
    """
    spark = store.spark
    known, last = {}, {}
    if store.exists(LEDGER):
        ledger = store.read(LEDGER)
        found = ledger.groupBy("source").agg(F.max("ingest_date").alias("last")).collect()
        last = {r["source"]: r["last"] for r in found}
        if last:
            since = min(last.values()) - timedelta(days=lookback)
            recent = ledger.filter(
                (F.col("ingest_month") >= since.strftime("%Y-%m")) & (F.col("ingest_date") >= since)
            )
            for row in recent.select("source", "file").toLocalIterator():
                known.setdefault(row["source"], set()).add(row["file"])
    out = {}
    for source, suffix in SUFFIXES.items():
        days = None
        if source in last:
            since = last[source] - timedelta(days=lookback)
            days = [d for d in landed_days(spark, landing, source) if d >= since]
        seen = known.get(source, set())
        out[source] = {}
        for landed, files in landed_files(spark, landing, source, suffix, days).items():
            new = [f for f in files if relative(f) not in seen]
            if new:
                out[source][landed] = new
    return out


def _enter(store: TableStore, pending: Mapping, run_date: date) -> None:
    """Add the files to the ledger, which is kept by month of ingest."""
    rows = [
        (source, landed, relative(file), run_date, landed.strftime("%Y-%m"))
        for source, by_day in pending.items()
        for landed, files in by_day.items()
        for file in files
    ]
    names = "source string, ingest_date date, file string, run_date date, ingest_month string"
    entries = store.spark.createDataFrame(rows, names)
    months = sorted({r[-1] for r in rows})
    if store.exists(LEDGER):
        kept = store.read(LEDGER).filter(in_values("ingest_month", months))
        entries = kept.unionByName(entries).distinct()
    store.publish(LEDGER, entries, "ingest_month", months)


# Cleaned tables.


def _merge_lookup(store: TableStore, landing: str, source: str, key: str, load, run_date, by_day) -> None:
    """A lookup's later deliveries overwrite earlier ones; a late delivery has it cleaned from all files."""
    table = f"clean_{source}"
    if not by_day:
        if not store.exists(table):
            store.publish(table, load(store.spark, landing, source, run_date), YEAR_COLUMN)
        return
    newest = store.made_from(table).get("newest")
    in_order = newest is not None and min(by_day) > date.fromisoformat(newest)
    files = [f for found in by_day.values() for f in found] if in_order else None
    rows = load(store.spark, landing, source, run_date, files)
    last = max([*by_day, *([date.fromisoformat(newest)] if newest else [])])
    if in_order:
        cleaning.merge_snapshot(store, table, key, rows, run_date, last)
    else:
        store.publish(table, rows, YEAR_COLUMN, made_from={"newest": last.isoformat()})


def _merge_incidents(store: TableStore, landing: str, files: list[str]):
    """The batch, and the incidents it names as they are now."""
    table = "clean_incidents"
    raw = read_csv(store.spark, landing, "incidents", files=files) if files else None
    if raw is None:
        batch = empty(store.spark, schemas.INCIDENTS)
        if not store.exists(table):
            store.publish(table, batch, YEAR_COLUMN)
        return batch, batch
    counted = Counted(raw)
    batch = cleaning.incident_batch(counted.df)
    require_complete(store.spark, landing, "incidents", files, counted.rows)
    years = cleaning.merge_incidents(store, table, batch)
    now = without_triage(store.read(table).filter(in_values(YEAR_COLUMN, years)))
    named = sized(batch.select("id").distinct(), batch.count())
    return batch, materialize(now.join(named, "id", "left_semi"), "fresh")


def _merge_weather(store: TableStore, landing: str, files: list[str]) -> DataFrame:
    rows = cleaning.load_weather(store.spark, landing, "weather", files)
    rows = materialize(rows, "weather")
    cleaning.merge_weather(store, "clean_weather", rows, files)
    return rows


# Dimensions.


def newest_types(store: TableStore, batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """The latest report of each code, kept as a table.

    A report of the batch replaces its own older version and competes with the others'. Only a code whose latest
    report has moved to another code is looked for among all incidents. Of the batch only what meets the known reports,
    of which there is one a code, goes into the joins.
    """
    columns = ["iucr", "primary_type", "description", "fbi_code", "updated_on", "date", "id"]
    order = [F.col(c).desc_nulls_last() for c in ("updated_on", "date", "id")]
    incidents = without_triage(store.read("clean_incidents"))
    if not store.exists(NEWEST_TYPES):
        rows = incidents.filter(F.col("iucr").isNotNull()).select(*columns)
        return store.publish(NEWEST_TYPES, latest_per_key(rows, ["iucr"], order))
    known = store.read(NEWEST_TYPES)
    if batch.isEmpty():
        return known
    fresh = fresh.filter(F.col("iucr").isNotNull()).select(*columns)
    n = known.count()

    def met(rows: DataFrame, *keys: str) -> DataFrame:
        """Keys of the rows that are known ones."""
        return rows.select(*keys).join(sized(known.select(*keys), n), [*keys], "left_semi").distinct()

    named = known.join(sized(met(batch, "id"), n), "id", "left_semi")
    stayed = sized(met(fresh, "iucr", "id"), n)
    moved = materialize(named.join(stayed, ["iucr", "id"], "left_anti").select("iucr"), "moved")
    rows = known.join(sized(named.select("iucr"), n), "iucr", "left_anti").unionByName(fresh)
    codes = [r[0] for r in moved.limit(1000).collect()]
    if len(codes) < 1000:
        again = incidents.filter(F.col("iucr").isin(codes)) if codes else None
    else:
        again = incidents.join(sized(moved), "iucr", "left_semi")
    if again is not None:
        rows = rows.unionByName(again.select(*columns))
    return store.publish(NEWEST_TYPES, latest_per_key(rows, ["iucr"], order))


def _location_rows(store: TableStore, fresh: DataFrame) -> DataFrame:
    """Places of the batch, and those of areas whose indicators changed."""
    keys = schemas.LOCATION.keys
    incidents = without_triage(store.read("clean_incidents")).select(*keys)
    areas = newest_snapshot(store.read("clean_areas"))
    changed = store.changed_since("clean_areas", "dim_location", [YEAR_COLUMN])
    if changed is None:
        return incoming_locations(incidents, areas)
    changed = materialize(changed.select("community_area").distinct(), "areas")
    places = fresh.select(*keys)
    if not changed.isEmpty():
        places = places.unionByName(incidents.join(changed, "community_area", "left_semi").select(*keys))
    return incoming_locations(places, areas)


# Facts.


def _incidents_in(
    incidents: DataFrame, versions: DataFrame, spec: VersionSpec
) -> DataFrame:
    """Ids of incidents whose key and day lie in one of the versions; only years that can are read."""
    first = versions.agg(F.min(spec.start)).first()[0]
    if first is None:
        return incidents.select("id").limit(0)
    rows = incidents.filter(F.col(YEAR_COLUMN) >= first.year).alias("f")
    found = sized(versions).alias("v")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"v.{k}")) for k in spec.keys]
    inside = valid_on(F.to_date("f.date"), F.col(f"v.{spec.start}"), F.col(f"v.{spec.end}"))
    return rows.join(found, reduce(and_, same) & inside, "left_semi").select("id")


def affected_incidents(
    store: TableStore, fresh: DataFrame, observed: DataFrame
) -> DataFrame | None:
    """Ids of the incidents whose facts may differ; None when that is not known and all may."""
    incidents = without_triage(store.read("clean_incidents"))
    ids = [fresh.select("id")]
    hours = observed.select(
        F.year("obs_time").alias("_year"),
        date_key(F.col("obs_time")).alias("_day"),
        hour_key(F.col("obs_time")).alias("_hour"),
    ).distinct()
    hours = materialize(hours, "hours")
    years = [r[0] for r in hours.select("_year").distinct().collect()]
    if years:
        keyed = incidents.filter(in_values(YEAR_COLUMN, years)).select(
            "id", date_key(F.col("date")).alias("_day"), hour_key(F.col("date")).alias("_hour")
        )
        ids.append(keyed.join(hours, ["_day", "_hour"], "left_semi").select("id"))
    for table in VERSIONED:
        spec = SPECS[table]
        told = (spec.surrogate, *spec.keys, spec.start)
        others = [c for c in spec.columns if c not in told]
        changed = store.changed_since(table, "fact_crime", others)
        if changed is None:
            return None
        # keys that are new as a whole come with incidents of the batch
        later = changed.filter(F.col(spec.start) > day(OPEN_START))
        columns = [spec.surrogate, *spec.keys, spec.start, spec.end]
        new = store.read(table).select(*columns).join(later.select(spec.surrogate), spec.surrogate, "left_semi")
        ids.append(_incidents_in(incidents, materialize(new, table), spec))
    return reduce(DataFrame.unionByName, ids).distinct()


def refresh(store: TableStore, landing: str, run_date: date) -> dict[str, dict[str, int]]:
    """Bring the warehouse up to date with what has landed; returns each step's counts.

    The published tables have the rows, keys included, that ``clean_feeds`` and ``build_warehouse`` would
    give at every run. Nothing pending changes nothing. Arrests do not land as files; ``load_arrests`` loads them.
    """
    spark = store.spark
    pending = pending_files(store, landing)
    if not any(pending.values()):
        return {}
    files = {source: [f for found in days.values() for f in found] for source, days in pending.items()}

    def lookup(source, key, load):
        return partial(_merge_lookup, store, landing, source, key, load, run_date, pending[source])

    merged = together(
        spark,
        incidents=partial(_merge_incidents, store, landing, files["incidents"]),
        weather=partial(_merge_weather, store, landing, files["weather"]),
        codes=lookup("codes", "iucr", cleaning.load_codes),
        areas=lookup("areas", "community_area", cleaning.load_areas),
    )
    batch, fresh = merged["incidents"]
    observed = merged["weather"]

    def types() -> dict[str, int]:
        codes = newest_snapshot(store.read("clean_codes"))
        rows = incoming_types(newest_types(store, batch, fresh), codes)
        return load_versioned(
            store, "dim_crime_type", schemas.INCIDENT_TYPE, schemas.UNKNOWN_TYPE, rows, run_date
        )

    steps = together(
        spark,
        generated=lambda: seed(store),
        dim_location=lambda: load_versioned(
            store,
            "dim_location",
            schemas.LOCATION,
            schemas.UNKNOWN_LOCATION,
            _location_rows(store, fresh),
            run_date,
            spread=("community_area", "community_area_name"),
            made_from={"clean_areas": store.state("clean_areas")},
        ),
        dim_crime_type=types,
        dim_weather=lambda: load_weather(store, observed),
    )
    del steps["generated"]
    names = (*steps, "dim_date", "dim_time_of_day", "dim_crime_flags")
    dims = {name: store.read(name) for name in names}

    incidents = without_triage(store.read("clean_incidents"))
    weather = without_triage(store.read("clean_weather"))
    ids = affected_incidents(store, fresh, observed)
    if ids is not None:
        ids = materialize(ids, "affected")
        incidents = materialize(incidents.join(sized(ids), "id", "left_semi"), "affected")
        years = [r[0] for r in incidents.select(YEAR_COLUMN).distinct().collect()]
        weather = weather.filter(in_values(YEAR_COLUMN, years))
    steps["fact_crime"] = load_incident_facts(store, incidents, weather, dims)
    _enter(store, pending, run_date)
    return steps
