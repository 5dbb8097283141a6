"""Cleaned tables to the published star."""

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.functions.hashing import change_hash_json
from starkeep.functions.keys import (
    NOT_APPLICABLE_KEY,
    UNKNOWN_KEY,
    date_key,
    elapsed_hours,
    flag_measure,
    hour_key,
)
from starkeep.operators.asof import asof_key
from starkeep.operators.bridge import bridge_from_columns, bridge_from_lists, count_members
from starkeep.operators.dedup import latest_per_key
from starkeep.operators.dimensions import (
    calendar_dimension,
    junk_dimension,
    time_of_day_dimension,
    with_reserved,
)
from starkeep.operators.joins import enrich, left_lookup, sized
from starkeep.operators.quality import (
    Contract,
    GateError,
    contract_violations,
    orphan_violations,
    require,
    version_violations,
)
from starkeep.operators.quarantine import split_rejects, tag_rules
from starkeep.operators.scd import (
    VersionSpec,
    change_counts,
    changed_rows,
    new_rows,
    scd1_upsert,
    scd2_merge,
    spread_attribute,
)
from starkeep.operators.shaping import conform
from starkeep.operators.surrogate import assign_keys, fill_keys
from starkeep.plans import cleaning, schemas
from starkeep.plans.reports import incident_extract
from starkeep.sources.files import materialize
from starkeep.sources.landing import empty
from starkeep.sources.keyindex import KeyIndex
from starkeep.sources.store import NO_VALUE, TableStore, in_values
from starkeep.sources.tables import YEAR_COLUMN, newest_snapshot, without_triage
from starkeep.sources.windows import DayRange

FACT_PARTITION = "fact_year"
LINEAGE = "fact_crime_lineage"
VERSIONED = ("dim_location", "dim_crime_type")
#: Dimensions whose members can change, and the fact's key to each.
EXTRACT_KEYS = {
    "dim_location": "location_key",
    "dim_crime_type": "crime_type_key",
    "dim_weather": "weather_key",
}

# What the arrest feed may hold of a person, and an arrest's own columns.
_PERSON = {"race": "string", "age_band": "string", "sex": "string"}
PERSON = schemas.table(**_PERSON)
ARREST = schemas.table(
    cb_no="long", case_number="string", arrest_date="timestamp_ntz", **_PERSON
)


@dataclass(frozen=True)
class Cleaned:
    """The cleaned tables of one run; optional sources may be None."""

    incidents: DataFrame
    codes: DataFrame | None = None
    areas: DataFrame | None = None
    weather: DataFrame | None = None
    arrests: DataFrame | None = None

    def ready(self) -> "Cleaned":
        """Without triage rows; of snapshot tables only the newest snapshot."""

        def lookup(df: DataFrame | None) -> DataFrame | None:
            return None if df is None else newest_snapshot(df)

        weather = None if self.weather is None else without_triage(self.weather)
        return Cleaned(
            without_triage(self.incidents),
            lookup(self.codes),
            lookup(self.areas),
            weather,
            self.arrests,
        )


def _fields(schema, names) -> dict[str, str]:
    return {n: schema[n].dataType.simpleString() for n in names}


# Dimension rows of one run.


def incoming_locations(incidents: DataFrame, areas: DataFrame | None) -> DataFrame:
    """Distinct places with their area's indicators."""
    spec = schemas.LOCATION
    places = incidents.select(*spec.keys).distinct()
    places = places.withColumn("block", F.lit(None).cast("string"))
    fields = _fields(schemas.AREAS, ("community_area_name", *spec.tracked))
    on = {"community_area": "community_area"}
    return enrich(places, areas, on, fields).select(*spec.attributes)


def incoming_types(incidents: DataFrame, codes: DataFrame | None) -> DataFrame:
    """One row per code as last reported, with its lookup attributes."""
    spec = schemas.INCIDENT_TYPE
    columns = ["iucr", "primary_type", "description", "fbi_code"]
    rows = incidents.filter(F.col("iucr").isNotNull())
    rows = rows.select(*columns, "updated_on", "date", "id")
    newest = [F.col(c).desc_nulls_last() for c in ("updated_on", "date", "id")]
    types = latest_per_key(rows, ["iucr"], newest).select(*columns)
    fields = _fields(schemas.CODES, ("index_code", "active"))
    found = enrich(types, codes, {"iucr": "iucr"}, fields, {"active": True})
    return found.select(*spec.attributes)


def hourly_weather(weather: DataFrame) -> DataFrame:
    """One observation per (date key, hour), the latest of the hour."""
    keyed = weather.filter(F.col("obs_time").isNotNull()).withColumns(
        {"obs_date_key": date_key(F.col("obs_time")), "obs_hour": hour_key(F.col("obs_time"))}
    )
    newest = [F.col("obs_time").desc()]
    return latest_per_key(keyed, ["obs_date_key", "obs_hour"], newest)


def incoming_weather(weather: DataFrame) -> DataFrame:
    names = schemas.CONTRACTS["dim_weather"].schema.names[1:]
    return hourly_weather(weather).select(*names)


# Loads: each publishes a table and returns its counts.


def together(spark: SparkSession, **loads: Callable) -> dict:
    """Run independent loads at the same time, so that small ones share the cluster."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(loads)) as pool:
        started = {name: pool.submit(in_session(f)) for name, f in loads.items()}
        return {name: load.result() for name, load in started.items()}


def _counts(df: DataFrame) -> dict[str, int]:
    return {r["change"]: r["n_rows"] for r in df.collect()}  # three classes


def _seeded(store: TableStore, table: str, rows) -> DataFrame:
    """The published table, or an empty one with its reserved members."""
    if store.exists(table):
        return store.read(table)
    schema = schemas.CONTRACTS[table].schema
    return with_reserved(store.spark.createDataFrame([], schema), rows)


def seed(store: TableStore) -> None:
    """Publish the generated dimensions once."""
    spark = store.spark
    generated = {
        "dim_date": lambda: calendar_dimension(spark),
        "dim_time_of_day": lambda: time_of_day_dimension(spark),
        "dim_crime_flags": lambda: junk_dimension(
            spark, "flags_key", schemas.FLAG_LABELS
        ),
    }
    for table, build in generated.items():
        if not store.exists(table):
            rows = materialize(build(), table)
            require(table, contract_violations(rows, schemas.CONTRACTS[table]))
            store.publish(table, rows)


def load_versioned(
    store: TableStore,
    table: str,
    spec: VersionSpec,
    unknown: Mapping,
    incoming: DataFrame,
    run_date: date,
    spread: tuple[str, str] | None = None,
    made_from: Mapping | None = None,
) -> dict[str, int]:
    """Merge, number the new versions, publish.

    A run without changes publishes nothing. ``spread`` names ``(on, column)`` of an
    attribute that is overwritten in all versions; it is taken from the incoming rows,
    so a new name alone takes effect as well.
    """
    current = _seeded(store, table, [unknown])
    incoming = materialize(incoming, table)
    counts = {"new": 0, "changed": 0, "unchanged": 0}
    counts |= _counts(change_counts(current, incoming, spec))
    renamed = 0
    if spread is not None and store.exists(table):
        renamed = _spread_changes(current, incoming, *spread)
    if counts["new"] + counts["changed"] + renamed == 0 and store.exists(table):
        if made_from is not None:
            store.record(table, made_from)
        return counts
    state = scd2_merge(current, incoming, spec, run_date)
    if spread is not None:
        state = spread_attribute(state, incoming, *spread)
    order = [*spec.keys, spec.start]
    state = materialize(fill_keys(state, spec.surrogate, order), table)
    gate = version_violations(state, spec)
    require(table, gate, contract_violations(state, schemas.CONTRACTS[table]))
    store.publish(table, state, made_from=made_from)
    return counts


def _spread_changes(current: DataFrame, incoming: DataFrame, on: str, column: str) -> int:
    after = spread_attribute(current, incoming, on, column)
    before = current.select(F.col(current.columns[0]).alias("_k"), F.col(column).alias("_c"))
    both = after.join(before, F.col(current.columns[0]) == F.col("_k"))
    return both.filter(~F.col(column).eqNullSafe(F.col("_c"))).count()


def _load_keyed(
    store: TableStore,
    table: str,
    reserved: Sequence[Mapping],
    incoming: DataFrame | None,
    keys: Sequence[str],
    overwrite: bool = False,
) -> dict[str, int]:
    """Insert, and with ``overwrite`` update, by key; nothing to do publishes nothing."""
    current = _seeded(store, table, reserved)
    if incoming is None:
        if not store.exists(table):
            store.publish(table, current)
        return {"skipped": 1}
    find = changed_rows if overwrite else new_rows
    fresh = materialize(find(current, incoming, keys), table)
    n = fresh.count()
    if n or not store.exists(table):
        state = scd1_upsert(current, fresh, keys)
        state = materialize(fill_keys(state, current.columns[0], keys), table)
        require(table, contract_violations(state, schemas.CONTRACTS[table]))
        store.publish(table, state)
    return {"upserted": n}


def load_weather(
    store: TableStore, weather: DataFrame | None, overwrite: bool = False
) -> dict[str, int]:
    """Insert new hours; ``overwrite`` also replaces the attributes of known hours."""
    incoming = None if weather is None else incoming_weather(weather)
    keys = ("obs_date_key", "obs_hour")
    reserved = [schemas.NO_WEATHER]
    return _load_keyed(store, "dim_weather", reserved, incoming, keys, overwrite)


def load_arrestees(store: TableStore, arrests: DataFrame | None) -> dict[str, int]:
    """Distinct demographics; without the source the dimension stays empty."""
    people = None if arrests is None else conform(arrests, PERSON).distinct()
    return _load_keyed(store, "dim_arrestee", [], people, PERSON.names)


# Facts.


def incident_facts(
    incidents: DataFrame, weather: DataFrame | None, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """One fact per incident with all keys and measures; no incident is dropped.

    ``dims`` are the published dimensions. Without a match a key is its reserved member.
    """
    names = schemas.CONTRACTS["fact_crime"].schema.names[1:]
    df = incidents.withColumns(
        {
            "occurrence_date": F.to_date("date"),
            "_occurred": date_key(F.col("date")),
            "_reported": date_key(F.col("updated_on")),
            "occurrence_time_key": hour_key(F.col("date")),
            "hours_to_update": elapsed_hours(F.col("date"), F.col("updated_on")),
            "incident_count": F.lit(1).cast("smallint"),
            "is_arrest": flag_measure(F.col("arrest")),
            "is_domestic": flag_measure(F.col("domestic")),
        }
    ).withColumnRenamed("id", "crime_id")
    base = df  # keys as they are before any join

    # Two roles of one calendar; a day outside it is the unknown day.
    for role, source in {
        "occurrence_date_key": "_occurred",
        "report_date_key": "_reported",
    }.items():
        df = left_lookup(
            df,
            dims["dim_date"],
            {source: "date_key"},
            {"date_key": role},
            defaults={role: UNKNOWN_KEY},
            bounded=True,
        )

    hour = {"_occurred": "obs_date_key", "occurrence_time_key": "obs_hour"}
    measures = ("temperature_celsius", "precipitation_mm")
    if weather is None:
        nulls = _fields(schemas.WEATHER, measures)
        df = df.withColumns({n: F.lit(None).cast(t) for n, t in nulls.items()})
    else:
        observed = materialize(
            hourly_weather(weather).select(*hour.values(), *measures), "weather"
        )
        df = left_lookup(df, observed, hour, {m: m for m in measures}, probe=base)
    df = left_lookup(
        df,
        dims["dim_weather"],
        hour,
        {"weather_key": "weather_key"},
        defaults={"weather_key": NOT_APPLICABLE_KEY},
        probe=base,
    )
    for name, spec in (
        ("dim_location", schemas.LOCATION),
        ("dim_crime_type", schemas.INCIDENT_TYPE),
    ):
        df = asof_key(df, dims[name], spec, "occurrence_date", probe=base)
    df = left_lookup(
        df,
        dims["dim_crime_flags"],
        {"arrest": "is_arrest", "domestic": "is_domestic"},
        {"flags_key": "flags_key"},
        null_safe=True,
        defaults={"flags_key": UNKNOWN_KEY},
        bounded=True,
    )
    return df.select(*names)


def load_incident_facts(
    store: TableStore,
    incidents: DataFrame,
    weather: DataFrame | None,
    dims: Mapping[str, DataFrame],
) -> dict[str, int]:
    """Facts of these incidents, merged into the published ones.

    What is recorded with the facts are the loads of the versioned dimensions, so that the next run can tell
    which versions are new to them.
    """
    members = {
        "occurrence_date_key": (dims["dim_date"], "date_key"),
        "report_date_key": (dims["dim_date"], "date_key"),
        "occurrence_time_key": (dims["dim_time_of_day"], "time_key"),
        "location_key": (dims["dim_location"], "location_key"),
        "crime_type_key": (dims["dim_crime_type"], "crime_type_key"),
        "weather_key": (dims["dim_weather"], "weather_key"),
        "flags_key": (dims["dim_crime_flags"], "flags_key"),
    }
    return load_facts(
        store,
        "fact_crime",
        incident_facts(incidents, weather, dims),
        "crime_pk",
        "crime_id",
        "occurrence_date_key",
        members,
        incidents.select(F.col("id").alias("crime_id")),
        {name: store.state(name) for name in VERSIONED},
    )


# Charge columns of the feed, repeated (``charge_1_type``) or as lists (``charges_type``).
CHARGE_FIELDS = {"iucr": "type", "charge_class": "class", "charge_statute": "statute"}


def arrest_charges(arrests: DataFrame) -> DataFrame:
    """One row per arrest and charge, with its position.

    The delimited lists hold all charges of an arrest, however many. An arrest without
    them has those of its repeated columns, as many as the feed has.
    """
    columns = set(arrests.columns)
    lists = {f: f"charges_{c}" for f, c in CHARGE_FIELDS.items()}
    listed = columns.issuperset(lists.values())
    parts = []
    if listed:
        parts.append(bridge_from_lists(arrests, "cb_no", lists, "iucr"))
        arrests = arrests.filter(F.col(lists["iucr"]).isNull())
    numbers = sorted(int(m[1]) for c in columns if (m := re.fullmatch(r"charge_(\d+)_type", c)))
    if numbers:
        groups = [{f: f"charge_{i}_{c}" for f, c in CHARGE_FIELDS.items()} for i in numbers]
        parts.append(bridge_from_columns(arrests, "cb_no", groups, "iucr"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumnRenamed("position", "charge_position")


def arrest_facts(
    arrests: DataFrame, charges: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """One fact per arrest: constant 1 and the number of its charges."""
    people = {n: n for n in PERSON.names}
    df = conform(arrests, ARREST).withColumns(
        {
            "_arrested": date_key(F.col("arrest_date")),
            "arrest_time_key": hour_key(F.col("arrest_date")),
            "arrest_count": F.lit(1).cast("smallint"),
        }
    )
    base = df
    df = left_lookup(
        df,
        dims["dim_date"],
        {"_arrested": "date_key"},
        {"date_key": "arrest_date_key"},
        defaults={"arrest_date_key": UNKNOWN_KEY},
        bounded=True,
    )
    df = left_lookup(
        df,
        dims["dim_arrestee"],
        people,
        {"arrestee_key": "arrestee_key"},
        null_safe=True,
        probe=base,
    )
    df = count_members(df, charges, "cb_no", "charge_count")
    return df.select(*schemas.CONTRACTS["fact_arrest"].schema.names[1:])


def charge_bridge(
    charges: DataFrame, facts: DataFrame, arrests: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Charges with the arrest's surrogate and the code's version on the arrest day.

    Arrest numbers are unique, so these joins have no hot key. All three frames grow with the arrests and are
    merged, whatever their files' sizes suggest.
    """
    days = conform(arrests, ARREST).select("cb_no", F.to_date("arrest_date").alias("_day"))
    known = facts.select("cb_no", "arrest_pk").join(days.hint("merge"), "cb_no")
    rows = charges.join(known.hint("merge"), "cb_no")
    spec = schemas.INCIDENT_TYPE
    rows = asof_key(rows, dims["dim_crime_type"], spec, "_day")
    return rows.select(*schemas.CONTRACTS["bridge_arrest_charge"].schema.names)


def require_unique(rows: DataFrame, key: str, table: str) -> None:
    """Raise for natural keys that are NULL or repeated."""
    bad = rows.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1))
    found = [r[0] for r in bad.select(key).limit(5).collect()]
    if found:
        raise GateError(f"{table}: {key} missing or repeated, for instance {found}")


def load_facts(
    store: TableStore,
    table: str,
    facts: DataFrame,
    surrogate: str,
    key: str,
    year_of: str,
    members: Mapping[str, tuple[DataFrame, str]] | None = None,
    keys: DataFrame | None = None,
    made_from: Mapping | None = None,
    rejects: date | None = None,
) -> dict[str, int]:
    """Upsert by natural key; known facts keep their surrogate.

    Which facts are new or changed is read from the table's key index (``sources.keyindex``), not from the table;
    with ``keys`` (the incoming keys in a cheap frame) only from the key ranges these lie in. Only the years are
    rewritten that hold incoming rows or their older copies (a corrected
    date moves a fact). A repeated load writes nothing. Before anything is published the new and
    changed facts must pass the gates: natural keys are there and unique, required
    columns are filled, and foreign keys (``members`` maps them to dimension and key) have members.
    ``made_from`` is recorded with the table.

    With ``rejects``, the day of the run, rows that fail do not stop the load: they go to ``<table>_rejects`` with the rules they
    break, under that day, and the others are loaded. A key that is rejected keeps the fact it has.
    """

    def sound(rows: DataFrame) -> DataFrame:
        """The rows to load; raises for bad ones, or sets them aside."""
        if rejects is None:
            gate(rows.drop(surrogate, "_year"))
            return rows
        fields = [T.StructField(key, rows.schema[key].dataType, False)]
        if table in schemas.CONTRACTS:
            contract = schemas.CONTRACTS[table].schema
            fields += [f for f in contract if f.name in rows.columns and f.name not in (key, surrogate)]
        tagged = tag_rules(rows, Contract(T.StructType(fields), ((key,),)), members)
        good, bad = split_rejects(materialize(tagged, table))
        bad = bad.drop(surrogate, "_year").withColumn("run_day", F.lit(rejects))
        store.publish(f"{table}_rejects", bad, "run_day", [rejects])
        return good

    def gate(rows: DataFrame) -> None:
        require_unique(rows, key, table)
        reports = [orphan_violations(rows, members)] if members else []
        if table in schemas.CONTRACTS:
            fields = [f for f in schemas.CONTRACTS[table].schema if f.name in rows.columns]
            reports.append(contract_violations(rows, Contract(T.StructType(fields))))
        if reports:
            require(table, *reports)

    index = KeyIndex(store, table, key, surrogate, FACT_PARTITION)
    year = (F.col(year_of) / 10000).cast("int")
    incoming = facts.withColumn(FACT_PARTITION, year)
    if not store.exists(table):
        staged = sound(materialize(incoming, table))
        # only the keys are sorted to be numbered; the rows are joined once
        keyed = assign_keys(staged.select(key), surrogate, [key])
        numbered = staged.join(keyed.hint("merge"), key).select(surrogate, *incoming.columns)
        published = store.publish(
            table, numbered, FACT_PARTITION, sort_by=[year_of], made_from=made_from
        )
        index.rebuild()
        return {"upserted": published.count()}
    current = store.read(table)
    types = dict(current.dtypes)
    incoming = incoming.select(*[F.col(c).cast(types[c]).alias(c) for c in incoming.columns])
    known = index.read(keys).select(key, surrogate, F.col(FACT_PARTITION).alias("_year"), "digest")
    columns = sorted(c for c in incoming.columns if c != key)
    same = change_hash_json(columns).eqNullSafe(F.col("digest"))
    staged = incoming.join(known, key, "left").filter(~same).drop("digest")
    staged = sound(materialize(staged, table))
    n = staged.count()
    if n == 0:
        if made_from is not None:
            store.record(table, made_from)
        return {"upserted": 0}
    moved = staged.filter(F.col(surrogate).isNotNull()).select("_year")
    touched = staged.select(FACT_PARTITION).union(moved).distinct()
    years = [row[0] for row in touched.collect()]  # a handful: calendar years
    new = staged.filter(F.col(surrogate).isNull()).select(key)
    top = index.top
    keyed = assign_keys(new, surrogate, [key], top + 1).withColumnRenamed(surrogate, "_fresh")
    fresh = staged.join(sized(keyed, n), key, "left")
    fresh = fresh.withColumn(surrogate, F.coalesce(surrogate, "_fresh")).select(*current.columns)
    fresh = materialize(fresh, table)
    base = current.filter(in_values(FACT_PARTITION, years))
    base = base.join(sized(fresh.select(key), n), key, "left_anti")
    state = base.unionByName(fresh).select(*current.columns)
    store.publish(table, state, FACT_PARTITION, years, [year_of], made_from)
    index.update(fresh, top + new.count(), n)
    return {"upserted": n}


def load_arrests(
    store: TableStore, arrests: DataFrame | None, dims: Mapping[str, DataFrame]
) -> dict[str, dict[str, int]]:
    """The second fact and its bridge; without the source both stay empty."""
    names = ("fact_arrest", "bridge_arrest_charge")
    if arrests is None:
        for table in names:
            if not store.exists(table):
                store.publish(table, empty(store.spark, schemas.CONTRACTS[table].schema))
        return {table: {"skipped": 1} for table in names}
    charges = materialize(arrest_charges(arrests), "charges")
    facts = arrest_facts(arrests, charges, dims)
    members = {
        "arrest_date_key": (dims["dim_date"], "date_key"),
        "arrestee_key": (dims["dim_arrestee"], "arrestee_key"),
    }
    counts = load_facts(
        store, "fact_arrest", facts, "arrest_pk", "cb_no", "arrest_date_key", members, arrests.select("cb_no")
    )
    published = store.read("fact_arrest")
    years = published.select("arrest_pk", FACT_PARTITION)
    fresh = charge_bridge(charges, published, arrests, dims).join(years.hint("merge"), "arrest_pk")
    fresh = materialize(fresh, names[1])
    owners = {
        "arrest_pk": (published, "arrest_pk"),
        "crime_type_key": (dims["dim_crime_type"], "crime_type_key"),
    }
    require(
        names[1],
        contract_violations(fresh, schemas.CONTRACTS[names[1]]),
        orphan_violations(fresh, owners),
    )
    if not store.exists(names[1]):
        bridge = store.publish(names[1], fresh, FACT_PARTITION, sort_by=["arrest_pk"])
        return {names[0]: counts, names[1]: {"changed": bridge.count()}}
    # An arrest's charges are replaced as a whole: a correction may list fewer.
    rows = arrests.count()
    loaded = published.join(sized(arrests.select("cb_no"), rows), "cb_no", "left_semi")
    old = store.read(names[1]).select(*fresh.columns)
    before = old.join(sized(loaded.select("arrest_pk"), rows), "arrest_pk", "left_semi")
    differing = fresh.exceptAll(before).unionByName(before.exceptAll(fresh))
    differing = materialize(differing.select("arrest_pk", FACT_PARTITION), "charges")
    n = differing.count()
    if n:
        touched = [r[0] for r in differing.select(FACT_PARTITION).distinct().collect()]
        changed = sized(differing.select("arrest_pk").distinct(), n)
        kept = old.join(changed, "arrest_pk", "left_anti")
        state = kept.unionByName(fresh.join(changed, "arrest_pk", "left_semi"))
        state = state.filter(in_values(FACT_PARTITION, touched))
        store.publish(names[1], state, FACT_PARTITION, touched, ["arrest_pk"])
    return {names[0]: counts, names[1]: {"changed": n}}


def build_warehouse(
    store: TableStore, cleaned: Cleaned, run_date: date, drop_old: bool = False
) -> dict[str, dict[str, int]]:
    """Dimensions first, then facts; returns each step's counts.

    Each table passes its gates before it is published: a violation raises ``GateError``
    and leaves the published state alone. With ``drop_old`` the loads that are no longer current are
    deleted at the end; not while others read them.
    """
    data = cleaned.ready()
    steps = together(
        store.spark,
        generated=lambda: seed(store),
        dim_location=lambda: load_versioned(
            store,
            "dim_location",
            schemas.LOCATION,
            schemas.UNKNOWN_LOCATION,
            incoming_locations(data.incidents, data.areas),
            run_date,
            spread=("community_area", "community_area_name"),
        ),
        dim_crime_type=lambda: load_versioned(
            store,
            "dim_crime_type",
            schemas.INCIDENT_TYPE,
            schemas.UNKNOWN_TYPE,
            incoming_types(data.incidents, data.codes),
            run_date,
        ),
        dim_weather=lambda: load_weather(store, data.weather),
        dim_arrestee=lambda: load_arrestees(store, data.arrests),
    )
    del steps["generated"]
    dims = {
        name: store.read(name)
        for name in (*steps, "dim_date", "dim_time_of_day", "dim_crime_flags")
    }
    steps["fact_crime"] = load_incident_facts(store, data.incidents, data.weather, dims)
    steps |= load_arrests(store, data.arrests, dims)
    if drop_old:
        drop_old_loads(store)
    return steps


def drop_old_loads(store: TableStore) -> None:
    """Delete loads that are neither current nor compared with by the next run; not while others read."""
    derived = ("fact_crime", "fact_arrest", "extract", LINEAGE, "dim_location")
    cleaned = [f"clean_{source}" for source in ("incidents", "codes", "areas", "weather")]
    indexes = ["fact_crime_keys", "fact_arrest_keys"]
    for table in (*schemas.CONTRACTS, *cleaned, *indexes, "extract", LINEAGE):
        if store.exists(table):
            store.drop_old_loads(table, needed_by=derived)


def clean_feeds(
    store: TableStore, landing: str, run_date: date, arrests: DataFrame | None = None
) -> Cleaned:
    """All landed feeds to published cleaned tables, partitioned by year.

    Every run reads all landed files and publishes whole tables, so a row whose year
    changed does not stay behind in its old partition.
    """
    loads = {
        "incidents": (cleaning.load_incidents,),
        "codes": (cleaning.load_codes, run_date),
        "areas": (cleaning.load_areas, run_date),
        "weather": (cleaning.load_weather,),
    }

    def load(name: str) -> DataFrame:
        clean, *run = loads[name]
        df = clean(store.spark, landing, name, *run)
        return store.publish(f"clean_{name}", df, YEAR_COLUMN)

    tables = together(store.spark, **{name: partial(load, name) for name in loads})
    return Cleaned(**tables, arrests=arrests)


def update_lineage(store: TableStore) -> DataFrame:
    """``(dimension, member, fact_year)``: in which years the facts use which members.

    Kept beside the facts; only the years whose facts were rewritten are looked through again.
    """
    now, before = store.state("fact_crime"), store.made_from(LINEAGE).get("fact_crime", {})
    years = _differing(now, before)
    if not years and store.exists(LINEAGE):
        return store.read(LINEAGE)
    facts = store.read("fact_crime").filter(in_values(FACT_PARTITION, years))
    used = [
        F.struct(F.lit(table).alias("dimension"), F.col(key).cast("bigint").alias("member"))
        for table, key in EXTRACT_KEYS.items()
    ]
    rows = facts.select(F.explode(F.array(*used)).alias("m"), FACT_PARTITION)
    rows = rows.select("m.*", FACT_PARTITION).distinct()
    return store.publish(
        LINEAGE, rows, FACT_PARTITION, years, made_from={"fact_crime": now}
    )


def _differing(now: Mapping[str, str], before: Mapping[str, str]) -> list[int | None]:
    """Years whose folders differ."""
    values = {v for v in now.keys() | before.keys() if now.get(v) != before.get(v)}
    return sorted((None if v == NO_VALUE else int(v) for v in values), key=lambda y: (y is None, y))


def stale_years(store: TableStore, options: Mapping) -> list[int | None] | None:
    """Years whose extract no longer shows the facts and members; None for all.

    A year is stale if its facts were rewritten or if they use a member that has changed: a version that ended
    changes all facts of its time, whatever their years.
    """
    made_from = store.made_from("extract")
    if not store.exists("extract") or made_from.get("options") != dict(options):
        return None
    fixed = ("dim_date", "dim_time_of_day")
    if any(made_from.get(t) != store.state(t) for t in fixed):
        return None
    years = set(_differing(store.state("fact_crime"), made_from["fact_crime"]))
    lineage = update_lineage(store)
    for table, key in EXTRACT_KEYS.items():
        if made_from.get(table) == store.state(table):
            continue
        changed = store.changed_since(table, "extract")
        if changed is None:
            return None
        members = changed.select(F.col(key).cast("bigint").alias("member"))
        of_table = lineage.filter(F.col("dimension") == table)
        hit = of_table.join(members, "member", "left_semi").select(FACT_PARTITION).distinct()
        years |= {row[0] for row in hit.collect()}  # a handful: calendar years
    return list(years)


def refresh_extract(store: TableStore, whole: bool = False, **options) -> DataFrame:
    """Publish the wide reporting table, by the facts' year and sorted by day.

    Only stale years are joined and written again (``stale_years``); ``whole``, or other ``options`` (those of
    ``incident_extract``) than last time, writes all. The year is a column more than its 41.
    """
    names = ("fact_crime", "dim_date", "dim_time_of_day", *EXTRACT_KEYS)
    years = None if whole else stale_years(store, options)
    if years == []:
        return store.read("extract")
    tables = {name: store.read(name) for name in names}
    made_from = {name: store.state(name) for name in names} | {"options": dict(options)}
    if years is not None:
        tables["fact_crime"] = tables["fact_crime"].filter(in_values(FACT_PARTITION, years))
    wide = incident_extract(tables, carry=(FACT_PARTITION,), **options)
    return store.publish(
        "extract", wide, FACT_PARTITION, years, ["occurrence_date"], made_from
    )


def facts_in(store: TableStore, table: str, day_key: str, days: DayRange) -> DataFrame:
    """Facts of a range of days; only the partitions of its years are read."""
    first, last = (int(d.strftime("%Y%m%d")) for d in (days.first, days.last))
    years = F.col(FACT_PARTITION).between(days.first.year, days.last.year)
    return store.read(table).filter(years & F.col(day_key).between(first, last))
