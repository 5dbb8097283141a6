import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starkeep.operators import joins
from starkeep.operators.quality import (
    contract_violations,
    orphans,
    schema_drift,
    version_faults,
)
from starkeep.operators.shaping import conform
from starkeep.plans import schemas
from starkeep.plans.reports import incident_extract
from starkeep.plans.warehouse import (
    Cleaned,
    build_warehouse,
    charge_bridge,
    incoming_locations,
    incoming_types,
    load_arrestees,
    load_arrests,
    load_versioned,
    load_weather,
    seed,
)
from starkeep.sources.files import materialize
from starkeep.sources.store import TableStore
from plans import Broadcasts

FIRST, SECOND = date(2024, 3, 1), date(2024, 6, 1)


def frame(spark, schema, rows):
    """Rows as dicts; absent columns are NULL."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    ddl = ", ".join(f"{n} {types[n]}" for n in names)
    values = [tuple(r.get(n) for n in names) for r in rows]
    return conform(spark.createDataFrame(values, ddl), schema)


def incidents(spark, *extra):
    base = dict(
        iucr="0110", primary_type="THEFT", description="D", fbi_code="06",
        arrest=True, domestic=False, beat="0111", district="001", ward=1,
        community_area=7, latitude=Decimal("41.5"), longitude=Decimal("-87.5"),
        _ingest_year=2024,
    )
    rows = [
        base | dict(id=1, date=datetime(2024, 1, 5, 13, 30),
                    updated_on=datetime(2024, 1, 6, 14, 0)),
        base | dict(id=2, date=datetime(2024, 6, 1, 1), updated_on=None, arrest=None),
        base | dict(id=3, date=datetime(1999, 1, 1), updated_on=datetime(1998, 12, 31, 22),
                    _ingest_year=1999, latitude=None, iucr=None),
        base | dict(id=4, date=datetime(2024, 1, 5, 13, 59), community_area=None,
                    district=None, ward=None, beat=None, iucr="9999"),
        base | dict(id=5, date=None, _ingest_year=9999),
    ]
    return frame(spark, schemas.INCIDENTS, rows + [base | e for e in extra])


def areas(spark, poverty="10.00", name="North", year=2024):
    row = dict(community_area=7, community_area_name=name,
               pct_below_poverty=Decimal(poverty), hardship_index=5, _ingest_year=year)
    return frame(spark, schemas.AREAS, [row])


def weather(spark, degrees="21.50"):
    row = dict(obs_time=datetime(2024, 1, 5, 13), temperature_celsius=Decimal(degrees),
               precipitation_mm=None, weather_code_wmo=0, weather_category="Clear",
               temp_band="Warm", precip_band="None", _ingest_year=2024)
    return frame(spark, schemas.WEATHER, [row])


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "warehouse"))


def facts(store):
    return {r.crime_id: r for r in store.read("fact_crime").collect()}


def check_gates(store):
    tables = {n: store.read(n) for n in schemas.CONTRACTS}
    for name, contract in schemas.CONTRACTS.items():
        found = tables[name].select(*[c for c in tables[name].columns if c != "fact_year"])
        assert schema_drift(found, contract) == []
        assert contract_violations(found, contract).filter("n_violations > 0").count() == 0
    links = {
        "occurrence_date_key": ("dim_date", "date_key"),
        "report_date_key": ("dim_date", "date_key"),
        "occurrence_time_key": ("dim_time_of_day", "time_key"),
        "location_key": ("dim_location", "location_key"),
        "crime_type_key": ("dim_crime_type", "crime_type_key"),
        "weather_key": ("dim_weather", "weather_key"),
        "flags_key": ("dim_crime_flags", "flags_key"),
    }
    for key, (dim, member) in links.items():
        assert orphans(tables["fact_crime"], key, tables[dim], member).count() == 0
    assert version_faults(tables["dim_location"], schemas.LOCATION).count() == 0
    assert version_faults(tables["dim_crime_type"], schemas.INCIDENT_TYPE).count() == 0


def test_without_optional_sources(spark, store):
    counts = build_warehouse(store, Cleaned(incidents(spark)), FIRST)
    assert counts["dim_weather"] == {"skipped": 1}
    assert counts["dim_arrestee"] == {"skipped": 1}
    assert counts["dim_crime_type"] == {"new": 2, "changed": 0, "unchanged": 0}
    assert counts["fact_crime"] == {"upserted": 4}
    got = facts(store)
    assert sorted(got) == [1, 2, 3, 4]
    one = got[1]
    assert (one.occurrence_date_key, one.occurrence_time_key) == (20240105, 13)
    assert (one.report_date_key, one.hours_to_update) == (20240106, 24)
    assert (one.flags_key, one.is_arrest, one.is_domestic) == (2, 1, 0)
    assert (one.weather_key, one.temperature_celsius) == (-1, None)
    # an unknown flag: the measure is 0, the key stays unknown
    assert (got[2].flags_key, got[2].is_arrest) == (0, 0)
    assert (got[2].report_date_key, got[2].hours_to_update) == (0, None)
    # days outside the calendar, no type, hours cut toward zero
    assert (got[3].occurrence_date_key, got[3].report_date_key) == (0, 0)
    assert (got[3].crime_type_key, got[3].hours_to_update) == (0, -2)
    assert got[4].location_key == 0 and got[4].crime_type_key > 0
    types = {r.iucr: r for r in store.read("dim_crime_type").collect()}
    assert types["0110"].active is True and types["UNKN"].active is False
    check_gates(store)

    # A corrected date moves a fact to another year, one fact is new.
    corrected = incidents(spark).filter("id <> 2").unionByName(
        incidents(spark, dict(id=2, date=datetime(2023, 5, 1)),
                  dict(id=9, date=datetime(2024, 2, 1))).filter("arrest and id in (2, 9)")
    )
    counts = build_warehouse(store, Cleaned(corrected), SECOND)
    assert counts["fact_crime"] == {"upserted": 2}
    after = facts(store)
    assert after[2].occurrence_date_key == 20230501
    assert {i: r.crime_pk for i, r in after.items() if i != 9} == {
        i: r.crime_pk for i, r in got.items()
    }
    assert after[9].crime_pk == 5


def test_with_all_sources(spark, store):
    rain = weather(spark)
    data = Cleaned(incidents(spark), areas=areas(spark), weather=rain)
    build_warehouse(store, data, FIRST)
    got = facts(store)
    assert got[1].weather_key == got[4].weather_key == 1
    assert got[1].temperature_celsius == Decimal("21.50")
    check_extract({n: store.read(n) for n in schemas.CONTRACTS})

    # The same again: nothing is published.
    names = ("dim_location", "dim_crime_type", "dim_weather", "fact_crime")
    before = {n: store.read(n).inputFiles() for n in names}
    counts = build_warehouse(store, data, SECOND)
    assert counts["dim_location"] == {"new": 0, "changed": 0, "unchanged": 1}
    assert counts["fact_crime"] == {"upserted": 0}
    assert counts["dim_weather"] == {"upserted": 0}
    assert {n: store.read(n).inputFiles() for n in names} == before

    # New indicators make a version; an hour that is known stays as it was.
    hot = rain.withColumn("temp_band", F.lit("Hot"))
    data = Cleaned(incidents(spark), areas=areas(spark, "20.00"), weather=hot)
    counts = build_warehouse(store, data, SECOND)
    assert counts["dim_location"] == {"new": 0, "changed": 1, "unchanged": 0}
    places = {r.location_key: r for r in store.read("dim_location").collect()}
    got = facts(store)
    assert len(got) == 4
    # before, and exactly on, the day of the change
    assert places[got[1].location_key].pct_below_poverty == Decimal("10.00")
    assert places[got[2].location_key].pct_below_poverty == Decimal("20.00")
    hours = {r.weather_key: r.temp_band for r in store.read("dim_weather").collect()}
    assert hours == {-1: "Unavailable", 1: "Warm"}
    assert load_weather(store, hot, overwrite=True) == {"upserted": 1}
    hours = {r.weather_key: r.temp_band for r in store.read("dim_weather").collect()}
    assert hours == {-1: "Unavailable", 1: "Hot"}
    check_gates(store)

    # A new name alone reaches all versions.
    load_versioned(
        store,
        "dim_location",
        schemas.LOCATION,
        schemas.UNKNOWN_LOCATION,
        incoming_locations(incidents(spark), areas(spark, "20.00", "Upper North")),
        date(2024, 7, 1),
        spread=("community_area", "community_area_name"),
    )
    rows = store.read("dim_location").filter("community_area = 7").collect()
    assert {(r.scd_version, r.community_area_name) for r in rows} == {
        (1, "Upper North"), (2, "Upper North"),
    }


def test_only_the_newest_snapshot_counts(spark):
    two = areas(spark, "10.00", year=2023).union(areas(spark, "30.00", year=2024))
    ready = Cleaned(incidents(spark), areas=two).ready()
    assert [r.pct_below_poverty for r in ready.areas.collect()] == [Decimal("30.00")]
    assert ready.incidents.filter("_ingest_year = 9999").count() == 0


def check_extract(tables):
    extract = incident_extract(tables)
    assert len(extract.columns) == 41
    rows = {r.crime_id: r for r in extract.collect()}
    assert sorted(rows) == ["1", "2", "4"]
    assert rows["1"].location_scd_start == datetime(1900, 1, 1)
    assert rows["1"].location_scd_end == datetime(2099, 12, 31)
    assert (rows["1"].index_code, rows["1"].weather_category) == ("U", "Clear")
    assert (rows["2"].weather_category, rows["2"].temperature_celsius) == ("Unavailable", None)
    assert (rows["4"].community_area, rows["4"].community_area_name) == (0, "Unknown")
    whole = incident_extract(tables, need_coordinates=False, missing_measures_as_zero=True)
    rows = {r.crime_id: r for r in whole.collect()}
    assert sorted(rows) == ["1", "2", "3", "4"] and rows["2"].temperature_celsius == 0
    assert rows["3"].occurrence_year == 0


def test_arrests_are_not_broadcast(spark, store, monkeypatch):
    """Frames that grow with the arrests are merged however small their files; few rows are broadcast."""
    arrests = spark.range(300).select(
        F.col("id").alias("cb_no"),
        F.concat(F.lit("C"), "id").alias("case_number"),
        F.lit(datetime(2024, 1, 5, 13)).cast("timestamp_ntz").alias("arrest_date"),
        F.lit("A").alias("race"),
        F.lit("0110|0111").alias("charges_type"),
        F.lit("M|F").alias("charges_class"),
        F.lit("x|y").alias("charges_statute"),
    )
    arrests = materialize(arrests, "arrests")
    seed(store)
    types = incoming_types(incidents(spark), None)
    load_versioned(store, "dim_crime_type", schemas.INCIDENT_TYPE, schemas.UNKNOWN_TYPE, types, FIRST)
    load_arrestees(store, arrests)
    dims = {n: store.read(n) for n in ("dim_crime_type", "dim_arrestee", "dim_date")}

    def broadcast_columns(batch):
        """The counts of ``load_arrests`` and what it broadcasts with a number of an arrest."""
        with Broadcasts(spark) as seen:
            counts = load_arrests(store, batch, dims)
        # the key index's digests do not compress, its files tell its size
        return counts, {c for c in seen.columns if re.search("cb_no|arrest_pk", c) and "digest" not in c}

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    counts, found = broadcast_columns(arrests)
    assert counts["bridge_arrest_charge"] == {"changed": 600} and found == set()
    counts, found = broadcast_columns(arrests)
    assert counts == {"fact_arrest": {"upserted": 0}, "bridge_arrest_charge": {"changed": 0}} and found == set()
    other = arrests.withColumn("charges_type", F.lit("0110"))
    counts, found = broadcast_columns(other)
    assert counts["fact_arrest"] == {"upserted": 300} and found == set()
    assert store.read("bridge_arrest_charge").count() == 300
    counts, found = broadcast_columns(arrests.filter("cb_no < 50"))
    assert counts["fact_arrest"] == {"upserted": 50} and found
    assert store.read("bridge_arrest_charge").count() == 350


def test_charges_are_merged_with_arrests(spark, rows):
    """Only the codes, which are counted, are broadcast; small files do not make the arrests so."""
    arrests = spark.createDataFrame(
        [(1, datetime(2024, 1, 5, 13)), (2, datetime(2024, 8, 1)), (3, None)], "cb_no long, arrest_date timestamp_ntz"
    )
    facts = arrests.select("cb_no", (F.col("cb_no") + 10).alias("arrest_pk"))
    charges = spark.createDataFrame(
        [(1, 1, "0110", "M", "x"), (1, 2, "0111", "F", "y"), (2, 1, "0110", "M", "x"), (9, 1, "0110", "M", "x")],
        "cb_no long, charge_position int, iucr string, charge_class string, charge_statute string",
    )
    spec = schemas.INCIDENT_TYPE
    codes = spark.createDataFrame(
        [(5, "0110", date(1, 1, 1), SECOND), (6, "0110", SECOND, date(9999, 12, 31))],
        f"crime_type_key long, iucr string, {spec.start} date, {spec.end} date",
    )
    bridge = charge_bridge(charges, facts, arrests, {"dim_crime_type": codes})
    assert rows(bridge, "arrest_pk", "crime_type_key", "charge_position") == [(11, 0, 2), (11, 5, 1), (12, 6, 1)]
    plan = bridge._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin")) == (2, 1)
