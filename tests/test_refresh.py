"""Runs that cost what has changed, against whole runs."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starkeep.operators import joins
from starkeep.plans import schemas
from starkeep.plans.refresh import pending_files, refresh
from starkeep.plans.warehouse import (
    FACT_PARTITION,
    Cleaned,
    build_warehouse,
    clean_feeds,
    drop_old_loads,
    load_facts,
    refresh_extract,
)
from starkeep.queries.building import RUNS, land_increment
from starkeep.sources.keyindex import KeyIndex
from starkeep.sources.landing import land
from starkeep.sources.store import TableStore
from plans import Broadcasts
from test_warehouse import areas, incidents, weather

FOLDER = "/root/testdata/sf0.001"
TABLES = ("dim_location", "dim_crime_type", "dim_weather", "fact_crime", "extract")


def content(store):
    return {t: sorted((tuple(r) for r in store.read(t).collect()), key=repr) for t in TABLES}


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """The same three batches by refreshes and by whole runs; the content after each."""
    root = str(tmp_path_factory.mktemp("landing"))
    stores = [TableStore(spark, str(tmp_path_factory.mktemp(n))) for n in ("parts", "whole")]
    seen = []
    for step, run_date in enumerate(RUNS):
        land_increment(spark, FOLDER, root, step)
        counts = refresh(stores[0], root, run_date)
        assert counts["fact_crime"]["upserted"] > 0
        build_warehouse(stores[1], clean_feeds(stores[1], root, run_date), run_date)
        refresh_extract(stores[0])
        refresh_extract(stores[1], whole=True)
        seen.append([content(store) for store in stores])
    return stores, root, seen


@pytest.mark.parametrize("step", range(3))
@pytest.mark.parametrize("table", TABLES)
def test_increments_equal_whole_runs(both, step, table):
    parts, whole = both[2][step]
    assert parts[table] == whole[table] and parts[table]


def test_increments_meet_all_cases(both):
    """Versions of places and of types, corrections, late observations."""
    last = both[2][-1][0]
    for table, number in (("dim_location", -2), ("dim_crime_type", -2)):
        assert max(row[number] for row in last[table]) >= 2
    facts = [{r[1]: r for r in seen[0]["fact_crime"]} for seen in both[2]]
    assert len(facts[0]) < len(facts[1]) == len(facts[2])
    columns = [*schemas.CONTRACTS["fact_crime"].schema.names, FACT_PARTITION]
    changed = {c for k in facts[1] for c, a, b in zip(columns, facts[1][k], facts[2][k], strict=True) if a != b}
    assert {"is_arrest", "weather_key", "temperature_celsius"} <= changed


def test_nothing_new(both):
    store, root = both[0][0], both[1]
    before = {t: store.state(t) for t in TABLES}
    assert not any(pending_files(store, root).values())
    assert refresh(store, root, date(2024, 2, 1)) == {}
    refresh_extract(store)
    assert {t: store.state(t) for t in TABLES} == before


def test_a_run_that_ended_halfway(spark, both, tmp_path, monkeypatch):
    """Facts and ledger were not written; the next run finds all that the lost one did not load."""
    root, store = str(tmp_path / "landing"), TableStore(spark, str(tmp_path / "store"))
    land_increment(spark, FOLDER, root, 0)
    refresh(store, root, RUNS[0])
    land_increment(spark, FOLDER, root, 1)
    with monkeypatch.context() as m:
        m.setattr("starkeep.plans.refresh.load_incident_facts", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(store, root, RUNS[1])
    refresh(store, root, RUNS[1])
    land_increment(spark, FOLDER, root, 2)
    with monkeypatch.context() as m:
        m.setattr("starkeep.plans.refresh.load_versioned", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(store, root, RUNS[2])
    refresh(store, root, RUNS[2])
    refresh_extract(store)
    assert content(store) == both[2][2][0]


def test_late_files_of_a_known_date(spark, tmp_path):
    root, store = str(tmp_path / "landing"), TableStore(spark, str(tmp_path / "store"))
    land_increment(spark, FOLDER, root, 0)
    refresh(store, root, RUNS[0])
    raw = spark.read.option("header", True).option("escape", '"').csv(f"{root}/incidents").drop("ingest_date")
    one = raw.filter("ID is not null and Date <> 'unknown'").orderBy("ID").limit(1)
    later = one.withColumns({"Updated On": F.lit("2031-01-01T00:00:00.000"), "Beat": F.lit("late")})
    land(later, root, "incidents", RUNS[0])
    assert {s: sum(map(len, d.values())) for s, d in pending_files(store, root).items()} == {
        "incidents": 1, "codes": 0, "areas": 0, "weather": 0,
    }
    # its code has a newer report now, and so a version that later facts take
    assert refresh(store, root, RUNS[1])["fact_crime"]["upserted"] > 1
    assert [r["beat"] for r in store.read("dim_location").filter("beat = 'late'").collect()] == ["late"]
    # an older delivery of the areas that lands late does not overwrite the newer one
    areas = store.read("clean_areas").orderBy("community_area").collect()
    land(spark.createDataFrame([("1", "Old", "1")], ["ca", "community_area_name", "HARDSHIP INDEX"]), root, "areas", date(2024, 1, 5))
    refresh(store, root, RUNS[1])
    assert store.read("clean_areas").orderBy("community_area").collect() == areas


def test_only_stale_years_are_written(spark, tmp_path):
    """After one area changed, years whose facts do not use its places keep their files."""
    rows = incidents(
        spark,
        dict(id=20, date=datetime(2020, 5, 1), _ingest_year=2020),
        dict(id=21, date=datetime(2021, 5, 1), community_area=8, _ingest_year=2021),
        dict(id=22, date=datetime(2022, 5, 1), community_area=8, _ingest_year=2022),
    )
    other = areas(spark).withColumn("community_area", F.lit(8).cast("smallint"))
    store = TableStore(spark, str(tmp_path / "store"))
    first = Cleaned(rows, areas=areas(spark).unionByName(other), weather=weather(spark))
    build_warehouse(store, first, date(2024, 3, 1))
    refresh_extract(store)
    before, facts = store.state("extract"), store.state("fact_crime")
    later = Cleaned(rows, areas=areas(spark, "20.00").unionByName(other), weather=weather(spark))
    build_warehouse(store, later, date(2024, 6, 1), drop_old=True)
    assert {y for y in facts if store.state("fact_crime")[y] != facts[y]} == {"2024"}
    refresh_extract(store)
    after = store.state("extract")
    # the facts of 2020 stay, but the version they use has ended
    assert {y for y in before if after[y] != before[y]} == {"2020", "2024"}
    parts = content(store)["extract"]
    refresh_extract(store, whole=True)
    assert content(store)["extract"] == parts
    refresh_extract(store, need_coordinates=False)
    assert len(content(store)["extract"]) > len(parts)
    drop_old_loads(store)
    assert refresh_extract(store, need_coordinates=False).count() == store.read("fact_crime").count()


def test_loads_read_only_their_key_ranges(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = spark.range(0, 4 << 20, 1 << 16).withColumnRenamed("id", "k")
    rows = rows.withColumn("day_key", (F.lit(20200101) + F.col("k") % 3 * 10000).cast("int"))
    rows = rows.withColumn("v", F.lit("a"))
    args = ("pk", "k", "day_key")
    assert load_facts(store, "t", rows, *args) == {"upserted": 64}
    index = KeyIndex(store, "t", "k", "pk", FACT_PARTITION)
    batch = rows.filter(F.col("k").between(1 << 20, (1 << 20) + (1 << 17))).withColumn("v", F.lit("b"))
    found = index.read(batch.select("k"))
    read = found.select(F.input_file_name()).distinct().count()
    assert read == 1 and store.read("t_keys").select(F.input_file_name()).distinct().count() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "key_range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    before = store.state("t_keys")
    assert load_facts(store, "t", batch, *args, keys=batch.select("k")) == {"upserted": 3}
    assert {r for r in before if store.state("t_keys")[r] != before[r]} == {"1"}
    assert store.read("t").filter("v = 'b'").count() == 3 and store.read("t").count() == 64
    assert load_facts(store, "t", batch, *args, keys=batch.select("k")) == {"upserted": 0}
    # a fact moves, others are new; the index that a lost run left behind is made anew
    moved = batch.withColumn("day_key", F.lit(20300101)).unionByName(
        spark.createDataFrame([(7, 20300102, "n"), (9, None, "n")], "k long, day_key int, v string")
    )
    store.record("t_keys", {"top": 0})
    assert load_facts(store, "t", moved, *args, keys=moved.select("k")) == {"upserted": 5}
    assert index.top == 66 and store.read("t").agg(F.countDistinct("pk"), F.max("pk")).first() == (66, 66)
    same = index.entries(store.read("t").select(*store.read("t").columns))
    assert sorted(map(tuple, same.collect()), key=repr) == sorted(map(tuple, store.read("t_keys").collect()), key=repr)
    names = spark.createDataFrame([("x", 20200101), ("y", 20210101)], "k string, day_key int")
    load_facts(store, "s", names, *args)
    assert load_facts(store, "s", names.filter("k = 'x'"), *args, keys=names.select("k")) == {"upserted": 0}


def test_ids_of_a_batch_are_not_broadcast(spark, both, tmp_path, monkeypatch):
    """One column of a wide table looks small by its files' bytes; a batch of many rows is merged."""
    root, store = str(tmp_path / "landing"), TableStore(spark, str(tmp_path / "store"))
    land_increment(spark, FOLDER, root, 0)
    refresh(store, root, RUNS[0])
    land_increment(spark, FOLDER, root, 1)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 50)
    with Broadcasts(spark) as seen:
        refresh(store, root, RUNS[1])
    found = seen.columns
    assert found and not [c for c in found if re.fullmatch(r"(iucr#\d+, )?(crime_)?id#\d+L", c)]
    refresh_extract(store)
    assert content(store) == both[2][1][0]
