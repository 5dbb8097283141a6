from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkeep.operators.quality import GateError
from starkeep.plans.warehouse import load_facts
from starkeep.sources.files import materialize, scratch_root
from starkeep.sources.landing import landed_files, read_json
from starkeep.sources.store import TableStore
from starkeep.sources.windows import DayRange, backfill


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def test_publish_and_replace_while_reading(spark, store):
    assert not store.exists("t")
    with pytest.raises(LookupError):
        store.read("t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    first = store.publish("t", df)
    assert store.exists("t") and first.dtypes == df.dtypes
    before = store.read("t")
    store.publish("t", first.withColumn("v", F.upper("v")))
    assert sorted(r.v for r in store.read("t").collect()) == ["A", "B"]
    assert sorted(r.v for r in before.collect()) == ["a", "b"]  # old readers are safe


def test_failed_publish_changes_nothing(spark, store):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    store.publish("t", df)
    broken = df.select(F.when(F.col("id") == 2, F.raise_error("no").cast("int")).alias("id"))
    with pytest.raises(Exception):
        store.publish("t", broken)
    assert sorted(r.id for r in store.read("t").collect()) == [1, 2]


def test_partitions_are_replaced_alone(spark, store):
    schema = "id int, year int"
    store.publish("t", spark.createDataFrame([(1, 2023), (2, 2024), (3, 2025)], schema), "year")
    files = {f for f in store.read("t").inputFiles() if "year=2023" in f}
    moved = spark.createDataFrame([(2, 2025), (3, 2025)], schema)
    got = store.publish("t", moved, "year", replacing=[2024, 2025])
    assert sorted(map(tuple, got.collect())) == [(1, 2023), (2, 2025), (3, 2025)]
    assert {f for f in got.inputFiles() if "year=2023" in f} == files


def test_old_loads_are_dropped_on_request(spark, store):
    schema = "id int, year int"
    for name, by in (("plain", None), ("parts", "year")):
        store.publish(name, spark.createDataFrame([(1, 2023), (2, 2024)], schema), by)
        again = spark.createDataFrame([(3, 2024)], schema)
        store.publish(name, again, by, replacing=[2024] if by else None)
        expected = sorted(map(tuple, store.read(name).collect()))
        assert store.drop_old_loads(name) == 1
        assert store.drop_old_loads(name) == 0
        assert sorted(map(tuple, store.read(name).collect())) == expected


def test_empty_table(spark, store):
    df = spark.createDataFrame([], "id int, year int")
    for name, by in (("plain", None), ("parts", "year")):
        got = store.publish(name, df, by)
        assert got.dtypes == df.dtypes and got.count() == 0


def test_materialize_uses_the_shared_folder(spark):
    df = materialize(spark.range(3).toDF("i"), "probe")
    assert all(scratch_root(spark) in f for f in df.inputFiles())
    assert df.count() == 3
    assert spark.sparkContext.applicationId in df.inputFiles()[0]


def load(store, *rows):
    df = store.spark.createDataFrame(list(rows), "id bigint, day_key int, m int")
    return load_facts(store, "f", df, "pk", "id", "day_key")


def state(store):
    rows = store.read("f").select("pk", "id", "day_key", "m").collect()
    return sorted(map(tuple, rows))


def test_fact_upsert(store):
    assert load(store, (1, 20230101, 1), (2, 20240101, 1)) == {"upserted": 2}
    first = state(store)
    assert first == [(1, 1, 20230101, 1), (2, 2, 20240101, 1)]
    files = store.read("f").inputFiles()
    assert load(store, (1, 20230101, 1), (2, 20240101, 1)) == {"upserted": 0}
    assert state(store) == first and store.read("f").inputFiles() == files
    assert load(store, (1, 20230101, 1), (2, 20240101, 5), (3, 0, 1)) == {"upserted": 2}
    assert state(store) == [(1, 1, 20230101, 1), (2, 2, 20240101, 5), (3, 3, 0, 1)]
    load(store, (2, 20230202, 5))  # the corrected date moves the fact to another year
    assert state(store) == [(1, 1, 20230101, 1), (2, 2, 20230202, 5), (3, 3, 0, 1)]


def test_rows_without_a_partition_value_stay(spark, store):
    """A load replaces the partition without a value only with all its rows."""
    schema = "k int, day int"
    for batch in ([(1, None), (2, None), (3, 20240101)], [(4, None)], [(1, 20240105)], [(5, 20230101)]):
        load_facts(store, "f", spark.createDataFrame(batch, schema), "pk", "k", "day")
    got = sorted((r.k, r.day) for r in store.read("f").select("k", "day").collect())
    assert got == [(1, 20240105), (2, None), (3, 20240101), (4, None), (5, 20230101)]


def test_partition_values_are_escaped(spark, store):
    schema = "id int, place string"
    store.publish("t", spark.createDataFrame([(1, "a/b=c"), (2, None), (3, "x")], schema), "place")
    new = spark.createDataFrame([(9, "a/b=c"), (8, None)], schema)
    got = store.publish("t", new, "place", replacing=["a/b=c", None])
    assert sorted(r.id for r in got.collect()) == [3, 8, 9]


def test_repeated_natural_keys_are_refused(spark, store):
    schema = "k int, day int"
    good = spark.createDataFrame([(1, 20240101)], schema)
    for bad in ([(2, 20240101), (2, 20240102)], [(None, 20240101)]):
        with pytest.raises(ValueError, match="k missing or repeated"):
            load_facts(store, "f", good.union(spark.createDataFrame(bad, schema)), "pk", "k", "day")
        assert not store.exists("f")
    load_facts(store, "f", good, "pk", "k", "day")
    with pytest.raises(ValueError):
        load_facts(store, "f", spark.createDataFrame([(3, 1), (3, 2)], schema), "pk", "k", "day")
    assert store.read("f").count() == 1


def test_pointer_is_overwritten_on_object_stores(spark, store, monkeypatch):
    monkeypatch.setattr("starkeep.sources.files.OBJECT_STORES", {"file"})
    for value in (1, 2):
        store.publish("t", spark.createDataFrame([(value,)], "id int"))
    assert [r.id for r in store.read("t").collect()] == [2]


def test_a_violating_load_leaves_the_table_alone(spark, store):
    """Facts whose foreign key has no member are refused before the pointer changes."""
    days = spark.createDataFrame([(20240101,), (20240102,)], "date_key int")
    members = {"day": (days, "date_key")}

    def load(rows):
        df = spark.createDataFrame(rows, "k int, day int")
        return load_facts(store, "f", df, "pk", "k", "day", members)

    with pytest.raises(GateError, match="member: day"):
        load([(1, 20240101), (2, 20249999)])
    assert not store.exists("f")
    load([(1, 20240101)])
    for bad in ([(1, 20249999)], [(2, None)]):
        with pytest.raises(GateError):
            load(bad)
    assert [(r.k, r.day) for r in store.read("f").collect()] == [(1, 20240101)]


def test_backfill_runs_every_chunk_in_order(spark):
    seen = []
    found = backfill(spark, DayRange(date(2024, 1, 31), date(2024, 4, 2)), seen.append)
    assert [d.label for d in seen] == [d.label for d, _ in found] == [
        "2024-01-31_to_2024-02-28",
        "2024-02-29_to_2024-03-30",
        "2024-03-31_to_2024-04-02",
    ]


def test_many_json_files_are_listed_by_folder(spark, tmp_path):
    """A date of which all files are asked for costs no job to list; of others just the files asked for are read."""
    root, day, other = str(tmp_path / "landing"), date(2024, 1, 10), date(2024, 1, 11)
    folder = tmp_path / "landing" / "weather" / f"ingest_date={day}"
    folder.mkdir(parents=True)
    for i in range(40):
        (folder / f"a {i}+%41.json").write_text(f'{{"n":\n {i}}}')
    (folder / "notes.txt").write_text("{}")
    schema = T.StructType([T.StructField("n", T.LongType())])
    found = landed_files(spark, root, "weather", ".json")
    assert [*found] == [day] and len(found[day]) == 40 and all(f.endswith("+%41.json") for f in found[day])

    def read(files):
        """The numbers read, and how many jobs the listing took."""
        spark.sparkContext.setJobGroup(group := f"listing {len(files)}", "")
        df = read_json(spark, root, "weather", schema, files)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return {(r["n"], r["ingest_date"]) for r in df.select("n", "ingest_date").collect()}, len(jobs)

    assert read(found[day]) == ({(i, day) for i in range(40)}, 0)
    late = tmp_path / "landing" / "weather" / f"ingest_date={other}"
    late.mkdir()
    (late / "b.json").write_text('{"n": 77}')
    some = [f for f in found[day] if "a 3" in f] + landed_files(spark, root, "weather", ".json", [other])[other]
    numbers, _ = read(some)
    assert numbers == {(i, day) for i in (3, *range(30, 40))} | {(77, other)}
    assert len(read([*found[day], some[-1]])[0]) == 41
