import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from starkeep.operators.asof import active_on, asof_key, asof_key_closed
from starkeep.operators.dedup import latest_or_keyless, latest_per_key
from starkeep.operators.joins import enrich, hot_keys, left_lookup
from starkeep.operators.scd import VersionSpec

SPEC = VersionSpec(surrogate="dim_key", keys=("nk",))
VERSIONS = "dim_key bigint, nk string, scd_start_date date, scd_end_date date"
FACTS = "id int, nk string, day date"


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [
            (0, None, date(1, 1, 1), date(9999, 12, 31)),
            (10, "A", date(2020, 1, 1), date(2023, 1, 1)),
            (11, "A", date(2023, 1, 1), date(9999, 12, 31)),
        ],
        VERSIONS,
    )


@pytest.mark.parametrize("limit", [100, 0])
def test_asof(spark, dim, limit):
    facts = spark.createDataFrame(
        [
            (1, "A", date(2021, 6, 1)),
            (2, "A", date(2024, 6, 1)),
            (3, "A", date(2023, 1, 1)),  # the day one version ends and the next starts
            (4, "A", date(2022, 12, 31)),
            (5, "A", date(2019, 12, 31)),
            (6, None, date(2024, 1, 1)),
            (7, "B", date(2024, 1, 1)),
            (8, "A", None),
        ],
        FACTS,
    )
    got = asof_key(facts, dim, SPEC, "day", broadcast_rows=limit)
    assert got.columns == ["id", "nk", "day", "dim_key"]
    assert {r.id: r.dim_key for r in got.collect()} == {
        1: 10, 2: 11, 3: 11, 4: 10, 5: 0, 6: 0, 7: 0, 8: 0,
    }


@pytest.mark.parametrize("limit", [100, 0])
def test_overlapping_versions_give_one_key(spark, limit):
    """The later start counts, of equal starts the larger surrogate, on either path."""
    versions = [
        (1, "A", date(2020, 1, 1), date(2025, 1, 1)),
        (2, "A", date(2022, 1, 1), date(2023, 1, 1)),
        (3, "B", date(2020, 1, 1), date(9999, 12, 31)),
        (4, "B", date(2020, 1, 1), date(2021, 1, 1)),
    ]
    asked = [("A", 2021), ("A", 2022), ("A", 2024), ("B", 2020), ("B", 2024)]
    facts = [(i, k, date(year, 6, 1)) for i, (k, year) in enumerate(asked)]
    got = asof_key(
        spark.createDataFrame(facts, FACTS),
        spark.createDataFrame(versions, VERSIONS),
        SPEC,
        "day",
        broadcast_rows=limit,
    )
    assert sorted((r.id, r.dim_key) for r in got.collect()) == [(0, 1), (1, 2), (2, 0), (3, 4), (4, 0)]


@pytest.mark.parametrize("limit", [100, 0])
def test_repeated_lookup_keys_repeat_no_fact(spark, limit):
    facts = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, k string")
    lookup = spark.createDataFrame([("A", 7), ("A", 5), ("A", 7), (None, 1)], "k string, v int")
    got = left_lookup(facts, lookup, {"k": "k"}, {"v": "v"}, null_safe=True, broadcast_rows=limit)
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, 5), (2, None), (3, 1)]


def test_closed_interval_repeats_the_boundary(spark):
    closed = spark.createDataFrame(
        [(10, "A", date(2020, 1, 1), date(2023, 1, 1)),
         (11, "A", date(2023, 1, 1), date(9999, 12, 31))],
        VERSIONS,
    )
    facts = spark.createDataFrame([(1, "A", date(2023, 1, 1))], FACTS)
    got = asof_key_closed(facts, closed, SPEC, "day").collect()
    assert sorted(r.dim_key for r in got) == [10, 11]


def test_asof_with_a_hot_key_against_brute_force(spark):
    rng = random.Random(5)
    start = date(2024, 1, 1)
    versions, number = [], 0
    for nk in [None, *"ABCDE"]:
        cuts = sorted(rng.sample(range(60), 5))
        for lo, hi in zip(cuts, cuts[1:]):
            number += 1
            versions.append((number, nk, start + timedelta(lo), start + timedelta(hi)))
    facts = []
    for i in range(3000):  # every second fact has the key A, every fifth none
        nk = "A" if i % 2 else rng.choice([None, *"BCDEF"])
        facts.append((i, nk, start + timedelta(rng.randrange(70))))
    expected = {
        i: next((k for k, n, lo, hi in versions if n == nk and lo <= day < hi), 0)
        for i, nk, day in facts
    }
    df = spark.createDataFrame(facts, FACTS)
    dim = spark.createDataFrame(versions, VERSIONS)
    for limit in (1000, 0):
        got = asof_key(df, dim, SPEC, "day", broadcast_rows=limit).collect()
        assert len(got) == len(facts)
        assert {r.id: r.dim_key for r in got} == expected


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("limit", [1000, 0])
def test_lookup_with_hot_and_null_keys(spark, limit, null_safe):
    facts = [(i, None if i % 3 == 0 else (1 if i % 3 == 1 else i % 50)) for i in range(3000)]
    members = [(n, f"m{n}") for n in [None, *range(0, 50, 2), 1]]
    df = spark.createDataFrame(facts, "id int, k int")
    lookup = spark.createDataFrame(members, "k int, name string")
    got = left_lookup(
        df,
        lookup,
        {"k": "k"},
        {"name": "name"},
        null_safe=null_safe,
        defaults={"name": "none"},
        broadcast_rows=limit,
    ).collect()
    known = dict(members)
    if not null_safe:
        known.pop(None)
    assert len(got) == len(facts)
    assert {r.id: r.name for r in got} == {i: known.get(k, "none") for i, k in facts}


def test_salted_lookup_spreads_the_hot_key(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 3 > 0, 1).otherwise(2).alias("k"))
    assert {r.k for r in hot_keys(df, ["k"]).collect()} == {1, 2}
    lookup = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    got = left_lookup(df, lookup, {"k": "k"}, {"name": "name"}, broadcast_rows=0)
    # Without merging of small partitions, each holds a part of the hot key.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = got.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) > 1 and max(r[1] for r in parts) < 20000 * 2 / 3


def test_enrich(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    lookup = spark.createDataFrame([(1, "a", False)], "k int, name string, active boolean")
    fields, defaults = {"name": "string", "active": "boolean"}, {"active": True}
    got = enrich(base, lookup, {"k": "k"}, fields, defaults)
    assert sorted(map(tuple, got.collect())) == [(1, "a", False), (2, None, True)]
    bare = enrich(base, None, {"k": "k"}, fields, defaults)
    assert bare.dtypes == got.dtypes
    assert sorted(map(tuple, bare.collect())) == [(1, None, True), (2, None, True)]


def test_active_on(spark):
    df = spark.createDataFrame(
        [
            (1, date(2020, 1, 1), date(2024, 1, 1), date(2020, 1, 1), None),
            (2, date(2024, 1, 1), date(2025, 1, 1), None, None),
            (3, date(2024, 1, 1), date(2025, 1, 1), date(2024, 2, 1), None),
        ],
        "id int, a date, b date, c date, d date",
    )
    day = F.lit("2024-01-01").cast("date")
    kept = active_on(df, day, [("a", "b"), ("c", "d")]).collect()
    assert [r.id for r in kept] == [2]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "old"), (1, 2, "new"), (2, None, "none"), (2, 1, "some"), (3, 5, "a"),
         (3, 5, "b")],
        "id int, ts int, v string",
    )
    got = latest_per_key(df, ["id"], [F.col("ts").desc_nulls_last()])
    assert sorted(map(tuple, got.collect())) == [(1, 2, "new"), (2, 1, "some"), (3, 5, "b")]
    assert latest_per_key(df.select("id"), ["id"]).count() == 3
    with pytest.raises(ValueError):
        latest_per_key(df.withColumn("__rank__", F.lit(1)), ["id"])


def test_rows_without_a_key_all_stay(spark):
    df = spark.createDataFrame(
        [(None, 1), (None, 2), (None, 2), (1, 1), (1, 2)], "id int, v int"
    )
    got = latest_or_keyless(df, "id", [F.col("v").desc()])
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, 2), (None, 1), (None, 2)]


def test_top_one_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1)], "id int, v int")
    plan = latest_per_key(df, ["id"], [F.col("v").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    partial = text.rindex("WindowGroupLimit")
    assert text.index("Exchange") < partial  # printed from the end of the plan
