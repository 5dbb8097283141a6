import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from starkeep.operators.quality import version_faults
from starkeep.operators.scd import (
    OPEN_END,
    OPEN_START,
    VersionSpec,
    change_counts,
    scd0_insert,
    scd1_upsert,
    scd2_history,
    scd2_merge,
    spread_attribute,
)
from starkeep.plans.schemas import LIFE, table
from starkeep.operators.surrogate import assign_keys, fill_keys

SPEC = VersionSpec(surrogate="k", keys=("a", "b"), tracked=("v",), others=("label",))
SCHEMA = table(k="long", a="string", b="integer", label="string", v="string", **LIFE)
DAY = date(2024, 1, 1)


def incoming(spark, *items):
    rows = [(a, b, None, v) for a, b, v in items]
    return spark.createDataFrame(rows, "a string, b int, label string, v string")


def merge(current, df, day, **options):
    return fill_keys(
        scd2_merge(current, df, SPEC, day, **options), "k", ["a", "b", "scd_start_date"]
    )


def versions(df):
    rows = df.select(
        "k", "a", "b", "v", "scd_start_date", "scd_end_date", "is_current", "scd_version"
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_new_key_is_open_both_ways(spark, empty):
    state = merge(empty, incoming(spark, ("x", 1, "p")), DAY)
    assert versions(state) == [(1, "x", 1, "p", OPEN_START, OPEN_END, True, 1)]


def test_unchanged_is_a_no_op(spark, empty):
    state = merge(empty, incoming(spark, ("x", 1, "p"), ("y", None, "q")), DAY)
    again = merge(state, incoming(spark, ("x", 1, "p"), ("y", None, "q")), date(2024, 2, 1))
    assert versions(again) == versions(state)
    counts = change_counts(state, incoming(spark, ("x", 1, "p")), SPEC).collect()
    assert [tuple(r) for r in counts] == [("unchanged", 1)]


def test_changed_expires_and_third_version_keeps_history(spark, empty):
    state = empty
    days = [DAY, date(2024, 2, 1), date(2024, 3, 1)]
    for day, v in zip(days, ("p", "q", None)):
        state = merge(state, incoming(spark, ("x", 1, v)), day)
    assert versions(state) == [
        (1, "x", 1, "p", OPEN_START, days[1], False, 1),
        (2, "x", 1, "q", days[1], days[2], False, 2),
        (3, "x", 1, None, days[2], OPEN_END, True, 3),
    ]
    assert version_faults(state, SPEC).count() == 0


def test_counts_of_all_classes(spark, empty):
    state = merge(empty, incoming(spark, ("x", 1, "p"), ("y", 1, "q")), DAY)
    df = incoming(spark, ("x", 1, "changed"), ("y", 1, "q"), ("z", None, "n"))
    counts = {r[0]: r[1] for r in change_counts(state, df, SPEC).collect()}
    assert counts == {"new": 1, "changed": 1, "unchanged": 1}


def test_partly_null_key_is_a_member_and_all_null_is_not(spark, empty):
    df = incoming(spark, ("x", None, "p"), (None, None, "q"))
    state = merge(empty, df, DAY)
    assert [r[1:4] for r in versions(state)] == [("x", None, "p")]
    assert versions(merge(state, df, date(2024, 2, 1))) == versions(state)


def test_reserved_member_never_changes(spark, empty):
    unknown = [(0, None, None, "Unknown", None, OPEN_START, OPEN_END, True, 1, b"\0")]
    current = spark.createDataFrame(unknown, SCHEMA)
    state = merge(current, incoming(spark, (None, None, "q"), ("x", 1, "p")), DAY)
    assert [(r[0], r[6]) for r in versions(state)] == [(0, True), (1, True)]


def test_second_change_on_a_day_replaces_that_version(spark, empty):
    state = merge(empty, incoming(spark, ("x", 1, "p")), DAY)
    later = date(2024, 2, 1)
    for v in ("q", "r"):
        state = merge(state, incoming(spark, ("x", 1, v)), later)
    assert versions(state) == [
        (1, "x", 1, "p", OPEN_START, later, False, 1),
        (2, "x", 1, "r", later, OPEN_END, True, 2),
    ]


def test_vanished_keys_stay_unless_asked(spark, empty):
    state = merge(empty, incoming(spark, ("x", 1, "p"), ("y", 1, "q")), DAY)
    later = date(2024, 2, 1)
    kept = merge(state, incoming(spark, ("x", 1, "p")), later)
    assert versions(kept) == versions(state)
    gone = merge(state, incoming(spark, ("x", 1, "p")), later, expire_missing=True)
    assert [(r[1], r[5], r[6]) for r in versions(gone)] == [
        ("x", OPEN_END, True),
        ("y", later, False),
    ]
    back = merge(gone, incoming(spark, ("y", 1, "q")), date(2024, 3, 1))
    assert versions(back)[-1][4:] == (date(2024, 3, 1), OPEN_END, True, 2)


def test_run_dates_do_not_go_back(spark, empty):
    state = merge(empty, incoming(spark, ("x", 1, "p")), DAY)
    state = merge(state, incoming(spark, ("x", 1, "q")), date(2024, 3, 1))
    with pytest.raises(Exception, match="run date"):
        merge(state, incoming(spark, ("x", 1, "r")), date(2024, 2, 1))


def test_history_equals_daily_merges(spark, empty):
    rng = random.Random(3)
    days = [DAY + timedelta(i) for i in range(8)]
    snapshots = []
    for day in days:
        for a in "xyz":
            for b in (1, None):
                if rng.random() < 0.7:
                    snapshots.append((a, b, None, rng.choice(["p", "q", None]), day))
    df = spark.createDataFrame(
        snapshots, "a string, b int, label string, v string, day date"
    )
    whole = scd2_history(df, SPEC, "day")
    state = empty
    for day in days:
        state = merge(state, df.filter(F.col("day") == F.lit(day)).drop("day"), day)
    assert version_faults(state, SPEC).count() == 0
    columns = [c for c in state.columns if c != "k"]
    expected = sorted(map(tuple, state.select(*columns).collect()), key=repr)
    assert sorted(map(tuple, whole.select(*columns).collect()), key=repr) == expected


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(5, 1, "old")], "k bigint, id int, v string")
    df = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "id int, v string")
    got = scd0_insert(target, df, ["id"])
    expected = [(5, 1, "old"), (None, 2, "b")]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected
    again = scd0_insert(got, df, ["id"])
    assert again.count() == 2


def test_upsert(spark):
    target = spark.createDataFrame(
        [(5, 1, "old", 1), (6, 2, "kept", 2)], "k bigint, id int, v string, w int"
    )
    df = spark.createDataFrame([(1, None, 9), (3, "new", 3)], "id int, v string, w int")
    got = sorted(map(tuple, scd1_upsert(target, df, ["id"]).collect()), key=lambda r: r[1])
    assert got == [(5, 1, None, 9), (6, 2, "kept", 2), (None, 3, "new", 3)]
    some = scd1_upsert(target, df, ["id"], update=["w"])
    got = sorted(map(tuple, some.collect()), key=lambda r: r[1])
    assert got == [(5, 1, "old", 9), (6, 2, "kept", 2), (None, 3, "new", 3)]


def test_spread_attribute(spark):
    dim = spark.createDataFrame(
        [(1, 7, None, 1), (2, 7, "old", 2), (3, 8, "same", 1), (4, None, "x", 1)],
        "k bigint, area int, name string, version int",
    )
    source = spark.createDataFrame(
        [(7, "new"), (8, None), (None, "never")], "area int, name string"
    )
    got = spread_attribute(dim, source, "area", "name")
    names = {r.k: r.name for r in got.collect()}
    assert names == {1: "new", 2: "new", 3: "same", 4: "x"}
    assert got.columns == dim.columns


def test_keys_are_dense_ordered_and_kept(spark):
    ids = list(range(1000))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i, None if i % 3 else i + 1) for i in ids], "i int, k bigint")
    fresh = assign_keys(df.drop("k"), "k", ["i"], start=10).collect()
    assert {r.i: r.k for r in fresh} == {i: i + 10 for i in range(1000)}
    filled = {r.i: r.k for r in fill_keys(df, "k", ["i"]).collect()}
    assert all(filled[i] == i + 1 for i in range(0, 1000, 3))
    rest = [filled[i] for i in range(1000) if i % 3]
    assert rest == list(range(1001, 1001 + len(rest)))
    assert assign_keys(df.drop("k").limit(0), "k", ["i"]).count() == 0
