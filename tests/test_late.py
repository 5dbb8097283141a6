import random
from datetime import date, timedelta

import pytest

from starkeep.operators.late import add_sightings, scd2_splice, sightings
from starkeep.operators.quality import version_faults
from starkeep.operators.scd import OPEN_END, OPEN_START, VersionSpec, scd2_history
from starkeep.operators.surrogate import fill_keys
from starkeep.plans.schemas import LIFE, table

SPEC = VersionSpec(surrogate="k", keys=("a", "b"), tracked=("v",), others=("label",))
SCHEMA = table(k="long", a="string", b="integer", label="string", v="string", **LIFE)
NAMES = "a string, b int, label string, v string, day date"
START = date(2024, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame([(a, b, f"{v}!", v, START + timedelta(days=d)) for a, b, v, d in rows], NAMES)


def load(spark, state, seen, *rows):
    late = frame(spark, *rows)
    next_state = fill_keys(scd2_splice(state, seen, late, SPEC, "day"), "k", ["a", "b", "scd_start_date"])
    return next_state, add_sightings(seen, late, SPEC, "day")


def chain(state, *key):
    rows = state.filter((state.a.eqNullSafe(key[0])) & (state.b.eqNullSafe(key[1]))).orderBy("scd_start_date")
    return [
        (r.k, r.v, r.label, r.scd_version, None if r.scd_start_date == OPEN_START else (r.scd_start_date - START).days,
         None if r.scd_end_date == OPEN_END else (r.scd_end_date - START).days, r.is_current)
        for r in rows.collect()
    ]


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA), sightings(frame(spark), SPEC, "day")


def test_a_late_snapshot_splits_a_version(spark, empty):
    state, seen = load(spark, *empty, ("x", 1, "p", 1), ("x", 1, "p", 5), ("x", 1, "q", 9), ("y", None, "r", 1))
    before = chain(state, "y", None)
    assert chain(state, "x", 1) == [(1, "p", "p!", 1, None, 9, False), (2, "q", "q!", 2, 9, None, True)]
    state, seen = load(spark, state, seen, ("x", 1, "s", 3))
    assert chain(state, "x", 1) == [
        (1, "p", "p!", 1, None, 3, False), (4, "s", "s!", 2, 3, 5, False),
        (5, "p", "p!", 3, 5, 9, False), (2, "q", "q!", 4, 9, None, True),
    ]
    assert chain(state, "y", None) == before
    # seen unchanged on a day between: nothing changes
    again, seen = load(spark, state, seen, ("x", 1, "q", 20), ("x", 1, "p", 2))
    assert chain(again, "x", 1) == chain(state, "x", 1)


def test_bounds_move(spark, empty):
    state, seen = load(spark, *empty, ("x", 1, "p", 4), ("x", 1, "q", 8))
    # before the first one, and the second value earlier than known
    state, seen = load(spark, state, seen, ("x", 1, "n", 2), ("x", 1, "q", 6))
    assert chain(state, "x", 1) == [
        (3, "n", "n!", 1, None, 4, False), (1, "p", "p!", 2, 4, 6, False), (2, "q", "q!", 3, 6, None, True),
    ]
    # the day of a version is delivered again: it is gone, its neighbour reaches over it
    state, seen = load(spark, state, seen, ("x", 1, "n", 4))
    assert chain(state, "x", 1) == [(3, "n", "n!", 1, None, 6, False), (2, "q", "q!", 2, 6, None, True)]


def test_odd_rows(spark, empty):
    state, seen = load(spark, *empty)
    assert state.count() == seen.count() == 0
    reserved = spark.createDataFrame([(0, None, None, "Unknown", None, OPEN_START, OPEN_END, True, 1, b"")], SCHEMA)
    late = frame(spark, ("x", None, None, 1), (None, None, "lost", 1)).unionByName(
        spark.createDataFrame([("x", None, None, "z", None)], NAMES)
    )
    state = fill_keys(scd2_splice(reserved, seen, late, SPEC, "day"), "k", ["a", "b", "scd_start_date"])
    assert sorted((r.k, r.a, r.v) for r in state.collect()) == [(0, None, None), (1, "x", None)]
    assert add_sightings(seen, late, SPEC, "day").count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_any_order_gives_the_history(spark, empty, seed):
    rng = random.Random(seed)
    rows = [(k, b, rng.choice("pqr"), d) for k in "xyz" for b in (1, None) for d in rng.sample(range(40), 12)]
    rng.shuffle(rows)
    state, seen = empty
    for part in range(4):
        state, seen = load(spark, state, seen, *rows[part::4])
    columns = [c for c in SPEC.columns if c != "k"]
    want = scd2_history(frame(spark, *rows), SPEC, "day").select(*columns)
    assert sorted(map(tuple, state.select(*columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    keys = [r.k for r in state.select("k").collect()]
    assert len(set(keys)) == len(keys) and None not in keys
    assert version_faults(state, SPEC).isEmpty()
