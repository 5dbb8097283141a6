from datetime import date, datetime, timezone
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from starkeep.operators import bridge, filters, quality, shaping
from starkeep.operators.quality import Contract
from starkeep.plans import reports, schemas
from starkeep.sources.tables import typed_nulls
from starkeep.sources.windows import (
    DayRange,
    chunk_months,
    month_chunks,
    resolve_range,
    slice_days,
)


def test_bridge_from_columns_and_list(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", None, "c", "a| |c"), (2, None, None, None, "")],
        "id int, x_1 string, x_2 string, x_3 string, listed string",
    )
    groups = [{"x": f"x_{i}"} for i in (1, 2, 3)]
    wide = bridge.bridge_from_columns(df, "id", groups, "x")
    listed = bridge.bridge_from_list(df, "id", "listed", "x")
    assert rows(wide) == rows(listed) == [(1, 1, "a"), (1, 3, "c")]
    counted = bridge.count_members(df.select("id"), wide, "id", "n")
    assert rows(counted) == [(1, 2), (2, 0)]


def test_pair_counts_against_brute_force(spark):
    members = {p: {f"m{(p * k) % 7}" for k in range(p % 5)} for p in range(60)}
    data = [(p, m) for p, ms in members.items() for m in ms for _ in range(2)]
    data += [(None, "m1"), (1, None)]
    expected = {}
    for ms in members.values():
        for pair in combinations(sorted(ms), 2):
            expected[pair] = expected.get(pair, 0) + 1
    df = spark.createDataFrame(data, "p int, m string")
    got = bridge.pair_counts(df, "p", "m").collect()
    assert {(r.member_a, r.member_b): r.n_parents for r in got} == expected


def test_pair_counts_of_a_large_parent(spark, monkeypatch):
    """A member domain and a parent of any size."""
    monkeypatch.setattr(bridge, "SPLIT", 7)
    df = spark.range(5000).selectExpr("id % 2500 AS p", "cast(id AS string) AS m")
    big = spark.range(60).selectExpr("-1 AS p", "cast(id AS string) AS m")
    got = bridge.pair_counts(df.union(big), "p", "m")
    assert got.count() == 2500 + 60 * 59 // 2
    assert got.filter("n_parents <> 1").count() == 0


def test_shaping(spark):
    df = spark.createDataFrame([("1", "x", "extra")], "a string, b string, z string")
    target = schemas.table(b="string", a="integer", c="decimal(5,2)")
    got = shaping.conform(df, target)
    assert got.dtypes == [("b", "string"), ("a", "int"), ("c", "decimal(5,2)")]
    assert tuple(got.first()) == ("x", 1, None)
    assert shaping.rename_present(df, {"a": "q", "no": "x"}).columns == ["q", "b", "z"]
    tagged = shaping.tag_columns(df, {"a": {"role": "LATITUDE"}})
    assert tagged.schema["a"].metadata == {"role": "LATITUDE"}
    assert typed_nulls(df, {"n": "smallint"}).dtypes[-1] == ("n", "smallint")


def test_filters(spark, rows):
    df = spark.createDataFrame(
        [(1, datetime(2018, 1, 1), "a"), (2, datetime(2024, 6, 1, 23, 59), "b"), (3, None, "a")],
        "id int, ts timestamp_ntz, c string",
    )
    days = filters.in_days(df, "ts", date(2018, 1, 1), date(2024, 6, 1))
    assert rows(days, "id") == [(1,), (2,), (3,)]
    assert rows(filters.in_days(df, "ts", date(2018, 1, 2)), "id") == [(2,), (3,)]
    assert rows(filters.in_categories(df, "c"), "id") == [(1,), (2,), (3,)]
    assert rows(filters.in_categories(df, "c", ["a"]), "id") == [(1,), (3,)]
    assert rows(filters.complete(df, ["ts"]), "id") == [(1,), (2,)]


def test_ranges(spark, rows):
    one = date(2024, 1, 31)
    assert resolve_range(day=one) == DayRange(one, one)
    assert resolve_range(one, date(2024, 2, 1)).label == "2024-01-31_to_2024-02-01"
    now = datetime(2024, 1, 28, 3, tzinfo=timezone.utc)
    assert resolve_range(now=now, zone="America/New_York").first == date(2024, 1, 19)
    for wrong in (dict(start=one), dict(end=one), dict(start=one, end=date(2024, 1, 1)), {}):
        with pytest.raises(ValueError):
            resolve_range(**wrong)
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 31)), (2, datetime(2024, 1, 31, 23, 59, 59, 999999)),
         (3, datetime(2024, 2, 1)), (4, None)],
        "id int, ts timestamp_ntz",
    )
    assert rows(slice_days(df, "ts", DayRange(one, one)), "id") == [(1,), (2,)]


def test_month_chunks(spark):
    days = DayRange(date(2024, 1, 15), date(2024, 4, 3))
    got = sorted(map(tuple, month_chunks(spark, days).collect()))
    assert got == [
        (date(2024, 1, 15), date(2024, 2, 14)),
        (date(2024, 2, 15), date(2024, 3, 14)),
        (date(2024, 3, 15), date(2024, 4, 3)),
    ]
    for first, last in ((date(2024, 1, 31), date(2024, 12, 30)),
                        (date(2023, 12, 29), date(2024, 3, 29)),
                        (date(2024, 2, 1), date(2024, 2, 1))):
        df = spark.createDataFrame([(first, last)], "a date, b date")
        chunks = sorted(map(tuple, chunk_months(df, "a", "b").collect()))
        assert chunks[0][0] == first and chunks[-1][1] == last
        assert all((b[0] - a[1]).days == 1 for a, b in zip(chunks, chunks[1:]))


def test_contract(spark, rows):
    contract = Contract(schemas.table("id v", id="integer", v="string"), (("id",),))
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c")], "id int, v string")
    assert rows(quality.contract_violations(df, contract)) == [
        ("not null: id", 2), ("not null: v", 1), ("unique: id", 1),
    ]
    assert quality.schema_drift(df, contract) == []
    drift = quality.schema_drift(df.select("v", "id").withColumn("x", F.lit(1)), contract)
    assert drift == [
        ("id", "id int", "v string"), ("v", "v string", "id int"), ("x", "absent", "x int"),
    ]


def test_orphans_and_reconcile(spark, rows):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(quality.orphans(facts, "k", dim, "k")) == [(2, 1), (None, 1)]
    assert rows(quality.reconcile(facts, dim, "k")) == [(4, 1, 2, 0)]
    assert rows(quality.row_counts({"a": facts, "b": dim})) == [("a", 4), ("b", 1)]
    assert rows(quality.same_content(facts, dim)) == [(4, 1, False)]


def test_reports(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1, datetime(2024, 1, 5)), ("a", 1, 0, datetime(2024, 2, 5)),
         ("b", 2, 0, datetime(2024, 2, 6))],
        "c string, n int, hit int, ts timestamp_ntz",
    )
    assert rows(reports.category_share(df, "c", "n")) == [("a", 2, 0.5), ("b", 2, 0.5)]
    trend = reports.monthly_trend(df, "ts", {"n": "n"})
    assert rows(trend) == [(date(2024, 1, 1), 1), (date(2024, 2, 1), 3)]
    sums = reports.summarise(df, ["c"], {"hits": "hit"}, {"mean": "n"}, count="rows")
    rated = reports.with_ratio(sums, "rate", "hits", "rows")
    assert rows(rated) == [("a", 1, 1.0, 2, 50.0), ("b", 0, 2.0, 1, 0.0)]
    none = spark.createDataFrame([(0, 0)], "p int, w int")
    assert reports.with_ratio(none, "rate", "p", "w").first().rate is None
    assert rows(reports.top(sums, "rows", ["c"], 1)) == [("a", 1, 1.0, 2)]


def test_contracts_have_all_tables():
    assert len(schemas.CONTRACTS) == 10
    for spec, name in ((schemas.LOCATION, "dim_location"), (schemas.INCIDENT_TYPE, "dim_crime_type")):
        assert tuple(schemas.CONTRACTS[name].schema.names) == spec.columns


def test_long_lists_and_long_chunks(spark):
    """Positions beyond 16 bits; chunks of several months."""
    long = spark.range(1).select("id", F.array_join(F.sequence(F.lit(1), F.lit(40_000)), "|").alias("items"))
    rows = bridge.bridge_from_list(long, "id", "items", "item")
    assert rows.agg(F.max("position")).first()[0] == 40_000
    assert bridge.count_members(long, rows, "id", "n").first()["n"] == 40_000
    days = DayRange(date(2020, 1, 1), date(2022, 3, 5))
    got = [tuple(r) for r in month_chunks(spark, days, 12).orderBy("chunk_start").collect()]
    assert got == [
        (date(2020, 1, 1), date(2020, 12, 31)), (date(2021, 1, 1), date(2021, 12, 31)), (date(2022, 1, 1), date(2022, 3, 5)),
    ]


def test_a_page_is_one_scan(spark, rows):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), (None, 1, 5)], "x string, y int, v int")
    visuals = {"all": [], "by x": ["x"], "both": ["y", "x"]}
    page = reports.page(df, visuals, {"total": "v"})
    assert page.columns == ["visual", "x", "y", "total"]
    assert rows(page) == sorted(
        [("all", None, None, 10), ("by x", "a", None, 5), ("by x", None, None, 5),
         ("both", "a", 1, 2), ("both", "a", 2, 3), ("both", None, 1, 5)], key=repr,
    )
    assert rows(reports.visual(page, "by x", ["x"], ["total"])) == [("a", 5), (None, 5)]
    plan = reports.page(df, visuals, {"total": "v"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Join" not in plan
    with pytest.raises(ValueError):
        reports.page(df, {"one": ["x", "y"], "two": ["y", "x"]}, {"total": "v"})


def test_visuals_read_the_published_lines(spark):
    from starkeep.queries import reporting

    folder = "/root/testdata/sf0.001"
    for name, columns in (("kpi_totals", 2), ("detail_table", 4), ("returns_by_month_place", 4)):
        plan = getattr(reporting, name)(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("FileScan") == 1, plan
        read = plan.split("ReadSchema: struct<")[1].split(">")[0]
        assert len(read.split(",")) == columns, read
