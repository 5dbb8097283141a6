from datetime import date, datetime

import pytest

from starkeep.operators.quality import Contract, GateError, drift
from starkeep.operators.quarantine import BROKEN, rule_counts, split_rejects, tag_rules
from starkeep.plans import schemas
from starkeep.plans.refresh import refresh
from starkeep.plans.warehouse import load_facts
from starkeep.sources.landing import land, landed_files
from starkeep.sources.manifest import land_batch, manifest, require_complete, unlisted
from starkeep.sources.store import TableStore
from starkeep.sources.windows import DayRange

DAY = date(2024, 5, 1)
SCHEMA = schemas.table(k="long", place="long", v="string", required="k v")


def test_tagged_rows(spark):
    contract = Contract(SCHEMA, (("k",), ("absent",)))
    places = spark.createDataFrame([(1,), (2,)], "id long")
    rows = [(1, 1, "a"), (2, 9, "a"), (3, 1, None), (4, 1, "x"), (4, 2, "y"), (None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA.simpleString().removeprefix("struct<").removesuffix(">"))
    tagged = tag_rules(df, contract, {"place": (places, "id")})
    got = {tuple(r)[:3]: r[BROKEN] for r in tagged.collect()}
    assert got == {
        (1, 1, "a"): [],
        (2, 9, "a"): ["member: place"],
        (3, 1, None): ["not null: v"],
        (4, 1, "x"): ["unique: k"],
        (4, 2, "y"): ["unique: k"],
        (None, None, None): ["member: place", "not null: k", "not null: v"],
    }
    good, bad = split_rejects(tagged)
    assert good.columns == df.columns and good.count() == 1 and bad.count() == 5
    assert {tuple(r) for r in rule_counts(bad).collect()} == {
        ("member: place", 2), ("not null: k", 1), ("not null: v", 2), ("unique: k", 2),
    }
    assert tag_rules(df.limit(0), contract).count() == 0
    assert tag_rules(df, Contract(schemas.table(v="string"))).filter(f"size({BROKEN}) > 0").isEmpty()


def test_three_of_a_thousand(spark, tmp_path):
    rows = [(i, 20240000 + i % 3, i % 5) for i in range(998)] + [(5, 20240001, 0), (2000, 20240001, 77)]
    df = spark.createDataFrame(rows, "k long, day int, place long")
    places = spark.range(5).withColumnRenamed("id", "m")
    args = ("pk", "k", "day", {"place": (places, "m")})
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(GateError):
        load_facts(store, "t", df, *args)
    assert load_facts(store, "t", df, *args, rejects=DAY) == {"upserted": 997}
    bad = {(r.k, r.place, *r.broken_rules) for r in store.read("t_rejects").collect()}
    assert bad == {(5, 0, "unique: k"), (2000, 77, "member: place")} and store.read("t_rejects").count() == 3
    # the same run again changes nothing; a later one that brings a sound row for a rejected key loads it
    assert load_facts(store, "t", df, *args, rejects=DAY) == {"upserted": 0}
    assert store.read("t_rejects").count() == 3
    sound = spark.createDataFrame([(2000, 20240001, 4), (5, 20240002, 4)], df.schema)
    assert load_facts(store, "t", sound, *args, rejects=date(2024, 5, 2)) == {"upserted": 2}
    assert store.read("t").count() == 999


def test_drift(spark):
    df = spark.createDataFrame([(1, "a", 2)], "k long, v string, extra int")
    assert [tuple(r) for r in drift(df, Contract(SCHEMA)).collect()] == [
        ("place", "place bigint", "v string"), ("v", "v string", "extra int"),
    ]
    assert drift(df.limit(0).select("k"), Contract(schemas.table(k="long"))).isEmpty()


def test_batches_are_counted(spark, tmp_path):
    root = str(tmp_path)
    assert manifest(spark, root).isEmpty()
    df = spark.range(10).selectExpr("id", "'x' AS v")
    days, later = DayRange(DAY, DAY), DayRange(date(2024, 4, 1), DAY)
    assert land_batch(df, root, "s", DAY, days, datetime(2024, 5, 1, 8)) == 10
    assert land_batch(df.limit(4), root, "s", DAY, later, datetime(2024, 5, 1, 9)) == 4
    assert land_batch(df.limit(0), root, "s", DAY, later, datetime(2024, 5, 1, 10)) == 0
    entries = {(r.label, r.n_rows) for r in manifest(spark, root).collect()}
    assert entries == {("2024-05-01", 10), ("2024-04-01_to_2024-05-01", 4), ("2024-04-01_to_2024-05-01", 0)}
    files = landed_files(spark, root, "s", ".csv")[DAY]
    require_complete(spark, root, "s", files, 14)
    with pytest.raises(GateError, match="14 rows landed, 13 were read"):
        require_complete(spark, root, "s", files, 13)
    land(df, root, "s", DAY)
    more = landed_files(spark, root, "s", ".csv")[DAY]
    assert unlisted(spark, root, more).count() == len(more) - len(files) > 0
    require_complete(spark, root, "s", more, 1)


def test_a_batch_with_lost_rows_is_refused(spark, tmp_path):
    root, store = str(tmp_path / "landing"), TableStore(spark, str(tmp_path / "store"))
    rows = spark.range(20).selectExpr(
        "cast(id as string) AS ID", "'2024-01-05T10:00:00.000' AS Date", "'0110' AS IUCR", "'7' AS Beat",
        "'' AS `Updated On`", "'true' AS Arrest", "'' AS Domestic",
    )
    land_batch(rows, root, "incidents", DAY, DayRange(DAY, DAY), datetime(2024, 5, 1, 8))
    file = next(tmp_path.glob("landing/incidents/ingest_date=2024-05-01/*.csv"))
    file.write_text("".join(file.read_text().splitlines(keepends=True)[:-1]))
    file.with_name(f".{file.name}.crc").unlink()
    with pytest.raises(GateError, match="rows landed"):
        refresh(store, root, DAY)
    assert not store.exists("fact_crime")
