from pyspark.sql import functions as F

from starkeep.functions.hashing import fingerprint
from starkeep.sources.prints import VALUES, differing, merge_prints, part_prints, published_prints, where_different
from starkeep.sources.store import TableStore


def frame(spark, *changed):
    rows = [(i, f"k{i}", None if i % 10 == 9 else 2020 + i % 3, i * 7) for i in range(60)]
    rows = [r for r in rows if r[0] not in changed] + [(i, f"k{i}", 2020 + i % 3, -1) for i in changed]
    return spark.createDataFrame(rows, "i long, k string, y int, v int")


def test_parts_merge_into_the_whole(spark):
    df = frame(spark)
    columns = df.columns
    by_year = part_prints(df, ["y"], columns)
    whole = fingerprint(df).first()
    assert tuple(merge_prints(by_year, []).first()) == tuple(whole)
    finer = part_prints(df.withColumn("b", F.col("i") % 4), ["y", "b"], columns)
    again = merge_prints(finer, ["y"])
    assert differing(by_year, again, ["y"]).isEmpty() and by_year.columns == ["y", *VALUES]
    moved = part_prints(df.repartition(5).select(*columns[::-1]), ["y"], columns)
    assert differing(by_year, moved, ["y"]).isEmpty()
    lost = part_prints(df.filter("y = 2020"), ["y"], columns)
    counts = {r["y"]: (r["n_left"], r["n_right"]) for r in differing(by_year, lost, ["y"]).collect()}
    assert set(counts) == {2021, 2022, None} and all(right == 0 for _, right in counts.values())


def test_where_tables_differ(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.publish("a", frame(spark), "y")
    store.publish("b", frame(spark), "y")
    args = ((store, "a"), (store, "b"), "y")
    assert where_different(*args, "i").isEmpty()
    store.publish("b", frame(spark, 12).filter("y = 2020"), "y", [2020])
    before = store.state("b_prints")
    found = [tuple(r) for r in where_different(*args, "i", 8).collect()]
    assert found == [(2020, 4, found[0][2], found[0][2])] and found[0][2] > 0
    # only the partition with a new load was read again
    assert {v for v in before if store.state("b_prints")[v] != before[v]} == {"2020"}
    assert where_different(*args, "k", 8).count() == 1
    store.publish("b", frame(spark).filter("y IS NOT NULL AND y < 2022"), "y")
    gone = where_different(*args, "i", 8)
    assert {r["y"] for r in gone.collect()} == {2022, None} and gone.agg(F.sum("n_right")).first()[0] == 0
    assert published_prints(store, "b", "y").count() == 2
