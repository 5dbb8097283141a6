"""Partitioned writes and published tables."""

from datetime import date, datetime

from pyspark.sql import functions as F

from starkeep.plans.warehouse import load_facts
from starkeep.queries.registry import Tables, query
from starkeep.sources.files import scratch_path
from starkeep.sources.landing import read_csv
from starkeep.sources.manifest import land_batch, manifest
from starkeep.sources.prints import where_different
from starkeep.sources.store import TableStore
from starkeep.sources.tables import write_cleaned
from starkeep.sources.windows import DayRange, backfill, slice_days


@query("""
SELECT o_orderkey, o_orderdate, CASE WHEN year(o_orderdate) = 1996
    THEN 'again' ELSE o_orderpriority END AS o_orderpriority,
    CAST(year(o_orderdate) AS INTEGER) AS _ingest_year
FROM orders
""")
def partition_overwrite(spark, folder):
    """A second write replaces only the year it holds."""
    orders = Tables(spark, folder).orders.select(
        "o_orderkey",
        "o_orderdate",
        "o_orderpriority",
        F.year("o_orderdate").alias("_ingest_year"),
    )
    path = scratch_path(spark, "cleaned")
    write_cleaned(orders, path)
    again = orders.filter(F.col("_ingest_year") == 1996)
    write_cleaned(again.withColumn("o_orderpriority", F.lit("again")), path)
    return spark.read.schema(orders.schema).parquet(path)


@query("""
WITH loaded AS (
    SELECT *, row_number() OVER (ORDER BY o_orderkey) AS old_pk FROM orders
    WHERE o_orderstatus <> 'P'),
added AS (
    SELECT o_orderkey, (SELECT count(*) FROM loaded)
        + row_number() OVER (ORDER BY o_orderkey) AS new_pk
    FROM orders WHERE o_orderstatus = 'P')
SELECT coalesce(old_pk, new_pk) AS order_pk, orders.o_orderkey,
    CASE WHEN orders.o_orderkey % 10 <> 3 THEN
        CAST(strftime(CASE WHEN o_orderstatus = 'F' THEN orders.o_orderdate
            ELSE orders.o_orderdate + INTERVAL 400 DAY END, '%Y%m%d') AS INTEGER)
        END AS date_key
FROM orders LEFT JOIN loaded USING (o_orderkey, o_orderstatus)
LEFT JOIN added ON added.o_orderkey = orders.o_orderkey
""")
def fact_upsert(spark, folder):
    """Facts loaded twice: known ones move to another year and keep their key.

    Some have no day in either load; they share the partition without a value.
    """
    orders = Tables(spark, folder).orders

    def facts(df, shift):
        day = F.date_add(F.to_date("o_orderdate"), shift)
        key = F.date_format(day, "yyyyMMdd").cast("int")
        return df.select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 3, key).alias("date_key"))

    store = TableStore(spark, scratch_path(spark, "store"))
    first = facts(orders.filter(F.col("o_orderstatus") != "P"), 0)
    second = facts(orders.filter(F.col("o_orderstatus") != "F"), 400)
    for batch in (first, second):
        load_facts(store, "orders", batch, "order_pk", "o_orderkey", "date_key")
    return store.read("orders").select("order_pk", "o_orderkey", "date_key")


@query("""
SELECT row_number() OVER (
        ORDER BY date_trunc('year', o_orderdate), o_orderkey) AS order_pk,
    o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key
FROM orders
""")
def backfill_loads(spark, folder):
    """All orders loaded year by year; every chunk's facts are numbered after the last's."""
    orders = Tables(spark, folder).orders
    store = TableStore(spark, scratch_path(spark, "store"))

    def load(days):
        rows = slice_days(orders, "o_orderdate", days)
        key = F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key")
        facts = rows.select("o_orderkey", key)
        return load_facts(store, "orders", facts, "order_pk", "o_orderkey", "date_key")

    first, last = orders.agg(F.trunc(F.min("o_orderdate"), "year"), F.to_date(F.max("o_orderdate"))).first()
    backfill(spark, DayRange(first, last), load, months=12)
    return store.read("orders").select("order_pk", "o_orderkey", "date_key")


@query("""
WITH feed AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 333 = 0 THEN -1 ELSE o_custkey END AS o_custkey,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
        concat_ws('; ', CASE WHEN o_orderkey % 333 = 0 THEN 'member: o_custkey' END,
            CASE WHEN o_orderkey % 400 = 1 THEN 'unique: o_orderkey' END) AS rules
    FROM orders, (SELECT unnest([1, 2]) AS copy) WHERE copy = 1 OR o_orderkey % 400 = 1)
SELECT row_number() OVER (ORDER BY o_orderkey % 2, o_orderkey) AS order_pk, o_orderkey, o_custkey, date_key,
    CAST(NULL AS DATE) AS run_day, rules FROM feed WHERE rules = ''
UNION ALL
SELECT NULL, o_orderkey, o_custkey, date_key, day, rules
FROM feed, (VALUES (DATE '2024-05-01', 0), (DATE '2024-05-02', 1)) AS runs(day, odd)
WHERE rules <> '' AND o_orderkey % 2 <= odd
""")
def quarantined_load(spark, folder):
    """Two loads with bad rows in them: sound ones are published, the others listed with the rules they break."""
    tables = Tables(spark, folder)
    copies = F.explode(F.when(F.col("o_orderkey") % 400 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    feed = tables.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 333 == 0, -1).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
        copies.alias("copy"),
    ).drop("copy")
    store = TableStore(spark, scratch_path(spark, "store"))
    members = {"o_custkey": (tables.customer, "c_custkey")}
    batches = {date(2024, 5, 1): feed.filter("o_orderkey % 2 = 0"), date(2024, 5, 2): feed}
    for run_day, batch in batches.items():
        load_facts(
            store, "orders", batch, "order_pk", "o_orderkey", "date_key", members,
            batch.select("o_orderkey"), rejects=run_day,
        )
    rejected = store.read("orders_rejects").withColumn("rules", F.array_join("broken_rules", "; "))
    columns = ["order_pk", "o_orderkey", "o_custkey", "date_key", "run_day", "rules"]
    loaded = store.read("orders").withColumn("rules", F.lit(""))
    return loaded.unionByName(rejected, allowMissingColumns=True).select(*columns)


@query("""
SELECT 'orders' AS source, DATE '2024-05-01' AS ingest_date,
    CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) || '_to_' || CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS label,
    count(*) AS n_rows, count(*) AS n_read
FROM orders GROUP BY o_orderstatus
""")
def landing_manifest(spark, folder):
    """Batches as they were counted while they landed, beside the rows that are read from their files."""
    orders = Tables(spark, folder).orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    root, day = scratch_path(spark, "landing"), date(2024, 5, 1)
    ends = orders.groupBy("o_orderstatus").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    for hour, row in enumerate(ends.orderBy("o_orderstatus").collect()):  # three states
        batch = orders.filter(F.col("o_orderstatus") == row["o_orderstatus"])
        land_batch(batch, root, "orders", day, DayRange(row["first"], row["last"]), datetime(2024, 5, 1, hour))
    entries = manifest(spark, root).withColumn("file", F.explode("files"))
    name = F.substring_index(F.col("_metadata.file_path"), "/", -3)
    read = read_csv(spark, root, "orders").select(name.alias("file")).groupBy("file").agg(F.count("*").alias("n"))
    both = entries.join(read, "file", "left")
    return both.groupBy("source", "ingest_date", "label", "n_rows").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_read"))


@query("""
WITH both_sides AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderkey % 64 AS key_bucket,
        o_orderkey % 64 = 5 AND year(o_orderdate) = 1996 AS altered,
        o_orderkey % 64 = 9 AND year(o_orderdate) = 1997 AS lost
    FROM orders)
SELECT order_year, key_bucket, count(*) AS n_left, count(*) FILTER (NOT lost) AS n_right
FROM both_sides GROUP BY 1, 2 HAVING bool_or(altered OR lost)
""")
def changed_parts(spark, folder):
    """Where two published tables differ: one has other priorities in one bucket and lacks the rows of another."""
    orders = Tables(spark, folder).orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("order_year")
    )
    bucket, year = F.col("o_orderkey") % 64, F.col("order_year")
    other = F.when((bucket == 5) & (year == 1996), F.lit("again")).otherwise(F.col("o_orderpriority"))
    altered = orders.filter(~((bucket == 9) & (year == 1997))).withColumn("o_orderpriority", other)
    store = TableStore(spark, scratch_path(spark, "store"))
    for table, rows in (("before", orders), ("after", altered.repartition(3))):
        store.publish(table, rows, "order_year")
    return where_different((store, "before"), (store, "after"), "order_year", "o_orderkey")
