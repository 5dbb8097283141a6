"""Gates and load windows."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from starkeep.operators import quality as Q
from starkeep.operators.quality import Contract
from starkeep.plans import cleaning
from starkeep.plans.schemas import table
from starkeep.queries import feeds
from starkeep.queries.merging import HISTORY_SQL, USERS, user_history
from starkeep.queries.registry import Tables, query
from starkeep.sources.windows import chunk_months, resolve_range, slice_days

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@query("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
))
def row_counts(spark, folder):
    t = Tables(spark, folder)
    return Q.row_counts({name: getattr(t, name) for name in TABLES})


@query("""
WITH facts AS (SELECT nullif(l_suppkey * 2, 0) AS key FROM lineitem)
SELECT key, count(*) AS n_rows FROM facts
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = key) GROUP BY 1
""")
def orphan_keys(spark, folder):
    t = Tables(spark, folder)
    facts = t.lineitem.select(F.nullif(F.col("l_suppkey") * 2, F.lit(0)).alias("key"))
    return Q.orphans(facts, "key", t.supplier, "s_suppkey")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
""")
def repeated_keys(spark, folder):
    return Q.duplicates(Tables(spark, folder).lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT 'not null: o_orderkey' AS rule,
    count(*) - count(o_orderkey) AS n_violations FROM orders
UNION ALL SELECT 'not null: o_orderpriority',
    count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) FROM orders
UNION ALL SELECT 'unique: o_custkey, o_orderdate', count(*) FROM (
    SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1) AS d
""")
def contract_check(spark, folder):
    """Not-null and uniqueness rules of a contract."""
    orders = Tables(spark, folder).orders
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    contract = Contract(
        table(
            required="o_orderkey o_orderpriority",
            o_orderkey="long",
            o_orderpriority="string",
        ),
        (("o_custkey", "o_orderdate"),),
    )
    return Q.contract_violations(orders.withColumn("o_orderpriority", priority), contract)


@query(f"""
WITH {HISTORY_SQL}, kept AS (
    SELECT *, lead(scd_start_date) OVER (PARTITION BY user_id ORDER BY scd_start_date)
        AS following
    FROM history WHERE event_type <> 'click')
SELECT user_id, count(CASE WHEN is_current THEN 1 END) AS n_current,
    count(CASE WHEN following <> scd_end_date THEN 1 END) AS n_broken
FROM kept GROUP BY 1
HAVING count(CASE WHEN is_current THEN 1 END) <> 1
    OR count(CASE WHEN following <> scd_end_date THEN 1 END) > 0
""")
def broken_versions(spark, folder):
    """Version chains with a hole or without a current row (one type taken out)."""
    versions = user_history(Tables(spark, folder).events)
    versions = versions.withColumn(USERS.surrogate, F.lit(None).cast("bigint"))
    return Q.version_faults(versions.filter(F.col("event_type") != "click"), USERS)


@query(f"""
WITH {feeds.INCIDENTS_SQL}
SELECT CAST((SELECT count(*) * 2 FROM events) AS BIGINT) AS n_landed,
    count(*) AS n_loaded,
    (SELECT count(*) FROM events WHERE value < 5 OR value BETWEEN 6 AND 7) AS n_missing,
    CAST(0 AS BIGINT) AS n_extra
FROM incidents WHERE _ingest_year <> 9999
""")
def landed_against_loaded(spark, folder):
    """Raw reports against cleaned incidents, by case."""
    feed = feeds.incident_feed(spark, folder)
    raw = feed.select(F.col("Case Number").alias("case_number"))
    loaded = cleaning.clean_incidents(feed).filter(F.col("_ingest_year") != 9999)
    return Q.reconcile(raw, loaded, "case_number")


@query("SELECT count(*) AS n_left, count(*) AS n_right, TRUE AS same FROM lineitem")
def same_fingerprint(spark, folder):
    """The rows in another order and layout have the same fingerprint."""
    lines = Tables(spark, folder).lineitem
    moved = lines.repartition("l_orderkey", "l_linenumber").select(*lines.columns[::-1])
    return Q.same_content(lines, moved)


@query("""
SELECT event_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-13 00:00:00'
""")
def window_slice(spark, folder):
    days = resolve_range(date(2024, 1, 5), date(2024, 1, 12))
    events = Tables(spark, folder).events.select("event_id", "ts", "event_type")
    return slice_days(events, "ts", days)


@query("""
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-19 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
""")
def lookback_day(spark, folder):
    """The day eight days before now, in the source's time zone."""
    now = datetime(2024, 1, 28, 3, 0, tzinfo=timezone.utc)  # still the 27th there
    day = resolve_range(now=now, zone="America/New_York")
    return slice_days(Tables(spark, folder).events.select("event_id", "ts"), "ts", day)


@query("""
WITH ends AS (
    SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
    FROM orders),
starts AS (
    SELECT CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))
        AS DATE) AS chunk_start, hi FROM ends)
SELECT chunk_start, least(CAST(chunk_start + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), hi)
    AS chunk_end
FROM starts
""")
def month_chunks(spark, folder):
    """Backfill chunks over the days the table covers."""
    day = F.to_date("o_orderdate")
    ends = Tables(spark, folder).orders.agg(
        F.min(day).alias("first"), F.max(day).alias("last")
    )
    return chunk_months(ends, "first", "last")
