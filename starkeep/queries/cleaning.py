"""Landing raw files and reading them back through the cleaning jobs."""

from datetime import date

from pyspark.sql import functions as F

from starkeep.functions.naming import snake_columns
from starkeep.functions.parsing import (
    cast_columns,
    parse_bool,
    parse_event_time,
)
from starkeep.functions.keys import partition_year
from starkeep.operators.shaping import conform, rename_present, tag_columns
from starkeep.plans import cleaning
from starkeep.plans.schemas import table
from starkeep.queries import feeds
from starkeep.queries.registry import Tables, query
from starkeep.sources.files import scratch_path
from starkeep.sources.landing import land, read_csv
from starkeep.sources.store import TableStore
from starkeep.sources.tables import YEAR_COLUMN, without_triage

RUN_DATE = date(2024, 6, 1)


def landed(spark, df, source, fmt="csv", **options):
    """The landing root of a new folder that holds ``df`` as one batch."""
    root = scratch_path(spark, "landing")
    land(df, root, source, RUN_DATE, fmt, **options)
    return root


def two_layouts(spark, folder):
    """Codes landed on two days: the older files lack a column, the newer have one more in front."""
    codes = feeds.code_feed(spark, folder)
    key = F.trim("IUCR").cast("int")
    root = scratch_path(spark, "landing")
    land(codes.filter(key % 3 == 0).drop("Active"), root, "codes", date(2024, 5, 1))
    newer = codes.filter(key % 3 != 0).select(F.lit("n,1").alias("Note"), *reversed(codes.columns))
    land(newer, root, "codes", RUN_DATE)
    return root


@query(f"""
WITH {feeds.CODES_SQL}
SELECT iucr, primary_description, secondary_description, index_code,
    CASE WHEN CAST(iucr AS INTEGER) % 3 <> 0 THEN active END AS active, _ingest_year
FROM codes
""")
def changing_headers(spark, folder):
    """Files of different layouts are each read by their own header."""
    return cleaning.load_codes(spark, two_layouts(spark, folder), "codes", RUN_DATE)


def text_times(spark, folder):
    """Event times as text in both formats, one type unreadable."""
    kind = F.col("event_type")
    text = F.when(kind == "click", F.date_format("ts", feeds.US))
    text = text.when(kind == "error", F.concat(F.lit("13/45/"), F.year("ts")))
    text = text.when(kind == "view", "").otherwise(F.date_format("ts", feeds.ISO))
    events = Tables(spark, folder).events
    return events.select("event_id", "event_type", text.alias("text"))


@query("""
SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL
    WHEN event_type = 'click' THEN date_trunc('second', ts)
    ELSE CAST(date_trunc('millisecond', ts) AS TIMESTAMP) END AS event_time
FROM events
""")
def two_format_times(spark, folder):
    times = text_times(spark, folder)
    return times.select("event_id", parse_event_time(F.col("text")).alias("event_time"))


TRIAGE_SQL = """
SELECT CAST(CASE WHEN event_type IN ('error', 'view') THEN 9999 ELSE year(ts) END
    AS SMALLINT) AS _ingest_year, count(*) AS n_rows
FROM events GROUP BY 1"""


def _triaged(spark, folder):
    year = partition_year(parse_event_time(F.col("text")))
    return text_times(spark, folder).withColumn("_ingest_year", year)


@query(TRIAGE_SQL)
def triage_counts(spark, folder):
    """Rows per partition year, unreadable times in the triage partition."""
    years = _triaged(spark, folder).groupBy("_ingest_year")
    return years.agg(F.count("*").alias("n_rows"))


@query(f"SELECT * FROM ({TRIAGE_SQL}) AS t WHERE _ingest_year <> 9999")
def triage_excluded(spark, folder):
    kept = without_triage(_triaged(spark, folder)).groupBy("_ingest_year")
    return kept.agg(F.count("*").alias("n_rows"))


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE
    WHEN 'purchase' THEN TRUE END AS flag FROM events
""")
def tolerant_flags(spark, folder):
    kind = F.col("event_type")
    text = F.when(kind == "click", " TRUE").when(kind == "view", "False ")
    text = text.when(kind == "purchase", "true").when(kind == "error", "banana")
    events = Tables(spark, folder).events
    return events.select("event_id", parse_bool(text).alias("flag"))


@query(f"WITH {feeds.INCIDENTS_SQL} SELECT * FROM incidents")
def clean_incidents(spark, folder):
    root = landed(spark, feeds.incident_feed(spark, folder), "incidents")
    return cleaning.load_incidents(spark, root, "incidents")


@query(f"WITH {feeds.INCIDENTS_SQL} SELECT * FROM incidents")
def incremental_incidents(spark, folder):
    """First reports cleaned, then the corrections of a later ingest date added."""
    feed = feeds.incident_feed(spark, folder)
    first = F.col("Description") == "version 1"
    root = landed(spark, feed.filter(first), "incidents")
    store = TableStore(spark, scratch_path(spark, "store"))
    cleaned = cleaning.load_incidents(spark, root, "incidents")
    store.publish("incidents", cleaned, YEAR_COLUMN)
    later = date(2024, 6, 2)
    land(feed.filter(~first), root, "incidents", later)
    return cleaning.add_incidents(store, "incidents", root, "incidents", [later])


@query(f"WITH {feeds.CODES_SQL} SELECT * FROM codes")
def clean_code_snapshot(spark, folder):
    root = landed(spark, feeds.code_feed(spark, folder), "codes")
    return cleaning.load_codes(spark, root, "codes", RUN_DATE)


@query(f"WITH {feeds.areas_sql()} SELECT * FROM areas")
def clean_area_snapshot(spark, folder):
    root = landed(spark, feeds.area_feed(spark, folder), "areas")
    return cleaning.load_areas(spark, root, "areas", RUN_DATE)


@query(f"WITH {feeds.WEATHER_SQL} SELECT * FROM weather")
def clean_hourly_json(spark, folder):
    feed = feeds.weather_feed(spark, folder)
    root = landed(spark, feed, "weather", "json", maxRecordsPerFile=1)
    return cleaning.load_weather(spark, root, "weather")


ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders"""


@query(ORDERS_SQL)
def csv_round_trip(spark, folder):
    """Text columns back to their types."""
    orders = Tables(spark, folder).orders
    root = landed(spark, orders, "orders")
    raw = read_csv(spark, root, "orders").drop("ingest_date")
    return cast_columns(raw, dict(orders.dtypes))


@query("""
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status,
    CAST(NULL AS VARCHAR) AS remark, CAST(floor(o_totalprice) AS BIGINT) AS total
FROM orders WHERE o_totalprice IS NOT NULL
""")
def conformed_columns(spark, folder):
    """Untidy headers to a fixed schema: renamed, dropped, added, cast and tagged."""
    orders = Tables(spark, folder).orders
    untidy = orders.toDF(
        "Order Key", "custKey", " Order-Status!", "TOTAL PRICE", "Order  Date", "priority"
    )
    named = rename_present(snake_columns(untidy), {"total_price": "total", "absent": "x"})
    named = named.withColumn("total", F.floor("total"))
    named = named.drop("order_date", "never_there")
    target = table(
        order_key="long",
        cust_key="long",
        order_status="string",
        remark="string",
        total="long",
    )
    return tag_columns(conform(named, target), {"total": {"role": "measure"}})
