"""Keys looked up in dimensions."""


from pyspark.sql import functions as F

from starkeep.functions.keys import date_key, hour_key
from starkeep.operators.asof import asof_key
from starkeep.operators.dimensions import days_covering, describe_days
from starkeep.operators.joins import enrich, left_lookup
from starkeep.operators.surrogate import assign_keys
from starkeep.plans.reports import prefixed
from starkeep.queries.merging import HISTORY_SQL, USERS, user_history
from starkeep.queries.registry import Tables, query
from starkeep.sources.files import materialize

ASOF_SQL = f"""
WITH {HISTORY_SQL}, dimension AS (
    SELECT *, row_number() OVER (ORDER BY user_id, scd_start_date) AS user_key
    FROM history),
facts AS (
    SELECT event_id, nullif(user_id, 7) AS user_id,
        CASE WHEN value >= 2 THEN CAST(ts AS DATE) END AS event_day
    FROM events)
SELECT facts.*, coalesce(user_key, 0) AS user_key
FROM facts LEFT JOIN dimension AS d ON d.user_id = facts.user_id
    AND event_day >= scd_start_date AND event_day < scd_end_date"""


def _asof(spark, folder, **options):
    events = Tables(spark, folder).events
    versions = assign_keys(
        user_history(events), USERS.surrogate, ["user_id", "scd_start_date"]
    )
    facts = events.select(
        "event_id",
        F.nullif("user_id", F.lit(7)).alias("user_id"),
        F.when(F.col("value") >= 2, F.to_date("ts")).alias("event_day"),
    )
    return asof_key(facts, materialize(versions, "versions"), USERS, "event_day", **options)


@query(ASOF_SQL)
def asof_lookup(spark, folder):
    """The user's version on the day of the event, small dimension."""
    return _asof(spark, folder)


@query(ASOF_SQL)
def asof_lookup_large(spark, folder):
    """The same when the dimension may not be broadcast."""
    return _asof(spark, folder, broadcast_rows=0)


GRID_SQL = """
    grid AS (
        SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS obs_date_key,
            CAST(hour(ts) AS SMALLINT) AS obs_hour, count(*) AS n_purchases
        FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
    keyed AS (
        SELECT *, row_number() OVER (ORDER BY obs_date_key, obs_hour) AS grid_key
        FROM grid)"""


def _grid(events):
    """Hours with a purchase; other hours are gaps."""
    hours = events.filter(F.col("event_type") == "purchase").groupBy(
        date_key(F.col("ts")).alias("obs_date_key"), hour_key(F.col("ts")).alias("obs_hour")
    )
    counted = hours.agg(F.count("*").alias("n_purchases"))
    return assign_keys(counted, "grid_key", ["obs_date_key", "obs_hour"])


def _two_keys(spark, folder, **options):
    events = Tables(spark, folder).events
    facts = events.select(
        "event_id", date_key(F.col("ts")).alias("day"), hour_key(F.col("ts")).alias("hour")
    )
    return left_lookup(
        facts,
        materialize(_grid(events), "grid"),
        {"day": "obs_date_key", "hour": "obs_hour"},
        {"grid_key": "grid_key", "n_purchases": "n_purchases"},
        defaults={"grid_key": -1},
        **options,
    )


TWO_KEY_SQL = f"""
WITH {GRID_SQL}
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day,
    CAST(hour(ts) AS SMALLINT) AS hour, coalesce(grid_key, -1) AS grid_key, n_purchases
FROM events LEFT JOIN keyed ON obs_date_key = CAST(strftime(ts, '%Y%m%d') AS INTEGER)
    AND obs_hour = hour(ts)"""


@query(TWO_KEY_SQL)
def two_key_lookup(spark, folder):
    """Key -1 in the gaps, the measure stays NULL there."""
    return _two_keys(spark, folder)


@query(TWO_KEY_SQL)
def two_key_lookup_large(spark, folder):
    """The same with salted hot keys instead of a broadcast."""
    return _two_keys(spark, folder, broadcast_rows=0)


@query("""
SELECT c_custkey, n_name, coalesce(n_regionkey, -1) AS n_regionkey
FROM customer LEFT JOIN nation ON n_nationkey = nullif(c_nationkey, 3)
""")
def enriched_members(spark, folder):
    t = Tables(spark, folder)
    place = F.nullif("c_nationkey", F.lit(3)).alias("place")
    fields = {"n_name": "string", "n_regionkey": "int"}
    found = enrich(
        t.customer.select("c_custkey", place),
        t.nation,
        {"place": "n_nationkey"},
        fields,
        {"n_regionkey": -1},
    )
    return found.drop("place")


@query("""
SELECT c_custkey, CAST(NULL AS VARCHAR) AS n_name, CAST(-1 AS INTEGER) AS n_regionkey
FROM customer
""")
def members_without_source(spark, folder):
    fields = {"n_name": "string", "n_regionkey": "int"}
    customers = Tables(spark, folder).customer.select("c_custkey")
    return enrich(customers, None, {}, fields, {"n_regionkey": -1})


@query("""
SELECT year(o_orderdate) AS order_year, monthname(l_shipdate) AS ship_month,
    dayname(l_shipdate) AS ship_day, count(*) AS n_lines
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3
""")
def role_playing_dates(spark, folder):
    """One calendar in two roles; it covers the days of both."""
    t = Tables(spark, folder)
    both = t.lineitem.select(F.to_date("l_shipdate").alias("day"))
    both = both.union(t.orders.select(F.to_date("o_orderdate")))
    calendar = F.broadcast(describe_days(days_covering(both, "day")))  # one row a day
    lines = t.lineitem.select("l_orderkey", date_key(F.col("l_shipdate")).alias("shipped"))
    orders = t.orders.select("o_orderkey", date_key(F.col("o_orderdate")).alias("ordered"))
    facts = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    roles = facts.join(
        prefixed(calendar, "ord_"), F.col("ordered") == F.col("ord_date_key")
    ).join(prefixed(calendar, "shp_"), F.col("shipped") == F.col("shp_date_key"))
    groups = roles.groupBy(
        F.col("ord_year").cast("bigint").alias("order_year"),
        F.col("shp_month_name").alias("ship_month"),
        F.col("shp_day_name").alias("ship_day"),
    )
    return groups.agg(F.count("*").alias("n_lines"))
