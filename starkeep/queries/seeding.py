"""Calendar, clock and junk dimensions, tied to the days and hours that tables use."""

from datetime import date

from pyspark.sql import functions as F

from starkeep.functions.banding import first_match
from starkeep.functions.hashing import change_hash
from starkeep.functions.keys import date_key, elapsed_hours, flag_measure, hour_key
from starkeep.operators import dimensions as D
from starkeep.operators.joins import left_lookup
from starkeep.plans import reports
from starkeep.plans.schemas import FLAG_LABELS
from starkeep.queries.registry import Tables, query

DAYS_SQL = """
    SELECT CAST(d AS DATE) AS d FROM (
        SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (
            SELECT date_trunc('day', min(o_orderdate))::TIMESTAMP AS lo,
                   date_trunc('day', max(o_orderdate))::TIMESTAMP AS hi
            FROM orders) AS ends) AS days"""

HOLIDAY_SQL = """
    SELECT d, CASE
        WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year'
        WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
        WHEN month(d) = 11 AND day(d) = 11 THEN 'Veterans Day'
        WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas'
        WHEN month(d) = 6 AND day(d) = 19 AND year(d) >= 2021 THEN 'Juneteenth'
        WHEN month(d) = 1 AND dow = 1 AND day(d) BETWEEN 15 AND 21
            THEN 'Martin Luther King Day'
        WHEN month(d) = 2 AND dow = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Presidents Day'
        WHEN month(d) = 5 AND dow = 1 AND day(d) BETWEEN 25 AND 31 THEN 'Memorial Day'
        WHEN month(d) = 9 AND dow = 1 AND day(d) BETWEEN 1 AND 7 THEN 'Labor Day'
        WHEN month(d) = 10 AND dow = 1 AND day(d) BETWEEN 8 AND 14 THEN 'Columbus Day'
        WHEN month(d) = 11 AND dow = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving'
        END AS holiday
    FROM (SELECT d, dayofweek(d) AS dow FROM days) AS x"""


@query(f"""
WITH days AS ({DAYS_SQL}), flagged AS ({HOLIDAY_SQL}),
used AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
members AS (
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(dayofweek(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
        dayofweek(d) IN (0, 6) AS is_weekend, holiday IS NOT NULL AS is_us_holiday,
        CAST(month(d) AS SMALLINT) AS month_num, monthname(d) AS month_name,
        CAST(quarter(d) AS SMALLINT) AS quarter, CAST(year(d) AS SMALLINT) AS year,
        CAST(week(d) AS SMALLINT) AS iso_week
    FROM flagged
    UNION ALL
    SELECT 0, DATE '0001-01-01', 0, 'Unknown', FALSE, FALSE, 0, 'Unknown', 0, 0, 0)
SELECT members.*, coalesce(n, 0) AS n_orders, n IS NOT NULL AS is_used
FROM members LEFT JOIN used ON used.d = members.full_date
""")
def calendar_dim(spark, folder):
    """Calendar over the days orders cover, with the orders of each day."""
    orders = Tables(spark, folder).orders
    days = D.describe_days(D.days_covering(orders, "o_orderdate"))
    calendar = D.with_reserved(days, [D.UNKNOWN_DAY])
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("day"))
    used = per_day.agg(F.count("*").alias("n_orders"))
    joined = calendar.join(used, F.col("full_date") == F.col("day"), "left")
    return joined.select(
        *calendar.columns,
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.col("day").isNotNull().alias("is_used"),
    )


@query(f"""
WITH days AS ({DAYS_SQL}), flagged AS ({HOLIDAY_SQL})
SELECT d AS full_date, holiday FROM flagged WHERE holiday IS NOT NULL
""")
def holiday_list(spark, folder):
    return D.holidays(D.days_covering(Tables(spark, folder).orders, "o_orderdate"))


@query("""
WITH hours AS (SELECT CAST(range AS INTEGER) AS h FROM range(24)),
used AS (SELECT hour(ts) AS h, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(hours.h AS SMALLINT) AS time_key, CAST(hours.h AS SMALLINT) AS hour_24,
    CAST(CASE WHEN hours.h % 12 = 0 THEN 12 ELSE hours.h % 12 END AS SMALLINT) AS hour_12,
    CASE WHEN hours.h < 12 THEN 'AM' ELSE 'PM' END AS am_pm,
    CASE WHEN hours.h <= 4 THEN 'Late Night' WHEN hours.h <= 8 THEN 'Early Morning'
         WHEN hours.h <= 11 THEN 'Morning' WHEN hours.h <= 16 THEN 'Afternoon'
         WHEN hours.h <= 20 THEN 'Evening' ELSE 'Night' END AS period_of_day,
    coalesce(n, 0) AS n_events
FROM hours LEFT JOIN used ON used.h = hours.h
""")
def time_of_day_dim(spark, folder):
    events = Tables(spark, folder).events
    used = events.groupBy(hour_key(F.col("ts")).alias("h")).agg(F.count("*").alias("n"))
    hours = D.time_of_day_dimension(spark)
    joined = hours.join(used, F.col("time_key") == F.col("h"), "left")
    return joined.select(*hours.columns, F.coalesce("n", F.lit(0)).alias("n_events"))


@query("""
WITH flags AS (
    SELECT DISTINCT nullif(l_returnflag, 'N') AS returned, l_linestatus AS status
    FROM lineitem)
SELECT CAST(CASE WHEN returned IS NULL OR status IS NULL THEN 0
        ELSE 1 + CASE returned WHEN 'A' THEN 0 ELSE 1 END
               + 2 * CASE status WHEN 'F' THEN 0 ELSE 1 END END AS BIGINT) AS flags_key,
    returned, status
FROM flags
""")
def junk_dim(spark, folder):
    flags = Tables(spark, folder).lineitem.select(
        F.nullif("l_returnflag", F.lit("N")).alias("returned"),
        F.col("l_linestatus").alias("status"),
    )
    domains = [["A", "R"], ["F", "O"]]
    return D.observed_combinations(flags, "flags_key", ["returned", "status"], domains)


@query("""
WITH flags AS (
    SELECT CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS is_arrest,
           CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'O' END AS is_domestic
    FROM lineitem)
SELECT CAST(CASE WHEN is_arrest IS NULL OR is_domestic IS NULL THEN 0
        ELSE 1 + is_arrest::INT + 2 * is_domestic::INT END AS SMALLINT) AS flags_key,
    CASE WHEN is_arrest IS NULL OR is_domestic IS NULL THEN 'Unknown' ELSE
        CASE WHEN is_arrest THEN 'Arrest, ' ELSE 'No Arrest, ' END ||
        CASE WHEN is_domestic THEN 'Domestic' ELSE 'Non-Domestic' END END AS label,
    count(*) AS n_lines
FROM flags GROUP BY 1, 2
""")
def junk_lookup(spark, folder):
    """Three-valued flags to junk keys; unknown flags keep their own member."""
    known = F.col("l_returnflag") != "N"
    flags = Tables(spark, folder).lineitem.select(
        F.when(known, F.col("l_returnflag") == "R").alias("is_arrest"),
        F.when(known, F.col("l_linestatus") == "O").alias("is_domestic"),
    )
    keyed = left_lookup(
        flags,
        D.junk_dimension(spark, "flags_key", FLAG_LABELS),
        {"is_arrest": "is_arrest", "is_domestic": "is_domestic"},
        {"flags_key": "flags_key", "label": "label"},
        null_safe=True,
        defaults={"flags_key": 0, "label": "Unknown"},
        bounded=True,
    )
    return keyed.groupBy("flags_key", "label").agg(F.count("*").alias("n_lines"))


@query("""
SELECT c_custkey, sha256(concat_ws('||', c_name,
        coalesce(nullif(c_mktsegment, 'MACHINERY'), '<<NULL>>'),
        CAST(c_nationkey AS VARCHAR))) AS hash_hex
FROM customer
""")
def change_hashes(spark, folder):
    segment = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    customers = Tables(spark, folder).customer.withColumn("c_mktsegment", segment)
    digest = change_hash(["c_name", "c_mktsegment", "c_nationkey"])
    return customers.select("c_custkey", F.lower(F.hex(digest)).alias("hash_hex"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS order_date,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
    CAST(hour(o_orderdate) AS SMALLINT) AS order_hour,
    CASE WHEN l_returnflag = 'R'
         THEN CAST(trunc(date_diff('second', l_shipdate, o_orderdate) / 3600) AS INTEGER)
         WHEN l_returnflag = 'A'
         THEN CAST(trunc(date_diff('second', o_orderdate, l_shipdate) / 3600) AS INTEGER)
    END AS hours
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def hours_between(spark, folder):
    """Elapsed hours, also negative ones and unknown ends."""
    t = Tables(spark, folder)
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag"
    )
    orders = t.orders.select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    forward = elapsed_hours(F.col("o_orderdate"), F.col("l_shipdate"))
    back = elapsed_hours(F.col("l_shipdate"), F.col("o_orderdate"))
    hours = F.when(F.col("l_returnflag") == "R", back)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.to_date("o_orderdate").alias("order_date"),
        date_key(F.col("o_orderdate")).alias("order_date_key"),
        hour_key(F.col("o_orderdate")).alias("order_hour"),
        hours.when(F.col("l_returnflag") == "A", forward).alias("hours"),
    )


@query("""
WITH flags AS (
    SELECT event_type, CASE WHEN value < 10 THEN NULL ELSE value > 50 END AS high
    FROM events)
SELECT event_type, high, count(*) AS n_events,
    CAST(sum(CASE WHEN high THEN 1 ELSE 0 END) AS BIGINT) AS n_high
FROM flags GROUP BY 1, 2
""")
def flag_measures(spark, folder):
    high = F.when(F.col("value") >= 10, F.col("value") > 50)
    events = Tables(spark, folder).events.select("event_type", high.alias("high"))
    events = events.withColumn("measure", flag_measure(F.col("high")))
    return reports.summarise(
        events, ["event_type", "high"], {"n_high": "measure"}, count="n_events"
    )


@query("""
SELECT event_type,
    CASE WHEN value < 1 THEN 'tiny' WHEN value < 20 THEN 'low' WHEN value < 80 THEN 'mid'
         ELSE 'high' END AS band, count(*) AS n_events
FROM events GROUP BY 1, 2
""")
def value_band(spark, folder):
    value = F.col("value")
    rules = [(value < 1, "tiny"), (value < 20, "low"), (value < 80, "mid")]
    band = first_match(rules, "high").alias("band")
    counts = Tables(spark, folder).events.groupBy("event_type", band)
    return counts.agg(F.count("*").alias("n_events"))
