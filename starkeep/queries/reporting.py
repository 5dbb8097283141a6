"""Reports over a retail star: order lines with their order, customer, nation and part."""

from datetime import date

from pyspark.sql import functions as F

from starkeep.functions.banding import first_match, temperature_band
from starkeep.functions.calendar import day_of_week
from starkeep.functions.keys import date_key, flag_measure, hour_key
from starkeep.operators import filters
from starkeep.operators.dimensions import days_covering, describe_days
from starkeep.plans import reports as R
from starkeep.queries.registry import Tables, money, query
from starkeep.sources.files import materialize, scratch_path
from starkeep.sources.store import TableStore


def calendar(df, column):
    """The days the events cover."""
    return describe_days(days_covering(df, column))


def star(spark, folder):
    """Lines joined with their dimensions; Catalyst prunes what a report does not use."""
    t = Tables(spark, folder)
    lines = t.lineitem.withColumns(
        {
            "line_count": F.lit(1),
            "is_returned": flag_measure(F.col("l_returnflag") == "R"),
            "amount": money("l_extendedprice"),
            "quantity": F.col("l_quantity").cast("bigint"),
        }
    )
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


PUBLISHED: dict[tuple[str, str], TableStore] = {}


def published_lines(spark, folder):
    """What the visuals read of the star, joined once in an application and published by year.

    A visual is then one scan of the few columns it names, without a join.
    """
    key = (spark.sparkContext.applicationId, folder)
    store = PUBLISHED.get(key)
    if store is None or not store.exists("lines"):
        store = TableStore(spark, scratch_path(spark, "reports"))
        columns = ["line_count", "is_returned", "amount", "l_returnflag", "n_name", "c_mktsegment"]
        lines = star(spark, folder).select(
            *columns, F.to_date("o_orderdate").alias("o_orderdate"), F.year("o_orderdate").alias("order_year")
        )
        store.publish("lines", lines, "order_year", sort_by=["o_orderdate"])
        PUBLISHED[key] = store
    return store.read("lines")


STAR_SQL = """
    star AS (
        SELECT *, 1 AS line_count, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END
                AS is_returned,
            CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
            CAST(l_quantity AS BIGINT) AS quantity,
            CAST(date_trunc('month', o_orderdate) AS DATE) AS month
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""


def star_query(select):
    return query(f"WITH {STAR_SQL} {select}")


def plain(df, *decimals):
    """Exact sums as doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


@query("""
SELECT n_name, c_mktsegment, count(*) AS n_orders
FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
WHERE year(o_orderdate) = 1997
GROUP BY 1, 2 ORDER BY n_orders DESC, n_name, c_mktsegment LIMIT 10
""")
def smoke_top10(spark, folder):
    """Largest groups of one calendar year."""
    t = Tables(spark, folder)
    facts = t.orders.select("o_custkey", date_key(F.col("o_orderdate")).alias("date_key"))
    year = calendar(t.orders, "o_orderdate").filter("year = 1997").select("date_key")
    joined = R.join_star(
        facts,
        [
            (F.broadcast(year), "date_key", "date_key"),
            (t.customer, "o_custkey", "c_custkey"),
            (t.nation, "c_nationkey", "n_nationkey"),
        ],
    )
    counts = R.summarise(joined, ["n_name", "c_mktsegment"], count="n_orders")
    return R.top(counts, "n_orders", ["n_name", "c_mktsegment"])


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber, l_partkey,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
    greatest(CAST(o_orderdate AS DATE), DATE '1996-01-01') AS ordered_from,
    least(CAST(l_shipdate AS DATE), DATE '2000-12-31') AS shipped_until,
    coalesce(nullif(n_name, 'NATION_3'), 'Unknown') AS nation,
    coalesce(nullif(c_mktsegment, 'MACHINERY'), 'U') AS segment, p_brand, s_name,
    nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
WHERE l_discount <> 0 AND l_tax <> 0
""")
def star_extract(spark, folder):
    """Wide extract: re-typed, defaulted, clamped; incomplete rows left out."""
    t = Tables(spark, folder)
    facts = t.lineitem.withColumns(
        {"discount": F.nullif("l_discount", F.lit(0)), "tax": F.nullif("l_tax", F.lit(0))}
    )
    wide = R.join_star(
        filters.complete(facts, ["discount", "tax"]),
        [
            (t.orders, "l_orderkey", "o_orderkey"),
            (t.customer, "o_custkey", "c_custkey"),
            (t.nation, "c_nationkey", "n_nationkey"),
            (t.part, "l_partkey", "p_partkey"),
            (t.supplier, "l_suppkey", "s_suppkey"),
        ],
    )
    nation = F.nullif("n_name", F.lit("NATION_3"))
    segment = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    ordered, shipped = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    return wide.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").cast("double").alias("amount"),
        F.greatest(ordered, F.lit(date(1996, 1, 1))).alias("ordered_from"),
        F.least(shipped, F.lit(date(2000, 12, 31))).alias("shipped_until"),
        F.coalesce(nation, F.lit("Unknown")).alias("nation"),
        F.coalesce(segment, F.lit("U")).alias("segment"),
        "p_brand",
        "s_name",
        "discount",
        "tax",
    )


SUMS_SQL = """CAST(sum(line_count) AS BIGINT) AS n_lines,
    CAST(sum(is_returned) AS BIGINT) AS n_returned"""
SUMS = {"n_lines": "line_count", "n_returned": "is_returned"}
RATE_SQL = "CAST(sum(is_returned) AS DOUBLE) * 100 / CAST(sum(line_count) AS DOUBLE)"


@star_query(f"SELECT {SUMS_SQL}, {RATE_SQL} AS return_rate FROM star")
def kpi_totals(spark, folder):
    totals = R.total(published_lines(spark, folder), SUMS)
    return R.with_ratio(totals, "return_rate", "n_returned", "n_lines")


@star_query(f"SELECT month, {SUMS_SQL} FROM star GROUP BY 1")
def monthly_trend(spark, folder):
    return R.monthly_trend(published_lines(spark, folder), "o_orderdate", SUMS)


@star_query("""
SELECT c_mktsegment, CAST(sum(amount) AS DOUBLE) AS amount,
    CAST(sum(amount) AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM star) AS share
FROM star GROUP BY 1
""")
def category_share(spark, folder):
    shares = R.category_share(published_lines(spark, folder), "c_mktsegment", "amount")
    return plain(shares, "amount")


@star_query(f"SELECT n_name, c_mktsegment, {SUMS_SQL} FROM star GROUP BY 1, 2")
def detail_table(spark, folder):
    return R.summarise(published_lines(spark, folder), ["n_name", "c_mktsegment"], SUMS)


PAGE = {
    "kpi": [],
    "trend": ["month"],
    "share": ["c_mktsegment"],
    "detail": ["n_name", "c_mktsegment"],
    "by place": ["month", "n_name"],
}


@star_query(f"""
SELECT CASE GROUPING(month, n_name, c_mktsegment) WHEN 7 THEN 'kpi' WHEN 3 THEN 'trend'
        WHEN 6 THEN 'share' WHEN 4 THEN 'detail' ELSE 'by place' END AS visual,
    month, n_name, c_mktsegment, {SUMS_SQL}, CAST(sum(amount) AS DOUBLE) AS amount
FROM star GROUP BY GROUPING SETS ((), (month), (c_mktsegment), (n_name, c_mktsegment), (month, n_name))
""")
def report_page(spark, folder):
    """Totals, trend, shares, detail and places over time from one scan."""
    lines = published_lines(spark, folder).withColumn("month", R.month_of("o_orderdate"))
    return plain(R.page(lines, PAGE, SUMS | {"amount": "amount"}), "amount")


@star_query("""
SELECT c_mktsegment, CAST(sum(amount) AS DOUBLE) AS amount,
    CAST(sum(amount) AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM star) AS share,
    CAST(sum(is_returned) AS DOUBLE) * 100 / (SELECT CAST(sum(line_count) AS DOUBLE) FROM star) AS returned_of_all
FROM star GROUP BY 1
""")
def visuals_of_a_page(spark, folder):
    """A visual drawn from two others of a page that was computed once: shares of the totals."""
    sums = SUMS | {"amount": "amount"}
    lines = published_lines(spark, folder)
    rows = materialize(R.page(lines, {"kpi": [], "share": ["c_mktsegment"]}, sums), "page")
    amount, lines = (R.visual(rows, "kpi", [], [n]).scalar().cast("double") for n in ("amount", "n_lines"))
    return R.visual(rows, "share", ["c_mktsegment"], list(sums)).select(
        "c_mktsegment",
        F.col("amount").cast("double").alias("amount"),
        F.try_divide(F.col("amount").cast("double"), amount).alias("share"),
        F.try_divide(F.col("n_returned").cast("double") * 100, lines).alias("returned_of_all"),
    )


@star_query(f"""
SELECT month, n_name, {SUMS_SQL}, {RATE_SQL} AS return_rate FROM star GROUP BY 1, 2
""")
def ratio_by_month(spark, folder):
    """Rate over time by place, from additive parts."""
    sums = R.monthly_trend(published_lines(spark, folder), "o_orderdate", SUMS, ["n_name"])
    return R.with_ratio(sums, "return_rate", "n_returned", "n_lines")


@star_query("SELECT n_name, month, c_mktsegment, count(*) AS n_lines FROM star GROUP BY ALL")
def place_month_category(spark, folder):
    groups = {
        "n_name": F.col("n_name"),
        "month": R.month_of("o_orderdate"),
        "c_mktsegment": F.col("c_mktsegment"),
    }
    return R.summarise(published_lines(spark, folder), groups, count="n_lines")


@star_query("""
SELECT month, n_name, CAST(sum(is_returned) AS BIGINT) AS n_returned
FROM star WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2
""")
def returns_by_month_place(spark, folder):
    kept = filters.in_categories(published_lines(spark, folder), "l_returnflag", ["A", "R"])
    return R.monthly_trend(kept, "o_orderdate", {"n_returned": "is_returned"}, ["n_name"])


@query("""
SELECT r_name, n_name, c_mktsegment, count(*) AS n_customers,
    CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3
""")
def geo_points(spark, folder):
    t = Tables(spark, folder)
    members = R.join_star(
        t.customer.withColumn("balance", money("c_acctbal")),
        [
            (t.nation, "c_nationkey", "n_nationkey"),
            (t.region, "n_regionkey", "r_regionkey"),
        ],
    )
    keys = ["r_name", "n_name", "c_mktsegment"]
    points = R.summarise(members, keys, {"balance": "balance"}, count="n_customers")
    return plain(points, "balance")


def _event_hours(spark, folder):
    return Tables(spark, folder).events.select(
        "event_type",
        "value",
        F.date_format("ts", "EEEE").alias("day_name"),
        day_of_week(F.col("ts")).alias("dow"),
        hour_key(F.col("ts")).alias("hour"),
        F.lit(1).alias("one"),
        money("value").alias("amount"),
    )


@query("""
SELECT dayname(ts) AS day_name, CAST(hour(ts) AS SMALLINT) AS hour, count(*) AS n_events,
    CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS amount
FROM events GROUP BY 1, 2
""")
def heat_map(spark, folder):
    sums = {"n_events": "one", "amount": "amount"}
    return plain(R.heat_map(_event_hours(spark, folder), "day_name", "hour", sums), "amount")


@query("""
SELECT CAST(hour(ts) AS SMALLINT) AS hour,
""" + ",\n".join(
    f"CAST(sum(CASE WHEN dayofweek(ts) = {d} THEN 1 END) AS BIGINT) AS \"{d}\""
    for d in range(7)
) + " FROM events GROUP BY 1")
def heat_grid(spark, folder):
    """Hours by days of the week (0 = Sunday) as columns."""
    return R.heat_grid(_event_hours(spark, folder), "hour", "dow", range(7), "one")


@query("""
SELECT CAST(hour(ts) AS SMALLINT) AS hour, count(*) AS n_events FROM events
WHERE event_type = 'purchase' GROUP BY 1
""")
def hour_pattern(spark, folder):
    hours = filters.in_categories(_event_hours(spark, folder), "event_type", ["purchase"])
    return R.summarise(hours, ["hour"], count="n_events")


@query("""
SELECT CASE WHEN value < 0 THEN 'Freezing' WHEN value < 10 THEN 'Cold'
        WHEN value < 20 THEN 'Mild' WHEN value < 30 THEN 'Warm' ELSE 'Hot' END AS band,
    CAST(hour(ts) AS SMALLINT) AS hour, count(*) AS n_events,
    count(CASE WHEN event_type IN ('error', 'signup') THEN 1 END) AS n_severe
FROM events GROUP BY 1, 2
""")
def band_by_hour(spark, folder):
    """Weather-like bands against severe types by hour."""
    events = _event_hours(spark, folder)
    severe = flag_measure(F.col("event_type").isin("error", "signup"))
    groups = {"band": temperature_band(F.col("value")), "hour": F.col("hour")}
    return R.summarise(
        events.withColumn("severe", severe), groups, {"n_severe": "severe"}, count="n_events"
    )


@query("""
SELECT p_type, avg(l_quantity) AS mean_quantity, avg(p_size) AS mean_size,
    count(*) AS n_lines
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1
""")
def scatter(spark, folder):
    t = Tables(spark, folder)
    joined = R.join_star(t.lineitem, [(t.part, "l_partkey", "p_partkey")])
    averages = {"mean_quantity": "l_quantity", "mean_size": "p_size"}
    return R.summarise(joined, ["p_type"], averages=averages, count="n_lines")


@query("""
SELECT CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low'
        ELSE 'high' END AS band, count(*) AS n_orders,
    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_final,
    CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) * 100
        / CAST(count(*) AS DOUBLE) AS final_rate
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1
""")
def rate_by_band(spark, folder):
    """A rate by a banded attribute of the member."""
    t = Tables(spark, folder)
    joined = R.join_star(t.orders, [(t.customer, "o_custkey", "c_custkey")])
    joined = joined.withColumn("final", flag_measure(F.col("o_orderstatus") == "F"))
    balance = F.col("c_acctbal")
    band = first_match([(balance < 0, "debt"), (balance < 5000, "low")], "high")
    sums = R.summarise(joined, {"band": band}, {"n_final": "final"}, count="n_orders")
    return R.with_ratio(sums, "final_rate", "n_final", "n_orders")


@query("""
SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
WHERE (o_orderdate IS NULL OR o_orderstatus = 'P'
       OR (o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1998-07-01'))
  AND o_orderpriority IN ('1-URGENT', '5-LOW')
""")
def report_filters(spark, folder):
    """Day range (rows without a day pass), chosen categories, and no choice."""
    orders = Tables(spark, folder).orders
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    kept = filters.in_days(
        orders.withColumn("day", day), "day", date(1996, 3, 1), date(1998, 6, 30)
    )
    kept = filters.in_categories(kept, "o_orderpriority", ["1-URGENT", "5-LOW"])
    kept = filters.in_categories(kept, "o_orderstatus")
    return kept.select("o_orderkey", "o_orderdate", "o_orderpriority")


@query("""
WITH o AS (
    SELECT CAST(day(o_orderdate) AS INTEGER) AS day_of_month, count(*) AS n_orders
    FROM orders WHERE day(o_orderdate) > 2 GROUP BY 1),
e AS (
    SELECT CAST(day(ts) AS INTEGER) AS day_of_month, count(*) AS n_events
    FROM events GROUP BY 1)
SELECT coalesce(o.day_of_month, e.day_of_month) AS day_of_month, n_orders, n_events
FROM o FULL JOIN e ON o.day_of_month = e.day_of_month
""")
def drill_across(spark, folder):
    """Two facts at one grain; either side may lack a group."""
    t = Tables(spark, folder)
    orders = t.orders.select(F.dayofmonth("o_orderdate").alias("day_of_month"))
    orders = orders.filter(F.col("day_of_month") > 2)
    events = t.events.select(F.dayofmonth("ts").alias("day_of_month"))
    grain = ["day_of_month"]
    parts = {
        "orders": R.summarise(orders, grain, count="n_orders"),
        "events": R.summarise(events, grain, count="n_events"),
    }
    return R.drill_across(parts, grain)


@query("""
SELECT l_orderkey AS case_number, count(*) AS n_rows,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS amount
FROM lineitem GROUP BY 1
""")
def case_rollup(spark, folder):
    """Facts grouped by a number they carry without a dimension."""
    lines = Tables(spark, folder).lineitem.withColumn("amount", money("l_extendedprice"))
    groups = {"case_number": F.col("l_orderkey")}
    return plain(R.summarise(lines, groups, {"amount": "amount"}, count="n_rows"), "amount")
