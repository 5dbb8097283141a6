"""The sample tables written out as the raw feeds the cleaning jobs read.

Each feed has a counterpart in SQL that gives the cleaned rows directly from the tables.
"""

from pyspark.sql import functions as F

from starkeep.queries.registry import Tables

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS"
US = "MM/dd/yyyy hh:mm:ss a"


def k_of(props):
    return F.get_json_object(props, "$.k").cast("int")


def padded(col, width):
    """Zeros in front up to ``width``; longer values stay whole (``lpad`` would cut them)."""
    text = col.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def incident_feed(spark, folder):
    """Every event as two reports, the second a later correction.

    Times come in both formats and some are unreadable, some ids are missing, flags and
    texts are untidy.
    """
    events = Tables(spark, folder).events
    event_type, value, user = F.col("event_type"), F.col("value"), F.col("user_id")
    updated = F.col("ts") + F.make_dt_interval(hours=F.col("version") * 5)
    when = F.when(value < 5, F.lit("unknown"))
    when = when.when(event_type == "click", F.date_format("ts", US))
    flag = F.when(F.col("version") == 1, "no").when(event_type == "purchase", "TRUE")
    flag = flag.when(event_type == "error", " False ").when(event_type == "view", "true")
    domestic = F.when(value > 50, "true").when(value > 20, "false").otherwise("")
    user_digits = padded(user, 6)
    keyless = (value < 1) | value.between(6, 7)
    reports = events.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    return reports.select(
        F.when(~keyless, F.col("event_id").cast("string")).alias("ID"),
        F.concat(F.lit("C"), "event_id").alias("Case Number"),
        when.otherwise(F.date_format("ts", ISO)).alias("Date"),
        F.concat(F.lit('the "'), event_type, F.lit('", corner')).alias("Block"),
        padded(k_of("props"), 4).alias("IUCR"),
        F.upper(event_type).alias("Primary Type"),
        F.concat(F.lit("version "), F.col("version")).alias("Description"),
        F.lit(None).cast("string").alias("Location Description"),
        flag.otherwise("").alias("Arrest"),
        domestic.alias("Domestic"),
        padded(user % 40, 4).alias("Beat"),
        padded(user % 20, 3).alias("District"),
        F.when(user % 10 == 3, "n/a").otherwise((user % 10).cast("string")).alias("Ward"),
        (user % 25).cast("string").alias("Community Area"),
        F.substring(event_type, 1, 2).alias("FBI Code"),
        F.lit("1").alias("X Coordinate"),
        F.lit("2").alias("Y Coordinate"),
        F.date_format("ts", "yyyy").alias("Year"),
        F.date_format(updated, ISO).alias("Updated On"),
        F.when(value >= 10, F.concat(F.lit("41."), user_digits)).alias("Latitude"),
        F.concat(F.lit("-87."), user_digits).alias("Longitude"),
        F.lit("(41, -87)").alias("Location"),
    )


# Cleaned incidents: rows without an id stay twice (both reports differ).
INCIDENTS_SQL = """
    incidents AS (
        SELECT CASE WHEN NOT keyless THEN event_id END AS id,
            'C' || event_id AS case_number,
            CASE WHEN value < 5 THEN NULL
                 WHEN event_type = 'click' THEN date_trunc('second', ts)
                 ELSE CAST(date_trunc('millisecond', ts) AS TIMESTAMP) END AS date,
            'the "' || event_type || '", corner' AS block,
            lpad(regexp_extract(props, '(\\d+)', 1),
                greatest(4, length(regexp_extract(props, '(\\d+)', 1)))::INT, '0') AS iucr,
            upper(event_type) AS primary_type, 'version ' || version AS description,
            CAST(NULL AS VARCHAR) AS location_description,
            CASE WHEN version = 1 THEN NULL WHEN event_type IN ('purchase', 'view')
                 THEN TRUE WHEN event_type = 'error' THEN FALSE END AS arrest,
            CASE WHEN value > 50 THEN TRUE WHEN value > 20 THEN FALSE END AS domestic,
            lpad(CAST(user_id % 40 AS VARCHAR), 4, '0') AS beat,
            lpad(CAST(user_id % 20 AS VARCHAR), 3, '0') AS district,
            CAST(nullif(user_id % 10, 3) AS SMALLINT) AS ward,
            CAST(user_id % 25 AS SMALLINT) AS community_area,
            substr(event_type, 1, 2) AS fbi_code,
            CAST(year(ts) AS SMALLINT) AS source_year,
            CAST(date_trunc('millisecond', ts + version * INTERVAL 5 HOUR) AS TIMESTAMP)
                AS updated_on,
            CASE WHEN value >= 10
                 THEN CAST(41 + user_id / 1e6 AS DECIMAL(9,6)) END AS latitude,
            CAST(-87 - user_id / 1e6 AS DECIMAL(9,6)) AS longitude,
            CAST(CASE WHEN value < 5 OR keyless THEN 9999 ELSE year(ts) END AS SMALLINT)
                AS _ingest_year
        FROM (SELECT *, value < 1 OR value BETWEEN 6 AND 7 AS keyless,
                  unnest([1, 2]) AS version FROM events) AS e
        WHERE version = 2 OR keyless)"""


def code_feed(spark, folder):
    """Every part as a code of four characters or more, untidy."""
    parts = Tables(spark, folder).part
    return parts.select(
        F.concat(F.lit(" "), padded(F.col("p_partkey"), 4)).alias("IUCR"),
        F.col("p_name").alias("Primary Description"),
        F.col("p_type").alias("Secondary Description"),
        F.when(F.col("p_size") > 25, "i").otherwise("n").alias("Index Code"),
        F.when(F.col("p_size") % 3 == 0, "False")
        .when(F.col("p_size") % 3 == 1, "true")
        .otherwise("?")
        .alias("Active"),
    )


CODES_SQL = """
    codes AS (
        SELECT lpad(CAST(p_partkey AS VARCHAR),
                greatest(4, length(CAST(p_partkey AS VARCHAR)))::INT, '0') AS iucr,
            p_name AS primary_description, p_type AS secondary_description,
            CASE WHEN p_size > 25 THEN 'I' ELSE 'N' END AS index_code,
            CASE p_size % 3 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END AS active,
            CAST(2024 AS SMALLINT) AS _ingest_year
        FROM part
        QUALIFY row_number() OVER (PARTITION BY iucr ORDER BY primary_description DESC,
            secondary_description DESC, index_code DESC, active DESC NULLS LAST) = 1)"""


def area_feed(spark, folder, shift=0):
    """Every nation as an area, with indicators of its customers."""
    t = Tables(spark, folder)
    counts = t.customer.groupBy("c_nationkey").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("poor"),
    )
    joined = t.nation.join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    n, poor = F.coalesce("n", F.lit(0)), F.coalesce("poor", F.lit(0))
    text = lambda col: col.cast("string")
    return joined.select(
        text(F.col("n_nationkey")).alias("ca"),
        F.col("n_name").alias("community_area_name"),
        F.concat(text(n % 100), F.lit(".5")).alias("PERCENT OF HOUSING CROWDED"),
        F.concat(text((poor + shift) % 100), F.lit(".25")).alias(
            "PERCENT HOUSEHOLDS BELOW POVERTY"
        ),
        F.lit("n/a").alias("PERCENT AGED 16+ UNEMPLOYED"),
        F.lit("7").alias("PERCENT AGED 25+ WITHOUT HIGH SCHOOL DIPLOMA"),
        F.lit("12.345").alias("PERCENT AGED UNDER 18 OR OVER 64"),
        text(n * 100).alias("PER CAPITA INCOME "),
        text(F.col("n_nationkey") * 3).alias("HARDSHIP INDEX"),
    )


def areas_sql(name="areas", shift=0):
    return f"""
    {name} AS (
        SELECT CAST(n_nationkey AS SMALLINT) AS community_area,
            n_name AS community_area_name,
            CAST(n % 100 + 0.5 AS DECIMAL(5,2)) AS pct_housing_crowded,
            CAST((poor + {shift}) % 100 + 0.25 AS DECIMAL(5,2)) AS pct_below_poverty,
            CAST(NULL AS DECIMAL(5,2)) AS pct_unemployed_16plus,
            CAST(7 AS DECIMAL(5,2)) AS pct_no_hs_25plus,
            CAST(12.35 AS DECIMAL(5,2)) AS pct_under18_or_over64,
            CAST(n * 100 AS INTEGER) AS per_capita_income_usd,
            CAST(n_nationkey * 3 AS SMALLINT) AS hardship_index,
            CAST(2024 AS SMALLINT) AS _ingest_year
        FROM (SELECT n_nationkey, n_name, count(c_custkey) AS n,
                  count(CASE WHEN c_acctbal < 0 THEN 1 END) AS poor
              FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
              GROUP BY ALL) AS x)"""


def weather_feed(spark, folder, size=5000, chosen=None):
    """Every event as an observation, or only ``chosen`` ones, in parallel arrays of those among ``size`` consecutive ids."""
    events = Tables(spark, folder).events
    k = k_of("props")
    item = F.struct(
        F.col("event_id"),
        F.when(F.col("event_type") == "signup", "?")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
        .alias("time"),
        (F.col("value") - 20).alias("temperature_2m"),
        F.when(F.col("event_type") != "purchase", k / 20.0).alias("precipitation"),
        F.col("value").alias("wind_speed_10m"),
        k.alias("weather_code"),
        k.cast("double").alias("relative_humidity_2m"),
    )
    block = F.floor(F.col("event_id") / size).alias("block")
    events = events if chosen is None else events.filter(chosen)
    grouped = events.groupBy(block).agg(F.sort_array(F.collect_list(item)).alias("rows"))
    names = ["time", "temperature_2m", "precipitation", "wind_speed_10m"]
    names += ["weather_code", "relative_humidity_2m"]
    hourly = F.struct(*[F.col(f"rows.{n}").alias(n) for n in names])
    return grouped.select(hourly.alias("hourly"))


WEATHER_SQL = """
    weather AS (
        SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS obs_time,
            CAST(value - 20 AS DECIMAL(5,2)) AS temperature_celsius,
            CASE WHEN event_type <> 'purchase' THEN CAST(k / 20.0 AS DECIMAL(6,2)) END
                AS precipitation_mm,
            CAST(value AS DECIMAL(5,2)) AS wind_speed_kmh,
            CAST(k AS SMALLINT) AS weather_code_wmo,
            CAST(k AS DECIMAL(5,2)) AS relative_humidity_pct,
            CASE WHEN k = 0 THEN 'Clear' WHEN k BETWEEN 1 AND 3 THEN 'Cloudy'
                 WHEN k BETWEEN 45 AND 48 THEN 'Fog' WHEN k BETWEEN 51 AND 67 THEN 'Rain'
                 WHEN k BETWEEN 71 AND 77 THEN 'Snow' WHEN k BETWEEN 80 AND 82 THEN 'Rain'
                 WHEN k BETWEEN 85 AND 86 THEN 'Snow' WHEN k BETWEEN 95 AND 99
                 THEN 'Storm' ELSE 'Other' END AS weather_category,
            CASE WHEN temperature_celsius < 0 THEN 'Freezing'
                 WHEN temperature_celsius < 10 THEN 'Cold'
                 WHEN temperature_celsius < 20 THEN 'Mild'
                 WHEN temperature_celsius < 30 THEN 'Warm' ELSE 'Hot' END AS temp_band,
            CASE WHEN precipitation_mm IS NULL OR precipitation_mm = 0 THEN 'None'
                 WHEN precipitation_mm < 1 THEN 'Light'
                 WHEN precipitation_mm < 5 THEN 'Moderate' ELSE 'Heavy' END AS precip_band,
            CAST(year(ts) AS SMALLINT) AS _ingest_year
        FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k
              FROM events WHERE event_type <> 'signup') AS e)"""
