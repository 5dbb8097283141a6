"""The whole warehouse, built from the sample tables written as raw feeds."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.functions.keys import flag_measure
from starkeep.operators import quality
from starkeep.operators.asof import active_on
from starkeep.plans import cleaning, reports, schemas, warehouse
from starkeep.plans.refresh import refresh
from starkeep.queries import feeds
from starkeep.queries.registry import Tables, query
from starkeep.sources.files import materialize, scratch_path
from starkeep.sources.landing import land
from starkeep.sources.store import TableStore
from starkeep.sources.tables import typed_nulls, without_triage
from starkeep.sources.windows import DayRange

FIRST_RUN, SECOND_RUN = date(2024, 1, 10), date(2024, 1, 20)


def land_feeds(spark, folder):
    """All four feeds as landed files."""
    root = scratch_path(spark, "landing")
    land(feeds.incident_feed(spark, folder), root, "incidents", FIRST_RUN)
    land(feeds.code_feed(spark, folder), root, "codes", FIRST_RUN)
    land(feeds.area_feed(spark, folder), root, "areas", FIRST_RUN)
    weather = feeds.weather_feed(spark, folder)
    land(weather, root, "weather", FIRST_RUN, "json", maxRecordsPerFile=1)
    return root


def build(spark, folder):
    """Two runs from raw files to facts.

    Between them new area indicators land, so every place gets a second version.
    """
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    root = land_feeds(spark, folder)
    warehouse.build_warehouse(store, warehouse.clean_feeds(store, root, FIRST_RUN), FIRST_RUN)
    land(feeds.area_feed(spark, folder, 1), root, "areas", SECOND_RUN)
    again = warehouse.clean_feeds(store, root, SECOND_RUN)
    warehouse.build_warehouse(store, again, SECOND_RUN)
    return store


THIRD_RUN = date(2024, 1, 25)
RUNS = (FIRST_RUN, SECOND_RUN, THIRD_RUN)


def land_increment(spark, folder, root, step):
    """What lands before each of three runs.

    First reports come in the first two, corrections in the last two, observations in the first and the last;
    area indicators are delivered again with the second and codes with the third.
    """
    event = F.substring("Case Number", 2, 18).cast("long")
    first = F.col("Description") == "version 1"
    wanted = {
        0: first & (event % 3 != 0),
        1: (first & (event % 3 == 0)) | (~first & (event % 2 == 0)),
        2: ~first & (event % 2 == 1),
    }
    land(feeds.incident_feed(spark, folder).filter(wanted[step]), root, "incidents", RUNS[step])
    if step < 2:
        land(feeds.area_feed(spark, folder, step), root, "areas", RUNS[step])
    if step != 1:
        codes = feeds.code_feed(spark, folder)
        if step == 2:
            turned = F.when(F.col("Index Code") == "i", "N").otherwise("I")
            codes = codes.withColumn("Index Code", turned)
        land(codes, root, "codes", RUNS[step])
        hundred = F.floor(F.col("event_id") / 100)
        weather = feeds.weather_feed(spark, folder, chosen=hundred % 2 == step // 2)
        land(weather, root, "weather", RUNS[step], "json", maxRecordsPerFile=1)


def build_by_increments(spark, folder):
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    root = scratch_path(spark, "landing")
    for step, run_date in enumerate(RUNS):
        land_increment(spark, folder, root, step)
        refresh(store, root, run_date)
    return store


def clean_incidents(spark, folder):
    clean = cleaning.clean_incidents(feeds.incident_feed(spark, folder))
    return materialize(without_triage(clean), "incidents")


# Places of the second run get their versions from SECOND_RUN on; first-run keys are
# numbered before second-run keys.
STAR_SQL = f"""
    {feeds.INCIDENTS_SQL}, {feeds.CODES_SQL}, {feeds.areas_sql()},
    {feeds.areas_sql("areas_later", 1)}, {feeds.WEATHER_SQL},
    loaded AS (SELECT * FROM incidents WHERE _ingest_year <> 9999),
    places AS (SELECT DISTINCT community_area, district, ward, beat FROM loaded),
    numbered AS (
        SELECT *, row_number() OVER (ORDER BY community_area NULLS FIRST,
            district NULLS FIRST, ward NULLS FIRST, beat NULLS FIRST) AS n FROM places),
    locations AS (
        SELECT n AS location_key, numbered.*, areas.* EXCLUDE (community_area),
            DATE '0001-01-01' AS scd_start_date, DATE '2024-01-20' AS scd_end_date,
            FALSE AS is_current, 1 AS scd_version
        FROM numbered LEFT JOIN areas USING (community_area)
        UNION ALL
        SELECT n + (SELECT count(*) FROM numbered), numbered.*,
            a.* EXCLUDE (community_area), DATE '2024-01-20', DATE '9999-12-31', TRUE, 2
        FROM numbered LEFT JOIN areas_later AS a USING (community_area)),
    types AS (
        SELECT row_number() OVER (ORDER BY iucr) AS crime_type_key, * FROM (
            SELECT iucr, primary_type, description, fbi_code FROM loaded
            QUALIFY row_number() OVER (
                PARTITION BY iucr ORDER BY updated_on DESC, date DESC, id DESC) = 1) AS t),
    hours AS (
        SELECT row_number() OVER (ORDER BY obs_date_key, obs_hour) AS weather_key, *
        FROM (
            SELECT CAST(strftime(obs_time, '%Y%m%d') AS INTEGER) AS obs_date_key,
                CAST(hour(obs_time) AS SMALLINT) AS obs_hour, weather.*
            FROM weather
            QUALIFY row_number() OVER (
                PARTITION BY obs_date_key, obs_hour ORDER BY obs_time DESC,
                temperature_celsius DESC NULLS LAST, precipitation_mm DESC NULLS LAST,
                wind_speed_kmh DESC NULLS LAST, weather_code_wmo DESC NULLS LAST) = 1
        ) AS h),
    facts AS (
        SELECT row_number() OVER (ORDER BY id) AS crime_pk, id AS crime_id, case_number,
            CAST(strftime(date, '%Y%m%d') AS INTEGER) AS occurrence_date_key,
            CAST(hour(date) AS SMALLINT) AS occurrence_time_key,
            CAST(strftime(updated_on, '%Y%m%d') AS INTEGER) AS report_date_key,
            l.location_key, t.crime_type_key, coalesce(w.weather_key, -1) AS weather_key,
            CAST(CASE WHEN arrest IS NULL OR domestic IS NULL THEN 0
                ELSE 1 + arrest::INT + 2 * domestic::INT END AS SMALLINT) AS flags_key,
            CAST(1 AS SMALLINT) AS incident_count,
            CAST(coalesce(arrest, FALSE) AS SMALLINT) AS is_arrest,
            CAST(coalesce(domestic, FALSE) AS SMALLINT) AS is_domestic,
            CAST(trunc(date_diff('second', date, updated_on) / 3600) AS INTEGER)
                AS hours_to_update,
            latitude, longitude, w.temperature_celsius, w.precipitation_mm
        FROM loaded AS f
        JOIN locations AS l ON l.community_area IS NOT DISTINCT FROM f.community_area
            AND l.district IS NOT DISTINCT FROM f.district
            AND l.ward IS NOT DISTINCT FROM f.ward AND l.beat IS NOT DISTINCT FROM f.beat
            AND CAST(date AS DATE) >= l.scd_start_date
            AND CAST(date AS DATE) < l.scd_end_date
        JOIN types AS t ON t.iucr = f.iucr
        LEFT JOIN hours AS w
            ON w.obs_date_key = CAST(strftime(date, '%Y%m%d') AS INTEGER)
            AND w.obs_hour = hour(date))"""


@query(f"WITH {STAR_SQL} SELECT * FROM facts")
def warehouse_facts(spark, folder):
    """Facts after two runs: keys as of the event, every incident once."""
    columns = schemas.CONTRACTS["fact_crime"].schema.names
    return build(spark, folder).read("fact_crime").select(*columns)


@query(f"""
WITH {STAR_SQL}
SELECT CAST(crime_id AS VARCHAR) AS crime_id, 1 AS incident_count,
    CAST(is_arrest AS INTEGER) AS is_arrest, CAST(is_domestic AS INTEGER) AS is_domestic,
    coalesce(hours_to_update, 0) AS hours_to_update, latitude, longitude,
    f.temperature_celsius, f.precipitation_mm,
    date_trunc('day', strptime(CAST(occurrence_date_key AS VARCHAR), '%Y%m%d'))
        AS occurrence_date,
    2024 AS occurrence_year, 1 AS occurrence_quarter, 1 AS occurrence_month,
    'January' AS occurrence_month_name,
    CAST(dayofweek(occurrence_date) AS INTEGER) AS occurrence_day_of_week,
    dayname(occurrence_date) AS occurrence_day_name,
    CAST(occurrence_time_key AS INTEGER) AS occurrence_hour,
    CASE WHEN occurrence_time_key <= 4 THEN 'Late Night'
        WHEN occurrence_time_key <= 8 THEN 'Early Morning'
        WHEN occurrence_time_key <= 11 THEN 'Morning'
        WHEN occurrence_time_key <= 16 THEN 'Afternoon'
        WHEN occurrence_time_key <= 20 THEN 'Evening' ELSE 'Night' END AS period_of_day,
    CAST(coalesce(community_area, 0) AS INTEGER) AS community_area,
    coalesce(community_area_name, 'Unknown') AS community_area_name,
    coalesce(district, 'Unknown') AS district,
    CAST(coalesce(ward, 0) AS INTEGER) AS ward, pct_below_poverty, pct_unemployed_16plus,
    pct_no_hs_25plus, per_capita_income_usd,
    CAST(hardship_index AS INTEGER) AS hardship_index,
    CAST(greatest(scd_start_date, DATE '1900-01-01') AS TIMESTAMP) AS location_scd_start,
    CAST(least(scd_end_date, DATE '2099-12-31') AS TIMESTAMP) AS location_scd_end,
    CAST(is_current AS INTEGER) AS location_is_current,
    CAST(scd_version AS INTEGER) AS location_scd_version,
    primary_type, description AS crime_description, fbi_code,
    coalesce(index_code, 'U') AS index_code,
    TIMESTAMP '1900-01-01 00:00:00' AS crime_type_scd_start,
    TIMESTAMP '2099-12-31 00:00:00' AS crime_type_scd_end, 1 AS crime_type_is_current,
    coalesce(weather_category, 'Unavailable') AS weather_category,
    coalesce(temp_band, 'Unavailable') AS temp_band,
    coalesce(precip_band, 'Unavailable') AS precip_band
FROM facts AS f JOIN locations AS l ON l.location_key = f.location_key
JOIN types AS t ON t.crime_type_key = f.crime_type_key
LEFT JOIN codes AS c ON c.iucr = t.iucr
LEFT JOIN hours AS w ON w.weather_key = f.weather_key
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
""")
def warehouse_extract(spark, folder):
    """The reporting columns of every incident with a map point."""
    extract = warehouse.refresh_extract(build(spark, folder))
    return extract.drop(warehouse.FACT_PARTITION)


@query(f"""
WITH {STAR_SQL}
SELECT CAST(community_area AS SMALLINT) AS community_area, primary_type,
    count(*) AS n_incidents
FROM facts JOIN locations USING (location_key) JOIN types USING (crime_type_key)
WHERE occurrence_date_key BETWEEN 20240103 AND 20241231
GROUP BY 1, 2 ORDER BY n_incidents DESC, community_area, primary_type LIMIT 10
""")
def warehouse_top(spark, folder):
    """Largest groups of a range of days over the published star."""
    store = build(spark, folder)
    days = DayRange(date(2024, 1, 3), date(2024, 12, 31))
    facts = warehouse.facts_in(store, "fact_crime", "occurrence_date_key", days)
    star = reports.join_star(
        facts.select("location_key", "crime_type_key"),
        [
            (store.read("dim_location"), "location_key", "location_key"),
            (store.read("dim_crime_type"), "crime_type_key", "crime_type_key"),
        ],
    )
    groups = ["community_area", "primary_type"]
    return reports.top(reports.summarise(star, groups, count="n_incidents"),
                       "n_incidents", groups)


@query(f"""
WITH {STAR_SQL}
SELECT hardship_index, pct_below_poverty, count(*) AS n_incidents,
    count(CASE WHEN index_code = 'I' THEN 1 END) AS n_index,
    CAST(count(CASE WHEN index_code = 'I' THEN 1 END) AS DOUBLE) * 100
        / CAST(count(*) AS DOUBLE) AS index_rate
FROM facts JOIN locations USING (location_key) JOIN types USING (crime_type_key)
LEFT JOIN codes USING (iucr)
GROUP BY 1, 2
""")
def warehouse_index_rate(spark, folder):
    """Rate by indicators as they were on the day of the event."""
    store = build(spark, folder)
    star = reports.join_star(
        store.read("fact_crime").select("location_key", "crime_type_key"),
        [
            (store.read("dim_location"), "location_key", "location_key"),
            (store.read("dim_crime_type"), "crime_type_key", "crime_type_key"),
        ],
    )
    star = star.withColumn("is_index", flag_measure(F.col("index_code") == "I"))
    by = ["hardship_index", "pct_below_poverty"]
    sums = reports.summarise(star, by, {"n_index": "is_index"}, count="n_incidents")
    return reports.with_ratio(sums, "index_rate", "n_index", "n_incidents")


@query(f"""
WITH {STAR_SQL}
SELECT CAST(coalesce(community_area, 0) AS INTEGER) AS community_area,
    count(*) AS n_incidents
FROM facts JOIN locations USING (location_key)
WHERE latitude IS NOT NULL AND scd_start_date <= DATE '2024-01-20'
    AND scd_end_date > DATE '2024-01-20'
GROUP BY 1
""")
def warehouse_active(spark, folder):
    """Incidents whose place and type versions were both valid on a day."""
    extract = warehouse.refresh_extract(build(spark, folder))
    ranges = [(f"{p}_scd_start", f"{p}_scd_end") for p in ("location", "crime_type")]
    active = active_on(extract, F.lit(date(2024, 1, 20)), ranges)
    return reports.summarise(active, ["community_area"], count="n_incidents")


@query(f"""
WITH {STAR_SQL}
SELECT 'fact_crime' AS table_name, count(*) AS n_rows, count(*) - count(DISTINCT crime_id)
    + count(CASE WHEN location_key IS NULL OR crime_type_key IS NULL THEN 1 END)
    AS n_violations FROM facts
UNION ALL
SELECT 'dim_location', count(*) + 1, count(*) - count(DISTINCT location_key) FROM locations
UNION ALL
SELECT 'dim_crime_type', count(*) + 1, count(*) - count(DISTINCT crime_type_key) FROM types
""")
def warehouse_gates(spark, folder):
    """Rows and violations of contracts, foreign keys and version chains after a build."""
    store = build(spark, folder)
    tables = {n: store.read(n) for n in ("fact_crime", "dim_location", "dim_crime_type")}
    more = {
        "fact_crime": quality.orphan_violations(
            tables["fact_crime"],
            {
                "location_key": (tables["dim_location"], "location_key"),
                "crime_type_key": (tables["dim_crime_type"], "crime_type_key"),
            },
        ),
        "dim_location": quality.version_violations(tables["dim_location"], schemas.LOCATION),
        "dim_crime_type": quality.version_violations(
            tables["dim_crime_type"], schemas.INCIDENT_TYPE
        ),
    }
    parts = []
    for name, df in tables.items():
        found = quality.contract_violations(df, schemas.CONTRACTS[name]).unionByName(more[name])
        sums = found.agg(F.sum("n_violations").alias("n_violations"))
        parts.append(sums.select(F.lit(name).alias("table_name"), "n_violations"))
    violations = reduce(DataFrame.unionByName, parts)
    return quality.row_counts(tables).join(violations, "table_name")


@query(f"""
WITH {STAR_SQL}
SELECT location_key, community_area, district, ward, beat,
    CAST(NULL AS VARCHAR) AS block, community_area_name, pct_housing_crowded,
    pct_below_poverty, pct_unemployed_16plus, pct_no_hs_25plus, pct_under18_or_over64,
    per_capita_income_usd, hardship_index, scd_start_date, scd_end_date, is_current,
    CAST(scd_version AS SMALLINT) AS scd_version
FROM locations
UNION ALL
SELECT 0, NULL, NULL, NULL, NULL, NULL, 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, DATE '0001-01-01', DATE '9999-12-31', TRUE, 1
""")
def warehouse_locations(spark, folder):
    """The versioned place dimension after two runs, with its unknown member."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    incidents = clean_incidents(spark, folder)
    for shift, run_date in ((0, FIRST_RUN), (1, SECOND_RUN)):
        areas = cleaning.clean_areas(feeds.area_feed(spark, folder, shift), FIRST_RUN)
        warehouse.load_versioned(
            store,
            "dim_location",
            schemas.LOCATION,
            schemas.UNKNOWN_LOCATION,
            warehouse.incoming_locations(incidents, areas),
            run_date,
            spread=("community_area", "community_area_name"),
        )
    return store.read("dim_location").drop("scd_hash")


@query(f"""
WITH {feeds.INCIDENTS_SQL}, {feeds.CODES_SQL}
SELECT i.iucr, i.primary_type, i.description, i.fbi_code, index_code,
    coalesce(active, TRUE) AS active
FROM (SELECT iucr, primary_type, description, fbi_code FROM incidents
      WHERE _ingest_year <> 9999
      QUALIFY row_number() OVER (
          PARTITION BY iucr ORDER BY updated_on DESC, date DESC, id DESC) = 1) AS i
LEFT JOIN codes USING (iucr)
""")
def warehouse_types(spark, folder):
    """The code dimension's incoming rows."""
    codes = cleaning.clean_codes(feeds.code_feed(spark, folder), FIRST_RUN)
    incidents = clean_incidents(spark, folder)
    return warehouse.incoming_types(incidents, materialize(codes, "codes"))


@query(f"""
WITH {feeds.WEATHER_SQL}
SELECT CAST(strftime(obs_time, '%Y%m%d') AS INTEGER) AS obs_date_key,
    CAST(hour(obs_time) AS SMALLINT) AS obs_hour, weather_code_wmo, weather_category,
    temp_band, precip_band
FROM weather
QUALIFY row_number() OVER (
    PARTITION BY obs_date_key, obs_hour ORDER BY obs_time DESC,
    temperature_celsius DESC NULLS LAST, precipitation_mm DESC NULLS LAST,
    wind_speed_kmh DESC NULLS LAST, weather_code_wmo DESC NULLS LAST) = 1
""")
def warehouse_hours(spark, folder):
    """The hourly dimension's incoming rows."""
    weather = cleaning.clean_weather(feeds.weather_feed(spark, folder))
    return warehouse.incoming_weather(weather)


@query("""
SELECT row_number() OVER (ORDER BY race) AS arrestee_key, race,
    CAST(NULL AS VARCHAR) AS age_band, CAST(NULL AS VARCHAR) AS sex
FROM (SELECT DISTINCT c_mktsegment AS race FROM customer) AS people
""")
def warehouse_people(spark, folder):
    """Distinct demographics of a feed that has one of the three attributes."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    people = Tables(spark, folder).customer.select(F.col("c_mktsegment").alias("race"))
    for _ in range(2):  # the second load changes nothing
        warehouse.load_arrestees(store, people)
    return store.read("dim_arrestee")


def arrest_feed(spark, folder):
    """Every order as an arrest, its lines as charges.

    Even orders list them in delimited fields, odd ones in repeated columns, as many as the
    longest order has lines.
    """
    t = Tables(spark, folder)
    code = F.lpad((F.col("l_partkey") % 120).cast("string"), 4, "0")
    line = F.struct("l_linenumber", code.alias("type"), "l_returnflag", "l_linestatus")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    most = lines.agg(F.max(F.size("lines"))).first()[0] or 1
    even, columns = F.col("l_orderkey") % 2 == 0, []
    fields = {"type": "type", "class": "l_returnflag", "statute": "l_linestatus"}
    for name, field in fields.items():
        entries = F.col(f"lines.{field}")
        columns.append(F.when(even, F.concat_ws("|", entries)).alias(f"charges_{name}"))
        for i in range(most):
            entry = F.when(~even, F.get(entries, F.lit(i)))
            columns.append(entry.alias(f"charge_{i + 1}_{name}"))
    charges = lines.select("l_orderkey", *columns)
    orders = t.orders.select(
        F.col("o_orderkey").alias("cb_no"),
        F.concat(F.lit("C"), "o_orderkey").alias("case_number"),
        (F.col("o_orderdate") + F.expr("INTERVAL '9000' DAY")).alias("arrest_date"),
        F.col("o_orderpriority").alias("race"),
    )
    return orders.join(charges, F.col("cb_no") == F.col("l_orderkey"), "left")


ARRESTS_SQL = """
    people AS (
        SELECT row_number() OVER (ORDER BY race) AS arrestee_key, race
        FROM (SELECT DISTINCT o_orderpriority AS race FROM orders) AS p),
    codes AS (
        SELECT row_number() OVER (ORDER BY iucr) AS crime_type_key, iucr FROM (
            SELECT DISTINCT lpad(CAST(p_partkey % 100 AS VARCHAR), 4, '0') AS iucr
            FROM part) AS c),
    charges AS (
        SELECT l_orderkey AS cb_no, CAST(row_number() OVER (PARTITION BY l_orderkey
                ORDER BY l_linenumber, iucr, charge_class, charge_statute) AS INTEGER)
                AS charge_position, iucr, charge_class, charge_statute
        FROM (SELECT *, lpad(CAST(l_partkey % 120 AS VARCHAR), 4, '0') AS iucr,
                  l_returnflag AS charge_class, l_linestatus AS charge_statute
              FROM lineitem) AS l),
    arrests AS (
        SELECT row_number() OVER (ORDER BY o_orderkey) AS arrest_pk,
            o_orderkey AS cb_no, 'C' || o_orderkey AS case_number,
            CAST(CASE WHEN year(d) BETWEEN 2018 AND 2030 THEN strftime(d, '%Y%m%d')
                ELSE '0' END AS INTEGER) AS arrest_date_key,
            CAST(hour(d) AS SMALLINT) AS arrest_time_key, arrestee_key,
            CAST(1 AS SMALLINT) AS arrest_count,
            CAST((SELECT count(*) FROM charges WHERE charges.cb_no = o_orderkey)
                AS INTEGER) AS charge_count
        FROM (SELECT *, o_orderdate + INTERVAL 9000 DAY AS d FROM orders) AS o
        JOIN people ON race = o_orderpriority)"""


def build_arrests(spark, folder):
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    warehouse.seed(store)
    part = F.lpad((F.col("p_partkey") % 100).cast("string"), 4, "0")
    codes = Tables(spark, folder).part.select(part.alias("iucr")).distinct()
    spec = schemas.INCIDENT_TYPE
    types = {n: "string" for n in spec.tracked[:-1]}
    codes = typed_nulls(codes, types).withColumn("active", F.lit(True))
    warehouse.load_versioned(
        store, "dim_crime_type", spec, schemas.UNKNOWN_TYPE, codes, FIRST_RUN
    )
    arrests = materialize(arrest_feed(spark, folder), "arrests")
    warehouse.load_arrestees(store, arrests)
    dims = {n: store.read(n) for n in ("dim_crime_type", "dim_arrestee", "dim_date")}
    for _ in range(2):  # the second load changes nothing
        warehouse.load_arrests(store, arrests, dims)
    return store


@query(f"WITH {ARRESTS_SQL} SELECT * FROM arrests")
def warehouse_arrests(spark, folder):
    """The second fact: people, days outside the calendar, number of charges."""
    columns = schemas.CONTRACTS["fact_arrest"].schema.names
    return build_arrests(spark, folder).read("fact_arrest").select(*columns)


@query(f"""
WITH {ARRESTS_SQL}
SELECT arrest_pk, coalesce(crime_type_key, 0) AS crime_type_key, charge_position,
    charge_class, charge_statute
FROM charges JOIN arrests USING (cb_no) LEFT JOIN codes ON codes.iucr = charges.iucr
""")
def warehouse_charges(spark, folder):
    """The bridge from arrests to codes."""
    columns = schemas.CONTRACTS["bridge_arrest_charge"].schema.names
    return build_arrests(spark, folder).read("bridge_arrest_charge").select(*columns)


# Three increments. ``b`` is the run a report lands for, ``k`` a run; a dimension's versions are the changes
# between what the runs see.
INCREMENTS_SQL = f"""
    {feeds.INCIDENTS_SQL.replace("incidents AS", "reports AS", 1).replace("WHERE version = 2 OR keyless", "")},
    {feeds.CODES_SQL}, {feeds.areas_sql()}, {feeds.areas_sql("areas_later", 1)},
    {feeds.WEATHER_SQL.replace("SELECT CAST", "SELECT event_id, CAST", 1)},
    runs(k, day) AS (
        VALUES (1, DATE '2024-01-10'), (2, DATE '2024-01-20'), (3, DATE '2024-01-25')),
    delivered AS (
        SELECT *, CASE WHEN description = 'version 1' THEN CASE WHEN event % 3 <> 0 THEN 1 ELSE 2 END
            WHEN event % 2 = 0 THEN 2 ELSE 3 END AS b
        FROM (SELECT *, CAST(substr(case_number, 2) AS BIGINT) AS event FROM reports) AS r
        WHERE id IS NOT NULL AND _ingest_year <> 9999),
    loaded AS (
        SELECT k, day, delivered.* FROM runs JOIN delivered ON b <= k
        QUALIFY row_number() OVER (PARTITION BY k, id ORDER BY updated_on DESC) = 1),
    area_runs AS (
        SELECT 1 AS k, * FROM areas UNION ALL SELECT k, areas_later.* FROM areas_later, runs WHERE k > 1),
    place_runs AS (
        SELECT p.*, a.* EXCLUDE (k, community_area, _ingest_year)
        FROM (SELECT DISTINCT k, day, community_area, district, ward, beat FROM loaded) AS p
        LEFT JOIN area_runs AS a ON a.k = p.k AND a.community_area = p.community_area),
    places AS (
        SELECT *, CASE WHEN scd_version = 1 THEN DATE '0001-01-01' ELSE day END AS scd_start_date,
            coalesce(lead(day) OVER place, DATE '9999-12-31') AS scd_end_date
        FROM (
            SELECT *, row_number() OVER place AS scd_version
            FROM (SELECT * FROM place_runs
                  WINDOW place AS (PARTITION BY community_area, district, ward, beat ORDER BY k)
                  QUALIFY lag(pct_below_poverty) OVER place IS DISTINCT FROM pct_below_poverty
                    OR row_number() OVER place = 1) AS c
            WINDOW place AS (PARTITION BY community_area, district, ward, beat ORDER BY k)) AS n
        WINDOW place AS (PARTITION BY community_area, district, ward, beat ORDER BY k)),
    code_runs AS (
        SELECT k, iucr, active,
            CASE WHEN k < 3 THEN index_code WHEN index_code = 'I' THEN 'N' ELSE 'I' END AS index_code
        FROM codes, runs),
    type_runs AS (
        SELECT t.*, c.index_code, coalesce(c.active, TRUE) AS active,
            row(primary_type, description, fbi_code, c.index_code, coalesce(c.active, TRUE)) AS tracked
        FROM (SELECT k, day, iucr, primary_type, description, fbi_code FROM loaded
              QUALIFY row_number() OVER (PARTITION BY k, iucr
                  ORDER BY updated_on DESC, date DESC, id DESC) = 1) AS t
        LEFT JOIN code_runs AS c ON c.k = t.k AND c.iucr = t.iucr),
    types AS (
        SELECT *, CASE WHEN scd_version = 1 THEN DATE '0001-01-01' ELSE day END AS scd_start_date,
            coalesce(lead(day) OVER code, DATE '9999-12-31') AS scd_end_date
        FROM (
            SELECT *, row_number() OVER code AS scd_version
            FROM (SELECT * FROM type_runs WINDOW code AS (PARTITION BY iucr ORDER BY k)
                  QUALIFY row_number() OVER code = 1
                    OR lag(tracked) OVER code IS DISTINCT FROM tracked) AS c
            WINDOW code AS (PARTITION BY iucr ORDER BY k)) AS n
        WINDOW code AS (PARTITION BY iucr ORDER BY k)),
    observed AS (
        SELECT CAST(strftime(obs_time, '%Y%m%d') AS INTEGER) AS obs_date_key,
            CAST(hour(obs_time) AS SMALLINT) AS obs_hour, event_id // 100 % 2 AS late, weather.*
        FROM weather),
    latest_hours AS (
        SELECT * FROM observed
        QUALIFY row_number() OVER (
            PARTITION BY obs_date_key, obs_hour ORDER BY obs_time DESC,
            temperature_celsius DESC NULLS LAST, precipitation_mm DESC NULLS LAST,
            wind_speed_kmh DESC NULLS LAST, weather_code_wmo DESC NULLS LAST) = 1),
    first_hours AS (
        SELECT * FROM observed
        QUALIFY row_number() OVER (
            PARTITION BY obs_date_key, obs_hour ORDER BY late, obs_time DESC,
            temperature_celsius DESC NULLS LAST, precipitation_mm DESC NULLS LAST,
            wind_speed_kmh DESC NULLS LAST, weather_code_wmo DESC NULLS LAST) = 1),
    facts AS (
        SELECT f.* EXCLUDE (description, primary_type, fbi_code, k, day), p.* EXCLUDE (k, day, community_area,
                district, ward, beat, scd_version, scd_start_date, scd_end_date),
            p.scd_version AS place_version, p.scd_start_date AS place_start, p.scd_end_date AS place_end,
            t.primary_type, t.description, t.fbi_code, t.index_code, t.scd_version AS type_version,
            t.scd_start_date AS type_start, t.scd_end_date AS type_end,
            w.temperature_celsius, w.precipitation_mm, h.weather_category, h.temp_band, h.precip_band
        FROM loaded AS f
        JOIN places AS p ON p.community_area IS NOT DISTINCT FROM f.community_area
            AND p.district IS NOT DISTINCT FROM f.district
            AND p.ward IS NOT DISTINCT FROM f.ward AND p.beat IS NOT DISTINCT FROM f.beat
            AND CAST(date AS DATE) >= p.scd_start_date AND CAST(date AS DATE) < p.scd_end_date
        JOIN types AS t ON t.iucr = f.iucr
            AND CAST(date AS DATE) >= t.scd_start_date AND CAST(date AS DATE) < t.scd_end_date
        LEFT JOIN latest_hours AS w ON w.obs_date_key = CAST(strftime(date, '%Y%m%d') AS INTEGER)
            AND w.obs_hour = hour(date)
        LEFT JOIN first_hours AS h ON h.obs_date_key = w.obs_date_key AND h.obs_hour = w.obs_hour
        WHERE f.k = 3)"""


@query(f"""
WITH {INCREMENTS_SQL}
SELECT id AS crime_id, case_number, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS occurrence_date_key,
    CAST(hour(date) AS SMALLINT) AS occurrence_time_key,
    CAST(strftime(updated_on, '%Y%m%d') AS INTEGER) AS report_date_key, community_area, district, ward, beat,
    CAST(place_version AS SMALLINT) AS place_version, pct_below_poverty, iucr,
    CAST(type_version AS SMALLINT) AS type_version, description, index_code, temp_band,
    CAST(CASE WHEN arrest IS NULL OR domestic IS NULL THEN 0
        ELSE 1 + arrest::INT + 2 * domestic::INT END AS SMALLINT) AS flags_key,
    CAST(coalesce(arrest, FALSE) AS SMALLINT) AS is_arrest,
    CAST(coalesce(domestic, FALSE) AS SMALLINT) AS is_domestic,
    CAST(trunc(date_diff('second', date, updated_on) / 3600) AS INTEGER) AS hours_to_update,
    latitude, longitude, temperature_celsius, precipitation_mm
FROM facts
""")
def warehouse_increments(spark, folder):
    """Facts after three refreshes, with the members they point to instead of surrogates."""
    store = build_by_increments(spark, folder)
    places = store.read("dim_location").withColumnRenamed("scd_version", "place_version")
    types = store.read("dim_crime_type").withColumnRenamed("scd_version", "type_version")
    star = reports.join_star(
        store.read("fact_crime"),
        [
            (places.select("location_key", *schemas.LOCATION.keys, "place_version", "pct_below_poverty"),
             "location_key", "location_key"),
            (types.select("crime_type_key", "iucr", "type_version", "description", "index_code"),
             "crime_type_key", "crime_type_key"),
            (store.read("dim_weather").select(
                "weather_key", F.when(F.col("weather_key") > 0, F.col("temp_band")).alias("temp_band")),
             "weather_key", "weather_key"),
        ],
    )
    keys = ("crime_pk", "location_key", "crime_type_key", "weather_key", "incident_count", "fact_year")
    return star.drop(*keys)


@query(f"""
WITH {INCREMENTS_SQL}
SELECT CAST(id AS VARCHAR) AS crime_id, 1 AS incident_count,
    CAST(coalesce(arrest, FALSE) AS INTEGER) AS is_arrest,
    CAST(coalesce(domestic, FALSE) AS INTEGER) AS is_domestic,
    coalesce(CAST(trunc(date_diff('second', date, updated_on) / 3600) AS INTEGER), 0) AS hours_to_update,
    latitude, longitude, temperature_celsius, precipitation_mm,
    CAST(date_trunc('day', date) AS TIMESTAMP) AS occurrence_date,
    CAST(year(date) AS INTEGER) AS occurrence_year, CAST(quarter(date) AS INTEGER) AS occurrence_quarter,
    CAST(month(date) AS INTEGER) AS occurrence_month, monthname(date) AS occurrence_month_name,
    CAST(dayofweek(date) AS INTEGER) AS occurrence_day_of_week, dayname(date) AS occurrence_day_name,
    CAST(hour(date) AS INTEGER) AS occurrence_hour,
    CASE WHEN hour(date) <= 4 THEN 'Late Night' WHEN hour(date) <= 8 THEN 'Early Morning'
        WHEN hour(date) <= 11 THEN 'Morning' WHEN hour(date) <= 16 THEN 'Afternoon'
        WHEN hour(date) <= 20 THEN 'Evening' ELSE 'Night' END AS period_of_day,
    CAST(coalesce(community_area, 0) AS INTEGER) AS community_area,
    coalesce(community_area_name, 'Unknown') AS community_area_name, coalesce(district, 'Unknown') AS district,
    CAST(coalesce(ward, 0) AS INTEGER) AS ward, pct_below_poverty, pct_unemployed_16plus,
    pct_no_hs_25plus, per_capita_income_usd, CAST(hardship_index AS INTEGER) AS hardship_index,
    CAST(greatest(place_start, DATE '1900-01-01') AS TIMESTAMP) AS location_scd_start,
    CAST(least(place_end, DATE '2099-12-31') AS TIMESTAMP) AS location_scd_end,
    CAST(place_end = DATE '9999-12-31' AS INTEGER) AS location_is_current,
    CAST(place_version AS INTEGER) AS location_scd_version,
    primary_type, description AS crime_description, fbi_code, coalesce(index_code, 'U') AS index_code,
    CAST(greatest(type_start, DATE '1900-01-01') AS TIMESTAMP) AS crime_type_scd_start,
    CAST(least(type_end, DATE '2099-12-31') AS TIMESTAMP) AS crime_type_scd_end,
    CAST(type_end = DATE '9999-12-31' AS INTEGER) AS crime_type_is_current,
    coalesce(weather_category, 'Unavailable') AS weather_category,
    coalesce(temp_band, 'Unavailable') AS temp_band, coalesce(precip_band, 'Unavailable') AS precip_band
FROM facts WHERE latitude IS NOT NULL AND longitude IS NOT NULL
""")
def extract_increments(spark, folder):
    """The reporting columns after three refreshes, of which the last two write stale years only."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    root = scratch_path(spark, "landing")
    for step, run_date in enumerate(RUNS):
        land_increment(spark, folder, root, step)
        refresh(store, root, run_date)
        extract = warehouse.refresh_extract(store)
    return extract.drop(warehouse.FACT_PARTITION)
