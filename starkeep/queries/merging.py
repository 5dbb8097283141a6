"""Deduplication, versioning, upserts, surrogate keys and bridges."""

from datetime import date

from pyspark.sql import functions as F

from starkeep.functions.keys import date_key
from starkeep.operators import bridge as B
from starkeep.operators.asof import active_on
from starkeep.operators.dedup import latest_per_key
from starkeep.operators.late import add_sightings, scd2_splice, sightings
from starkeep.operators.scd import (
    VersionSpec,
    change_counts,
    scd0_insert,
    scd1_upsert,
    scd2_history,
    scd2_merge,
    spread_attribute,
)
from starkeep.operators.surrogate import assign_keys, fill_keys
from starkeep.plans.schemas import LIFE, table
from starkeep.queries.registry import Tables, query
from starkeep.sources.files import materialize


USERS = VersionSpec(surrogate="user_key", keys=("user_id",), tracked=("event_type",))
SECOND_HALF = date(2024, 1, 16)
FIRST_RUN, SECOND_RUN = date(2024, 1, 15), date(2024, 1, 30)

USERS_SCHEMA = table(user_key="long", user_id="long", event_type="string", **LIFE)


def last_per(events, *keys):
    newest = [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]
    return latest_per_key(events, list(keys), newest)


def user_days(events):
    """Each user's last event type per day."""
    dated = events.withColumn("day", F.to_date("ts"))
    dated = dated.select("user_id", "day", "event_type", "ts", "event_id")
    return last_per(dated, "user_id", "day").select("user_id", "day", "event_type")


def user_history(events):
    return scd2_history(user_days(events), USERS, "day")


def with_hex(df):
    return df.withColumn("scd_hash", F.lower(F.hex("scd_hash")))


def two_batches(events):
    """First batch merged into an empty table, and the second batch."""
    slim = events.select("user_id", "ts", "event_type", "event_id")
    early = F.col("ts") < F.lit(SECOND_HALF)
    first, second = last_per(slim.filter(early), "user_id"), last_per(
        slim.filter(~early), "user_id"
    )
    empty = events.sparkSession.createDataFrame([], USERS_SCHEMA)
    return scd2_merge(empty, first, USERS, FIRST_RUN), second


HISTORY_SQL = """
    days AS (
        SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events
        QUALIFY row_number() OVER (
            PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1),
    points AS (
        SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before
        FROM days QUALIFY before IS DISTINCT FROM event_type),
    history AS (
        SELECT user_id, event_type,
            CASE WHEN n = 1 THEN DATE '0001-01-01' ELSE day END AS scd_start_date,
            coalesce(following, DATE '9999-12-31') AS scd_end_date,
            following IS NULL AS is_current, CAST(n AS SMALLINT) AS scd_version,
            sha256(event_type) AS scd_hash
        FROM (SELECT *, row_number() OVER w AS n, lead(day) OVER w AS following
              FROM points WINDOW w AS (PARTITION BY user_id ORDER BY day)) AS numbered)"""

BATCHES_SQL = """
    first AS (
        SELECT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
        QUALIFY row_number() OVER (
            PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    second AS (
        SELECT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'
        QUALIFY row_number() OVER (
            PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    paired AS (
        SELECT coalesce(f.user_id, s.user_id) AS user_id, f.event_type AS old_type,
            s.event_type AS new_type
        FROM first AS f FULL JOIN second AS s ON f.user_id = s.user_id)"""


@query("""
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_user(spark, folder):
    events = Tables(spark, folder).events
    return last_per(events.select("user_id", "event_id", "ts", "event_type"), "user_id")


@query(f"WITH {HISTORY_SQL} SELECT * FROM history")
def version_history(spark, folder):
    """All versions of every user in one pass over the daily states."""
    return with_hex(user_history(Tables(spark, folder).events))


@query(f"WITH {HISTORY_SQL} SELECT * FROM history")
def late_snapshots(spark, folder):
    """The same versions from days that arrive out of order: every third first, then those before, then those after."""
    days = materialize(user_days(Tables(spark, folder).events), "days")
    state = spark.createDataFrame([], USERS_SCHEMA)
    seen = sightings(days.limit(0), USERS, "day")
    for part in (1, 0, 2):
        arrived = days.filter(F.datediff("day", F.lit("2000-01-01").cast("date")) % 3 == part)
        after = add_sightings(seen, arrived, USERS, "day")
        state = scd2_splice(state, seen, arrived, USERS, "day")
        state = fill_keys(state, "user_key", ["user_id", "scd_start_date"])
        seen = materialize(after, "sightings")
    return with_hex(state.drop("user_key"))


@query(f"""
WITH {BATCHES_SQL}, rows AS (
    SELECT user_id, old_type AS event_type, DATE '0001-01-01' AS scd_start_date,
        CASE WHEN new_type <> old_type THEN DATE '2024-01-30' ELSE DATE '9999-12-31' END
            AS scd_end_date,
        new_type IS NULL OR new_type = old_type AS is_current, 1 AS scd_version
    FROM paired WHERE old_type IS NOT NULL
    UNION ALL
    SELECT user_id, new_type,
        CASE WHEN old_type IS NULL THEN DATE '0001-01-01' ELSE DATE '2024-01-30' END,
        DATE '9999-12-31', TRUE, CASE WHEN old_type IS NULL THEN 1 ELSE 2 END
    FROM paired WHERE new_type IS NOT NULL AND new_type IS DISTINCT FROM old_type)
SELECT row_number() OVER (ORDER BY user_id, scd_start_date) AS user_key, user_id,
    event_type, scd_start_date, scd_end_date, is_current,
    CAST(scd_version AS SMALLINT) AS scd_version, sha256(event_type) AS scd_hash
FROM rows
""")
def version_merge(spark, folder):
    """Two merges in a row, then keys."""
    current, second = two_batches(Tables(spark, folder).events)
    state = scd2_merge(current, second, USERS, SECOND_RUN)
    return with_hex(fill_keys(state, "user_key", ["user_id", "scd_start_date"]))


@query(f"""
WITH {BATCHES_SQL}
SELECT CASE WHEN old_type IS NULL THEN 'new' WHEN old_type <> new_type THEN 'changed'
        ELSE 'unchanged' END AS change, count(*) AS n_rows
FROM paired WHERE new_type IS NOT NULL GROUP BY 1
""")
def version_changes(spark, folder):
    return change_counts(*two_batches(Tables(spark, folder).events), USERS)


@query(f"""
WITH {HISTORY_SQL}
SELECT history.*, c_mktsegment AS label
FROM history LEFT JOIN customer ON c_custkey = user_id AND c_mktsegment <> 'MACHINERY'
""")
def label_all_versions(spark, folder):
    """One attribute overwritten in every version of its member."""
    t = Tables(spark, folder)
    versions = with_hex(user_history(t.events))
    versions = versions.withColumn("label", F.lit(None).cast("string"))
    segment = F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("label")
    labels = t.customer.select(F.col("c_custkey").alias("user_id"), segment)
    return spread_attribute(versions, labels, "user_id", "label")


@query(f"""
WITH {HISTORY_SQL}
SELECT user_id, event_type, scd_version FROM history
WHERE scd_start_date <= DATE '2024-01-15' AND scd_end_date > DATE '2024-01-15'
""")
def versions_on_day(spark, folder):
    versions = user_history(Tables(spark, folder).events)
    day = F.lit(date(2024, 1, 15))
    active = active_on(versions, day, [("scd_start_date", "scd_end_date")])
    return active.select("user_id", "event_type", "scd_version")


def _base_and_incoming(spark, folder):
    """Known orders, and incoming ones: some known with a new priority, some new."""
    orders = Tables(spark, folder).orders
    base = orders.filter(F.col("o_orderstatus") != "P")
    incoming = orders.filter(F.col("o_orderstatus") != "F").withColumn(
        "o_orderpriority", F.concat("o_orderpriority", F.lit(" (new)"))
    )
    return base, incoming


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
         ELSE o_orderpriority || ' (new)' END AS o_orderpriority
FROM orders
""")
def overwrite_upsert(spark, folder):
    return scd1_upsert(*_base_and_incoming(spark, folder), ["o_orderkey"])


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    CASE WHEN o_orderstatus = 'P' THEN o_orderpriority || ' (new)'
         ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def insert_if_absent(spark, folder):
    return scd0_insert(*_base_and_incoming(spark, folder), ["o_orderkey"])


@query("""
SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS part_key, p_partkey, p_name
FROM part
""")
def surrogate_keys(spark, folder):
    parts = Tables(spark, folder).part.select("p_partkey", "p_name")
    return assign_keys(parts, "part_key", ["p_name", "p_partkey"])


# Bridges: an order with the brands of all its lines, in their order.


def order_brands(spark, folder):
    """The brands of an order's lines as an array; line numbers may repeat."""
    t = Tables(spark, folder)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    brands = t.part.select("p_partkey", "p_brand")
    joined = lines.join(brands, F.col("l_partkey") == F.col("p_partkey"))
    listed = F.array_sort(F.collect_list(F.struct("l_linenumber", "p_brand")))
    return joined.groupBy("l_orderkey").agg(listed.getField("p_brand").alias("brands"))


BRIDGE_SQL = """
    SELECT l_orderkey, p_brand AS brand, CAST(row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, p_brand) AS INTEGER) AS position
    FROM lineitem JOIN part ON p_partkey = l_partkey"""


@query(BRIDGE_SQL)
def bridge_rows(spark, folder):
    """From repeated columns, as many as the longest order has lines."""
    orders = materialize(order_brands(spark, folder), "order-brands")
    most = orders.agg(F.max(F.size("brands"))).first()[0] or 1
    columns = [F.get("brands", F.lit(i)).alias(f"brand_{i + 1}") for i in range(most)]
    groups = [{"brand": f"brand_{i + 1}"} for i in range(most)]
    wide = orders.select("l_orderkey", *columns)
    return B.bridge_from_columns(wide, "l_orderkey", groups, "brand")


@query(BRIDGE_SQL)
def bridge_from_text(spark, folder):
    """The same members from one delimited field."""
    brands = F.concat_ws("|", "brands").alias("brands")
    listed = order_brands(spark, folder).select("l_orderkey", brands)
    return B.bridge_from_list(listed, "l_orderkey", "brands", "brand")


@query(f"""
WITH bridge AS ({BRIDGE_SQL}), counts AS (
    SELECT l_orderkey, count(*) AS n FROM bridge GROUP BY 1)
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
    CAST(1 AS SMALLINT) AS order_count,
    CAST(coalesce(n, 0) AS INTEGER) AS member_count
FROM orders LEFT JOIN counts ON l_orderkey = o_orderkey
""")
def bridge_fact(spark, folder):
    """A fact with the constant 1 and the number of its members."""


    parents = Tables(spark, folder).orders.select(
        "o_orderkey",
        date_key(F.col("o_orderdate")).alias("order_date_key"),
        F.lit(1).cast("smallint").alias("order_count"),
    )
    bridge = bridge_rows(spark, folder).withColumnRenamed("l_orderkey", "o_orderkey")
    return B.count_members(parents, bridge, "o_orderkey", "member_count")


@query("""
WITH members AS (
    SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT a.p_brand AS member_a, b.p_brand AS member_b, count(*) AS n_parents
FROM members AS a JOIN members AS b
    ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
GROUP BY 1, 2
""")
def pair_counts(spark, folder):
    """Brands that occur in the same order."""
    t = Tables(spark, folder)
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    brands = t.part.select("p_partkey", "p_brand")
    joined = lines.join(brands, F.col("l_partkey") == F.col("p_partkey"))
    return B.pair_counts(joined, "l_orderkey", "p_brand")


@query("""
SELECT event_id, event_type, value FROM events
""")
def zip_explode(spark, folder):
    """Parallel arrays back to rows. Each array holds one block of consecutive ids."""
    events = Tables(spark, folder).events.select("event_id", "event_type", "value")
    block = F.floor(F.col("event_id") / 500).alias("block")
    item = F.struct("event_id", "event_type", "value")
    arrays = events.groupBy(block).agg(F.sort_array(F.collect_list(item)).alias("rows"))
    arrays = arrays.select(*[F.col(f"rows.{c}").alias(c) for c in events.columns])
    zipped = arrays.select(F.explode(F.arrays_zip(*events.columns)).alias("e"))
    return zipped.select("e.*")
