"""Raw feeds to typed tables. Bad values become NULL, bad rows are set aside; nothing
is refused."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkeep.functions.banding import (
    precipitation_band,
    temperature_band,
    weather_category,
)
from starkeep.functions.keys import TRIAGE_YEAR, partition_year
from starkeep.functions.naming import snake_columns
from starkeep.functions.parsing import parse_bool, parse_event_time, parse_iso_minutes
from starkeep.operators.dedup import latest_or_keyless, latest_per_key
from starkeep.operators.joins import sized
from starkeep.operators.shaping import conform, rename_present
from starkeep.plans import schemas
from starkeep.sources.files import materialize
from starkeep.sources.landing import empty, read_csv, read_json
from starkeep.sources.store import TableStore, in_values
from starkeep.sources.tables import YEAR_COLUMN


def clean_incidents(raw: DataFrame) -> DataFrame:
    """Typed incidents, the latest row per id.

    A row without a readable time or without an id is kept in the triage partition.
    """
    df = rename_present(snake_columns(raw), {"year": "source_year"})
    df = df.withColumns(
        {
            "date": parse_event_time(F.col("date")),
            "updated_on": parse_event_time(F.col("updated_on")),
            "arrest": parse_bool(F.col("arrest")),
            "domestic": parse_bool(F.col("domestic")),
        }
    )
    df = conform(df.drop(YEAR_COLUMN), schemas.INCIDENTS)
    df = newest_reports(df)
    year = F.when(F.col("id").isNull(), F.lit(TRIAGE_YEAR).cast("smallint"))
    return df.withColumn(YEAR_COLUMN, year.otherwise(partition_year(F.col("date"))))


def newest_reports(df: DataFrame) -> DataFrame:
    """The latest row per id; rows without an id all stay."""
    newest = [F.col("updated_on").desc_nulls_last(), F.col("date").desc_nulls_last()]
    return latest_or_keyless(df, "id", newest)


def _snapshot(df: DataFrame, key: str, schema, run_date: date) -> DataFrame:
    """One row per key of a lookup that is delivered whole.

    Of several landed copies the one of the latest ingest date stays.
    """
    newest = [F.col("ingest_date").desc()] if "ingest_date" in df.columns else []
    kept = latest_per_key(df.filter(F.col(key).isNotNull()), [key], newest)
    year = F.lit(run_date.year).cast("smallint")
    return conform(kept.withColumn(YEAR_COLUMN, year), schema)


def clean_codes(raw: DataFrame, run_date: date) -> DataFrame:
    df = snake_columns(raw).withColumns(
        {
            "iucr": F.trim("iucr"),
            "index_code": F.upper("index_code"),
            "active": parse_bool(F.col("active")),
        }
    )
    return _snapshot(df, "iucr", schemas.CODES, run_date)


def clean_areas(raw: DataFrame, run_date: date) -> DataFrame:
    df = rename_present(snake_columns(raw), schemas.AREA_NAMES)
    typed = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in schemas.AREAS.fields
        if f.name in df.columns
    }
    return _snapshot(df.withColumns(typed), "community_area", schemas.AREAS, run_date)


def clean_weather(raw: DataFrame) -> DataFrame:
    """Hourly observations from parallel arrays, one row per hour and file."""
    arrays = [F.col(f"hourly.{f.name}") for f in raw.schema["hourly"].dataType.fields]
    hours = raw.select(F.explode(F.arrays_zip(*arrays)).alias("h"))
    names = {
        "temperature_celsius": "temperature_2m",
        "precipitation_mm": "precipitation",
        "wind_speed_kmh": "wind_speed_10m",
        "weather_code_wmo": "weather_code",
        "relative_humidity_pct": "relative_humidity_2m",
    }
    typed = [
        F.col(f"h.{source}").try_cast(schemas.WEATHER[name].dataType).alias(name)
        for name, source in names.items()
    ]
    df = hours.select(parse_iso_minutes(F.col("h.time")).alias("obs_time"), *typed)
    df = df.filter(F.col("obs_time").isNotNull())
    return conform(
        df.withColumns(
            {
                "weather_category": weather_category(F.col("weather_code_wmo")),
                "temp_band": temperature_band(F.col("temperature_celsius")),
                "precip_band": precipitation_band(F.col("precipitation_mm")),
                YEAR_COLUMN: F.year("obs_time").cast("smallint"),
            }
        ),
        schemas.WEATHER,
    )


def load_incidents(spark: SparkSession, root: str, source: str) -> DataFrame:
    raw = read_csv(spark, root, source)
    if raw is None:
        return empty(spark, schemas.INCIDENTS)
    return clean_incidents(raw.drop("ingest_date"))


def add_incidents(
    store: TableStore, table: str, landing: str, source: str, days: Sequence[date]
) -> DataFrame:
    """Bring the cleaned table up to date with the files of some ingest dates; only these are read."""
    raw = read_csv(store.spark, landing, source, days=days)
    if raw is not None:
        merge_incidents(store, table, incident_batch(raw))
    return store.read(table)


def incident_batch(raw: DataFrame) -> DataFrame:
    return materialize(clean_incidents(raw.drop("ingest_date")), "incidents")


def merge_incidents(store: TableStore, table: str, batch: DataFrame) -> list:
    """Merge cleaned reports into the published table; returns the years that were rewritten.

    The result is the same as cleaning all reports again, because the latest of the latest
    is the latest; merging a batch again changes nothing. Only the years are rewritten where a
    new row or an older report of the same incident lies.
    """
    if not store.exists(table):
        store.publish(table, batch, YEAR_COLUMN)
        return [row[0] for row in batch.select(YEAR_COLUMN).distinct().collect()]
    current = store.read(table)
    known = current.select("id", YEAR_COLUMN)
    moved = known.join(sized(batch.select("id"), batch.count()), "id", "left_semi").select(YEAR_COLUMN)
    touched = batch.select(YEAR_COLUMN).union(moved).distinct()
    years = [row[0] for row in touched.collect()]  # a handful: calendar years
    base = current.filter(in_values(YEAR_COLUMN, years))
    state = newest_reports(base.unionByName(batch))
    store.publish(table, state, YEAR_COLUMN, years)
    return years


def merge_weather(store: TableStore, table: str, rows: DataFrame, files: Sequence[str]) -> None:
    """Add the observations of some landed files; a file of the batch that was added last is not added again."""
    if not store.exists(table):
        store.publish(table, rows, YEAR_COLUMN, made_from={"files": list(files)})
        return
    if set(store.made_from(table).get("files", ())) >= set(files):
        return
    rows = materialize(rows, table)
    years = [row[0] for row in rows.select(YEAR_COLUMN).distinct().collect()]
    state = store.read(table).filter(in_values(YEAR_COLUMN, years)).unionByName(rows)
    store.publish(table, state, YEAR_COLUMN, years, made_from={"files": list(files)})


def merge_snapshot(
    store: TableStore, table: str, key: str, rows: DataFrame, run_date: date, newest: date
) -> None:
    """Overwrite a lookup's rows by those of later deliveries; keys they lack stay."""
    year = F.lit(run_date.year).cast("smallint")
    rows = materialize(rows, table)
    if store.exists(table):
        kept = store.read(table).join(sized(rows.select(key), rows.count()), key, "left_anti")
        rows = kept.select(rows.columns).withColumn(YEAR_COLUMN, year).unionByName(rows)
    store.publish(table, rows, YEAR_COLUMN, made_from={"newest": newest.isoformat()})


def load_codes(
    spark: SparkSession, root: str, source: str, run_date: date, files: Sequence[str] | None = None
) -> DataFrame:
    raw = read_csv(spark, root, source, files=files)
    return empty(spark, schemas.CODES) if raw is None else clean_codes(raw, run_date)


def load_areas(
    spark: SparkSession, root: str, source: str, run_date: date, files: Sequence[str] | None = None
) -> DataFrame:
    raw = read_csv(spark, root, source, files=files)
    return empty(spark, schemas.AREAS) if raw is None else clean_areas(raw, run_date)


def load_weather(
    spark: SparkSession, root: str, source: str, files: Sequence[str] | None = None
) -> DataFrame:
    raw = read_json(spark, root, source, schemas.WEATHER_FEED, files)
    return empty(spark, schemas.WEATHER) if raw is None else clean_weather(raw)
