"""Wide reporting extract and the report queries over it.

Reports take any wide frame: they name columns, not tables. Ratios are computed from
their additive parts when asked for and never stored.
"""

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkeep.functions.keys import day
from starkeep.operators.filters import complete
from starkeep.sources.files import materialize

# The window that open validity dates are clamped to in the extract.
CLAMP_FIRST = date(1900, 1, 1)
CLAMP_LAST = date(2099, 12, 31)


def join_star(
    facts: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]
) -> DataFrame:
    """Inner star join on ``(dimension, fact key, dimension key)``.

    Every fact has a member in each dimension (reserved ones included), so the join keeps
    all facts. Spark broadcasts the dimensions that are small, and splits a skewed key of
    the others.
    """
    joined = facts
    for dimension, fact_key, dim_key in dims:
        if fact_key == dim_key:
            joined = joined.join(dimension, fact_key)
        else:
            joined = joined.join(dimension, F.col(fact_key) == F.col(dim_key))
    return joined


def prefixed(dimension: DataFrame, prefix: str) -> DataFrame:
    """A role of a dimension: all its columns under a prefix."""
    return dimension.toDF(*[f"{prefix}{c}" for c in dimension.columns])


def clamp(col: Column) -> Column:
    clamped = F.least(F.greatest(col, day(CLAMP_FIRST)), day(CLAMP_LAST))
    return clamped.cast("timestamp_ntz")


def incident_extract(
    tables: Mapping[str, DataFrame],
    need_coordinates: bool = True,
    missing_measures_as_zero: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The 41 reporting columns of every incident, and those of the facts named in ``carry``.

    ``need_coordinates`` drops incidents without a map point. Missing weather stays NULL,
    so averages leave it out; ``missing_measures_as_zero`` gives the original's zeros.
    """
    facts = tables["fact_crime"]
    if need_coordinates:
        facts = complete(facts, ["latitude", "longitude"])
    place, kind = (
        prefixed(tables["dim_location"], "loc_"),
        prefixed(tables["dim_crime_type"], "type_"),
    )
    star = join_star(
        facts,
        [
            (tables["dim_date"], "occurrence_date_key", "date_key"),
            (tables["dim_time_of_day"], "occurrence_time_key", "time_key"),
            (place, "location_key", "loc_location_key"),
            (kind, "crime_type_key", "type_crime_type_key"),
            (tables["dim_weather"], "weather_key", "weather_key"),
        ],
    )

    def text(name: str, missing: str = "Unknown") -> Column:
        return F.coalesce(F.col(name), F.lit(missing))

    def whole(name: str) -> Column:
        return F.col(name).cast("int")

    def measure(name: str) -> Column:
        if missing_measures_as_zero:
            return F.coalesce(F.col(name), F.lit(0).cast("decimal(6,2)"))
        return F.col(name)

    columns = {
        "crime_id": F.col("crime_id").cast("string"),
        "incident_count": whole("incident_count"),
        "is_arrest": whole("is_arrest"),
        "is_domestic": whole("is_domestic"),
        "hours_to_update": F.coalesce(F.col("hours_to_update"), F.lit(0)),
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
        "temperature_celsius": measure("temperature_celsius"),
        "precipitation_mm": measure("precipitation_mm"),
        "occurrence_date": F.col("full_date").cast("timestamp_ntz"),
        "occurrence_year": whole("year"),
        "occurrence_quarter": whole("quarter"),
        "occurrence_month": whole("month_num"),
        "occurrence_month_name": F.col("month_name"),
        "occurrence_day_of_week": whole("day_of_week"),
        "occurrence_day_name": F.col("day_name"),
        "occurrence_hour": whole("hour_24"),
        "period_of_day": F.col("period_of_day"),
        "community_area": F.coalesce(whole("loc_community_area"), F.lit(0)),
        "community_area_name": text("loc_community_area_name"),
        "district": text("loc_district"),
        "ward": F.coalesce(whole("loc_ward"), F.lit(0)),
        "pct_below_poverty": F.col("loc_pct_below_poverty"),
        "pct_unemployed_16plus": F.col("loc_pct_unemployed_16plus"),
        "pct_no_hs_25plus": F.col("loc_pct_no_hs_25plus"),
        "per_capita_income_usd": whole("loc_per_capita_income_usd"),
        "hardship_index": whole("loc_hardship_index"),
        "location_scd_start": clamp(F.col("loc_scd_start_date")),
        "location_scd_end": clamp(F.col("loc_scd_end_date")),
        "location_is_current": whole("loc_is_current"),
        "location_scd_version": whole("loc_scd_version"),
        "primary_type": text("type_primary_type"),
        "crime_description": text("type_description"),
        "fbi_code": text("type_fbi_code"),
        "index_code": text("type_index_code", "U"),
        "crime_type_scd_start": clamp(F.col("type_scd_start_date")),
        "crime_type_scd_end": clamp(F.col("type_scd_end_date")),
        "crime_type_is_current": whole("type_is_current"),
        "weather_category": text("weather_category", "Unavailable"),
        "temp_band": text("temp_band", "Unavailable"),
        "precip_band": text("precip_band", "Unavailable"),
    }
    return star.select(*[col.alias(name) for name, col in columns.items()], *carry)


def total(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """One row of sums; ``measures`` maps result names to columns."""
    return df.agg(*[F.sum(c).alias(n) for n, c in measures.items()])


def summarise(
    df: DataFrame,
    by: Mapping[str, Column] | Sequence[str],
    sums: Mapping[str, str] | None = None,
    averages: Mapping[str, str] | None = None,
    count: str | None = None,
) -> DataFrame:
    """Group by columns or expressions; sums, averages (NULLs left out), row count."""
    if not isinstance(by, Mapping):
        by = {name: F.col(name) for name in by}
    groups = df.groupBy(*[col.alias(name) for name, col in by.items()])
    aggregates = [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    aggregates += [F.avg(c).alias(n) for n, c in (averages or {}).items()]
    if count is not None:
        aggregates.append(F.count("*").alias(count))
    return groups.agg(*aggregates)


def page(
    df: DataFrame, visuals: Mapping[str, Sequence[str]], sums: Mapping[str, str]
) -> DataFrame:
    """All visuals of a report page from one scan: ``visual``, every column some visual groups by, and the sums.

    ``visuals`` maps each one's name to its columns (none for totals); columns it does not group by are NULL in its
    rows. One shuffle of partial sums serves all; see :func:`visual`.
    """
    columns = list(dict.fromkeys(c for by in visuals.values() for c in by))
    sets = [[F.col(c) for c in by] for by in visuals.values()]
    totals = [F.sum(c).alias(n) for n, c in sums.items()]
    grouped = df.groupingSets(sets, *columns).agg(F.grouping_id().alias("_set"), *totals)
    number = {
        name: sum(1 << k for k, c in enumerate(reversed(columns)) if c not in by)
        for name, by in visuals.items()
    }
    if len(set(number.values())) < len(number):
        raise ValueError("two visuals group by the same columns")
    named = F.create_map(*[F.lit(x) for name, n in number.items() for x in (n, name)])
    label = F.element_at(named, F.col("_set").cast("int")).alias("visual")
    return grouped.select(label, *columns, *sums)


def visual(page_rows: DataFrame, name: str, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One visual's rows of a page."""
    return page_rows.filter(F.col("visual") == name).select(*by, *sums)


def month_of(column: str) -> Column:
    return F.trunc(F.to_date(column), "month")


def monthly_trend(
    df: DataFrame, day: str, sums: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    groups = {"month": month_of(day), **{c: F.col(c) for c in by}}
    return summarise(df, groups, sums)


def category_share(df: DataFrame, category: str, measure: str) -> DataFrame:
    """Each category's sum and its share of the whole.

    The sums are written once, so that the whole is added up from them and not from a
    second pass over the facts.
    """
    sums = materialize(summarise(df, [category], {"amount": measure}), "sums")
    whole = sums.agg(F.sum("amount")).scalar()
    share = F.try_divide(F.col("amount").cast("double"), whole.cast("double"))
    return sums.withColumn("share", share)


def with_ratio(df: DataFrame, name: str, part: str, whole: str) -> DataFrame:
    """``part`` as a percentage of ``whole``, NULL for an empty whole."""
    hundred = F.col(part).cast("double") * 100
    return df.withColumn(name, F.try_divide(hundred, F.col(whole).cast("double")))


def heat_map(
    df: DataFrame, rows: str, columns: str, sums: Mapping[str, str]
) -> DataFrame:
    """Long form, one row per cell that occurs."""
    return summarise(df, [rows, columns], sums)


def heat_grid(
    df: DataFrame, rows: str, columns: str, values: Sequence, measure: str
) -> DataFrame:
    """Wide form: one column per given value of ``columns``."""
    return df.groupBy(rows).pivot(columns, list(values)).sum(measure)


def top(df: DataFrame, by: str, ties: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` largest; ``ties`` make the order total."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def drill_across(parts: Mapping[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Join aggregates of different facts that were brought to one grain.

    Each part is aggregated first, so the join sees one row per group. A NULL group of one
    part meets the NULL group of another.
    """

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]
        joined = a.alias("a").join(b.alias("b"), reduce(and_, same), "full_outer")
        keys = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in on]
        values = [F.col(f"{s}.{c}") for s, df in (("a", a), ("b", b)) for c in df.columns if c not in on]
        return joined.select(*keys, *values)

    return reduce(meet, parts.values())
