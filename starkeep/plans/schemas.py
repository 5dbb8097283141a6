"""The incident warehouse's columns, types, keys and reserved members.

Wall-clock times are TIMESTAMP_NTZ; fixed-length codes are strings.
"""

from pyspark.sql import types as T

from starkeep.functions.keys import NOT_APPLICABLE_KEY, UNKNOWN_KEY
from starkeep.operators.quality import Contract
from starkeep.operators.scd import OPEN_END, OPEN_START, VersionSpec


def table(required: str = "", **types: str) -> T.StructType:
    """Columns in order with their types; ``required`` names those that are never NULL."""
    schema = T.StructType()
    for name, type_name in types.items():
        schema.add(name, type_name, name not in required.split())
    return schema


# Cleaned tables.

INCIDENTS = table(
    id="long",
    case_number="string",
    date="timestamp_ntz",
    block="string",
    iucr="string",
    primary_type="string",
    description="string",
    location_description="string",
    arrest="boolean",
    domestic="boolean",
    beat="string",
    district="string",
    ward="short",
    community_area="short",
    fbi_code="string",
    source_year="short",
    updated_on="timestamp_ntz",
    latitude="decimal(9,6)",
    longitude="decimal(9,6)",
    _ingest_year="short",
    required="_ingest_year",
)

CODES = table(
    iucr="string",
    primary_description="string",
    secondary_description="string",
    index_code="string",
    active="boolean",
    _ingest_year="short",
    required="iucr _ingest_year",
)

AREAS = table(
    community_area="short",
    community_area_name="string",
    pct_housing_crowded="decimal(5,2)",
    pct_below_poverty="decimal(5,2)",
    pct_unemployed_16plus="decimal(5,2)",
    pct_no_hs_25plus="decimal(5,2)",
    pct_under18_or_over64="decimal(5,2)",
    per_capita_income_usd="integer",
    hardship_index="short",
    _ingest_year="short",
    required="community_area _ingest_year",
)

WEATHER = table(
    obs_time="timestamp_ntz",
    temperature_celsius="decimal(5,2)",
    precipitation_mm="decimal(6,2)",
    wind_speed_kmh="decimal(5,2)",
    weather_code_wmo="short",
    relative_humidity_pct="decimal(5,2)",
    weather_category="string",
    temp_band="string",
    precip_band="string",
    _ingest_year="short",
    required="obs_time _ingest_year",
)

# Area feed: header names to ours.
AREA_NAMES = {
    "ca": "community_area",
    "percent_of_housing_crowded": "pct_housing_crowded",
    "percent_households_below_poverty": "pct_below_poverty",
    "percent_aged_16_unemployed": "pct_unemployed_16plus",
    "percent_aged_25_without_high_school_diploma": "pct_no_hs_25plus",
    "percent_aged_under_18_or_over_64": "pct_under18_or_over64",
    "per_capita_income": "per_capita_income_usd",
}

# Weather feed: one object per file, parallel arrays under "hourly".
def _arrays(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, T.ArrayType(t)) for n, t in types.items()])


WEATHER_FEED = T.StructType().add(
    "hourly",
    _arrays(
        time=T.StringType(),
        temperature_2m=T.DoubleType(),
        precipitation=T.DoubleType(),
        wind_speed_10m=T.DoubleType(),
        weather_code=T.DoubleType(),
        relative_humidity_2m=T.DoubleType(),
    ),
)

# Versioned dimensions.

LOCATION = VersionSpec(
    surrogate="location_key",
    keys=("community_area", "district", "ward", "beat"),
    others=("block", "community_area_name"),
    tracked=(
        "pct_housing_crowded",
        "pct_below_poverty",
        "pct_unemployed_16plus",
        "pct_no_hs_25plus",
        "pct_under18_or_over64",
        "per_capita_income_usd",
        "hardship_index",
    ),
)

INCIDENT_TYPE = VersionSpec(
    surrogate="crime_type_key",
    keys=("iucr",),
    tracked=("primary_type", "description", "fbi_code", "index_code", "active"),
)

# Warehouse tables.

LIFE = {
    "scd_start_date": "date",
    "scd_end_date": "date",
    "is_current": "boolean",
    "scd_version": "short",
    "scd_hash": "binary",
}
LIFE_REQUIRED = " ".join(LIFE)

CONTRACTS = {
    "dim_date": Contract(
        table(
            date_key="integer",
            full_date="date",
            day_of_week="short",
            day_name="string",
            is_weekend="boolean",
            is_us_holiday="boolean",
            month_num="short",
            month_name="string",
            quarter="short",
            year="short",
            iso_week="short",
            required="date_key full_date day_of_week day_name is_weekend is_us_holiday month_num month_name quarter year iso_week",
        ),
        (("date_key",), ("full_date",)),
    ),
    "dim_time_of_day": Contract(
        table(
            time_key="short",
            hour_24="short",
            hour_12="short",
            am_pm="string",
            period_of_day="string",
            required="time_key hour_24 hour_12 am_pm period_of_day",
        ),
        (("time_key",),),
    ),
    "dim_location": Contract(
        table(
            location_key="long",
            community_area="short",
            district="string",
            ward="short",
            beat="string",
            block="string",
            community_area_name="string",
            pct_housing_crowded="decimal(5,2)",
            pct_below_poverty="decimal(5,2)",
            pct_unemployed_16plus="decimal(5,2)",
            pct_no_hs_25plus="decimal(5,2)",
            pct_under18_or_over64="decimal(5,2)",
            per_capita_income_usd="integer",
            hardship_index="short",
            **LIFE,
            required=f"location_key {LIFE_REQUIRED}",
        ),
        (
            ("location_key",),
            ("community_area", "district", "ward", "beat", "scd_start_date"),
        ),
    ),
    "dim_crime_type": Contract(
        table(
            crime_type_key="long",
            iucr="string",
            primary_type="string",
            description="string",
            fbi_code="string",
            index_code="string",
            active="boolean",
            **LIFE,
            required=f"crime_type_key iucr active {LIFE_REQUIRED}",
        ),
        (("crime_type_key",), ("iucr", "scd_start_date")),
    ),
    "dim_weather": Contract(
        table(
            weather_key="long",
            obs_date_key="integer",
            obs_hour="short",
            weather_code_wmo="short",
            weather_category="string",
            temp_band="string",
            precip_band="string",
            required="weather_key obs_date_key obs_hour",
        ),
        (("weather_key",), ("obs_date_key", "obs_hour")),
    ),
    "dim_crime_flags": Contract(
        table(
            flags_key="short",
            is_arrest="boolean",
            is_domestic="boolean",
            label="string",
            required="flags_key label",
        ),
        (("flags_key",),),
    ),
    "dim_arrestee": Contract(
        table(
            arrestee_key="long",
            race="string",
            age_band="string",
            sex="string",
            required="arrestee_key",
        ),
        (("arrestee_key",),),
    ),
    "fact_crime": Contract(
        table(
            crime_pk="long",
            crime_id="long",
            case_number="string",
            occurrence_date_key="integer",
            occurrence_time_key="short",
            report_date_key="integer",
            location_key="long",
            crime_type_key="long",
            weather_key="long",
            flags_key="short",
            incident_count="short",
            is_arrest="short",
            is_domestic="short",
            hours_to_update="integer",
            latitude="decimal(9,6)",
            longitude="decimal(9,6)",
            temperature_celsius="decimal(5,2)",
            precipitation_mm="decimal(6,2)",
            required="crime_pk crime_id occurrence_date_key occurrence_time_key report_date_key location_key crime_type_key weather_key flags_key incident_count is_arrest is_domestic",
        ),
        (("crime_pk",), ("crime_id",)),
    ),
    "fact_arrest": Contract(
        table(
            arrest_pk="long",
            cb_no="long",
            case_number="string",
            arrest_date_key="integer",
            arrest_time_key="short",
            arrestee_key="long",
            arrest_count="short",
            charge_count="integer",
            required="arrest_pk cb_no arrest_date_key arrest_time_key arrest_count charge_count",
        ),
        (("arrest_pk",), ("cb_no",)),
    ),
    "bridge_arrest_charge": Contract(
        table(
            arrest_pk="long",
            crime_type_key="long",
            charge_position="integer",
            charge_class="string",
            charge_statute="string",
            required="arrest_pk crime_type_key charge_position",
        ),
        (("arrest_pk", "charge_position"),),
    ),
}

# Reserved members.

_ALWAYS = {
    "scd_start_date": OPEN_START,
    "scd_end_date": OPEN_END,
    "is_current": True,
    "scd_version": 1,
    "scd_hash": bytes(1),
}

UNKNOWN_LOCATION = {
    "location_key": UNKNOWN_KEY,
    "community_area_name": "Unknown",
    **_ALWAYS,
}

UNKNOWN_TYPE = {
    "crime_type_key": UNKNOWN_KEY,
    "iucr": "UNKN",
    "primary_type": "Unknown",
    "description": "Unknown",
    "active": False,
    **_ALWAYS,
}

NO_WEATHER = {
    "weather_key": NOT_APPLICABLE_KEY,
    "obs_date_key": UNKNOWN_KEY,
    "obs_hour": 0,
    "weather_category": "Unavailable",
    "temp_band": "Unavailable",
    "precip_band": "Unavailable",
}

# Junk dimension: words for false and true; the first flag varies fastest.
FLAG_LABELS = {
    "is_arrest": ("No Arrest", "Arrest"),
    "is_domestic": ("Non-Domestic", "Domestic"),
}
