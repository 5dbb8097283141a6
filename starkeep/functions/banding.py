"""Numbers to named bands by ordered rules."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weather codes (WMO code table, inclusive ranges), temperature
# bands in Celsius and precipitation bands in millimetres (upper bounds, exclusive).
WEATHER_CODES = [
    (0, 0, "Clear"),
    (1, 3, "Cloudy"),
    (45, 48, "Fog"),
    (51, 67, "Rain"),
    (71, 77, "Snow"),
    (80, 82, "Rain"),
    (85, 86, "Snow"),
    (95, 99, "Storm"),
]
TEMPERATURE_BANDS = [(0, "Freezing"), (10, "Cold"), (20, "Mild"), (30, "Warm")]
PRECIPITATION_BANDS = [(1, "Light"), (5, "Moderate")]


def first_match(rules: list[tuple[Column, str]], otherwise: str | None) -> Column:
    """Label of the first rule that holds."""
    chain = reduce(lambda done, r: done.when(r[0], r[1]), rules[1:], F.when(*rules[0]))
    return chain.otherwise(otherwise)


def weather_category(code: Column) -> Column:
    return first_match(
        [(code.between(lo, hi), label) for lo, hi, label in WEATHER_CODES], "Other"
    )


def temperature_band(celsius: Column, missing: str = "Unavailable") -> Column:
    """``missing`` names the band of NULL; pass ``"Hot"`` for the original's reading."""
    below = [(celsius < limit, label) for limit, label in TEMPERATURE_BANDS]
    return first_match([(celsius.isNull(), missing), *below], "Hot")


def precipitation_band(millimetres: Column) -> Column:
    below = [(millimetres < limit, label) for limit, label in PRECIPITATION_BANDS]
    dry = millimetres.isNull() | (millimetres == 0)
    return first_match([(dry, "None"), *below], "Heavy")
