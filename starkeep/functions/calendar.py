"""Calendar and clock attributes."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from starkeep.functions.banding import first_match
from starkeep.functions.keys import date_key

# United States federal holidays. Fixed: name, month, day, first year.
# Floating: name, month, day of week (0 = Sunday), first and last day of month.
FIXED_HOLIDAYS = [
    ("New Year", 1, 1, None),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas", 12, 25, None),
    ("Juneteenth", 6, 19, 2021),
]
FLOATING_HOLIDAYS = [
    ("Martin Luther King Day", 1, 1, 15, 21),
    ("Presidents Day", 2, 1, 15, 21),
    ("Memorial Day", 5, 1, 25, 31),
    ("Labor Day", 9, 1, 1, 7),
    ("Columbus Day", 10, 1, 8, 14),
    ("Thanksgiving", 11, 4, 22, 28),
]

# Periods of the day by last hour, inclusive.
DAY_PERIODS = [
    (4, "Late Night"),
    (8, "Early Morning"),
    (11, "Morning"),
    (16, "Afternoon"),
    (20, "Evening"),
]
LAST_PERIOD = "Night"


def day_of_week(day: Column) -> Column:
    """0 = Sunday."""
    return F.dayofweek(day) - 1


def holiday_rules(day: Column) -> dict[str, Column]:
    """One predicate per holiday."""
    rules = {}
    for name, month, dom, since in FIXED_HOLIDAYS:
        hit = (F.month(day) == month) & (F.dayofmonth(day) == dom)
        rules[name] = hit if since is None else hit & (F.year(day) >= since)
    for name, month, dow, first, last in FLOATING_HOLIDAYS:
        rules[name] = (
            (F.month(day) == month)
            & (day_of_week(day) == dow)
            & F.dayofmonth(day).between(first, last)
        )
    return rules


def is_holiday(day: Column) -> Column:
    return reduce(or_, holiday_rules(day).values())


def holiday_names(day: Column) -> Column:
    """All holidays that fall on the day, as an array (empty on other days)."""
    hits = [F.when(hit, F.lit(name)) for name, hit in holiday_rules(day).items()]
    return F.array_compact(F.array(*hits))


def calendar_columns(day: Column) -> dict[str, Column]:
    """The attributes of one calendar day, in table order."""
    return {
        "date_key": date_key(day, default=None),
        "full_date": day,
        "day_of_week": day_of_week(day).cast("smallint"),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": day_of_week(day).isin(0, 6),
        "is_us_holiday": is_holiday(day),
        "month_num": F.month(day).cast("smallint"),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day).cast("smallint"),
        "year": F.year(day).cast("smallint"),
        "iso_week": F.weekofyear(day).cast("smallint"),
    }


def clock_columns(hour: Column) -> dict[str, Column]:
    """The attributes of one hour of the day, in table order."""
    return {
        "time_key": hour.cast("smallint"),
        "hour_24": hour.cast("smallint"),
        "hour_12": ((hour + 11) % 12 + 1).cast("smallint"),
        "am_pm": F.when(hour < 12, "AM").otherwise("PM"),
        "period_of_day": first_match(
            [(hour <= last, label) for last, label in DAY_PERIODS], LAST_PERIOD
        ),
    }
