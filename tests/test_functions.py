import hashlib
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starkeep.functions import banding, calendar, hashing, keys, naming, parsing
from starkeep.operators import dimensions
from starkeep.plans.schemas import FLAG_LABELS


@pytest.mark.parametrize(
    "header, name",
    [
        ("Storm Level", "storm_level"),
        ("GPS Fix", "gps_fix"),
        ("UTC", "utc"),
        ("row_total", "row_total"),
        ("xCoordinate", "x_coordinate"),
        ("  spaced  out ", "spaced_out"),
        ("PER_CAPITA_INCOME_", "per_capita_income"),
        ("Percent Aged 16+ (old)", "percent_aged_16_old"),
    ],
)
def test_snake_case(header, name):
    assert naming.to_snake_case(header) == name
    assert naming.to_snake_case(name) == name


def test_headers_that_fall_together_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["Case Number", "case_number"])
    with pytest.raises(ValueError):
        naming.snake_columns(df)


def test_event_times(spark):
    times = {
        "2024-06-01T14:30:00.000": datetime(2024, 6, 1, 14, 30),
        "2024-06-01T14:30:00.125": datetime(2024, 6, 1, 14, 30, 0, 125000),
        "06/01/2024 02:30:00 PM": datetime(2024, 6, 1, 14, 30),
        "06/01/2024 12:00:00 am": datetime(2024, 6, 1),
        "06/01/2024 12:00:05 PM": datetime(2024, 6, 1, 12, 0, 5),
        "03/10/2024 02:30:00 AM": datetime(2024, 3, 10, 2, 30),  # hour skipped by DST
        "2024-03-10T02:30:00.000": datetime(2024, 3, 10, 2, 30),
        "06/01/2024 13:30:00 PM": None,
        "06/01/2024 00:30:00 PM": None,
        "13/01/2024 02:30:00 PM": None,
        "02/30/2024 02:30:00 PM": None,
        "2024-02-30T00:00:00.000": None,
        "2024-06-01": None,
        "garbage": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(t,) for t in times], "t string")
    got = df.select("t", parsing.parse_event_time(F.col("t")).alias("p")).collect()
    assert {r.t: r.p for r in got} == times


def test_minute_times(spark):
    df = spark.createDataFrame([("2024-06-01T13:00",), ("2024-06-01",)], "t string")
    got = [r[0] for r in df.select(parsing.parse_iso_minutes(F.col("t"))).collect()]
    assert got == [datetime(2024, 6, 1, 13), None]


def test_tolerant_bool(spark):
    words = ["True", "falsE", "  true", "FALSE ", "   ", "yes", "0", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(parsing.parse_bool(F.col("w"))).collect()]
    assert got == [True, False, True, False, None, None, None, None]


def test_bad_casts_are_null(spark):
    df = spark.createDataFrame([("12", "1.5"), ("x", "")], "a string, b string")
    types = {"a": "smallint", "b": "decimal(5,2)"}
    got = [tuple(r) for r in parsing.cast_columns(df, types).collect()]
    assert got == [(12, Decimal("1.50")), (None, None)]


def test_hash(spark):
    df = spark.createDataFrame(
        [("Oslo", "7"), ("Oslo", "7"), (None, "7"), ("", "7"), ("no", "rth"), ("nor", "th")],
        "a string, b string",
    )
    got = [bytes(r[0]) for r in df.select(hashing.change_hash(["a", "b"])).collect()]
    assert got[0] == got[1] == hashlib.sha256(b"Oslo||7").digest()
    assert got[2] != got[3] and got[4] != got[5]
    none = df.select(hashing.change_hash([])).distinct().collect()
    assert [bytes(r[0]) for r in none] == [hashlib.sha256(b"").digest()]
    spoof = spark.createDataFrame([(None, "7"), ("<<NULL>>", "7")], "a string, b string")
    assert spoof.select(hashing.change_hash_json(["a", "b"])).distinct().count() == 2


def test_fingerprint_counts_repeats(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    prints = [
        tuple(hashing.fingerprint(df).first())
        for df in (one, one.orderBy("s", ascending=False), one.union(one).union(one))
    ]
    assert prints[0] == prints[1] != prints[2]
    assert tuple(hashing.fingerprint(one.limit(0)).first())[0] == 0


def test_keys_and_measures(spark):
    df = spark.createDataFrame(
        [
            (datetime(2024, 6, 1, 23, 59), datetime(2024, 6, 2, 1, 58, 59), True),
            (datetime(2024, 6, 1, 2), datetime(2024, 5, 31, 23, 1), False),
            (datetime(2024, 3, 9, 12), datetime(2024, 3, 10, 12), False),  # DST starts
            (None, datetime(2024, 6, 1), None),
        ],
        "a timestamp_ntz, b timestamp_ntz, f boolean",
    )
    a, b = F.col("a"), F.col("b")
    got = df.select(
        keys.date_key(a),
        keys.hour_key(a),
        keys.elapsed_hours(a, b),
        keys.flag_measure(F.col("f")),
        keys.partition_year(a),
    ).collect()
    assert [tuple(r) for r in got] == [
        (20240601, 23, 1, 1, 2024),
        (20240601, 2, -2, 0, 2024),
        (20240309, 12, 24, 0, 2024),
        (0, 0, None, 0, 9999),
    ]


def test_bands(spark):
    def labels(fn, values, kind):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        return [r[0] for r in df.select(fn(F.col("v"))).collect()]

    codes = [0, 3, 45, 60, 77, 82, 86, 99, 4, 100, None]
    assert labels(banding.weather_category, codes, "int") == [
        "Clear", "Cloudy", "Fog", "Rain", "Snow", "Rain", "Snow", "Storm",
        "Other", "Other", "Other",
    ]
    degrees = [-0.1, 0.0, 9.9, 19.9, 29.9, 30.0, None]
    assert labels(banding.temperature_band, degrees, "double") == [
        "Freezing", "Cold", "Cold", "Mild", "Warm", "Hot", "Unavailable",
    ]
    assert labels(lambda c: banding.temperature_band(c, "Hot"), [None], "double") == ["Hot"]
    rain = [None, 0.0, 0.5, 1.0, 5.0]
    assert labels(banding.precipitation_band, rain, "double") == [
        "None", "None", "Light", "Moderate", "Heavy",
    ]


def nth_weekday(year, month, weekday, n):
    day = date(year, month, 1)
    days = [day + timedelta(i) for i in range(31)]
    hits = [d for d in days if d.month == month and d.weekday() == weekday]
    return hits[n]


def test_calendar(spark):
    calendar_rows = dimensions.calendar_dimension(spark).collect()
    assert len(calendar_rows) == 4749  # the days of 2018..2030 and the unknown day
    days = {r.full_date: r for r in calendar_rows}
    unknown = days.pop(date(1, 1, 1))
    assert (unknown.date_key, unknown.day_name, unknown.year) == (0, "Unknown", 0)
    for d, r in days.items():
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert r.day_of_week == d.isoweekday() % 7
        assert (r.day_name, r.month_name) == (d.strftime("%A"), d.strftime("%B"))
        assert r.is_weekend == (d.weekday() >= 5)
        assert (r.year, r.month_num, r.iso_week) == (d.year, d.month, d.isocalendar()[1])
        assert r.quarter == (d.month + 2) // 3
    for year in range(2018, 2031):
        expected = {date(year, m, d) for m, d in ((1, 1), (7, 4), (11, 11), (12, 25))}
        if year >= 2021:
            expected.add(date(year, 6, 19))
        rules = [(1, 0, 2), (2, 0, 2), (5, 0, -1), (9, 0, 0), (10, 0, 1), (11, 3, 3)]
        expected |= {nth_weekday(year, m, w, n) for m, w, n in rules}
        assert {d for d, r in days.items() if d.year == year and r.is_us_holiday} == expected


def test_holiday_names_cover_the_flag(spark):
    days = dimensions.days_between(spark, date(2020, 1, 1), date(2022, 12, 31))
    named = {r.full_date for r in dimensions.holidays(days).collect()}
    flagged = dimensions.describe_days(days).filter("is_us_holiday").collect()
    assert named == {r.full_date for r in flagged}


def test_clock(spark):
    hours = {r.time_key: r for r in dimensions.time_of_day_dimension(spark).collect()}
    assert sorted(hours) == list(range(24))
    for h, r in hours.items():
        at = datetime(2024, 1, 1, h)
        assert (r.hour_12, r.am_pm) == (int(at.strftime("%I")), at.strftime("%p"))
    ends = {4: "Late Night", 5: "Early Morning", 8: "Early Morning", 9: "Morning",
            12: "Afternoon", 16: "Afternoon", 17: "Evening", 20: "Evening", 21: "Night"}
    assert {h: hours[h].period_of_day for h in ends} == ends


def test_flags(spark):
    flags = dimensions.junk_dimension(spark, "flags_key", FLAG_LABELS)
    assert [tuple(r) for r in flags.orderBy("flags_key").collect()] == [
        (0, None, None, "Unknown"),
        (1, False, False, "No Arrest, Non-Domestic"),
        (2, True, False, "Arrest, Non-Domestic"),
        (3, False, True, "No Arrest, Domestic"),
        (4, True, True, "Arrest, Domestic"),
    ]


def test_reserved_members_are_added_once(spark):
    days = dimensions.describe_days(
        dimensions.days_between(spark, date(2024, 1, 1), date(2024, 1, 3))
    )
    once = dimensions.with_reserved(days, [dimensions.UNKNOWN_DAY])
    assert dimensions.with_reserved(once, [dimensions.UNKNOWN_DAY]).count() == 4
