import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from starkeep.functions.hashing import fingerprint
from starkeep.plans import cleaning, schemas
from starkeep.sources import landing
from starkeep.sources.store import TableStore
from starkeep.sources.tables import (
    newest_snapshot,
    optional_table,
    read_cleaned,
    without_triage,
    write_cleaned,
)

HEADER = (
    "ID,Case Number,Date,Block,IUCR,Primary Type,Description,Location Description,Arrest,"
    "Domestic,Beat,District,Ward,Community Area,FBI Code,X Coordinate,Y Coordinate,Year,"
    "Updated On,Latitude,Longitude,Location"
)
REPORTS = [
    # the same id twice, corrected later
    '1,A1,06/01/2024 01:00:00 PM,1 MAIN,0110,T,D,STREET,false,true,0111,001,1,7,01A,1,2,'
    '2024,06/02/2024 01:00:00 PM,41.5,-87.25,"(41.5, -87.25)"',
    '1,A1,06/01/2024 01:00:00 PM,1 MAIN,0110,T,D,STREET,true,true,0111,001,1,7,01A,1,2,'
    '2024,06/05/2024 01:00:00 PM,41.5,-87.25,"(41.5, -87.25)"',
    # quotes inside, no area, no coordinates
    '2,A2,2024-06-01T02:00:00.000,"2 ""OLD"" ROAD, REAR",0110,T,D,,false,false,0112,002,'
    ',,01A,,,2024,2024-06-02T00:00:00.000,,,',
    # an event of the year before
    '3,A3,12/31/2023 11:30:00 PM,3 MAIN,0120,T,D,HOME,FALSE,TRUE,0113,003,3,9,02,1,2,2023,'
    '06/01/2024 01:00:00 PM,41.886000000,-87.1,"(41, -87)"',
    # no readable date
    '4,A4,,4 MAIN,0120,T,D,HOME,maybe,,0113,003,300000,x,02,1,2,,,41.1,-87.1,',
    # no id, twice the same number of other things
    ',A5,06/03/2024 01:00:00 PM,5 MAIN,0120,T,D,HOME,true,,0113,003,3,9,02,1,2,2024,,,,',
    ',A6,06/04/2024 01:00:00 PM,6 MAIN,0120,T,D,HOME,true,,0113,003,3,9,02,1,2,2024,,,,',
]


def put(root, source, name, text, day="2024-06-01"):
    folder = root / source / f"ingest_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture
def incidents(spark, tmp_path):
    put(tmp_path, "incidents", "a.csv", "\n".join([HEADER, *REPORTS]) + "\n")
    return cleaning.load_incidents(spark, str(tmp_path) + "/", "incidents")


def test_incident_schema(incidents):
    assert incidents.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.INCIDENTS.fields
    ]


def test_latest_report_wins(incidents):
    got = {r.id: r for r in incidents.filter("id is not null").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[1].arrest is True and got[1].updated_on == datetime(2024, 6, 5, 13)
    assert got[2].block == '2 "OLD" ROAD, REAR'
    assert got[2].latitude is None and got[2].community_area is None
    assert got[2].district == "002"
    assert got[3].latitude == Decimal("41.886000")
    assert (got[4].date, got[4].ward, got[4].community_area) == (None, None, None)
    assert (got[4].arrest, got[4].domestic) == (None, None)


def test_triage_keeps_every_row(incidents):
    years = incidents.groupBy("_ingest_year").count().collect()
    assert {r[0]: r[1] for r in years} == {2023: 1, 2024: 2, 9999: 3}
    assert without_triage(incidents).count() == 3


def test_repeat_gives_the_same_rows(spark, incidents, tmp_path):
    again = cleaning.load_incidents(spark, str(tmp_path), "incidents")
    assert fingerprint(incidents).first() == fingerprint(again).first()


def test_adding_dates_equals_cleaning_all(spark, tmp_path):
    root, days = str(tmp_path / "landing"), [date(2024, 6, d) for d in (1, 2, 3)]
    store = TableStore(spark, str(tmp_path / "store"))
    for day, reports in zip(days, (REPORTS[1:3], REPORTS[:1] + REPORTS[3:6], REPORTS[5:])):
        text = "\n".join([HEADER, *reports]) + "\n"
        put(tmp_path / "landing", "incidents", "a.csv", text, day.isoformat())
        if day == days[0]:
            first = cleaning.load_incidents(spark, root, "incidents")
            store.publish("incidents", first, "_ingest_year")
        else:
            cleaning.add_incidents(store, "incidents", root, "incidents", [day])
    whole = cleaning.load_incidents(spark, root, "incidents")
    added = store.read("incidents")
    assert fingerprint(added).first() == fingerprint(whole).first()
    assert added.count() == 6


def test_no_files_no_reader(spark, tmp_path, monkeypatch):
    def refuse(*args):
        raise AssertionError("reader was called")

    monkeypatch.setattr(landing, "_reader", refuse)
    loads = {
        "INCIDENTS": cleaning.load_incidents(spark, str(tmp_path), "none"),
        "CODES": cleaning.load_codes(spark, str(tmp_path), "none", date(2024, 1, 1)),
        "AREAS": cleaning.load_areas(spark, str(tmp_path), "none", date(2024, 1, 1)),
        "WEATHER": cleaning.load_weather(spark, str(tmp_path), "none"),
    }
    for name, df in loads.items():
        assert df.schema == getattr(schemas, name) and df.count() == 0


def test_unknown_columns_are_dropped_and_absent_ones_null(spark, tmp_path):
    put(tmp_path, "i", "a.csv", "ID,Date,Updated On,Arrest,Domestic,Novel\n7,,,,,x\n")
    row = cleaning.load_incidents(spark, str(tmp_path), "i").first()
    assert row.id == 7 and row.iucr is None and "novel" not in row.asDict()


def test_codes(spark, tmp_path):
    text = "IUCR,PRIMARY DESCRIPTION,SECONDARY DESCRIPTION,INDEX CODE,ACTIVE\n"
    put(tmp_path, "codes", "a.csv", text + " 0110 ,OLD,X,i,TRUE\n,NO CODE,X,n,TRUE\n")
    put(tmp_path, "codes", "b.csv", text + "0110,NEW,X,i,False\n", day="2024-07-01")
    got = cleaning.load_codes(spark, str(tmp_path), "codes", date(2024, 7, 2)).collect()
    assert [tuple(r) for r in got] == [("0110", "NEW", "X", "I", False, 2024)]


def test_areas(spark, tmp_path):
    text = (
        "ca,community_area_name,percent_of_housing_crowded,"
        "percent_households_below_poverty,percent_aged_16_unemployed,"
        "percent_aged_25_without_high_school_diploma,percent_aged_under_18_or_over_64,"
        "per_capita_income_,hardship_index\n"
        "7,North,7.9,15.1,bad,18.7,28.8,23939,39\n,Total,1,1,1,1,1,1,1\n"
    )
    put(tmp_path, "areas", "a.csv", text)
    got = cleaning.load_areas(spark, str(tmp_path), "areas", date(2024, 7, 2)).collect()
    assert [tuple(r) for r in got] == [
        (7, "North", Decimal("7.90"), Decimal("15.10"), None, Decimal("18.70"),
         Decimal("28.80"), 23939, 39, 2024)
    ]


def test_weather(spark, tmp_path):
    hourly = {
        "time": ["2024-06-01T13:00", "2024-06-01T14:00", "bad"],
        "temperature_2m": [31.5, None, 1.0],
        "precipitation": [0.0, None, 1.0],
        "wind_speed_10m": [3.25, 4.0, 1.0],
        "weather_code": [0, 95, 1],
        "relative_humidity_2m": [50, 51, 52],
    }
    put(tmp_path, "weather", "a.json", json.dumps({"hourly": hourly}, indent=1))
    got = cleaning.load_weather(spark, str(tmp_path), "weather").orderBy("obs_time")
    assert [tuple(r) for r in got.collect()] == [
        (datetime(2024, 6, 1, 13), Decimal("31.50"), Decimal("0.00"), Decimal("3.25"), 0,
         Decimal("50.00"), "Clear", "Hot", "None", 2024),
        (datetime(2024, 6, 1, 14), None, None, Decimal("4.00"), 95, Decimal("51.00"),
         "Storm", "Unavailable", "None", 2024),
    ]


def test_a_file_with_other_columns_fails_under_a_schema(spark, tmp_path):
    put(tmp_path, "s", "a.csv", "a,b\n1,2\n")
    put(tmp_path, "s", "b.csv", "b,a\n2,1\n")
    df = landing.read_csv(spark, str(tmp_path), "s", schemas.table(a="string", b="string"))
    with pytest.raises(Exception):
        df.collect()


def test_landing_appends(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "x", y')], "a string, b string")
    for day in (date(2024, 1, 1), date(2024, 1, 1), date(2024, 1, 2)):
        landing.land(df, str(tmp_path), "s", day)
    got = landing.read_csv(spark, str(tmp_path), "s")
    counts = {str(r[0]): r[1] for r in got.groupBy("ingest_date").count().collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 1}
    assert {r.b for r in got.collect()} == {'say "x", y'}


def test_cleaned_tables(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 2024), (2, 2023), (3, 9999)], "id int, _ingest_year smallint"
    )
    path = str(tmp_path / "t")
    write_cleaned(df, path)
    write_cleaned(spark.createDataFrame([(9, 2023)], df.schema), path)
    table = spark.read.schema(df.schema).parquet(path)
    assert sorted(r.id for r in table.collect()) == [1, 3, 9]
    table.createOrReplaceTempView("cleaned_probe")
    assert sorted(r.id for r in read_cleaned(spark, "cleaned_probe").collect()) == [1, 9]
    plain = spark.createDataFrame([(1,)], "id int")
    assert without_triage(plain) is plain
    assert optional_table(spark, "no_such_table") is None
    assert [r.id for r in newest_snapshot(without_triage(table)).collect()] == [1]
