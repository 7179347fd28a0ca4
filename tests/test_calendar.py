import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import calendar as C
from tests.helpers import rows


def test_one_row_per_day_and_all_columns(spark):
    dim = C.date_dimension(spark, "2020-01-01", "2030-12-31")
    assert dim.count() == 4018
    assert dim.select("DatePK").distinct().count() == 4018
    assert len(dim.columns) == 49


def day(spark, text):
    return C.date_dimension(spark, text, text).first().asDict()


def test_week_ids_pair_iso_week_and_calendar_year(spark):
    first = day(spark, "2021-01-01")
    assert first["WeekIdIso"] == 202153 and first["YearWeekOfYearIso"] == "2021-W53"
    last = day(spark, "2024-12-30")
    assert last["WeekIdIso"] == 202401 and last["WeekOfYearIsoName"] == "W1"


def test_one_day_in_full(spark):
    got = day(spark, "2024-02-29")
    expected = {
        "DatePK": 20240229, "DateString": "29.02.2024", "IsLeapYear": True, "HalfYearId": 1, "YearHalfYearId": 20241,
        "HalfYearName": "H1", "YearHalfYear": "2024-H1", "YearQuarterId": 20241, "YearQuarter": "2024-Q1", "QuarterShortname": "Q1",
        "YearMonthId": 202402, "MonthName": "February", "MonthNameShort": "Feb", "MonthNameDe": "Februar", "MonthNameShortFr": "fév.",
        "MonthNameIt": "febbraio", "DayName": "Thursday", "DayNameShort": "Thu", "DayNameShortDe": "Do.", "DayNameIt": "giovedì",
        "DayOfYear": 60, "DayOfWeekUs": 5, "DayOfWeekIso": 4, "IsWeekDay": True, "IsLastDayOfMonth": True, "LastDayOfMonth": dt.date(2024, 2, 29),
        "MonthDay": dt.date(1972, 2, 29), "StartOfWeekUs": dt.date(2024, 2, 25), "StartOfWeekIso": dt.date(2024, 2, 26),
        "EndOfWeekUs": dt.date(2024, 3, 2), "EndOfWeekIso": dt.date(2024, 3, 3), "IsCompensation": None, "IsHoliday": None,
    }
    assert {k: got[k] for k in expected} == expected
    assert not day(spark, "1900-03-01")["IsLeapYear"] and day(spark, "2000-03-01")["IsLeapYear"]


def test_last_day_has_its_first_instant_only(spark):
    dates = C.date_range(spark, "2024-01-30", "2024-02-01")
    assert C.instants(dates, 60).count() == 2 * 1440 + 1
    assert C.instants(dates, 3600).count() == 49


@pytest.mark.parametrize("step", [7, 3600, 50000, 100000])
def test_the_grid_runs_on_over_midnight(spark, step):
    dates = C.date_range(spark, "2024-01-01", "2024-01-04")
    base = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    assert [r[0] for r in rows(C.instants(dates, step))] == list(range(base, base + 3 * 86400 + 1, step))


@pytest.mark.parametrize("zone", ["UTC", "Europe/Zurich", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = C.expand_to_datetime(C.date_range(spark, "2024-03-30", "2024-04-01"), 3600)
        row = got.filter("TimestampPK = 1711846800").select(
            "DateUtcFK", "TimeString", "TimeHour", "AmPm", "WeekTimePK"
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (20240331, "01:00:00", 1, "AM", 6 * 86400 + 3600)


def test_windows(spark):
    df = spark.createDataFrame([(0,), (59 * 60 + 59,), (43200 + 20 * 60,)], "TimestampPK bigint")
    got = {r["TimePK"]: r for r in C.add_time_columns(df).collect()}
    late, noon = got[3599], got[44400]
    assert (late["Window5MinuteId"], late["Window5MinuteName"], late["IsWindow5MinuteStart"]) == (12, "55-60", False)
    assert (late["Window60MinuteId"], late["Window60MinuteName"]) == (1, "00-60")
    assert (noon["Window20MinuteId"], noon["Window20MinuteName"], noon["IsWindow20MinuteStart"]) == (2, "20-40", True)
    assert noon["IsWindow30MinuteStart"] is False and noon["AmPm"] == "PM" and noon["TimeSecondId"] == 122000


def test_minutes_of_the_week(spark):
    whole = C.time_dimension(C.date_range(spark, "2024-01-01", "2024-12-31"))
    assert whole.count() == 10080
    late = C.time_dimension(C.date_range(spark, "2024-01-29", "2024-12-31"))
    assert late.count() == 3 * 1440
    monday = whole.filter("WeekTimePK = 0").select(F.col("WeekTime").cast("timestamp_ntz")).first()[0]
    assert monday == dt.datetime(1970, 1, 5)


def test_view_and_window_view(spark):
    dates = C.date_range(spark, "2024-01-01", "2024-01-10")
    dim, mapping, times = C.add_date_columns(dates), C.minute_mapping(dates), C.time_dimension(dates)
    view = C.date_minute_view(dim, mapping, times)
    assert view.count() == 9 * 1440 + 1
    assert C.date_minute_view(dim, mapping, times, 15).count() == 9 * 96 + 1
    assert C.date_minute_view(dim.filter("DatePK = 20240102"), mapping.limit(0), times).count() == 1


PAYLOAD = """[
 {"startDate":"2024-01-01","nationwide":true,"name":[{"language":"EN","text":"New Year"},{"language":"DE","text":"Neujahr"}]},
 {"startDate":"2024-01-02","nationwide":false,"name":[{"language":"DE","text":"Berchtoldstag"}],"subdivisions":[{"code":"CH-ZH"}]},
 {"startDate":"2024-01-06","nationwide":false,"name":[{"language":"DE","text":"Dreikönig"}],"subdivisions":[{"code":"CH-UR"}]},
 {"startDate":"2024-03-19","nationwide":false,"name":[{"language":"EN","text":"Joseph"}],"subdivisions":[{"code":"CH-ZH"}]},
 {"startDate":"2024-05-01","nationwide":false,"name":[{"language":"DE","text":"Tag der Arbeit"}]}]"""


def test_holidays(spark):
    payload = spark.createDataFrame([(PAYLOAD,)], "body string")
    names = [r[2] for r in sorted(C.filter_holidays(payload, "body", "DE", "CH-ZH").collect())]
    assert names == ["Neujahr", "Berchtoldstag", None]
    kept = C.filter_holidays(payload, "body", "DE", "CH-ZH", ["Berchtoldstag", "Neujahr"])
    # The excluded names do not touch nationwide days.
    assert [r[2] for r in sorted(kept.collect())] == ["Neujahr", None]


def test_days_off_and_flags(spark):
    free = spark.createDataFrame(
        [(dt.date(2024, 1, 2), "PublicHoliday", "b"), (dt.date(2023, 12, 31), C.COMPENSATION, "a"), (dt.date(2024, 1, 2), "Other", "c")],
        "date date, type string, name string",
    )
    table = C.days_off(free)
    assert [r[0] for r in rows(table)] == [1, 2, 3] and rows(table)[0][3] == "a"
    marked = C.apply_holidays(C.date_dimension(spark, "2023-12-31", "2024-01-02"), table)
    assert [r[1] for r in rows(marked.select("DatePK", "IsHoliday"))] == [None, None, True]
    assert marked.count() == 3


def test_days_off_ids_go_on_after_a_load(spark):
    rows_of = lambda year: spark.createDataFrame([(f"{year}-01-01", "h", "a"), (f"{year}-08-01", "h", "b")], "date string, type string, name string").withColumn("date", F.col("date").cast("date"))
    first = C.days_off(rows_of(2024))
    both = first.union(C.days_off(rows_of(2025), first))
    assert [r.Id for r in both.orderBy("Date").collect()] == [1, 2, 3, 4]
