"""Calendar, minute-of-week and minute-mapping dimensions, holidays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.times import SECONDS_PER_DAY, day_seconds, epoch_date, window_label
from lakeloom.operators.rows import running_id

# Month names, per month de, de short, fr, fr short, it, it short.
MONTHS = (
    ("Januar", "Jan.", "janvier", "janv.", "gennaio", "gen."),
    ("Februar", "Feb.", "février", "fév.", "febbraio", "feb."),
    ("März", "Mär.", "mars", "mar.", "marzo", "mar."),
    ("April", "Apr.", "avril", "avr.", "aprile", "apr."),
    ("Mai", "Mai.", "mai", "mai.", "maggio", "mag."),
    ("Juni", "Jun.", "juin", "jui.", "giugno", "giu."),
    ("Juli", "Jul.", "juillet", "juil.", "luglio", "lug."),
    ("August", "Aug.", "août", "aoû.", "agosto", "ago."),
    ("September", "Sep.", "septembre", "sept.", "settembre", "set."),
    ("Oktober", "Okt.", "octobre", "oct.", "ottobre", "ott."),
    ("November", "Nov.", "novembre", "nov.", "novembre", "nov."),
    ("Dezember", "Dez.", "décembre", "déc.", "dicembre", "dic."),
)
# Day names from Monday, in the same order of languages.
DAYS = (
    ("Montag", "Mo.", "lundi", "lun.", "lunedì", "lun."),
    ("Dienstag", "Di.", "mardi", "mar.", "martedì", "mar."),
    ("Mittwoch", "Mi.", "mercredi", "mer.", "mercoledì", "mer."),
    ("Donnerstag", "Do.", "jeudi", "jeu.", "giovedì", "gio."),
    ("Freitag", "Fr.", "vendredi", "ven.", "venerdì", "ven."),
    ("Samstag", "Sa.", "samedi", "sam.", "sabato", "sab."),
    ("Sonntag", "So.", "dimanche", "dim.", "domenica", "dom."),
)
LANGUAGES = ("De", "ShortDe", "Fr", "ShortFr", "It", "ShortIt")
# Window sizes in minutes, anchor Monday of the week time, the type that is no holiday.
WINDOWS = (5, 10, 15, 20, 30, 60)
WEEK_ANCHOR = 4 * SECONDS_PER_DAY
COMPENSATION = "Kompensation"

TIME_COLUMNS = [
    "TimePK", "Time", "TimeString", "TimeHour", "TimeMinute", "TimeSecond", "AmPm",
    "TimeSecondId", "TimeMinuteId",
] + [f.format(w) for w in WINDOWS for f in ("IsWindow{}MinuteStart", "Window{}MinuteId", "Window{}MinuteName")]
WEEK_COLUMNS = ["WeekTimePK", "WeekTime", "WeekTimeDuration", "DayTimeDuration"]


def _names(table: Sequence[Sequence[str]], number: Column, prefix: str) -> list[Column]:
    """One column per language, looked up by the 1-based month or weekday number."""
    return [
        F.element_at(F.array(*[F.lit(row[i]) for row in table]), number).alias(f"{prefix}{language}")
        for i, language in enumerate(LANGUAGES)
    ]


def add_date_columns(df: DataFrame, date: str = "Date") -> DataFrame:
    """48 calendar columns next to a date column.

    ``WeekIdIso`` and ``YearWeekOfYearIso`` pair the ISO week with the calendar year.
    """
    d = F.col(date)
    year, month, day, quarter = F.year(d), F.month(d), F.dayofmonth(d), F.quarter(d)
    week = F.weekofyear(d)
    us, iso = F.dayofweek(d), F.weekday(d) + 1
    half = F.when(month <= 6, 1).otherwise(2)
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return df.select(
        "*",
        (year * 10000 + month * 100 + day).alias("DatePK"),
        F.date_format(d, "dd.MM.yyyy").alias("DateString"),
        year.alias("Year"),
        (((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)).alias("IsLeapYear"),
        half.alias("HalfYearId"),
        (year * 10 + half).alias("YearHalfYearId"),
        text("H", half.cast("string")).alias("HalfYearName"),
        text(year.cast("string"), "-H", half.cast("string")).alias("YearHalfYear"),
        quarter.alias("Quarter"),
        (year * 10 + quarter).alias("YearQuarterId"),
        text(year.cast("string"), "-Q", quarter.cast("string")).alias("YearQuarter"),
        text("Q", quarter.cast("string")).alias("QuarterShortname"),
        (year * 100 + month).alias("YearMonthId"),
        month.alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.date_format(d, "MMM").alias("MonthNameShort"),
        *_names(MONTHS, month, "MonthName"),
        (year * 100 + week).alias("WeekIdIso"),
        week.alias("WeekOfYearIso"),
        text("W", week.cast("string")).alias("WeekOfYearIsoName"),
        text(year.cast("string"), "-W", week.cast("string")).alias("YearWeekOfYearIso"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.date_format(d, "EEE").alias("DayNameShort"),
        *_names(DAYS, iso, "DayName"),
        F.dayofyear(d).alias("DayOfYear"),
        day.alias("Day"),
        us.alias("DayOfWeekUs"),
        iso.alias("DayOfWeekIso"),
        (iso < 6).alias("IsWeekDay"),
        (d == F.last_day(d)).alias("IsLastDayOfMonth"),
        F.last_day(d).alias("LastDayOfMonth"),
        F.make_date(F.lit(1972), month, day).alias("MonthDay"),
        F.date_sub(d, us - 1).alias("StartOfWeekUs"),
        F.date_sub(d, iso - 1).alias("StartOfWeekIso"),
        F.date_add(d, F.lit(7) - us).alias("EndOfWeekUs"),
        F.date_add(d, F.lit(7) - iso).alias("EndOfWeekIso"),
        F.lit(None).cast("boolean").alias("IsCompensation"),
        F.lit(None).cast("boolean").alias("IsHoliday"),
    )


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
        ).alias("Date")
    )


def dates_between(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the earliest to the latest date of a column."""
    day = F.to_date(F.col(column))
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("Date")
    )


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The calendar table: ``Date`` and 48 derived columns."""
    return add_date_columns(date_range(spark, start, end))


def add_time_columns(df: DataFrame, key: str = "TimestampPK") -> DataFrame:
    """Time of day from epoch seconds, with ids and the window columns for each window size.

    Plain arithmetic on the seconds: the result is UTC whatever the session zone is.
    """
    second_of_day = day_seconds(F.col(key))
    timed = df.select(
        "*",
        F.timestamp_seconds(key).alias("TimestampStartUtc"),
        second_of_day.alias("TimePK"),
    ).select(
        "*",
        F.timestamp_seconds("TimePK").alias("Time"),
        F.floor(F.col("TimePK") / 3600).cast("int").alias("TimeHour"),
        F.floor(F.col("TimePK") % 3600 / 60).cast("int").alias("TimeMinute"),
        (F.col("TimePK") % 60).cast("int").alias("TimeSecond"),
    )
    hour, minute, second = F.col("TimeHour"), F.col("TimeMinute"), F.col("TimeSecond")
    extra = [
        F.format_string("%02d:%02d:%02d", hour, minute, second).alias("TimeString"),
        F.when(hour < 12, "AM").otherwise("PM").alias("AmPm"),
        (hour * 10000 + minute * 100 + second).alias("TimeSecondId"),
        (hour * 100 + minute).alias("TimeMinuteId"),
    ]
    for size in WINDOWS:
        extra += [
            ((minute % size == 0) & (second == 0)).alias(f"IsWindow{size}MinuteStart"),
            (F.floor(minute / size) + 1).cast("int").alias(f"Window{size}MinuteId"),
            window_label(minute, size).alias(f"Window{size}MinuteName"),
        ]
    return timed.select("*", *extra)


def _days(dates: DataFrame, step: int) -> DataFrame:
    """One row per day of the range with its first and last instant in epoch seconds.

    The grid of instants starts at the first midnight and runs on over all midnights; it ends at the
    last midnight.
    """
    seconds = F.unix_date(F.col("Date")).cast("bigint") * SECONDS_PER_DAY
    ends = dates.agg(F.min(seconds).alias("_first"), F.max(seconds).alias("_last"))
    days = F.sequence("_first", "_last", F.lit(SECONDS_PER_DAY).cast("bigint"))
    day = F.col("_day")
    return (
        ends.select("_first", "_last", F.explode(days).alias("_day"))
        .select(
            epoch_date(day).alias("Date"),
            (day + F.pmod(F.col("_first") - day, F.lit(step).cast("bigint"))).alias("_start"),
            F.least(day + F.lit(SECONDS_PER_DAY - 1).cast("bigint"), F.col("_last")).alias("_stop"),
        )
        .filter(F.col("_start") <= F.col("_stop"))
    )


def _spread(days: DataFrame, step: int) -> DataFrame:
    """The instants of each day, made where the day is: days are spread over the cluster first."""
    tasks = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    instants_of_day = F.sequence("_start", "_stop", F.lit(step).cast("bigint"))
    return (
        days.repartition(tasks, "Date")
        .select("*", F.explode(instants_of_day).alias("TimestampPK"))
        .drop("_start", "_stop")
    )


def instants(dates: DataFrame, step: int = 60) -> DataFrame:
    """``TimestampPK`` every ``step`` seconds from the first to the last midnight, both included.

    So the last day has one row.
    """
    return _spread(_days(dates, step), step).select("TimestampPK")


def expand_to_datetime(dates: DataFrame, step: int = 60) -> DataFrame:
    """All instants with their time, date and week-time columns.

    Date columns are computed once per day, before the day is expanded to its instants.
    """
    dated = _spread(add_date_columns(_days(dates, step)), step)
    timed = add_time_columns(dated).withColumnRenamed("DatePK", "DateUtcFK")
    week_time = (F.col("DayOfWeekIso") - 1) * SECONDS_PER_DAY + F.col("TimePK")
    return timed.withColumn("WeekTimePK", week_time).select(
        "*",
        F.timestamp_seconds(F.col("WeekTimePK") + WEEK_ANCHOR).alias("WeekTime"),
        (F.col("WeekTimePK") / F.lit(86400.0)).alias("WeekTimeDuration"),
        (F.col("TimePK") / F.lit(86400.0)).alias("DayTimeDuration"),
    )


def minute_mapping(dates: DataFrame, step: int = 60) -> DataFrame:
    """Which week time each minute of the range has."""
    return expand_to_datetime(dates, step).select("DateUtcFK", "TimestampStartUtc", "WeekTimePK")


def time_dimension(dates: DataFrame, step: int = 60) -> DataFrame:
    """Distinct minutes of the week met in the first month of the range.

    Instants after that month are not generated. A range starting late in a month gives fewer rows.
    """
    ends = dates.agg(F.min("Date").alias("first"), F.max("Date").alias("last"))
    # Two dates bound the instants: the first one, and the first of the next month or the last one.
    month = ends.select(
        F.explode(F.array("first", F.least(F.date_add(F.last_day("first"), 1), F.col("last")))).alias("Date")
    )
    first_month = ends.select(F.trunc("first", "month")).scalar()
    return (
        expand_to_datetime(month, step)
        .filter(F.trunc("Date", "month") == first_month)
        .select(*WEEK_COLUMNS, *TIME_COLUMNS)
        .dropDuplicates(["WeekTimePK"])
    )


def date_minute_view(
    dates: DataFrame, mapping: DataFrame, times: DataFrame, window: int | None = None
) -> DataFrame:
    """Dates with all their minutes; ``window`` keeps the starts of windows of that many minutes.

    Whether the minute-of-week table is broadcast is left to its size.
    """
    if window is not None:
        times = times.filter(F.col(f"IsWindow{window}MinuteStart"))
        # Only the starts go on to meet the columns of their dates.
        mapping = mapping.join(times.select("WeekTimePK"), "WeekTimePK", "left_semi").select(*mapping.columns)
    view = dates.join(mapping, dates["DatePK"] == mapping["DateUtcFK"], "left").join(
        times.select(*WEEK_COLUMNS, *TIME_COLUMNS),
        "WeekTimePK",
        "left" if window is None else "inner",
    )
    return view.select(*dates.columns, *WEEK_COLUMNS, *TIME_COLUMNS)


HOLIDAY_PAYLOAD = (
    "array<struct<startDate:string,nationwide:boolean,"
    "name:array<struct<language:string,text:string>>,subdivisions:array<struct<code:string>>>>"
)


def filter_holidays(
    payload: DataFrame, column: str, language: str, subdivision: str, excluded: Sequence[str] = ()
) -> DataFrame:
    """Holidays from JSON answers: nationwide ones, and those of one subdivision not excluded by name."""
    day = payload.select(
        F.explode(F.from_json(F.col(column), HOLIDAY_PAYLOAD)).alias("h")
    ).select(
        F.col("h.startDate").cast("date").alias("date"),
        F.lit("PublicHoliday").alias("type"),
        F.get(F.filter("h.name", lambda n: n["language"] == language), F.lit(0))["text"].alias("name"),
        F.col("h.nationwide").alias("_everywhere"),
        F.coalesce(
            F.exists("h.subdivisions", lambda s: s["code"] == subdivision), F.lit(False)
        ).alias("_here"),
    )
    wanted = F.lit(True)
    if excluded:
        wanted = F.coalesce(~F.col("name").isin(*excluded), F.lit(True))
    return day.filter(F.col("_everywhere") | (F.col("_here") & wanted)).drop("_everywhere", "_here")


def days_off(holidays: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The days-off table with a running id by date, type and comment.

    With the ``stored`` table of earlier loads the ids go on after its largest one; its rows are not repeated here.
    """
    rows = holidays.select(
        F.col("date").alias("Date"), F.col("type").alias("Type"), F.col("name").alias("Comment")
    )
    last = None if stored is None else stored.agg(F.max("Id")).first()[0]
    return running_id(rows, "Date", ["Type", "Comment"], "Id", 1 + (last or 0)).select(
        "Id", "Date", "Type", "Comment"
    )


def apply_holidays(dimension: DataFrame, free: DataFrame) -> DataFrame:
    """``IsHoliday`` true on days off that are no compensation, NULL on all others."""
    holidays = free.filter(F.col("Type") != COMPENSATION).select(F.col("Date").alias("_day")).distinct()
    marked = dimension.join(holidays, F.col("Date") == F.col("_day"), "left")
    flag = F.when(F.col("_day").isNotNull(), True)
    return marked.withColumn("IsHoliday", flag).select(*dimension.columns)
