"""Queries on calendar dimensions, over the date ranges of the test tables."""

from pyspark.sql import functions as F

from lakeloom.operators import calendar as C
from lakeloom.queries.base import query


def _sql_names(table, number, prefix):
    return ", ".join(
        f"CASE {number} "
        + " ".join(f"WHEN {i + 1} THEN '{row[k]}'" for i, row in enumerate(table))
        + f' END AS "{prefix}{language}"'
        for k, language in enumerate(C.LANGUAGES)
    )


def _sql_dates(d):
    """The calendar columns in SQL."""
    year, month, week = f"CAST(year({d}) AS INT)", f"CAST(month({d}) AS INT)", f"CAST(week({d}) AS INT)"
    us, iso = f"CAST(dayofweek({d})+1 AS INT)", f"CAST(isodow({d}) AS INT)"
    half, quarter = f"CASE WHEN month({d})<=6 THEN 1 ELSE 2 END", f"CAST(quarter({d}) AS INT)"
    day = f"CAST(day({d}) AS INT)"
    return f"""{year}*10000+{month}*100+{day} AS "DatePK", strftime({d}, '%d.%m.%Y') AS "DateString", {year} AS "Year",
    (({year}%4=0 AND {year}%100<>0) OR {year}%400=0) AS "IsLeapYear", {half} AS "HalfYearId", {year}*10+({half}) AS "YearHalfYearId",
    'H' || ({half}) AS "HalfYearName", {year} || '-H' || ({half}) AS "YearHalfYear", {quarter} AS "Quarter", {year}*10+{quarter} AS "YearQuarterId",
    {year} || '-Q' || {quarter} AS "YearQuarter", 'Q' || {quarter} AS "QuarterShortname", {year}*100+{month} AS "YearMonthId", {month} AS "Month",
    strftime({d}, '%B') AS "MonthName", strftime({d}, '%b') AS "MonthNameShort", {_sql_names(C.MONTHS, month, "MonthName")},
    {year}*100+{week} AS "WeekIdIso", {week} AS "WeekOfYearIso", 'W' || {week} AS "WeekOfYearIsoName", {year} || '-W' || {week} AS "YearWeekOfYearIso",
    strftime({d}, '%A') AS "DayName", strftime({d}, '%a') AS "DayNameShort", {_sql_names(C.DAYS, iso, "DayName")},
    CAST(dayofyear({d}) AS INT) AS "DayOfYear", {day} AS "Day", {us} AS "DayOfWeekUs", {iso} AS "DayOfWeekIso", {iso}<6 AS "IsWeekDay",
    {d}=last_day({d}) AS "IsLastDayOfMonth", last_day({d}) AS "LastDayOfMonth", make_date(1972, {month}, {day}) AS "MonthDay",
    {d}-({us}-1) AS "StartOfWeekUs", {d}-({iso}-1) AS "StartOfWeekIso", {d}+(7-{us}) AS "EndOfWeekUs", {d}+(7-{iso}) AS "EndOfWeekIso",
    CAST(NULL AS BOOLEAN) AS "IsCompensation", CAST(NULL AS BOOLEAN) AS "IsHoliday" """


def _sql_times(pk):
    """The time-of-day columns in SQL from second-of-day ``pk``."""
    h, m, s = f"CAST({pk}//3600 AS INT)", f"CAST({pk}%3600//60 AS INT)", f"CAST({pk}%60 AS INT)"
    pad = lambda x: f"lpad(CAST({x} AS STRING), 2, '0')"
    windows = ", ".join(
        f"""({m}%{w}=0 AND {s}=0) AS "IsWindow{w}MinuteStart", {m}//{w}+1 AS "Window{w}MinuteId",
        {pad(f"{m}//{w}*{w}")} || '-' || {pad(f"{m}//{w}*{w}+{w}")} AS "Window{w}MinuteName" """
        for w in C.WINDOWS
    )
    return f"""{pk} AS "TimePK", make_timestamp({pk}*1000000) AS "Time", {pad(h)} || ':' || {pad(m)} || ':' || {pad(s)} AS "TimeString",
    {h} AS "TimeHour", {m} AS "TimeMinute", {s} AS "TimeSecond", CASE WHEN {h}<12 THEN 'AM' ELSE 'PM' END AS "AmPm",
    {h}*10000+{m}*100+{s} AS "TimeSecondId", {h}*100+{m} AS "TimeMinuteId", {windows}"""


_ORDER_DATES = """bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM {orders}),
dates AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)"""
_DIMENSION = f'dim AS (SELECT d AS "Date", {_sql_dates("d")} FROM dates)'
_EVENT_MINUTES = """bounds AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM {events}),
dates AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
minutes AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MINUTE)) AS ts FROM bounds),
grid AS (SELECT ts, CAST(ts AS DATE) AS d, CAST(epoch(ts) AS BIGINT) % 86400 AS pk FROM minutes),
weekly AS (SELECT *, CAST((isodow(ts)-1)*86400 + pk AS BIGINT) AS wk FROM grid)"""
_FACTS = "facts AS (SELECT date_trunc('minute', ts) AS f, count(*) AS events FROM {events} GROUP BY 1)"


def _with_events(rows, t, column):
    """Rows with the number of events in the minute of a column."""
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp")).alias(column)
    facts = t.events.groupBy(minute).agg(F.count(F.lit(1)).alias("events"))
    return rows.join(facts, column, "left").withColumn("events", F.coalesce("events", F.lit(0)))


@query(
    "b1_date_dimension",
    f"""WITH {_ORDER_DATES}, {_DIMENSION},
facts AS (SELECT CAST(o_orderdate AS DATE) AS f, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM {{orders}} GROUP BY 1)
SELECT dim.*, coalesce(orders, 0) AS orders, revenue FROM dim LEFT JOIN facts ON "Date" = f""",
)
def _(t):
    """The calendar over the order dates, with the orders of each day."""
    dimension = C.add_date_columns(C.dates_between(t.orders, "o_orderdate"))
    facts = t.orders.groupBy(F.to_date("o_orderdate").alias("Date")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )
    return dimension.join(facts, "Date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(
    "b2_time_columns",
    f"""WITH base AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS "TimestampPK" FROM {{events}})
SELECT *, make_timestamp("TimestampPK"*1000000) AS "TimestampStartUtc", {_sql_times('("TimestampPK"%86400)')} FROM base""",
)
def _(t):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")).alias("TimestampPK")
    return C.add_time_columns(t.events.select("event_id", seconds))


@query(
    "b3_expand_to_datetime",
    f"""WITH {_EVENT_MINUTES}, {_FACTS}
SELECT CAST(epoch(ts) AS BIGINT) AS "TimestampPK", ts AS "TimestampStartUtc", {_sql_times("pk")}, d AS "Date",
  {_sql_dates("d").replace('"DatePK"', '"DateUtcFK"')}, wk AS "WeekTimePK", make_timestamp((wk+345600)*1000000) AS "WeekTime",
  wk/86400.0 AS "WeekTimeDuration", pk/86400.0 AS "DayTimeDuration", coalesce(events, 0) AS events FROM weekly LEFT JOIN facts ON ts = f""",
)
def _(t):
    """All minutes of the days of the events, with the events of each."""
    return _with_events(C.expand_to_datetime(C.dates_between(t.events, "ts"), 60), t, "TimestampStartUtc")


@query(
    "b4_time_dimension",
    f"""WITH {_EVENT_MINUTES}, {_FACTS},
week_facts AS (SELECT CAST((isodow(f)-1)*86400 + epoch(date_trunc('minute', f)) % 86400 AS BIGINT) AS fw, CAST(sum(events) AS BIGINT) AS events FROM facts GROUP BY 1),
times AS (SELECT DISTINCT wk AS "WeekTimePK", make_timestamp((wk+345600)*1000000) AS "WeekTime", wk/86400.0 AS "WeekTimeDuration",
  pk/86400.0 AS "DayTimeDuration", {_sql_times("pk")} FROM weekly, bounds WHERE date_trunc('month', d) = date_trunc('month', lo))
SELECT times.*, coalesce(events, 0) AS events FROM times LEFT JOIN week_facts ON fw = "WeekTimePK" """,
)
def _(t):
    """The minutes of the week, with the events of all weeks in each."""
    seconds = F.unix_timestamp(F.date_trunc("minute", F.col("ts").cast("timestamp")))
    week_time = F.weekday("ts").cast("bigint") * 86400 + seconds % 86400
    facts = t.events.groupBy(week_time.alias("WeekTimePK")).agg(F.count(F.lit(1)).alias("events"))
    times = C.time_dimension(C.dates_between(t.events, "ts"))
    return times.join(facts, "WeekTimePK", "left").withColumn("events", F.coalesce("events", F.lit(0)))


@query(
    "b5_minute_mapping",
    f"""WITH {_EVENT_MINUTES}, {_FACTS}
SELECT CAST(strftime(ts, '%Y%m%d') AS INT) AS "DateUtcFK", ts AS "TimestampStartUtc", wk AS "WeekTimePK", coalesce(events, 0) AS events
FROM weekly LEFT JOIN facts ON ts = f""",
)
def _(t):
    """The mapping over the days of the events, with the events of each minute."""
    return _with_events(C.minute_mapping(C.dates_between(t.events, "ts")), t, "TimestampStartUtc")


def _view(t, window=1):
    """The view with the events of each window."""
    dates = C.dates_between(t.events, "ts")
    view = C.date_minute_view(
        C.add_date_columns(dates),
        C.minute_mapping(dates, 60 * window),
        C.time_dimension(dates, 60 * window),
        None if window == 1 else window,
    )
    minute = F.minute("ts")
    facts = t.events.groupBy(
        F.to_date("ts").alias("Date"), (F.hour("ts") * 100 + minute - minute % window).alias("TimeMinuteId")
    ).agg(F.count(F.lit(1)).alias("events"))
    return view.join(facts, ["Date", "TimeMinuteId"], "left").withColumn(
        "events", F.coalesce("events", F.lit(0))
    )


_VIEW_SQL = f"""WITH {_EVENT_MINUTES}, {_DIMENSION},
times AS (SELECT DISTINCT wk AS "WeekTimePK", make_timestamp((wk+345600)*1000000) AS "WeekTime", wk/86400.0 AS "WeekTimeDuration",
  pk/86400.0 AS "DayTimeDuration", {_sql_times("pk")} FROM weekly)
SELECT dim.*, times.*, coalesce(events, 0) AS events FROM dim JOIN weekly ON d = "Date" JOIN times ON wk = times."WeekTimePK"
LEFT JOIN (SELECT CAST(ts AS DATE) AS fd, hour(ts)*100 + minute(ts) - minute(ts)%SIZE AS fm, count(*) AS events FROM {{events}} GROUP BY 1, 2) facts
  ON fd = "Date" AND fm = "TimeMinuteId" """.replace("{{", "{").replace("}}", "}")


@query("b6_date_minute_view", _VIEW_SQL.replace("SIZE", "1"))
def _(t):
    return _view(t)


for _size in C.WINDOWS:
    query(f"b6_date_{_size}_minute_view", _VIEW_SQL.replace("SIZE", str(_size)) + f'WHERE "IsWindow{_size}MinuteStart"')(
        lambda t, size=_size: _view(t, size)
    )

# Holiday answers made of the orders: one document per order with one or two days.
_HOLIDAY_JSON = """SELECT o_orderkey, concat('[{\"startDate\":\"', CAST(CAST(o_orderdate AS DATE) AS STRING), '\",\"nationwide\":',
  CASE WHEN o_custkey%3=0 THEN 'true' ELSE 'false' END, ',\"name\":[{\"language\":\"EN\",\"text\":\"day', CAST(o_custkey%7 AS STRING),
  '\"},{\"language\":\"DE\",\"text\":\"Tag', CAST(o_custkey%7 AS STRING), '\"}]',
  CASE WHEN o_custkey%5=0 THEN '' ELSE concat(',\"subdivisions\":[{\"code\":\"CH-', CASE WHEN o_custkey%2=0 THEN 'ZH' ELSE 'BE' END, '\"}]') END,
  '}]') AS body FROM {orders}"""
_HOLIDAYS = """holidays AS (SELECT CAST(o_orderdate AS DATE) AS date, 'PublicHoliday' AS type, concat('Tag', CAST(o_custkey%7 AS STRING)) AS name
  FROM {orders} WHERE o_custkey%3=0 OR (o_custkey%5<>0 AND o_custkey%2=0 AND o_custkey%7 NOT IN (2, 4)))"""


def _holidays(t):
    return C.filter_holidays(t.sql(_HOLIDAY_JSON), "body", "DE", "CH-ZH", ["Tag2", "Tag4"])


@query("b7_filter_holidays", f"WITH {_HOLIDAYS} SELECT * FROM holidays")
def _(t):
    return _holidays(t)


@query(
    "b8_days_off",
    f"""WITH {_HOLIDAYS} SELECT row_number() OVER (ORDER BY date, type, name) AS "Id", date AS "Date", type AS "Type", name AS "Comment"
    FROM (SELECT DISTINCT * FROM holidays) x""",
)
def _(t):
    return C.days_off(_holidays(t).distinct())


@query(
    "b9_apply_holidays",
    f"""WITH {_ORDER_DATES}, {_DIMENSION}, {_HOLIDAYS}
SELECT * REPLACE (CASE WHEN "Date" IN (SELECT date FROM holidays WHERE name <> 'Tag1') THEN true END AS "IsHoliday") FROM dim""",
)
def _(t):
    dimension = C.add_date_columns(C.dates_between(t.orders, "o_orderdate"))
    free = _holidays(t).withColumn(
        "type", F.when(F.col("name") == "Tag1", C.COMPENSATION).otherwise(F.col("type"))
    )
    return C.apply_holidays(dimension, C.days_off(free.distinct()))
