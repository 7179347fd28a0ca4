"""Queries on enrichment, flattening, medallion layers and operational logs."""

from pyspark.sql import functions as F

from lakeloom.functions.nested import flatten
from lakeloom.plans import ingest, medallion, oplog
from lakeloom.queries.base import query

_LOAD = {
    "load_id": "load-1",
    "load_time": "2024-02-01T00:00:00+00:00",
    "source_system": "sensors",
    "pipeline": "ingest",
    "run_as": "loader",
}


@query(
    "g1_enrich",
    """SELECT event_id, 'events.parquet' AS meta_file_name, true AS has_file, '2024-02-01T00:00:00+00:00' AS load_timestamp, 'load-1' AS load_id,
      'sensors' AS source_system, 'ingest' AS pipeline_name, 'loader' AS run_as, props AS body_string,
      sha256(props || '||' || props) AS hash_key FROM {events}""",
)
def _(t):
    raw = t.events.withColumn("Body", F.col("props").cast("binary"))
    found = F.col("meta_file_path").endswith("events.parquet") & (F.col("meta_file_size") > 0)
    return ingest.enrich(raw, "Body", **_LOAD).select(
        "event_id",
        "meta_file_name",
        (found & F.col("meta_file_modification_time").isNotNull()).alias("has_file"),
        "load_timestamp",
        "load_id",
        "source_system",
        "pipeline_name",
        "run_as",
        "body_string",
        "hash_key",
    )


@query(
    "g2_decode_body",
    """SELECT event_id, CAST(user_id AS INT) AS deviceid, value AS temp, date_trunc('second', ts) AS "timestamp", event_type AS sender FROM {events}""",
)
def _(t):
    body = F.to_json(
        F.struct(
            F.col("user_id").alias("deviceid"),
            F.col("value").alias("temp"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            F.col("event_type").alias("sender"),
        )
    )
    raw = t.events.select("event_id", body.alias("body_string"))
    return ingest.decode_body(raw, "body_string", "deviceid INT, temp DOUBLE, timestamp TIMESTAMP, sender STRING")


def _documents_by_line(t):
    """Each document as a record with the list of its lines."""
    lines = F.transform(
        F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("size"))
    )
    return t.documents.select(
        "doc_id", lines.alias("lines"), F.struct("lang", F.struct("source").alias("origin")).alias("about")
    )


@query(
    "g3_flatten",
    """SELECT doc_id, line, CAST(length(line) AS INT) AS size, lang AS about_lang, source AS about_origin_source
       FROM (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line FROM {documents}) x""",
)
def _(t):
    return flatten(_documents_by_line(t))


@query(
    "g4_first_of_list",
    """SELECT doc_id, string_split(text, chr(10))[1] AS lines_line, CAST(length(string_split(text, chr(10))[1]) AS INT) AS lines_size FROM {documents}""",
)
def _(t):
    return ingest.first_of_list(_documents_by_line(t).drop("about"), "lines", ("line", "size"))


# Market rows: one per event.
_MARKETS = """SELECT event_type AS id, substr(event_type, 1, 3) AS symbol, concat('u', CAST(user_id AS STRING)) AS name, value AS current_price,
  CAST(floor(value * 1000) AS BIGINT) AS market_cap, user_id % 50 AS market_cap_rank, CAST(floor(value * 1100) AS BIGINT) AS fully_diluted_valuation,
  CAST(floor(value * 10) AS BIGINT) AS total_volume, value + 2 AS high_24h, value - 2 AS low_24h, value / 4 AS price_change_24h, value / 8 AS price_change_percentage_24h,
  CAST(floor(value) AS BIGINT) AS market_cap_change_24h, value / 16 AS market_cap_change_percentage_24h, value * 3 AS circulating_supply, value * 4 AS total_supply,
  CASE WHEN user_id % 3 = 0 THEN value * 5 END AS max_supply, value * 2 AS ath, value / 2 AS ath_change_percentage, value / 32 AS atl, value / 64 AS atl_change_percentage,
  CASE WHEN user_id % 4 = 0 THEN CAST(NULL AS STRING) ELSE concat('{\"times\":', CAST(user_id AS STRING), '.5,\"currency\":\"usd\",\"percentage\":', CAST(user_id % 7 AS STRING), '}') END AS roi,
  event_id, ts FROM {events}"""
_ROI_COLUMNS = """CASE WHEN user_id % 4 <> 0 THEN {times} END AS roi_times, CASE WHEN user_id % 4 <> 0 THEN 'usd' END AS roi_currency,
  CASE WHEN user_id % 4 <> 0 THEN {percent} END AS roi_percentage"""


_USER = "CAST(substr(name, 2) AS BIGINT)"


@query(
    "h1_markets_silver",
    "SELECT * EXCLUDE (roi), "
    + _ROI_COLUMNS.format(times=f"CAST({_USER} AS STRING) || '.5'", percent=f"CAST({_USER} % 7 AS STRING)").replace("user_id", _USER)
    + f""", CAST(CAST(ts AS DATE) AS TIMESTAMP) AS load_timestamp, CAST(ts AS DATE) AS date, true AS has_file FROM ({_MARKETS}) m""",
)
def _(t):
    """Market rows are written to one folder per load; the load time comes back out of the path."""
    folder = t.scratch("markets")
    stamp = F.date_format(F.to_date("ts"), "yyyyMMdd'T'HHmmss'Z'")
    t.sql(_MARKETS).withColumn("load", stamp).write.partitionBy("load").parquet(folder)
    bronze = t.spark.read.parquet(folder).select("*", "_metadata")
    silver = medallion.markets_silver(bronze)
    has_file = F.col("file_name").endswith(".parquet") & F.col("file_path").endswith(F.col("file_name")) & F.col("file_modification_time").isNotNull()
    return silver.withColumn("has_file", has_file).drop("load", "file_name", "file_path", "file_modification_time")


@query(
    "h2_markets_silver_typed",
    "SELECT * EXCLUDE (roi), "
    + _ROI_COLUMNS.format(times=f"CAST({_USER} + 0.5 AS DOUBLE)", percent=f"CAST({_USER} % 7 AS DOUBLE)").replace("user_id", _USER)
    + f" FROM ({_MARKETS}) m",
)
def _(t):
    return medallion.markets_silver_typed(t.sql(_MARKETS))


def _coins(t):
    """Coin details as nested answers, all coins in one frame."""
    pair = lambda usd, chf: F.struct(F.expr(usd).alias("usd"), F.expr(chf).alias("chf"))
    return t.events.select(
        F.col("event_type").alias("id"),
        F.substring("event_type", 1, 3).alias("symbol"),
        F.upper("event_type").alias("name"),
        F.struct(
            pair("value", "value * 2").alias("current_price"),
            pair("value * 3", "value * 4").alias("ath"),
            pair("value / 2", "value / 4").alias("atl"),
            F.expr("value / 8").alias("price_change_24h"),
            pair("value / 16", "value / 32").alias("price_change_24h_in_currency"),
            F.expr("value / 64").alias("price_change_percentage_24h"),
            pair("value * 5", "value * 6").alias("market_cap"),
            pair("value * 7", "value * 8").alias("total_volume"),
        ).alias("market_data"),
    )


_COINS_SQL = """SELECT {distinct} event_type AS id, substr(event_type, 1, 3) AS symbol, upper(event_type) AS name, value*3 AS ath_usd, value*4 AS ath_chf,
  value/2 AS atl_usd, value/4 AS atl_chf, value AS current_price_usd, value*2 AS current_price_chf, value*5 AS market_cap_usd, value*6 AS market_cap_chf,
  value*7 AS total_volume_usd, value*8 AS total_volume_chf, value/8 AS price_change_24h, value/16 AS price_change_24h_usd, value/32 AS price_change_24h_chf,
  value/64 AS price_change_percentage_24h FROM {{events}}"""


@query("h3_coins_silver", _COINS_SQL.format(distinct="").replace("{{", "{").replace("}}", "}"))
def _(t):
    return medallion.coins_silver(_coins(t))


@query("h3_coins_gold", _COINS_SQL.format(distinct="DISTINCT").replace("{{", "{").replace("}}", "}"))
def _(t):
    return medallion.coins_gold([medallion.coins_silver(_coins(t))])


def _gold_columns(wrap):
    names = []
    for kind, column in medallion.MARKET_MEASURES:
        name = column if column == "total_volume" else f"{kind}_{column}"
        names.append((kind, column, name))
    return ", ".join(wrap(*n) for n in names)


def _gold_sql(source):
    columns = _gold_columns(
        lambda kind, column, name: f"round(avg({column}), 5) AS {name}"
        if kind == "avg"
        else f"CAST(sum({column}) AS BIGINT) AS {name}"
    )
    return f"WITH m AS ({source}) SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(ts AS DATE) AS date, {columns} FROM m GROUP BY ALL"


def _gold(rows):
    silver = rows.withColumns({"year": F.year("ts"), "month": F.month("ts"), "date": F.to_date("ts")})
    gold = medallion.markets_gold(silver)
    return gold.select(*[F.round(c, 5).alias(c) if c.startswith("avg_") else F.col(c) for c in gold.columns])


@query("h4_markets_gold", _gold_sql(_MARKETS))
def _(t):
    return _gold(t.sql(_MARKETS))


# The order lines as market rows: every measure is a whole number of its own, so that both engines average the same sums.
_LINES = "SELECT l_shipdate AS ts, {} FROM {{lineitem}}".format(
    ", ".join(
        f"CAST(l_partkey AS BIGINT) * {64 * (i + 2)} AS {column}" if kind == "avg" else f"CAST(l_quantity AS BIGINT) * {i + 2} AS {column}"
        for i, (kind, column) in enumerate(medallion.MARKET_MEASURES)
    )
)


@query("a6_eighteen_measures", _gold_sql(_LINES))
def _(t):
    return _gold(t.sql(_LINES))


def _weather(t):
    """Weather answers: one per event, the user is the city."""
    e = F.expr
    return t.events.select(
        e("named_struct('lon', value / 8, 'lat', value / 16)").alias("coord"),
        e("array(named_struct('id', CAST(user_id AS INT), 'main', event_type, 'description', upper(event_type), 'icon', substr(event_type, 1, 2)))").alias("weather"),
        F.lit("stations").alias("base"),
        e(
            """named_struct('temp', value, 'feels_like', value - 1, 'temp_min', value - 2, 'temp_max', value + 2, 'pressure', CAST(user_id % 50 AS INT),
            'humidity', CAST(user_id % 60 AS INT), 'sea_level', 1, 'grnd_level', 2)"""
        ).alias("main"),
        e("CAST(user_id % 70 AS INT)").alias("visibility"),
        e("named_struct('speed', value / 4, 'deg', CAST(user_id % 360 AS INT))").alias("wind"),
        e("named_struct('all', CAST(user_id % 100 AS INT))").alias("clouds"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("dt"),
        e(
            "named_struct('type', 1, 'id', CAST(user_id % 9 AS INT), 'country', 'CH', 'sunrise', 21600 + user_id, 'sunset', 64800 + user_id)"
        ).alias("sys"),
        F.lit(3600).alias("timezone"),
        F.col("event_id").alias("id"),
        e("concat('city', CAST(user_id AS STRING))").alias("name"),
        F.lit(200).alias("cod"),
        F.lit("load-1").alias("LoadID"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("LoadTimeStamp"),
    )


_WEATHER_SQL = """weather AS (SELECT 'stations' AS "Base", CAST(user_id%100 AS INT) AS "Clouds_All", 200 AS "Cod", value/8 AS "Coord_Lon", value/16 AS "Coord_Lat",
  date_trunc('second', ts) AS "Weather_TimeStamp", event_id AS "ID", value-1 AS "Main_Feels_Like", value-2 AS "Main_Temp_Min", CAST(user_id%50 AS INT) AS "Main_Pressure",
  CAST(user_id%60 AS INT) AS "Main_Humidity", value AS "Main_Temp", value+2 AS "Main_Temp_Max", 'city' || user_id AS "City", 'CH' AS "Sys_Country", CAST(user_id%9 AS INT) AS "Sys_ID",
  make_timestamp((21600+user_id)*1000000) AS "Sys_Sunrise", make_timestamp((64800+user_id)*1000000) AS "Sys_Sunset", 1 AS "Sys_Type", 3600 AS "Timezone",
  CAST(user_id%70 AS INT) AS "Visibility", substr(event_type, 1, 2) AS "Weather_0_Icon", upper(event_type) AS "Weather_0_Description", event_type AS "Weather_0_Main",
  CAST(user_id AS INT) AS "Weather_0_ID", value/4 AS "Wind_Speed", CAST(user_id%360 AS INT) AS "Wind_Deg", 'load-1' AS "LoadID", TIMESTAMP '2024-02-01' AS "LoadTimeStamp" FROM {events})"""
_CITIES_SQL = """cities AS (SELECT 'city' || c_custkey AS "City", c_acctbal AS "Longitude", c_acctbal/2 AS "Latitude",
  n_name AS "State", r_name AS "Country", 'load-1' AS "LoadID", TIMESTAMP '2024-02-01' AS "LoadTimeStamp"
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey)"""


def _cities(t):
    """City answers: customers with their nation and region in a map."""
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return places.select(
        F.concat(F.lit("city"), F.col("c_custkey").cast("string")).alias("City"),
        F.col("c_acctbal").alias("Longitude"),
        (F.col("c_acctbal") / 2).alias("Latitude"),
        F.create_map(F.lit("state"), "n_name", F.lit("country"), "r_name").alias("Response"),
        F.lit("load-1").alias("LoadID"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("LoadTimeStamp"),
    )


@query("h5_weather_silver", f"WITH {_WEATHER_SQL} SELECT * FROM weather")
def _(t):
    return medallion.weather_silver(_weather(t))


@query("h6_cities_silver", f"""WITH {_CITIES_SQL} SELECT *, "State" || '|' || "Country" AS "Response" FROM cities""")
def _(t):
    """The answer map is compared as text."""
    answer = F.concat_ws("|", F.col("Response")["state"], F.col("Response")["country"])
    return medallion.cities_silver(_cities(t)).withColumn("Response", answer)


@query(
    "h7_weather_detailed",
    f"""WITH {_WEATHER_SQL}, {_CITIES_SQL}
SELECT c."City", "Longitude", "Latitude", "State", "Country", "Clouds_All", "Weather_TimeStamp", "Main_Feels_Like", "Main_Temp_Min", "Main_Temp", "Main_Temp_Max",
  "Sys_Sunrise" AS "Sunrise", "Sys_Sunset" AS "Sunset", "Visibility", "Wind_Speed", "Wind_Deg" FROM weather w JOIN cities c ON w."City" = c."City" """,
)
def _(t):
    return medallion.weather_detailed(
        medallion.weather_silver(_weather(t)), medallion.cities_silver(_cities(t))
    )


_DAILY_SQL = f"""WITH {_WEATHER_SQL}
SELECT "City", CAST("Weather_TimeStamp" AS DATE) AS "Date", round(avg("Main_Temp"), 6) AS "Avg_Temperature", max("Main_Temp_Max") AS "Max_Temperature",
  min("Main_Temp_Min") AS "Min_Temperature", round(avg("Wind_Speed"), 6) AS "Avg_Wind_Speed", round(avg("Visibility"), 6) AS "Avg_Visibility"
FROM weather GROUP BY 1, 2"""


def _weather_daily(t):
    daily = medallion.weather_aggregated(medallion.weather_silver(_weather(t)))
    return daily.withColumns({c: F.round(c, 6) for c in daily.columns if c.startswith("Avg_")})


query("h8_weather_aggregated", _DAILY_SQL)(_weather_daily)


@query(
    "a7_daily_figures",
    """SELECT user_id, CAST(ts AS DATE) AS day, round(avg(value), 6) AS average, max(value) AS largest, min(value) AS smallest FROM {events} GROUP BY 1, 2""",
)
def _(t):
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.round(F.avg("value"), 6).alias("average"), F.max("value").alias("largest"), F.min("value").alias("smallest")
    )


@query(
    "h9_monthly_sales",
    """SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, round(sum(o_totalprice), 2) AS total_sales FROM {orders}
       WHERE o_custkey % 11 <> 0 GROUP BY 1""",
)
def _(t):
    day = F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderdate"))
    raw = t.orders.withColumn("o_orderdate", day)
    return medallion.monthly_sales(raw, "o_orderdate", "o_totalprice").withColumn(
        "total_sales", F.round("total_sales", 2)
    )


@query(
    "i1_serving_usage",
    """SELECT p_partkey, concat(p_name, CASE WHEN p_size%2=0 THEN ' INFERENCE' ELSE '' END) AS sku_name FROM {part} WHERE p_size%2=0 AND p_size%3=0""",
)
def _(t):
    usage = t.part.select(
        "p_partkey",
        F.expr("concat(p_name, CASE WHEN p_size%2=0 THEN ' INFERENCE' ELSE '' END)").alias("sku_name"),
        F.expr(
            "named_struct('serving_type', CASE WHEN p_size%3=0 THEN 'FOUNDATION_MODEL' ELSE 'CUSTOM' END)"
        ).alias("product_features"),
    )
    return oplog.serving_usage(usage).drop("product_features")


def _audit(t):
    """Audit rows made of the events: the user is the job, the text of the settings is JSON."""
    e = F.expr
    cron = "concat(CAST(second(ts) AS STRING), ' ', CAST(minute(ts) AS STRING), ' ', CAST(hour(ts) AS STRING), ' * * ?')"
    schedule = (
        f"""',"schedule":{{"quartz_cron_expression":"', {cron}, '","timezone_id":"UTC","pause_status":"', event_type, '"}}'"""
    )
    return t.events.select(
        F.col("ts").alias("event_time"),
        e("CASE WHEN event_type = 'error' THEN 'notebook' ELSE 'jobs' END").alias("service_name"),
        e("CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'deleteRun' ELSE 'update' END").alias("action_name"),
        (F.col("user_id") % 3).alias("workspace_id"),
        e("named_struct('email', concat('user', CAST(user_id AS STRING), '@example.com'))").alias("user_identity"),
        e(
            f"""named_struct('run_id', event_id, 'job_id', user_id, 'new_settings',
            concat('{{"name":"job', CAST(user_id AS STRING), '"', CASE WHEN event_id % 4 = 0 THEN '' ELSE concat({schedule}) END, '}}'))"""
        ).alias("request_params"),
        "event_id",
    )


@query(
    "i2_deleted_runs",
    """SELECT 'user' || user_id || '@example.com' AS deleter, event_id AS run_id, ts AS event_time, 'jobs' AS service_name, 'deleteRun' AS action_name, user_id % 3 AS workspace_id FROM {events}
       WHERE event_type = 'purchase' AND event_id IN (SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F') ORDER BY ts DESC""",
)
def _(t):
    timeline = t.orders.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("job_id"))
    return oplog.deleted_runs(_audit(t), timeline, "F").select(
        "deleter", "run_id", "event_time", "service_name", "action_name", "workspace_id"
    )


@query(
    "i3_latest_schedules",
    """SELECT user_id AS job_id, user_id % 3 AS workspace_id, ts AS event_time, 'user' || user_id || '@example.com' AS email,
  concat('{\"quartz_cron_expression\":\"', second(ts), ' ', minute(ts), ' ', hour(ts), ' * * ?\",\"timezone_id\":\"UTC\",\"pause_status\":\"', event_type, '\"}') AS cron_schedule,
  concat(second(ts), ' ', minute(ts), ' ', hour(ts), ' * * ?') AS quartz_cron_expression, 'UTC' AS timezone_id, event_type AS pause_status, 'job' || user_id AS job_name,
  concat('At ', hour(ts), ':', minute(ts), ':', second(ts), ' every day') AS human_readable
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {events} WHERE event_type IN ('signup', 'view', 'click')) x
WHERE rn = 1 AND event_id % 4 <> 0""",
)
def _(t):
    return oplog.latest_schedules(_audit(t), ties=("event_id",))


@query(
    "i4_job_addresses",
    """SELECT CAST(o_orderkey % 100 AS STRING) AS workspace_id, o_orderkey AS job_id, concat('https://ws-', o_orderkey % 100, '.', s_nationkey, '.example.net/') AS workspace_url,
       concat('https://ws-', o_orderkey % 100, '.', s_nationkey, '.example.net/jobs/', o_orderkey) AS job_url
       FROM {orders} JOIN {supplier} ON s_suppkey = o_orderkey % 100""",
)
def _(t):
    url = F.concat(F.lit("https://ws-"), "s_suppkey", F.lit("."), "s_nationkey", F.lit(".example.net/"))
    jobs = t.orders.select((F.col("o_orderkey") % 100).cast("string").alias("workspace_id"), F.col("o_orderkey").alias("job_id"))
    workspaces = t.supplier.select(url.alias("workspace_url"))
    return oplog.job_addresses(jobs, workspaces, r"https://ws-(\d+)\.\d+\.example\.net/")
