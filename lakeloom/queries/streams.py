"""Queries that run a file stream to its end and read what it wrote."""

from uuid import uuid4

from pyspark.sql import functions as F

from lakeloom.operators import quality
from lakeloom.operators.history import END, START
from lakeloom.plans import medallion
from lakeloom.queries.base import query
from lakeloom.queries.history import _EVENT_HISTORY, _HISTORY_COLUMNS
from lakeloom.queries.inputs import SNAPSHOTS
from lakeloom.queries.layers import _WEATHER_SQL, _weather
from lakeloom.session import is_folder
from lakeloom.sinks.tables import read_flagged, save_table, write_folders
from lakeloom.streaming import flows as T

_NOW = "2024-02-01 06:00:00"
_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


def _stream(t, name="events"):
    """A table as a stream, be it one file or a folder of files; the tables beside it are not looked at."""
    schema = getattr(t, name).schema
    if is_folder(t.spark, t.path(name)):
        return T.file_stream(t.spark, t.path(name), schema)
    # A stream starts at a folder or a wildcard; this one fits the file alone.
    return T.file_stream(t.spark, f"{t.folder}/[{name[0]}]{name[1:]}.parquet", schema)


def _landed(t, stream, partition_by=()):
    """Run the stream into a folder and read the folder."""
    folder = t.scratch("stream")
    T.run_to_files(stream, f"{folder}/data", f"{folder}/checkpoint", partition_by)
    return t.spark.read.parquet(f"{folder}/data")


@query("s14_file_stream", f"SELECT {_EVENT_COLUMNS} FROM {{events}}")
def _(t):
    """The stream runs twice with one checkpoint; the second run finds nothing new."""
    folder = t.scratch("stream")
    for _run in range(2):
        T.run_to_files(_stream(t), f"{folder}/data", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/data")


_DRIFT = """SELECT event_id, user_id, event_type, value, CASE
    WHEN event_id % 5 = 1 THEN concat('{{"event_id":', CAST(event_id AS STRING), ',"user_id":', CAST(user_id AS STRING), ',"event_type":"', event_type, '","channel":"c', CAST(event_id % 3 AS STRING), '"}}')
    WHEN event_id % 5 = 2 THEN concat('{{"event_id":', CAST(event_id AS STRING), ',"user_id":"u', CAST(user_id AS STRING), '","event_type":"', event_type, '","detail":{{"page":"p","rank":', CAST(event_id % 7 AS STRING), '}}}}')
    WHEN event_id % 5 = 3 THEN concat('{{"event_id":', CAST(event_id AS STRING), ',"User_Id":', CAST(user_id AS STRING), ',"event_type":"', event_type, '","detail":{{"page":[1,2],"rank":3}}}}')
    WHEN event_id % 500 = 4 THEN concat('no json ', CAST(event_id AS STRING))
    ELSE concat('{{"event_id":', CAST(event_id AS STRING), ',"user_id":', CAST(user_id AS STRING), ',"event_type":"', event_type, '"}}') END AS value_line
  FROM {events}""".replace("{{", "{").replace("}}", "}")


@query(
    "s14_rescued_fields",
    """SELECT CASE WHEN event_id % 500 <> 4 THEN event_id END AS event_id,
    CASE WHEN event_id % 5 NOT IN (2, 3) AND event_id % 500 <> 4 THEN user_id END AS user_id,
    CASE WHEN event_id % 500 <> 4 THEN event_type END AS event_type,
    CASE event_id % 5 WHEN 2 THEN event_id % 7 WHEN 3 THEN 3 END AS detail_rank,
    CASE event_id % 5 WHEN 1 THEN '{"channel":"c' || (event_id % 3) || '"}'
      WHEN 2 THEN '{"detail":{"page":"p"},"user_id":"u' || user_id || '"}'
      WHEN 3 THEN '{"User_Id":' || user_id || ',"detail":{"page":[1,2]}}'
      ELSE CASE WHEN event_id % 500 = 4 THEN '{"_corrupt_record":"no json ' || event_id || '"}' END END AS _rescued_data
    FROM {events}""",
)
def _(t):
    """Files of drifted JSON lines: new fields, other types, another spelling, nested ones, and lines that are no JSON."""
    folder = t.scratch("drift")
    t.sql(_DRIFT).select(F.col("value_line").alias("value")).write.text(folder)
    declared = "event_id bigint, user_id bigint, event_type string, detail struct<rank:bigint>"
    rows = _landed(t, T.json_stream(t.spark, folder, declared))
    return rows.select("event_id", "user_id", "event_type", F.col("detail.rank").alias("detail_rank"), "_rescued_data")


@query("s15_table_stream", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}")
def _(t):
    name = f"streamed_{uuid4().hex[:12]}"
    save_table(t.orders, name, path=t.scratch("table"))
    return _landed(t, t.spark.readStream.table(name).select("o_orderkey", "o_custkey", "o_totalprice"))


@query("k12_streaming_table", "SELECT doc_id, lang, source, n_chars FROM {documents}")
def _(t):
    return _landed(t, _stream(t, "documents").select("doc_id", "lang", "source", "n_chars"))


@query(
    "k13_stream_sink",
    "SELECT page_id, url, split_part(url, '/', 3) AS host FROM {pages}",
)
def _(t):
    host = F.get(F.split("url", "/"), F.lit(2))
    return _landed(t, _stream(t, "pages").select("page_id", "url", host.alias("host")))


def _day_folders(t, rows, day, prefix):
    """Rows in one folder per day, whose name holds the day as a 14-digit stamp."""
    folder = t.scratch("landing")
    stamp = F.concat(F.lit(prefix), F.date_format(day, "yyyyMMddHHmmss"))
    write_folders(rows.withColumn("load", stamp), folder, ["load"])
    return folder


@query(
    "t1_raw_to_bronze",
    f"""SELECT {_EVENT_COLUMNS}, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS filename_timestamp, TIMESTAMP '{_NOW}' AS load_timestamp, true AS has_name FROM {{events}}""",
)
def _(t):
    folder = _day_folders(t, t.events, F.to_date("ts"), "customer_delta_")
    stream = T.file_stream(t.spark, f"{folder}/*", t.events.schema)
    has_name = F.col("_metadata.file_name").endswith(".parquet")
    return _landed(t, T.bronze(stream, _NOW)).withColumn("has_name", has_name).drop("_metadata")


@query("t2_stream_of_folders", "SELECT event_id, user_id, value, 'kind=' || event_type AS folder FROM {events}")
def _(t):
    folder = t.scratch("kinds")
    rows = t.events.select("event_id", "user_id", "value", F.col("event_type").alias("kind"))
    write_folders(rows, folder, ["kind"])
    stream = T.file_stream(t.spark, f"{folder}/*", rows.drop("kind").schema)
    return _landed(t, T.with_folder(stream, "folder"))


@query("t3_bronze_to_silver", f"WITH {_WEATHER_SQL} SELECT * FROM weather")
def _(t):
    folder, bronze = t.scratch("bronze"), _weather(t)
    bronze.write.parquet(folder)
    return _landed(t, medallion.weather_silver(T.file_stream(t.spark, folder, bronze.schema)))


@query("t4_stream_filter", f"SELECT {_EVENT_COLUMNS} FROM {{events}} WHERE event_type = 'purchase'")
def _(t):
    return _landed(t, _stream(t).filter(F.col("event_type") == "purchase"))


def _value_rules():
    return {"not_small": F.col("value") >= 10, "known_user": F.col("user_id") > 20}


@query("t5_stream_drop", f"SELECT {_EVENT_COLUMNS} FROM {{events}} WHERE value >= 10 AND user_id > 20")
def _(t):
    folder = t.scratch("checked")
    T.run_expectations(_stream(t), _value_rules(), "drop", f"{folder}/rows", f"{folder}/metrics", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/rows").drop("batch")


@query(
    "t5_stream_metrics",
    """SELECT 'not_small' AS rule, count(*) FILTER (value >= 10) AS passed, count(*) FILTER (value < 10) AS failed FROM {events}
       UNION ALL SELECT 'known_user', count(*) FILTER (user_id > 20), count(*) FILTER (user_id <= 20) FROM {events}""",
)
def _(t):
    folder = t.scratch("checked")
    T.run_expectations(_stream(t), _value_rules(), "warn", f"{folder}/rows", f"{folder}/metrics", f"{folder}/checkpoint")
    return (
        T.rule_counts(t.spark, f"{folder}/metrics")
        .groupBy("rule")
        .agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
    )


@query("t6_stream_quarantine", f"SELECT {_EVENT_COLUMNS}, NOT (value >= 10 AND user_id > 20) AS is_quarantined FROM {{events}}")
def _(t):
    folder = t.scratch("quarantine")
    T.run_quarantine(_stream(t), _value_rules(), f"{folder}/data", f"{folder}/checkpoint")
    flagged = read_flagged(t.spark, f"{folder}/data", t.events.schema, "is_quarantined")
    return quality.valid(flagged).unionByName(quality.invalid(flagged))


@query(
    "t6_quarantine_metrics",
    """SELECT 'not_small' AS rule, count(*) FILTER (value >= 10) AS passed, count(*) FILTER (value < 10) AS failed,
         (SELECT count(*) FROM {events} WHERE NOT (value >= 10 AND user_id > 20)) AS quarantined FROM {events}
       UNION ALL SELECT 'known_user', count(*) FILTER (user_id > 20), count(*) FILTER (user_id <= 20),
         (SELECT count(*) FROM {events} WHERE NOT (value >= 10 AND user_id > 20)) FROM {events}""",
)
def _(t):
    """The counts per rule that the quarantine stream keeps beside its rows."""
    folder = t.scratch("quarantine")
    T.run_quarantine(_stream(t), _value_rules(), f"{folder}/data", f"{folder}/checkpoint", f"{folder}/metrics")
    held = read_flagged(t.spark, f"{folder}/data", t.events.schema, "is_quarantined").filter("is_quarantined")
    counts = T.rule_counts(t.spark, f"{folder}/metrics").groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
    return counts.withColumn("quarantined", held.agg(F.count(F.lit(1))).scalar())


# Batches that the events come in, and files of each, which are read side by side.
_BATCHES, _FILES = 3, 8


def _event_parts(t):
    """The events in a few batches of mixed times, so that rows also come late."""
    folder = t.scratch("parts")
    rows = t.events.select("user_id", "ts", "event_type", "value", "event_id")
    rows.repartition(_BATCHES * _FILES, "event_id").write.parquet(folder)
    return T.file_stream(t.spark, folder, rows.schema, files_per_batch=_FILES)


@query(
    "t7_stream_scd1",
    """SELECT user_id, ts, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {events}) x WHERE rn = 1""",
)
def _(t):
    table = T.UpsertedTable(t.spark, t.scratch("scd1"))
    table.run_scd1(_event_parts(t), ["user_id"], "ts", t.scratch("checkpoint"), ties=["event_id"])
    return table.read()


@query("t7_stream_scd2", f"WITH {_EVENT_HISTORY} SELECT {_HISTORY_COLUMNS} FROM hist")
def _(t):
    table = T.UpsertedTable(t.spark, t.scratch("scd2"))
    table.run_scd2(_event_parts(t), ["user_id"], "ts", t.scratch("checkpoint"), track_except=["value", "event_id"])
    return table.read().select("user_id", "event_type", "value", "event_id", START, END)


@query(
    "d9_snapshot_append",
    f"""SELECT user_id, event_type, value, CAST(day AS TIMESTAMP) AS filename_timestamp, TIMESTAMP '{_NOW}' AS load_timestamp FROM ({SNAPSHOTS}) s""",
)
def _(t):
    snapshots = t.sql(SNAPSHOTS)
    rows = snapshots.drop("day")
    folder = _day_folders(t, snapshots, F.col("day"), "customer_snapshot_")
    stream = T.file_stream(t.spark, f"{folder}/*", rows.schema)
    return _landed(t, T.bronze(stream, _NOW)).drop("_metadata")
