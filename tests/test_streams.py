import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.history import END, LAST, START, scd1, scd2
from lakeloom.queries import QUERIES
from lakeloom.session import scratch
from lakeloom.streaming import flows as T
from tests.helpers import rows

SCHEMA = "key string, seq int, state string"


def land(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_second_run_reads_new_files_only(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    land(spark, source, [("a", 1, "x")])
    for data in ([("b", 1, "y")], [("c", 1, "z")]):
        T.run_to_files(T.file_stream(spark, source, SCHEMA), f"{out}/data", f"{out}/check")
        land(spark, source, data)
    T.run_to_files(T.file_stream(spark, source, SCHEMA), f"{out}/data", f"{out}/check")
    assert [r[0] for r in rows(spark.read.parquet(f"{out}/data"))] == ["a", "b", "c"]


def test_upserts_over_several_batches_equal_the_batch_job(spark):
    rng = random.Random(3)
    data = [(f"k{rng.randint(1, 8)}", s, rng.choice("ab")) for s in range(120)]
    rng.shuffle(data)
    source = scratch(spark, "in")
    current, history = T.UpsertedTable(spark, scratch(spark, "scd1")), T.UpsertedTable(spark, scratch(spark, "scd2"))
    checks = scratch(spark, "c1"), scratch(spark, "c2")
    for part in range(3):
        land(spark, source, data[part * 40 : part * 40 + 40])
        current.run_scd1(T.file_stream(spark, source, SCHEMA), ["key"], "seq", checks[0])
        history.run_scd2(T.file_stream(spark, source, SCHEMA), ["key"], "seq", checks[1])
    whole = spark.createDataFrame(data, SCHEMA)
    columns = ["key", "state", START, END]
    assert rows(current.read().select("key", "seq", "state")) == rows(scd1(whole, ["key"], "seq"))
    assert rows(history.read().select(*columns, LAST)) == rows(scd2(whole, ["key"], "seq", with_last=True).select(*columns, LAST))


def test_a_batch_that_runs_again_changes_nothing(spark):
    source = scratch(spark, "in")
    land(spark, source, [("a", 1, "x"), ("a", 2, "y")])
    table = T.UpsertedTable(spark, scratch(spark, "scd2"))
    for _ in range(2):  # a lost checkpoint hands batch 0 again
        table.run_scd2(T.file_stream(spark, source, SCHEMA), ["key"], "seq", scratch(spark, "check"))
    assert rows(table.read().select("key", "state", START, END)) == [("a", "x", 1, 2), ("a", "y", 2, None)]


def test_expectations_write_rows_and_counts_once_per_batch(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    land(spark, source, [("a", 1, "x"), ("b", -1, "y"), ("c", None, "z")])
    for _ in range(2):
        T.run_expectations(
            T.file_stream(spark, source, SCHEMA), {"positive": "seq > 0"}, "drop", f"{out}/rows", f"{out}/metrics", scratch(spark, "check")
        )
    assert [r[0] for r in rows(spark.read.parquet(f"{out}/rows"))] == ["a"]
    assert rows(T.rule_counts(spark, f"{out}/metrics")) == [("positive", 1, 2, 0)]


def test_failed_expectation_stops_the_stream(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    land(spark, source, [("a", 1, "x"), ("b", -1, "y")])
    try:
        T.run_expectations(
            T.file_stream(spark, source, SCHEMA), {"positive": "seq > 0"}, "fail", f"{out}/rows", f"{out}/metrics", scratch(spark, "check")
        )
        stopped = False
    except Exception as error:
        stopped = "expectation failed: positive" in str(error)
    assert stopped


def test_each_folder_keeps_its_own_name(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    for coin in ("one", "two"):
        land(spark, f"{source}/{coin}", [(coin, 1, "x")])
    stream = T.with_folder(T.file_stream(spark, f"{source}/*", SCHEMA), "coin")
    T.run_to_files(stream, f"{out}/data", f"{out}/check")
    assert rows(spark.read.parquet(f"{out}/data").select("key", "coin")) == [("one", "one"), ("two", "two")]


def test_bronze_columns(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    land(spark, f"{source}/customer_20250301120000", [("a", 1, "x")])
    stream = T.bronze(T.file_stream(spark, f"{source}/*", SCHEMA), "2025-04-01 00:00:00")
    T.run_to_files(stream, f"{out}/data", f"{out}/check")
    row = spark.read.parquet(f"{out}/data").select(
        F.col("filename_timestamp").cast("string"), F.col("load_timestamp").cast("string"), F.col("_metadata.file_name").endswith(".parquet")
    ).first()
    assert tuple(row) == ("2025-03-01 12:00:00", "2025-04-01 00:00:00", True)


def test_a_new_checkpoint_goes_on_from_the_state(spark):
    kind = "id int, at int, x string"
    first, second = scratch(spark, "in"), scratch(spark, "in")
    spark.createDataFrame([(1, 1, "a"), (2, 99, "z"), (3, 5, "c")], kind).write.parquet(first)
    spark.createDataFrame([(1, 2, "b"), (2, 7, "old"), (4, 1, "d")], kind).write.parquet(second)
    both = spark.read.parquet(first, second)
    one, two = T.UpsertedTable(spark, scratch(spark, "one"), 4), T.UpsertedTable(spark, scratch(spark, "two"), 4)
    for folder in (first, second):
        one.run_scd1(T.file_stream(spark, folder, kind), ["id"], "at", scratch(spark, "checkpoint"))
        two.run_scd2(T.file_stream(spark, folder, kind), ["id"], "at", scratch(spark, "checkpoint"))
    assert rows(one.read()) == rows(scd1(both, ["id"], "at"))
    assert rows(two.read().drop(LAST)) == rows(scd2(both, ["id"], "at"))


def test_a_state_is_one_file_per_bucket_and_leaves_nothing_behind(spark):
    import os

    source = scratch(spark, "in")
    table = T.UpsertedTable(spark, scratch(spark, "state"), buckets=4)
    check = scratch(spark, "check")
    for part in range(3):
        spark.range(part * 50, part * 50 + 200).selectExpr("cast(id as string) as key", "int(id) as seq", "'x' as state").repartition(5).write.mode("append").parquet(source)
        table.run_scd1(T.file_stream(spark, source, SCHEMA), ["key"], "seq", check)
    found = [f for at, _, files in os.walk(f"{table.path}/state") for f in files if f.endswith(".parquet")]
    assert len(found) == 4 and len([n for n in os.listdir(f"{table.path}/log") if n.endswith(".json")]) == 1
    assert table.read().count() == 300


def test_full_buckets_are_dealt_to_twice_as_many(spark):
    import json

    data = [(f"k{i % 40}", i, "ab"[i // 40 % 2]) for i in range(160)]
    random.Random(5).shuffle(data)
    source, check = scratch(spark, "in"), scratch(spark, "check")
    table = T.UpsertedTable(spark, scratch(spark, "scd2"), buckets=2, bucket_rows=8)
    for part in range(4):
        land(spark, source, data[part * 40 : part * 40 + 40])
        table.run_scd2(T.file_stream(spark, source, SCHEMA), ["key"], "seq", check)
    assert table._latest()["of"] >= 8 and len(json.dumps(table._latest())) < 5000
    want = scd2(spark.createDataFrame(data, SCHEMA), ["key"], "seq", with_last=True)
    assert rows(table.read()) == rows(want.select(*table.read().columns))


def test_counts_per_batch_survive_a_restart(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    for part in ([("a", 1, "x"), ("b", -1, "y")], [("c", 5, "z")]):
        land(spark, source, part)
        for _ in range(2):
            T.run_quarantine(T.file_stream(spark, source, SCHEMA), {"positive": "seq > 0", "x": "state = 'x'"}, f"{out}/rows", f"{out}/check", f"{out}/metrics")
    assert rows(T.rule_counts(spark, f"{out}/metrics")) == [("positive", 1, 0, 1), ("positive", 1, 1, 0), ("x", 0, 1, 1), ("x", 1, 1, 0)]


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def written(spark, frame, table, parts):
    """A folder of tables, with one written as one file or as a folder of ``parts`` files."""
    folder = tempfile.mkdtemp(prefix="tables-", dir="/tmp")
    if parts:
        frame.repartition(parts).write.parquet(f"{folder}/{table}.parquet")
    else:
        frame.toPandas().to_parquet(f"{folder}/{table}.parquet")
    spark.range(3).write.parquet(f"{folder}/other.parquet")
    return folder


@pytest.mark.parametrize("parts", (0, 3))
def test_streaming_table_reads_files_and_folders(spark, parts):
    data = [(i, f"t{i}", "en", f"s{i}", 2) for i in range(7)]
    folder = written(spark, spark.createDataFrame(data, DOCUMENTS), "documents", parts)
    assert rows(QUERIES["k12_streaming_table"](spark, folder)) == [(i, lang, source, n) for i, _, lang, source, n in data]


@pytest.mark.parametrize("parts", (0, 3))
def test_stream_sink_reads_files_and_folders(spark, parts):
    data = [(i, f"https://h{i}.net/a", "") for i in range(7)]
    folder = written(spark, spark.createDataFrame(data, "page_id bigint, url string, html string"), "pages", parts)
    assert rows(QUERIES["k13_stream_sink"](spark, folder)) == [(i, url, f"h{i}.net") for i, url, _ in data]


@pytest.mark.parametrize("parts", (0, 3))
def test_stream_sink_beside_a_table_in_partition_folders(spark, parts):
    data = [(1, "https://h1.net/a", "x"), (2, None, "y"), (2, "https://h2.net", None)]
    folder = written(spark, spark.createDataFrame(data, "page_id bigint, url string, html string"), "pages", parts)
    spark.range(6).withColumn("kind", F.col("id") % 2).write.partitionBy("kind").parquet(f"{folder}/kinds.parquet")
    spark.range(3).write.parquet(f"{folder}/my_pages.parquet")
    assert rows(QUERIES["k13_stream_sink"](spark, folder)) == [(1, "https://h1.net/a", "h1.net"), (2, "https://h2.net", "h2.net"), (2, None, None)]
