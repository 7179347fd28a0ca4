import pytest
from pyspark.sql import functions as F

from lakeloom import session as S
from lakeloom.operators.rows import all_but_last, running_id, summary_rows, union_all_by_name, with_columns_of
from lakeloom.plans import generators as N
from lakeloom.plans import medallion
from lakeloom.sinks import tables as K
from lakeloom.sources import files
from tests.helpers import rows


def test_manifest_diff(spark):
    source = spark.createDataFrame([("a.csv", 1), ("b/c.csv", 2), ("b/.hidden", 3), ("x.tmp", 4), ("n.csv", 5)], "file string, size bigint")
    target = spark.createDataFrame([("a.csv", 1), ("b/c.csv", 9), ("only.csv", 1)], "file string, size bigint")
    got = {r[0]: r[3] for r in files.manifest_diff(source, target).collect()}
    assert got == {"a.csv": "same", "b/c.csv": "resized", "b/.hidden": "skipped", "x.tmp": "skipped", "n.csv": "missing"}


def test_listing_and_folder_sizes(spark):
    root = S.scratch(spark, "listing")
    spark.range(10).coalesce(1).write.parquet(f"{root}/one")
    spark.range(10).repartition(3).write.parquet(f"{root}/two")
    listing = files.file_listing(spark, root, "*.parquet")
    sizes = {r[0].rsplit("/", 1)[1]: r[1] for r in files.folder_sizes(listing).collect()}
    assert sizes == {"one": 1, "two": 3}
    assert files.file_listing(spark, root, "*.csv").count() == 0


def test_json_document_over_many_lines(spark, tmp_path):
    (tmp_path / "c.json").write_text('[\n {"name": "a",\n  "zones": [{"z": 1}]},\n {"name": "b", "zones": []}\n]')
    df = files.json_documents(spark, str(tmp_path))
    assert rows(df.select("name", F.size("zones"))) == [("a", 1), ("b", 0)]


def test_csv_without_options_keeps_the_header_as_row(spark, tmp_path):
    (tmp_path / "w.csv").write_text("a,b/c\n1,2.5\n")
    assert rows(files.csv_rows(spark, str(tmp_path))) == [("1", "2.5"), ("a", "b/c")]
    table = files.csv_table(spark, str(tmp_path))
    assert table.dtypes == [("a", "int"), ("b/c", "double")]


def test_partition_read_prunes(spark):
    path = S.scratch(spark, "parts")
    K.write_folders(spark.range(100).withColumn("p", F.col("id") % 4), path, ["p"])
    read = files.read_files(spark, path).filter("p = 2")
    assert "PartitionFilters: [isnotnull(p" in read._jdf.queryExecution().executedPlan().toString()
    assert files.one_partition(spark, path, p=2).columns == ["id"]


def test_fan_out_writes_one_folder_per_value(spark):
    path = S.scratch(spark, "fan")
    df = spark.createDataFrame([(1, "Côte d'Ivoire"), (2, "Peru"), (3, None)], "id int, country string")
    got = K.fan_out(df, "country", path)
    assert rows(got.select("id", "part_of")) == [(1, "côte_d_ivoire"), (2, "peru"), (3, None)]


def test_append_merges_columns(spark):
    path = S.scratch(spark, "merge")
    spark.sql("SELECT 1 AS a").write.parquet(path)
    got = K.append_with_new_columns(spark.sql("SELECT 2 AS a, 'x' AS b"), path)
    assert rows(got.select("a", "b")) == [(1, None), (2, "x")]


def test_shared_folder_is_the_configured_one(spark):
    assert S.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cut_counts_and_keeps_the_schema(spark):
    df = spark.range(7).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    again, n = S.cut_and_count(df)
    assert n == 7 and again.dtypes == df.dtypes and again.count() == 7
    nothing, zero = S.cut_and_count(df.limit(0))
    assert zero == 0 and nothing.count() == 0


def test_running_id_has_no_gaps(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("b"), F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("n"))
    assert sorted(r[0] for r in running_id(df, "b", ["id"], "k").select("k").collect()) == list(range(1, 501))
    # A NULL bucket comes first, and each group counts anew.
    per = running_id(df, "n", ["id"], "k", start=0, within=["b"]).groupBy("b").agg(F.max("k").alias("m"), F.count("k").alias("c"))
    assert all(r["m"] == r["c"] - 1 for r in per.collect())


def test_row_helpers(spark):
    assert [r[0] for r in rows(all_but_last(spark.range(4), "id"))] == [0, 1, 2]
    empty = spark.range(3).limit(0)
    assert union_all_by_name([], empty).schema == empty.schema
    with pytest.raises(ValueError):
        union_all_by_name([])
    wider = with_columns_of(spark.range(1), spark.sql("SELECT 'x' AS s, 1L AS id").schema)
    assert rows(wider) == [(None, 0)]
    summary = {r["column_name"]: r for r in summary_rows(spark.range(5).withColumn("s", F.lit("t"))).collect()}
    assert (summary["id"]["mean"], summary["id"]["max"], summary["s"]["mean"], summary["s"]["row_count"]) == (2.0, "4", None, 5)


def test_generated_customers_repeat_whatever_the_partitioning(spark):
    one, many = spark.range(200).coalesce(1), spark.range(200).repartition(7)
    assert rows(N.fake_customers(one, "id")) == rows(N.fake_customers(many, "id"))
    made = N.fake_customers(one, "id")
    assert len(made.columns) == 16 and made.select("primary_key").distinct().count() == 200
    ages = made.agg(F.min("age"), F.max("age"), F.min("income"), F.max("income")).first()
    assert 18 <= ages[0] and ages[1] <= 99 and 10000 <= ages[2] and ages[3] <= 100000
    assert rows(N.fake_customers(one, "id", seed=2)) != rows(made)


def test_snapshots_grow_and_increments_arrive_once(spark):
    ids = spark.range(25).select("id", (F.floor(F.col("id") / 5) + 1).cast("int").alias("step"))
    arriving = N.arrivals(ids, "id", "step")
    per_day = rows(N.daily_snapshots(arriving, 5, "2025-03-01").groupBy("Day").count())
    assert per_day == [(1, 10), (2, 15), (3, 19), (4, 24), (5, 28)]
    assert rows(N.daily_increments(arriving, "2025-03-01").groupBy("Year", "Month", "Day").count()) == [(2025, 3, d, 5) for d in range(1, 6)]
    assert rows(N.daily_snapshots(arriving, 2, "2025-03-01").groupBy("Day").count()) == [(1, 10), (2, 15)]


def test_markets_gold_names(spark):
    columns = ", ".join(f"1 AS {c}" for c in dict.fromkeys(c for _, c in medallion.MARKET_MEASURES))
    gold = medallion.markets_gold(spark.sql(f"SELECT 2024 AS year, 1 AS month, DATE'2024-01-01' AS date, {columns}"))
    assert len(gold.columns) == 21 and "total_volume" in gold.columns and "total_market_cap" in gold.columns


def test_fan_out_keeps_codes_as_text(spark):
    from lakeloom.session import scratch
    from lakeloom.sinks import tables

    df = spark.createDataFrame([("007", 1), ("12", 2), ("a b", 3)], "code string, n int")
    got = tables.fan_out(df, "code", scratch(spark, "fan"))
    assert sorted((r.code, r.n, r.part_of) for r in got.collect()) == [("007", 1, "007"), ("12", 2, "12"), ("a b", 3, "a_b")]
    assert tables.quoted("it's \\") == "'it\\'s \\\\'"


def test_sql_on_a_path_leaves_no_name_behind(spark):
    folder = S.scratch(spark, "it's csv")
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, x string").write.option("header", True).csv(folder)
    before = {v.name for v in spark.catalog.listTables()}
    got = files.sql_on_files(spark, "SELECT x, count(*) AS n FROM {files} GROUP BY x", folder, "csv", header=True)
    assert rows(got) == [("a", 1), ("b", 2)] and {v.name for v in spark.catalog.listTables()} == before


def test_files_of_a_scan_are_counted_by_path(spark):
    folder = S.scratch(spark, "parts")
    for day in ("a", "b"):
        spark.range(5 if day == "a" else 7).coalesce(1).write.parquet(f"{folder}/day={day}")
    found = files.scanned_files(spark.read.parquet(folder)).collect()
    assert sorted(r.rows for r in found) == [5, 7] and len({r.path for r in found}) == 2 and all(r.size > 0 for r in found)
