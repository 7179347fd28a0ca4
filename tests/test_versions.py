import pytest
from pyspark.sql import functions as F

from lakeloom.operators import versions as V
from lakeloom.session import scratch
from tests.helpers import rows

AT = [f"2024-05-0{d} 12:00:00" for d in range(1, 9)]


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "Ilse", 12.5), (2, "Urs", 80.25), (3, "Noa", 31.0)], "id int, name string, amount double")


def test_update_delete_merge(spark, people):
    updated = V.update_where(people, F.col("id").isin(1, 2), {"amount": F.col("amount") + 5})
    deleted = V.delete_where(updated, F.col("id") == 3)
    source = spark.createDataFrame([(2, "Urs-Peter", 64.0), (3, "Noa", 40.5)], people.schema)
    assert rows(V.merge(deleted, source, ["id"])) == [(1, "Ilse", 17.5), (2, "Urs-Peter", 64.0), (3, "Noa", 40.5)]


def test_update_expressions_see_the_old_row(people):
    swapped = V.update_where(people, F.lit(True), {"id": F.col("amount").cast("int"), "amount": F.col("id").cast("double")})
    assert rows(swapped)[0] == (12, "Ilse", 1.0)


def test_delete_keeps_rows_with_unknown_condition(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, x int")
    assert [r[0] for r in rows(V.delete_where(df, F.col("x") > 0))] == [1]


def test_merge_refuses_copies_of_a_key(spark, people):
    twice = spark.createDataFrame([(2, "x", 1.0), (2, "y", 2.0)], people.schema)
    with pytest.raises(ValueError, match="more than once"):
        V.merge(people, twice, ["id"])


def test_merge_null_keys_never_match(spark, people):
    target = people.union(spark.createDataFrame([(None, "n", 0.0)], people.schema))
    source = spark.createDataFrame([(None, "m", 1.0), (None, "o", 2.0)], people.schema)
    assert V.merge(target, source, ["id"]).count() == 6


def test_merge_keeps_copies_in_the_target(spark, people):
    source = spark.createDataFrame([(1, "new", 0.0)], people.schema)
    assert sum(r[1] == "new" for r in rows(V.merge(people.union(people), source, ["id"]))) == 2


def history(spark, people):
    table = V.VersionedTable(spark, scratch(spark, "people"))
    table.create(people, AT[0])
    table.commit(V.update_where(table.read(), F.col("id") == 1, {"amount": F.col("amount") + 1}), "UPDATE", AT[1])
    new = spark.createDataFrame([(4, "Vreni", 9.75)], people.schema)
    table.commit(V.delete_where(V.insert(table.read(), new), F.col("id") == 2), "WRITE", AT[2])
    return table


def test_change_feed_rebuilds_each_version(spark, people):
    table = history(spark, people)
    feed = table.changes(["id"], 1)
    kinds = rows(feed.groupBy(V.COMMIT, V.CHANGE).count())
    assert kinds == [(1, "update_postimage", 1), (1, "update_preimage", 1), (2, "delete", 1), (2, "insert", 1)]
    for version in (1, 2):
        changes = feed.filter(F.col(V.COMMIT) == version)
        assert rows(V.apply_changes(table.read(version - 1), changes, ["id"])) == rows(table.read(version))
    assert table.changes(["id"], 0, 0).count() == 3


def test_time_travel_diff_restore_log(spark, people):
    table = history(spark, people)
    assert rows(table.read_at("2024-05-02 11:59:59")) == rows(people)
    assert table.version_at(AT[1]) == 1
    with pytest.raises(ValueError):
        table.version_at("2024-04-30 00:00:00")
    assert rows(table.added(0, 1)) == [(1, "Ilse", 13.5)]
    assert table.restore(0, AT[3]) == 3
    assert rows(table.read()) == rows(people)
    assert [(r[0], r[2], r[3]) for r in rows(table.log())] == [(0, "CREATE", 3), (1, "UPDATE", 3), (2, "WRITE", 3), (3, "RESTORE 0", 3)]


def test_version_without_log_row_is_not_seen_and_gets_replaced(spark, people):
    table = V.VersionedTable(spark, scratch(spark, "people"))
    table.create(people, AT[0])
    people.limit(1).write.parquet(f"{table.path}/version=1")
    assert table.latest() == 0 and table.read().count() == 3
    table.commit(people.limit(2), "WRITE", AT[1])
    assert table.read().count() == 2


def test_empty_version(spark, people):
    table = V.VersionedTable(spark, scratch(spark, "people"))
    table.create(people.limit(0), AT[0])
    assert table.read().count() == 0 and rows(table.log())[0][3] == 0


def test_added_column_default_for_new_rows_only(spark, people):
    wider = V.add_column(people, "category", "string")
    assert V.add_column(wider, "category", "string").columns == wider.columns
    new = spark.createDataFrame([(4, "Vreni", 1.0, None), (5, "Kim", 2.0, "Own")], "id int, name string, amount double, category string")
    got = rows(V.insert(wider, new, {"category": "General"}))
    assert [r[3] for r in got] == [None, None, None, "General", "Own"]


def test_change_feed_over_an_added_column(spark, people):
    table = V.VersionedTable(spark, scratch(spark, "people"))
    table.create(people, AT[0])
    table.commit(V.add_column(table.read(), "category", "string"), "ADD COLUMN", AT[1])
    assert table.changes(["id"], 1).count() == 0


def test_compaction_keeps_rows_and_lowers_files(spark):
    df = spark.range(5000).repartition(16)
    table = V.VersionedTable(spark, scratch(spark, "ids"))
    table.create(df, AT[0])
    counts = table.compact(64 * 1024 * 1024, AT[1])
    assert counts == {"before": 16, "after": 1} and table.read().count() == 5000


def test_clustering_narrows_both_columns(spark):
    n = 64
    df = spark.range(n * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))
    path = scratch(spark, "clustered")
    V.clustered(df, "x", "y", 16).write.parquet(path)
    read = spark.read.parquet(path)
    spans = read.groupBy(F.input_file_name()).agg(
        (F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y")
    )
    assert read.count() == n * n
    widths = spans.agg(F.avg("x"), F.avg("y")).first()
    # A layout by one column alone leaves the other at its full width of 63.
    assert widths[0] < 40 and widths[1] < 40


def test_clustering_takes_text_dates_and_nulls(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), (None, None), ("zz", "2024-05-05")], "s string, d string").withColumn("d", F.to_date("d"))
    assert rows(V.clustered(df, "s", "d", 2)) == rows(df)


def test_spread_bits(spark):
    value = spark.range(1).select(V.spread_bits(F.lit(0b1011), 6)).first()[0]
    assert value == 0b1000101


def test_null_keys_take_no_part_in_the_merge_join(spark, people):
    many = people.union(spark.range(5000).select(F.lit(None).cast("int"), F.col("id").cast("string"), F.lit(1.0)))
    source = spark.createDataFrame([(None, "m", 1.0), (1, "new", 2.0), (9, "nine", 3.0)], people.schema)
    merged = V.merge(many, source, ["id"])
    assert merged.count() == 5000 + 3 + 2
    assert "FullOuter" not in merged._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(id" in merged._jdf.queryExecution().executedPlan().toString()


def test_changes_between_states_with_repeated_keys(spark):
    kind = "id int, x string"
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], kind)
    assert V.change_rows(twice, twice, ["id"]).count() == 0
    after = spark.createDataFrame([(1, "b"), (1, "d"), (2, "c"), (None, "n"), (None, "n"), (None, "m")], kind)
    got = rows(V.change_rows(twice, after, ["id"]))
    assert got == sorted([(1, "a", "update_preimage"), (1, "d", "update_postimage"), (None, "n", "insert"), (None, "m", "insert")], key=repr)
    unclear = spark.createDataFrame([(1, "x"), (1, "y"), (2, "c"), (None, "n")], kind)
    with pytest.raises(Exception, match="more than once"):
        V.change_rows(twice, unclear, ["id"]).collect()


def test_a_feed_beyond_the_versions_is_an_error(spark, people):
    table = history(spark, people)
    for first, last in ((1, 9), (2, 1), (7, None)):
        with pytest.raises(ValueError, match="no versions"):
            table.changes(["id"], first, last)


def test_texts_with_a_common_start_are_clustered(spark):
    df = spark.range(20_000).select(
        F.concat(F.lit("https://example.org/é/漢字/"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(20_000)).cast("string"), 6, "0")).alias("url"),
        F.pmod(F.col("id") * 104_729, F.lit(20_000)).alias("n"),
    ).union(spark.createDataFrame([(None, None)], "url string, n long"))
    placed = V.clustered(df, "url", "n", 16).withColumn("part", F.spark_partition_id())
    assert placed.count() == 20_001
    spans = placed.groupBy("part").agg(F.countDistinct("url").alias("u"), (F.max("n") - F.min("n")).alias("n"),
                                       (F.max(F.substring("url", -6, 6)).cast("int") - F.min(F.substring("url", -6, 6)).cast("int")).alias("u_span")).collect()
    assert sum(r.n for r in spans) / len(spans) < 10_000 and sum(r.u_span for r in spans) / len(spans) < 10_000


def test_one_pass_feed_equals_state_by_state(spark, monkeypatch):
    """Copies, NULL keys, rows that come back, added columns; runs of any length give the same feed."""
    import random

    r = random.Random(9)
    kind = "id int, x string"
    states = {}
    for n in range(6):
        rows_ = [(k, r.choice("ab")) for k in range(8) if r.random() < 0.7] + [(None, r.choice("ab")) for _ in range(r.randint(0, 3))]
        states[n] = spark.createDataFrame(rows_ + rows_[:2] if n % 2 else rows_, kind).dropDuplicates(["id", "x"]) if n % 2 else spark.createDataFrame(rows_, kind)
    states[5] = states[5].withColumn("more", F.lit("m"))
    want = []
    for n in range(1, 6):
        before = states[n - 1] if n < 5 else states[n - 1].withColumn("more", F.lit(None).cast("string"))
        made = V.change_rows(before, states[n], ["id"])
        want += [(*(tuple(x)[:2]), x["more"] if n == 5 else None, x[V.CHANGE], n) for x in made.collect()]
    for run in (32, 2):
        monkeypatch.setattr(V, "RUN", run)
        feed = V.change_feed(states, ["id"], {n: AT[n] for n in range(6)})
        got = [(x.id, x.x, x["more"], x[V.CHANGE], x[V.COMMIT]) for x in feed.collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert V.change_feed({0: states[0]}, ["id"]).count() == 0
    plan = V.change_feed({n: states[n] for n in range(5)}, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_copies_of_a_row_that_come_and_go(spark):
    kind = "id int, x string"
    one, three = spark.createDataFrame([(1, "a")], kind), spark.createDataFrame([(1, "a")] * 3 + [(None, "n")] * 2, kind)
    with pytest.raises(Exception, match="more than once"):
        V.change_feed({0: one, 1: three}, ["id"]).collect()


def test_a_random_layout_touches_all_files(spark):
    n = 64
    df = spark.range(n * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))
    good, bad = scratch(spark, "good"), scratch(spark, "bad")
    V.clustered(df, "x", "y", 16).write.parquet(good)
    df.repartition(16, F.xxhash64("x", "y")).write.parquet(bad)
    shares = [V.touched_shares(spark.read.parquet(p), ["x", "y"]).first() for p in (good, bad)]
    assert max(shares[0]) < 0.6 and min(shares[1]) > 0.9


def test_few_distinct_values_spread_over_the_curve(spark):
    """Ten values beside many: both columns narrow, which ranks among distinct bounds alone would not give."""
    df = spark.range(6000).select((F.col("id") % 10).alias("x"), F.pmod(F.col("id") * 7919, F.lit(6000)).alias("y"))
    path = scratch(spark, "few")
    V.clustered(df, "x", "y", 8).write.parquet(path)
    share = V.touched_shares(spark.read.parquet(path), ["x", "y"]).first()
    assert share.x < 0.7 and share.y < 0.5
