import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import history as H
from lakeloom.plans import generators as N
from tests.helpers import plan, rows


def brute_scd2(data):
    """Versions of (key, seq, tracked, other) rows, one key after the other."""
    out = []
    for key in {r[0] for r in data}:
        versions = []
        for _, seq, state, other in sorted((r for r in data if r[0] == key), key=lambda r: r[1]):
            if versions and versions[-1][1] == state:
                versions[-1][2] = other
            else:
                if versions:
                    versions[-1][4] = seq
                versions.append([key, state, other, seq, None])
        out += [tuple(v) for v in versions]
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [1, 7, 10**6])
def test_scd2_equals_brute_force_for_any_chunk(spark, width):
    rng = random.Random(width)
    hot = [("hot", s, rng.choice(["a", "b", None]), s * 10) for s in rng.sample(range(400), 150)]
    cold = [(f"k{i}", s, rng.choice("ab"), s) for i in range(30) for s in rng.sample(range(400), rng.randint(1, 6))]
    data = hot + cold
    df = spark.createDataFrame(data, "key string, seq int, state string, other int")
    result = H.scd2(df, ["key"], "seq", ["other"], chunk=F.floor(F.col("seq") / width))
    assert rows(result.select("key", "state", "other", H.START, H.END)) == brute_scd2(data)


def test_scd2_of_long_and_short_keys_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "PIECE_ROWS", 20)
    rng = random.Random(11)
    data = [(k, s, rng.choice(["a", "b", None]), s * 10) for k, n in (("long", 90), (None, 40), ("edge", 20), ("short", 3)) for s in rng.sample(range(400), n)]
    df = spark.createDataFrame(data, "key string, seq int, state string, other int")
    result = H.scd2(df, ["key"], "seq", ["other"])
    assert rows(result.select("key", "state", "other", H.START, H.END)) == brute_scd2(data)
    last = {(r[0], r[1]): r[2] for r in rows(H.scd2(df, ["key"], "seq", ["other"], with_last=True).select("key", H.START, H.LAST))}
    assert last == {(r[0], r[3]): r[2] // 10 for r in brute_scd2(data)}


def test_scd2_of_short_keys_deals_and_sorts_the_rows_once(spark):
    text = plan(H.scd2(spark.range(50).selectExpr("id % 7 as key", "id as seq", "id % 3 as state"), ["key"], "seq"))
    assert text.count("Exchange hashpartitioning") == text.count("Sort [") == 1 and "SortMergeJoin" not in text


def test_scd2_run_over_many_chunks_is_one_version(spark):
    data = [("k", s, "same", s) for s in range(50)]
    df = spark.createDataFrame(data, "key string, seq int, state string, other int")
    result = H.scd2(df, ["key"], "seq", ["other"], chunk=F.floor(F.col("seq") / 3))
    assert rows(result.select("key", "state", "other", H.START, H.END)) == [("k", "same", 49, 0, None)]


def test_scd2_keeps_null_keys_and_two_part_keys(spark):
    data = [(None, 1, 1, "a"), (None, 1, 2, "b"), ("x", None, 1, "a")]
    df = spark.createDataFrame(data, "a string, b int, seq int, state string")
    got = rows(H.scd2(df, ["a", "b"], "seq").select("a", "b", "state", H.START, H.END))
    assert got == sorted([(None, 1, "a", 1, 2), (None, 1, "b", 2, None), ("x", None, "a", 1, None)], key=repr)


def test_scd2_open_rows_are_scd1(spark):
    rng = random.Random(5)
    data = [(rng.randint(1, 9), s, rng.choice("abc")) for s in range(200)]
    df = spark.createDataFrame(data, "key int, seq int, state string")
    current = H.scd2(df, ["key"], "seq").filter(F.col(H.END).isNull()).select("key", "state")
    assert rows(current) == rows(H.scd1(df, ["key"], "seq").select("key", "state"))


def test_scd1_keeps_newest_not_last_arrived(spark):
    df = spark.createDataFrame([("k", 2, "new"), ("k", 1, "late")], "key string, seq int, v string")
    assert rows(H.scd1(df, ["key"], "seq")) == [("k", 2, "new")]


def test_default_chunk_needs_a_known_type(spark):
    df = spark.createDataFrame([("k", "1", "a")], "key string, seq string, v string")
    with pytest.raises(ValueError):
        H.scd2(df, ["key"], "seq")


def scripted(spark):
    ids = spark.createDataFrame([(1, 1)], "id int, step int")
    return N.daily_snapshots(N.arrivals(ids, "id", "step"), 5, "2025-03-01").filter(
        F.col("primary_key").startswith("PK")
    )


def test_scripted_snapshots_give_the_known_histories(spark):
    snapshots = scripted(spark).withColumn("version", H.version_number(F.col("snapshot_date"))).drop(
        "Year", "Month", "Day", "snapshot_date"
    )
    history = H.scd2_from_snapshots(snapshots, ["primary_key"], "version")
    assert rows(history.select("primary_key", "name", H.START, H.END)) == [
        ("PK1", "UPDATED", 20250302, None),
        ("PK1", "Update1", 20250301, 20250302),
        ("PK2", "Delete1", 20250301, 20250303),
        ("PK3", "UPDATED", 20250304, None),
        ("PK3", "Update2", 20250301, 20250304),
        ("PK4", "Delete2", 20250301, 20250305),
        ("PK5", "Update3", 20250301, None),
    ]
    by_sequence = H.scd2(snapshots, ["primary_key"], "version")
    still_open = by_sequence.filter(F.col(H.END).isNull()).select("primary_key")
    assert [r[0] for r in rows(still_open)] == ["PK1", "PK2", "PK3", "PK4", "PK5"]


def test_snapshot_key_that_comes_back_opens_a_new_version(spark):
    data = [("a", 1, "x"), ("a", 3, "x"), ("b", 1, "y"), ("b", 2, "y"), ("b", 3, "y")]
    df = spark.createDataFrame(data, "key string, version int, v string")
    got = rows(H.scd2_from_snapshots(df, ["key"], "version").select("key", H.START, H.END))
    assert got == [("a", 1, 2), ("a", 3, None), ("b", 1, None)]


def test_untracked_columns_do_not_open_versions(spark):
    data = [("a", 1, "x", 10), ("a", 2, "x", 20), ("a", 3, "z", 30)]
    df = spark.createDataFrame(data, "key string, version int, v string, load int")
    got = rows(H.scd2_from_snapshots(df, ["key"], "version", ["load"]).select("v", "load", H.START, H.END))
    assert got == [("x", 20, 1, 3), ("z", 30, 3, None)]


def days(spark, *numbers):
    return spark.createDataFrame([(dt.date(2025, 3, n),) for n in numbers], "day date")


def test_snapshots_stop_at_the_first_missing_day(spark):
    frame = days(spark, 1, 2, 3, 5, 6)
    assert len(rows(H.contiguous_snapshots(frame, "day", "2025-03-01"))) == 3
    assert len(rows(H.contiguous_snapshots(frame, "day", "2025-03-02"))) == 2
    assert rows(H.contiguous_snapshots(frame, "day", "2025-03-04")) == []
    assert len(rows(H.contiguous_snapshots(frame, "day", "2025-03-02", "skip"))) == 4
    assert len(rows(H.contiguous_snapshots(frame, "day"))) == 3


def test_deletes_active_final(spark):
    data = [("old", 1, "a"), ("old", 2, "a"), ("new", 2, "b"), ("gone", 1, "c")]
    df = spark.createDataFrame(data, "key string, seq int, v string").withColumn("seen", F.col("seq"))
    history = H.scd2(df, ["key"], "seq", ["seen"])
    assert [r[0] for r in rows(H.deleted(history).select("key"))] == ["gone", "old"]
    assert [r[0] for r in rows(H.unseen(history, "seen").select("key"))] == ["gone"]
    live = H.active(history)
    assert [r[0] for r in rows(live.select("key"))] == ["new"]
    assert rows(H.final(live, H.deleted(history), ["key"])) == rows(live)


def test_equal_sequences_need_ties(spark):
    kind = "id int, at int, x string"
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "b"), (2, 1, "c")], kind)
    with pytest.raises(Exception, match="one sequence value"):
        H.scd2(df, ["id"], "at").collect()
    assert rows(H.scd2(df, ["id"], "at", ties=["x"])) == [(1, "b", 1, None), (2, "c", 1, None)]


def test_a_key_twice_in_a_snapshot_is_an_error(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "b")], "id int, v int, x string")
    with pytest.raises(Exception, match="twice"):
        H.scd2_from_snapshots(df, ["id"], "v").collect()
    with pytest.raises(ValueError, match="twice"):
        H.snapshot_step(spark.createDataFrame([], "id int, x string, __START_AT int, __END_AT int"), df.drop("v"), ["id"], 3)


def test_steps_equal_the_history_of_all_snapshots(spark):
    import random

    r = random.Random(3)
    snaps = [(k, v, r.choice("ab"), r.randint(0, 2)) for v in (1, 2, 4, 7, 8) for k in (1, 2, 3, 4, None) if r.random() < 0.7]
    df = spark.createDataFrame(snaps, "id int, v int, x string, note int")
    history = H.scd2_from_snapshots(df.filter("v = 1"), ["id"], "v", ["note"])
    for v in (2, 4, 7, 8):
        history = H.snapshot_step(history, df.filter(f"v = {v}").drop("v"), ["id"], v, ["note"])
        assert rows(history) == rows(H.scd2_from_snapshots(df.filter(f"v <= {v}"), ["id"], "v", ["note"]))


def test_pieces_follow_the_data(spark):
    dense = spark.range(10_000).select(F.lit(1).alias("id"), F.col("id").alias("at"), (F.col("id") / 100).cast("int").alias("x"))
    chunked = dense.withColumn("_sequence", F.col("at").cast("double")).withColumn("c", H.default_chunk(dense, "at"))
    sizes = [r["count"] for r in chunked.groupBy("c").count().collect()]
    assert len(sizes) > 100 and max(sizes) < 300
    assert H.scd2(dense, ["id"], "at").count() == 100


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spliced_batches_equal_a_full_recompute(spark, seed):
    """Late, repeated and out-of-order rows, NULL keys, new keys; untracked columns follow the newest row of a version."""
    rng = random.Random(seed)
    data = [(rng.choice([None, "a", "b", "c", "d"]), s, rng.choice("xy"), rng.randint(0, 9)) for s in rng.sample(range(200), 90)]
    data = list({(k, s): (k, s, x, n) for k, s, x, n in data}.values())
    kind = "key string, seq int, state string, note int"
    step = lambda part: spark.createDataFrame(part, kind)
    parts = [data[:30], data[30:45] + data[3:6] + data[30:32], data[45:]]
    history = H.scd2(step(parts[0]), ["key"], "seq", ["note"], with_last=True)
    asked = []
    for n in (1, 2):
        before = step([r for p in parts[:n] for r in p])
        history = H.splice(history, step(parts[n]), ["key"], "seq", ["note"], lambda: asked.append(1) or before)
        want = H.scd2(step(sorted({r for p in parts[: n + 1] for r in p}, key=repr)), ["key"], "seq", ["note"], with_last=True)
        assert rows(history) == rows(want.select(*history.columns))
    assert asked


def test_rows_in_order_need_the_open_versions_alone(spark):
    kind = "key string, seq int, state string, note int"
    first = [("a", 1, "x", 1), ("a", 3, "x", 2), ("b", 2, "y", 1)]
    later = [("a", 4, "x", 7), ("a", 6, "z", 1), ("b", 9, "y", 5), ("c", 1, "q", 0)]
    history = H.scd2(spark.createDataFrame(first, kind), ["key"], "seq", ["note"], with_last=True)
    got = H.splice(history, spark.createDataFrame(later, kind), ["key"], "seq", ["note"])
    want = H.scd2(spark.createDataFrame(first + later, kind), ["key"], "seq", ["note"], with_last=True)
    assert rows(got) == rows(want.select(*got.columns))
    with pytest.raises(ValueError, match="late"):
        H.splice(history, spark.createDataFrame(first[:1], kind), ["key"], "seq", ["note"])
