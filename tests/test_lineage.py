import datetime as dt
import random

import pytest

from lakeloom.operators import lineage as L
from tests.helpers import rows

DAY = dt.date(2024, 5, 2)


def log(spark, *edges, day=DAY):
    """Edge log from (source, target) or (source, target, date)."""
    data = [(s, t, *(d or (day,)), dt.datetime(2024, 5, 2)) for s, t, *d in edges]
    return spark.createDataFrame(
        data,
        "source_table_full_name string, target_table_full_name string, event_date date, event_time timestamp",
    )


def test_latest_edges_drop_what_is_not_lineage(spark):
    old = dt.date(2024, 5, 1)
    edges = log(
        spark,
        ("c.s.a", "c.s.b"),
        ("c.s.a", "c.s.b"),
        ("c.s.old", "c.s.b", old),
        (None, "c.s.b"),
        ("c.s.b", "c.s.b"),
        ("c.s.__materialization_x", "c.s.b"),
        ("c.s.xymaterializationQ1", "c.s.b"),
        ("short", "c.s.b"),
        ("c.s.z", "c.s.d", old),
        (None, "c.s.d"),
    )
    assert rows(L.latest_edges(edges)) == [("c.s.a", "c.s.b")]


def test_prefix_with_dot_leaves_out_longer_catalogs(spark):
    edges = log(spark, ("x.s.a", "dev.s.b"), ("x.s.a", "dev2.s.b"))
    assert len(rows(L.latest_edges(edges, prefix="dev."))) == 1
    assert len(rows(L.latest_edges(edges, prefix="dev"))) == 2


def test_stages_leave_out_short_ancestries(spark):
    edges = log(spark, ("c.s.a", "c.s.b"), ("c.s.b", "c.s.d"), ("c.s.e", "c.s.f"))
    got = L.table_stages(edges, 2)
    assert rows(got.select("stage_2", "stage_1", "stage_0")) == [("c.s.a", "c.s.b", "c.s.d")]
    assert got.columns[3:6] == ["0_catalog", "0_schema", "0_table"]
    assert len(rows(L.table_stages(edges, 1))) == 3


def test_recursion_survives_cycles_and_stops_at_the_depth(spark):
    chain = [(f"c.s.t{i + 1}", f"c.s.t{i}") for i in range(6)]
    edges = log(spark, *chain, ("c.s.t0", "c.s.t3"), ("c.s.__materialization_mat_1", "c.s.t0"), ("c.s.t0", "c.s.t0"))
    whole = L.recursive_lineage(edges, "c.s.t0", 10)
    assert len(rows(whole)) == 7
    # The start has depth 0; tables up to the depth have their edges listed.
    assert len(rows(L.recursive_lineage(edges, "c.s.t0", 0))) == 1
    assert len(rows(L.recursive_lineage(edges, "c.s.t0", 2))) == 3


@pytest.mark.parametrize("levels", [1, 2, 3, 20])
def test_rounds_of_any_size_find_the_same(spark, levels):
    rng = random.Random(11)
    pairs = {(f"t{rng.randint(0, 40)}", f"t{rng.randint(0, 40)}") for _ in range(55)}
    edges = log(spark, *pairs)
    for depth in (0, 1, 2, 4, 9):
        known, frontier = {"t1"}, {"t1"}
        for _ in range(depth):
            frontier = {s for s, t in pairs if t in frontier and s != t} - known
            known |= frontier
        expected = sorted((s, t) for s, t in pairs if t in known and s != t)
        got = L.recursive_lineage(edges, "t1", depth, levels_per_round=levels)
        assert rows(got.select(L.SOURCE, L.TARGET)) == expected


def test_recursion_reads_the_newest_date_of_the_log(spark):
    edges = log(spark, ("c.s.a", "c.s.b", dt.date(2024, 1, 1)), ("c.s.x", "c.s.y"))
    assert rows(L.recursive_lineage(edges, "c.s.b")) == []
    assert len(rows(L.recursive_lineage(edges, "c.s.b", day=dt.date(2024, 1, 1)))) == 1
    with pytest.raises(ValueError):
        L.recursive_lineage(edges.limit(0), "c.s.b")


def test_simple_paths(spark):
    edges = log(spark, ("a", "b"), ("b", "c"), ("x", "c"), ("c", "x"))
    # x only leads back to c, so that branch disappears.
    assert rows(L.simple_paths(edges, "c", 4)) == [("a", "b", "c", None, None, 1)]
    # A path that still grows after the last round is dropped.
    assert rows(L.simple_paths(edges, "c", 2)) == []
    assert rows(L.simple_paths(edges, "a", 2)) == [("a", None, None, 1)]


def test_left_paths_pad_at_the_front_and_follow_cycles(spark):
    edges = log(spark, ("a", "b"), ("b", "c"), ("x", "c"), ("c", "x"))
    got = rows(L.left_paths(edges, "c", 3))
    assert got == [("b", "c", "x", "c", 1), ("x", "c", "x", "c", 1), (None, "a", "b", "c", 1)]


def test_all_paths_cover_every_target(spark):
    edges = log(spark, ("k.s.a", "k.s.b"), ("k.s.b", "k.s.c"), ("k.s.a", "other.s.z"))
    got = rows(L.all_paths(edges, "k.", 2).select("stage_0", "stage_1", "stage_2", "target_catalog", "target_schema"))
    assert got == [("k.s.a", "k.s.b", "k.s.c", "k", "s"), (None, "k.s.a", "k.s.b", "k", "s")]


def test_paths_hold_only_edges_of_the_recursion(spark):
    edges = log(spark, ("a", "b"), ("b", "d"), ("a", "c"), ("c", "d"), ("z", "a"))
    closure = {r[:2] for r in rows(L.recursive_lineage(edges, "d", 5).select(L.SOURCE, L.TARGET))}
    for path in rows(L.simple_paths(edges, "d", 5)):
        names = [n for n in path[:-1] if n]
        assert set(zip(names, names[1:])) <= closure


def test_flow_numbers_and_colours(spark):
    edges = log(spark, ("c.Bronze.a", "c.silver.b"), ("c.Bronze.a", "c.silver.b"), ("c.silver.b", "c.gold.x"), ("q.w.e", "c.gold.x"))
    got = L.flow(edges)
    numbers = {r[0] for r in rows(got.select("source"))} | {r[0] for r in rows(got.select("target"))}
    assert numbers == {0, 1, 2, 3}
    colours = dict((r[0], r[1]) for r in rows(got.select("source_label", "source_colour")))
    assert colours == {"a": "#cd7f32", "b": "#c0c0c0", "e": "#a9a9a9"}
    assert {r for r in rows(got.select("source_label", "value"))} == {("a", 2), ("b", 1), ("e", 1)}


def test_newest_rows_of_target_counts_all_types(spark):
    edges = log(spark, ("a", "b", dt.date(2024, 1, 1)), ("c", "b")).selectExpr(
        "*", "if(source_table_full_name = 'a', 'PIPELINE', 'JOB') AS entity_type"
    )
    assert rows(L.newest_rows_of(edges, "b")) == []
    assert len(rows(L.newest_rows_of(edges, "b", "JOB"))) == 1


def test_nothing_stays_cached_and_scratch_is_cleared(spark, monkeypatch):
    import os

    from lakeloom import session
    from lakeloom.operators import lineage
    from lakeloom.session import clear_scratch, scratch

    edges = spark.createDataFrame([("c.a.x", "c.b.y", "2024-01-01")], "source_table_full_name string, target_table_full_name string, event_date string")
    edges = edges.withColumn("event_date", edges.event_date.cast("date"))
    cached = lambda: set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    before = cached()
    assert lineage.latest_edges(edges).count() == 1
    assert cached() == before
    monkeypatch.setattr(session, "_NAMED", {})
    path = scratch(spark, "x")
    edges.write.parquet(path)
    assert clear_scratch(spark) >= 1 and not os.path.exists(path) and clear_scratch(spark) == 0
