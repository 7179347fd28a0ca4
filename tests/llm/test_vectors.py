"""Sharding and embedding near-duplicates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import embeddings, sharding
from lakeloom.llm.queries import QUERIES
from tests.helpers import plan
from tests.llm.cases import no_rows, odd_documents


def test_growing_moves_rows_only_into_the_new_shard(spark):
    keys = spark.range(20_000)
    for weights in ([1.0] * 8, [1.0, 3.0, 0.5]):
        n = len(weights)
        got = keys.select(sharding.rendezvous(F.col("id"), weights).alias("a"), sharding.rendezvous(F.col("id"), [*weights, 2.0]).alias("b"))
        tally = {(r.a, r.b): r["count"] for r in got.groupBy("a", "b").count().collect()}
        assert all(b in (a, n) for a, b in tally)
        moved = sum(c for (_, b), c in tally.items() if b == n)
        assert moved / 20_000 == pytest.approx(2 / (sum(weights) + 2), abs=0.02)
        for shard, w in enumerate(weights):
            assert sum(c for (a, _), c in tally.items() if a == shard) / 20_000 == pytest.approx(w / sum(weights), abs=0.02)
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [1.0, 0.0])


def test_slots_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    docs = odd_documents(spark)
    many = docs.union(docs.filter("doc_id = 1").crossJoin(spark.range(100)).drop("id"))
    got = sharding.shards(many).collect()
    assert len(got) == many.count()
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert {r.size for r in got if r.doc_id in (3, 4, 11)} == {1} and {r.text_crc32 for r in got if r.doc_id in (3, 4, 11)} == {0}
    assert sharding.shards(no_rows(docs)).collect() == []


def test_shards_stay_in_the_engine(spark):
    text = plan(sharding.shards(odd_documents(spark)))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text


def brute(keys, vectors, labels, cosine):
    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / max(map(abs, v))
        return v / np.linalg.norm(v)

    units = [unit(v) for v in vectors]
    n = len(keys)
    link = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and labels[i] is not None and labels[i] == labels[j]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((keys[j] for j in seen if keys[j] is not None), default=None)
        out.append((keys[i], len(link[i]), least, keys[i] == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [16, 1024])
def test_links_against_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", tile)
    r = np.random.default_rng(7)
    vectors = []
    for _ in range(40):
        base = r.normal(size=16)
        vectors += [(base * r.uniform(0.5, 2) + r.normal(scale=s, size=16)).tolist() for s in r.choice([0.02, 0.1, 0.3], r.integers(1, 12))]
    hot = r.normal(size=16)
    vectors += [(hot + r.normal(scale=0.03, size=16)).tolist() for _ in range(60)] + [hot.tolist()] * 30
    vectors += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e-200] * 2, [3.0], [5.0], [-1.0]]
    keys = [*random.Random(1).sample(range(5000), len(vectors) - 1), None]
    labels = [None if i % 29 == 0 else i % 2 for i in range(len(vectors))]
    table = spark.createDataFrame(list(zip(keys, vectors, labels, range(len(keys)))), "vec_id long, embedding array<double>, label int, n int")
    got = sorted((tuple(x) for x in embeddings.near_duplicates(table).collect()), key=repr)
    want = brute(keys, vectors, labels, 0.98)
    assert got == [(k, n, c, k == c) for k, n, c, _ in want]
    assert embeddings.near_duplicates(no_rows(table)).collect() == []


def test_registered_query_meets_partners_of_low_rank(spark, tmp_path):
    """64 dimensions, all differences in two of them: steps run straight across the borders of cells."""
    angles = np.random.default_rng(6).uniform(0, 2 * np.pi, 400)
    vectors = np.zeros((400, 64))
    vectors[:, 3], vectors[:, 5] = np.cos(angles), np.sin(angles)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted((tuple(x) for x in QUERIES["op7_embedding_near_dedup"](spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(range(400), list(vectors), [1] * 400, 0.98)


def test_walk_is_ordered_and_complete():
    r = np.random.default_rng(3)
    a, b = r.random(9), r.random(7)
    cells = list(embeddings.walk(a, b, 0.5))
    assert [c for *_, c in cells] == sorted(c for *_, c in cells)
    assert {(i, j) for i, j, _ in cells} == {(i, j) for i in range(9) for j in range(7) if a[i] ** 2 + b[j] ** 2 <= 0.5}


def test_bounds_never_exceed_the_distance():
    r = np.random.default_rng(4)
    points, others, book = r.normal(size=(50, 6)), r.normal(size=(80, 6)), r.normal(size=(10, 6))
    bound = embeddings.regions(points, book)[1]
    home = embeddings.regions(others, book)[0]
    far = np.sqrt(((points[:, None] - others[None]) ** 2).sum(2))
    assert (bound[:, home] <= far + 1e-9).all()


def test_lower_recall_stops_earlier(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(200, 16))
    table = np.concatenate([base, base + r.normal(scale=0.1, size=base.shape)])
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(table)], "vec_id long, embedding array<double>, label int")
    whole = sum(x.n_links for x in embeddings.near_duplicates(frame).collect())
    part = sum(x.n_links for x in embeddings.near_duplicates(frame, recall=0.9).collect())
    assert whole * 0.85 <= part <= whole and whole > 200
