"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from lakeloom.llm import graph, simhash
from tests.llm.cases import no_rows, odd_documents


def plain_fingerprint(text, width=4):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, radius):
    parent = {i: i for i in range(len(fps))}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(ids))]


def texts(n, seed=3):
    """Base texts, exact copies, and copies with a word or two changed."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    made = []
    while len(made) < n:
        base = [r.choice(words) for _ in range(r.randint(1, 160))]
        for _ in range(r.choice((1, 1, 2, 6))):
            copy = list(base)
            for _ in range(r.randint(0, 2)):
                copy[r.randrange(len(copy))] = r.choice(words)
            made.append(" ".join(copy))
    return made[:n]


@pytest.mark.parametrize("text", ["", None, "  ", "One", "A b\tC", "a b c d e\n\x0bF g", "é É x y z", "to be or not to be " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_near_finds_every_pair(radius):
    r = np.random.default_rng(radius)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.array([sum(1 << int(k) for k in r.choice(64, int(r.integers(0, 10)), replace=False)) for _ in range(200)], np.uint64)
    values = np.unique(np.concatenate([base, r.choice(base, 200) ^ flips]))
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(values)] = values
    lanes = np.packbits(np.arange(words * 64) < len(values), bitorder="little").view(np.uint64)
    a, b = simhash.near(padded, np.repeat(values, words), np.tile(np.arange(words), len(values)), lanes, radius)
    want = {(int(x), int(y)) for x in values for y in values if x != y and bin(int(x) ^ int(y)).count("1") <= radius}
    assert {(int(x), int(y)) for x, y in zip(a, b)} == want


@pytest.mark.parametrize("tile", [8, 2048])
def test_components_of_documents(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash.links, "__defaults__", (4, tile))
    made = texts(300)
    ids = [i * 7 % 1009 for i in range(len(made))]
    docs = spark.createDataFrame(list(zip(ids, made)), "doc_id long, text string")
    got = simhash.near_duplicates(docs).collect()
    fps = [plain_fingerprint(t) for t in made]
    assert len(got) == len(made)
    assert {(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got} == set(zip(ids, fps, plain_components(ids, fps, 4)))
    kept = {r.doc_id for r in simhash.deduplicate(docs).collect()}
    assert kept == set(plain_components(ids, fps, 4))


def test_more_equal_blocks_find_the_same(spark, monkeypatch):
    made = texts(200, 9)
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    plain = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    monkeypatch.setattr(simhash, "equal_blocks", lambda *a: 3)
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()} == plain
    monkeypatch.undo()
    assert [simhash.equal_blocks(n, 4) for n in (10, 1 << 23, 1 << 25, 1 << 33, 1 << 60)] == [1, 1, 2, 3, 4]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = simhash.near_duplicates(docs).collect()
    source = docs.collect()
    assert len(got) == len(source)
    empty = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.component_id for r in empty} == {3} and len(empty) == 5
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 6, 7, 8, 9, 10]
    assert simhash.near_duplicates(no_rows(docs)).collect() == [] and simhash.deduplicate(no_rows(docs)).collect() == []


def test_components_of_links(spark):
    r = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(200, i) for i in range(201, 260)]
    some = [(r.randrange(300, 500), r.randrange(300, 500)) for _ in range(150)]
    pairs = chain + star + some + [(7, 7), (9, 8), (8, 9)]
    got = {tuple(x) for x in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {(i, find(i)) for i in list(parent)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []
