"""Hard negatives, ranked search and URL verdicts against brute force."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeloom.llm import hard_negatives, ranked_search, url_filter
from lakeloom.llm.queries import ORACLE, QUERIES, RULES
from tests.llm.cases import no_rows, odd_documents
from tests.oracle import connect, normal

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["op11_hard_negatives", "op12_ranked_search"])
def test_registered_queries_agree_with_sql(spark, key):
    found = connect(FOLDER).execute(ORACLE[key])
    names = [d[0] for d in found.description]
    df = QUERIES[key](spark, FOLDER)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(names, found.fetchall())


def brute_negatives(table, asks, positives=5, negatives=10):
    """Rows (key, label, vector); ``asks`` says which keys are anchors. Python's whole numbers throughout."""
    clamp = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    fine = [
        (k, lab, [clamp(math.floor(256 * x)) for x in v]) for k, lab, v in table
        if k is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (ak, al, av) in enumerate(fine):
        if not asks(ak):
            continue
        score = {i: sum(x * y for x, y in zip(av, v)) for i, (_, _, v) in enumerate(fine) if len(v) == len(av) and i != a}
        order = sorted(score, key=lambda i: (-score[i], fine[i][0]))
        for p in [i for i in order if fine[i][1] == al][:positives]:
            hard = [i for i in order if fine[i][1] != al and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:negatives]
            out += [(ak, fine[p][0], r, fine[i][0], clamp(score[p]), clamp(score[i])) for r, i in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("block, tile, step", [(16, 2, 3), (4096, 256, 8)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, block, tile, step):
    for name, size in (("BLOCK", block), ("TILE", tile), ("STEP", step)):
        monkeypatch.setattr(hard_negatives, name, size)
    r = np.random.default_rng(5)
    centres = r.normal(size=(4, 12))
    rows = [(i, int(r.integers(3)), (centres[r.integers(4)] + r.normal(scale=0.6, size=12)).tolist()) for i in range(150)]
    rows += [(200 + i, i % 3, [round(float(x), 1) for x in r.normal(size=12)]) for i in range(20)] + rows[:6] + [(500 + i, i % 2, rows[0][2]) for i in range(30)]
    rows += [(600, 1, [1.0, 2.0]), (601, 1, [2.0, 2.0]), (602, 0, [1.0, 1.0]), (610, 0, []), (611, 0, []), (612, 1, []), (620, 2, [0.0] * 12)]
    rows += [(None, 1, [1.0] * 12), (700, None, [1.0] * 12), (710, 1, None), (720, 1, [None] + [1.0] * 11), (730, 1, [float("nan")] * 12), (740, 2, [float("inf")] * 12)]
    rows += [(800 + i, i % 2, [1e18 * (1 + i), 3.0, -2.5]) for i in range(8)]
    table = spark.createDataFrame([(*x, None) for x in rows], "vec_id long, label int, embedding array<double>, tile int")
    got = hard_negatives.mine(table, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, lambda k: k % 10 == 0)
    assert len(want) > 400 and sorted(tuple(x) for x in got.collect()) == want
    assert hard_negatives.mine(no_rows(table), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives.mine(table, F.lit(None).cast("boolean")).collect() == []


def test_bounds_leave_only_what_can_matter():
    """Candidates at the end hold every answer, and the bounds let go of most others."""
    r = np.random.default_rng(2)
    q, columns = r.normal(size=64) * np.linspace(3, 0.01, 64), r.normal(size=(64, 2000))
    score, low, high = q @ columns, columns.min(1), columns.max(1)
    at, left = hard_negatives.scan(columns, low, high, q, np.arange(2000), hard_negatives.among_first(5))
    assert set(np.argsort(-score)[:5]) <= set(at) and len(at) < 100 and np.allclose(score[at], left)
    least, most = np.sort(score)[1500], np.sort(score)[1700]
    at, _ = hard_negatives.scan(columns, low, high, q, np.arange(2000), hard_negatives.inside([(least, most)], 10))
    inside = np.flatnonzero((score >= least) & (score <= most))
    assert set(inside[np.argsort(-score[inside])][:10]) <= set(at) and len(at) < 200


def broadcast_bytes(df):
    """Bytes that running the frame sends through the driver."""
    run = df._jdf.queryExecution()
    run.toRdd().count()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "BroadcastExchangeExec":
            return node.metrics().apply("dataSize").value()
        inner = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
        return sum(map(walk, inner))

    return walk(run.executedPlan())


def test_anchors_pass_the_driver_once(spark, monkeypatch):
    """What is broadcast does not grow with the number of blocks."""
    sent, plain = [], hard_negatives.map_batches
    monkeypatch.setattr(hard_negatives, "map_batches", lambda df, *a, **b: sent.append(broadcast_bytes(df)) or plain(df, *a, **b))
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    r = np.random.default_rng(8)
    rows = [(i, i % 2, r.normal(size=32).tolist()) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(table, F.col("vec_id") % 10 == 0)
    assert got.select("anchor_id").distinct().count() == 300 and len(sent) > 2
    # 300 anchors are 0.1 MB, beside 375 blocks they would be 40; a table of keys alone takes a few.
    assert max(sent) < 8e6


def test_chunks_of_anchors_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(9)
    rows = [(i, f"l{r.integers(3)}", r.normal(size=6).round(1).tolist()) for i in range(200)]
    rows += rows[:10] + [(300 + i, "l0", [1e6 * (i - 4), 2.0, 1.0, 0.0, 0.0, 3.0]) for i in range(8)] + [(400 + i, "l1", [1e5 * i, 1e4]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    for name, size in (("BLOCK", 16), ("TILE", 5), ("CHUNK", 20_000)):
        monkeypatch.setattr(hard_negatives, name, size)
    got = [tuple(x) for x in hard_negatives.mine(table, F.col("vec_id") % 5 == 0).collect()]
    assert len(got) > 500 and sorted(got) == brute_negatives(rows, lambda k: k % 5 == 0)


@pytest.mark.parametrize("scale", [1, 1 << 12, 1 << 40])
def test_groups_keep_the_best_of_all_blocks(monkeypatch, scale):
    """Over several blocks, in single and double precision and Python's whole numbers; with columns that fade, few anchors read the last ones."""
    alone, plain = [], hard_negatives.scan
    monkeypatch.setattr(hard_negatives, "scan", lambda columns, *a: alone.append(len(columns)) or plain(columns, *a))
    r = np.random.default_rng(10)
    n, d, k, anchors = 3000, 32, 2, 24
    codes = (r.normal(size=(n, d)) * 100 * 0.7 ** np.arange(d)).astype(np.int64)
    codes[100:110] = codes[50]
    codes *= np.where(np.arange(d) < 2, scale, 1)
    label, key = r.integers(0, 3, n), r.permutation(n) // 2
    score = [[sum(x * y for x, y in zip(a, b)) for b in codes.tolist()] for a in codes[:anchors].tolist()]

    def best(a, fits, least, most):
        order = sorted((i for i in range(n) if fits[i] and least <= score[a][i] <= most), key=lambda i: (-score[a][i], key[i], i))
        return [(i, key[i], score[a][i]) for i in order[:k]]

    windows = [[(max(s) * 3 // 10, max(s) * 9 // 10), (max(s) // 5, max(s) * 85 // 100)] for s in score]
    for same in (True, False):
        arr = pa.array([{"rid": i, "key": int(key[i]), "codes": codes[i].tolist()} for i in range(anchors)], pa.struct([("rid", pa.int64()), ("key", pa.int64()), ("codes", pa.list_(pa.int64()))]))
        ends = [[(-math.inf, math.inf)] for _ in range(anchors)] if same else windows
        least, most = (np.array([[w[e] for w in each] for each in ends], object).astype(float if scale == 1 else object) for e in (0, 1))
        group = hard_negatives.Group(arr, least, most, k)
        for first in range(0, n, 60):
            at = slice(first, first + 60)
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (np.arange(first, first + 60), key[at], label[at])]
            packed = pa.array([[hard_negatives._packed(c) for c in codes[at].T]], pa.list_(pa.binary()))
            block = hard_negatives.Block(pa.RecordBatch.from_arrays([*lists, packed], ["rid", "key", "label", "columns"]), 0)
            group.read(block, (label[:anchors, None] == label[at]) == same)
        got = list(zip(*(x.tolist() for x in group.found()[:2]), *(list(x) for x in group.found()[2])))
        clamp = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
        want = [(a, w, i, kk, clamp(s)) for a in range(anchors) for w, e in enumerate(ends[a]) for i, kk, s in best(a, ((label == label[a]) == same) & (np.arange(n) != a), *e)]
        assert got == want
    assert alone and all(x < d for x in alone) == (scale < 1 << 40)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_ranks(docs, items, k):
    counted = [(key, Counter(TERM.findall((t or "").translate(LOWER)))) for key, t in docs]
    counted = [(key, c) for key, c in counted if c]
    n, words, df = len(counted), sum(c.total() for _, c in counted), Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for key, c in counted:
            m = 50 + 50 * c.total() * n // words
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            scored.append((score, key))
        best = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, r, key, score) for r, (score, key) in enumerate(best, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("columns, step, tile", [(5, 2, 3), (4096, 512, 256)])
def test_ranks_against_brute_force(spark, monkeypatch, columns, step, tile):
    for name, size in (("COLUMNS", columns), ("STEP", step), ("TILE", tile)):
        monkeypatch.setattr(ranked_search, name, size)
    r = random.Random(3)
    words = ["alpha", "beta", "Gamma", "ÉTÉ", "été", "x1", "the", "the", "the", "你好", "ab"]
    docs = [(i, r.choice([" ", "-", "_", "\n"]).join(r.choice(words) for _ in range(r.randint(0, 40)))) for i in range(120)]
    docs += [(300 + i, "alpha beta the") for i in range(40)] + docs[:5] + [(None, "beta gamma x1")] + [(d.doc_id, d.text) for d in odd_documents(spark).collect()]
    items = [(1, "ALPHA beta"), (1, "ALPHA beta"), (2, "The the été"), (3, None), (4, "nowhere"), (5, "x1 你好 ab"), (None, "gamma"), (6, "..."), (7, "word one a")]
    frame = spark.createDataFrame([(*d, None) for d in docs], "doc_id long, text string, score double")
    asked = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, rank int")
    got = ranked_search.rank(frame, asked, k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute_ranks(docs, items, 7)
    assert ranked_search.rank(no_rows(frame), asked).collect() == [] and ranked_search.rank(frame, no_rows(asked)).collect() == []


def test_tree_finds_the_best_columns():
    """Quarters and maxima against a dense grid; the search against all scores."""
    r = np.random.default_rng(4)
    for lines, columns in ((1, 1), (1, 9), (13, 1), (37, 300)):
        dense = np.where(r.random((lines, columns)) < 0.2, r.integers(1, 50, (lines, columns)), 0)
        dense[0, 0] = 3
        line, column = np.nonzero(dense)
        tree = ranked_search.Tree.build(line, column, dense[line, column])
        assert tree.peak[1] == dense.max() and len(tree.peak) == len(tree.quarters)
        for k, size in itertools.product((1, 5), (1, 7)):
            rows, weights = r.choice(lines, min(size, lines), replace=False), r.integers(0, 30, min(size, lines))
            score = weights @ dense[rows]
            place, found = tree.best(rows, weights, k)
            bar = max(1, np.sort(score)[-k] if columns >= k else 1)
            assert dict(zip(place.tolist(), found.tolist())) == {c: s for c, s in enumerate(score) if s >= bar}


def test_parts_of_urls(spark):
    urls = [
        "https://WWW.Ex-ample.NET:80/en/A?x=/de/#f", "http://a.org/fr/1", "http://borg/fr/1", "net", "x://net/", "x://net", "http://example.com/de/?q", "http://sub.example.com/de/",
        "http://a.example.net/en/2", "http://notexample.net/en/", "a://b?c://d/e", "a://ÄB#/x", "://", "", None, "http://n.net?/x", "one\ntwo://h\nh/p\nq",
    ]
    made = spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_filter.host_of(F.col("url")).alias("h"), url_filter.path_of(F.col("url")).alias("p"))
    made = made.withColumn("fit", url_filter.rule_for(F.col("h"), F.col("p"), RULES)).collect()
    for r in made:
        rest = (r.url or "").partition("://")[2] if "://" in (r.url or "") else ""
        host = re.split("[/?#]", rest)[0]
        assert r.h == host.translate(LOWER) and r.p == re.split("[?#]", rest[len(host) :])[0]
        fits = [(len(t), t, v) for t, v in RULES if (r.h == t.split("/")[0] or r.h.endswith("." + t.split("/")[0])) and r.p.startswith(t[t.index("/") :])]
        assert (tuple(r.fit[n] for n in ("size", "rule", "verdict")) if r.fit else None) == max(fits, default=None)


def test_names_are_split_at_least_cost():
    """Against all ways to cut a name."""
    known = {"free": 3.0, "casino": 4.0, "casinos": 6.5, "sin": 3.5, "o": 2.0, "bet": 3.1, "bets": 3.2, "ca": 5.0, "s": 2.5}

    def cost(parts):
        return sum(known[p] if p in known else 9.0 + url_filter.UNKNOWN * len(p) for p in parts)

    for name in ("freecasinobets", "casinos", "xyzbet", "betsxq", "qq", "s", "ocasinxo"):
        words = [(-1, 0, 9.0)] + [(i, len(w), c) for w, c in known.items() for i in range(len(name)) if name.startswith(w, i)]
        found = url_filter.split_name(name, words)
        ways = []
        for cuts in itertools.product((0, 1), repeat=len(name) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(name)]
            ways.append([name[a:b] for a, b in zip(at, at[1:])])
        assert "".join(found) == name and cost(found) == pytest.approx(min(map(cost, ways)))
    assert url_filter.split_name("freecasinobets", [(-1, 0, 9.0), (0, 4, 3.0), (4, 6, 4.0), (10, 4, 3.2), (10, 3, 3.1)]) == ["free", "casino", "bets"]


def test_verdicts_follow_the_words(spark):
    r = random.Random(6)
    parts = ["green", "garden", "house", "river", "music", "daily", "news"]
    rows = [(i, f"http://{r.choice(parts)}{r.choice(parts)}.com/{r.choice(parts)}/{i}") for i in range(300)]
    rows += [(1000 + i, f"https://{r.choice(['best', 'win'])}{r.choice(['casino', 'poker'])}{r.choice(['slots', ''])}.com/slots/{i}") for i in range(40)]
    rows += [(2000, "http://greenslots.com/slots/"), (2001, "http://housenews.org/fr/x"), (2002, None), (2003, "no url"), (None, "http://musicdaily.com"), (2002, None), (2004, "http://x" + "ab" * 4000 + ".com/")]
    pages = spark.createDataFrame([(*x, 1, 2.0) for x in rows], "page_id long, url string, words int, score double")
    texts = spark.createDataFrame([(" ".join(parts * 5 + ["best", "slots", "win"] * 4),), (None,), ("",)], "text string")
    got = url_filter.judge(pages, texts, RULES)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    by = {}
    for x in got.collect():
        by.setdefault(x.page_id, []).append(x)
    assert sum(map(len, by.values())) == len(rows) and len(by[2002]) == 2
    assert all(by[i][0].verdict == "allow" for i in range(300)) and all(by[1000 + i][0].verdict == "block" for i in range(40))
    assert by[2000][0].verdict == "block" and (by[2001][0].rule, by[2001][0].verdict) == ("org/fr/", "allow")
    assert {(x.host, x.path, x.rule, x.verdict) for x in by[2002] + by[2003]} == {("", "", None, "allow")} and by[None][0].verdict == "allow"
    assert url_filter.judge(no_rows(pages), texts, RULES).collect() == []
    assert {x.verdict for x in url_filter.judge(pages, no_rows(texts), (), seeds=("nothing",)).collect()} == {"allow"}


def test_odds_against_plain_counts(spark):
    rows = [(i, ["a", "b"] * (i % 3) + (["bad"] if i % 5 == 0 else ["c"]) + [f"w{i % 7}"]) for i in range(60)]
    df = spark.createDataFrame([*rows, (99, [])], "i long, tokens array<string>")
    model = url_filter.learn(df, "tokens", F.array_contains("tokens", "bad"))
    bad, every = Counter(), Counter()
    for i, tokens in rows:
        at = [(lambda h: (h - (1 << 64) if h >> 63 else h) % url_filter.BUCKETS)(xxhash.xxh64_intdigest(t, 42)) for t in tokens]
        every.update(at)
        bad.update(at if i % 5 == 0 else ())
    share = bad.total() / every.total()
    assert model[0] == pytest.approx(math.log(12 / 49))
    for b, n in every.items():
        assert model[1][b] == pytest.approx(math.log((bad[b] + 1) / (n * share + 1)) - math.log((n - bad[b] + 1) / (n - n * share + 1)))
    got = {r.i: r.s for r in df.withColumn("s", url_filter.odds(F.col("tokens"), model)).collect()}
    assert got[99] == pytest.approx(model[0], abs=1e-6) and got[0] > 0 > got[1]


def test_query_judges_every_page(spark):
    got = QUERIES["op13_url_filter"](spark, FOLDER).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages) and {r.verdict for r in got} == {"allow", "block"}
    for r in got:
        assert pages[r.page_id].partition("://")[2].lower().startswith(r.host + r.path)
