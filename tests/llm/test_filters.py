"""Toxicity, quality rules and the quality classifier."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from lakeloom.llm import quality_classifier, quality_rules, toxicity
from tests.llm.cases import labels, no_rows, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus(spark):
    """600 documents; those divisible by 6 hold an insult, half of them in disguise; those with remainder 1 are junk."""
    r = random.Random(1)
    parts = "the and of in ing er tion an re on at en es or it is ed nd th ha st".split()
    insults = ["idiot", "moron", "loser", "stupid"]
    disguise = {"idiot": "1d10t", "moron": "m o r o n", "loser": "l0s3r", "stupid": "st.u.p.i.d"}
    docs, marks = [], []
    for i in range(600):
        words = ["".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(r.randint(60, 120))]
        if i % 6 == 0:
            w = r.choice(insults)
            words[r.randrange(len(words))] = disguise[w] if i % 12 == 0 and i > 300 else w
        if i % 6 == 1:
            words = [w + "###" if r.random() < 0.8 else w.upper() for w in words]
        docs.append((i, " ".join(words)))
        marks.append((i, int(i % 6 != 1), int(i % 6 == 0)))
    frames = spark.createDataFrame(docs, "doc_id long, text string").cache(), labels(spark, marks).cache()
    yield frames
    for frame in frames:
        frame.unpersist(True)


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.learn(*corpus)


def test_disguised_words_are_restored(model):
    costs = model.costs.tolist()
    for seen, meant in {"1d10t": "idiot", "l0s3r": "loser", "$tupid!!": "stupid", "i d i o t": "idiot", "st.u.p.i.d": "stupid", "idioooot": "idiot"}.items():
        assert toxicity.restore(seen, costs) == meant
    assert toxicity.restore("The, (and) of.", costs) == "the and of"
    assert toxicity.restore("2024 *** 你", costs) == "你"


def test_signs_at_edges_letterless_and_doubled_words_are_read(spark):
    docs = spark.createDataFrame([(i, "ass snake idiot tits bass pass glass a letter class") for i in range(20)], "doc_id long, text string")
    costs = toxicity.character_costs(docs).tolist()
    for seen, meant in {"a$$": "ass", "$$nake": "snake", "455": "ass", "4$$": "ass", "@$$": "ass", "71+5": "tits", "iiddiioott": "idiot"}.items():
        assert meant in toxicity.readings(seen, costs), seen
    for seen, meant in {"snake$$$": "snake", "idiot!!": "idiot", "letter": "letter", "class": "class"}.items():
        assert meant in toxicity.readings(seen, costs), seen
    assert toxicity.readings("2024", costs) == toxicity.readings("$$$", costs) == () and toxicity.readings("你你", costs) == ("你你",)


def test_cheapest_path_of_the_lattice(model):
    """Viterbi against all paths."""
    costs = model.costs.tolist()

    def all_paths(line, at=0):
        if at == len(line):
            yield "", 0.0
            return
        for read, written, cost in toxicity.arcs(line, at):
            for rest, more in all_paths(line, at + read):
                yield written + rest, cost + more

    def total(text, channel):
        a = b = toxicity.EDGE
        for c in " ".join(text.split(" ")) + " ":
            code = toxicity.EDGE if c == " " else toxicity.CODE.get(c, toxicity.OTHER)
            channel += costs[(a * toxicity.SIZE + b) * toxicity.SIZE + code]
            a, b = (toxicity.EDGE, toxicity.EDGE) if c == " " else (b, code)
        return channel

    for line in ("1d0", "a.b1", "ooo!t", "5ee", "x-1"):
        paths = [p for p in all_paths(line) if not p[0].startswith(" ") and "  " not in p[0] and not p[0].endswith(" ") and p[0]]
        best = min(total(*p) for p in paths)
        found = toxicity.decode(line, costs)
        assert min(total(t, c) for t, c in paths if t == found) == pytest.approx(best)


def test_toxic_documents_score_high(corpus, model):
    docs, marks = corpus
    got = {r.doc_id: r for r in toxicity.score(docs, model).withColumn("h", toxicity.held_out(docs.doc_id)).collect()}
    held = [r for r in got.values() if r.h]
    assert len(held) > 100 and all(0 <= r.score <= 1 for r in held)
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 6 == 0) for r in held]) > 0.97
    left = {r.doc_id for r in toxicity.clean(docs, marks).collect()}
    assert left == {i for i, r in got.items() if r.score < 0.3}


def test_held_out_labels_are_never_used(spark, corpus):
    docs, marks = corpus
    flipped = marks.withColumn("toxic", toxicity.F.when(toxicity.held_out(marks.doc_id), 1 - marks.toxic).otherwise(marks.toxic))
    assert toxicity.learn(docs, flipped).weights == toxicity.learn(docs, marks).weights


def test_odd_rows_of_toxicity(spark):
    docs = odd_documents(spark)
    for rows, marks in ((docs, labels(spark)), (docs, no_rows(labels(spark))), (no_rows(docs), labels(spark))):
        model = toxicity.learn(rows, marks)
        assert toxicity.score(rows, model, name="s").count() == rows.count()
        kept = toxicity.clean(rows, marks)
        assert kept.columns == docs.columns and kept.count() == rows.count()


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def brute_ratios(docs, trusted):
    """Bucket -> ratio, from {doc_id: text} rows and trusted keys."""

    def long(*words):
        seed = 42
        for w in words:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) % quality_rules.BUCKETS

    raw, good, grams = Counter(), Counter(), {}
    for key, text in docs:
        w = WORD.findall(text or "")
        own = [long(x) for x in w] + [long(x, y) for x, y in zip(w, w[1:])]
        grams[key] = own
        raw.update(own)
        if key in trusted:
            good.update(own)
    n = quality_rules.BUCKETS
    t, r = sum(good.values()) + n, sum(raw.values()) + n
    ratio = {b: round(math.log((good[b] + 1) / t) - math.log((raw[b] + 1) / r), 6) for b in range(n)}
    return {k: sum(ratio[b] for b in own) / len(own) if own else 0.0 for k, own in grams.items()}


def test_quality_rules_against_brute_force(corpus):
    docs, marks = corpus
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ratios = brute_ratios(rows, {r.doc_id for r in marks.collect() if r.quality == 1})
    got = {r.doc_id: r for r in quality_rules.judge(docs, marks).collect()}
    for key, text in rows:
        r, (n, *_, repeat) = got[key], brute_measures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(text)
        assert r.ratio == pytest.approx(ratios[key], abs=1e-9)
        failed = n < 50 or 100 * repeat > 50 * n
        assert r.base_failed == failed and r.kept == (not failed and ratios[key] >= quality_rules.THRESHOLD)
    assert all(got[i].kept == (i % 6 != 1) for i in got)
    assert {r.doc_id for r in quality_rules.accepted(docs, marks).collect()} == {i for i, r in got.items() if r.kept}


def test_every_trusted_document_counts(spark):
    """More trusted documents than any bound; those last in hash order hold words of their own."""
    rows = [(i, f"w{i % 97} x{i // 5000}") for i in range(25_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = docs.selectExpr("doc_id", "int(doc_id % 10 > 0) as quality", "0 as toxic")
    want = brute_ratios(rows, {i for i, _ in rows if i % 10})
    got = {r.doc_id: r.ratio for r in quality_rules.judge(docs, marks).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_repeats_of_many_kinds(spark):
    r = random.Random(4)
    made = [" ".join(r.choice("ab") for _ in range(r.randint(0, 30))) for _ in range(200)]
    made += ["a b c x a b c", "a a a a", "a b\nc\n\nc\nc ", "\n\n", "a\x0bb\x0cc\ra b c", "w " * 5000, "    x"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    for r in quality_rules.judge(docs, labels(spark)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(made[r.doc_id])


def test_repeats_where_hashes_agree(spark, monkeypatch):
    """Hashes of few values: most windows of a group differ, the words decide."""
    few = quality_rules.F.xxhash64
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *c: quality_rules.F.pmod(few(*c), quality_rules.F.lit(7)) * (1 << 50))
    r = random.Random(8)
    made = [" ".join(r.choice("abcd") for _ in range(n)) for n in (3, 10, 40, 90, 300)] + [" ".join(f"w{i}" for i in range(200)), "a b c d e f a b c"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = docs.select("doc_id", quality_rules.repeated_words(quality_rules.words_of(docs.text)).alias("n")).collect()
    assert {x.doc_id: x.n for x in got} == {i: brute_measures(t)[4] for i, t in enumerate(made)}


def test_repeats_of_very_long_texts(spark):
    """3.5 million words: positions leave 42 bits of the hash, so that some different windows agree."""
    words = quality_rules.F.expr("concat(transform(sequence(0, 3500000), i -> concat(prefix, i)), array(concat(prefix, 7), concat(prefix, 8), concat(prefix, 9)))")
    for prefix in ("v", "zz"):
        one = spark.range(1).selectExpr(f"'{prefix}' as prefix").select(words.alias("w"))
        assert one.select(quality_rules.repeated_words(one.w).alias("n")).first().n == 6


def test_odd_rows_of_quality_rules(spark):
    docs = odd_documents(spark)
    for rows, marks in ((docs, labels(spark)), (docs, no_rows(labels(spark))), (no_rows(docs), labels(spark))):
        judged = quality_rules.judge(rows, marks).collect()
        assert len(judged) == rows.count() and not any(r.kept for r in judged if r.n_words < 50)
        assert quality_rules.accepted(rows, marks).columns == docs.columns


def test_classifier_ranks_held_out_documents(corpus):
    docs, marks = corpus
    model = quality_classifier.learn(docs, marks)
    scored = quality_classifier.score(docs, model).withColumn("h", toxicity.held_out(docs.doc_id)).collect()
    held = [r for r in scored if r.h]
    good, bad = [r.score for r in held if r.doc_id % 6 != 1], [r.score for r in held if r.doc_id % 6 == 1]
    assert min(good) >= 0.7 > max(bad)
    flipped = marks.withColumn("quality", toxicity.F.when(toxicity.held_out(marks.doc_id), 1 - marks.quality).otherwise(marks.quality))
    again = quality_classifier.learn(docs, flipped)
    assert np.allclose(again.weights, model.weights) and again.threshold == pytest.approx(model.threshold)


def test_pairs_teach_the_order():
    r = np.random.default_rng(1)
    x = r.random((400, len(quality_classifier.NAMES)))
    label = (x[:, 3] + 0.2 * x[:, 5] > 0.6).astype(int)
    model = quality_classifier.rank(x, label)
    raw = model.raw(x)
    assert (raw[label == 1][:, None] > raw[label == 0][None, :]).mean() > 0.99
    assert ((model.score(x) >= 0.7) == (label == 1)).mean() > 0.97


def test_all_pairs_teach_not_a_draw_of_them():
    """The weights minimise the log loss over every pair of a good and a bad row; near a plain sum over all pairs."""
    r = np.random.default_rng(7)
    x = r.random((1200, len(quality_classifier.NAMES)))
    label = (x[:, 3] + 0.3 * r.standard_normal(1200) > 0.5).astype(int)
    model = quality_classifier.rank(x, label)
    z = (quality_classifier.bend(x) - model.mean) / model.scale
    diff = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, z.shape[1])
    p = 1 / (1 + np.exp(diff @ model.weights))
    slope = quality_classifier.PENALTY * model.weights - diff.T @ p / len(diff)
    assert np.abs(slope).max() < 1e-4
    raw = np.round(model.raw(x), 9)
    fewest = min(((raw >= t) != (label == 1)).sum() for t in [*np.unique(raw), raw.max() + 1])
    assert ((model.score(x) >= 0.7) != (label == 1)).sum() == fewest


def test_every_labelled_row_counts(spark, monkeypatch):
    """As many rows as before, but more than the 20,000 that once were enough: all are measured and added up."""
    monkeypatch.setattr(quality_classifier, "features", lambda t: [float(v) for v in np.random.default_rng(len(t or "")).random(len(quality_classifier.NAMES))])
    docs = spark.range(30_000).selectExpr("id as doc_id", "repeat('a', int(id % 997)) as text")
    marks = spark.range(30_000).selectExpr("id as doc_id", "int(id % 997 % 3 > 0) as quality")
    model = quality_classifier.learn(docs, marks)
    ids = [r[0] for r in docs.filter(~toxicity.held_out(docs.doc_id)).select("doc_id").collect()]
    assert len(ids) > 20_000
    table = np.array([quality_classifier.features("a" * i) for i in range(997)])
    want = quality_classifier.rank(table[[i % 997 for i in ids]], np.array([int(i % 997 % 3 > 0) for i in ids]))
    for name in ("mean", "scale", "weights", "threshold", "width"):
        assert np.allclose(getattr(model, name), getattr(want, name), atol=1e-7), name


def test_odd_rows_of_classifier(spark):
    docs = odd_documents(spark)
    for rows, marks in ((docs, labels(spark)), (docs, no_rows(labels(spark))), (no_rows(docs), labels(spark))):
        scored = quality_classifier.score(rows, quality_classifier.learn(rows, marks), name="s").collect()
        assert len(scored) == rows.count() and all(0 <= r.s <= 1 for r in scored)
    same = {r.s for r in scored if not (r.text or "").strip()}
    assert len(same) <= 1
