"""The registered queries and the pipeline, over whole tables, against brute force."""

import base64
import hashlib
import re
import struct
import zlib
from html import unescape

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import corpus_pipeline
from lakeloom.llm import quality_classifier, quality_rules, toxicity, warc
from lakeloom.llm.queries import ORACLE, QUERIES
from tests.helpers import plan
from tests.llm.cases import no_rows, odd_documents
from tests.llm.test_filters import brute_measures, brute_ratios
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_texts import check_packing
from tests.oracle import connect, normal

FOLDER = "/root/testdata/sf0.001"


def read(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return {d["doc_id"]: d["text"] for d in read("documents")}


def run(spark, key):
    return [r.asDict() for r in QUERIES[key](spark, FOLDER).collect()]


def crc(text):
    return zlib.crc32((text or "").encode())


def full_ids(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in docs.items()}


def test_native_queries_have_no_python(spark):
    for key in ("op4_sharding", "op6_quality_rules"):
        text = plan(QUERIES[key](spark, FOLDER))
        assert not any(w in text for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def plain_article(page):
    """What stands between the article tags, cut at block tags."""
    inner = page[page.index("<article>") + len("<article>") : page.index("</article>")]
    inner = re.sub(r"<!--.*?-->", "", inner, flags=re.S)
    parts = re.split(r"</?(?:p|h1|h2|h3|ul|ol|li|div|blockquote|table|tr|td)\b[^>]*>", inner)
    parts = [unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br[^>]*>", " ", x))) for x in parts]
    return "\n\n".join(t for x in parts if (t := " ".join(x.split())))


def test_op1(spark):
    got, pages = run(spark, "op1_html_extraction"), read("pages")
    assert {g["page_id"]: g["url"] for g in got} == {p["page_id"]: p["url"] for p in pages} and len(got) == len(pages)
    want = {p["page_id"]: plain_article(p["html"]) for p in pages}
    assert {g["page_id"]: g["text"] for g in got} == want
    assert all(g["n_chars"] == len(g["text"]) > 0 for g in got)


def test_op2_scores_are_products_over_listed_words(spark, docs):
    """The learned list, counted again over the labelled texts, and every score from it."""
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.learn(frame, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    costs = model.costs.tolist()

    def held(text):
        words = {w for token in text.lower().split() for w in toxicity.readings(token, costs)}
        words |= {w for r in toxicity.spaced(text.lower()) for w in toxicity.decode(r, costs).split()}
        return {f for w in words for f in toxicity.features(w)}

    found = {i: held(t or "") for i, t in docs.items()}
    marked = {r["doc_id"]: r["toxic"] for r in read("labels") if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    # Near copies count once, so plain counts are the upper bound.
    for feature, weight in model.weights.items():
        n = sum(t == 1 and feature in found[i] for i, t in marked.items() if i in docs)
        assert n >= 3 and 0.5 <= weight < 1
    for g in run(spark, "op2_toxicity"):
        rest = 1 - model.base
        for feature in found[g["doc_id"]] & set(model.weights):
            rest *= 1 - model.weights[feature]
        assert g["score"] == pytest.approx(1 - rest, abs=1e-12)


def test_op9_scores_are_the_model_of_plain_features(spark, docs):
    """The model learned without Spark from the same labelled texts, and every score from it."""
    marked = {}
    for r in read("labels"):
        if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["doc_id"] in docs:
            marked[r["doc_id"]] = max(marked.get(r["doc_id"], 0), r["quality"])
    order = sorted(marked, key=lambda i: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(struct.pack("<q", i), 42)))
    x = np.array([quality_classifier.features(docs[i]) for i in order])
    model = quality_classifier.rank(x, np.array([marked[i] for i in order]))
    for g in run(spark, "op9_quality_classifier"):
        want = model.score(np.array([quality_classifier.features(docs[g["doc_id"]])]))[0]
        assert g["score"] == pytest.approx(want, abs=1e-6) and g["predicted"] == int(g["score"] >= 0.7)


@pytest.mark.parametrize("key, bar", [("op2_toxicity", 0.3), ("op9_quality_classifier", 0.7)])
def test_scores(spark, key, bar, docs):
    got = run(spark, key)
    assert {g["doc_id"] for g in got} == set(docs) and len(got) == len(docs)
    for g in got:
        assert g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2)
        assert 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= bar)


def test_op3(spark):
    """Every record against one built by hand from the page."""
    got, pages = run(spark, "op3_warc_derivatives"), {p["page_id"]: p for p in read("pages")}
    assert len(got) == 2 * len(pages) and len({g["record_id"] for g in got}) == len(got)
    for g in got:
        page = pages[g["page_id"]]
        raw = warc.response(str(page["page_id"]), page["url"], page["html"])
        head, _, block = raw.partition(b"\r\n\r\n")
        named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        body = block.partition(b"\r\n\r\n")[2][: len(page["html"].encode())]
        assert body == page["html"].encode() and g["refers_to"] == named["WARC-Record-ID"]
        assert g["payload_digest"] == named["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (g["target_uri"], g["date"], g["type"] in ("metadata", "conversion")) == (page["url"], named["WARC-Date"], True)
        made = next(m for m in warc.derive(raw) if m["type"] == g["type"])
        assert g["record_crc32"] == zlib.crc32(made["record"]) and g["record_id"] == made["record_id"]
        content = made["record"].partition(b"\r\n\r\n")[2][: g["content_length"]]
        assert g["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def test_op4(spark, docs):
    got = run(spark, "op4_sharding")
    assert {g["doc_id"]: (g["size"], g["text_crc32"]) for g in got} == {i: (len((t or "").encode()) + 1, crc(t)) for i, t in docs.items()}
    assert all(g["law"] == "key" and 0 <= g["shard"] < 8 and g["grown_shard"] in (g["shard"], 8) for g in got)
    for s in range(8):
        assert sorted(g["slot"] for g in got if g["shard"] == s) == list(range(sum(g["shard"] == s for g in got)))


def test_op5(spark, docs):
    got = {g["doc_id"]: (int(g["fingerprint"], 16), g["component_id"]) for g in run(spark, "op5_simhash_near_dedup")}
    ids = list(docs)
    fps = [plain_fingerprint(docs[i]) for i in ids]
    assert got == dict(zip(ids, zip(fps, plain_components(ids, fps, 4))))


def judged(docs, trusted):
    ratios = brute_ratios(list(docs.items()), trusted)
    out = {}
    for key, text in docs.items():
        n, *_, repeat = brute_measures(text)
        failed = n < 50 or 100 * repeat > 50 * n
        out[key] = (failed, not failed and ratios[key] >= quality_rules.THRESHOLD)
    return out


def good_labels():
    return {r["doc_id"] for r in read("labels") if r["quality"] == 1}


def test_op6(spark, docs):
    got = run(spark, "op6_quality_rules")
    want = judged(docs, good_labels())
    assert {g["doc_id"]: (g["base_failed"], g["kept"]) for g in got} == want
    for g in got:
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == brute_measures(docs[g["doc_id"]])


def test_op7(spark):
    found = connect(FOLDER).execute(ORACLE["op7_embedding_near_dedup"])
    names = [d[0] for d in found.description]
    df = QUERIES["op7_embedding_near_dedup"](spark, FOLDER)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(names, found.fetchall())


def test_op8(spark, docs):
    got, full = run(spark, "op8_packing"), full_ids(docs)
    by = check_packing(got, full, 4096)
    assert len(by) * 4096 - sum(map(len, full.values())) < 4096 * 4


def test_op10(spark, docs):
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for g in run(spark, "op10_sentencepiece"):
        ids = model.encode(docs[g["doc_id"]])
        assert g["n_ids"] == len(ids) and g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert g["round_trip"] and g["decoded_crc32"] == crc(docs[g["doc_id"]])


def test_pipeline(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash_near_dedup", "packing"]
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    toxic = {g["doc_id"] for g in run(spark, "op2_toxicity") if g["predicted"]}
    clean = {i: t for i, t in docs.items() if i not in toxic}
    first = corpus_pipeline.drop_toxic(spark, source, FOLDER)
    assert first.columns == source.columns and {r.doc_id for r in first.collect()} == set(clean)
    verdicts = judged(clean, good_labels())
    fine = {i: t for i, t in clean.items() if verdicts[i][1]}
    ids = list(fine)
    least = plain_components(ids, [plain_fingerprint(fine[i]) for i in ids], 4)
    left = {i: fine[i] for i, c in zip(ids, least) if i == c}
    got = [r.asDict() for r in corpus_pipeline.run(spark, FOLDER).collect()]
    assert {g["doc_id"] for g in got} == set(left)
    check_packing(got, full_ids(left), 4096)


def test_stages_on_odd_rows(spark):
    docs = odd_documents(spark)
    for rows in (docs, no_rows(docs)):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, rows, FOLDER)
            made.collect()
            assert name == "packing" or made.columns == docs.columns
    assert corpus_pipeline.drop_toxic(spark, docs, FOLDER).count() == docs.count()
