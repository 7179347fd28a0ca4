"""Extraction, WARC derivatives, packing and SentencePiece."""

import gzip
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import html, packing, pieces, warc
from tests.llm.cases import no_rows, odd_documents, rows

WORDS = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXT = "Some words of a real article that go on for a while, as articles do. " * 3


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain  text\n here", "plain text here"),
        (f"<nav><a>Home</a></nav><article><h1>T&amp;t</h1><p>{TEXT}<br>x<p>Re.</article><footer>c</footer>", f"T&t\n\n{TEXT.strip()} x\n\nRe."),
        (f"<body><header>Site</header><main><p>{TEXT}</p><script>var a='</p>';</script><style>p{{}}</style></main><aside>{TEXT}</aside>", TEXT.strip()),
        (f"<div class='cookie-notice'>We use cookies</div><div id=main><h1>Head</h1><p>{TEXT}</p></div><div class=ad>{TEXT}</div>", f"Head\n\n{TEXT.strip()}"),
        (f"<article><p>{TEXT}</p><form><p>Mail</p></form><section class='comments'><p>{TEXT}</p></section></article>", TEXT.strip()),
        (f"<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul><div><p>{TEXT}</p><p>{TEXT}</p></div>", f"{TEXT.strip()}\n\n{TEXT.strip()}"),
        (f"<article><p>a&nbsp;&lt;b&gt; &#x4f60;\t\n c</p><p>{TEXT}</p><ul><li>one</li><li>two</li></ul></article>", f"a <b> 你 c\n\n{TEXT.strip()}\n\none\n\ntwo"),
        (f"<article><p>{TEXT}<!-- no --></p><table><tr><td>x</td><td>y</td></tr></table>", f"{TEXT.strip()}\n\nx\n\ny"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<html><head><title>T</title><meta charset=x><body><p>{TEXT}</p></body></html>", TEXT.strip()),
        (f"<head><title>T</title><script>x</script><div><p>{TEXT}</p></div>", TEXT.strip()),
        (f"<head><title>T</title>{TEXT}", TEXT.strip()),
        (f"<body><table><tr><td class=sidebar>Side<td><p>{TEXT}</p></table></body>", TEXT.strip()),
        (f"<article><p>{TEXT}</p><ul><li class=hidden hidden>Buy<li>one<li>two</ul><dl><dt>a<dd hidden>x<dt>b<dd>c</dl></article>", f"{TEXT.strip()}\n\none\n\ntwo\n\na\n\nb\n\nc"),
        (f"<body><datalist><option>a<option>b</datalist><p>{TEXT}</p></body>", TEXT.strip()),
        (f"<article><p>{TEXT}</p><ul><li>one<ul><li>in</ul>out<li>two</ul></article>", f"{TEXT.strip()}\n\none\n\nin\n\nout\n\ntwo"),
    ],
)
def test_optional_end_tags(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("frame", ["article", "main"])
def test_nothing_else_of_an_article_is_dropped(frame):
    links = "".join(f"<li class=share><a href=/{i}>Reference {i}</a></li>" for i in range(6))
    inner = f"<h2 class='section-header'>One</h2><p class=notice>{TEXT}</p><section id='legal'><h2 id='social-impact'>Two</h2><p>{TEXT}</p></section>"
    page = f"<nav><a>Home</a></nav><{frame}>{inner}<ul>{links}</ul><div class='share'>Tweet</div></{frame}><footer>c</footer>"
    assert html.main_text(page).split("\n\n") == ["One", TEXT.strip(), "Two", TEXT.strip(), *[f"Reference {i}" for i in range(6)]]


@pytest.mark.parametrize("wrap", ["<form>{}</form>", "<div class='with-sidebar'>{}</div>", "<div class='has-notice'>{}</div>", "<div class='hidden-xs'>{}</div>", "<section id='search-engines'>{}</section>", "<nav>{}", "<div class=sidebar><aside>{}</aside></div>", "<div hidden>{}</div>"])
def test_names_around_everything_empty_no_page(wrap):
    assert html.main_text("<body>" + wrap.format(f"<p>{TEXT}</p>" * 3) + "</body>").split("\n\n") == [TEXT.strip()] * 3


@pytest.mark.parametrize(
    "part",
    ["<p class='ad'>Buy</p>", "<p><span class='share'>Buy</span></p>", "<ul><li class='comment'>Buy</li></ul>", "<ol class='commentlist'><li>Buy</ol>", "<h3 class='comments-title'>Buy</h3>",
     "<aside>Buy</aside>", "<form><p>Buy</p></form>", "<div class='newsletter-box'>Buy</div>", f"<section class='comments'><p>{TEXT}</p><p>{TEXT}</p></section>", "<p class=notice>Buy</p>"],
)
def test_named_parts_of_an_article_go(part):
    assert html.main_text(f"<article><p>{TEXT}</p><p>{TEXT}</p>{part}</article>").split("\n\n") == [TEXT.strip()] * 2


def test_inline_parts_do_not_split_a_block_and_end_with_it():
    assert html.main_text(f"<article><p>{TEXT}one <span class=ad>x <span>y</span> z</span>two<p>{TEXT}<span class=ad>x<p>three</article>").split("\n\n") == [f"{TEXT}one two", TEXT.strip(), "three"]


def test_deep_and_unclosed_pages_take_linear_time():
    for page, n in (("<div><p>word word</p>" * 20_000, 20_000), ("<div>" * 20_000 + "<p>word word</p>" + "</div>" * 20_000, 1), ("<li><div>word word" * 20_000, 20_000)):
        begin = time.process_time()
        assert html.main_text(page).count("word word") == n
        assert time.process_time() - begin < 10


def test_smoothing_keeps_a_constant_and_spreads_a_peak():
    assert np.allclose(html.smooth(np.full(9, 3.0)), 3)
    spread = html.smooth(np.eye(1, 11, 5)[0])
    assert spread.argmax() == 5 and spread[5] > spread[4] > spread[3] > 0


def test_extract_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", f"<p>{TEXT}</p>", 1), (1, "u", f"<p>{TEXT}</p>", 1), (None, None, None, 2), (2, "v", "<p>" * 3000 + "x" * 200_000, 3)],
        "page_id long, url string, html string, text int",
    )
    got = html.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.n_chars for r in got.collect())) == [0, len(TEXT) - 1, len(TEXT) - 1, 200_000]
    assert html.extract(no_rows(pages)).collect() == []


def block_of(record):
    headers, block = warc.parse(record)
    return dict(headers), block


def test_derived_records_point_back():
    raw = warc.response("7", "http://a.example/x", "<title>T t</title><p>Hello &amp; you</p><script>no</script><p>Bye")
    source, block = block_of(raw)
    meta, text = warc.derive(raw)
    for made in (meta, text):
        named, content = block_of(made["record"])
        assert named["WARC-Refers-To"] == source["WARC-Record-ID"] == made["refers_to"]
        assert named["WARC-Target-URI"] == "http://a.example/x" and named["WARC-Date"] == source["WARC-Date"]
        assert named["WARC-Source-Payload-Digest"] == source["WARC-Payload-Digest"] == warc.digest(block.partition(b"\r\n\r\n")[2])
        assert named["WARC-Block-Digest"] == warc.digest(content) == made["block_digest"]
    assert dict(block_of(meta["record"])[0])["WARC-Concurrent-To"] == text["record_id"]
    about = dict(warc.fields(block_of(meta["record"])[1].decode()))
    assert about["title"] == "T t" and about["http-Content-Type".lower()] == "text/html; charset=utf-8" and about["digest-verified"] == "yes"
    assert block_of(text["record"])[1].decode() == "Hello & you\nBye"
    assert warc.derive(gzip.compress(raw)) == warc.derive(raw)


def test_payloads_are_unpacked():
    body = "<p>été</p>".encode("latin-1")
    packed = gzip.compress(body)
    chunks = b"3\r\n" + packed[:3] + b"\r\n" + f"{len(packed) - 3:x}".encode() + b";x=1\r\n" + packed[3:] + b"\r\n0\r\n\r\n"
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html;\r\n charset=iso-8859-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n"
    raw = warc.record([("WARC-Type", "response"), ("WARC-Payload-Digest", "sha1:WRONG")], head + chunks)
    meta, text = warc.derive(raw)
    assert block_of(text["record"])[1].decode() == "été"
    about = dict(warc.fields(block_of(meta["record"])[1].decode()))
    assert meta["payload_digest"] == "sha1:WRONG" and about["digest-verified"] == "no"
    assert warc.derive(warc.record([("WARC-Type", "request")], b"GET /")) == []


def test_warc_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a", 0), (1, "u", "<p>a", 0), (None, None, None, 1)], "page_id long, url string, html string, warc int")
    made = warc.derivatives(warc.responses(pages)).collect()
    assert len(made) == 6 and len({r.record_id for r in made}) == 4
    bad = spark.createDataFrame([(1, b"junk"), (2, None), (3, b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc"), (4, b"\x1f\x8bno")], "key long, warc binary")
    assert [(r.key, r.type) for r in warc.derivatives(bad).orderBy("key").collect()] == [(i, "error") for i in (1, 2, 3, 4)]
    assert warc.derivatives(no_rows(bad)).collect() == []


def test_word_by_word_encoding_is_the_tokenizers():
    encoder = packing.Encoder(WORDS)
    r = random.Random(1)
    signs = "aZé'sß ñ\t\n<|endoftext|>İŉ²½٣漢字é\x1c\x85\xa0 ﬁ!?$$12 don't we'll Ω ς Σ 😀\xad_-"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 25))) + ("<|endoftext|> x" if i % 7 == 0 else "") for i in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [packing.END]


def check_packing(pieces_, full, capacity):
    """Every id in exactly one piece, sequences in bounds and without gaps."""
    for key, ids in full.items():
        own = sorted((p for p in pieces_ if p["doc_id"] == key), key=lambda p: p["start"])
        at = 0
        for p in own:
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    by = {}
    for p in pieces_:
        by.setdefault(p["sequence_id"], []).append(p)
    for held in by.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return by


def test_pack(spark):
    r = random.Random(2)
    docs = [(i, " ".join(r.choice(["hello", "world", "tokenizer", "é"]) for _ in range(r.choice((0, 3, 40, 700))))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    encoder = packing.Encoder(WORDS)
    full = {i: encoder.tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in docs}
    made = [p.asDict() for p in packing.pack(frame, WORDS, capacity=256, block=20_000, with_ids=True).collect()]
    by = check_packing(made, full, 256)
    assert len(by) * 256 - sum(map(len, full.values())) < 4 * 256
    assert all(zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"] for p in made)


def test_balance_takes_the_cheapest_open_sequence():
    placed = packing.balance([60, 50, 40, 30, 20], 100, 0.01)
    assert placed == [(0, 0, 60, 0, 0), (1, 0, 50, 1, 0), (2, 0, 40, 1, 50), (3, 0, 30, 0, 60), (4, 0, 10, 0, 90), (4, 10, 10, 1, 90)]
    assert packing.balance([]) == []
    r = random.Random(3)
    for _ in range(30):
        lengths = [r.randint(1, 300) for _ in range(r.randint(1, 60))]
        made = packing.balance(lengths, 100)
        assert len({k for *_, k, _ in made}) == -(-sum(lengths) // 100)
        assert sorted((d, s + i) for d, s, n, *_ in made for i in range(n)) == [(d, i) for d, n in enumerate(lengths) for i in range(n)]


def test_odd_rows_of_packing(spark):
    docs = odd_documents(spark)
    encoder = packing.Encoder(WORDS)
    whole = sum(len(i) for i in encoder.encode([r.text or "" for r in docs.collect()]))
    made = packing.pack(docs, WORDS)
    assert made.agg(F.sum("length")).first()[0] == whole
    assert made.filter("doc_id is null").count() == 2
    assert packing.pack(no_rows(docs), WORDS).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL)


def test_ids_are_the_models(vocabulary):
    from sentencepiece import SentencePieceProcessor

    model, codec = SentencePieceProcessor(model_file=MODEL), pieces.Codec(vocabulary)
    r = random.Random(2)
    signs = list("abcdeéthinsoaa   \n\t漢字ﬁ😀▁Ａ́<s>11 ") + ["the", "ing", "tion", " un", "aaa"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(1500)] + ["a" * 500, " " * 40, "the " * 300]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == model.encode(text)
        assert codec.decode(ids) == model.decode(model.encode(text))
        assert SPACELESS(text) or codec.decode(ids) == text


def SPACELESS(text):
    return pieces.SPACE in text


def test_suffix_array_ranges(vocabulary):
    matcher = pieces.Matcher(vocabulary)
    line = "▁the▁thing▁that▁ate▁the▁cat"
    text = np.array([matcher.code[c] for c in line], np.int32)
    order = matcher.suffixes(text)
    low, high = matcher.ranges(text, order)
    assert [line[i : i + 16] for i in order] == sorted((line[i : i + 16] for i in range(len(line))), key=lambda s: [matcher.code[c] for c in s])
    found = {vocabulary.pieces[i]: sorted(order[a:b].tolist()) for i, a, b in zip(matcher.ids, low, high) if b > a}
    want = {}
    for p in filter(None, vocabulary.pieces):
        at = [i for i in range(len(line)) if line.startswith(p, i)]
        if at:
            want[p] = at
    assert found == want


def test_encode_and_decode_rows(spark, vocabulary):
    docs = odd_documents(spark)
    made = pieces.encode(docs, vocabulary)
    assert made.count() == docs.count() and made.filter("NOT round_trip").count() == 0
    back = pieces.decode(made, vocabulary)
    assert rows(back) == rows(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    assert pieces.encode(no_rows(docs), vocabulary).collect() == []
    assert pieces.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), vocabulary).orderBy("doc_id").collect()[0].text is None
