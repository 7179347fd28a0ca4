"""Verdicts on URLs: rules of hosts and paths first, then naive Bayes over the words of host and path.

Names in hosts run words together. A unigram model of words (from texts, and from what hosts and paths set apart) splits
them by the Viterbi path of least cost; the words found and those of the path are the tokens of a multinomial model.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.tasks import Batches, map_batches
from lakeloom.session import cut

# Longest word, and longest piece of a name that is split at once (a host name has 253 characters at most).
LONGEST, PIECE = 24, 255
# A run of letters that is no known word costs as much as a word seen once, and this factor for every letter.
UNKNOWN = math.log(10)
# Hash buckets of the tokens.
BUCKETS = 1 << 16
# Words whose counts a task holds before it passes them on.
COUNTED = 1_000_000
# Words that mark the URLs the model learns to block, unless a caller has labels of its own.
SEEDS = tuple(
    "ads adserver advert adult bet bets betting casino gambling malware phishing pills poker porn sex spam tracker viagra warez xxx".split()
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = "[^\\x00-\\x60\\x7B-\\x7F]+"
_WORDS = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits, as a struct (size, rule, verdict), or null.

    A rule fits its host and all subdomains where the path starts with the rule's. Of rules of one length the later in
    the order of their texts counts, of a rule with two verdicts ``block``.
    """

    def fitting(rule: str, verdict: str) -> Column:
        domain, prefix = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(prefix))
        parts = {"size": len(rule), "rule": rule, "blocks": verdict == "block", "verdict": verdict}
        return F.when(fits, F.struct(*[F.lit(x).alias(n) for n, x in parts.items()]))

    found = [fitting(*rule) for rule in rules]
    if not found:
        return F.lit(None).cast("struct<size:int,rule:string,blocks:boolean,verdict:string>")
    return F.greatest(*found) if len(found) > 1 else found[0]


def letters(text: Column) -> Column:
    """Runs of a-z and of characters beyond ASCII."""
    return F.regexp_extract_all(text, F.lit(_LETTERS), 0)


def path_tokens(path: Column) -> Column:
    """The runs of letters of a path, and one ``#`` per run of digits."""
    lower = F.translate(path, _UPPER, _LOWER)
    return F.concat(letters(lower), F.transform(F.regexp_extract_all(lower, F.lit("[0-9]+"), 0), lambda _: F.lit("#")))


def pieces(name: Column) -> Column:
    """Names longer than ``PIECE`` characters fall into pieces of that length, each split by itself."""
    starts = F.sequence(F.lit(0), F.floor((F.length(name) - 1) / PIECE))
    return F.transform(starts, lambda i: F.substr(name, (i * PIECE + 1).cast("int"), F.lit(PIECE)))


def _count_words(batches: Batches) -> Batches:
    held: Counter[bytes] = Counter()

    def passed() -> pa.RecordBatch:
        words = [w.decode("utf-8", "replace") for w in held]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            held.update((text or b"").translate(_WORDS).split())
        if len(held) > COUNTED:
            yield passed()
            held.clear()
    yield passed()


def lexicon(texts: DataFrame, text: str, named: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """(word, n) of at most ``LONGEST`` characters: occurrences in all texts and in what URLs set apart, (word, n) of
    ``named``; seeds count once more, so that each is a word."""
    counted = map_batches(texts.select(F.col(f"`{text}`")), _count_words, "word string, n bigint")
    once = texts.sparkSession.createDataFrame([(s, 1) for s in seeds], "word string, n bigint")
    every = counted.unionByName(named.select("word", "n")).unionByName(once)
    return every.filter(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.sum("n").alias("n"))


def split_name(name: str, words: list[tuple[int, int, float]]) -> list[str]:
    """The words on the path of least cost. ``words`` are (start, length, cost) of known words in the name; a stretch between
    them stays one piece, which costs ``UNKNOWN`` per letter besides the cost of a word seen once (start -1).
    Equal costs go to the fewer words, then to the longer last word."""
    rare = max((c for s, _, c in words if s < 0), default=0.0)
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, length, cost in words:
        if start >= 0:
            ends.setdefault(start + length, []).append((start, cost))
    # Per place: (cost, words, start of the last word) of the best path, and of the best one that ends in an unknown stretch.
    best, open_ = [(0.0, 0, 0)], [(math.inf, 0, 0)]
    for end in range(1, len(name) + 1):
        fresh, going = best[end - 1], open_[end - 1]
        start = (fresh[0] + rare + UNKNOWN, fresh[1] + 1, end - 1)
        stretch = min(start, (going[0] + UNKNOWN, going[1], going[2]))
        known = [(best[s][0] + cost, best[s][1] + 1, s) for s, cost in ends.get(end, ())]
        open_.append(stretch)
        best.append(min([stretch, *known]))
    found, end = [], len(name)
    while end:
        found.append(name[best[end][2] : end])
        end = best[end][2]
    return found[::-1]


def _split(batches: Batches) -> Batches:
    for batch in batches:
        names, edges = batch.column("name").to_pylist(), batch.column("edges").to_pylist()
        words = [split_name(n, [(e["start"], e["length"], e["cost"]) for e in es]) for n, es in zip(names, edges)]
        yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], ["name", "words"])


def segments(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words) for every distinct ``name`` of at most ``PIECE`` characters, by the counts of ``words`` (word, n).

    All parts of a name that are words of the list meet it by a join, so the list may be of any size.
    """
    counted = cut(words, "lexicon")
    # One number: the occurrences of all words.
    rare = math.log(counted.agg(F.sum("n")).first()[0] or 1)
    costs = counted.select("word", (F.lit(rare) - F.log("n")).alias("cost"))
    size = F.length("name")
    starts = names.select("name", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    parts = starts.select("name", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), size - F.col("start")))).alias("length"))
    parts = parts.withColumn("word", F.substr("name", F.col("start") + 1, F.col("length")))
    edges = parts.join(costs, "word").groupBy("name").agg(F.sort_array(F.collect_list(F.struct("start", "length", "cost"))).alias("edges"))
    rare_edge = F.array(F.struct(F.lit(-1).alias("start"), F.lit(0).alias("length"), F.lit(rare).alias("cost")))
    every = names.join(edges, "name", "left").select("name", F.concat(rare_edge, F.coalesce("edges", rare_edge)).alias("edges"))
    return map_batches(every, _split, "name string, words array<string>", 500)


def bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def learn(rows: DataFrame, tokens: str, blocked: Column) -> tuple[float, list[float]]:
    """The log odds of a blocked URL, and per bucket of tokens the log of its share in blocked URLs over that in others.

    A class's share is the token's share overall times (found + 1) / (expected + 1), so tokens that were never or hardly
    seen say little. All rows count, in partial sums per task; two numbers per bucket reach the driver. Without
    URLs of both classes nothing is blocked.
    """
    told = F.coalesce(blocked, F.lit(False))
    base = rows.agg(F.count_if(told), F.count_if(~told)).first()
    if not base[0] or not base[1]:
        return -math.inf, [0.0] * BUCKETS
    each = rows.select(told.alias("told"), F.explode(F.col(f"`{tokens}`")).alias("token"))
    found = {r["b"]: (r["bad"], r["n"]) for r in each.groupBy(bucket(F.col("token")).alias("b")).agg(F.count_if("told").alias("bad"), F.count(F.lit(1)).alias("n")).collect()}
    bad, n = sum(b for b, _ in found.values()), sum(n for _, n in found.values())
    weights = [0.0] * BUCKETS
    for at, (b, all_) in found.items():
        hope = all_ * bad / n
        weights[at] = math.log((b + 1) / (hope + 1)) - math.log((all_ - b + 1) / (all_ - hope + 1))
    return math.log(base[0] / base[1]), weights


def odds(tokens: Column, model: tuple[float, list[float]]) -> Column:
    """Log odds of a blocked URL, to six decimals, from its tokens."""
    base, weights = model
    if base == -math.inf:
        return F.lit(base)
    table = F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")
    return F.round(F.aggregate(tokens, F.lit(base), lambda total, t: total + F.get(table, bucket(t))), 6)


def judge(
    pages: DataFrame, texts: DataFrame, rules: Sequence[tuple[str, str]], key: str = "page_id", url: str = "url", text: str = "text", seeds: Sequence[str] = SEEDS
) -> DataFrame:
    """Per row of ``pages``: key, ``host``, ``path``, ``rule``, ``verdict`` and ``score``, the log odds of a block.

    ``rules`` are few (text, verdict) pairs; where none fits, a score of 0 or more blocks. The model learns from all
    URLs: those with a ``seeds`` word among their tokens as blocked, the others as allowed. Words are counted over all ``texts``.
    A null URL or one without ``://`` has an empty host and path and no tokens, so the share of blocked URLs decides alone.
    Repeated rows come back as often as they went in, an empty table gives no rows, further columns are not looked at.
    URLs meet the words of their host by a join; a host with very many of them relies on Spark's splitting of skewed joins.
    """
    whole = F.col(f"`{url}`")
    urls = pages.select(F.col(f"`{key}`").alias("key"), host_of(whole).alias("host"), path_of(whole).alias("path"))
    hosts = cut(urls.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    labels = hosts.select("host", "n", F.posexplode(F.split("host", "[.]")).alias("label_at", "label")).withColumn("names", letters(F.col("label")))
    placed = labels.select("host", "n", "label_at", F.posexplode("names").alias("name_at", "long"), (F.size("names") > 1).alias("apart"))
    placed = placed.select("host", "n", "label_at", "name_at", "apart", "long", F.posexplode(pieces(F.col("long"))).alias("piece_at", "name"))
    # Words that stand alone: parts of a label between other signs, and the words of paths.
    alone = placed.filter("apart").select(F.col("long").alias("word"), "n")
    in_paths = urls.select(F.explode(letters(F.translate("path", _UPPER, _LOWER))).alias("word"), F.lit(1).cast("bigint").alias("n"))
    words = lexicon(texts, text, alone.unionByName(in_paths), seeds)
    split = cut(segments(placed.select("name").distinct(), words), "names")
    at = F.struct("label_at", "name_at", "piece_at", "words")
    spelled = placed.join(split, "name").groupBy("host").agg(F.flatten(F.transform(F.sort_array(F.collect_list(at)), lambda x: x["words"])).alias("words"))
    tokens = F.concat(F.coalesce("words", F.array().cast("array<string>")), path_tokens(F.col("path")))
    rows = cut(urls.join(spelled, "host", "left").select("key", "host", "path", tokens.alias("tokens")), "urls")

    model = learn(rows, "tokens", F.arrays_overlap("tokens", F.array(*[F.lit(s) for s in seeds])))
    fit = rule_for(F.col("host"), F.col("path"), rules)
    judged = rows.select("key", "host", "path", fit.alias("fit"), odds(F.col("tokens"), model).alias("score"))
    own = F.when(F.col("score") >= 0, "block").otherwise("allow")
    return judged.select(
        F.col("key").alias(key), "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "score"
    )
