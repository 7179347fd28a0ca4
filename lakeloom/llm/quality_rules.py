"""Quality rules per document, and a log-likelihood ratio of hashed n-grams, in DataFrame expressions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.tasks import free_name
from lakeloom.session import cut

# Hash buckets of the two multinomials.
BUCKETS = 1 << 14
# Kept are documents with at least this mean log ratio per n-gram, in nats.
THRESHOLD = -0.15
# Numbers of 64 bits in the filter of trusted keys: one megabyte.
FILTER_WORDS = 1 << 17
# Rules of the base.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_SPACE = " \t\n\x0b\f\r"
_SPACES = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _SPACES))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more, each counted once.

    Where some of the windows' 64-bit hashes agree, the upper bits of the hash and the position are packed into one number
    and sorted, so that windows which may be equal become neighbours: n log n steps for any text. Neighbours
    are then compared by their words. A group of agreeing bits that holds different windows shows at least one unequal pair
    of neighbours; the windows of such groups are sorted by the words themselves. So the count is exact at any length.
    """

    def covered(w: Column, h: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(F.size(h).cast("bigint"))))
        place = (low - 1).cast("bigint")
        top = lambda x: x.bitwiseAND(F.bitwise_not(place))
        at = lambda x: x.bitwiseAND(place).cast("int")
        yes = lambda c: F.coalesce(c, F.lit(False))

        def equal(p: Column, q: Column) -> Column:
            return (F.get(w, p) == F.get(w, q)) & (F.get(w, p + 1) == F.get(w, q + 1)) & (F.get(w, p + 2) == F.get(w, q + 2))

        def settled(places: Column) -> Column:
            """Of these windows, the places of those whose words come twice or more."""
            spelled = F.transform(places, lambda p: F.struct(F.struct(F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("g"), p.alias("p")))
            twin = lambda s, x, j: yes(x["g"] == F.get(s, j - 1)["g"]) | yes(x["g"] == F.get(s, j + 1)["g"])
            return let(F.sort_array(spelled), lambda s: F.array_compact(F.transform(s, lambda x, j: F.when(twin(s, x, j), x["p"]))))

        def flagged(s: Column) -> Column:
            twin = lambda x, j: yes(top(x) == top(F.get(s, j - 1))) | yes(top(x) == top(F.get(s, j + 1)))
            found = F.array_compact(F.transform(s, lambda x, j: F.when(twin(x, j), x)))

            def split(f: Column) -> Column:
                clash = lambda x, j: yes(top(x) == top(F.get(f, j + 1))) & ~equal(at(x), at(F.get(f, j + 1)))
                mixed = F.array_distinct(F.array_compact(F.transform(f, lambda x, j: F.when(clash(x, j), top(x)))))

                def joined(m: Column) -> Column:
                    sure = F.transform(F.filter(f, lambda x: ~F.array_contains(m, top(x))), at)
                    doubtful = F.transform(F.filter(f, lambda x: F.array_contains(m, top(x))), at)
                    return F.when(F.size(m) == 0, F.transform(f, at)).otherwise(F.concat(sure, settled(doubtful)))

                return let(mixed, joined)

            return F.sort_array(let(found, split))

        packed = F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("bigint")))
        steps = lambda q: F.transform(q, lambda p, j: F.coalesce(F.least(F.get(q, j + 1) - p, F.lit(3)), F.lit(3)))
        spans = let(let(F.sort_array(packed), flagged), steps)
        return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def count(w: Column) -> Column:
        windows = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
        )
        none = lambda h: F.size(F.array_distinct(h)) == F.size(h)
        return let(windows, lambda h: F.when(none(h), F.lit(0).cast("bigint")).otherwise(covered(w, h)))

    return let(words, count)


def repeated_lines(text: Column) -> Column:
    """Lines between ``\\n`` that hold a word and equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(_WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def maybe_among(keys: DataFrame, key: str) -> Column:
    """True for every value of ``keys``, and for few others: a Bloom filter of ``FILTER_WORDS`` numbers, whatever the number of keys.

    With some ten million keys and more it lets most values pass; what it lets pass must be joined.
    """
    bits, each = 64 * FILTER_WORDS, range(3)
    place = lambda j: F.pmod(F.xxhash64(F.col(key), F.lit(j)), F.lit(bits))
    places = keys.select(F.explode(F.array(*[place(j) for j in each])).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).cast("int").alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("w"))
    full = keys.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("at")).join(words, "at", "left")
    one = full.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("w", F.lit(0).cast("bigint")).alias("w")))), lambda x: x["w"]).alias("filter"))
    held = one.scalar()
    found = [F.call_function("shiftrightunsigned", F.get(held, F.shiftright(place(j), 6).cast("int")), place(j).bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1 for j in each]
    return found[0] & found[1] & found[2]


def _gram_counts(texts: DataFrame, name: str) -> DataFrame:
    """(bucket, ``name``): words and word pairs of ``_text`` per bucket."""
    each = texts.select(words_of(F.col("_text")).alias("w"))
    pairs = each.select(F.explode(F.arrays_zip(F.col("w").alias("x"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("y"))).alias("g"))
    grams = pairs.select(F.explode(F.array(bucket(F.col("g.x")), F.when(F.col("g.y").isNotNull(), bucket(F.col("g.x"), F.col("g.y"))))).alias("bucket"))
    return grams.filter("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def log_ratios(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(bucket, ratio) for every bucket: log of its share among the words and word pairs of trusted documents
    over its share in all documents, one added to every count, to six decimals.

    Trusted are all documents labelled 1. All documents are counted in a plain scan; the trusted ones a second time, by an ordinary
    semi join with their keys. A filter of fixed size lets few other texts into its shuffle. Both sides count every
    word, in partial sums per task.
    """
    named = F.col(f"`{key}`")
    good = cut(labels.filter(named.isNotNull() & (F.col(f"`{label}`") == 1)).select(named.alias("_key")).distinct(), "trusted")
    texts = docs.select(named.alias("_key"), F.col(f"`{text}`").alias("_text"))
    raw = _gram_counts(texts, "raw")
    counts = raw.join(_gram_counts(texts.filter(maybe_among(good, "_key")).join(good, "_key", "left_semi"), "good"), "bucket", "left")
    full = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    one = lambda c: F.coalesce(F.col(c), F.lit(0)) + 1
    total = lambda c: F.sum(one(c)).over(Window.partitionBy())
    ratio = F.log(one("good") / total("good")) - F.log(one("raw") / total("raw"))
    return cut(full.select("bucket", F.round(ratio, 6).alias("ratio")), "ratios")


def lookup(ratios: DataFrame) -> Column:
    """The ratios as one constant array, by bucket: as many numbers as there are buckets, whatever the corpus."""
    values = {r["bucket"]: r["ratio"] for r in ratios.collect()}
    line = ",".join(f"{values[b]:.6f}" for b in range(BUCKETS))
    return F.split(F.lit(line), ",").cast("array<double>")


def mean_ratio(words: Column, table: Column) -> Column:
    """Mean log ratio over the words and word pairs of a document; 0 without words."""

    def mean(w: Column) -> Column:
        each = F.transform(
            w,
            lambda x, i: F.get(table, bucket(x))
            + F.when(i + 1 < F.size(w), F.get(table, bucket(x, F.get(w, i + 1)))).otherwise(F.lit(0.0)),
        )
        total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
        return F.when(F.size(w) == 0, F.lit(0.0)).otherwise(total / F.greatest(2 * F.size(w) - 1, F.lit(1)))

    return let(words, mean)


def measures(text: Column, table: Column) -> Column:
    """One struct of all measures of a text; the text is split once."""

    def made(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
            mean_ratio(w, table).alias("ratio"),
        )

    return let(words_of(text), made)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: the key, the measures, ``base_failed``, ``kept`` and ``ratio``.

    Null texts count as empty: no words, so the base fails. Repeated rows come back as often as they went in; an
    empty table gives no rows; without trusted documents all ratios come near 0 and the base alone decides.
    """
    table = lookup(log_ratios(docs, labels, key, text))
    whole = F.col(f"`{text}`")
    found = docs.select(F.col(f"`{key}`"), measures(whole, table).alias("m"), symbols(whole).alias("n_symbols"), repeated_lines(whole).alias("n_dup_lines"))
    failed = base_failed(F.col("m"))
    return found.select(
        F.col(f"`{key}`"), "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("m.ratio") >= threshold)).alias("kept"), F.col("m.ratio").alias("ratio"),
    )


def symbols(text: Column) -> Column:
    """Characters of ``[#*$%&|<>]``."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^#*$%&|<>]+", "")).cast("bigint")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass the base and the ratio, with their columns."""
    table = lookup(log_ratios(docs, labels, key, text))
    name = free_name(docs, "_m")
    tagged = docs.withColumn(name, measures(F.col(f"`{text}`"), table))
    m = F.col(f"`{name}`")
    return tagged.filter(~base_failed(m) & (m["ratio"] >= threshold)).drop(name)
