"""SimHash near-duplicates, compared on vertical bit planes.

Fingerprints of 64 bits are made per document in the tasks. Candidates come from the pigeonhole rule: of
``radius + m`` bit blocks at least ``m`` are equal in two fingerprints that differ in ``radius`` bits or
fewer, so equal values of any ``m`` blocks name every pair. Inside such a bucket the fingerprints are held as
bit planes (64 fingerprints per machine word); a query is compared with all of them by carry-save counters,
and a word is abandoned as soon as all its 64 distances exceed the radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.graph import components, forest
from lakeloom.llm.tasks import Batches, free_name, map_batches, only
from lakeloom.session import cut, cut_and_count

SEED = 42
BITS = 64
# Fingerprints compared with each other in one step; larger buckets are cut into such pieces.
TILE = 2048
# (query, word) pairs held at once while comparing.
LANES = 1 << 17

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, width: int = 4) -> int:
    """The fingerprint of one text: words split at ASCII white space, A-Z lowered, shingles of ``width`` words
    with repeats (fewer words: the whole sequence; none: zero); a bit is set if over half the hashes set it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1 :].tolist()
    first = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[i:j], SEED) for i, j in zip(first, last)), np.uint64, n)
    columns = hashes.view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", width: int = 4) -> DataFrame:
    """The ``keys`` of every row and ``fp``, its fingerprint as a signed 64-bit number."""
    named = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias(free_name(only(docs, *keys), "_text")))

    def work(batches: Batches) -> Batches:
        for batch in batches:
            made = np.array([fingerprint(t, width) for t in batch.column(len(keys)).to_pylist()], np.uint64)
            columns = [batch.column(i) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made.view(np.int64))], [*keys, "fp"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in only(docs, *keys).schema)
    return map_batches(named, work, f"{fields}, fp bigint", 1000)


def masks(blocks: int, equal: int) -> list[int]:
    """Bit masks of every choice of ``equal`` out of ``blocks`` blocks of the 64 bits, as signed numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [int(np.array(sum(c), np.uint64).astype(np.int64)) for c in combinations(parts, equal)]


def equal_blocks(rows: int, radius: int, tile: int = TILE) -> int:
    """How many equal blocks a bucket asks for, so that a bucket of evenly spread fingerprints fits a tile."""
    equal = 1
    while equal < 4 and rows > tile << (BITS * equal // (radius + equal)):
        equal += 1
    return equal


def _planes(values: np.ndarray) -> np.ndarray:
    """64 rows, one per bit; column w holds that bit of the fingerprints 64w to 64w+63."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits, axis=0, bitorder="little")
    return np.ascontiguousarray(packed.T).view(np.uint64)


def near(values: np.ndarray, queries: np.ndarray, words: np.ndarray, lanes: np.ndarray, radius: int):
    """(query, other) values that differ in 1 to ``radius`` bits, for each query against one word of 64 lanes.

    ``values`` holds the fingerprints of all words, ``lanes`` the valid lanes of each word.
    """
    planes = _planes(values)
    width = max(1, radius.bit_length())
    flips = np.where(np.unpackbits(queries.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T, _FULL, np.uint64(0))
    at, word = np.arange(len(queries)), words
    count = [np.zeros(len(word), np.uint64) for _ in range(width)]
    over = ~lanes[word]
    for j in range(0, BITS, 2):
        x, y = planes[j, word] ^ flips[j, at], planes[j + 1, word] ^ flips[j + 1, at]
        low = count[0]
        half = low ^ x
        carry, count[0] = (low & x) | (half & y), half ^ y
        for k in range(1, width):
            carry, count[k] = count[k] & carry, count[k] ^ carry
        over |= carry
        if j >= 14 and j % 8 == 6 or j == BITS - 2:
            more, same = np.zeros_like(over), np.full_like(over, _FULL)
            for k in range(width - 1, -1, -1):
                if radius >> k & 1:
                    same &= count[k]
                else:
                    more |= same & count[k]
                    same &= ~count[k]
            over |= more
            alive = over != _FULL
            if not alive.all():
                at, word, over = at[alive], word[alive], over[alive]
                count = [c[alive] for c in count]
    left = (~over).view(np.uint8).reshape(-1, 8)
    row, lane = np.nonzero(np.unpackbits(left, axis=1, bitorder="little"))
    found, other = queries[at[row]], values[word[row] * 64 + lane]
    differ = found != other
    return found[differ], other[differ]


def _links(radius: int):
    def work(batches: Batches) -> Batches:
        for batch in batches:
            known = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            for values, queries, words, lanes in _steps(batch):
                a, b = near(values, queries, words, lanes, radius)
                known = forest(np.concatenate([known[0], a]), np.concatenate([known[1], b]))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in known], ["a", "b"])

    return work


def _steps(batch: pa.RecordBatch):
    """The comparisons of a batch of tiles, many small tiles at once; each tile starts a new word."""
    held: list = []
    size = 0
    for mine, others in zip(*[[np.asarray(v, np.int64).view(np.uint64) for v in batch.column(n).to_pylist()] for n in ("mine", "others")]):
        stored = others if len(others) else mine
        word = -(-len(stored) // 64)
        step = max(1, LANES // word)
        for i in range(0, len(mine), step):
            part = mine[i : i + step]
            held.append((stored, part, word))
            size += len(part) * word
            if size >= LANES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list):
    total = sum(w for *_, w in held)
    values, lanes = np.zeros(total * 64, np.uint64), np.zeros(total * 64, np.uint8)
    queries, words, start = [], [], 0
    for stored, part, word in held:
        values[start * 64 : start * 64 + len(stored)] = stored
        lanes[start * 64 : start * 64 + len(stored)] = 1
        queries.append(np.repeat(part, word))
        words.append(np.tile(np.arange(start, start + word), len(part)))
        start += word
    valid = np.packbits(lanes, bitorder="little").view(np.uint64)
    return values, np.concatenate(queries), np.concatenate(words), valid


def links(fps: DataFrame, rows: int, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp`` within ``radius`` bits of each other.

    A bucket with more than ``tile`` members is cut into pieces by a hash, and every pair of pieces is
    compared in a group of its own: no task holds a whole hot bucket and no pair is left out. A group
    returns a spanning forest of its links, never all pairs.
    """
    equal = equal_blocks(rows, radius, tile)
    chosen = masks(radius + equal, equal)
    fp = F.col("fp")
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(chosen)]))
    keyed = fps.select(fp, each.alias("e")).select("fp", "e.t", "e.k")
    counts = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), parts).cast("int")
    placed = keyed.join(counts, ["t", "k"]).select("fp", "t", "k", parts.alias("parts"), own.alias("own"))
    paired = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    first: Column = F.col("own") <= F.col("with")
    tiles = paired.groupBy("t", "k", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j")).agg(
        F.collect_list(F.when(first, F.col("fp"))).alias("mine"),
        F.collect_list(F.when(~first, F.col("fp"))).alias("others"),
    )
    # A piece alone is compared with itself; two pieces with each other, unless one is empty.
    tiles = tiles.filter((F.size("mine") > 0) & ((F.col("i") == F.col("j")) | (F.size("others") > 0)))
    return map_batches(tiles.select("mine", "others"), _links(radius), "a bigint, b bigint", 256)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """Per row: the key, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest key reachable.

    Rows without words have fingerprint zero and link like any other. A null key names no component: rows
    reachable only from null keys get a null. Repeated rows come back as often as they went in.
    """
    made = cut(fingerprints(docs, [key], text, width), "fingerprints")
    name = F.col(f"`{key}`")
    classes, rows = cut_and_count(made.groupBy("fp").agg(F.min(name).alias("least")), "classes")
    joined = components(links(classes.select("fp"), rows, radius))
    rooted = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = cut(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return made.join(named, "fp").select(name, digits.alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``.

    The row with the smallest (key, hash of the text) of a component stays, nulls last; of rows equal in both
    one stays. Every other column passes through, whatever its name.
    """
    digest = free_name(docs, "_digest")
    tagged = docs.withColumn(digest, F.xxhash64(F.col(f"`{text}`")))
    made = cut(fingerprints(tagged, [key, digest], text, width), "fingerprints")
    best = F.min(F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("id"), F.col(f"`{digest}`").alias("digest")))
    classes, rows = cut_and_count(made.groupBy("fp").agg(best.alias("best")), "classes")
    joined = components(links(classes.select("fp"), rows, radius))
    rooted = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    kept = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    kept = cut(kept.select(F.struct("best.id", "best.digest").alias("stay")), "kept")
    row = free_name(tagged, "_row")
    identity = F.struct(F.col(f"`{key}`").alias("id"), F.col(f"`{digest}`").alias("digest"))
    chosen = tagged.withColumn(row, identity).join(kept, F.col(row) == F.col("stay"), "left_semi")
    order = F.row_number().over(Window.partitionBy(row).orderBy(F.lit(0)))
    rank = free_name(chosen, "_rank")
    return chosen.withColumn(rank, order).filter(F.col(rank) == 1).drop(row, rank, digest)
