"""Ranked search over a term-document grid kept as K2-treaps.

Documents are cut into blocks. A block's grid has a line per term and a column per document; a quadtree stores, for
each cell that holds anything, four bits for its quarters and the largest impact inside. An item follows the paths of
its terms' lines down the tree together: a range of documents is worth at most the weighted sum of the maxima on those
paths, the best ranges are halved first, and those that cannot reach the item's answer are left.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.tasks import Batches, map_batches
from lakeloom.session import cut

# Documents of a block, and postings after which a block ends early.
COLUMNS, POSTINGS = 2048, 400_000
# Items that meet a block together; ranges halved in one step.
TILE, STEP = 256, 512
# Terms whose document counts a task holds before it passes them on.
COUNTED = 1_000_000

# Fixed values of the score: bytes that end a term, lower case for A-Z alone, and the integer constants.
_TERMS = bytes(32 if c < 128 and not chr(c).isalnum() else c + 32 if 65 <= c <= 90 else c for c in range(256))
SCALE, TF, LENGTH, BASE = 1_000_000_000, 1000, 20, 50
POP = np.array([bin(m).count("1") for m in range(16)], np.int64)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of letters and digits of ASCII and of all other characters, in a UTF-8 text; only A-Z are lower-cased."""
    return (text or b"").translate(_TERMS).split()


def interleave(x: np.ndarray) -> np.ndarray:
    """Bit i of every number moved to bit 2i."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass
class Tree:
    """A quadtree over lines and columns. Nodes are numbered level by level from the root, 1; number 0 is the empty cell.

    ``quarters`` has a bit per quarter that holds anything (2 * lower half + right half), ``start`` the number of the
    first of them, ``peak`` the largest impact.
    """

    height: int
    quarters: np.ndarray
    peak: np.ndarray
    start: np.ndarray

    @staticmethod
    def build(line: np.ndarray, column: np.ndarray, impact: np.ndarray) -> Tree:
        height = max(int(line.max()), int(column.max()), 1).bit_length() if len(line) else 1
        place = (interleave(line) << np.uint64(1)) | interleave(column)
        order = np.argsort(place)
        place, peak = place[order], impact[order].astype(np.int32)
        quarters, peaks = [np.zeros(len(place), np.uint8)], [peak]
        for _ in range(height):
            above, quarter = place >> np.uint64(2), (place & np.uint64(3)).astype(np.uint8)
            first = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])[: len(above)])
            quarters.append(np.bitwise_or.reduceat(np.uint8(1) << quarter, first) if len(first) else np.zeros(0, np.uint8))
            peak = np.maximum.reduceat(peak, first) if len(first) else peak
            peaks.append(peak)
            place = above[first]
        return Tree.load(height, np.concatenate(quarters[::-1]), np.concatenate(peaks[::-1]))

    @staticmethod
    def load(height: int, quarters: np.ndarray, peak: np.ndarray) -> Tree:
        quarters, peak = np.concatenate([[np.uint8(0)], quarters]), np.concatenate([[np.int32(0)], peak])
        below = POP[quarters]
        return Tree(height, quarters, peak, 2 + np.cumsum(below) - below)

    def best(self, lines: np.ndarray, weights: np.ndarray, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of at least ``floor``: the k highest and all that tie with the last of them.

        Lines beyond the tree hold nothing.
        """
        held = lines < 1 << self.height
        lines, weights = lines[held], weights[held]
        kind = np.float64 if float(weights.sum()) * max(1, int(self.peak.max())) < 1 << 53 else np.int64
        weights = weights.astype(kind)
        level, column, node = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full((1, len(lines)), min(1, len(self.peak) - 1))
        bound = self.peak[node].astype(kind) @ weights
        found, scores = np.zeros(0, np.int64), np.zeros(0, kind)
        while len(bound):
            pick = np.argpartition(-bound, STEP - 1)[:STEP] if len(bound) > STEP else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[pick] = False
            shift = self.height - 1 - level[pick]
            quarter = 2 * ((lines[None, :] >> shift[:, None]) & 1)
            parent = node[pick]
            bits, first = self.quarters[parent], self.start[parent]
            halves = []
            for right in (0, 1):
                at = quarter + right
                halves.append(np.where((bits >> at) & 1, first + POP[bits & ((1 << at) - 1)], 0))
            child = np.concatenate(halves)
            worth = self.peak[child].astype(kind) @ weights
            deep, where = np.tile(level[pick] + 1, 2), np.concatenate([2 * column[pick], 2 * column[pick] + 1])
            stays, leaf = worth >= floor, deep == self.height
            ends = stays & leaf
            if ends.any():
                found, scores = np.concatenate([found, where[ends]]), np.concatenate([scores, worth[ends]])
                if len(scores) > k:
                    floor = max(floor, int(np.partition(scores, -k)[-k]))
                    high = scores >= floor
                    found, scores = found[high], scores[high]
                    stays = worth >= floor
                    rest &= bound >= floor
            stays &= ~leaf
            level, column = np.concatenate([level[rest], deep[stays]]), np.concatenate([column[rest], where[stays]])
            bound, node = np.concatenate([bound[rest], worth[stays]]), np.concatenate([node[rest], child[stays]])
        return found, scores.astype(np.int64)


def _tally(batches: Batches) -> Batches:
    """Documents per term; documents with a term and terms in all under the null term."""
    docs = words = 0
    held: Counter[bytes] = Counter()

    def passed() -> pa.RecordBatch:
        return _columns([[*held, None], [*held.values(), docs], [*[0] * len(held), words]], TALLY)

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            terms = terms_of(text)
            docs, words = docs + bool(terms), words + len(terms)
            held.update(set(terms))
        if len(held) > COUNTED:
            yield passed()
            docs = words = 0
            held.clear()
    yield passed()


TALLY = pa.schema([("term", pa.binary()), ("docs", pa.int64()), ("words", pa.int64())])
INDEX = pa.schema(
    [("rid", pa.list_(pa.int64())), ("doc", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary())), ("height", pa.int32()), ("quarters", pa.binary()), ("peaks", pa.binary())]
)
INDEX_DDL = "rid array<bigint>, doc array<bigint>, terms array<binary>, height int, quarters binary, peaks binary"


def _columns(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SCALE * tf // (TF * tf + LENGTH * m)


def _build(docs: int, words: int):
    """A tree per block of documents; the lines of frequent terms lie together, which fills cells."""

    def block(rid: list, key: list, length: list, size: list, terms: list, tf: list) -> pa.RecordBatch:
        m = np.array([BASE + (BASE * n * docs) // words for n in length], np.int64)
        column = np.repeat(np.arange(len(rid)), size)
        coded = pa.array(terms, pa.binary()).dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.argsort(-np.bincount(code), kind="stable")
        line = np.empty(len(order), np.int64)
        line[order] = np.arange(len(order))
        tree = Tree.build(line[code], column, impact(np.array(tf, np.int64), m[column]))
        held = coded.dictionary.take(pa.array(order)).to_pylist()
        return _columns([[rid], [key], [held], [tree.height], [tree.quarters[1:].tobytes()], [tree.peak[1:].tobytes()]], INDEX)

    def work(batches: Batches) -> Batches:
        parts: tuple[list, ...] = ([], [], [], [], [], [])
        for batch in batches:
            for rid, key, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2).cast(pa.binary()).to_pylist()):
                terms = Counter(terms_of(text))
                if terms:
                    for part, x in zip(parts, (rid, key, terms.total(), len(terms))):
                        part.append(x)
                    parts[4].extend(terms)
                    parts[5].extend(terms.values())
                if len(parts[0]) >= COLUMNS or len(parts[4]) >= POSTINGS:
                    yield block(*parts)
                    parts = ([], [], [], [], [], [])
        if parts[0]:
            yield block(*parts)

    return work


FOUND = "item bigint, doc bigint, rid bigint, score bigint"


def _search(k: int):
    """The k best documents of a block for every item beside it, ties with the last included.

    What a task has found for an item is a floor for the blocks after it.
    """

    def work(batches: Batches) -> Batches:
        floors: dict[int, int] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                tree = Tree.load(batch.column("height")[row].as_py(), *(np.frombuffer(batch.column(n)[row].as_buffer(), t) for n, t in (("quarters", np.uint8), ("peaks", np.int32))))
                rid, doc = (batch.column(n)[row].values for n in ("rid", "doc"))
                items = batch.column("items")[row].values
                asked = items.field("terms")
                where = pc.index_in(asked.flatten().field("term"), value_set=batch.column("terms")[row].values)
                line, weight = where.fill_null(-1).to_numpy(), asked.flatten().field("w").to_numpy()
                ends = np.cumsum(pc.list_value_length(asked).to_numpy())
                out_item, out_place, out_score = [], [], []
                for item, first, last in zip(items.field("item").to_pylist(), [0, *ends[:-1]], ends):
                    has = line[first:last] >= 0
                    place, score = tree.best(line[first:last][has].astype(np.int64), weight[first:last][has], k, floors.get(item, 1))
                    if len(score) >= k:
                        floors[item] = max(floors.get(item, 1), int(np.partition(score, -k)[-k]))
                    out_item += [item] * len(place)
                    out_place.append(place)
                    out_score.append(score)
                place = pa.array(np.concatenate([np.zeros(0, np.int64), *out_place]))
                scores = pa.array(np.concatenate([np.zeros(0, np.int64), *out_score]))
                yield pa.RecordBatch.from_arrays([pa.array(out_item, pa.int64()), doc.take(place), rid.take(place), scores], ["item", "doc", "rid", "score"])

    return work


def rank(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text") -> DataFrame:
    """Per row of ``items``: its ``k`` documents of the highest score above 0, ``rank`` from 1, ties by smaller ``key``.

    Terms weigh ``floor(1000 * ln((2N + 2) / (2 df + 1)))`` and add their weight times an impact that grows with their
    share of the document and saturates; all documents enter N, the mean length and every count. The trees hold all terms of all
    documents; every item is compared with every block, in groups of ``TILE`` items.

    Null, empty and blank texts have no terms: such documents are never found and items without terms get no rows.
    Repeated documents are documents of their own, in an order of no meaning after the ties; a null ``key`` (an integer)
    comes last among equal scores. Repeated items get their rows each. No documents, no items: no rows. Other columns
    are not looked at.
    """
    texts = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc"), F.col(f"`{text}`").alias("text"))
    tally = cut(map_batches(texts.select("text"), _tally, "term binary, docs bigint, words bigint").groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")), "tally")
    total = tally.filter("term is null").first()
    n, words = (total["docs"], total["words"]) if total else (0, 0)
    known = tally.filter("term is not null").select("term", F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("docs") + 1))).cast("bigint").alias("w"))

    asked = cut(items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{item}`").alias("name"), F.col(f"`{query}`").alias("text")), "items")
    apart = map_batches(asked.select("item", "text"), _item_terms, "item bigint, term binary")
    weighed = apart.join(known, "term").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("terms"))
    tiles = max(1, -(-asked.count() // TILE))
    dealt = weighed.groupBy(F.pmod(F.xxhash64("item"), F.lit(tiles)).cast("int").alias("tile")).agg(F.collect_list(F.struct("item", "terms")).alias("items"))

    numbered = texts.select(F.monotonically_increasing_id().alias("rid"), "doc", "text")
    index = map_batches(numbered, _build(n, max(words, 1)), INDEX_DDL)
    pairs = index.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).join(cut(dealt, "tiles"), "tile")
    found = map_batches(pairs.drop("tile"), _search(k), FOUND, 4)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "rid")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "name"), "item").select(F.col("name").alias(item), "rank", F.col("doc").alias(key), "score")


def _item_terms(batches: Batches) -> Batches:
    for batch in batches:
        each = [sorted(set(terms_of(t))) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        item = np.repeat(batch.column(0).to_numpy(), [len(t) for t in each])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array([t for ts in each for t in ts], pa.binary())], ["item", "term"])
