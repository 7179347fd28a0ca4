"""Hard negatives by a vertical scan: rows lie in blocks of one column per dimension.

A group of anchors reads a block's columns in the order of the group's components, largest magnitude first. The smallest
and largest value of every column not yet read bound what the rest can add to a row's score; rows that cannot reach the
answer any more, as far as the blocks before have filled it, leave the candidates. Once few anchors have any left, each
reads the other columns in the order of its own components, until the scores of the rows left are exact.

Anchors take their turns in chunks of a fixed size: what the driver, a worker and the disk hold of them at once does not
grow with the table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.tasks import Batches, map_batches
from lakeloom.session import cut, cut_and_count, scratch

# Rows of a block, and anchors that read a block together.
BLOCK, TILE = 4096, 256
# Columns read between two looks at the bounds, at least.
STEP = 8
# Bytes of the anchors that take a turn together, what a worker keeps of their answers included.
CHUNK = 8 << 20
# Tasks of a turn, for each of the session's cores.
WAVES = 4
LONG = np.iinfo(np.int64)
# Sums below this are exact in single and in double precision.
EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}


def whole(vector: Column, label: Column) -> Column:
    """Label and vector are there and every component is finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return label.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def _matrix(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), -1)


def _packed(column: np.ndarray) -> bytes:
    """A column in the narrowest of three widths; its length and the number of rows tell which."""
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= column.min() and column.max() <= np.iinfo(kind).max:
            return column.astype(kind).tobytes()
    return column.astype(np.int64).tobytes()


def _unpacked(column: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(column, {2: np.int16, 4: np.int32, 8: np.int64}[len(column) // rows])


def _turn(batches: Batches) -> Batches:
    """Rows of each block to columns, one per dimension."""
    for batch in batches:
        for k in range(batch.num_rows):
            members = batch.column("rows")[k].values
            codes = _matrix(members.field("codes"))
            columns = [_packed(c) for c in codes.T]
            one = batch.slice(k, 1)
            kept = [one.column(n) for n in ("d", "home", "slice")]
            lists = [_one_list(members.field(n)) for n in ("rid", "key", "label")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *lists, pa.array([columns], pa.list_(pa.binary()))], ["d", "home", "slice", "rid", "key", "label", "columns"]
            )


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def scan(
    columns: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray, at: np.ndarray, needed: Callable, score: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows that stay candidates to the end, and their scores.

    ``columns`` holds one line per dimension, ``low`` and ``high`` its extremes, ``at`` the first candidates, ``score`` what
    they have from other columns; ``needed`` says from lower and upper bounds of the scores which rows can still matter.
    """
    order = np.argsort(-np.abs(q), kind="stable")
    rest = _rest(q[None, order], low[order], high[order])[:, 0]
    score = np.zeros(len(at), columns.dtype) if score is None else score
    for first in range(0, len(order), STEP):
        read = order[first : first + STEP]
        score = score + q[read] @ columns[read[:, None], at[None, :]]
        done = min(first + STEP, len(order))
        stay = needed(score + rest[0, done], score + rest[1, done])
        if not stay.all():
            at, score = at[stay], score[stay]
        if not len(at):
            break
    return at, score


def _rest(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each line of ``q`` the least and the most that the columns from each one on can add."""
    ends = np.stack([q * low, q * high])
    rest = np.zeros((2, len(q), q.shape[1] + 1), ends.dtype)
    for side, of in enumerate((ends.min(0), ends.max(0))):
        rest[side, :, :-1] = np.cumsum(of[:, ::-1], axis=1)[:, ::-1]
    return rest


def _kth(values: np.ndarray, k: int):
    """The k-th largest of the values, of which there are more than k."""
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


def among_first(k: int) -> Callable:
    """Rows that can be among the k highest scores."""

    def needed(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= _kth(lower, k) if len(lower) > k else np.ones(len(lower), bool)

    return needed


def inside(windows: list[tuple[int, int]], k: int) -> Callable:
    """Rows that can be among the k highest scores of one of the windows (least and largest score)."""

    def needed(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), bool)
        for least, most in windows:
            open_ = (upper >= least) & (lower <= most)
            sure = lower[(lower >= least) & (upper <= most)]
            stay |= open_ & (upper >= _kth(sure, k)) if len(sure) > k else open_
        return stay

    return needed


def _long(scores) -> list[int]:
    return [max(LONG.min, min(LONG.max, int(x))) for x in scores] if scores.dtype == object else scores


def _as(kind: type, limits: np.ndarray) -> np.ndarray:
    """Limits to compare scores of the kind with, none of which lies beyond what is exact."""
    if kind in EXACT:
        return np.clip(limits.astype(np.float64), -EXACT[kind], EXACT[kind]).astype(kind)
    return np.array([int(x) if abs(x) != np.inf else x for x in limits.ravel()], object).reshape(limits.shape)


class Block:
    """A block as a row holds it."""

    def __init__(self, batch: pa.RecordBatch, k: int) -> None:
        self.rid, self.key = (batch.column(n)[k].values.to_numpy(zero_copy_only=False) for n in ("rid", "key"))
        self.label = batch.column("label")[k].values
        packed = batch.column("columns")[k].as_py()
        self.columns = np.array([_unpacked(c, len(self.rid)) for c in packed], np.int64).reshape(len(packed), len(self.rid))
        self.low, self.high = self.columns.min(1), self.columns.max(1)
        self.most = max([0, *map(abs, self.low.tolist()), *map(abs, self.high.tolist())])
        self.kinds: dict = {}

    def of(self, kind: type) -> list[np.ndarray]:
        """Columns and their extremes as numbers of the kind."""
        if kind not in self.kinds:
            self.kinds[kind] = [x.astype(kind) for x in (self.columns, self.low, self.high)]
        return self.kinds[kind]


class Group:
    """Anchors that read blocks together, and their best rows of those read so far.

    Each anchor has windows (least and largest score) and the ``k`` highest rows in each, ties by smaller key. ``floor`` is
    what a row needs to be among them.
    """

    def __init__(self, anchors: pa.StructArray, least: np.ndarray, most: np.ndarray, k: int) -> None:
        self.codes, self.k = _matrix(anchors.field("codes")), k
        # Copies, for a batch is let go when its blocks are read.
        self.rid, self.key = (anchors.field(n).to_numpy(zero_copy_only=False).copy() for n in ("rid", "key"))
        codes, self.floor, self.most = self.codes, least.copy(), most
        self.width = max(abs(int(codes.min())), abs(int(codes.max()))) if codes.size else 0
        none = np.zeros(0, np.int64)
        self.best, self.more = (none, none, none, none), []

    def needed(self, a: int, kind: type) -> Callable:
        """Rows that can still be among the best of an anchor."""
        if self.floor[a, 0] == -np.inf:
            return among_first(self.k)
        return inside(list(zip(*(_as(kind, x[a]).tolist() for x in (self.floor, self.most)))), self.k)

    def read(self, block: Block, fits: np.ndarray) -> None:
        """Meet a block; ``fits`` says for each anchor which rows may be partners, its own row aside."""
        width = 2 * max(1, block.most) * max(1, self.width) * (self.codes.shape[1] + 1)
        # Python's whole numbers where double precision could round; every anchor reads those alone.
        kind = next((k for k, top in EXACT.items() if width < top), object)
        columns, low, high = block.of(kind)
        codes, rows = self.codes.astype(kind), len(block.rid)
        order = np.argsort(-np.abs(self.codes.astype(np.float64)).sum(0), kind="stable")
        done, live, score = 0, fits, np.zeros(fits.shape, kind)
        for look, at_least, at_most in [] if kind is object else self._looks(_rest(codes[:, order], low[order], high[order]), kind):
            read = order[done:look]
            score, done = score + codes[:, read] @ columns[read] if done else codes[:, read] @ columns[read], look
            # A part of the rows tells whether looking at all of them pays.
            for n in (rows // 16, rows) if done < len(order) else (rows,):
                live = fits[:, :n] & (score[:, :n] >= at_least) & (score[:, :n] <= at_most)
                if not (few := np.count_nonzero(live.any(1)) * 8 <= len(live)):
                    break
            if few:
                break
        if done == len(order):
            at = np.flatnonzero(live)
            self._take(block, *np.divmod(at, rows), score.ravel()[at])
        else:
            rest = order[done:]
            for a in np.flatnonzero(live.any(1)):
                at = np.flatnonzero(live[a])
                at = at[block.rid[at] != self.rid[a]]
                at, found = scan(columns[rest], low[rest], high[rest], codes[a, rest], at, self.needed(a, kind), score[a, at])
                self._take(block, np.full(len(at), a), at, found)
        if sum(len(x[0]) for x in self.more) * 4 > len(self.best[0]):
            self.settle()

    def _looks(self, rest: np.ndarray, kind: type) -> list[tuple]:
        """Numbers of columns after which to look at the bounds, each time a quarter of what was open is left, and what a
        score needs to have and may have there, so that it can end inside a window."""
        columns = rest.shape[2] - 1
        floor, most = (x.astype(np.float64)[:, None] for x in (self.floor.min(1), self.most.max(1)))
        looks, span = [], (rest[1] - rest[0]).sum(0)
        for done in range(STEP, columns, STEP) if np.isfinite(floor).any() else ():
            if 4 * span[done] <= span[looks[-1] if looks else 0]:
                looks.append(done)
        return [(n, _as(kind, floor - rest[1, :, n, None]), _as(kind, most - rest[0, :, n, None])) for n in (*looks, columns)]

    def _take(self, block: Block, a: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
        """Keep exact scores that can be among the best."""
        stay = block.rid[at] != self.rid[a]
        counts = np.bincount(a, minlength=len(self.rid))
        ends = np.cumsum(counts)
        for i in np.flatnonzero(counts > 4 * self.k * self.floor.shape[1]):
            own = slice(ends[i] - counts[i], ends[i])
            inner = np.flatnonzero(stay[own])
            stay[own][inner] = self.needed(i, score.dtype.type)(score[own][inner], score[own][inner])
        a, at, score = a[stay], at[stay], score[stay]
        floor, most = (_as(score.dtype.type, x) for x in (self.floor, self.most))
        for w in range(floor.shape[1]):
            fits = np.flatnonzero((score >= floor[a, w]) & (score <= most[a, w]))
            if len(fits):
                exact = score[fits] if score.dtype == object else score[fits].astype(np.int64)
                self.more.append((a[fits] * floor.shape[1] + w, exact, block.key[at[fits]], block.rid[at[fits]]))

    def settle(self) -> None:
        """The best of those held and those that came; floors rise."""
        if not self.more:
            return
        slot, score, key, rid = (np.concatenate(x) for x in zip(self.best, *self.more))
        if score.dtype == object:
            order = np.array(sorted(range(len(slot)), key=lambda i: (slot[i], -score[i], key[i], rid[i])), int)
        else:
            order = np.lexsort((rid, key, -score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order, kept = order[place < self.k], slot[place < self.k]
        self.best, self.more = (kept, score[order], key[order], rid[order]), []
        if score.dtype == object:
            self.floor = _as(object, self.floor)
        full = place[place < self.k] == self.k - 1
        self.floor.flat[kept[full]] = self.best[1][full]

    def found(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Anchor and window of each of the best rows, and their rid, key and score."""
        self.settle()
        slot, score, key, rid = self.best
        windows = self.floor.shape[1]
        return slot // windows, slot % windows, [rid, key, _long(score)]


POSITIVES = "anchor bigint, anchor_id bigint, positive bigint, positive_id bigint, positive_score bigint"
NEGATIVES = "anchor bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, negative bigint, negative_id bigint, negative_score bigint"


def _read_all(batches: Batches, group: Callable, same: bool) -> list:
    """The groups of all anchors after every block has met those beside it."""
    groups = {}
    for batch in batches:
        for row in range(batch.num_rows):
            block, anchors = Block(batch, row), batch.column("anchors")[row].values
            first = anchors.field("rid")[0].as_py()
            if first not in groups:
                groups[first] = [group(anchors.slice(i, TILE)) for i in range(0, len(anchors), TILE)]
            labels = pa.concat_arrays([block.label, anchors.field("label")]).dictionary_encode().indices.to_numpy()
            label, own = labels[: len(block.rid)], labels[len(block.rid) :, None]
            for i, one in enumerate(groups[first]):
                mine = own[i * TILE : i * TILE + len(one.rid)]
                one.read(block, mine == label if same else mine != label)
    return [one for each in groups.values() for one in each]


def _positives(k: int):
    """Over the blocks of a task: each anchor's k highest rows of its label, itself left out."""

    def group(anchors: pa.StructArray) -> Group:
        return Group(anchors, np.full((len(anchors), 1), -np.inf), np.full((len(anchors), 1), np.inf), k)

    def work(batches: Batches) -> Batches:
        for one in _read_all(batches, group, True):
            a, _, rows = one.found()
            yield _table([one.rid[a], one.key[a], *rows], POSITIVES)

    return work


def _negatives(k: int, low: int, high: int):
    """Over the blocks of a task: for each positive the k highest rows of other labels inside its window."""

    def group(anchors: pa.StructArray) -> Group:
        held = anchors.field("positives").to_pylist()
        # An anchor with fewer positives has windows that nothing fits.
        shape = len(held), max(map(len, held))
        least, most = np.full(shape, np.inf, object), np.full(shape, -np.inf, object)
        for a, each in enumerate(held):
            for w, p in enumerate(each):
                least[a, w], most[a, w] = -((-low * p["score"]) // 100), high * p["score"] // 100
        one = Group(anchors, least, most, k)
        one.positives = {n: np.array([[p[n] for p in each] + [0] * (shape[1] - len(each)) for each in held], np.int64) for n in ("place", "key", "score")}
        return one

    def work(batches: Batches) -> Batches:
        for one in _read_all(batches, group, False):
            a, w, rows = one.found()
            yield _table([one.rid[a], one.key[a], *(x[a, w] for x in one.positives.values()), *rows], NEGATIVES)

    return work


def _table(columns: list, schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int32() if f.endswith(" int") else pa.int64() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _meet(blocks: DataFrame, anchors: DataFrame, on: list[str], fields: list[str]) -> DataFrame:
    """Every block beside the anchors of a chunk that share ``on`` with it, by broadcasting the chunk.

    Blocks stay where they are read; a task goes through its blocks with all anchors and keeps the best of all.
    """
    held = anchors.groupBy(*on).agg(F.collect_list(F.struct(*fields)).alias("anchors"))
    few = blocks.coalesce(WAVES * blocks.sparkSession.sparkContext.defaultParallelism)
    return few.join(F.broadcast(held), on).select("rid", "key", "label", "columns", "anchors")


def mine(
    table: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """For each anchor and each of its ``positives`` nearest rows of the same label, the first ``negatives`` rows of other
    labels whose score lies between ``window`` percent of the positive's.

    Components count as ``floor(scale * x)``; a score is the integer inner product, higher first, ties by smaller key.
    Every row is compared with every anchor of its length: rows of an own label in the first pass, of other labels in
    the second, when the windows are known. ``key`` is an integer. Rows with a null key, label or vector or a
    component that is null or not finite take no part; vectors of another length than the anchor's are no partners.
    Repeated rows are rows of their own, so a repeated anchor brings its rows again and has its copy among its positives.
    Components and scores beyond 64 bits end at the last 64-bit number. Negative scores of a positive leave no window;
    an empty table, no anchors, or a single label give no rows. Further columns are not looked at.
    """
    vec = F.col(f"`{vector}`")
    rows = table.select(
        F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{label}`").alias("label"), vec.alias("vec"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    fine = rows.filter(F.col("key").isNotNull() & whole(F.col("vec"), F.col("label")))
    codes = F.transform("vec", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    coded, count = cut_and_count(fine.select(F.monotonically_increasing_id().alias("rid"), "key", "label", "asks", codes.alias("codes")), "codes")
    homes = max(1, -(-count // BLOCK))
    coded = coded.withColumn("d", F.size("codes")).withColumn("home", F.pmod(F.xxhash64("label"), F.lit(homes)).cast("int"))
    ends = F.min(F.array_min("codes")).alias("low"), F.max(F.array_max("codes")).alias("high")
    shape = coded.groupBy("d", "home").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("a"), *ends)
    slices = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    shape = cut(shape.select("d", "home", slices.alias("slices"), "a", "low", "high"), "homes")

    # An anchor is sent with its vector and leaves its best rows in the worker. Rows travel in the narrowest of three widths.
    size = F.col("a") * (8 * F.col("d") + 256 + 32 * positives * (negatives + 1))
    total, low, high = shape.agg(F.sum(size), F.min("low"), F.max("high")).first()
    chunks = max(1, -(-(total or 0) // CHUNK))
    fits = lambda bits: -(1 << bits) <= (low or 0) and (high or 0) < 1 << bits
    width = "smallint" if fits(15) else "int" if fits(31) else "bigint"
    coded = coded.withColumn("codes", F.col("codes").cast(f"array<{width}>"))

    # One block per home and slice. Labels share a home by hash; a home with many rows has many slices.
    filled = coded.join(shape.select("d", "home", "slices"), ["d", "home"]).withColumn("slice", F.pmod(F.xxhash64("rid"), F.col("slices")).cast("int"))
    grouped = filled.groupBy("d", "home", "slice").agg(F.collect_list(F.struct("rid", "key", "label", "codes")).alias("rows"))
    kind = coded.schema["label"].dataType.simpleString()
    held = "rid array<bigint>, key array<bigint>, label array<%s>, columns array<binary>" % kind
    blocks = cut(map_batches(grouped, _turn, f"d int, home int, slice int, {held}", 16), "blocks")

    fields = ["rid", "key", "label", "codes"]
    dealt = coded.filter("asks").select(*fields, "d", "home", F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(chunks)).alias("chunk"))
    asking = cut(dealt.repartitionByRange("chunk"), "anchors")
    best = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    each = F.struct("place", F.col("positive_id").alias("key"), F.col("positive_score").alias("score"))
    hardest = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "negative")
    path = scratch(table.sparkSession, "hard")
    for chunk in range(chunks):
        asks = asking.filter(F.col("chunk") == chunk)
        near = map_batches(_meet(blocks, asks, ["d", "home"], fields), _positives(positives), POSITIVES)
        first = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
        chosen = cut(first.groupBy(F.col("anchor").alias("rid")).agg(F.sort_array(F.collect_list(each)).alias("positives")), "near")
        # The windows are known: the second pass meets the blocks of all homes.
        hard = map_batches(_meet(blocks, asks.join(chosen, "rid"), ["d"], [*fields, "positives"]), _negatives(negatives, *window), NEGATIVES)
        ranked = hard.withColumn("rank", F.row_number().over(hardest)).filter(F.col("rank") <= negatives)
        result = ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        result.write.mode("append").parquet(path)
    return table.sparkSession.read.schema(result.schema).parquet(path)
