"""Embedding near-duplicates by an inverted multi-index.

The vectors' halves have codebooks of their own; a pair of codes names a cell of the product grid. A query walks
the cells by the multi-sequence order of a lower bound of its distance to them, until the target recall is met: with
recall 1 until no cell left can hold a vector within the radius. Vectors met there are verified by their cosine in
double precision.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.graph import components, forest
from lakeloom.llm.tasks import Batches, map_batches
from lakeloom.session import cut, cut_and_count

# Distinct vectors the codebooks are fitted on, at most; taken in the order of a hash.
SAMPLE = 20_000
# Vectors of a cell, and queries of a cell, compared in one step.
TILE = 1024
# Distinct vectors of the largest label per cell that the grid is laid out for, and the most codes per half.
PER_CELL, MOST_CODES = 128, 2048
# Planes that bound a region as seen from a vector.
PLANES = 12
ROUNDS = 12


@dataclass
class Index:
    """Codebooks per dimension, (first half, second half); the squared distance that partners have at most, and
    the recall that walks aim at."""

    books: dict[int, tuple[np.ndarray, np.ndarray]]
    reach: float
    recall: float

    def stop(self, d: int) -> float:
        """The bound, squared, beyond which a walk ends.

        Recall 1 ends where no cell can hold a partner. Below 1, a partner counts as a step of random direction: its
        part along the normal of a plane is about normal with the reach over the root of the dimension as deviation,
        so a walk that goes as far as the normal quantile of the recall meets that share of the farthest partners.
        """
        if self.recall >= 1:
            return self.reach
        return min(self.reach, NormalDist().inv_cdf(max(self.recall, 0.5)) ** 2 * self.reach / d + 1e-12)

    def halves(self, unit: np.ndarray, apart: dict[tuple[int, int], np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: the nearest code of every vector, and lower bounds of the distances to all codes' regions.

        ``apart`` keeps the distances between codes from one call to the next.
        """
        d = unit.shape[1]
        books = self.books.get(d) or (np.zeros((1, d // 2)), np.zeros((1, d - d // 2)))
        for half, book in enumerate(books):
            if (d, half) not in apart:
                apart[d, half] = between(book)
        return [regions(part, book, apart[d, half]) for half, (part, book) in enumerate(zip((unit[:, : d // 2], unit[:, d // 2 :]), books))]


def between(book: np.ndarray) -> np.ndarray:
    """The distances between all codes."""
    return np.array([np.sqrt(((book - code) ** 2).sum(1)) for code in book])


def regions(part: np.ndarray, book: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codes, and for each vector and code a distance that keeps it out of the code's region.

    A region is bounded by the planes halfway to other codes. Looked at are the planes towards the ``PLANES`` codes nearest to
    the vector, which are the farthest from it, so the work per vector grows with the number of codes alone.
    """
    apart = between(book) if apart is None else apart
    far = ((part[:, None, :] - book[None, :, :]) ** 2).sum(2) if len(book) < 64 else np.maximum(
        (part**2).sum(1)[:, None] + (book**2).sum(1)[None, :] - 2 * part @ book.T, 0
    )
    near = far.argmin(1)
    close = np.argpartition(far, PLANES - 1, axis=1)[:, :PLANES] if len(book) > PLANES else np.tile(np.arange(len(book)), (len(part), 1))
    bound = np.zeros_like(far)
    for a in close.T:
        gap = (far - np.take_along_axis(far, a[:, None], 1)) / (2 * np.maximum(apart[a], 1e-300))
        # Codes this close together are told apart by rounding only.
        gap[apart[a] < 1e-5] = 0
        np.maximum(bound, gap, out=bound)
    return near, np.maximum(bound - 1e-9, 0)


def walk(first: np.ndarray, second: np.ndarray, stop: float):
    """Cells (i, j) by growing first[i]^2 + second[j]^2, up to ``stop``: a heap holds the border of the cells seen."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a] ** 2, second[b] ** 2
    border, seen = [(x[0] + y[0], 0, 0)], {(0, 0)}
    while border:
        cost, i, j = heapq.heappop(border)
        if cost > stop:
            return
        yield int(a[i]), int(b[j]), cost
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(border, (x[p] + y[q], p, q))


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of the points: spread-out starting points from a fixed seed, then rounds of assignment and means."""
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    rng = np.random.default_rng(0)
    centres = points[rng.integers(len(points))][None, :]
    far = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < k and far.sum() > 0:
        pick = points[rng.choice(len(points), p=far / far.sum())]
        centres = np.vstack([centres, pick])
        far = np.minimum(far, ((points - pick) ** 2).sum(1))
    for _ in range(rounds):
        own = ((points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T).argmin(1)
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest entry first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(1, keepdims=True))


def fit(vectors: DataFrame, rows: int, cosine: float, recall: float = 1.0) -> Index:
    """Codebooks from at most ``SAMPLE`` of the distinct ``vec``; the grid grows with ``rows``, those compared with each other."""
    picked = vectors.orderBy(F.xxhash64("vec", "label"), "cid").limit(SAMPLE).select("vec").toArrow()
    by_size: dict[int, list] = {}
    for v in picked.column("vec").to_pylist():
        by_size.setdefault(len(v), []).append(v)
    codes = min(MOST_CODES, max(8, math.ceil(math.sqrt(rows / PER_CELL))))
    units = {d: unit_rows(np.array(v, np.float64)) for d, v in by_size.items() if d > 1}
    books = {d: (kmeans(u[:, : d // 2], codes), kmeans(u[:, d // 2 :], codes)) for d, u in units.items()}
    return Index(books, (2 - 2 * cosine) * (1 + 1e-9) + 1e-12, recall)


def _matrix(column: pa.Array, start: int, stop: int) -> np.ndarray:
    part = column.slice(start, stop - start)
    return part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(stop - start, -1)


def _place(index: Index):
    """Every vector once as member of its cell, and once as query for each cell its walk meets, its own and those after it.

    The bounds hold for both ends of a pair, so the end in the earlier cell meets the other.
    """

    def work(batches: Batches) -> Batches:
        apart: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            size = np.array([len(v) for v in batch.column("vec")], np.int64)
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                part = batch.take(pa.array(rows))
                unit = unit_rows(_matrix(part.column("vec"), 0, len(rows)))
                (own1, low1), (own2, low2) = index.halves(unit, apart)
                stop = index.stop(int(d))
                at, first, second, asks = [*range(len(rows))], own1.tolist(), own2.tolist(), [False] * len(rows)
                for k, home in enumerate(zip(first[:], second[:])):
                    for i, j, _ in walk(low1[k], low2[k], stop):
                        if (i, j) >= home:
                            at.append(k), first.append(i), second.append(j), asks.append(True)
                taken = part.take(pa.array(at))
                inside = (own1[at] == first) & (own2[at] == second)
                made = [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(asks), pa.array(inside)]
                yield pa.RecordBatch.from_arrays(
                    [taken.column(n) for n in ("cid", "label", "n", "vec")] + made, ["cid", "label", "n", "vec", "i", "j", "asks", "home"]
                )

    return work


def _verify(cosine: float):
    """Per tile: how many vectors each query and each member links to, and a spanning forest of the links.

    Each pair comes once: from the earlier cell, and inside a cell from the smaller ``cid``.
    """

    def work(batches: Batches) -> Batches:
        for batch in batches:
            ids, links = [], []
            a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for row in range(batch.num_rows):
                sides = {}
                for name in ("asks", "held"):
                    tile = batch.column(name)[row].values
                    vec = tile.field("vec")
                    sides[name] = (
                        tile.field("cid").to_numpy(), tile.field("n").to_numpy(), unit_rows(_matrix(vec, 0, len(vec)))
                    )
                home = batch.column("asks")[row].values.field("home").to_numpy(zero_copy_only=False)
                (qid, times, q), (mid, n, m) = sides["asks"], sides["held"]
                close = (q @ m.T >= cosine) & (~home[:, None] | (qid[:, None] < mid[None, :]))
                x, y = np.nonzero(close)
                for own, found in ((qid, close @ n), (mid, times @ close)):
                    ids.append(own[found > 0])
                    links.append(found[found > 0])
                a, b = forest(np.concatenate([a, qid[x]]), np.concatenate([b, mid[y]]))
            ids, links = np.concatenate(ids), np.concatenate(links).astype(np.int64)
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids), none, pa.array(links)], ["a", "b", "links"])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "links"])

    return work


def usable(vector: Column, label: Column) -> Column:
    """Label and vector are there, all components finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = F.coalesce(F.forall(vector, finite), F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    return label.isNotNull() & whole


def near_duplicates(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98, recall: float = 1.0
) -> DataFrame:
    """Per vector: key, ``n_links``, ``component_id`` and ``kept``, comparing vectors of equal label and length.

    Equal vectors form a class that is compared once and counted with its copies. A cell with many members or
    queries is cut into tiles by a hash, every pair of pieces in a group of its own. Vectors that are null, zero or
    hold null or non-finite components, and vectors without a label, link with nothing and are kept. A null key
    names no component. Repeated rows are vectors of their own; an empty table gives no rows.
    """
    name, vec = F.col(f"`{key}`"), F.col(f"`{vector}`")
    rows = table.select(name.alias("key"), F.col(f"`{label}`").alias("label"), vec.alias("vec"))
    rows = rows.withColumn("fine", usable(F.col("vec"), F.col("label")))
    fine = rows.filter("fine").select("key", "label", "vec")
    classes = fine.groupBy("label", "vec").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n"))
    classes, count = cut_and_count(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] if count else 0
    index = fit(classes, largest, cosine, recall)

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    shape = f"cid bigint, label {kinds['label']}, n bigint, vec {kinds['vec']}, i int, j int, asks boolean, home boolean"
    placed = cut(map_batches(classes.select("cid", "label", "n", "vec"), _place(index), shape, 1000), "placed")
    cell = ["label", F.size("vec").alias("d"), "i", "j"]
    keyed = placed.select(F.struct(*cell).alias("cell"), "asks", F.struct("cid", "n", "vec", "home").alias("one"))
    pieces = lambda c: F.ceil(F.count_if(c) / TILE).cast("int")
    sizes = keyed.groupBy("cell").agg(pieces(F.col("asks")).alias("a"), pieces(~F.col("asks")).alias("h")).filter("a > 0 and h > 0")
    whole = keyed.join(sizes, "cell")
    own = F.pmod(F.xxhash64("one.cid"), F.when(F.col("asks"), F.col("a")).otherwise(F.col("h"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), F.col("h")).otherwise(F.col("a")) - 1))
    spread = whole.withColumn("own", own).withColumn("other", other)
    x, y = F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")), F.when(F.col("asks"), F.col("other")).otherwise(F.col("own"))
    tiles = spread.groupBy("cell", x.alias("x"), y.alias("y")).agg(
        F.collect_list(F.when(F.col("asks"), F.col("one"))).alias("asks"),
        F.collect_list(F.when(~F.col("asks"), F.col("one"))).alias("held"),
    )
    tiles = tiles.filter((F.size("asks") > 0) & (F.size("held") > 0)).select("asks", "held")
    found = cut(map_batches(tiles, _verify(cosine), "a bigint, b bigint, links bigint", 64), "found")

    linked = found.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b is not null")).withColumnRenamed("node", "cid")
    joined = classes.join(roots, "cid", "left").join(linked, "cid", "left")
    joined = joined.select("label", "vec", "least", F.coalesce("root", "cid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    known = joined.join(smallest, "root").select("label", "vec", "n_links", "component_id")
    back = fine.join(known, ["label", "vec"]).select("key", "n_links", "component_id")
    alone = rows.filter("not fine").select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    kept = F.col("key").eqNullSafe(F.col("component_id"))
    return back.unionByName(alone).select(F.col("key").alias(key), "n_links", "component_id", kept.alias("kept"))
