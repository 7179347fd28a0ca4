"""Document quality by Bradley-Terry ranking of preference pairs."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.tasks import Batches, map_batches, scored_by_text
from lakeloom.llm.toxicity import held_out
from lakeloom.operators.rows import running_offset
from lakeloom.session import cut

PENALTY, ROUNDS = 1e-3, 40
# Scores are laid on nodes this far apart, wider beyond BEND on either side of zero.
STEP, BEND = 1 / 16, 64.0
# Score of a document right at the threshold.
AT_THRESHOLD = 0.7

NAMES = (
    "length upper digit symbol exclamation pipe stop comma quote other_ascii non_ascii line_share word_length "
    "distinct_words same_as_next same_as_second repeated_lines longest_line marked_words loud_words"
).split()


# A word that ends in two signs or more.
_MARKED = re.compile(r"\w[^\w\s]{2,}(?!\S)")


def features(text: str | None) -> list[float]:
    """Shares of a text that tell prose from junk; all zero for an empty text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = (text or "").split()
    if not words:
        return [0.0] * len(NAMES)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, size = len(words), len(raw)
    letters = max(1, int(seen[65:91].sum() + seen[97:123].sum()))
    count = lambda signs: int(seen[[ord(c) for c in signs]].sum())
    lines = [line for line in text.split("\n") if line.strip()]
    listed = [
        math.log1p(n) / 10,
        seen[65:91].sum() / letters,
        seen[48:58].sum() / size,
        count("#*$%&<>@^~=+_{}[]") / n,
        count("!?") / n,
        count("|/\\") / n,
        count(".;:") / n,
        count(",") / n,
        count("\"'()`") / n,
        (seen[33:127].sum() - letters) / size,
        seen[128:].sum() / size,
        len(lines) / n,
        size / n / 20,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        sum(map(eq, words, words[2:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        max(map(len, lines), default=0) / size,
        len(_MARKED.findall(text)) / n,
        0.0,
    ]
    listed[-1] = listed[1] * listed[4]
    return [float(x) for x in listed]


def bend(x: np.ndarray) -> np.ndarray:
    """The features, their roots and their steep shares, so that a line can cut at small values too."""
    clipped = np.clip(x, 0, None)
    return np.hstack([x, np.sqrt(clipped), np.tanh(8 * clipped)])


@dataclass
class Model:
    """``weights`` over scaled features; documents at or above ``threshold`` pass; ``width`` scales the logistic curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    width: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (bend(x) - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((self.raw(x) - self.threshold) / self.width + math.log(AT_THRESHOLD / (1 - AT_THRESHOLD)), -500, 500)
        return 1 / (1 + np.exp(-z))


# Values to add up, by position.
Part = tuple[np.ndarray, np.ndarray]


def _sum(parts: list[Part]) -> Part:
    """One value per position, in the order of the positions."""
    at, value = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    at, place = np.unique(at, return_inverse=True)
    return at, np.bincount(place, value, len(at))


def _dense(*arrays: np.ndarray) -> Part:
    value = np.concatenate([np.ravel(a) for a in arrays]).astype(float)
    return np.arange(len(value)), value


def _spot(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The node below each score and the share that the node above it takes."""
    u = np.arcsinh(s / BEND) * (BEND / STEP)
    low = np.floor(u)
    share = (s - _at(low)) / (_at(low + 1) - _at(low))
    return low.astype(np.int64), np.clip(share, 0, 1)


def _at(node: np.ndarray) -> np.ndarray:
    return BEND * np.sinh(node * (STEP / BEND))


def _moments(x: np.ndarray, label: np.ndarray) -> Part:
    return _dense([len(x), (label == 1).sum(), (label == 0).sum()], bend(x).sum(0))


def _spread(mean: np.ndarray):
    return lambda x, label: _dense(((bend(x) - mean) ** 2).sum(0))


def _heights(mean: np.ndarray, scale: np.ndarray, w: np.ndarray):
    """How many bad rows (even positions) and good ones (odd) lie at each node."""

    def work(x: np.ndarray, label: np.ndarray) -> Part:
        low, share = _spot((bend(x) - mean) / scale @ w)
        good = (label == 1).astype(np.int64)
        return np.concatenate([2 * low + good, 2 * low + 2 + good]), np.concatenate([1 - share, share])

    return work


def _slopes(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, nodes: np.ndarray, beaten: np.ndarray, bent: np.ndarray):
    """Sums over rows: the slope, the curvature without the products of good and bad rows, and the features at each node.

    ``beaten`` and ``bent`` hold, for bad and good rows at each node, the sums over all rows of the other label.
    """

    def work(x: np.ndarray, label: np.ndarray) -> Part:
        z = (bend(x) - mean) / scale
        low, share = _spot(z @ w)
        good, at = (label == 1).astype(np.int64), np.searchsorted(nodes, low)
        above = np.minimum(at + 1, len(nodes) - 1)
        between = lambda table: table[good, at] * (1 - share) + table[good, above] * share
        held = np.zeros((2, len(nodes), z.shape[1]))
        np.add.at(held, (good, at), z * (1 - share)[:, None])
        np.add.at(held, (good, above), z * share[:, None])
        return _dense(z.T @ (between(beaten) * np.where(good, -1, 1)), (z * between(bent)[:, None]).T @ z, held)

    return work


def _fit(total: Callable[[Callable[[np.ndarray, np.ndarray], Part]], Part]) -> tuple[Model, int, int]:
    """The model without its threshold, and the numbers of good and bad rows; ``total`` adds up a function over all rows.

    Each good document meets each bad one: P(good beats bad) = 1 / (1 + exp(-w (g - b))). The log loss over all such
    pairs, with a small penalty, is minimised by Newton steps. What the rows of one label add for a row of the other follows
    from the two scores alone, so it is computed between nodes of the score line, from the number of rows at each, and read off
    linearly between nodes: every pair counts, in time linear in the rows.
    """
    size = 3 * len(NAMES)
    found = total(_moments)[1]
    if not len(found) or not found[0]:
        return Model(np.zeros(size), np.ones(size), np.zeros(size), -1.0, 1.0), 0, 0
    n, good, bad = (int(v) for v in found[:3])
    mean = found[3:] / n
    scale = np.maximum(np.sqrt(total(_spread(mean))[1] / n), 1e-6)
    w = np.zeros(size)
    if not good or not bad:
        return Model(mean, scale, w, -1.0 if good >= bad else 1.0, 1.0), good, bad
    step, before, pairs = np.zeros(size), np.inf, float(good) * bad
    for _ in range(ROUNDS):
        at, value = total(_heights(mean, scale, w))
        nodes = np.unique(at >> 1)
        count = np.zeros((2, len(nodes)))
        count[at & 1, np.searchsorted(nodes, at >> 1)] = value
        s = _at(nodes)
        lead = np.clip(s[None, :] - s[:, None], -500, 500)  # good at a row's node, bad at a column's
        p = 1 / (1 + np.exp(-lead))
        loss = count[1] @ np.logaddexp(0, lead) @ count[0] / pairs + PENALTY / 2 * w @ w
        if loss > before + 1e-4 and np.abs(step).max() > 1e-6:
            step = step / 2
            w = w + step
            continue
        before, q = loss, p * (1 - p) / pairs
        sums = total(_slopes(mean, scale, w, nodes, np.stack([count[1] @ p, p @ count[0]]) / pairs, np.stack([count[1] @ q, q @ count[0]])))[1]
        slope, curve, held = sums[:size], sums[size : size + size**2].reshape(size, size), sums[size + size**2 :].reshape(2, len(nodes), size)
        mixed = held[1].T @ q @ held[0]
        step = np.linalg.solve(curve - mixed - mixed.T + PENALTY * np.eye(size), slope + PENALTY * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Model(mean, scale, w, 0.0, 1.0), good, bad


def _raw(model: Model, x: np.ndarray) -> np.ndarray:
    """Scores without their last digits, in which equal documents may differ."""
    return np.round(model.raw(x), 9)


def rank(x: np.ndarray, label: np.ndarray) -> Model:
    """Weights under which the preferred document of a pair wins, learned from all pairs; see :func:`learn`, which does so for rows in Spark."""
    x, label = np.asarray(x, float).reshape(-1, len(NAMES)), np.asarray(label)
    model, good, bad = _fit(lambda work: _sum([work(x, label)]))
    if not good or not bad:
        return model
    raw = _raw(model, x)
    ranked, place = np.unique(raw, return_inverse=True)
    lead = np.bincount(place, np.where(label == 1, 1, -1), len(ranked)).astype(np.int64)
    # Errors if what lies below a score fails: good ones there, bad ones from there on; last, if all fail.
    errors = bad + np.concatenate([[0], np.cumsum(lead)])
    level = np.flatnonzero(errors == errors.min())
    k = int(level[len(level) // 2])
    return _set(model, ranked[k - 1] if k else None, ranked[k] if k < len(ranked) else None, raw.std())


def _set(model: Model, below: float | None, above: float | None, spread: float) -> Model:
    """The model with its threshold halfway between two scores, or beyond the last."""
    model.threshold = float(above - 1 if below is None else below + 1 if above is None else (below + above) / 2)
    model.width = max(float(spread) / 2, 1e-6)
    return model


def _threshold(rows: DataFrame, model: Model, bad: int, good: int) -> Model:
    """The threshold over all rows: of the places in the ranking with the fewest errors the middle one."""

    def scored(batches: Batches) -> Batches:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(NAMES))
            raw = _raw(model, x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw), pa.array(_spot(raw)[0])], ["label", "raw", "node"])

    scores = map_batches(rows, scored, "label int, raw double, node bigint")
    one = F.col("label") == 1
    lots = cut(scores.groupBy("raw", "node").agg(F.count_if(one).alias("good"), F.count(F.lit(1)).alias("n")), "scores")
    bounds = lots.agg(F.max("raw"), F.sum("n"), F.sum(F.col("raw") * F.col("n")) / F.sum("n")).first()
    spread = math.sqrt(lots.agg(F.sum((F.col("raw") - bounds[2]) ** 2 * F.col("n"))).first()[0] / bounds[1])
    placed = running_offset(lots, "node", ["raw"], 2 * F.col("good") - F.col("n"), "lead")
    errors = cut(placed.select("raw", "node", (F.col("lead") + bad).alias("errors")), "errors")
    least = min(errors.agg(F.min("errors")).first()[0], good)
    level = errors.filter(F.col("errors") == least)
    count = level.count()
    middle = (count + (least == good)) // 2
    if middle == count:
        return _set(model, bounds[0], None, spread)
    above = running_offset(level, "node", ["raw"], F.lit(1), "place").filter(F.col("place") == middle).first()["raw"]
    return _set(model, lots.filter(F.col("raw") < above).agg(F.max("raw")).first()[0], above, spread)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Model:
    """A model from all labelled rows outside the held-out fold and all pairs of a good and a bad one among them.

    A key labelled twice takes the higher label. The features, a few numbers a row, meet the labels and are written
    once; sums over them, of a size that does not grow with the rows, reach the driver. The threshold is the place in
    the ranking of all these rows with the fewest errors, halfway between the scores around it. With one label only nothing can be
    compared: all weights are zero.
    """
    named = F.col(f"`{key}`")
    ask = labels.filter(named.isNotNull() & F.col(f"`{label}`").isNotNull() & ~held_out(named))
    ask = ask.groupBy(named.alias("_key")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("_label"))
    own = docs.filter(named.isNotNull() & ~held_out(named)).select(named.alias("_key"), F.col(f"`{text}`").alias("_text"))
    kind = own.schema["_key"].dataType.simpleString()
    measured = map_batches(own, _measure, f"_key {kind}, x array<double>")
    rows = cut(measured.join(ask, "_key").select(F.col("_label").alias("label"), "x"), "features")

    def total(work) -> Part:
        def added(batches: Batches) -> Batches:
            kept = None
            for batch in batches:
                part = work(np.array(batch.column(1).to_pylist(), float).reshape(-1, len(NAMES)), batch.column(0).to_numpy(zero_copy_only=False))
                kept = part if kept is None else _sum([kept, part])
            if kept is not None:
                yield pa.RecordBatch.from_arrays([pa.array(kept[0], pa.int64()), pa.array(kept[1], pa.float64())], ["at", "value"])

        sums = map_batches(rows, added, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        at = sums.column("at").to_numpy()
        order = np.argsort(at)
        return at[order], sums.column("value").to_numpy()[order]

    model, good, bad = _fit(total)
    return _threshold(rows, model, bad, good) if good and bad else model


def _measure(batches: Batches) -> Batches:
    for batch in batches:
        x = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["_key", "x"])


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``score``: above 0.7 for documents that rank above the threshold. Null texts count
    as empty; repeated rows score alike."""

    def scored(texts: list[str]) -> list[float]:
        return model.score(np.array([features(t) for t in texts]).reshape(-1, len(NAMES))).tolist()

    return docs.withColumn(name, scored_by_text(scored)(F.col(f"`{text}`")))
