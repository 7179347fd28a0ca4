"""Toxicity scores of texts restored from disguised spelling.

A word written with look-alike signs, gaps or stretched letters becomes a lattice: every sign may stand for
itself, for letters it resembles, or for nothing. Viterbi search under a character trigram model of the corpus
takes the cheapest path. A list of words and word beginnings learned from labelled documents then scores the
restored text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.tasks import Batches, free_name, map_batches, only, scored_by_text, worker_store
from lakeloom.session import cut

# Labelled rows used to learn, at most; taken in the order of a hash of their key.
SAMPLE = 20_000
# Word beginnings looked at, in characters.
STEMS = (4, 5, 6, 7)
# Features whose counts a task holds before it passes them on.
COUNTED = 200_000
# Words whose reading a worker remembers.
KNOWN = 300_000

# The alphabet of the character model: word boundary, any other sign, a to z, and Latin letters with accents.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7) + "œ"
EDGE, OTHER = 0, 1
SIZE = len(LETTERS) + 2
CODE = {c: i + 2 for i, c in enumerate(LETTERS)}

# Look-alikes: the letters a sign may stand for.
ALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
GAPS = frozenset("-._*~'’/\\:,;^`=#%&\"")
AROUND = ".,;:?\"'()[]{}…«»“”‘’*#%&~^_`<>=/\\-–—"

# Channel costs, in nats.
COST_ALIKE, COST_DROP, COST_SIGN, COST_PAIR, COST_RUN, COST_GAP, COST_BREAK = 1.5, 4.0, 6.0, 4.0, 0.5, 1.0, 2.0

_RUN = re.compile(rf"([{LETTERS}])\1")
_EDGE_RUN = re.compile(r"^([$!|+@])\1+|([$!|+@])\2+$")
_SAME = re.compile(r"(.)\1*", re.S)
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")


# --- character model -------------------------------------------------------------------------------------


def _codes(words: list[str]) -> np.ndarray:
    """Codes of the words, two boundaries in front of each and after the last."""
    line = np.frombuffer(("  " + "  ".join(words) + "  ").encode("utf-32-le", "surrogatepass"), "<u4")
    table = np.full(0x180, OTHER, np.int64)
    for letter, code in CODE.items():
        table[ord(letter)] = code
    table[32] = EDGE
    return np.where(line < 0x180, table[np.minimum(line, 0x17F)], OTHER)


def _count_trigrams(batches: Batches) -> Batches:
    total = np.zeros(SIZE**3)
    for batch in batches:
        words: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            words.update((text or "").lower().split())
        plain: Counter[str] = Counter()
        for word, n in words.items():
            if (bare := word.strip(AROUND)).isalpha():
                plain[bare] += n
        if plain:
            c = _codes(list(plain))
            often = np.repeat(list(plain.values()), [len(w) + 2 for w in plain])
            inside = (c[1:-1] != EDGE) | (c[2:] != EDGE)
            # Position i belongs to the word whose two boundaries and letters it runs through.
            index = (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:]
            n = len(often)
            total += np.bincount(index[:n], often * inside[:n], SIZE**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen].astype(np.int64))], ["gram", "n"])


def character_costs(docs: DataFrame, text: str = "text") -> np.ndarray:
    """-log P(third | first, second) for all trigrams of the alphabet, from the words of all texts that are letters alone but for signs around them.

    Counts are summed in the tasks; at most ``SIZE ** 3`` numbers (a quarter million) reach the driver, whatever
    the size of the corpus.
    """
    grams = map_batches(only(docs, text), _count_trigrams, "gram bigint, n bigint")
    counts = np.zeros(SIZE**3)
    for row in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    one = counts.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    two = counts.sum(0)
    p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
    p3 = (counts + 20 * p2) / (counts.sum(2, keepdims=True) + 20)
    return -np.log(p3).reshape(-1)


# --- lattice ---------------------------------------------------------------------------------------------


def run_length(line: str, at: int) -> int:
    """How often the sign at ``at`` is repeated from there on."""
    match = _SAME.match(line, at)
    return match.end() - at if match else 1


def arcs(line: str, at: int) -> list[tuple[int, str, float]]:
    """(characters read, characters written, channel cost) of every reading of the run of equal signs at ``at``.

    A space written ends a word.
    """
    c, run = line[at], run_length(line, at)
    if c in " \t":
        return [(1, "", COST_GAP / 2), (1, " ", 0.0)]
    if c in CODE:
        plain = [(run, c * run, 0.0)]
        if run == 2:
            plain.append((run, c, COST_PAIR))
        return plain if run < 3 else [*plain, (run, c, COST_RUN), (run, c + c, COST_RUN)]
    if c in ALIKE:
        found = [(run, letter * run, COST_ALIKE * run) for letter in ALIKE[c]]
        if run >= 2:
            found += [(run, letter, COST_ALIKE + COST_RUN) for letter in ALIKE[c]]
        found.append((run, "\0" * run, COST_SIGN * run) if c.isdigit() else (run, "", COST_DROP))
        return found
    if c in GAPS or not c.isalnum():
        return [(run, "", COST_GAP), (run, " ", COST_BREAK)]
    return [(run, "\0" * run, 0.0)]


def decode(line: str, costs) -> str:
    """The cheapest reading of a lower-case line; signs that are no letters of the alphabet become ``\\0``."""
    return search(line, costs)[0]


def search(line: str, costs) -> tuple[str, float]:
    """The cheapest reading of a lower-case line and its cost.

    Where all open paths share one state their common part is settled and forgotten, so memory grows with the
    ambiguous stretches of a line and time with its length.
    """
    # Place -> state -> (cost, place before, state before, written); a state is the last two codes.
    layers: dict[int, dict] = {0: {(EDGE, EDGE): (0.0, -1, None, "")}}
    done: list[str] = []
    open_places = {0}

    def settle(place: int, state) -> None:
        path = []
        while layers[place][state][1] >= 0:
            _, before, previous, written = layers[place][state]
            path.append(written)
            place, state = before, previous
        done.extend(reversed(path))

    at = 0
    while at < len(line):
        states = layers.get(at)
        if states is None:
            at += 1
            continue
        if len(states) == 1 and len(open_places) == 1 and len(layers) > 64:
            state = next(iter(states))
            settle(at, state)
            layers = {at: {state: (states[state][0], -1, None, "")}}
            states = layers[at]
        found = arcs(line, at)
        open_places.discard(at)
        for state, (cost, *_) in states.items():
            for read, written, channel in found:
                a, b = state
                total = cost + channel
                for w in written:
                    if w == " ":
                        if b == EDGE:
                            continue
                        total += costs[(a * SIZE + b) * SIZE + EDGE]
                        a = b = EDGE
                    else:
                        code = CODE.get(w, OTHER)
                        total += costs[(a * SIZE + b) * SIZE + code]
                        a, b = b, code
                layer = layers.setdefault(at + read, {})
                open_places.add(at + read)
                known = layer.get((a, b))
                if known is None or total < known[0]:
                    layer[a, b] = (total, at, state, written)
        at += found[0][0]
    end = {s: v[0] + (costs[(s[0] * SIZE + s[1]) * SIZE + EDGE] if s[1] != EDGE else 0) for s, v in layers[len(line)].items()}
    last = min(end, key=lambda s: (end[s], s))
    settle(len(line), last)
    return "".join(done), end[last]


def cores(token: str) -> list[str]:
    """The token without the signs around it, and, where a doubled sign stands at its edge, with that read as letters."""
    core = token.rstrip(AROUND + "!").lstrip(AROUND)
    bare = core
    for sign in "$!|+@":
        if bare.endswith(2 * sign):
            bare = bare.rstrip(sign + AROUND)
        if bare.startswith(2 * sign):
            bare = bare.lstrip(sign + AROUND)
    if not bare or not _EDGE_RUN.search(core):
        return [bare]
    letters = [_EDGE_RUN.sub(lambda m: ALIKE[m[0][0]][k % len(ALIKE[m[0][0]])] * len(m[0]), core) for k in (0, 1)]
    return list(dict.fromkeys([bare, *letters]))


def read(core: str, costs) -> tuple[str, ...]:
    """The words a core stands for. One whose lattice has one path alone needs no search; one without a letter stands
    for words only if they are cheaper than its signs as they are."""
    if core.isalpha() and not _RUN.search(core):
        return (core,)
    if not core:
        return ()
    found, cost = search(core, costs)
    if core.isalpha() and "\0" in found:
        return (core,)
    if not any(c.isalpha() for c in core) and ("\0" in found or cost >= COST_SIGN * sum(c in ALIKE for c in core)):
        return ()
    return tuple(found.split())


def readings(token: str, costs) -> tuple[str, ...]:
    """The words a lower-case token may stand for; a doubled sign at its edge is tried as noise and as letters."""
    if token.isalpha() and not _RUN.search(token):
        return (token,)
    return tuple(dict.fromkeys(w for core in cores(token) for w in read(core, costs)))


def spaced(text: str) -> list[str]:
    """Runs of three or more single characters between white space."""
    return [m for m in _SPACED.findall(text) if len(set(m)) > 2]


def restore(text: str, costs) -> str:
    """The text in lower case with disguised words put back."""
    text = text.lower()
    for run in spaced(text):
        text = text.replace(run, decode(run, costs), 1)
    return " ".join(w for t in text.split() for w in readings(t, costs))


# --- learning --------------------------------------------------------------------------------------------


@dataclass
class Model:
    """``costs``: the character model. ``weights``: feature -> share of toxic documents that hold it.
    ``base``: share of toxic documents without any feature."""

    costs: np.ndarray
    weights: dict[str, float]
    base: float


def features(word: str) -> list[str]:
    """Beginnings of a word, and the word itself marked by ``=``."""
    return [f"={word}", *[word[:k] for k in STEMS if len(word) >= k]]


def _words(text: str, costs, known: dict) -> set[str]:
    text = text.lower()
    found: set[str] = set()
    for token in set(text.split()):
        words = known.get(token)
        if words is None:
            words = readings(token, costs)
            if len(known) < KNOWN:
                known[token] = words
        found.update(words)
    for run in spaced(text):
        found.update(decode(run, costs).split())
    return found


def _counting(costs: np.ndarray):
    """Number of toxic and of other documents with each feature."""

    def work(batches: Batches) -> Batches:
        table, known, total = costs.tolist(), {}, (Counter(), Counter())

        def passed() -> pa.RecordBatch:
            names = [*total[1], *(f for f in total[0] if f not in total[1])]
            counts = [pa.array([t[f] for f in names], pa.int64()) for t in (total[1], total[0])]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["feature", "n", "m"])

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[label == 1].update({f for w in _words(text or "", table, known) for f in features(w)})
            if len(total[0]) + len(total[1]) > COUNTED:
                yield passed()
                total[0].clear(), total[1].clear()
        yield passed()

    return work


def _holding(costs: np.ndarray, chosen: frozenset[str]):
    """Of each toxic document, the features among those chosen that it holds."""

    def work(batches: Batches) -> Batches:
        table, known = costs.tolist(), {}
        for batch in batches:
            rows = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if label == 1:
                    rows.append(sorted({f for w in _words(text or "", table, known) for f in features(w) if f in chosen}))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["held"])

    return work


def held_out(key: Column) -> Column:
    """Rows that no model learns from."""
    return F.crc32(key.cast("string")) % 4 == 2


def _signatures(batches: Batches) -> Batches:
    """Three minima over differently mixed hashes of a text's three-word shingles, beside text and label."""
    mixes = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            words = text.split()
            grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
            hashes = np.array([xxhash.xxh64_intdigest(g) for g in grams], np.uint64)
            rows.append([int((hashes ^ m).min() >> np.uint64(1)) for m in mixes])
        columns = [batch.column(0), batch.column(1), *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]]
        yield pa.RecordBatch.from_arrays(columns, ["text", "label", "s0", "s1", "s2"])


def labelled(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, bound: int) -> DataFrame:
    """(text, label) of at most ``bound`` labelled texts outside the held-out fold, copies and near copies once.

    The labels are cut to the bound by the order of a hash before they meet the texts, so what is broadcast has
    a fixed size. A key labelled twice takes the higher label; null keys and labels are left out. Texts with one label that
    agree in all of three minimum hashes count as copies: their words would else pass for independent evidence.
    """
    named = F.col(f"`{key}`")
    ask = labels.filter(named.isNotNull() & F.col(f"`{label}`").isNotNull() & ~held_out(named))
    ask = ask.groupBy(named.alias("_key")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("_label"))
    ask = ask.orderBy(F.xxhash64("_key"), "_key").limit(bound)
    own = docs.select(named.alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = own.join(F.broadcast(ask), "_key").select("text", F.col("_label").alias("label"))
    found = map_batches(found, _signatures, "text string, label int, s0 bigint, s1 bigint, s2 bigint", 500)
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    found = found.groupBy("s0", "s1", "s2", "label").agg(first)
    return found.select("text", "label")


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", bound: int = SAMPLE) -> Model:
    """The character model of all documents, and the word list learned from at most ``bound`` labelled rows.

    A word or stem is listed if the documents that hold it are toxic far more often than the rest (likelihood
    ratio above 2 ln of the number of features: about one is expected by chance) and mostly toxic. Of stems
    and words with equal counts the longest stem stands for all. A feature that clean documents hold too must
    bring as many toxic documents that no surer feature covers, so a stem gives way to the longer one it is part
    of. Without toxic labels the list is empty.
    """
    costs = character_costs(docs, text)
    sample = cut(labelled(docs, labels, label, key, text, bound), "sample")
    tally = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = tally.get(1, 0), tally.get(0, 0)
    if not bad:
        return Model(costs, {}, 0.0)
    share = bad / (bad + good)
    counts = map_batches(sample, _counting(costs), "feature string, n bigint, m bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    seen = cut(counts.filter("n > 0"), "features")
    bar = 2 * math.log(max(seen.count(), 10))
    # The likelihood ratio is taken where the counts are; what is far above chance, a short list, reaches the driver.
    n, m = F.col("n"), F.col("m")
    part = lambda x, p: F.when(x > 0, x * F.log(x / (n + m) / p)).otherwise(0.0)
    weight = ((n + share) / (n + m + 1)).alias("weight")
    rated = seen.select("feature", "n", "m", weight, (2 * (part(n, share) + (part(m, 1 - share) if good else F.lit(0.0)))).alias("ratio"))
    rows = rated.filter((F.col("weight") >= 0.5) & (F.col("ratio") > bar) & (n >= 3)).collect()
    weights, b = {r["feature"]: r["weight"] for r in rows}, {r["feature"]: r["m"] for r in rows}
    apart = {f: w for f, w in weights.items() if not any(weights.get(g) == w and g != f for g in _wider(f, weights))}
    holding = map_batches(sample, _holding(costs, frozenset(apart)), "held array<string>").collect()
    uncovered = [frozenset(r["held"]) for r in holding]
    chosen: dict[str, float] = {}
    for feature in sorted(apart, key=lambda f: (-apart[f], -len(f), f)):
        wrong = b.get(feature, 0)
        if not wrong or sum(feature in held for held in uncovered) >= wrong:
            chosen[feature] = apart[feature]
            uncovered = [held for held in uncovered if feature not in held]
    base = len(uncovered) / max(1, len(uncovered) + good - min(good, sum(b.get(f, 0) for f in chosen)))
    return Model(costs, chosen, min(base, 0.25))


def _wider(feature: str, weights: dict[str, float]) -> list[str]:
    """Listed stems with the same count that make the feature needless: for a word its stems, for a stem the longer ones."""
    if feature.startswith("="):
        return [s for s in features(feature[1:])[1:] if s in weights]
    return [s for s in weights if len(s) > len(feature) and s.startswith(feature)]


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``score``: 1 minus the product of (1 - weight) over the listed words and stems
    that the restored text holds, and over the base rate. A null or empty text scores the base rate."""
    weights, base, costs = model.weights, model.base, model.costs
    store = str(hash((tuple(sorted(weights.items())), base, float(costs.sum()))))

    def scored(texts: list[str]) -> list[float]:
        once, tokens = worker_store("toxicity", store, "once", "tokens")
        if "table" not in once:
            once["table"] = costs.tolist()
        table = once["table"]

        def hits(words) -> tuple[str, ...]:
            return tuple({f for w in words for f in features(w) if f in weights})

        out = []
        for text in texts:
            text = text.lower()
            found: set[str] = set()
            for token in set(text.split()):
                hit = tokens.get(token)
                if hit is None:
                    hit = hits(readings(token, table))
                    if len(tokens) < KNOWN:
                        tokens[token] = hit
                if hit:
                    found.update(hit)
            for run in spaced(text):
                found.update(hits(decode(run, table).split()))
            rest = 1 - base
            for f in found:
                rest *= 1 - weights[f]
            out.append(1 - rest)
        return out

    return docs.withColumn(name, scored_by_text(scored)(F.col(f"`{text}`")))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns."""
    name = free_name(docs, "_score")
    return score(docs, learn(docs, labels, key=key, text=text), text, name).filter(F.col(name) < threshold).drop(name)
