"""Encoding and decoding with a SentencePiece byte-pair vocabulary, by a suffix array over the text.

The distinct words of a batch are put into one text and its suffixes are sorted. Every piece of the vocabulary is looked
up by binary search; its range in the suffix array lists all places where it occurs. These occurrences are the
edges of a graph over text positions. Sorted by position they are relaxed one by one: a position is reached by the
one piece that byte-pair merging would leave last there, which holds if merging never joins it with the piece before.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.tasks import Batches, map_batches, only, worker_store

# Characters indexed together.
TEXT = 1_000_000
# Words whose ids a worker remembers; beyond, it keeps the first half.
KNOWN = 600_000
# Words of more characters are relaxed place by place; shorter ones all together, by distance from their start.
LONG = 400
SPACE = "▁"

_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NEVER = np.int64(1 << 40)


@dataclass
class Vocabulary:
    """Pieces by id (empty: none to match), the ids of single bytes, the order in which pieces are merged (-1: a
    single character), the two parts each was merged from, and all pairs that merge: key l * size + r -> rank."""

    pieces: list[str]
    first_byte: int
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray

    @property
    def size(self) -> int:
        return len(self.pieces)


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file. A piece that merging its own characters does not give is never used."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    usual = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
    pieces = [model.id_to_piece(i) if usual[i] else "" for i in range(n)]
    ids = {p: i for i, p in enumerate(pieces) if p}
    first_byte = next((i for i in range(n) if model.is_byte(i)), -1)
    order = sorted((i for p, i in ids.items() if len(p) > 1), key=lambda i: (-model.get_score(i), i))
    rank = np.full(n, -1, np.int64)
    rank[order] = np.arange(len(order))
    pairs = {}
    for p, i in ids.items():
        for k in range(1, len(p)):
            l, r = ids.get(p[:k]), ids.get(p[k:])
            if l is not None and r is not None:
                pairs[l, r] = i
    left, right = np.arange(n), np.arange(n)
    for i in order:
        parts = [ids.get(c) for c in pieces[i]]
        while len(parts) > 2:
            best = min((rank[pairs[p]], k) for k, p in enumerate(zip(parts, parts[1:])) if p in pairs) if any(
                p in pairs for p in zip(parts, parts[1:])
            ) else None
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [pairs[parts[k], parts[k + 1]]]
        if len(parts) == 2 and pairs.get(tuple(parts)) == i:
            left[i], right[i] = parts
        else:
            pieces[i] = ""
    keys = np.array([l * n + r for l, r in pairs if pieces[pairs[l, r]]], np.int64)
    ranks = np.array([rank[i] for i in pairs.values() if pieces[i]], np.int64)
    by = np.argsort(keys)
    return Vocabulary(pieces, first_byte, rank, left, right, keys[by], ranks[by])


def order_of(keys: np.ndarray) -> np.ndarray:
    """The places of the keys (from 0) in ascending order. Key and place are sorted as one number where 63 bits hold both."""
    bits = int(len(keys)).bit_length()
    if not len(keys) or int(keys.max()).bit_length() + bits > 63:
        return np.argsort(keys)
    return np.sort((keys << bits) | np.arange(len(keys))) & ((1 << bits) - 1)


class Matcher:
    """Finds the ids of words over a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        letters = sorted({c for p in vocabulary.pieces for c in p})
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.other = len(letters) + 1
        top = max(map(ord, letters)) + 1
        self.table = np.full(top + 1, self.other, np.int32)
        self.table[[ord(c) for c in letters]] = np.arange(1, self.other)
        used = [i for i, p in enumerate(vocabulary.pieces) if p]
        self.ids = np.array(used, np.int64)
        self.lengths = np.array([len(vocabulary.pieces[i]) for i in used])
        self.depth = int(self.lengths.max())
        self.width = self.other.bit_length()
        codes = np.zeros((len(used), self.depth), np.int64)
        for row, i in enumerate(used):
            codes[row, : self.lengths[row]] = [self.code[c] for c in vocabulary.pieces[i]]
        self.keys = self.packed(codes)
        self.masks = self.packed(np.where(codes > 0, (1 << self.width) - 1, 0))
        # A stranger to the vocabulary is a token of its own, beyond all ids; it never merges.
        self.stranger = vocabulary.size
        self.rank = np.append(vocabulary.rank, -1)
        self.left, self.right = np.append(vocabulary.left, self.stranger), np.append(vocabulary.right, self.stranger)
        self.pairs: dict[int, int] | None = None
        # Pairs that merge, in an open hash table of a power of two with few collisions.
        self.bits = max(4, int(np.ceil(np.log2(4 * len(vocabulary.pair_keys) + 4))))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NEVER)
        keys, ranks = vocabulary.pair_keys, vocabulary.pair_ranks
        at = self._slot(keys)
        while len(keys):
            free = self.slots[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            here = np.flatnonzero(free)[first]
            self.slots[at[here]], self.values[at[here]] = keys[here], ranks[here]
            rest = np.setdiff1d(np.arange(len(keys)), here)
            keys, ranks, at = keys[rest], ranks[rest], (at[rest] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Rank of the piece that two adjacent pieces merge to; a very large number where none exists."""
        key = l * self.v.size + r
        key[(l >= self.v.size) | (r >= self.v.size)] = -2
        at = self._slot(key)
        out = np.full(len(key), _NEVER)
        todo = np.arange(len(key))
        while len(todo):
            held = self.slots[at[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
        return out

    def apart(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Whether merging leaves ``l`` and ``r``, side by side, as they are.

        The merges are undone from the last one: the piece of higher rank was made later (of equal ones the right).
        At every point the two pieces at the border must not merge before the step that is undone next.
        """
        good = np.ones(len(l), bool)
        live = np.arange(len(l))
        l, r, limit = l.copy(), r.copy(), np.full(len(l), _NEVER)
        while len(live):
            join = self.merged(l, r) < limit
            good[live[join]] = False
            a, b = self.rank[l], self.rank[r]
            go = ~join & (np.maximum(a, b) >= 0)
            live, l, r, a, b = live[go], l[go], r[go], a[go], b[go]
            late = a > b
            limit = np.where(late, a, b + 1)
            l, r = np.where(late, self.right[l], l), np.where(late, r, self.left[r])
        return good

    def suffixes(self, text: np.ndarray) -> np.ndarray:
        """Positions of the text in the order of their suffixes, as far as the longest piece reaches.

        The first sort takes three characters at once, each further one doubles that.
        """
        width, rank = 3, text.astype(np.int64)
        padded = np.concatenate([rank, [0, 0]])
        rank = (rank * (self.other + 1) + padded[1:-1]) * (self.other + 1) + padded[2:]
        while True:
            order = order_of(rank)
            ordered = rank[order]
            fresh = np.empty(len(rank), np.int64)
            fresh[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            if width >= self.depth:
                return order
            follow = np.zeros(len(rank), np.int64)
            follow[:-width] = fresh[width:] + 1
            rank = fresh * (len(rank) + 1) + follow
            width *= 2

    def packed(self, codes: np.ndarray) -> np.ndarray:
        """Rows of character codes as rows of few whole numbers in the same order; missing characters count as 0."""
        per = 62 // self.width
        whole = np.zeros((len(codes), -(-self.depth // per) * per), np.int64)
        whole[:, : codes.shape[1]] = codes
        out = np.zeros((len(codes), whole.shape[1] // per), np.int64)
        for k in range(per):
            out = (out << self.width) | whole[:, k::per]
        return out

    def ranges(self, text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per piece the first and the end place of its occurrences in the suffix array, by binary search.

        Suffixes are compared as numbers of several characters each, cut to the length of the piece by its mask.
        """
        per, parts = 62 // self.width, self.keys.shape[1]
        padded = np.concatenate([text.astype(np.int64), np.zeros(per * parts, np.int64)])
        run = np.zeros(len(padded) - per + 1, np.int64)
        for k in range(per):
            run = (run << self.width) | padded[k : k + len(run)]

        def search(past: bool) -> np.ndarray:
            low, high = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), len(order), np.int64)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    return low
                mid = (low[open_] + high[open_]) // 2
                at, less, same = order[mid], np.zeros(len(open_), bool), np.ones(len(open_), bool)
                for part in range(parts):
                    seen, want = run[at + part * per] & self.masks[open_, part], self.keys[open_, part]
                    less |= same & (seen < want)
                    same &= seen == want
                before = less | same if past else less
                low[open_[before]] = mid[before] + 1
                high[open_[~before]] = mid[~before]

        return search(False), search(True)

    def words(self, words: list[str]) -> list[np.ndarray]:
        """The pieces of each word; characters outside the vocabulary as their bytes' ids."""
        sizes = np.array([len(w) for w in words], np.int64)
        line = np.frombuffer("\0".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        begin = np.cumsum(np.concatenate([[0], sizes[:-1] + 1]))
        border = np.zeros(len(line), bool)
        border[begin[1:] - 1] = True
        text = np.where(line < len(self.table), self.table[np.minimum(line, len(self.table) - 1)], self.other)
        text[border] = 0
        order = self.suffixes(text)
        low, high = self.ranges(text, order)
        # Edges: where they start, their piece and their length; strangers lead one step on.
        count = high - low
        take = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        start, token, span = order[take], np.repeat(self.ids, count), np.repeat(self.lengths, count)
        alien = np.flatnonzero(text == self.other)
        start, token, span = np.concatenate([start, alien]), np.concatenate([token, np.full(len(alien), self.stranger)]), np.concatenate([span, np.ones(len(alien), np.int64)])
        origin = np.repeat(begin, sizes + 1)[: len(line)]
        depth = start + span - origin[start]
        last, back = np.full(len(line) + 1, -1, np.int64), np.zeros(len(line) + 1, np.int64)
        long = np.repeat(sizes > LONG, sizes + 1)[: len(line)][start]
        if long.any():
            self._relax_long(start[long], token[long], span[long], origin, last, back)
            start, token, span, depth = start[~long], token[~long], span[~long], depth[~long]
        # By distance from the start of the word, then by place, longest first.
        by = order_of((depth * (len(line) + 1) + start + span) * 32 + (31 - span))
        start, token, span, depth = start[by], token[by], span[by], depth[by]
        cuts = np.flatnonzero(np.diff(depth, prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:]):
            self._relax(start[a:b], token[a:b], span[a:b], origin, last, back)
        return self._trace(words, line, begin, sizes, last, back)

    def _relax(self, start, token, span, origin, last, back) -> None:
        """Edges that end at the same distance from their words' starts; a place takes the first edge that fits."""
        end = start + span
        while len(end):
            lead = np.concatenate([[True], end[1:] != end[:-1]])
            s, t, e = start[lead], token[lead], end[lead]
            before = last[s]
            fits = origin[np.minimum(s, len(origin) - 1)] == s
            inner = np.flatnonzero(~fits)
            if len(inner):
                fits[inner] = self.apart(before[inner], t[inner])
            last[e[fits]], back[e[fits]] = t[fits], s[fits]
            rest = ~lead & (last[end] < 0)
            start, token, end = start[rest], token[rest], end[rest]

    def _relax_long(self, start, token, span, origin, last, back) -> None:
        """The same for few long words: edges by their end, the longest first, one by one."""
        by = np.argsort((start + span) * 32 + (31 - span), kind="stable")
        at_start = (origin[start] == start)[by].tolist()
        start, token, span = start[by].tolist(), token[by].tolist(), span[by].tolist()
        known: dict[tuple[int, int], bool] = {}
        final: dict[int, int] = {}
        for s, t, n, first in zip(start, token, span, at_start):
            e = s + n
            if e in final:
                continue
            if not first:
                pair = (final[s], t)
                if pair not in known:
                    known[pair] = self.stays(*pair)
                if not known[pair]:
                    continue
            final[e], last[e], back[e] = t, t, s

    def stays(self, l: int, r: int) -> bool:
        """:meth:`apart` of one pair."""
        if self.pairs is None:
            self.pairs = dict(zip(self.v.pair_keys.tolist(), self.v.pair_ranks.tolist()))
            self.rows = self.rank.tolist(), self.left.tolist(), self.right.tolist()
        rank, left, right = self.rows
        size, limit = self.v.size, int(_NEVER)
        while True:
            if l < size and r < size and self.pairs.get(l * size + r, limit) < limit:
                return False
            a, b = rank[l], rank[r]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, l = a, right[l]
            else:
                limit, r = b + 1, left[r]

    def _trace(self, words, line, begin, sizes, last, back) -> list[np.ndarray]:
        """The pieces from the end of each word back to its start, of all words together, one piece a step."""
        at, live, steps = begin + sizes, np.arange(len(words)), []
        count = np.zeros(len(words), np.int64)
        while len(live):
            live = live[at[live] > begin[live]]
            here = at[live]
            steps.append((live, last[here], here - 1))
            count[live] += 1
            at[live] = back[here]
        ends = np.cumsum(count)
        flat, place = np.zeros(int(count.sum()), np.int64), np.zeros(int(count.sum()), np.int64)
        for step, (who, token, where) in enumerate(steps):
            flat[ends[who] - 1 - step], place[ends[who] - 1 - step] = token, where
        strange = np.flatnonzero(flat == self.stranger)
        if len(strange):
            spelled = [[b + self.v.first_byte for b in chr(c).encode("utf-8", "surrogatepass")] for c in line[place[strange]].tolist()]
            more = np.array([len(x) for x in spelled], np.int64)
            width = np.ones(len(flat), np.int64)
            width[strange] = more
            owner = np.repeat(np.arange(len(words)), count)
            longer = np.repeat(flat, width)
            longer[np.repeat(flat == self.stranger, width)] = [b for x in spelled for b in x]
            flat, ends = longer, np.cumsum(np.bincount(owner, width, len(words)).astype(np.int64))
        return np.split(flat, ends[:-1])


def split(text: str) -> list[str]:
    """Words with their leading spaces marked; no piece reaches from one word into the next."""
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Codec:
    """Encodes texts to little-endian ids and decodes them."""

    def __init__(self, vocabulary: Vocabulary, name: str = ""):
        self.matcher = Matcher(vocabulary)
        (self.known,) = worker_store("pieces", name, "words")
        v = vocabulary
        self.spelling = [p.encode("utf-8") for p in v.pieces]
        if v.first_byte >= 0:
            for b in range(256):
                self.spelling[v.first_byte + b] = bytes([b])
        if v.size > 2:
            self.spelling[1 if not v.pieces[1] and v.first_byte != 1 else 0] = b""
        self.letters = np.frombuffer(b"".join(self.spelling), np.uint8)
        self.sizes = np.array([len(x) for x in self.spelling], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [split(t) for t in texts]
        fresh = list(set().union(*parts).difference(self.known)) if parts else []
        start, size = 0, 0
        for i, word in enumerate(fresh):
            size += len(word) + 1
            if size >= TEXT or i == len(fresh) - 1:
                part = fresh[start : i + 1]
                found = self.matcher.words(part)
                raw, ends = np.concatenate(found).astype("<u4").tobytes(), (4 * np.cumsum([len(f) for f in found])).tolist()
                self.known.update((w, raw[a:b]) for w, a, b in zip(part, [0, *ends], ends))
                start, size = i + 1, 0
        made = [np.frombuffer(b"".join(map(self.known.__getitem__, p)), "<u4") for p in parts]
        if len(self.known) > KNOWN:
            # Words met first are mostly the frequent ones; they stay.
            for word in list(self.known)[KNOWN // 2 :]:
                del self.known[word]
        return made

    def decode(self, ids: np.ndarray) -> str:
        size = self.sizes[ids]
        end = np.cumsum(size)
        raw = self.letters[np.repeat(self.begins[ids] - end + size, size) + np.arange(end[-1] if len(end) else 0)].tobytes()
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Key, ``n_ids``, ``ids_crc32`` (little-endian unsigned 32-bit ids), ``decoded_crc32`` (UTF-8 of the decoded
    ids), ``round_trip`` and, if asked for, the ``ids`` of every row.

    Batches of texts are encoded inside the tasks; nothing is shuffled. Null and empty texts have no ids; repeated
    rows come back as often as they went in. A text that itself holds the space mark decodes to a space there.
    """
    kind = only(docs, key).schema[0].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        codec = Codec(vocabulary, str(hash(tuple(vocabulary.pieces))))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = codec.encode(texts)
            back = [codec.decode(i) for i in ids]
            columns = {
                key: batch.column(0),
                "n_ids": pa.array([len(i) for i in ids], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                "decoded_crc32": pa.array([zlib.crc32(b.encode("utf-8", "surrogatepass")) for b in back], pa.int64()),
                "round_trip": pa.array([a == b for a, b in zip(texts, back)], pa.bool_()),
            }
            if with_ids:
                columns["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"`{key}` {kind}, n_ids bigint, ids_crc32 bigint, decoded_crc32 bigint, round_trip boolean"
    return map_batches(only(docs, key, text), work, schema + (", ids array<int>" if with_ids else ""), 2000)


def decode(rows: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key and ``text`` of every row of ids; null ids give a null text."""
    kind = only(rows, key).schema[0].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        codec = Codec(vocabulary)
        for batch in batches:
            texts = [None if i is None else codec.decode(np.array(i, np.int64)) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return map_batches(only(rows, key, ids), work, f"`{key}` {kind}, text string", 1000)
