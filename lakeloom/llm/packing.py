"""Cost-balanced packing of tokenized documents into sequences of fixed length."""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakeloom.llm.tasks import Batches, map_batches, only, worker_store

LENGTH = 4096
# The id that ends every document.
END = 2
# Tokens packed together: sequences are balanced inside such a block, and a task holds one block.
BLOCK = 2_000_000
# Cost of a piece of n tokens is n + n * n * QUADRATIC: attention equals the rest at 8,192 tokens.
QUADRATIC = 1 / 8192
# Words whose ids a worker remembers before it starts anew.
KNOWN = 1_000_000


# Words without white space whose normal form and splitting follow from letters and digits alone.
_PLAIN = re.compile("[!-~\u00a1-\u024f]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")


class Encoder:
    """Token ids of texts, word by word.

    The tokenizer never lets a token cross white space, so equal words have equal ids and are encoded once.
    A word of Latin letters is split by the tokenizer's own pattern and its parts go straight to its merges;
    any other word, a word that may hold a special token, and a text with separators that only Python calls
    white space go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.parts = worker_store("packing", path, "words", "parts")
        made = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in made["normalizer"]["normalizers"]]
        self.plain = steps == ["NFC", "Replace", "Lowercase"]
        self.pattern = regex.compile(made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]) if self.plain else None
        table = sorted(set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256)))
        spare = [b for b in range(256) if b not in table]
        self.letters = {b: chr(b) for b in table} | {b: chr(256 + i) for i, b in enumerate(spare)}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            ids = self.parts[part] = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        if self.plain and _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join([self._part(p) for p in self.pattern.findall(word.lower())])
        return self._whole(word)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known
        split = [None if _ODD_SPACE.search(t) else t.split() for t in texts]
        for word in set().union(*[w for w in split if w]).difference(known):
            known[word] = self._word(word)
        made = [self._whole(t) if w is None else b"".join(map(known.__getitem__, w)) for t, w in zip(texts, split)]
        for store in (self.known, self.parts):
            if len(store) > KNOWN:
                store.clear()
        end = np.array([END], "<u4").tobytes()
        return [np.frombuffer(m + end, "<u4") for m in made]


def balance(lengths: list[int], capacity: int = LENGTH, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Place documents of the given lengths; returns (document, start, length, sequence, offset) per piece.

    As few sequences as can hold all tokens are opened. Documents longer than a sequence are cut into full
    pieces first. Then pieces go, longest first, to the sequence of lowest cost that has room; if none has, the
    piece is cut at the largest room left and its rest takes its turn again. Ties go to the earlier one.
    """
    total = sum(lengths)
    room = np.full(-(-total // capacity), capacity, np.int64)
    cost = np.zeros(len(room))
    placed, queue, full = [], [], 0

    def put(doc: int, start: int, n: int, k: int) -> None:
        placed.append((doc, start, n, k, int(capacity - room[k])))
        room[k] -= n
        cost[k] += n + quadratic * n * n

    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= capacity:
            put(doc, start, capacity, full)
            full, start = full + 1, start + capacity
        if n > start:
            queue.append((start - n, doc, start))
    heapq.heapify(queue)
    while queue:
        n, doc, start = heapq.heappop(queue)
        n = -n
        open_to = np.flatnonzero(room >= n)
        if len(open_to):
            put(doc, start, n, int(open_to[np.argmin(cost[open_to])]))
        else:
            k = int(np.argmax(room))
            part = int(room[k])
            put(doc, start, part, k)
            heapq.heappush(queue, (part - n, doc, start + part))
    return placed


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = LENGTH,
    quadratic: float = QUADRATIC,
    block: int = BLOCK,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place: the key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, and the ``ids`` themselves if asked for.

    Every task packs its documents in blocks of ``block`` tokens as it reads them; nothing is shuffled, and a
    repeated task makes the same sequences from the same rows. At most one sequence's worth of padding
    arises per block. Null and empty texts are the end id alone; a null key stays null; repeated rows are packed as
    often as they come; an empty table gives no rows. Other columns are not read.
    """
    kind = only(docs, key).schema[0].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        encoder = Encoder(tokenizer)
        home, made = TaskContext.get().partitionId() << 36, 0
        keys, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, keys, held, size
            placed = balance([len(h) for h in held], capacity, quadratic)
            doc, start, length, sequence, offset = (list(c) for c in zip(*placed)) if placed else ([],) * 5
            pieces = [held[d][s : s + n] for d, s, n in zip(doc, start, length)]
            columns = {
                key: pa.array([keys[d] for d in doc], key_type),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64()),
                "doc_tokens": pa.array([len(held[d]) for d in doc], pa.int64()),
                "sequence_id": pa.array([home + made + s for s in sequence], pa.int64()),
                "offset": pa.array(offset, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([p.astype(np.int32) for p in pieces], pa.list_(pa.int32()))
            made += -(-size // capacity)
            keys, held, size = [], [], 0
            return pa.RecordBatch.from_pydict(columns)

        key_type = None
        for batch in batches:
            key_type = batch.schema[0].type
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for name, ids in zip(names, encoder.encode(texts)):
                keys.append(name)
                held.append(ids)
                size += len(ids)
                if size >= block:
                    yield flush()
        if held:
            yield flush()

    schema = f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return map_batches(only(docs, key, text), work, schema + (", ids array<int>" if with_ids else ""), 500)
