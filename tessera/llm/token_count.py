"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a piece form a doubly linked list; a heap holds the adjacent
pairs that the vocabulary can merge, lowest rank (then leftmost) first. Each
popped pair that still stands is merged and its new neighbours are pushed.
The count is the initial symbols minus the merges; no ids are produced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_of, text_list
from tessera.llm.pieces import PATTERN, Kept, SegmentTable

_SHIFT = 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the merge list."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(extra)) for b in range(256)]


class MergeCounter:
    """Counts tokens as a byte-level BPE ``.json`` file defines them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE file without prefix space or normalizer is needed")
        vocab = model["vocab"]
        self.symbols = [vocab[c] for c in byte_alphabet()]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[a] << _SHIFT | vocab[b], r)
            self.merged.append(vocab[a + b])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_marks = special
        self.pieces = Kept(lambda p: self.merge(p.encode()))
        self.table = SegmentTable(self.segment)

    def merge(self, piece: bytes) -> int:
        """Tokens of one piece."""
        n = len(piece)
        rank, merged = self.rank.get, self.merged
        sym = [self.symbols[b] for b in piece]
        heap = [r * n + i for i in range(n - 1) if (r := rank(sym[i] << _SHIFT | sym[i + 1])) is not None]
        heapify(heap)
        after, before, left = [*range(1, n + 1)], [*range(-1, n)], n
        while heap:
            r, i = divmod(heappop(heap), n)
            j = after[i]
            if sym[i] < 0 or j >= n or rank(sym[i] << _SHIFT | sym[j]) != r:
                continue  # one of the two has been merged meanwhile
            sym[i], sym[j] = merged[r], -1
            left -= 1
            k = after[i] = after[j]
            before[k] = i
            if k < n and (r := rank(sym[i] << _SHIFT | sym[k])) is not None:
                heappush(heap, r * n + i)
            if (h := before[i]) >= 0 and (r := rank(sym[h] << _SHIFT | sym[i])) is not None:
                heappush(heap, r * n + h)
        return left

    def segment(self, text: str) -> int:
        """Tokens of a text; strings of added tokens count one each."""
        if any(m in text for m in self.special_marks):
            return len(self.special.findall(text)) + sum(self.plain(t) for t in self.special.split(text))
        return self.plain(text)

    def plain(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, PATTERN.findall(text)))

    def count(self, text: str) -> int:
        return self.table.of(text, sum)


_COUNTERS: dict[str, MergeCounter] = {}  # one per worker process and file


def counter(path: str) -> MergeCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids
    are kept as they are; an empty table gives no rows; other columns are
    ignored. A task holds one Arrow batch and a bounded table of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, texts = counter(vocabulary).count, text_list(b)
            n = [count(t) for t in texts]
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
