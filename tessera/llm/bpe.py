"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can end its encoding. It is
found from the tokens that end there: the one that follows the last token of
the shorter prefix it leaves without merging across their border. The table
of last tokens is the whole state, so appending bytes continues it, an edit
recomputes only from the edit to where the old table is met again, and the
ids are read backwards from the end.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import cut, plain_texts, row_blocks, sha256_rows
from tessera.llm.common import column_of, text_list
from tessera.llm.pieces import PATTERN, Kept, SegmentTable

_SHIFT, _PAIRS = 20, 1_000_000


class Vocabulary:
    """Token bytes by rank, and which two tokens may stand side by side."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.text_of = {r: str(r) for r in self.bytes}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}
        self.ends = ahocorasick.Automaton()
        for t, r in self.rank.items():
            if self.whole(r):
                self.ends.add_word(t.decode("latin-1"), (r, len(t)))
        self.ends.make_automaton()
        self.pieces = Kept(self.encode_piece)
        self.table = SegmentTable(self.encode_segment)
        self.kept = Kept(self._values)

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None if none do."""
        if token not in self._parts:
            whole = self.bytes[token]
            seq = [self.rank[whole[i : i + 1]] for i in range(len(whole))]
            while len(seq) > 2:
                ranks = [self.rank.get(self.bytes[a] + self.bytes[b], token) for a, b in zip(seq, seq[1:])]
                low = min(ranks)
                if low >= token:
                    break
                i = ranks.index(low)
                seq[i : i + 2] = [low]
            self._parts[token] = (seq[0], seq[1]) if len(seq) == 2 else None
        return self._parts[token]

    def whole(self, token: int) -> bool:
        """Whether the token encodes its own bytes."""
        return len(self.bytes[token]) == 1 or self.parts(token) is not None

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether left + right encodes as these two.

        The merges that made both are undone, latest first; the two parts at
        the border must never have been mergeable before the next one undone."""
        key = left << _SHIFT | right
        known = self._pairs.get(key)
        if known is not None:
            return known
        a, b, before, good = left, right, float("inf"), None
        while good is None:
            joined = self.rank.get(self.bytes[a] + self.bytes[b])
            made_a = a if len(self.bytes[a]) > 1 else -1
            made_b = b if len(self.bytes[b]) > 1 else -1
            if joined is not None and joined < before:
                good = False
            elif made_a < 0 and made_b < 0:
                good = True
            elif made_a > made_b:
                before, a = made_a, self.parts(a)[1]
            else:  # of equal ranks the left one merges first
                before, b = made_b + 1, self.parts(b)[0]
        if len(self._pairs) >= _PAIRS:
            self._pairs.clear()
        self._pairs[key] = good
        return good

    def extend(self, last: list[int], data: bytes, start: int, stop: int) -> None:
        """Fill last[start:stop], the last tokens of the prefixes of ``data``."""
        del last[start:]
        low = max(0, start - self.longest)
        known = self._pairs.get
        for end, (token, size) in self.ends.iter(data[low:stop].decode("latin-1")):
            if end + low != len(last):  # before the start, or settled already
                continue
            if size == end + low + 1:
                fits = True
            elif (fits := known(last[-size] << _SHIFT | token)) is None:
                fits = self.side_by_side(last[-size], token)
            if fits:
                last.append(token)
        if len(last) != stop:
            raise ValueError("the vocabulary lacks a byte")

    def ids(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes[out[-1]])
        return out[::-1]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        if (token := self.rank.get(data)) is not None:
            return (token,)
        last: list[int] = []
        self.extend(last, data, 0, len(data))
        return tuple(self.ids(last))

    def encode_segment(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, PATTERN.findall(text))))

    def encode(self, text: str) -> list[int]:
        """Ids of a text, each pattern match by itself, no special tokens."""
        return self.table.of(text, lambda values: [*chain.from_iterable(values)])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def _values(self, key: str) -> tuple[int, str, bytes]:
        ids = self.encode_segment(key)
        return len(ids), ",".join(map(self.text_of.__getitem__, ids)), self.decode(ids)

    def digests(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, list[str], list[str]]]:
        """Block by block and by text (no nulls): the number of ids, SHA-256
        of the ids in decimal and of the bytes decoded from them."""
        for i, j in row_blocks(texts):
            keys, block = cut(texts[i:j]).with_heads()
            values = list(map(self.kept.__getitem__, keys))
            n = np.fromiter((v[0] for v in values), np.int64, len(values))
            ids, data = pa.array([v[1] for v in values], pa.string()), pa.array([v[2] for v in values], pa.binary())
            yield block.sums(n), sha256_rows(block.joined(ids, ",")), sha256_rows(block.joined(data, ""))


class PieceEditor:
    """One growing or edited byte string with its table of last tokens."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        n = len(self.data)
        self.data += more
        self.vocabulary.extend(self.last, self.data, n, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:stop]; returns bytes recomputed."""
        old, self.data = self.last, self.data[:start] + new + self.data[stop:]
        shift, same = start + len(new) - stop, 0
        self.last, at = old[:start], start
        while at < len(self.data) and same < self.vocabulary.longest:
            self.vocabulary.extend(self.last, self.data, at, at + 1)
            same = same + 1 if at >= start + len(new) and old[at - shift] == self.last[at] else 0
            at += 1
        self.last += old[at - shift :]
        return at - start

    def ids(self) -> list[int]:
        return self.vocabulary.ids(self.last)


_VOCABULARIES: dict[str, Vocabulary] = {}  # one per worker process and file


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, sha256 of the ids (decimal, comma-joined) and of the
    bytes decoded from them, for every row.

    Null and empty texts have no ids; repeated rows and null ids are kept; an
    empty table gives no rows; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for part in vocabulary(path).digests(plain_texts(column_of(b, "text"))):
                for column, values in zip((n, of_ids, of_bytes), part):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): the encodings themselves; rows as above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = pa.array([vocabulary(path).encode(t) for t in text_list(b)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), ids], ["doc_id", "ids"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids array<int>")
