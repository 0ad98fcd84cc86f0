"""Blocks of texts as indexes into their distinct segments.

A tokenizer's work on a text is its work on the text's segments (``pieces``),
and segments repeat a lot. A block of texts is cut by Arrow, its distinct
segments are handled once, and results go back to the texts as array takes
and joins; Python loops run over distinct segments only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tessera.llm.pieces import _CUT, loose

#: Bytes of text handled at once (one longer text is a block of its own).
BLOCK_BYTES = 4_000_000


def plain_texts(column: pa.Array) -> pa.Array:
    """A string column without nulls (empty instead), copied from offset 0."""
    texts = pc.fill_null(column.cast(pa.string()), "")
    return pa.concat_arrays([texts, texts[:0]])


def row_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) rows of consecutive blocks of about ``limit`` bytes."""
    end = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(end):
        before = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, before + limit, "right")))
        yield start, stop
        start = stop


@dataclass
class Block:
    """Texts of a block: ``index[offsets[r]:offsets[r + 1]]`` are the segments
    of row r, as positions in ``segments``."""

    segments: list[str]
    index: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def sums(self, values: np.ndarray) -> np.ndarray:
        """By row, the sum of a value of the segments."""
        total = np.concatenate([[0], np.cumsum(values[self.index])])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def joined(self, values: pa.Array, separator: str) -> pa.Array:
        """By row, the segments' strings (or bytes) in order, joined."""
        taken = values.take(pa.array(self.index))
        wide = pa.large_binary() if pa.types.is_binary(values.type) else pa.large_string()
        rows = pa.LargeListArray.from_arrays(pa.array(self.offsets, pa.int64()), taken.cast(wide))
        return pc.binary_join(rows, pa.scalar(separator.encode() if pa.types.is_binary(values.type) else separator, wide))

    def with_heads(self) -> tuple[list[str], "Block"]:
        """Keys as a text has them: " " + segment, and first segments without
        the space, one key for each row that has any."""
        at = self.offsets[:-1][np.diff(self.offsets) > 0]
        heads = [self.segments[k] for k in self.index[at].tolist()]
        index = self.index.copy()
        index[at] = len(self.segments) + np.arange(len(at))
        used = np.bincount(index, minlength=len(self.segments))[: len(self.segments)] > 0
        new = np.concatenate([np.cumsum(used) - 1, np.count_nonzero(used) + np.arange(len(at))])
        keys = [" " + s for s, u in zip(self.segments, used.tolist()) if u] + heads
        return keys, Block(keys, new[index], self.offsets)


def cut(texts: pa.Array) -> Block:
    """The segments of a block of texts (no nulls); an empty text has none."""
    parts = pc.split_pattern(texts, " ")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    index = coded.indices.to_numpy().astype(np.int64)
    odd = np.fromiter(map(loose, distinct), bool, len(distinct))
    if odd.any():  # white space beside a space: cut these rows by the full rule
        counts = np.diff(offsets)
        row = np.repeat(np.arange(len(counts)), counts)
        number = {s: k for k, s in enumerate(distinct)}
        rows = np.split(index, offsets[1:-1])
        for r in np.unique(row[odd[index]]).tolist():
            text = texts[r].as_py()
            own = _CUT.split(text) if text else []
            rows[r] = np.array([number.setdefault(s, len(number)) for s in own], np.int64)
        index = np.concatenate(rows)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        used = np.unique(index)
        names = list(number)
        distinct, index = [names[k] for k in used.tolist()], np.searchsorted(used, index)
    return Block(distinct, index, offsets)


def sha256_rows(joined: pa.Array) -> list[str]:
    """Lowercase hex digest of each value of a large string or binary array."""
    joined = joined.cast(pa.large_binary())
    _, offsets, data = joined.buffers()
    at = np.frombuffer(offsets, np.int64, len(joined) + 1, joined.offset * 8).tolist()
    view = memoryview(data) if data else b""
    return [hashlib.sha256(view[i:j]).hexdigest() for i, j in zip(at, at[1:])]
