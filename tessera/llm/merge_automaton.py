"""Byte-level BPE by a tokenization automaton compiled from the merge list.

The automaton reads tokens. It begins as one state that every byte leads back
to, and takes the merges in order, one gadget each: for a merge u v -> uv,
the state q that all arcs u enter gets a copy without the arc v, the arcs u
enter the copy instead, and wherever u leaves, uv leaves too, to where v led
from q. A token sequence is then accepted exactly if the merges produce it, so
each byte string has one accepted path, and so has each of its prefixes.

A state differs from the one it was copied from by one lost arc, and from
what it was at its birth by the arcs of later merges, which follow their left
parts. That is how states are stored (origin, lost arc, birth); the rows of
the transition table are filled in from it as texts ask for them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import accumulate, chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import Block, cut, plain_texts, row_blocks, sha256_rows
from tessera.llm.common import column_of
from tessera.llm.pieces import PATTERN, Kept
from tessera.llm.token_count import byte_alphabet

_SHIFT, _ARCS = 20, 2_000_000


class MergeAutomaton:
    """Deterministic automaton whose arcs are the tokens of a merge list.

    ``merges`` are (left, right, merged) token ids in rank order, ``of_byte``
    the token of every byte. Each token must come from one merge only."""

    def __init__(self, of_byte: list[int], merges: list[tuple[int, int, int]]):
        self.bytes: dict[int, bytes] = {t: bytes([b]) for b, t in enumerate(of_byte)}
        self.left: dict[int, int] = {}
        self.made: dict[int, int] = dict.fromkeys(of_byte, -1)
        self.goes: dict[int, int] = dict.fromkeys(of_byte, 0)  # the state that all arcs of a token enter
        self.origin, self.lost, self.born = [-1], [-1], [0]
        for step, (u, v, uv) in enumerate(merges, 1):
            if uv in self.made:
                raise ValueError(f"token {uv} comes from two merges")
            self._gadget(step, u, v, uv)
        self.table = _Table(self)
        self.token = {data: t for t, data in self.bytes.items() if t in self.goes}
        self.ends = ahocorasick.Automaton()
        for data, t in self.token.items():
            self.ends.add_word(data.decode("latin-1"), (t, len(data)))
        self.ends.make_automaton()

    def _gadget(self, step: int, u: int, v: int, uv: int) -> None:
        self.bytes[uv] = self.bytes[u] + self.bytes[v]
        self.made[uv], self.left[uv] = step, u
        if u not in self.goes or v not in self.goes or not self.has(self.goes[u], v):
            return  # no path u v is left: the merge never applies
        q = self.goes[u]
        self.goes[uv] = self.goes[v]  # for u = v this is q itself, before its arcs move
        self.goes[u] = len(self.origin)
        self.origin.append(q)
        self.lost.append(v)
        self.born.append(step)

    def has(self, state: int, token: int) -> bool:
        """Whether an arc of the token leaves the state."""
        origin, lost, born, made, left = self.origin, self.lost, self.born, self.made, self.left
        while state:
            if made[token] >= born[state]:
                token = left[token]  # added later, beside the arcs of its left part
            elif lost[state] == token:
                return False
            else:
                state = origin[state]
        return True  # the first state has every token

    def step(self, state: int, token: int) -> int:
        """The state that the token leads to, -1 if it has no arc there."""
        return self.table[state << _SHIFT | token]

    def encode(self, data: bytes) -> list[int]:
        """The token labels of the path that spells ``data``."""
        if (whole := self.token.get(data)) is not None:
            return [whole]
        states, labels, table = [0], [-1], self.table  # of the prefixes so far
        for last, (token, size) in self.ends.iter(data.decode("latin-1")):
            if last + 1 == len(labels) and (to := table[states[-size] << _SHIFT | token]) >= 0:
                states.append(to)
                labels.append(token)
        if len(labels) <= len(data):
            raise ValueError("the vocabulary lacks a byte")
        out, end = [], len(data)
        while end:
            out.append(labels[end])
            end -= len(self.bytes[out[-1]])
        return out[::-1]

    def accepts(self, tokens: list[int]) -> bool:
        """Whether the merges produce this sequence."""
        return -1 not in accumulate(tokens, lambda s, t: s if s < 0 else self.step(s, t), initial=0)


class _Table(dict):
    """Rows of the transition table by state and token; -1 where there is no
    arc. Rows are forgotten together when there are too many."""

    def __init__(self, automaton: MergeAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, key: int) -> int:
        state, token = key >> _SHIFT, key & ((1 << _SHIFT) - 1)
        if len(self) >= _ARCS:
            self.clear()
        to = self.automaton.goes.get(token, -1)  # tokens of merges that never apply go nowhere
        if to >= 0 and not self.automaton.has(state, token):
            to = -1
        self[key] = to
        return to


class Codec:
    """Encoding and decoding as a byte-level BPE ``.json`` file defines them.

    Strings of added tokens inside a text are those tokens, as the library
    has it by default."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE file without prefix space or normalizer is needed")
        vocab = model["vocab"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.automaton = MergeAutomaton([vocab[c] for c in byte_alphabet()], [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {c: (i,) for c, i in added.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.label = self.automaton.bytes | {i: c.encode() for c, i in added.items()}
        self.pieces = Kept(lambda p: tuple(self.automaton.encode(p.encode())))
        self.kept = Kept(self._values)

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        for a in self.added:
            if a in text:
                parts = self.split.split(text)
                return [*chain.from_iterable(self.added.get(p) or self._plain(p) for p in parts)]
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        return [*chain.from_iterable(map(self.pieces.__getitem__, PATTERN.findall(text)))]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the arc labels."""
        return b"".join(map(self.label.__getitem__, ids))

    def _values(self, key: str) -> tuple[int, str, bytes]:
        ids = self.encode(key)
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def block(self, block: Block) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """By row: number of ids, ids in decimal with commas, decoded bytes."""
        keys, rows = block.with_heads()
        values = list(map(self.kept.__getitem__, keys))
        n = np.fromiter((v[0] for v in values), np.int64, len(values))
        ids, data = pa.array([v[1] for v in values], pa.string()), pa.array([v[2] for v in values], pa.binary())
        return rows.sums(n), rows.joined(ids, ","), rows.joined(data, "")


_CODECS: dict[str, Codec] = {}  # one per worker process and file


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every row.

    Null and empty texts have no ids; repeated rows and null ids are kept as
    they are; an empty table gives no rows; other columns are ignored,
    whatever their names. Very long texts are handled whole, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, c = plain_texts(column_of(b, "text")), codec(path)
            for i, j in row_blocks(texts):
                ids = [c.encode(t) for t in texts[i:j].to_pylist()]
                columns = [column_of(b, "doc_id")[i:j], pa.array(ids, pa.list_(pa.int32())), pa.array(map(c.decode, ids), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def decode_ids(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from arrays of ids: the emitted labels as UTF-8, bytes
    that are none as U+FFFD. Null arrays decode to the empty text; an id
    outside the vocabulary fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = codec(path)
            texts = [c.decode(ids or []).decode("utf-8", "replace") for ids in column_of(b, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    src = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return src.mapInArrow(run, "doc_id long, text string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, sha256 of the ids (decimal, comma-joined) and of the
    text decoded from them, for every row; rows as in ``encode_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, c = plain_texts(column_of(b, "text")), codec(path)
            for i, j in row_blocks(texts):
                n, ids, data = c.block(cut(texts[i:j]))
                columns = [column_of(b, "doc_id")[i:j], pa.array(n, pa.int64()), pa.array(sha256_rows(ids), pa.string()), pa.array(sha256_rows(data), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
