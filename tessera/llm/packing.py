"""Best-fit packing through the configuration linear program.

Documents become pieces of at most ``capacity`` tokens. The histogram of piece
lengths (at most ``capacity`` numbers, whatever the corpus) is all the driver
sees. Over it the linear program "fewest sequences, each a configuration of
lengths that fits, that cover every length" is solved by multiplicative
weights: a knapsack dynamic program finds the configurations of the greatest
price, they are bought in small amounts, and prices of covered lengths decay.
Amounts are rounded down to whole sequences; what remains is packed best-fit,
longest first, still by length class. Places are then dealt to the pieces by
their rank among equals.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import cut as cut_texts
from tessera.llm.blocks import plain_texts, row_blocks
from tessera.llm.common import column_of, staged
from tessera.llm.pieces import KEEP_CHARS, PATTERN
from tessera.llm.token_count import byte_alphabet

#: Segments whose ids are kept in each worker, new segments encoded in one text.
KEEP_ENTRIES, GROUP = 600_000, 256
#: Characters from which a text goes through tokenizers (tiktoken's matcher
#: fails on a million characters of white space).
LONG_CHARS = 500_000
#: Rows per rank bucket, so that no task ranks all pieces of a common length.
BUCKET_ROWS = 5_000
#: Rounds of the multiplicative weights, how fast weights fall with cover,
#: share of a class bought at once, share of the best price that still counts,
#: configurations bought a round.
ROUNDS, RATE, STEP, NEAR, MANY = 250, 10.0, 0.03, 0.99, 32


class SegmentIds:
    """Little-endian 32-bit ids of whole texts from ids of their segments.

    New segments go through tiktoken with the file's tokens as ranks, which
    gives the ids of tokenizers in less time; those that hold an added token
    and very long ones go through tokenizers itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        of_char = {c: k for k, c in enumerate(byte_alphabet())}
        ranks = {bytes(map(of_char.__getitem__, t)): k for t, k in vocab.items() if t not in self.added}
        self.plain = Encoding("file", pat_str=PATTERN.pattern, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(vocab.values()) + 1, dtype=bool)  # tokens that begin with a space
        self.spaced[[k for t, k in vocab.items() if t.startswith("\u0120")]] = True
        self.kept: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for data in self.rows(pa.array(texts, pa.string())):
            yield from (x.as_py() for x in data)

    def rows(self, texts: pa.Array) -> Iterator[pa.Array]:
        """The ids of each text (no nulls) as bytes, block by block."""
        for i, j in row_blocks(texts):
            keys, block = cut_texts(texts[i:j]).with_heads()
            get = self.kept.get
            values = list(map(get, keys))
            if None in values:
                if len(self.kept) > KEEP_ENTRIES:
                    self.kept.clear()
                new = dict(zip(fresh := list({k for k, v in zip(keys, values) if v is None}), self._new(fresh)))
                values = [new[k] if v is None else v for k, v in zip(keys, values)]
                self.kept.update((k, v) for k, v in new.items() if len(k) <= KEEP_CHARS)
            yield block.joined(pa.array(values, pa.binary()), "")

    def _ids(self, text: str) -> np.ndarray:
        if len(text) >= LONG_CHARS or any(mark in text for mark in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.plain.encode_ordinary(text), dtype="<u4")

    def _new(self, keys: list[str]) -> list[bytes]:
        """Ids of texts. Those that are one space and a segment without more
        are encoded many in one text and told apart by the tokens that begin
        with a space."""
        out: dict[str, bytes] = {}
        alone = [k for k in keys if k.rfind(" ") != 0]
        many = [k for k in keys if k.rfind(" ") == 0]
        for at in range(0, len(many), GROUP):
            group = many[at : at + GROUP]
            ids = self._ids("".join(group))
            cuts = (np.flatnonzero(self.spaced[ids]) * 4).tolist()
            if len(cuts) != len(group):
                alone += group
                continue
            data = ids.tobytes()
            out.update((k, data[i:j]) for k, i, j in zip(group, cuts, [*cuts[1:], len(data)]))
        out.update((k, self._ids(k).tobytes()) for k in alone)
        return [out[k] for k in keys]


_ENCODERS: dict[str, SegmentIds] = {}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids + end."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(vocabulary, SegmentIds(vocabulary)) if vocabulary not in _ENCODERS else _ENCODERS[vocabulary]
        for b in batches:
            ids, out = iter(column_of(b, "doc_id").to_pylist()), []
            for coded in encoder.rows(plain_texts(column_of(b, "text"))):
                at = np.frombuffer(coded.buffers()[1], np.int64, len(coded) + 1).tolist()
                data = memoryview(coded.buffers()[2] or b"").cast("B")
                for i, j, doc in zip(at, at[1:], ids):  # ids last: the end of a block takes none
                    parts = cut((j - i) // 4 + 1, capacity)  # the last one ends with the end id
                    crcs = [zlib.crc32(data[i + 4 * s : min(i + 4 * (s + n), j)]) for s, n in parts]
                    crcs[-1] = zlib.crc32(end, crcs[-1])
                    out += [(doc, k, s, n, crc) for k, ((s, n), crc) in enumerate(zip(parts, crcs))]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of every size up to ``capacity`` and the item last added."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(int(lengths[0]), capacity + 1):  # lengths ascend
        n = np.searchsorted(lengths, c, "right")
        value = best[c - lengths[:n]] + price[:n]
        k = int(value.argmax())
        best[c], took[c] = value[k], k
        if best[c - 1] > best[c]:
            best[c], took[c] = best[c - 1], -1
    return best, took


def _trace(took: np.ndarray, lengths: np.ndarray, size: int) -> Counter:
    out: Counter = Counter()
    while size > 0:
        if took[size] < 0:
            size -= 1
        else:
            out[int(took[size])] += 1
            size -= int(lengths[took[size]])
    return out


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> dict[tuple, float]:
    """Amounts of configurations ((class, copies), ...) from multiplicative weights.

    Prices start at the share of a sequence that a piece fills, the optimal
    dual of an instance without waste. The amounts are scaled to cover each
    token once on average."""
    size = lengths * counts
    weight, covered = size / capacity, np.zeros(len(lengths))
    bought: dict[tuple, float] = {}
    for _ in range(ROUNDS):
        price = weight / counts
        best, took = knapsack(lengths, price, capacity)
        with_item = price + best[capacity - lengths]  # the best configuration that holds each class
        near = [k for k in np.argsort(-with_item, kind="stable")[:MANY] if with_item[k] >= NEAR * best[capacity]]
        for config in {tuple(sorted((Counter({int(k): 1}) + _trace(took, lengths, int(capacity - lengths[k]))).items())) for k in near}:
            k, a = np.array(config).T
            amount = STEP * (counts[k] / a).min()
            bought[config] = bought.get(config, 0.0) + amount
            gain = amount * a / counts[k]
            covered[k] += gain
            weight[k] *= np.exp(-RATE * gain)
        weight /= weight.max()
    scale = min(1.0, size.sum() / (covered * size).sum())
    return {c: x * scale for c, x in bought.items()}


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(sequences, ((length, copies), ...)) that hold every piece exactly once."""
    out: list[tuple[int, tuple]] = []
    if any(not 0 < n <= capacity for n in histogram):
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    if full := histogram.get(capacity):
        out.append((full, ((capacity, 1),)))
    lengths = np.array(sorted(n for n in histogram if n < capacity), dtype=np.int64)
    if not len(lengths):
        return out
    counts = np.array([histogram[int(n)] for n in lengths], dtype=np.int64)
    left = counts.copy()
    bought = fractional(lengths, counts, capacity)
    # whole sequences of the fractional solution, fullest configurations first
    filled = lambda c: sum(int(lengths[k]) * a for k, a in c)
    for config in sorted(bought, key=lambda c: (-filled(c), c)):
        k, a = np.array(config).T
        n = int(min(np.floor(bought[config] + 1e-9), (left[k] // a).min()))
        if n > 0:
            left[k] -= n * a
            out.append((n, tuple((int(lengths[i]), m) for i, m in config)))
    # the rest: best fit by class, longest first; equal bins are held together
    open_bins: dict[int, list[list]] = {}
    for k in range(len(lengths) - 1, -1, -1):
        size, n = int(lengths[k]), int(left[k])
        for room in sorted(r for r in open_bins if r >= size):
            each, groups = room // size, open_bins[room]
            while n and groups:
                bins, held = groups.pop()
                use = min(bins, n // each)
                if use < bins and n < each * bins:
                    groups.append([bins - use, held])
                    if not use:  # one bin takes the last few
                        groups[-1][0] -= 1
                        if not groups[-1][0]:
                            groups.pop()
                        open_bins.setdefault(room - n * size, []).append([1, [*held, (size, n)]])
                        n = 0
                        break
                open_bins.setdefault(room - each * size, []).append([use, [*held, (size, each)]])
                n -= use * each
            if not n:
                break
        if n:
            each = capacity // size
            if n // each:
                open_bins.setdefault(capacity - each * size, []).append([n // each, [(size, each)]])
            if n % each:
                open_bins.setdefault(capacity - n % each * size, []).append([1, [(size, n % each)]])
    out += [(bins, tuple(held)) for groups in open_bins.values() for bins, held in groups]
    return out


def _places(chosen: list[tuple[int, tuple]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence and offset of every run of places."""
    runs: dict[int, list] = {}
    taken: Counter = Counter()
    first = 0
    for sequences, held in chosen:
        offset = 0
        for length, copies in held:
            for _ in range(copies):
                runs.setdefault(length, []).append((taken[length], first, offset))
                taken[length] += sequences
                offset += length
        first += sequences
    return {n: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for n, r in runs.items()}


def ranked(rows: DataFrame, key: str, order: list[str], n_rows: int) -> DataFrame:
    """Adds ``rank`` (from 0) among rows of equal ``key``; a common key is
    dealt over hash buckets whose sizes are then added up."""
    buckets = n_rows // BUCKET_ROWS + 1
    parts = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = parts.groupBy(key, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy(key, "bucket").orderBy(*order)) - 1
    return parts.withColumn("own", own).join(starts, [key, "bucket"]).withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "bucket")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.

    A null or empty text is its end id alone; repeated rows are packed as
    often as they come; null ids are kept; an empty table gives no rows;
    other columns are ignored. The driver gets the length histogram (at most
    ``capacity`` rows) and broadcasts the plan made from it."""
    rows = staged(pieces(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = rows.sparkSession.sparkContext.broadcast(_places(plan(histogram, capacity)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (column_of(b, c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, base, off = places.value[int(length[at[0]])]
                k = np.searchsorted(first, rank[at], "right") - 1
                sequence[at], offset[at] = base[k] + rank[at] - first[k], off[k]
            kept = [column_of(b, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    order = ["doc_id", "piece", "start", "ids_crc32"]
    return ranked(rows, "length", order, sum(histogram.values())).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
