"""Alignment of two tokenizers' tokens on the same texts.

The byte-level tokenizer (A) reports character offsets, the piece tokenizer
(B) byte spans of surfaces. Both are coarse: tokens inside one character share
its offsets, byte-fallback pieces have empty surfaces. Where a token's span
ends before the next one's begins there is a coarse cut; tokens between two
cuts are told apart by the bytes they decode to.

Byte positions where both sides end a token cut a text into groups; every
stretch between two neighbouring ends of either side is one link, as exactly
one token of each side covers it. How often a pair of ids is linked in the
whole corpus is counted by Spark. What tasks know of their documents is
staged in blocks meanwhile (the documents' segments and the links of each
distinct one), so that the sums over the counts need no second alignment. Segments (see ``pieces``) are aligned
once for each worker's bounded store, many in one call of the tokenizers.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import Block, cut, plain_texts, row_blocks, sha256_rows
from tessera.llm.common import column_of, staged
from tessera.llm.token_count import byte_alphabet

#: Segments aligned in one text; segments, and bytes of their
#: groups, kept in each worker.
GROUP, KEEP_SEGMENTS, KEEP_BYTES = 256, 200_000, 32_000_000
#: Characters of new segments aligned at once.
ADD_CHARS = 200_000
#: Rows of the pair counts that workers get as a table (16 bytes and a flag
#: each); pairs below its least count come to the documents by a join.
TABLE_PAIRS = 1 << 20
#: Pairs that a task adds up before it passes them on.
TASK_PAIRS = 1 << 19
_A_BITS = 20  # a pair is B's id << 20 | A's id


def cut_ends(is_cut: np.ndarray, span_end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the span's at coarse cuts, between them the last
    cut plus the decoded sizes since."""
    total = np.cumsum(size)
    at = np.maximum.accumulate(np.where(is_cut, np.arange(len(size)), -1))
    ends = np.where(at >= 0, span_end[at] + total - total[at], total)
    return ends.astype(np.int64)


def _starts(sizes) -> np.ndarray:
    """0 and the running totals."""
    return np.concatenate([[0], np.cumsum(np.fromiter(sizes, np.int64))]).astype(np.int64)


def ragged(offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the items of the given rows, and each row's item count."""
    n = offsets[rows + 1] - offsets[rows]
    first = np.repeat(offsets[rows] - np.cumsum(n) + n, n)
    return first + np.arange(len(first)), n


def added_up(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, with the sums of their counts."""
    order = np.argsort(pairs, kind="stable")
    pairs, n = pairs[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first], np.add.reduceat(n, first) if len(first) else n


class Aligner:
    """Alignments of segments, kept by segment."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        of_char = {c: k for k, c in enumerate(byte_alphabet())}
        self.a_bytes = {i: bytes(map(of_char.__getitem__, t)) for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in of_char for c in t)}
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]
        if any(b" " in data.lstrip(b" ") for data in self.b_bytes):
            raise ValueError("pieces with inner spaces: texts cannot be cut at single spaces")
        if max(self.a_bytes) >= 1 << _A_BITS:
            raise ValueError("too many ids")
        n = max(max(self.a_bytes) + 1, len(self.b_bytes))
        self.a_table = pa.array([self.a_bytes.get(k, b"") for k in range(n)], pa.binary())
        self.b_table = pa.array(self.b_bytes, pa.binary())
        self.a_size, self.b_size = (pc.binary_length(t).to_numpy().astype(np.int64) for t in (self.a_table, self.b_table))
        self.marks = pa.array([f"{k}{s}" for k in range(n) for s in (",", "|", ";", "")])
        self.forget()

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size = np.zeros((4, 0), np.int64)  # A tokens, B tokens, groups, links
        self.bad = np.zeros(0, bool)
        self.groups = pa.array([], pa.string())
        self.pairs, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def rows(self, segments: list[str]) -> np.ndarray:
        """Rows of the store for these segments."""
        if len(self.known) > KEEP_SEGMENTS or self.groups.nbytes > KEEP_BYTES:
            self.forget()
        new = [s for s in segments if s not in self.known]
        if new:
            plain = [s for s in new if " " not in s]
            texts = [plain[k : k + GROUP] for k in range(0, len(plain), GROUP)] + [[s] for s in new if " " in s]
            for part in self._shares(texts):
                self._add(part)
        return np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))

    def _shares(self, texts: list[list[str]]) -> Iterator[list[list[str]]]:
        """The texts, about ADD_CHARS characters of them at a time: what the
        tokenizers say about a text takes far more memory than the text."""
        part, chars = [], 0
        for group in texts:
            part.append(group)
            chars += sum(map(len, group))
            if chars > ADD_CHARS:
                yield part
                part, chars = [], 0
        if part:
            yield part

    def _add(self, texts: list[list[str]]) -> None:
        """Align texts of segments; a text whose tokens do not spell it is
        taken apart, a single such segment is bad."""
        joined = [" ".join(group) for group in texts]
        coded = self.a.encode_batch([" " + t for t in joined], add_special_tokens=False)
        # the result's spans; this sentencepiece calls its span proto "proto"
        pieces = [self.b.encode(t, return_type="proto").pieces for t in joined]
        data = [b" " + t.encode() for t in joined]
        chars, size = _starts([len(t) + 1 for t in joined]), _starts(map(len, data))
        a_n, b_n = _starts(map(len, coded)), _starts(map(len, pieces))
        a_id = np.fromiter(chain.from_iterable(c.ids for c in coded), np.int64, a_n[-1])
        a_span = np.fromiter(chain.from_iterable(chain.from_iterable(c.offsets for c in coded)), np.int64, 2 * a_n[-1]).reshape(-1, 2)
        b_row = np.fromiter((v for own in pieces for p in own for v in (p.id, p.begin, p.end)), np.int64, 3 * b_n[-1]).reshape(-1, 3)
        spelt = self._spelt(self.a_table, a_id, a_n, data, size) & self._spelt(self.b_table, b_row[:, 0], b_n, data, size)
        if not spelt.all():
            wrong = [group for group, good in zip(texts, spelt.tolist()) if not good]
            bad = [group[0] for group in wrong if len(group) == 1]
            self._keep(bad, np.zeros((4, len(bad)), np.int64), True, pa.array([""] * len(bad), pa.string()), np.zeros(0, np.int64))
            again = [[s] for group in wrong if len(group) > 1 for s in group]
            again += [group for group, good in zip(texts, spelt.tolist()) if good]
            for part in self._shares(again) if bad or len(again) > len(texts) else ():
                self._add(part)
            return
        a_span += np.repeat(chars[:-1], np.diff(a_n))[:, None]
        b_span = b_row[:, 1:] + 1 + np.repeat(size[:-1], np.diff(b_n))[:, None]
        self._align([s for group in texts for s in group], " " + " ".join(joined), a_id, a_span, b_row[:, 0], b_span)

    @staticmethod
    def _spelt(table: pa.Array, ids: np.ndarray, at: np.ndarray, data: list[bytes], size: np.ndarray) -> np.ndarray:
        """Which texts the bytes of their tokens are."""
        taken = table.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], np.int32, len(ids) + 1)[at]
        spelt = memoryview(taken.buffers()[2] or b"").cast("B")[: ends[-1]]
        if np.array_equal(ends, size) and spelt == b"".join(data):
            return np.ones(len(data), bool)
        return np.fromiter((spelt[i:j] == d for i, j, d in zip(ends[:-1].tolist(), ends[1:].tolist(), data)), bool, len(data))

    def _align(self, segments: list[str], flat: str, a_id: np.ndarray, a_span: np.ndarray, b_id: np.ndarray, b_span: np.ndarray) -> None:
        """Align segments that stand one after the other in ``flat``, each with
        a space before it; spans of A in its characters, of B in its bytes."""
        to_byte = np.arange(len(flat) + 1)
        if not flat.isascii():
            code = np.frombuffer(flat.encode("utf-32-le"), "<u4")
            to_byte = np.concatenate([[0], np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))])
        a_cut = np.append(a_span[1:, 0] >= a_span[:-1, 1], True)
        a_end = cut_ends(a_cut, to_byte[a_span[:, 1]], self.a_size[a_id])
        b_cut = np.append(b_span[1:, 0] >= b_span[:-1, 1], True) & (b_span[:, 1] > b_span[:, 0])
        b_end = cut_ends(b_cut, b_span[:, 1], self.b_size[b_id])
        ends = np.union1d(a_end, b_end)
        at_a, at_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        both = ends[(a_end[at_a] == ends) & (b_end[at_b] == ends)]
        stop = np.cumsum([len(s.encode()) + 1 for s in segments]) if not flat.isascii() else np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)) + 1)
        if not np.isin(stop, both).all():
            raise ValueError("a token crosses a single space")
        size = np.stack([np.diff(np.searchsorted(x, stop, "right"), prepend=0) for x in (a_end, b_end, both, ends)])
        # groups as text: tokens by group, A before B, each with what follows it
        group = np.concatenate([np.searchsorted(both, a_end), np.searchsorted(both, b_end)])
        side = np.repeat([0, 1], [len(a_id), len(b_id)])
        order = np.argsort(group * 2 + side, kind="stable")
        group, side, ids = group[order], side[order], np.concatenate([a_id, b_id])[order]
        segment = np.searchsorted(stop, both)[group]
        after = np.where(np.diff(segment) > 0, 3, np.where(np.diff(group) > 0, 2, np.diff(side)))
        marks = self.marks.take(pa.array(ids * 4 + np.append(after, 3)))
        lists = pa.ListArray.from_arrays(pa.array(_starts(size[0] + size[1]), pa.int32()), marks)
        self._keep(segments, size, False, pc.binary_join(lists, ""), b_id[at_b] << _A_BITS | a_id[at_a])

    def _keep(self, segments: list[str], size: np.ndarray, bad: bool, groups: pa.Array, pairs: np.ndarray) -> None:
        self.known.update(zip(segments, range(len(self.bad), len(self.bad) + len(segments))))
        self.size = np.concatenate([self.size, size], axis=1)
        self.bad = np.concatenate([self.bad, np.full(len(segments), bad)])
        self.groups = pa.concat_arrays([self.groups, groups])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(size[3])])
        self.pairs = np.concatenate([self.pairs, pairs])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}  # one per worker process and pair of files


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _spelt(block: Block, bad: np.ndarray) -> np.ndarray:
    """Rows with tokens: some text, and no segment that its tokens miss."""
    return (np.diff(block.offsets) > 0) & (block.sums(bad.astype(np.int64)) == 0)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _packed(**columns: pa.Array) -> bytes:
    """Arrays of any lengths as one compressed Arrow row."""
    row = pa.RecordBatch.from_arrays([pa.LargeListArray.from_arrays(pa.array([0, len(c)], pa.int64()), c) for c in columns.values()], list(columns))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(row)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> dict[str, pa.Array]:
    row = pa.ipc.open_stream(data).read_next_batch()
    return {n: c.values for n, c in zip(row.schema.names, row.columns)}


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Rows (pair, n): links of a pair that a task has counted; and rows
    (block): documents of a block with what does not depend on the counts,
    their segments, and the links of these, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows_of(pairs: np.ndarray, n: np.ndarray, blocks: list[bytes]) -> pa.RecordBatch:
            none, few = pa.nulls(len(blocks), pa.int64()), pa.nulls(len(pairs), pa.binary())
            columns = [pa.concat_arrays([none, pa.array(x, pa.int64())]) for x in (pairs, n)]
            return pa.RecordBatch.from_arrays([*columns, pa.concat_arrays([pa.array(blocks, pa.binary()), few])], ["pair", "n", "block"])

        for b in batches:
            texts = plain_texts(column_of(b, "text"))
            for i, j in row_blocks(texts):
                block = cut(texts[i:j])
                rows = al.rows(block.segments)
                spelt = _spelt(block, al.bad[rows])
                counted = np.repeat(spelt, np.diff(block.offsets))
                at, links = ragged(al.at, rows)
                own, link = np.unique(al.pairs[at], return_inverse=True)
                times = np.repeat(np.bincount(block.index[counted], minlength=len(rows)), links)
                of_own = np.bincount(link, times, len(own)).astype(np.int64)  # sums of one block are exact in doubles
                pairs, n = added_up(np.concatenate([pairs, own[of_own > 0]]), np.concatenate([n, of_own[of_own > 0]]))
                text = pc.if_else(pa.array(spelt), block.joined(al.groups.take(pa.array(rows)), ";"), pa.scalar("", pa.large_string()))
                if digest:
                    text = pa.array([h if s else "" for h, s in zip(sha256_rows(text), spelt.tolist())], pa.large_string())
                sums = {c: pa.array(block.sums(x) * spelt, pa.int64()) for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), al.size[:, rows])}
                packed = _packed(doc_id=column_of(b, "doc_id")[i:j], **sums, text=text, spelt=pa.array(spelt), offsets=pa.array(block.offsets, pa.int32()),
                                 index=pa.array(block.index, pa.int32()), links=pa.array(links, pa.int32()), link=pa.array(link, pa.int32()), pairs=pa.array(own))
                full = len(pairs) > TASK_PAIRS
                yield rows_of(pairs if full else pairs[:0], n if full else n[:0], [packed])
                if full:
                    pairs, n = pairs[:0], n[:0]
        yield rows_of(pairs, n, [])

    return _source(docs, id_col, text_col).mapInArrow(run, "pair long, n long, block binary")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n): how many links of all texts hold the ids ``pair & 0xFFFFF``
    of A and ``pair >> 20`` of B."""
    return blocks.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))


def with_best(pairs: DataFrame) -> DataFrame:
    """Adds ``best``: no pair of the same B id has a greater count. The joined
    side has a row for each B id, so no more than B's vocabulary."""
    top = pairs.groupBy(F.shiftright("pair", _A_BITS).alias("b")).agg(F.max("n").alias("top"))
    return pairs.withColumn("b", F.shiftright("pair", _A_BITS)).join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def least_count(pairs: DataFrame, most: int) -> int:
    """A power of two that at most ``most`` pairs' counts reach; 0 if all may."""
    by_size = pairs.groupBy((F.length(F.bin("n")) - 1).alias("size")).agg(F.count("*").alias("rows")).collect()
    total, least = 0, 62
    for size, rows in sorted(by_size, reverse=True):
        if (total := total + rows) > most:
            return 1 << least
        least = size
    return 0


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups for every row.

    ``a_path`` is a byte-level BPE ``.json`` file read on a space and the text,
    ``b_path`` a ``.model`` file that adds the space itself. ``groups`` lists
    the ids of A and B of each group, ``a1,a2|b1;a3|b2,b3``; with ``digest``
    it is ``groups_sha256``, the text's lowercase hex SHA-256.

    Null and empty texts and texts that A's or B's tokens do not spell have no
    tokens: zeros and ''. Repeated rows and null ids are kept as they are and
    count as often as they come; an empty table gives no rows; other columns
    are ignored, whatever their names. Very long texts are handled whole."""
    spark = docs.sparkSession
    blocks = staged(aligned_blocks(docs, a_path, b_path, id_col, text_col, digest), "alignment-blocks")
    pairs = with_best(staged(pair_counts(blocks), "alignment-pairs"))
    least = least_count(pairs, table_pairs)
    known = pairs.filter(F.col("n") >= least).sort("pair").toArrow()
    table = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "n", "best")))
    last = "groups_sha256" if digest else "groups"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = table.value
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", last, "rest"]
        for b in batches:
            for packed in column_of(b, "block"):
                c = _unpacked(packed.as_py())
                own, links, link, spelt = (c[k].to_numpy(zero_copy_only=False) for k in ("pairs", "links", "link", "spelt"))
                block = Block([], c["index"].to_numpy().astype(np.int64), c["offsets"].to_numpy().astype(np.int64))
                k = np.minimum(np.searchsorted(codes, own), max(len(codes) - 1, 0))
                found = codes[k] == own if len(codes) else np.zeros(len(own), bool)
                n, top = (np.where(found, x[k], 0).astype(np.int64) if len(codes) else np.zeros(len(own), np.int64) for x in (counts, best))
                ends = _starts(links)
                by_segment = lambda x: np.diff(_starts(x[link])[ends])
                sums = [pa.array(block.sums(by_segment(x)) * spelt, pa.int64()) for x in (top, n)]
                # pairs that are not in the table, once for each link; the last row of the offsets has none
                rest = np.flatnonzero(~found[link])
                held = np.concatenate([[0], np.searchsorted(rest, ends[1:]), [len(rest)]])
                items, n_items = ragged(held, np.where(np.repeat(spelt, np.diff(block.offsets)), block.index, len(links)))
                at_row = np.concatenate([[0], np.cumsum(n_items)])[block.offsets]
                lists = pa.ListArray.from_arrays(pa.array(at_row, pa.int32()), pa.array(own[link[rest][items]]))
                columns = [c[x] for x in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([*columns, *sums, c["text"].cast(pa.string()), lists], names)

    kinds = ["doc_id long", "n_a long", "n_b long", "n_groups long", "n_links long", "n_best long", "count_sum long", f"{last} string"]
    out = blocks.filter("block IS NOT NULL").select("block").mapInArrow(run, ", ".join([*kinds, "rest array<long>"]))
    names = [k.split()[0] for k in kinds]
    if not least:  # the table has all pairs
        return out.select(*names)
    out = staged(out.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    rare = out.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
    added = rare.join(pairs.filter(F.col("n") < least), "pair").groupBy("row")
    added = added.agg(F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    sums = {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0))}
    return out.join(added, "row", "left").withColumns(sums).select(*names)
