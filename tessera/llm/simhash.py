"""SimHash near-duplicates through a Gray-order hierarchical index.

Every distinct fingerprint enters the upper nodes whose masked bit pattern it
carries. The upper two levels are cut so that no pair is lost: of d+1 blocks
of bits, two fingerprints at d or fewer differing bits share one whole block,
and of the bits outside it cut into d+1 again they share one more. A node of
the second level (36 of 64 bits at d = 2) is one shuffle key, so a large
group of near copies is dealt over many small nodes. Inside a node the
fingerprints are sorted by Gray rank, runs of neighbours factor their shared
bits into inner nodes that hold only what their parent does not, and a search
descends with the differences accumulated so far, dropping a whole subtree
once they exceed d. Nodes emit the spanning forest of their links, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_of, local_components, spare_prefix, staged, text_list
from tessera.llm.components import components

BITS = 64
#: Children of an inner node, and searches that descend together.
FANOUT, BLOCK = 8, 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text: words are runs of non-white-space, A-Z lowered."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(s), seed) for s in zip(*(words[k:] for k in range(shingle)))]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):  # a bounded bit matrix for very long texts
        part = np.array(hashes[at : at + BLOCK], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): one row per input row; null text counts as empty (fp 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in text_list(b)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    edges = [len(bits) * k // parts for k in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:])]


def node_masks(distance: int) -> list[int]:
    """Masks of the second-level nodes; a pair within ``distance`` agrees on one."""
    every = list(range(BITS))
    out = []
    for block in _cut(every, distance + 1):
        rest = [b for b in every if b not in set(block)]
        out += [sum(1 << b for b in block + sub) for sub in _cut(rest, distance + 1)]
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a bit pattern in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """The part of the hierarchy below the upper nodes, for many groups at once.

    ``fp`` is sorted by group, then by Gray rank; level 0 holds fingerprints,
    each higher level runs of FANOUT children of one group up to one root each."""

    def __init__(self, fp: np.ndarray, group: np.ndarray):
        self.levels: list[dict] = []
        low, high, owner = fp, fp, group
        while True:
            level = {"pattern": low, "mask": ~(low ^ high), "group": owner}
            self.levels.append(level)
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[start, len(owner)])
            if (size == 1).all():
                break
            rank = np.arange(len(owner)) - np.repeat(start, size)
            cut = np.flatnonzero(rank % FANOUT == 0)
            parent = np.cumsum(rank % FANOUT == 0) - 1
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            level["own"] = level["mask"] & (low ^ high)[parent]  # bits that the parent does not hold
            level["first"] = cut  # where each parent's children start
            owner = owner[cut]
        self.levels[-1]["own"] = self.levels[-1]["mask"]

    def within(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (i < j) of level 0 that differ in ``distance`` bits or fewer."""
        fp, group = self.levels[0]["pattern"], self.levels[0]["group"]
        top = self.levels[-1]
        root = np.searchsorted(top["group"], group)
        for at in range(0, len(fp), BLOCK):
            q = np.arange(at, min(at + BLOCK, len(fp)))
            node, diff = root[q], np.zeros(len(q), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                level = self.levels[depth]
                diff = diff + np.bitwise_count((fp[q] ^ level["pattern"][node]) & level["own"][node])
                keep = diff <= distance
                q, node, diff = q[keep], node[keep], diff[keep]
                if depth:
                    first = self.levels[depth - 1]["first"]
                    ends = np.r_[first[1:], len(self.levels[depth - 1]["pattern"])]
                    n = ends[node] - first[node]
                    child = np.repeat(first[node], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    q, diff, node = np.repeat(q, n), np.repeat(diff, n), child
            one = q < node
            yield q[one], node[one]


def _forest(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links of complete (node, key) groups of a partition sorted by them."""

    def solve(node: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        new = np.r_[True, (node[1:] != node[:-1]) | (key[1:] != key[:-1])]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        group, fp = group[many], fp[many].view(np.uint64)
        if not len(fp):
            return None
        order = np.lexsort((gray_rank(fp), group))
        group, fp = group[order], fp[order]
        found = list(GrayIndex(fp, group).within(distance))
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        label = local_components(len(fp), i, j)
        moved = label != np.arange(len(fp))
        fp = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(fp[label[moved]]), pa.array(fp[moved])], ["a", "b"]) if moved.any() else None

    held: list[np.ndarray] | None = None
    for b in batches:
        cols = [column_of(b, c).to_numpy(zero_copy_only=False) for c in ("node", "key", "fp")]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        node, key, fp = cols
        if not len(fp):
            continue
        last = int(np.flatnonzero((node != node[-1]) | (key != key[-1])).max(initial=-1)) + 1  # the open group starts here
        if last and (out := solve(node[:last], key[:last], fp[:last])) is not None:
            yield out
        held = [node[last:], key[last:], fp[last:]]
    if held is not None and len(held[0]) and (out := solve(*held)) is not None:
        yield out


def fingerprint_links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that connect all of ``distinct.fp`` within ``distance`` bits."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    nodes = F.array(*[
        F.struct(F.lit(k).alias("node"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for k, m in enumerate(node_masks(distance))
    ])
    rows = distinct.select("fp", F.explode(nodes).alias("at")).select("at.node", "at.key", "fp")
    rows = rows.repartition("node", "key").sortWithinPartitions("node", "key")
    return rows.mapInArrow(lambda it: _forest(it, distance), "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links of ``distance`` or
    fewer differing bits.

    Null and empty texts (and texts of white space) have fingerprint zero and
    link like any other; rows with fewer words than a shingle hash the whole
    sequence. Repeated rows each keep their row; null ids are kept and never
    name a component that has another id; an empty table gives no rows; other
    columns of ``docs`` are ignored, whatever their names."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    reps = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-set")
    roots = components(staged(fingerprint_links(reps, distance), "fingerprint-links"))
    linked = reps.join(roots.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(smallest, "root").select("fp", "least")
    # staged, so that the last join has plain exchanges on both sides and a common fingerprint's rows can be split
    of_fp = staged(reps.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "component-ids")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return fps.join(of_fp, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs``, unchanged, one of each component: that of the
    smallest id (null ids last; of repeated rows any one).

    Null and empty texts are one component, with all whose fingerprint is
    near zero; very long texts are hashed whole; an empty table gives no
    rows; columns of any name are kept as they are."""
    p = spare_prefix(docs, "row")
    row = p + "row"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    parts = simhash_components(rows, row, text_col, shingle, distance).select(F.col("doc_id").alias(row), F.col("component_id").alias("part"))
    ids = rows.select(row, F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")).alias("own"))
    first = parts.join(ids, row).groupBy("part").agg(F.min("own").alias("own")).select(F.col("own.row").alias(row))
    return rows.join(first, row, "left_semi").select(*[F.col(c) for c in docs.columns])
