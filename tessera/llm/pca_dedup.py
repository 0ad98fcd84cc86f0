"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are rotated so that the dimensions which carry most of their
products come first. Two vectors whose cosine reaches the threshold differ by
at most w = sqrt(2 - 2t) in every coordinate, so cells of width w over the
leading ones need comparing with neighbouring cells only; cells are cut into
tiles of bounded size, and pairs of tiles whose boxes lie further apart than
w are skipped. Tiles are staged once and their pairs come from a Cartesian
product, whose tasks read two files' tiles each: no tile is exchanged for the
pairs it is in, which grow with the square of the vectors. A pair of tiles
multiplies the leading dimensions, with the suffix norms as one more, in
single precision; a pair of vectors goes on only while its product so far
plus the product of the two suffix norms can still reach the threshold, and
what remains is decided by the exact cosine in double precision. Equal vectors
are one vector with a multiplicity. Tiles report link counts and a spanning
forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_of, drop_shuffles, local_components, staged
from tessera.llm.components import components

#: Vectors per tile, leading coordinates that make the cells and the boxes,
#: dimensions accumulated before each bound, pairs finished at a time.
TILE, CELL_DIMS, BOX_DIMS, STEPS, BLOCK = 2048, 3, 8, (32, 128), 1 << 16
#: Slack of the bounds for rounding in the rotated coordinates, and in single precision.
SLACK, SLACK_SINGLE = 1e-9, 1e-5


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither over- nor underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def packed(rows: DataFrame, kind: str) -> DataFrame:
    """(vec_id, d, x) of (vec_id, v): the numbers as bytes, with -0 as 0, and
    their count; null for a null vector."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = column_of(b, "v")
            size = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros((), kind)
            ends = pa.array((np.r_[0, np.cumsum(size)] * flat.itemsize).astype(np.int32))
            x = pa.Array.from_buffers(pa.binary(), len(v), [None, ends.buffers()[1], pa.py_buffer(flat.tobytes())])
            none = v.is_null()
            yield pa.RecordBatch.from_arrays([column_of(b, "vec_id"), pc.if_else(none, None, pa.array(size, pa.int32())), pc.if_else(none, None, x)], ["vec_id", "d", "x"])

    return rows.select("vec_id", "v").mapInArrow(pack, "vec_id long, d int, x binary")


def _matrices(b: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) of a batch of packed vectors, by length."""
    size, x = column_of(b, "d").to_numpy(), column_of(b, "x")
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, _matrix(x.take(pa.array(rows)).to_pylist(), d, kind)


def _matrix(x: list[bytes], d: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x), kind).reshape(-1, d).astype(np.float64)


def rotations(vectors: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """By vector length the rotation to principal order, from all vectors.

    The driver gets at most 16 d x d moments for each length d."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _matrices(b, kind):
                u = unit(x)
                total[d] = total.get(d, 0) + u.T @ u
        yield _moment_batch(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, m in zip(column_of(b, "d").to_pylist(), column_of(b, "m").to_pylist()):
                total[d] = total.get(d, 0) + np.frombuffer(m).reshape(d, d)
        yield _moment_batch(total)

    def _moment_batch(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([m.tobytes() for m in total.values()], pa.binary())], ["d", "m"])

    parts = vectors.select("d", "x").mapInArrow(moments, "d int, m binary").repartition(16).mapInArrow(add, "d int, m binary").collect()
    sums: dict[int, np.ndarray] = {}
    for r in parts:
        sums[r.d] = sums.get(r.d, 0) + np.frombuffer(bytes(r.m)).reshape(r.d, r.d)
    return {d: np.linalg.eigh(m)[1][:, ::-1].copy() for d, m in sums.items()}


def _suffix(r: np.ndarray, s: int) -> np.ndarray:
    return np.sqrt((r[:, s:] ** 2).sum(axis=1))


def _turned(x: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The vectors, scaled to unit length, turned, and what the first bound
    multiplies: the leading dimensions and the norm of the others."""
    u = unit(x)
    r = u @ rotation
    s = min(STEPS[0], x.shape[1])
    return x, u, r, np.column_stack([r[:, :s], _suffix(r, s)]).astype(np.float32)


def compare(a: np.ndarray, b: np.ndarray, rotation: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i of a, j of b) whose cosine is at least ``threshold``; each
    pair once if ``same``."""
    return _near(_turned(a, rotation), _turned(b, rotation), threshold, same)


def _near(left: tuple, right: tuple, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    (a, ua, ra, fa), (b, ub, rb, fb) = left, right
    d = a.shape[1]
    stops = sorted({min(s, d) for s in (*STEPS, d)})
    need = threshold - SLACK
    hit = np.flatnonzero(fa @ fb.T >= np.float32(threshold - SLACK_SINGLE))
    i, j = hit // len(b), hit % len(b)
    if same:
        i, j = i[i < j], j[i < j]
    out_i, out_j = [i[:0]], [j[:0]]
    for at in range(0, len(i), BLOCK):
        p, q = i[at : at + BLOCK], j[at : at + BLOCK]
        sofar = np.einsum("ij,ij->i", ra[p, : stops[0]], rb[q, : stops[0]])
        for lo, hi in zip(stops, stops[1:-1]):  # the last step is the exact cosine
            sofar = sofar + np.einsum("ij,ij->i", ra[p, lo:hi], rb[q, lo:hi])
            keep = sofar + _suffix(ra, hi)[p] * _suffix(rb, hi)[q] >= need
            p, q, sofar = p[keep], q[keep], sofar[keep]
        exact = np.einsum("ij,ij->i", ua[p], ub[q])
        near = np.abs(exact - threshold) < SLACK  # decided by the cosine of the given numbers
        x, y = a[p[near]], b[q[near]]
        exact[near] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
        keep = exact >= threshold
        out_i.append(p[keep])
        out_j.append(q[keep])
    return np.concatenate(out_i), np.concatenate(out_j)


def tiles(reps: DataFrame, turns: dict[int, np.ndarray], threshold: float, kind: str) -> DataFrame:
    """One row per tile: tile, d, cell, box, ids, copies and vectors as bytes."""
    width = np.sqrt(max(0.0, 2 - 2 * threshold)) * (1 + 1e-9) + 1e-12
    turned = reps.sparkSession.sparkContext.broadcast(turns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, rows, x in _matrices(b, kind):
                r = unit(x) @ turned.value[d][:, :CELL_DIMS]
                lead = np.zeros((len(rows), CELL_DIMS), np.int32)
                lead[:, : r.shape[1]] = np.floor(r / width).astype(np.int32)
                part = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([column_of(part, c) for c in names] + [pa.array(lead[:, k]) for k in range(CELL_DIMS)], [*names, *cell])

    names, cell = ["rep", "n", "d", "x"], [f"c{k}" for k in range(CELL_DIMS)]
    cells = ", ".join(f"{c} int" for c in cell)
    # placed once for the cells' sizes and once for the tiles: shorter than staging the vectors again
    rows = reps.select(*names).mapInArrow(place, f"rep long, n long, d int, x binary, {cells}")
    cut = staged(rows.groupBy("d", *cell).agg(F.ceil(F.count("*") / TILE).alias("cuts")), "cells")
    dealt = rows.join(cut, ["d", *cell]).withColumn("cut", F.pmod(F.xxhash64("rep"), F.col("cuts"))).drop("cuts")

    def gather(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))  # one tile
        d, *rest = (k.as_py() for k in key)
        x = b"".join(t.column("x").to_pylist())
        lead = np.zeros((len(t), BOX_DIMS))
        turn = turned.value[d][:, :BOX_DIMS]
        lead[:, : turn.shape[1]] = unit(_matrix([x], d, kind)) @ turn
        data = [np.array(t.column(c).to_pylist(), dtype=np.int64).tobytes() for c in ("rep", "n")] + [x]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([d, *rest], [pa.int32()] * (1 + CELL_DIMS) + [pa.int64()])]
                                         + [pa.array([v], pa.list_(pa.float64())) for v in (lead.min(axis=0), lead.max(axis=0))] + [pa.array([v], pa.binary()) for v in data],
                                         ["d", *cell, "cut", "low", "high", "ids", "copies", "x"])

    schema = f"d int, {cells}, cut long, low array<double>, high array<double>, ids binary, copies binary, x binary"
    made = dealt.groupBy("d", *cell, "cut").applyInArrow(gather, schema)
    return staged(made.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def tile_pairs(made: DataFrame, threshold: float) -> DataFrame:
    """Both tiles (a_ and b_ columns) of each pair of tiles, once, that lie in
    neighbouring cells and whose boxes are near. A Cartesian product of the
    staged tiles: a task holds one file's and reads the other's."""
    side = lambda s: made.select(*[F.col(c).alias(f"{s}_{c}") for c in made.columns])
    a, b = F.col("a_tile"), F.col("b_tile")
    gap = lambda k: F.greatest(F.col("b_low")[k] - F.col("a_high")[k], F.col("a_low")[k] - F.col("b_high")[k], F.lit(0.0))
    apart = sum((gap(k) * gap(k) for k in range(BOX_DIMS)), F.lit(0.0))
    # of (a, b) and (b, a) one is taken by a hash, so that both tasks that see the pair's files have work
    first = (a == b) | ((a != b) & ((a < b) == (F.pmod(F.xxhash64(F.least(a, b), F.greatest(a, b)), F.lit(2)) == 0)))
    beside = [F.abs(F.col(f"a_c{k}") - F.col(f"b_c{k}")) <= 1 for k in range(CELL_DIMS)]
    near = reduce(lambda x, y: x & y, beside, (F.col("a_d") == F.col("b_d")) & first)
    return side("a").join(side("b").hint("shuffle_replicate_nl"), near & (apart <= 2 - 2 * threshold + SLACK))


def near_links(made: DataFrame, turns: dict[int, np.ndarray], threshold: float, kind: str) -> DataFrame:
    """(rep, links, other): link counts of vectors (other null) and forest links."""
    turned = made.sparkSession.sparkContext.broadcast(turns)
    work = tile_pairs(made, threshold).select(F.col("a_d").alias("d"), *[f"{s}_{c}" for s in "ab" for c in ("tile", "ids", "copies", "x")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, None  # the tile that several pairs in a row begin with
        for batch in batches:
            for k in range(batch.num_rows):
                cell = lambda c: column_of(batch, c)[k].as_py()  # noqa: B023, E731
                d, a, same = cell("d"), cell("a_tile"), cell("a_tile") == cell("b_tile")
                ids = [np.frombuffer(cell(f"{s}_ids"), np.int64) for s in "ab"]
                copies = [np.frombuffer(cell(f"{s}_copies"), np.int64) for s in "ab"]
                if at != a:
                    at, left = a, _turned(_matrix([cell("a_x")], d, kind), turned.value[d])
                right = left if same else _turned(_matrix([cell("b_x")], d, kind), turned.value[d])
                i, j = _near(left, right, threshold, same)
                if not len(i):
                    continue
                if same:
                    counts = np.bincount(i, copies[0][j], len(ids[0])) + np.bincount(j, copies[0][i], len(ids[0]))
                    every, counted, jj = ids[0], [counts], j
                else:
                    every = np.concatenate(ids)
                    counted, jj = [np.bincount(i, copies[1][j], len(ids[0])), np.bincount(j, copies[0][i], len(ids[1]))], j + len(ids[0])
                total = np.concatenate(counted).astype(np.int64)
                label = local_components(len(every), i, jj)
                got, moved = np.flatnonzero(total), np.flatnonzero(label != np.arange(len(every)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[every[got], every[moved]]), pa.array(np.r_[total[got], np.zeros(len(moved), np.int64)]),
                    pa.array([None] * len(got) + every[label[moved]].tolist(), pa.int64()),
                ], ["rep", "links", "other"])

    return staged(work.mapInArrow(run, "rep long, links long, other long"), "vector-links")


def embedding_components(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row: vec_id, n_links (other vectors linked directly),
    component_id (smallest id reachable) and kept (vec_id = component_id).

    Vectors that are null, empty, all zero or hold null or non-finite numbers
    link with nothing; vectors of different lengths never link. Repeated rows
    are vectors of their own that link with each other. A null id is kept and
    never names a component that has another id; an empty table gives no rows;
    other columns are ignored."""
    kind, of = ("<f4", "float") if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else ("<f8", "double")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{of}>").alias("v"))
    good = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = packed(rows.select("vec_id", F.when(good, F.col("v")).alias("v")), kind)
    digest = F.unhex(F.sha1("x")).alias("digest")  # rows find their vector again by SHA-1 and length
    distinct = rows.where("x is not null").groupBy("d", "x").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    reps = staged(distinct.select("*", digest, F.monotonically_increasing_id().alias("rep")), "vector-set")
    drop_shuffles(reps.sparkSession)
    turns = rotations(reps, kind)
    made = tiles(reps, turns, threshold, kind)
    drop_shuffles(reps.sparkSession)
    found = near_links(made, turns, threshold, kind)
    counts = found.where("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null"), "rep", "other").withColumnRenamed("node", "rep")
    linked = reps.join(roots, "rep").select("rep", "root", "first")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("least")), "root").select("rep", "least")
    done = reps.join(counts, "rep", "left").join(named, "rep", "left")
    done = staged(done.select("d", "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id")), "vector-classes")
    out = rows.select("vec_id", "d", digest).join(done, ["d", "digest"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
