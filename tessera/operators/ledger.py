"""Ordered borrow / return logs solved in chunks (the general case of W5).

A title's events depend on two counters: its active loans, and the active
loans of each borrower. Both are carried from event to event, so every event
may hang on all those before it; what can be done apart is. A title's log is
cut into chunks of ``chunk_rows`` consecutive events, and spans of them are
packed in parallel: borrowers as numbers, the rest as arrays, one row for up to
``SPAN_ROWS`` events. The packed spans of a title are walked in order by one
task, which holds one span and the title's active loans and writes down the
counters that each chunk starts with; different titles are walked side by side.
From these starts all chunks are replayed in parallel. However a title's
counters go, its log is read a fixed number of times. Titles of one chunk are
replayed at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import DEFAULT_CHUNK, position_in_key
from tessera.session import staging_path

#: Events of a title that one chunk holds.
CHUNK_ROWS = 1 << 17
#: Events of a title that are packed into one row, or one chunk's if that is more.
SPAN_ROWS = 1 << 17

_TOTAL = "t"  # key of a title's own counter; borrowers have "b" + name, a null one "n"
_NO_COPIES = -1 << 63  # for unknown copies: no borrow
_START, _BORROW, _RETURN = 0, 1, 2  # what a row sent to Python is
_CHUNK, _SPAN = ["book_title", "chunk"], ["book_title", "span"]
COUNTERS = "book_title string, who string, n long"


def _who(borrower: Column) -> Column:
    return F.coalesce(F.concat(F.lit("b"), borrower), F.lit("n"))


def _edges(batch: pa.RecordBatch, *columns: str) -> np.ndarray:
    """By row whether it differs from the one before in ``columns``; the first does."""
    code = lambda v: (v.dictionary_encode().indices if pa.types.is_string(v.type) else v).to_numpy()
    new = np.ones(len(batch), bool)
    if len(batch):
        new[1:] = np.any([c[1:] != c[:-1] for c in (code(batch.column(c)) for c in columns)], axis=0)
    return new


def _names(column: pa.Array) -> list[str]:
    """A string column as Python strings, each made once."""
    coded = column.dictionary_encode()
    names = coded.dictionary.to_pylist()
    return [names[i] for i in _list(coded.indices)]


def _list(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _limits(copies: pa.Array) -> pa.Array:
    return pc.fill_null(copies, _NO_COPIES)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (chunk, title, event, seq), a chunk's counters ahead of
    its events -> the outcome of every event."""
    words = pa.array(["borrowed", "no_copies", "returned", "no_active_loan"])
    at, total, held = None, 0, {}
    for b in batches:
        out: list[int] = []
        new = _edges(b, *_CHUNK).tolist()
        if new and at == (b.column("book_title")[0].as_py(), b.column("chunk")[0].as_py()):
            new[0] = False
        for first, what, who, n in zip(new, _list(b.column("what")), _names(b.column("who")), _list(_limits(b.column("n")))):
            if first:
                total, held = 0, {}
            if what == _START:
                if who == _TOTAL:
                    total = n
                else:
                    held[who] = n
            elif what == _BORROW:
                out.append(0 if total < n else 1)
                if total < n:
                    total += 1
                    held[who] = held.get(who, 0) + 1
            elif (own := held.get(who, 0)) > 0:
                out.append(2)
                total -= 1
                held[who] = own - 1
            else:
                out.append(3)
        if new:
            at = (b.column("book_title")[-1].as_py(), b.column("chunk")[-1].as_py())
        yield pa.RecordBatch.from_arrays([b.column("seq").filter(pc.not_equal(b.column("what"), _START)), words.take(pa.array(out, pa.int8()))], ["seq", "outcome"])


_PACKED = "book_title string, chunk long, chunks binary, sizes binary, whos array<string>, who_at binary, borrows binary, limits binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events sorted by (span, title, chunk, seq) -> one row per span:
    its chunks and their sizes, its borrowers, and by event the borrower's
    place among them, whether it is a borrow, and the copies."""
    at, parts = None, []

    def row() -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        column = lambda c: t.column(c).combine_chunks()
        chunks, sizes = np.unique(column("chunk").to_numpy(), return_counts=True)
        who = column("who").dictionary_encode()
        borrows, limits = column("what").to_numpy() == _BORROW, _limits(column("n")).to_numpy()
        arrays = [a.tobytes() for a in (chunks.astype(np.int64), sizes.astype(np.int64), who.indices.to_numpy().astype(np.int32), borrows.astype(np.uint8), limits.astype(np.int64))]
        values = [at[0], int(chunks[0]), *arrays[:2], who.dictionary.to_pylist(), *arrays[2:]]
        types = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, types)], [c.split()[0] for c in _PACKED.split(", ")])

    for b in batches:
        cuts = np.flatnonzero(_edges(b, *_SPAN)).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(b)]):
            key = (b.column("book_title")[lo].as_py(), b.column("span")[lo].as_py())
            if at != key:
                if parts:
                    yield row()
                at, parts = key, []
            parts.append(b.slice(lo, hi - lo))
    if at is not None:
        yield row()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (title, chunk), a title's counters ahead of its packed
    spans -> (title, chunk, who, n): the counters other than 0 that each chunk
    starts with, of the borrowers that it names."""
    at, total, held = None, 0, {}  # held: the title's active loans by borrower
    for b in batches:
        for k, (title, event, who, n) in enumerate(zip(*(b.column(c).to_pylist() for c in ("book_title", "event", "who", "n")))):
            if at != title:
                at, total, held = title, 0, {}
            if not event:
                if who == _TOTAL:
                    total = n
                else:
                    held[who] = n
                continue
            array = lambda c, kind: np.frombuffer(b.column(c)[k].as_py(), kind)  # noqa: B023, E731
            chunks, sizes, whos = array("chunks", np.int64), array("sizes", np.int64), b.column("whos")[k].as_py()
            who_at, borrows, limits = array("who_at", np.int32), array("borrows", np.uint8), array("limits", np.int64)
            counts = [held.get(w, 0) for w in whos]
            before, out = counts.copy(), []
            for chunk, hi, size in zip(chunks.tolist(), np.cumsum(sizes).tolist(), sizes.tolist()):
                own = slice(hi - size, hi)
                out.append((chunk, _TOTAL, total))
                out.extend((chunk, whos[i], counts[i]) for i in np.unique(who_at[own]).tolist() if counts[i])
                for i, borrow, limit in zip(who_at[own].tolist(), borrows[own].tolist(), limits[own].tolist()):
                    if borrow:
                        if total < limit:
                            total += 1
                            counts[i] += 1
                    elif counts[i] > 0:
                        total -= 1
                        counts[i] -= 1
            for w, was, now in zip(whos, before, counts):
                if now:
                    held[w] = now
                elif was:
                    del held[w]
            yield pa.RecordBatch.from_arrays([pa.array([title] * len(out), pa.string()), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64())))], [*_CHUNK, "who", "n"])


def _in_order(events: DataFrame, starts: DataFrame) -> DataFrame:
    """Events and counters (title, chunk, span, who, n), each span in one task, sorted."""
    rows = events.withColumns({"event": F.lit(True), "n": F.col("copies").cast("long")}).drop("copies")
    counters = starts.select(*_CHUNK, "span", F.lit(False).alias("event"), F.lit(0).cast("long").alias("seq"), F.lit("start").alias("kind"), "who", "n")
    return rows.unionByName(counters, allowMissingColumns=True).repartition(*_SPAN).sortWithinPartitions("span", *_CHUNK, "event", "seq")


def _coded(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in order as they are sent to Python: few columns, few of them text."""
    what = F.when(~F.col("event"), _START).when(F.col("kind") == "borrow", _BORROW).otherwise(_RETURN).cast("byte")
    return rows.select("book_title", *columns, what.alias("what"), "who", "n")


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = staging_path(df.sparkSession, f"ledger-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _chunk_starts(events: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """(title, chunk, who, n): the counters other than 0 at every chunk's start,
    from spans of ``width`` chunks that are packed apart and walked in order."""
    span = F.floor(F.col("chunk") / F.lit(width)).cast("long").alias("span")
    whole = F.lit(0).cast("long").alias("span")
    none = known.where(F.lit(False)).select("*", F.lit(0).cast("long").alias("chunk"), whole)
    packed = _coded(_in_order(events.select("*", span), none), "span", "chunk").mapInArrow(_pack, _PACKED)
    spans = packed.select("*", whole, F.lit(0).cast("long").alias("seq"), F.lit("span").alias("kind"), F.lit(None).cast("string").alias("who"), F.lit(None).alias("copies"))
    walked = _in_order(spans, known.select("*", F.lit(0).cast("long").alias("chunk"), whole))
    return _staged(walked.mapInArrow(_walk, "book_title string, chunk long, who string, n long").filter("n <> 0"), "starts")


def counters(loans: DataFrame) -> DataFrame:
    """(book_title, who, n): the active loans of every title and borrower; a
    null borrower's count for the title only."""
    act = loans.filter(F.col("return_date").isNull() & F.col("book_title").isNotNull())
    total = act.select("book_title", F.lit(_TOTAL).alias("who"))
    own = act.filter(F.col("borrower_name").isNotNull()).select("book_title", _who(F.col("borrower_name")).alias("who"))
    return total.unionByName(own).groupBy("book_title", "who").agg(F.count(F.lit(1)).alias("n"))


def after_events(before: DataFrame, done: DataFrame) -> DataFrame:
    """The counters after events with their outcomes (book_title,
    borrower_name, outcome)."""
    step = F.when(F.col("outcome") == "borrowed", 1).when(F.col("outcome") == "returned", -1).cast("long")
    moved = done.filter(F.col("outcome").isin("borrowed", "returned")) \
        .select("book_title", F.explode(F.array(F.lit(_TOTAL), _who(F.col("borrower_name")))).alias("who"), step.alias("n"))
    return before.unionByName(moved).groupBy("book_title", "who").agg(F.sum("n").alias("n")).filter("n <> 0")


def ledger_outcomes(events: DataFrame, known: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_width: int = DEFAULT_CHUNK,
                    span_rows: int = SPAN_ROWS) -> DataFrame:
    """(seq, outcome) of each event (seq, book_title, kind, borrower_name, copies).

    ``known`` are the ``counters`` before the first event. Titles are not
    null. A borrow needs fewer active loans than the event's copies, a return
    an active loan of its borrower."""
    at_first = lambda df: df.withColumn("chunk", F.lit(0).cast("long"))
    columns = ["seq", "kind", _who(F.col("borrower_name")).alias("who"), "copies"]
    sizes = events.groupBy("book_title").agg(F.count(F.lit(1)).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= chunk_rows:
        rows, starts = events.select("book_title", F.lit(0).cast("long").alias("chunk"), *columns), at_first(known)
    else:
        numbered = position_in_key(events, "book_title", "seq", "__pos", chunk_width)
        chunk = F.floor((F.col("__pos") - 1) / F.lit(chunk_rows)).cast("long")
        rows = _staged(numbered.select("book_title", chunk.alias("chunk"), *columns), "events")
        long_titles = _staged(rows.filter("chunk = 1").select("book_title").distinct(), "titles")
        known = _staged(known, "known")
        long = lambda df: df.join(long_titles, "book_title", "left_semi")
        later = _chunk_starts(long(rows), long(known), max(1, span_rows // chunk_rows))
        starts = at_first(known).join(long_titles, "book_title", "left_anti").unionByName(later)
    one = F.col("chunk").alias("span")  # each chunk by itself
    return _coded(_in_order(rows.select("*", one), starts.select("*", one)), "chunk", "seq").mapInArrow(_replay, "seq long, outcome string")
