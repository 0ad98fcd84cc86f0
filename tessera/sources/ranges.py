"""Records of large files, read by many tasks.

A quoted CSV field may hold line ends, a JSON document may be one line: where
a record ends cannot be told from the bytes around. So files are read as
pieces that end at a separator (line ends, closing braces) and can be split
anywhere, in two passes:

1. For each split, what its pieces do to the reader's state, from either state
   it may begin in (inside quotes or not): the state it ends in, how far the
   depth of brackets moves, and the lowest depth at which a piece ends.
   These rows, one a split, are combined in file order, which tells every
   split the state it really begins in.
2. Each split is read from that state. Records that end in it are its own;
   what precedes its first record end belongs to a record begun earlier, what
   follows the last one to the next. These fragments, at most two a split,
   are put together by Spark.

A record is placed where it ends. Memory holds one Arrow batch and one record.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import staging_path
from tessera.sources.files import ROW_BITS

#: Splits whose states are sent to every task; of more files the states
#: travel beside the pieces, by an exchange.
SENT_SPLITS = 100_000

_SPLIT = ["file", "block"]
_LOWEST = 5


@dataclass(frozen=True)
class Grammar:
    """How pieces make records. ``step(piece, inside)`` gives the state after
    the piece and its separator and the change of depth; a record ends where a
    piece ends outside quotes at ``depth``. ``parse`` turns record texts into
    fields; ``joint`` is what stood between pieces."""

    separator: str
    step: Callable[[str, bool], tuple[bool, int]]
    depth: int
    parse: Callable[[list[str]], list[list[str]]]
    joint: str


def _close_quote(line: str, at: int) -> int:
    """Place after the quote that closes a field, -1 if the line has none."""
    while (q := line.find('"', at)) >= 0:
        if line[q + 1 : q + 2] != '"':
            return q + 1
        at = q + 2
    return -1


def csv_step(line: str, inside: bool) -> tuple[bool, int]:
    """Whether a quoted field is open after the line. A quote opens a field
    only at its start, doubled quotes inside stand for one, and what follows
    a closing quote up to the comma is plain."""
    at = 0
    if inside:
        at = _close_quote(line, 0)
        if at < 0:
            return True, 0
        at = line.find(",", at) + 1
        if not at:
            return False, 0
    while True:
        if line[at : at + 1] != '"':
            at = line.find(',"', at) + 1
            if not at:
                return False, 0
        at = _close_quote(line, at + 1)
        if at < 0:
            return True, 0
        at = line.find(",", at) + 1
        if not at:
            return False, 0


def parse_csv(records: list[str]) -> list[list[str]]:
    """Fields of complete records, as Python's csv module splits them. A lone
    carriage return outside quotes reads as a space."""
    csv.field_size_limit(sys.maxsize)
    try:
        return list(csv.reader(records))
    except csv.Error:
        return [next(csv.reader([r.replace("\r", " ")])) for r in records]


def json_step(piece: str, inside: bool) -> tuple[bool, int]:
    """State after the piece and the closing brace that ended it."""
    at, depth = 0, 0
    while True:
        if not inside:
            q = piece.find('"', at)
            plain = piece[at:] if q < 0 else piece[at:q]
            if plain:
                depth += plain.count("{") + plain.count("[") - plain.count("]")
            if q < 0:
                return False, depth - 1
            at = q + 1
        while True:  # the end of a string
            q = piece.find('"', at)
            if q < 0:
                return True, depth
            slash = q
            while slash > at and piece[slash - 1] == "\\":
                slash -= 1
            at = q + 1
            if (q - slash) % 2 == 0:
                break
        inside = False


CSV = Grammar("\n", csv_step, 0, parse_csv, "\n")
#: Members of one array or object, each an object: a record ends at depth 1.
JSON_MEMBERS = Grammar("}", json_step, 1, lambda records: [[r] for r in records], "}")


def pieces(spark: SparkSession, path, grammar: Grammar) -> DataFrame:
    """(piece, file, block, mono) of all files behind ``path``."""
    df = spark.read.option("lineSep", grammar.separator).text(path if isinstance(path, str) else list(path))
    return as_pieces(df)


def as_pieces(df: DataFrame) -> DataFrame:
    """The columns this module reads, from a text scan (batch or stream)."""
    return df.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mono"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of pieces of one split: ((file, block), texts, monos)."""
    for b in batches:
        if not b.num_rows:
            continue
        files, blocks = b.column("file").dictionary_encode(), b.column("block")
        turn = pc.or_(pc.not_equal(files.indices[1:], files.indices[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
        cuts = [0, *(i + 1 for i in pc.indices_nonzero(turn).to_pylist()), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            texts = [t.decode("utf-8", "replace") for t in b.column("piece")[i:j].to_pylist()]
            yield (files[i].as_py(), blocks[i].as_py()), texts, b.column("mono")[i:j].to_pylist()


def _line(text: str, grammar: Grammar) -> str:
    return text[:-1] if grammar.separator == "\n" and text.endswith("\r") else text


def split_effects(source: DataFrame, grammar: Grammar) -> DataFrame:
    """(file, block, and from either state: end, delta, stops) of every split.

    ``stops`` are the depths, counted from the split's start, at which pieces
    end outside quotes; only the lowest few can end a record, as a file's
    last piece alone may go lower than its members."""
    step = grammar.step
    names = [*_SPLIT, "end_out", "delta_out", "stops_out", "end_in", "delta_in", "stops_in"]
    kinds = [pa.string(), pa.int64(), *[pa.bool_(), pa.int64(), pa.list_(pa.int64())] * 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, []

        def row() -> pa.RecordBatch:
            values = [*at, *(v for inside, depth, stops in state for v in (inside, depth, sorted(stops)))]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for split, texts, _ in _rows(batches):
            if split != at:
                if at is not None:
                    yield row()
                at, state = split, [(False, 0, set()), (True, 0, set())]
            for k, (inside, depth, stops) in enumerate(state):
                low = min(stops, default=None)
                for t in texts:
                    inside, d = step(t, inside)
                    depth += d
                    if not inside and (low is None or depth < low + _LOWEST) and depth not in stops:
                        stops.add(depth)
                        low = min(stops)
                        stops -= {x for x in stops if x >= low + _LOWEST}
                state[k] = (inside, depth, stops)
        if at is not None:
            yield row()

    each = "end_{0} boolean, delta_{0} long, stops_{0} array<long>"
    return source.mapInArrow(run, f"file string, block long, {each.format('out')}, {each.format('in')}")


def split_states(effects: DataFrame, grammar: Grammar) -> DataFrame:
    """(file, block, inside, depth, record) each split begins with.

    A split sets the state, keeps it or swaps it: the state before a split is
    the last one set, swapped as often as splits since did. ``record`` counts
    the earlier splits of the file in which some record ends."""
    by_file = Window.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("end_out") & ~F.col("end_in")).cast("int")
    df = effects.withColumn("swaps", F.sum(swap).over(by_file.rowsBetween(Window.unboundedPreceding, 0)))
    sets = F.when(F.col("end_out") == F.col("end_in"), F.struct(F.col("end_out").alias("to"), "swaps"))
    df = df.withColumn("set", F.last(sets, ignorenulls=True).over(before))
    swapped = (F.coalesce(F.lag("swaps").over(by_file), F.lit(0)) - F.coalesce("set.swaps", F.lit(0))) % 2 == 1
    df = df.withColumn("inside", F.coalesce("set.to", F.lit(False)) != swapped)
    own = lambda c: F.when(F.col("inside"), F.col(f"{c}_in")).otherwise(F.col(f"{c}_out"))
    df = df.withColumn("depth", F.coalesce(F.sum(own("delta")).over(before), F.lit(0)))
    ends = F.array_contains(own("stops"), F.lit(grammar.depth) - F.col("depth")).cast("long")
    return df.select(*_SPLIT, "inside", "depth", F.coalesce(F.sum(ends).over(before), F.lit(0)).alias("record"))


def _read(source: DataFrame, grammar: Grammar, states: dict | None) -> DataFrame:
    """(file, block, mono, part, fields): records (part 'r') that begin and
    end in a split, and the fragments up to its first record end ('h'), after
    the last ('t'), or all of a split without any ('o'). Without ``states``,
    rows without piece bring them."""
    step, stop = grammar.step, grammar.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, depth, held, headed = None, False, 0, [], False
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            done = [r for r in out if r[3] == "r"]
            fields = iter(grammar.parse([r[4] for r in done]))
            rows = [(*r[:4], next(fields) if r[3] == "r" else [r[4]]) for r in out]
            out.clear()
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*_SPLIT, "mono", "part", "fields"])

        def tail() -> None:
            if held:
                out.append((*at, last, "t" if headed else "o", grammar.joint.join(held)))

        last = 0
        for split, texts, monos in _rows(batches):
            if split != at:
                tail()
                at, held, headed = split, [], False
                if states is not None:
                    inside, depth = states[split]
                else:  # the first row of a split
                    inside, depth = bool(monos[0] & 1), monos[0] >> 1
                    texts, monos = texts[1:], monos[1:]
            for text, last in zip(texts, monos):
                inside, d = step(text, inside)
                depth += d
                held.append(_line(text, grammar))
                if not inside and depth == stop:
                    out.append((*at, last, "r" if headed else "h", grammar.joint.join(held)))
                    held, headed = [], True
            yield flush()
        tail()
        yield flush()

    return source.mapInArrow(run, "file string, block long, mono long, part string, fields array<string>")


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = staging_path(df.sparkSession, f"ranges-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _states(source: DataFrame, grammar: Grammar) -> DataFrame:
    """The state of every split; files that are one split need no first pass."""
    splits = source.select(*_SPLIT).distinct()
    if splits.filter("block > 0").isEmpty():
        return splits.withColumns({"inside": F.lit(False), "depth": F.lit(0).cast("long"), "record": F.lit(0).cast("long")})
    return split_states(split_effects(source, grammar), grammar)


def records(source: DataFrame, grammar: Grammar, sent_splits: int = SENT_SPLITS) -> DataFrame:
    """(fields array<string>, seq, file, first, closed): every record of the
    files, ``seq`` in the order of (file path, place in the file), ``first``
    for the first one of a file. What a file ends with after its last record
    end is a record too, not ``closed``, without the file's last line end."""
    spark = source.sparkSession
    states = _states(source, grammar)
    rank = (F.row_number().over(Window.orderBy(*_SPLIT)) - 1).cast("long")  # one row a split
    states = states.withColumn("rank", rank)
    known = states.limit(sent_splits + 1).collect()
    if len(known) <= sent_splits:
        sent = {(r.file, r.block): (r.inside, r.depth) for r in known}
        states = spark.createDataFrame(known, states.schema)
        parts = _read(source, grammar, sent)
    else:
        states = _staged(states, "states")
        begin = F.shiftleft(F.col("depth"), 1) + F.col("inside").cast("long")
        marks = states.select(F.expr("X''").alias("piece"), *_SPLIT, begin.alias("mono"), F.lit(-1).cast("long").alias("place"))
        rows = source.withColumn("place", F.col("mono")).unionByName(marks)
        rows = rows.repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "place").drop("place")
        parts = _read(rows, grammar, None)
    whole = parts.filter("part = 'r'").select(*_SPLIT, "mono", "fields")
    # a split's head ends the record that is open before it, its tail opens the next one
    some = parts.filter("part <> 'r'").join(states.select(*_SPLIT, "record"), _SPLIT)
    some = some.withColumn("record", F.when(F.col("part") == "t", F.col("record") + 1).otherwise(F.col("record")))
    place = F.struct("block", "mono", (F.col("part") == "h").alias("ends"), F.col("fields")[0].alias("text"))
    some = some.groupBy("file", "record").agg(F.sort_array(F.collect_list(place)).alias("of"))
    end = F.element_at("of", -1)
    text = F.array_join(F.transform("of", lambda x: x["text"]), grammar.joint)
    some = some.select("file", end["block"].alias("block"), end["mono"].alias("mono"), (F.col("record") == 0).alias("first"), end["ends"].alias("closed"), text.alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fields = [grammar.parse([t])[0] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(fields, pa.list_(pa.string()))], [*_SPLIT, "mono", "first", "closed", "fields"])

    stitched = some.mapInArrow(parse, "file string, block long, mono long, first boolean, closed boolean, fields array<string>")
    out = whole.withColumns({"first": F.lit(False), "closed": F.lit(True)}).unionByName(stitched).join(states.select(*_SPLIT, "rank"), _SPLIT)
    seq = F.shiftleft("rank", ROW_BITS) + F.col("mono").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return out.select("fields", seq.alias("seq"), "file", "first", "closed")
