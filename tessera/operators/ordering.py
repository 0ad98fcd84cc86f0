"""Order-dependent building blocks that stay correct and balanced under skew.

DataFrames have no order, so every ordered operator takes an explicit unique
``seq`` column. A naive ``row_number()``/``lag()`` window partitioned by a
business key sends every row of a hot key to one task; the helpers here never
do that:

* first/last per key are partial aggregates (``min``/``max_by``) combined
  map-side, joined back on the unique ``seq`` (uniform hash partitioning);
* positions and predecessors within a key are computed per *chunk* — the key
  plus a slice of the ``seq`` range — so each window partition holds at most
  ``chunk_width`` rows; a second, tiny window over per-chunk summaries stitches
  the chunks together.

``chunk_width`` is in units of ``seq``; seq must be integral.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 20
#: Consecutive chunk numbers whose sizes are summed in one window.
CHUNKS_TOGETHER = 1 << 16

_CHUNK = "__chunk"


def _keys(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def join_keys_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        how: str = "left") -> DataFrame:
    """Join on ``keys`` treating NULL as a value (like a Python dict key)."""
    keys = list(keys)
    if not keys:
        raise ValueError("join needs at least one key")
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def flag_first(df: DataFrame, keys: str | Sequence[str], seq: str, name: str = "is_first",
               candidates: Column | None = None) -> DataFrame:
    """Adds boolean ``name``: the row has the smallest ``seq`` of its key among
    the rows matching ``candidates`` (all rows when None).

    Plan: partial ``min(seq)`` per key (hot keys collapse map-side), then a
    join on ``seq`` and key — no window over the key. Rows of a key that share
    its smallest ``seq`` are all flagged; none is multiplied. The rows are
    shuffled on (seq, key), which spreads a hot key, after the aggregate's
    small shuffle on the key.
    """
    keys = _keys(keys)
    cand = df if candidates is None else df.filter(candidates)
    winners = cand.groupBy(*keys).agg(F.min(seq).alias(seq)).withColumn("__win", F.lit(True))
    out = join_keys_null_safe(df, winners, [seq, *keys], "left")
    won = F.coalesce(F.col("__win"), F.lit(False))
    if candidates is not None:  # a row that is no candidate may share the winner's seq
        won = won & F.coalesce(candidates, F.lit(False))
    return out.withColumn(name, won).drop("__win")


def latest_per_key(df: DataFrame, keys: str | Sequence[str], seq: str,
                   cols: Sequence[str]) -> DataFrame:
    """One row per key holding ``cols`` of the row with the largest ``seq``."""
    keys = _keys(keys)
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(seq)).alias("__last")
    return df.groupBy(*keys).agg(picked, F.max(seq).alias(seq)) \
        .select(*keys, seq, *[F.col(f"__last.{c}").alias(c) for c in cols])


def earliest_per_key(df: DataFrame, keys: str | Sequence[str], seq: str,
                     cols: Sequence[str]) -> DataFrame:
    """One row per key holding ``cols`` of the row with the smallest ``seq``."""
    keys = _keys(keys)
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(seq)).alias("__first")
    return df.groupBy(*keys).agg(picked, F.min(seq).alias(seq)) \
        .select(*keys, seq, *[F.col(f"__first.{c}").alias(c) for c in cols])


def _with_chunk(df: DataFrame, seq: str, width: int) -> DataFrame:
    return df.withColumn(_CHUNK, F.floor(F.col(seq) / F.lit(width)).cast("bigint"))


def position_in_key(df: DataFrame, keys: str | Sequence[str] | None, seq: str,
                    name: str = "position", chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """1-based rank of each row inside its key, in ``seq`` order.

    With no keys this is a gap-free global row index (without ``zipWithIndex``
    and without an unpartitioned window over the rows). Chunk sizes are taken
    from the ranked rows, on the exchange that ranked them, and summed in two
    levels: inside a group of ``CHUNKS_TOGETHER`` consecutive chunk numbers,
    then over the groups. However sparse ``seq`` is, no window holds more
    chunks than that, and the last one sees one row per occupied group.
    """
    keys = _keys(keys)
    chunked = _with_chunk(df, seq, chunk_width)
    part = keys + [_CHUNK]
    in_chunk = Window.partitionBy(*part).orderBy(seq)
    ranked = chunked.withColumn("__rn", F.row_number().over(in_chunk))
    counts = ranked.groupBy(*part).agg(F.max("__rn").cast("bigint").alias("__n")) \
        .withColumn("__group", F.floor(F.col(_CHUNK) / F.lit(CHUNKS_TOGETHER)).cast("bigint"))

    def before(*by, order):
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__n").over(w), F.lit(0))

    inner = counts.withColumn("__in", before(*keys, "__group", order=_CHUNK))
    groups = inner.groupBy(*keys, "__group").agg(F.sum("__n").alias("__n"))
    groups = groups.select(*keys, "__group", before(*keys, order="__group").alias("__out"))
    offsets = join_keys_null_safe(inner.drop("__n"), groups, [*keys, "__group"], "left") \
        .select(*part, (F.col("__in") + F.col("__out")).alias("__off"))
    out = join_keys_null_safe(ranked, offsets, part, "left") if keys else \
        ranked.join(offsets, _CHUNK, "left")
    return out.withColumn(name, (F.col("__rn") + F.col("__off")).cast("bigint")) \
        .drop("__rn", "__off", _CHUNK)


def _earlier_chunk(chunks: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: ``value`` of the key's previous chunk (null for its
    first). Chunks are compared inside groups of ``CHUNKS_TOGETHER``
    consecutive numbers, then the groups' last values, so that a sparse
    ``seq`` does not put a row for every event of a key into one window."""
    keys = list(keys)
    grouped = chunks.withColumn("__group", F.floor(F.col(_CHUNK) / F.lit(CHUNKS_TOGETHER)).cast("bigint"))
    inner = grouped.withColumn("__in", F.lag(F.struct(value)).over(Window.partitionBy(*keys, "__group").orderBy(_CHUNK)))
    lasts = inner.groupBy(*keys, "__group").agg(F.max_by(F.struct(value), F.col(_CHUNK)).alias("__last"))
    lasts = lasts.select(*keys, "__group", F.lag("__last").over(Window.partitionBy(*keys).orderBy("__group")).alias("__out"))
    out = join_keys_null_safe(inner, lasts, [*keys, "__group"], "left")
    return out.withColumn(name, F.coalesce("__in", "__out")[value]).drop("__in", "__out", "__group")


def previous_in_key(df: DataFrame, keys: str | Sequence[str], seq: str, value: str,
                    name: str, chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """``lag(value)`` over the key in ``seq`` order, computed chunk-wise.

    Inside a chunk the plain window lag is used; the first row of a chunk takes
    the last value of the nearest earlier non-empty chunk of the same key,
    found in two levels (see ``_earlier_chunk``).
    """
    keys = _keys(keys)
    chunked = _with_chunk(df, seq, chunk_width)
    part = keys + [_CHUNK]
    w = Window.partitionBy(*part).orderBy(seq)
    chunked = chunked.withColumn("__lag_v", F.lag(value).over(w)) \
        .withColumn("__lag_s", F.lag(seq).over(w))
    tails = chunked.groupBy(*part).agg(F.max_by(F.col(value), F.col(seq)).alias("__tail"))
    prev_tail = _earlier_chunk(tails, keys, "__tail", "__prev_tail").select(*part, "__prev_tail")
    out = join_keys_null_safe(chunked, prev_tail, part, "left")
    return out.withColumn(
        name, F.when(F.col("__lag_s").isNull(), F.col("__prev_tail")).otherwise(F.col("__lag_v"))
    ).drop("__lag_v", "__lag_s", "__prev_tail", _CHUNK)


def trailing_mean_in_key(df: DataFrame, keys: str | Sequence[str], seq: str, value: str, width: int,
                         name: str, position: str = "position", chunk_width: int = DEFAULT_CHUNK,
                         scale: int = 2) -> DataFrame:
    """Per key in ``seq`` order: the 1-based ``position`` and the mean of
    ``value`` over the current and previous ``width - 1`` rows (partial frames
    at the start; NULL values skipped), rounded half-even on the exact
    rational.

    One full shuffle. Rows are windowed per chunk (key + slice of the seq
    range), where ``lag`` gives the predecessors inside the chunk. A summary
    per chunk (row count and its last ``width - 1`` values, bounded) is
    aggregated from the windowed rows, which are already partitioned and
    sorted by chunk. Windows over the summaries, in two levels, give each chunk
    its position offset and the values carried over from earlier chunks (the
    previous ``width - 1`` non-empty chunks hold enough of them); they are
    joined back on (key, chunk). A hot key is spread over its chunks.
    """
    from tessera.functions.numeric import EXACT, half_even_mean

    keys = _keys(keys)
    k = width - 1
    chunked = _with_chunk(df, seq, chunk_width)
    part = keys + [_CHUNK]
    w = Window.partitionBy(*part).orderBy(seq)
    v = F.col(value).cast(EXACT)
    lag_names = [f"__lag{j}" for j in range(1, k + 1)]
    rows = chunked.select("*", F.row_number().over(w).alias("__rn"),
                          *[F.lag(v, j).over(w).alias(n) for j, n in zip(range(1, k + 1), lag_names)])
    # the last min(n, k) values of each chunk, oldest first (from its last row)
    recent = F.array(*[F.col(n) for n in reversed(lag_names)], v)
    summary = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"),
                                      F.max_by(recent, F.col(seq)).alias("__last"))
    take = F.least(F.col("__n"), F.lit(k))
    summary = summary.select(*part, "__n", F.slice(F.col("__last"), F.lit(k + 2) - take, take).alias("__tail"))
    # offset and carried values in two levels: inside a group of consecutive chunks, then over the groups
    last = lambda c: F.slice(c, F.greatest(F.size(c) - F.lit(k - 1), F.lit(1)), k) if k else c

    def carried(frame: DataFrame, by: list[str], order: str, off: str, carry: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order)
        before = F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        values = F.flatten(F.collect_list("__tail").over(w.rowsBetween(-k, -1))) if k else F.col("__tail")
        return frame.withColumns({off: before, carry: last(values)})

    summary = summary.withColumn("__group", F.floor(F.col(_CHUNK) / F.lit(CHUNKS_TOGETHER)).cast("bigint"))
    summary = carried(summary, [*keys, "__group"], _CHUNK, "__off_in", "__carry_in")
    groups = summary.groupBy(*keys, "__group").agg(
        F.sum("__n").alias("__n"), F.max_by(last(F.concat("__carry_in", "__tail")), F.col(_CHUNK)).alias("__tail"))
    groups = carried(groups, keys, "__group", "__off_out", "__carry_out").drop("__n", "__tail")
    summary = join_keys_null_safe(summary, groups, [*keys, "__group"], "left").select(
        *part, (F.col("__off_in") + F.col("__off_out")).alias("__off"), last(F.concat("__carry_out", "__carry_in")).alias("__carry"))

    out = join_keys_null_safe(rows, summary, part, "left")
    # frame slot j (j rows back): inside the chunk while j < rn, else carried over
    slots = [v]
    for j in range(1, k + 1):
        # the (j - rn + 1)-th carried value from the end; clamped below 0 (index 0 is an error)
        from_carry = F.try_element_at(F.col("__carry"), F.least(F.col("__rn") - F.lit(j + 1), F.lit(-1)))
        slots.append(F.when(F.col("__rn") > j, F.col(f"__lag{j}")).otherwise(from_carry))
    total = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0).cast(EXACT)) for x in slots])
    n = reduce(lambda a, b: a + b, [x.isNotNull().cast("int") for x in slots])
    return out.withColumn(position, (F.col("__rn") + F.col("__off")).cast("bigint")) \
        .withColumn(name, half_even_mean(total.cast(EXACT), n, scale)) \
        .drop("__rn", "__off", "__carry", _CHUNK, *lag_names)
