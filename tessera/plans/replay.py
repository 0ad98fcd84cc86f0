"""Replay a table as a file stream, in order.

Rows are appended in ``n_chunks`` consecutive ``seq`` ranges, one write per
range, so every file of range k is older than every file of range k + 1 (the
file source hands out files oldest first). Inside a range, rows are
hash-partitioned by ``key`` and sorted by ``seq``, so all events of a key in
that range sit in one file in order: however the files are cut into
micro-batches, each key sees its events in ``seq`` order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows that one replayed file holds at most on average.
ROWS_PER_FILE = 1_000_000


def write_stream_chunks(df: DataFrame, path: str, key: str, seq: str = "seq", n_chunks: int = 3,
                        files_per_chunk: int = 2, fmt: str = "parquet", options: dict | None = None,
                        columns: list[str] | None = None) -> None:
    bounds = df.agg(F.min(seq).alias("lo"), F.max(seq).alias("hi"), F.count(F.lit(1)).alias("n")).first()  # one row
    if bounds["lo"] is None:
        return
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = (hi - lo) // n_chunks + 1
    files_per_chunk += int(bounds["n"]) // (n_chunks * ROWS_PER_FILE)  # as many as the table needs
    for k in range(n_chunks):
        part = df.filter((F.col(seq) >= lo + k * step) & (F.col(seq) < lo + (k + 1) * step))
        part = part.repartition(files_per_chunk, key).sortWithinPartitions(seq)
        if columns is not None:
            part = part.select(*columns)  # a projection keeps the sorted order
        w = part.write.mode("append").format(fmt)
        for name, value in (options or {}).items():
            w = w.option(name, value)
        w.save(path)
