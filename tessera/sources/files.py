"""File-order keys and small per-file probes shared by the file sources.

A DataFrame read from files carries no order, but "first row wins" rules need
the order of the source. Rows get ``seq = split_rank * 2^33 + row_in_task``:
``split_rank`` is the rank of (file path, first byte of the split) among the
values that the scan itself reports, and the low bits come from
``monotonically_increasing_id``, which grows in read order inside a split. A
task may read several splits in any order; their ranks keep them apart.
"""

from __future__ import annotations

import csv
import io
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

ROW_BITS = 33


def list_files(spark: SparkSession, path: str | list[str], fmt: str = "text") -> list[str]:
    """Files behind ``path`` (the same listing Spark does for any scan).
    A missing path raises ``FileNotFoundError``."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        return sorted(spark.read.format(fmt).load(paths).inputFiles())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"File not found: {path}") from e
        raise


def order_columns() -> list:
    """What ``with_file_order`` needs; select it directly over a file scan."""
    return [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__mono")]


def with_file_order(df: DataFrame) -> DataFrame:
    """Adds ``seq`` (file path, then split, then row) and drops the
    ``order_columns``. The ranks are those of the splits the scan reports (one
    row per split), so no path has to be spelled the way a listing spells it;
    a row without a rank fails the job."""
    splits = df.select("__file", "__block").distinct()
    ranks = splits.select(F.col("__file").alias("__f"), F.col("__block").alias("__b"),
                          (F.row_number().over(Window.orderBy("__file", "__block")) - 1).cast("long").alias("__rank"))
    out = df.join(ranks, (F.col("__file") == F.col("__f")) & (F.col("__block") == F.col("__b")), "left")
    rank = F.when(F.col("__rank").isNull(), F.raise_error(F.concat(F.lit("no rank for "), F.col("__file"))).cast("long")) \
        .otherwise(F.col("__rank"))
    low = F.col("__mono").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return out.withColumn("seq", F.shiftleft(rank, ROW_BITS) + low) \
        .drop("__file", "__block", "__f", "__b", "__rank", "__mono")


def _first_line_of(path: str) -> str | None:
    """First line of one file, however long, and little beyond it."""
    from pyarrow import fs as pafs

    if path.startswith("file:"):
        filesystem, p = pafs.LocalFileSystem(), "/" + unquote(path[len("file:"):]).lstrip("/")  # listings escape paths
    else:
        filesystem, p = pafs.FileSystem.from_uri(path)
    buf = b""
    with filesystem.open_input_stream(p) as f:
        while b"\n" not in buf:
            chunk = f.read(64 * 1024)
            if not chunk:
                break
            buf += chunk
    if not buf:
        return None
    return buf.split(b"\n", 1)[0].decode("utf-8", errors="replace").rstrip("\r")


def csv_headers(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, header) for each file — the first CSV record, parsed — computed
    on the executors, one small read per file. ``header`` is null for an
    empty file."""
    def probe(batches):
        for pdf in batches:
            heads = []
            for p in pdf["path"]:
                line = _first_line_of(p)
                heads.append(None if line is None else next(csv.reader(io.StringIO(line)), []))
            yield pd.DataFrame({"path": pdf["path"], "header": heads})

    n = max(1, min(len(files), spark.sparkContext.defaultParallelism * 4))
    return spark.createDataFrame([(f,) for f in files], "path string").repartition(n) \
        .mapInPandas(probe, "path string, header array<string>")


def dense_row_number(df: DataFrame, seq: str = "seq", name: str = "row_no") -> DataFrame:
    """1-based row number in ``seq`` order, skew-free (see ordering.position_in_key)."""
    from tessera.operators.ordering import position_in_key

    return position_in_key(df, None, seq, name)


__all__ = ["list_files", "order_columns", "with_file_order", "csv_headers", "dense_row_number"]
