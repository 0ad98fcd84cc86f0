"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import staging_path

#: Words are runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, a
    lost executor re-reads files, and every later use sees the same rows."""
    path = staging_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As ``staged``, with each file holding one hash bucket of ``key``, so that
    grouping by ``key`` needs no exchange. The files stay, as ``staged``'s do; the
    table's name is only needed to read them as buckets."""
    spark, path = df.sparkSession, staging_path(df.sparkSession, f"llm-{label}")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return out


def drop_shuffles(spark: SparkSession) -> None:
    """Have executors delete the shuffle files of jobs that are over: Spark does
    so when the driver's garbage is collected, which it may not be for long."""
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare_prefix(docs: DataFrame, *names: str) -> str:
    """A prefix under which none of ``names`` is a column of ``docs``."""
    taken, prefix = {c.lower() for c in docs.columns}, "__"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return prefix


def id_text_crc(col: str) -> Column:
    """crc32 of an integer id written as decimal text (null id: of '')."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def text_list(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A string column as Python strings, null as empty."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)), "").to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of an Arrow string column, flat, and each row's word count."""
    texts = pc.fill_null(texts, "")
    texts = pa.concat_arrays([texts, texts[:0]])  # a copy from offset 0: some kernels misread slices
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = parts.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    n = np.diff(parts.offsets.to_numpy())
    keep = real.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(n)), n)
    return flat.filter(real), np.bincount(row[keep], minlength=len(n))


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over links i-j."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while not np.array_equal(nxt := new[new], new):
            new = nxt
        if np.array_equal(new, label):
            break
        label = new
    return label
