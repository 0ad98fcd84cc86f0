"""Keyed state of a stream, kept in files by bucket and micro-batch.

A key's rows lie in the bucket of its hash; a micro-batch reads the buckets
its keys fall into and writes these anew under its own number, the others stay
where they are. A batch reads what was there before its number, so one that is
run again finds the state it found the first time and writes the same files.
Its cost follows the buckets it touches, not all that was ever stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = -1


class BucketState:
    """State rows of ``schema`` (DDL), grouped by ``keys``, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 256):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _children(self, path: str) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []

    def versions(self, before: int | None = None) -> dict[int, list[int]]:
        """By bucket the batches that wrote it (before ``before``), ascending."""
        out: dict[int, list[int]] = {}
        batches = sorted(int(n.split("=")[1]) for n in self._children(self.path) if n.startswith("batch_id="))
        for batch in batches:
            if before is None or batch < before:
                for name in self._children(f"{self.path}/batch_id={batch}"):
                    if name.startswith("bucket="):
                        out.setdefault(int(name.split("=")[1]), []).append(batch)
        return out

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the rows' keys (at most as many as there are)."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def read(self, touched: list[int], before: int) -> DataFrame:
        """The state of these buckets as it was before a batch."""
        known = self.versions(before)
        paths = [f"{self.path}/batch_id={known[b][-1]}/bucket={b}" for b in touched if b in known]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The whole state of every bucket that ``rows`` has, as of this batch."""
        known = self.versions(batch_id)
        names = [c.split()[0] for c in self.schema.split(",")]
        out = rows.select(*names, F.lit(batch_id).alias("batch_id"), self.bucket().alias("bucket"))
        out = out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("batch_id", "bucket").parquet(self.path)
        self._forget(known)

    def _forget(self, known: dict[int, list[int]]) -> None:
        """Versions that a later one had replaced before this batch began."""
        for bucket, batches in known.items():
            for batch in batches[:-1]:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={batch}/bucket={bucket}")
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def seed(self, rows: DataFrame) -> None:
        """The state before the first batch, unless there is some already."""
        if not self.versions():
            self.write(rows, SEED)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write the rows of a batch as its partition of ``path`` (again, if it is
    run again) and read them back."""
    out = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path).filter(F.col("batch_id") == batch_id)
