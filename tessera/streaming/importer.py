"""Continuous user-CSV import with de-duplication across micro-batches.

Each micro-batch is imported with the batch operator against the ids stored
before that batch. Outcomes and newly added users are written into a
``batch_id`` partition with dynamic overwrite, ids into the buckets the batch
touches (``bucket_state``) — so a retried batch reproduces exactly the same
result, cross-batch duplicates are found, and a batch reads the stored ids of
its own buckets only. Files are read by as many tasks as they have splits
(``sources.ranges``). ``seq`` orders the rows of one batch; the order of the
whole stream is (``batch_id``, ``seq``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.text import py_int
from tessera.operators.importer import import_users, observed_audit
from tessera.sources.ranges import CSV
from tessera.sources.users_csv import user_rows
from tessera.streaming.bucket_state import BucketState, write_batch


def start_import_stream(spark: SparkSession, source_dir: str, store_path: str, outcomes_path: str,
                        checkpoint: str, existing_ids: DataFrame | None = None, files_per_batch: int = 1,
                        available_now: bool = True, ids_path: str | None = None, buckets: int = 256,
                        on_metrics=None) -> StreamingQuery:
    """Start the stream over CSV files (header ``user_id,name,email``).

    ``ids_path`` (default beside the store) keeps the known ids by bucket; it
    begins as ``existing_ids``. ``on_metrics(batch_id, counts)`` gets the rows
    of each outcome, counted while the outcomes are written."""
    ids_path = ids_path or store_path.rstrip("/") + "-ids"
    if existing_ids is not None:
        first = existing_ids.select(F.col("user_id").cast("long")).distinct()
        BucketState(spark, ids_path, "user_id long", ["user_id"], buckets).seed(first)
    stream = spark.readStream.option("lineSep", CSV.separator).option("maxFilesPerTrigger", files_per_batch) \
        .text(source_dir).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                 F.col("_metadata.file_modification_time").alias("time"))

    def import_batch(batch: DataFrame, batch_id: int) -> None:
        ids = BucketState(batch.sparkSession, ids_path, "user_id long", ["user_id"], buckets)
        # file names in the order the source hands them out: oldest first, then by path
        named = F.concat(F.lpad(F.unix_micros("time").cast("string"), 20, "0"), F.lit(" "), "file")
        pieces = batch.select(F.col("value").cast("binary").alias("piece"), named.alias("file"), "block", F.monotonically_increasing_id().alias("mono"))
        raw = user_rows(pieces).select("seq", F.col("c0").alias("user_id"), F.col("c1").alias("name"), F.col("c2").alias("email"))
        touched = ids.touched(raw.select(py_int(F.col("user_id")).alias("user_id")))
        known = ids.read(touched, batch_id)
        counts = Observation(f"import-{batch_id}")
        out = write_batch(observed_audit(import_users(raw, known), counts), outcomes_path, batch_id)
        # the added rows are read from what was written: the import is not computed again
        added = out.filter(F.col("outcome") == "added").select("user_id", "name", "email")
        write_batch(added, store_path, batch_id)
        ids.write(known.unionByName(added.select("user_id")), batch_id)
        if on_metrics is not None:
            on_metrics(batch_id, counts.get)

    writer = stream.writeStream.foreachBatch(import_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
