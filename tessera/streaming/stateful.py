"""State machines over event streams.

Every micro-batch is solved by the batch operator, started from the state that
earlier batches left: the last event of each vehicle, the active loans of each
title and borrower. A key that fills half of a batch is therefore cut into
chunks like any hot key (see ``operators.ordering`` and ``operators.ledger``):
no handler holds a key's events. State is kept by key bucket (``bucket_state``)
and only the buckets of a batch's keys are read and written.

Events of a key must come in ``seq`` order over the batches; inside a batch
they may lie in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.ledger import COUNTERS, after_events, counters, ledger_outcomes
from tessera.operators.library import first_titles
from tessera.operators.ordering import latest_per_key
from tessera.operators.rental import rental_outcomes
from tessera.session import staging_path
from tessera.streaming.bucket_state import BucketState, write_batch


def _started(stream: DataFrame, handle, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def _staged(batch: DataFrame, label: str) -> DataFrame:
    """A batch's events, or what all batches use, read from the source once."""
    path = staging_path(batch.sparkSession, label)
    batch.write.parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def start_rental_stream(events: DataFrame, vehicles: DataFrame, sink: str, state: str, checkpoint: str,
                        buckets: int = 256, available_now: bool = True) -> StreamingQuery:
    """Streaming twin of ``operators.rental.rental_outcomes``: (seq,
    vehicle_id, kind, outcome) by ``batch_id`` under ``sink``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        last = BucketState(batch.sparkSession, state, "vehicle_id long, kind string", ["vehicle_id"], buckets)
        ev = _staged(batch.select("seq", "vehicle_id", "kind"), "rental-batch")
        touched = last.touched(ev)
        before = last.read(touched, batch_id)
        done = write_batch(rental_outcomes(ev, vehicles, before=before).select("seq", "vehicle_id", "kind", "outcome"), sink, batch_id)
        now = latest_per_key(done.filter("outcome <> 'not_found'"), "vehicle_id", "seq", ["kind"]).select("vehicle_id", "kind")
        last.write(now.unionByName(before.join(now, "vehicle_id", "left_anti")), batch_id)

    return _started(events, handle, checkpoint, available_now)


def start_ledger_stream(events: DataFrame, books: DataFrame, loans: DataFrame, sink: str, state: str, checkpoint: str,
                        buckets: int = 256, available_now: bool = True, **chunks: int) -> StreamingQuery:
    """Streaming twin of ``operators.library.loan_ledger``: (seq, book_title,
    kind, borrower_name, outcome) by ``batch_id`` under ``sink``. ``loans``
    are those before the first batch."""
    def held(spark) -> BucketState:
        return BucketState(spark, state, COUNTERS, ["book_title"], buckets)

    held(events.sparkSession).seed(counters(loans))
    titles = _staged(first_titles(books), "ledger-titles")

    # the joins of a batch are merged: broadcasts would go through the driver batch after batch
    def handle(batch: DataFrame, batch_id: int) -> None:
        ev = batch.join(titles.hint("merge"), batch["isbn"] == F.col("__isbn"), "left").drop("__isbn")
        ev = _staged(ev.select("seq", "book_title", "kind", "borrower_name", "copies"), "ledger-batch")
        found = ev.filter("book_title IS NOT NULL")
        counts = held(batch.sparkSession)
        touched = counts.touched(found)
        before = counts.read(touched, batch_id)
        out = found.join(ledger_outcomes(found, before, **chunks).hint("merge"), "seq") \
            .unionByName(ev.filter("book_title IS NULL").withColumn("outcome", F.lit("book_not_found")))
        done = write_batch(out.select("seq", "book_title", "kind", "borrower_name", "outcome"), sink, batch_id)
        counts.write(after_events(before, done.filter("book_title IS NOT NULL")), batch_id)

    return _started(events, handle, checkpoint, available_now)
