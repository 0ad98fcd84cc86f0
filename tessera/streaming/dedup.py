"""De-duplication of an event stream within a watermark.

A key's first event is kept and its repeats are dropped while the state knows
the key; the state forgets a key once the watermark has passed its event by
the delay, so it follows the events of a delay and not all that ever came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def deduplicated(events: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first of the events with equal ``keys`` whose ``time`` lies within
    ``delay`` of each other; null keys are keys like others."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def start_deduplicated(events: DataFrame, keys: list[str], time: str, delay: str, sink: str, checkpoint: str,
                       available_now: bool = True) -> StreamingQuery:
    """Append ``deduplicated`` events to the Parquet folder ``sink``."""
    writer = deduplicated(events, keys, time, delay).writeStream.format("parquet").option("path", sink) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
