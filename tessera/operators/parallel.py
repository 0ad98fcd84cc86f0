"""Parallelism guard for CPU-heavy row-wise operators.

A scan yields one task per file split; a small input (one row group) would
run a regex-heavy projection on a single core. ``spread`` adds a round-robin
exchange only when the input has fewer partitions than the cluster has task
slots — on large inputs the scan is already wide and nothing is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the task slots when it has fewer partitions.

    Call it on a scan (the plans do, for the text and page tables): a scan's
    partition count comes from the file listing, while the count of a plan
    with shuffles is only known after running them (adaptive execution), so
    asking would execute the upstream once more."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - streaming frames have no static partitioning
        return df
    return df.repartition(target) if current < target else df
