"""Sinks: grade report (S7), relational append (S11), page results."""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import grades as G

RESULT_FIELDS = ("url", "title", "description", "status_code", "fetch_time", "error")


def write_grade_report(grades: DataFrame, path: str, top_n: int = G.DEFAULT_TOP_N,
                       window_size: int = G.DEFAULT_WINDOW) -> None:
    """The report as a folder: ``summary`` (the bounded sections as
    (section, key, value) lines) and the unbounded sections as partitioned JSON lines
    (``major_grouping``, ``rolling_averages``) — nothing is gathered into one
    task. Overwrites."""
    G.report_rows(grades, top_n).write.mode("overwrite").json(f"{path}/summary")
    G.major_grouping(grades).write.mode("overwrite").json(f"{path}/major_grouping")
    G.rolling_averages(grades, window_size).write.mode("overwrite").json(f"{path}/rolling_averages")


def append_table(df: DataFrame, path_or_table: str, fmt: str = "parquet") -> None:
    """Append rows to a table; a path is written as ``fmt`` files, a
    name as a catalog table. Use from ``foreachBatch`` for streams."""
    if "/" in path_or_table or ":" in path_or_table:
        df.write.mode("append").format(fmt).save(path_or_table)
    else:
        df.write.mode("append").saveAsTable(path_or_table)


_LOG = "write_id string, part string"


def append_once(df: DataFrame, path: str, write_id: str) -> bool:
    """S11, safe to repeat: append the rows as the write ``write_id``, unless
    that write is in the log already; returns whether it was not.

    Rows go to a folder of their own; the write counts from when its log file,
    named by the id, is created, which storage does once. A job that fails or
    is run again in between leaves a folder that no reader looks at."""
    spark, root = df.sparkSession, path.rstrip("/")
    name = f"{root}/log/{hashlib.sha256(write_id.encode()).hexdigest()}.json"
    entry = spark._jvm.org.apache.hadoop.fs.Path(name)
    fs = entry.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(entry):
        return False
    part = uuid.uuid4().hex
    df.write.parquet(f"{root}/rows/part={part}")
    try:
        out = fs.create(entry, False)
    except Py4JJavaError:
        if fs.exists(entry):  # the same write, ended elsewhere meanwhile
            return False
        raise
    out.write(bytearray(json.dumps({"write_id": write_id, "part": part}).encode()))
    out.close()
    return True


def read_once(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all writes in the log of ``append_once``."""
    root = path.rstrip("/")
    log = spark.read.schema(_LOG).json(f"{root}/log")
    rows = spark.read.option("basePath", f"{root}/rows").option("mergeSchema", True).parquet(f"{root}/rows")
    return rows.join(log.select("part"), "part", "left_semi").drop("part")


def sentiment_rows(scored: DataFrame) -> DataFrame:
    """The stored shape of an analysed text: (text, sentiment, score)."""
    return scored.filter(F.col("error_stage").isNull()).select(
        F.col("clean_text").alias("text"), "sentiment", F.col("score").cast("int"))


def write_page_results(outcomes: DataFrame, path: str) -> None:
    """Six fields per page, fetch_time rounded to 3 decimals, nulls kept."""
    outcomes.select("url", "title", "description", "status_code",
                    F.round(F.col("fetch_time"), 3).alias("fetch_time"), "error") \
        .write.mode("overwrite").option("ignoreNullFields", False).json(path)
