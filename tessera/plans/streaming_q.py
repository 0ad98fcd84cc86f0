"""Registered streaming queries: table-derived files are replayed as a file
stream with ``trigger(availableNow=True)`` and the sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import py_int
from tessera.operators import library as B
from tessera.plans.library_q import AS_OF
from tessera.plans.tables import view, with_views
from tessera.session import staging_path
from tessera.plans.replay import write_stream_chunks
from tessera.streaming.dedup import start_deduplicated
from tessera.streaming.importer import start_import_stream
from tessera.streaming.stateful import start_ledger_stream, start_rental_stream
from tessera.streaming.text import start_text_stream

FILES_PER_CHUNK = 2
#: Buckets of the streams' states.
BUCKETS = 16


def _stream_import(spark, sf):
    src = staging_path(spark, "stream-users-src")
    # spellings of one id (' +7 ', '7') must stay in one file, in order
    raw = view(spark, sf, "users_raw_v").withColumn("__id", py_int(F.col("user_id")))
    write_stream_chunks(raw, src, "__id", files_per_chunk=FILES_PER_CHUNK, fmt="csv",
                        options={"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
                                 "ignoreTrailingWhiteSpace": False},
                        columns=["user_id", "name", "email"])
    src_csv = src
    store, outcomes, ckpt = (staging_path(spark, n) for n in ("stream-store", "stream-outcomes", "stream-ckpt"))
    q = start_import_stream(spark, src_csv, store, outcomes, ckpt, view(spark, sf, "users_existing_v"),
                            files_per_batch=FILES_PER_CHUNK, buckets=BUCKETS)
    q.awaitTermination()
    # error_code tells an in-batch repeat from an id stored by an earlier
    # micro-batch, which depends on batch boundaries; the outcome does not
    return spark.read.parquet(outcomes).select("user_id", "name", "email", "outcome")


def _stream_text(spark, sf):
    src = staging_path(spark, "stream-text-src")
    write_stream_chunks(view(spark, sf, "text_v").withColumnRenamed("doc_id", "seq"), src, "seq",
                        files_per_chunk=FILES_PER_CHUNK)
    sink, quarantine, ckpt = (staging_path(spark, n) for n in ("stream-text", "stream-quarantine", "stream-ckpt"))
    q = start_text_stream(spark, src, "seq long, lang string, text string", sink, quarantine, ckpt, key="seq",
                          files_per_batch=FILES_PER_CHUNK)
    q.awaitTermination()
    return spark.read.parquet(sink).select(F.col("seq").alias("doc_id"), "text", "sentiment", "score")


def _stream_rental(spark, sf):
    src = staging_path(spark, "stream-rental-src")
    ev = view(spark, sf, "vehicle_events_v").select("seq", "vehicle_id", "days", "kind")
    write_stream_chunks(ev, src, "vehicle_id", files_per_chunk=FILES_PER_CHUNK)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", FILES_PER_CHUNK).parquet(src)
    sink, state, ckpt = (staging_path(spark, n) for n in ("stream-rental", "stream-state", "stream-ckpt"))
    start_rental_stream(stream, view(spark, sf, "vehicles_v"), sink, state, ckpt, BUCKETS).awaitTermination()
    return spark.read.parquet(sink).drop("batch_id")


def _stream_ledger(spark, sf):
    src = staging_path(spark, "stream-ledger-src")
    books = view(spark, sf, "books_v").join(
        view(spark, sf, "books_v").groupBy("isbn").agg(F.min("seq").alias("__s")), "isbn")
    b = view(spark, sf, "borrow_requests_v").select((F.col("seq") * 2).alias("seq"), F.lit("borrow").alias("kind"),
                                                    "borrower_name", "isbn")
    r = view(spark, sf, "return_requests_v").select((F.col("seq") * 2 + 1).alias("seq"),
                                                    F.lit("return").alias("kind"), "borrower_name", "isbn")
    ev = b.unionByName(r)
    # all events of a title must stay in order: replay partitioned by the title of the first book per ISBN
    fb = books.filter(F.col("seq") == F.col("__s")).select(F.col("isbn").alias("__i"), F.col("title").alias("__title"))
    keyed = ev.join(fb, ev["isbn"] == F.col("__i"), "left").withColumn("__title", F.coalesce("__title", F.lit("")))
    write_stream_chunks(keyed.drop("__i"), src, "__title", files_per_chunk=FILES_PER_CHUNK)
    stream = spark.readStream.schema(keyed.drop("__i").schema).option("maxFilesPerTrigger", FILES_PER_CHUNK) \
        .parquet(src).drop("__title")
    norm_books = B.normalise_books(view(spark, sf, "books_v"))
    loans = B.normalise_loans(view(spark, sf, "loans_v"), AS_OF)
    sink, state, ckpt = (staging_path(spark, n) for n in ("stream-ledger", "stream-state", "stream-ckpt"))
    start_ledger_stream(stream, norm_books, loans, sink, state, ckpt, BUCKETS).awaitTermination()
    return spark.read.parquet(sink).drop("batch_id")


def _stream_distinct(spark, sf):
    """Which vehicles had which kind of event, each told once; the delay is
    longer than the log."""
    src = staging_path(spark, "stream-distinct-src")
    ev = view(spark, sf, "vehicle_events_v").select("seq", F.col("ts").cast("timestamp").alias("ts"), "vehicle_id", "kind")
    write_stream_chunks(ev, src, "vehicle_id", files_per_chunk=FILES_PER_CHUNK)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", FILES_PER_CHUNK).parquet(src)
    sink, ckpt = staging_path(spark, "stream-distinct"), staging_path(spark, "stream-ckpt")
    start_deduplicated(stream, ["vehicle_id", "kind"], "ts", "36500 days", sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select("vehicle_id", "kind")


QUERIES = {
    "stream_distinct_events": _stream_distinct,
    "stream_import": _stream_import,
    "stream_text_sentiment": _stream_text,
    "stream_rental_outcomes": _stream_rental,
    "stream_loan_ledger": _stream_ledger,
}

from tessera.plans.sources_q import ORACLE as _SRC  # noqa: E402
from tessera.plans.text_q import _C as _TEXT_C  # noqa: E402
from tessera.plans.payroll_q import ORACLE as _PAY  # noqa: E402
from tessera.plans.library_q import ORACLE as _LIB  # noqa: E402

ORACLE = {
    "stream_distinct_events": with_views("SELECT DISTINCT vehicle_id, kind FROM vehicle_events_v", "vehicle_events_v"),
    "stream_import": "SELECT user_id, name, email, outcome FROM (" + _SRC["csv_user_parse"].replace(
        "SELECT CAST(row_number() OVER (ORDER BY seq) AS BIGINT) AS row_no, user_id", "SELECT user_id") + ")",
    "stream_text_sentiment": with_views(f", {_TEXT_C} SELECT doc_id, clean_text AS text, sentiment, score FROM r "
                                        "WHERE error_stage IS NULL", "text_v"),
    "stream_rental_outcomes": _PAY["rental_outcomes"],
    "stream_loan_ledger": "SELECT seq, book_title, kind, borrower_name, outcome FROM ("
    + _LIB["loan_ledger"] + ")",
}
