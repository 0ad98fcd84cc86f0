"""Fetched-page analytics: HTML metadata, fetch outcomes, run summaries,
method comparison, batching and first-N.

Network fetching itself is not rebuilt: the input is a table of already
fetched pages / fetch results, batch or stream.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.markup import PageHead
from tessera.functions.text import PY_WS
from tessera.operators.ordering import DEFAULT_CHUNK, position_in_key

# Method preference on equal elapsed time (first wins) and the
# baseline method of the speed-up.
METHOD_PREFERENCE = ("async", "threaded", "sequential")
BASELINE_METHOD = "sequential"
DEFAULT_BATCH = 5
DEFAULT_FIRST_N = 20

# Fixed value: the fallback description is matched exactly like this.
_OG = (rf"(?i)<meta{PY_WS}+property=[\"']og:description[\"']{PY_WS}+content=[\"']([^\"']+)[\"']")


@pandas_udf(StructType([StructField(n, StringType()) for n in ("title", "description")]))
def _head(pages: pd.Series) -> pd.DataFrame:
    """Title and description element of each page, Arrow-batched."""
    head = PageHead()
    return pd.DataFrame([(None, None) if p is None else head.read(p) for p in pages], columns=["title", "description"])


def page_metadata(pages: DataFrame, html: str = "html") -> DataFrame:
    """title = text of the first ``<title>`` (inner tags dropped, each
    text piece decoded and stripped), null without a tag; description =
    non-empty content of the first ``<meta name="description">``, else the
    raw ``og:description`` content (attribute order property, content;
    case-insensitive; not decoded). Tags, comments and script bodies are what
    Python's HTML parser takes for them (see ``functions.markup``)."""
    out = pages.withColumn("__head", _head(F.col(html)))
    og = F.nullif(F.regexp_extract(F.col(html), _OG, 1), F.lit(""))
    description = F.coalesce(F.nullif(F.col("__head.description"), F.lit("")), og)
    return out.withColumns({"title": F.col("__head.title"), "description": description}).drop("__head")


def fetch_outcomes(fetches: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """P20: (seq, url, method, status_code, fetch_error, elapsed_ms [+ title,
    description]): 200 keeps the metadata and no error; another status gives
    ``HTTP <code>`` and drops metadata; no status gives the fetch error.

    One row out per fetch: metadata with a ``page_id`` belongs to the fetch of
    that ``seq``; metadata without one is taken by url, of a url that repeats
    the smallest (title, description)."""
    f = fetches
    if metadata is not None and "page_id" in metadata.columns:
        m = metadata.select(F.col("page_id").alias("__p"), "title", "description")
        f = f.join(m, f["seq"] == F.col("__p"), "left").drop("__p")
    elif metadata is not None:
        m = metadata.groupBy(F.col("url").alias("__u")).agg(F.min(F.struct("title", "description")).alias("__m"))
        f = f.join(m.select("__u", "__m.title", "__m.description"), f["url"] == F.col("__u"), "left").drop("__u")
    ok = F.col("status_code") == 200
    error = (F.when(F.col("status_code").isNull(), F.coalesce(F.col("fetch_error"), F.lit("Unknown error")))
             .when(~ok, F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))))
    out = f.withColumn("error", error) \
        .withColumn("fetch_time", F.col("elapsed_ms").cast("double") / F.lit(1000.0))
    for c in ("title", "description"):
        if c in out.columns:
            out = out.withColumn(c, F.when(F.coalesce(ok, F.lit(False)), F.col(c)))
    return out.drop("fetch_error")


def fetch_summary(outcomes: DataFrame) -> DataFrame:
    """Per method: total, successful (status 200), failed, elapsed
    seconds (sum of fetch times) and seconds per URL (null for no URLs)."""
    g = outcomes.groupBy("method").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("status_code") == 200, 1)).alias("successful"),
        F.sum("elapsed_ms").alias("__ms"))
    return g.select("method", "total", "successful", (F.col("total") - F.col("successful")).alias("failed"),
                    (F.col("__ms").cast("double") / F.lit(1000.0)).alias("elapsed_sec"),
                    (F.col("__ms").cast("double") / F.lit(1000.0) / F.nullif(F.col("total"), F.lit(0)))
                    .alias("sec_per_url"))


def method_comparison(summary: DataFrame) -> DataFrame:
    """Speed-up of each method against the sequential run and the
    winner (least time; ties prefer async, then threaded, then sequential).
    The summary has one row per method, so the window below is tiny."""
    every = Window.partitionBy()  # one row per method
    base = F.max(F.when(F.col("method") == BASELINE_METHOD, F.col("elapsed_sec"))).over(every)
    s = summary.withColumn("__base", base)
    pref = F.coalesce(F.array_position(F.array(*[F.lit(m) for m in METHOD_PREFERENCE]), F.col("method")),
                      F.lit(len(METHOD_PREFERENCE) + 1))
    rank = F.row_number().over(Window.orderBy(F.col("elapsed_sec").asc(), pref.asc(), F.col("method").asc()))
    return s.select("method", "elapsed_sec",
                    (F.col("__base") / F.nullif(F.col("elapsed_sec"), F.lit(0.0))).alias("speedup"),
                    (rank == 1).alias("is_winner"))


def batch_items(items: DataFrame, seq: str = "seq", size: int = DEFAULT_BATCH,
                chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """Consecutive batches of ``size`` items in input order (the last may
    be short): adds ``batch_no`` (0-based) and ``position_in_batch`` (1-based).
    The global position is a chunked index: no single-partition window."""
    p = position_in_key(items, None, seq, "__pos", chunk_width)
    return p.withColumn("batch_no", F.floor((F.col("__pos") - 1) / F.lit(size)).cast("bigint")) \
        .withColumn("position_in_batch", ((F.col("__pos") - 1) % F.lit(size) + 1).cast("bigint")).drop("__pos")


def first_n(items: DataFrame, seq: str = "seq", n: int = DEFAULT_FIRST_N) -> DataFrame:
    """The first n items in input order (a bounded top-k)."""
    return items.orderBy(F.col(seq).asc()).limit(n)
