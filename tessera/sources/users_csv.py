"""User CSV files: strict scan (S1), lenient prefix load (S2), sink (S3).

Strict rules: every file's header must be exactly ``user_id,name,email``
(checked per file, in parallel, before the scan); a 0-byte file is empty;
a row with fewer than three columns or an id that Python's ``int()``
rejects is malformed; longer rows are accepted (first three columns used).
A file is read by as many tasks as it has splits, quoted line ends or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import py_int
from tessera.session import staging_path
from tessera.sources.files import csv_headers, list_files
from tessera.sources.ranges import CSV, records
from tessera.sources.ranges import pieces as csv_pieces

HEADER = ["user_id", "name", "email"]


class FileFormatError(ValueError):
    """A file does not have the expected header."""


def user_rows(pieces: DataFrame) -> DataFrame:
    """(seq, c0, c1, c2) of CSV pieces (see ``ranges``) without header records
    and blank lines. Fields are as Python's csv module gives them; missing
    trailing ones are NULL."""
    rows = records(pieces, CSV).filter(~F.col("first") & (F.size("fields") > 0))
    return rows.select("seq", *[F.get("fields", F.lit(k)).alias(f"c{k}") for k in range(3)])


def _scan(spark: SparkSession, path) -> DataFrame:
    """The rows, written once: imports use them several times, and the files
    are parsed in Python."""
    rows, parsed = user_rows(csv_pieces(spark, path, CSV)), staging_path(spark, "users-parsed")
    rows.write.parquet(parsed)
    return spark.read.schema(rows.schema).parquet(parsed)


def check_headers(spark: SparkSession, files: list[str], expected: list[str] = HEADER) -> None:
    """Raise ``FileFormatError`` if any non-empty file has another header."""
    heads = csv_headers(spark, files)
    bad = heads.filter(F.col("header").isNotNull() & (F.col("header") != F.array(*[F.lit(h) for h in expected])))
    sample = bad.limit(5).collect()  # at most five rows reach the driver
    if sample:
        raise FileFormatError("Invalid CSV headers in " + ", ".join(r["path"] for r in sample))


def read_users_csv(spark: SparkSession, path, strict_header: bool = True) -> DataFrame:
    """Raw user rows (seq, user_id, name, email as text; email NULL for a
    short row). Feed to ``operators.importer.import_users``."""
    if strict_header:
        check_headers(spark, list_files(spark, path))
    raw = _scan(spark, path)
    return raw.select("seq", F.col("c0").alias("user_id"), F.col("c1").alias("name"), F.col("c2").alias("email"))


def read_users_csv_lenient(spark: SparkSession, path) -> DataFrame:
    """Header skipped unchecked; short rows silently dropped; values not
    stripped; the first row whose id does not parse stops the load, so only
    the rows before it are kept. A missing path gives an empty result."""
    try:
        list_files(spark, path)
    except FileNotFoundError:
        return spark.createDataFrame([], "seq long, user_id long, name string, email string")
    raw = _scan(spark, path).filter(F.col("c2").isNotNull())
    parsed = raw.select("seq", py_int(F.col("c0")).alias("user_id"), F.col("c1").alias("name"),
                        F.col("c2").alias("email"))
    stop = parsed.filter(F.col("user_id").isNull()).agg(F.min("seq").alias("__stop"))
    # the one row of a global aggregate beside every row: one row by definition, so it is broadcast
    out = parsed.crossJoin(F.broadcast(stop))
    return out.filter(F.col("__stop").isNull() | (F.col("seq") < F.col("__stop"))).drop("__stop")


def write_users_csv(users: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: header plus the three columns; one file per partition. Quotes
    inside fields are doubled."""
    users.select(F.col("user_id").cast("string"), "name", "email") \
        .write.mode(mode).option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
