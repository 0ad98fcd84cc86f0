"""Keyed user store (S4/S5), grade CSV (S6) and library JSON.

The keyed store is kept as JSON lines — one ``{"user_id", "name", "email"}``
object per user, written in parallel. The single-object layout
``{"<id>": {"name", "email"}, ...}`` is read from whole files, or written and
read as one such object a line, each holding a bounded share of the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.functions.text import py_int, py_strip
from tessera.session import staging_path
from tessera.sources.files import list_files, order_columns, with_file_order
from tessera.sources.ranges import CSV, JSON_MEMBERS, pieces, records

STORE_SCHEMA = "user_id long, name string, email string"
STORE_OBJECT = "map<string, struct<name: string, email: string>>"
#: Users that one exported object holds on average.
OBJECT_ROWS = 10_000


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = staging_path(df.sparkSession, f"store-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_user_store(spark: SparkSession, path: str) -> DataFrame:
    """S4 (JSON lines layout): missing path -> empty store."""
    try:
        return spark.read.schema(STORE_SCHEMA).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], STORE_SCHEMA)
        raise


def read_user_store_object(spark: SparkSession, path: str, layout: str = "file") -> DataFrame:
    """S4 (JSON object layout): each file is one object (``layout='file'``) or
    each line is (``'lines'``, as exported). Missing, blank or invalid JSON
    gives an empty store, never an error. Keys are ids as text. A file's
    members are read by as many tasks as it has splits."""
    try:
        if layout == "lines":
            parsed = spark.read.text(path).select(F.from_json(F.col("value"), STORE_OBJECT).alias("m"))
        else:
            parsed = _object_members(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], STORE_SCHEMA)
        raise
    return parsed.select(F.explode("m").alias("k", "v")).select(
        F.col("k").try_cast("long").alias("user_id"), F.col("v.name").alias("name"), F.col("v.email").alias("email"))


def _members(spark: SparkSession, path, opening: str, closing: str) -> DataFrame:
    """(text, seq, file, closed, bad) of the members of one array or object a
    file: ``text`` as between its commas, ``bad`` where the file goes wrong.
    What comes after the last member is not ``closed``."""
    rows = records(pieces(spark, path, JSON_MEMBERS), JSON_MEMBERS)
    text = F.col("fields")[0]
    by_place = lambda use, first, later: F.when(F.col("first"), use(first)).otherwise(use(later))
    lead = (rf"^\uFEFF?\s*{opening}\s*", r"^\s*,\s*")
    rest = (rf"^\uFEFF?\s*({opening}\s*{closing}\s*)?$", rf"^\s*{closing}\s*$")
    bad = ~F.when(F.col("closed"), by_place(text.rlike, *lead)).otherwise(by_place(text.rlike, *rest))
    whole = F.when(F.col("closed"), F.concat(by_place(lambda p: F.regexp_replace(text, p, ""), *lead), F.lit("}")))
    return rows.select(whole.alias("text"), "seq", "file", "closed", bad.alias("bad"))


def _object_members(spark: SparkSession, path) -> DataFrame:
    """(m): one-member maps of the objects in valid files."""
    one = F.from_json(F.concat(F.lit("{"), F.col("text"), F.lit("}")), STORE_OBJECT)
    # the brace that closes the object ends a piece, so it is not in the text
    rows = _staged(_members(spark, path, r"\{", r"\}?").withColumn("m", one), "members")
    ended = rows.filter(~F.col("closed")).select("file")
    wrong = rows.filter(F.col("bad") | (F.col("closed") & F.col("m").isNull())).select("file").distinct()
    return rows.filter("closed").join(ended, "file", "left_semi").join(wrong, "file", "left_anti")


def write_user_store(users: DataFrame, path: str, mode: str = "append") -> None:
    """One write per job (append new users, or overwrite)."""
    users.select(F.col("user_id").cast("long"), "name", "email").write.mode(mode).json(path)


def export_user_store_objects(users: DataFrame, path: str, object_rows: int = OBJECT_ROWS) -> None:
    """The object layout at any size: ids (unique, as in the store) are dealt
    by hash over as many objects as the store needs, one object a line."""
    objects = users.count() // object_rows + 1
    bucket = F.pmod(F.xxhash64(F.col("user_id").cast("long")), F.lit(objects))
    obj = users.groupBy(bucket.alias("__bucket")).agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("user_id").cast("string"), F.struct("name", "email")))).alias("m"))
    obj.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)


GRADE_TEXT = "student_id string, name string, major string, year string, course_name string, grade string"


def _parsed_or_fail(parsed: Column, raw: Column, what: str) -> Column:
    """``parsed``, or fail the job (lazily, inside the scan) naming the value."""
    msg = F.concat(F.lit(f"invalid {what}: "), F.coalesce(raw, F.lit("<missing>")))
    return F.when(parsed.isNull(), F.raise_error(msg)).otherwise(parsed)


def read_grades_csv(spark: SparkSession, path) -> DataFrame:
    """The grade CSV (header, six columns) as the flat fact table of
    ``operators.grades`` (``score`` = grade, ``seq`` = file order). Year and
    grade follow Python's ``int()`` / ``float()`` text rules (surrounding
    whitespace allowed); a value that does not parse fails the job, like the
    source. (The source parses a student's year on its first row only; here a
    bad year on any row fails.)"""
    rows = records(pieces(spark, path, CSV), CSV).filter(~F.col("first") & (F.size("fields") > 0))
    names = [c.split()[0] for c in GRADE_TEXT.split(", ")]
    field = lambda k: F.get("fields", F.lit(k))
    df = rows.select("seq", *[F.when(field(k) != "", field(k)).alias(n) for k, n in enumerate(names)])
    year = _parsed_or_fail(py_int(F.col("year")), F.col("year"), "year")
    score = _parsed_or_fail(py_strip(F.col("grade")).try_cast("double"), F.col("grade"), "grade")
    return df.select("student_id", "name", "major", year.cast("int").alias("year"), "course_name",
                     score.alias("score"), "seq")


BOOK_SCHEMA = ("title string, isbn string, category string, book_type string, year string, copies long, "
               "author struct<name: string, nationality: string, birth_year: string>")
LOAN_SCHEMA = "borrower_name string, book_title string, borrow_date string, return_date string, due_date string"
AUTHOR_SCHEMA = "name string, nationality string, birth_year string"


def _read_json_records(spark: SparkSession, path, schema: str, layout: str) -> DataFrame:
    """JSON array files (``layout='array'``, whole file = one array, read by as
    many tasks as it has splits) or JSON lines (``'lines'``); a missing path is
    an empty list, a member that is no such object a row of nulls."""
    try:
        list_files(spark, path)
    except FileNotFoundError:
        return spark.createDataFrame([], schema + ", seq long")
    if layout == "array":
        rows = _members(spark, path, r"\[", r"\]").filter("closed OR bad").select(F.from_json(F.when(~F.col("bad"), F.col("text")), schema).alias("r"), "seq")
        return rows.select("r.*", "seq")
    return with_file_order(spark.read.schema(schema).json(path).select("*", *order_columns()))


def read_books(spark: SparkSession, path, layout: str = "array") -> DataFrame:
    """Books flattened to the operator shape (author_name plus the nested
    author details); defaults and checks are in ``library.normalise_books``."""
    b = _read_json_records(spark, path, BOOK_SCHEMA, layout)
    return b.select("seq", "isbn", "title", "category", "book_type", "copies", "year",
                    F.col("author.name").alias("author_name"),
                    F.col("author.nationality").alias("author_nationality"),
                    F.col("author.birth_year").alias("author_birth_year"))


def _write_json_records(rows: DataFrame, path: str, layout: str) -> None:
    """JSON lines, or one array a file with a member a line."""
    if layout == "lines":
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)
        return

    def as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for b in batches:
            if b.num_rows:
                leads = [lead] + [","] * (b.num_rows - 1)
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(pa.array(leads), b.column(0).cast(pa.string()), "")], ["value"])
                lead = ","
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"])], ["value"])

    text = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    text.mapInArrow(as_array, "value string").write.mode("overwrite").text(path)


def write_books(books: DataFrame, path: str, layout: str = "lines") -> None:
    rows = books.select("title", "isbn", "category", "book_type", "year", "copies",
                 F.struct(F.col("author_name").alias("name"),
                          F.col("author_nationality").alias("nationality"),
                          F.col("author_birth_year").alias("birth_year")).alias("author"))
    _write_json_records(rows, path, layout)


def read_loans(spark: SparkSession, path, layout: str = "array") -> DataFrame:
    """Loans with text dates; ``library.normalise_loans`` applies the defaults."""
    return _read_json_records(spark, path, LOAN_SCHEMA, layout)


def write_loans(loans: DataFrame, path: str, layout: str = "lines") -> None:
    rows = loans.select("borrower_name", "book_title", *[F.col(c).cast("string").alias(c)
                                                         for c in ("borrow_date", "return_date", "due_date")])
    _write_json_records(rows, path, layout)


def read_authors(spark: SparkSession, path, layout: str = "array") -> DataFrame:
    """S10."""
    return _read_json_records(spark, path, AUTHOR_SCHEMA, layout)


def write_authors(authors: DataFrame, path: str, layout: str = "lines") -> None:
    _write_json_records(authors.select("name", "nationality", "birth_year"), path, layout)
