"""Registered source / sink queries: table-derived data is written to the
shared staging folder (under ``spark.checkpoint.dir``) and read back through
the file sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import grades as G
from tessera.operators import importer as I
from tessera.operators import library as B
from tessera.operators import text as T
from tessera.operators import web as W
from tessera.operators.parallel import spread
from tessera.plans.importer_q import _V as _IMPORT_V
from tessera.plans.library_q import AS_OF, _DUE
from tessera.plans.sqlfrag import py_int, py_strip
from tessera.plans.tables import view, with_views
from tessera.session import staging_path
from tessera.sources import records as R
from tessera.sources import sinks as K
from tessera.sources import users_csv as U
from tessera.sources.files import dense_row_number


FILES = 8


def _in_files(df):
    """Rows dealt in ``seq`` order over FILES files whose names keep the order."""
    return df.repartitionByRange(FILES, "seq").sortWithinPartitions("seq")


def _users_csv(spark, sf):
    path = staging_path(spark, "users-csv")
    U.write_users_csv(_in_files(view(spark, sf, "users_raw_v")), path)
    return path


def _csv_import(spark, sf):
    rows = U.read_users_csv(spark, _users_csv(spark, sf))
    out = I.import_users(rows, view(spark, sf, "users_existing_v"))
    return dense_row_number(out).select("row_no", "user_id", "name", "email", "outcome", "error_code")


def _csv_lenient(spark, sf):
    out = U.read_users_csv_lenient(spark, _users_csv(spark, sf))
    return dense_row_number(out).select("row_no", "user_id", "name", "email")


def _added(spark, sf):
    return I.added_users(I.import_users(view(spark, sf, "users_raw_v"), view(spark, sf, "users_existing_v")))


def _csv_roundtrip(spark, sf):
    path = staging_path(spark, "users-out")
    U.write_users_csv(_added(spark, sf), path)
    return U.read_users_csv_lenient(spark, path).select("user_id", "name", "email")


def _store_write(spark, sf):
    path = staging_path(spark, "user-store")
    R.write_user_store(_added(spark, sf), path)
    return R.read_user_store(spark, path)


def _store_object(spark, sf):
    path = staging_path(spark, "user-store-object")
    R.export_user_store_objects(_added(spark, sf), path, object_rows=100)
    return R.read_user_store_object(spark, path, layout="lines")


#: Rows that one array file holds at most on average.
ARRAY_ROWS = 500_000


def _large_files(df):
    """Rows dealt in ``seq`` order over as few files as their number needs (the
    readers split each again); no task sorts more than one file's rows."""
    files = df.count() // ARRAY_ROWS + 1
    return (df.coalesce(1) if files == 1 else df.repartitionByRange(files, "seq")).sortWithinPartitions("seq")


def _books_roundtrip(spark, sf, layout="lines", dealt=_in_files):
    path = staging_path(spark, "books-json")
    b = view(spark, sf, "books_v").withColumn("author_nationality", F.lit(None).cast("string")) \
        .withColumn("author_birth_year", F.lit(None).cast("string"))
    R.write_books(dealt(b), path, layout)
    return B.normalise_books(R.read_books(spark, path, layout)) \
        .select("isbn", "title", "category", "book_type", "copies", "error_code")


def _loans_roundtrip(spark, sf, layout="lines", dealt=_in_files):
    path = staging_path(spark, "loans-json")
    R.write_loans(dealt(view(spark, sf, "loans_v")), path, layout)
    return B.normalise_loans(R.read_loans(spark, path, layout), AS_OF) \
        .select("borrower_name", "book_title", "borrow_date", "due_date", "return_date")


def _authors_roundtrip(spark, sf, layout="lines", dealt=_in_files):
    path = staging_path(spark, "authors-json")
    R.write_authors(dealt(view(spark, sf, "authors_v")), path, layout)
    return B.normalise_authors(R.read_authors(spark, path, layout)) \
        .select("name", "nationality", "birth_year", "error_code")


def _grades_csv(spark, sf):
    path = staging_path(spark, "grades-csv")
    g = _in_files(view(spark, sf, "grades_v")).select(
        F.col("student_id").cast("string"), "name", "major", "year", "course_name", F.col("score").alias("grade"))
    g.write.mode("overwrite").option("header", True).csv(path)
    return R.read_grades_csv(spark, path)


def _grade_csv_scan(spark, sf):
    return G.student_dimension(_grades_csv(spark, sf)).select("student_id", "name", "major", "year", "n_courses")


def _grade_report_export(spark, sf):
    path = staging_path(spark, "grade-report")
    K.write_grade_report(_grades_csv(spark, sf), path)
    named = "section string, key string, value string"
    summary = spark.read.schema(named).json(f"{path}/summary")
    majors = spark.read.json(f"{path}/major_grouping").select(
        F.lit("major_grouping").alias("section"), F.concat_ws(" ", "major", F.col("position").cast("string")).alias("key"), F.col("name").alias("value"))
    rolling = spark.read.json(f"{path}/rolling_averages").select(
        F.lit("rolling_averages").alias("section"), F.concat_ws(" ", F.col("student_id").cast("string"), F.col("position").cast("string")).alias("key"),
        F.col("rolling_average").cast("string").alias("value"))
    return summary.unionByName(majors).unionByName(rolling)


def _sentiment_store(spark, sf):
    path = staging_path(spark, "sentiment-table")
    K.append_table(K.sentiment_rows(T.clean_and_score(spread(view(spark, sf, "text_v")))), path)
    return spark.read.parquet(path)


def _sentiment_once(spark, sf):
    """The table written twice under one id, as a job that is run again does."""
    path = staging_path(spark, "sentiment-once")
    rows = K.sentiment_rows(T.clean_and_score(spread(view(spark, sf, "text_v"))))
    for _ in range(2):
        K.append_once(rows, path, "night run")
    return K.read_once(spark, path)


def _page_results(spark, sf):
    path = staging_path(spark, "page-results")
    meta = W.page_metadata(spread(view(spark, sf, "pages_v"))).select("page_id", "url", "title", "description")
    K.write_page_results(W.fetch_outcomes(view(spark, sf, "fetch_v"), meta), path)
    return spark.read.json(path)


QUERIES = {
    "csv_user_parse": _csv_import,
    "csv_user_lenient_prefix": _csv_lenient,
    "csv_user_roundtrip": _csv_roundtrip,
    "keyed_json_write": _store_write,
    "keyed_json_read": _store_object,
    "books_json_roundtrip": _books_roundtrip,
    "loans_json_roundtrip": _loans_roundtrip,
    "authors_json_roundtrip": _authors_roundtrip,
    "books_array_roundtrip": lambda spark, sf: _books_roundtrip(spark, sf, "array", _large_files),
    "loans_array_roundtrip": lambda spark, sf: _loans_roundtrip(spark, sf, "array", _large_files),
    "authors_array_roundtrip": lambda spark, sf: _authors_roundtrip(spark, sf, "array"),
    "grade_csv_scan": _grade_csv_scan,
    "grade_report_export": _grade_report_export,
    "sentiment_store": _sentiment_store,
    "sentiment_store_once": _sentiment_once,
    "page_results_export": _page_results,
}

# The CSV round trip turns NULL text into '' (as Python's csv module does).
_CSV_V = _IMPORT_V.replace("FROM users_raw_v", "FROM (SELECT seq, user_id, coalesce(name, '') AS name, "
                                               "coalesce(email, '') AS email FROM users_raw_v)")

ORACLE = {
    "csv_user_parse": with_views(f""", {_CSV_V},
s AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS sid FROM users_existing_v),
w AS (SELECT v.*, s.sid IS NOT NULL AS stored,
             parse_error IS NULL AND error_code IS NULL AND s.sid IS NULL AS cand
      FROM v LEFT JOIN s ON v.user_id = s.sid),
f AS (SELECT *, cand AND seq = min(CASE WHEN cand THEN seq END) OVER (PARTITION BY user_id) AS first FROM w)
SELECT CAST(row_number() OVER (ORDER BY seq) AS BIGINT) AS row_no, user_id, name, email,
  CASE WHEN parse_error IS NOT NULL THEN 'malformed' WHEN error_code IS NOT NULL THEN 'invalid'
       WHEN stored OR NOT coalesce(first, false) THEN 'duplicate' ELSE 'added' END AS outcome,
  CASE WHEN parse_error IS NOT NULL THEN parse_error WHEN error_code IS NOT NULL THEN error_code
       WHEN stored THEN 'already_stored' WHEN NOT coalesce(first, false) THEN 'repeated_in_batch' END AS error_code
FROM f""", "users_raw_v", "users_existing_v"),
    "csv_user_lenient_prefix": with_views(f"""
, r AS (SELECT seq, {py_int('user_id')} AS user_id, coalesce(name, '') AS name, coalesce(email, '') AS email,
               row_number() OVER (ORDER BY seq) AS row_no FROM users_raw_v)
SELECT CAST(row_no AS BIGINT) AS row_no, user_id, name, email FROM r
WHERE row_no < coalesce((SELECT min(row_no) FROM r WHERE user_id IS NULL), 9223372036854775807)""", "users_raw_v"),
    "books_json_roundtrip": with_views("""
SELECT isbn, title, coalesce(category, 'General') AS category, coalesce(book_type, 'Hardcover') AS book_type,
  coalesce(copies, 1) AS copies,
  CASE WHEN NOT coalesce(regexp_matches(title, '^ *\\p{L}[\\p{L} ]*\\z'), false) THEN 'invalid_title'
  WHEN author_name IS NULL OR trim(author_name) = '' THEN 'missing_author' WHEN isbn IS NULL OR trim(isbn) = ''
  THEN 'missing_isbn'
  WHEN coalesce(category, 'General') NOT IN ('Fiction', 'Non-Fiction', 'Science Fiction', 'Fantasy', 'Mystery',
    'Thriller', 'Romance', 'Biography', 'History', 'Children', 'Poetry', 'Cookbooks', 'Self-Help', 'Technology',
    'Science', 'General') THEN 'invalid_category'
  WHEN coalesce(book_type, 'Hardcover') NOT IN ('Hardcover', 'Paperback', 'Ebook', 'Audiobook')
  THEN 'invalid_book_type' END AS error_code FROM books_v""", "books_v"),
    "loans_json_roundtrip": with_views(f"""
SELECT borrower_name, book_title, borrow_date, {_DUE} AS due_date, return_date FROM loans_v""", "loans_v"),
    "authors_json_roundtrip": with_views(f"""
SELECT name, CASE WHEN {py_strip('nationality')} <> '' THEN nationality END AS nationality,
  CASE WHEN {py_strip('birth_year')} <> '' THEN birth_year END AS birth_year,
  CASE WHEN name IS NULL OR {py_strip('name')} = '' THEN 'missing_name' END AS error_code FROM authors_v""",
                                         "authors_v"),
    "grade_csv_scan": with_views("""
SELECT CAST(student_id AS VARCHAR) AS student_id, arg_min(name, seq) AS name, arg_min(major, seq) AS major,
  CAST(arg_min(year, seq) AS INTEGER) AS year, count(*) AS n_courses FROM grades_v GROUP BY student_id""",
                                 "grades_v"),
}

from tessera.plans.importer_q import _O as _IMPORT_O  # noqa: E402
from tessera.plans.text_q import _C as _TEXT_C  # noqa: E402
from tessera.plans.web_q import _O as _WEB_O  # noqa: E402

_ADDED = with_views(f"{_IMPORT_O} SELECT user_id, name, email FROM o WHERE outcome = 'added'",
                    "users_raw_v", "users_existing_v")
from tessera.plans import grades_q as _GR  # noqa: E402

ORACLE.update({
    "grade_report_export": with_views(f""", {_GR._ORDERED}, {_GR._AVGS}, m AS (SELECT student_id, min(seq) AS first_seq,
  arg_min(name, seq) AS name, arg_min(major, seq) AS major FROM grades_v GROUP BY student_id)
{_GR._REPORT}
UNION ALL SELECT 'major_grouping', concat(major, ' ', CAST(row_number() OVER (PARTITION BY major ORDER BY first_seq) AS VARCHAR)), name FROM m
UNION ALL SELECT 'rolling_averages', concat(CAST(student_id AS VARCHAR), ' ', CAST(row_number() OVER (PARTITION BY student_id ORDER BY seq) AS VARCHAR)),
  CAST({_GR.half_even_mean('sum(score) OVER w', 'count(score) OVER w')} AS VARCHAR) FROM grades_v
  WINDOW w AS (PARTITION BY student_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", "grades_v"),
    "csv_user_roundtrip": _ADDED,
    "keyed_json_write": _ADDED,
    "keyed_json_read": _ADDED,
    **{f"{t}_array_roundtrip": ORACLE[f"{t}_json_roundtrip"] for t in ("books", "loans", "authors")},
    "sentiment_store": with_views(f", {_TEXT_C} SELECT clean_text AS text, sentiment, score FROM r "
                                  "WHERE error_stage IS NULL", "text_v"),
    "sentiment_store_once": with_views(f", {_TEXT_C} SELECT clean_text AS text, sentiment, score FROM r "
                                       "WHERE error_stage IS NULL", "text_v"),
    "page_results_export": with_views(f"""{_WEB_O}
SELECT url, title, description, CAST(status_code AS BIGINT) AS status_code, round(fetch_time, 3) AS fetch_time, error
FROM o""", "pages_v", "fetch_v"),
})
