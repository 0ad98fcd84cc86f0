"""Driver tables and the derived views that present them in operator shape.

Each view is portable SQL that runs unchanged on Spark and DuckDB. The Spark
side builds the view with ``spark.sql`` over the registered parquet tables and
then applies the library operators (DataFrame API); the oracle side inlines
the very same view text as a CTE in front of a hand-written SQL equivalent.
Views read whole tables: modular arithmetic only derives values (which rows
get an unknown id, a blank name, a lexicon word...), it never drops rows, and
keys are derived so that their number grows with the table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Offset that moves an id outside every driver key range (an unknown entity).
UNKNOWN = 1_000_000_000

VIEWS: dict[str, str] = {
    # Grade facts: student = customer, one course grade per order.
    "grades_v": """
SELECT o.o_custkey AS student_id, c.c_name AS name, c.c_mktsegment AS major,
       CAST(c.c_nationkey % 4 + 1 AS BIGINT) AS year, o.o_orderpriority AS course_name,
       CAST(floor(o.o_totalprice / 5000) AS DOUBLE) AS score, o.o_orderkey AS seq
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    # Raw user rows as text, before parsing.
    "users_raw_v": """
SELECT c_custkey AS seq,
       CASE WHEN c_custkey % 23 = 22 THEN 'abc' WHEN c_custkey % 19 = 0 THEN '0'
            WHEN c_custkey % 31 = 0 THEN concat(' +', CAST(c_custkey - c_custkey % 3 AS STRING), ' ')
            ELSE CAST(c_custkey - c_custkey % 3 AS STRING) END AS user_id,
       CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_name END AS name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'invalid-email'
            ELSE concat('user', CAST(c_custkey AS STRING), '@example.com') END AS email
FROM customer""",
    # Ids already in the keyed user store (derived from the whole supplier table).
    "users_existing_v": """
SELECT s_suppkey * 6 AS user_id, s_name AS name,
       concat('s', CAST(s_suppkey AS STRING), '@example.com') AS email
FROM supplier""",
    # Free text with lexicon words appended, plus null / blank / punctuation-only rows.
    "text_v": """
SELECT doc_id, lang,
       CASE WHEN doc_id % 101 = 0 THEN NULL WHEN doc_id % 103 = 0 THEN '   '
            WHEN doc_id % 107 = 0 THEN '?!'
            ELSE concat(text, CASE doc_id % 7 WHEN 0 THEN ' Good!' WHEN 1 THEN ' terrible.'
                                             WHEN 2 THEN ' excellent, bad' ELSE '' END) END AS text
FROM documents""",
    # Pages with description / og:description tags injected.
    "pages_v": """
SELECT page_id, url,
       concat(CASE WHEN page_id % 11 = 10 THEN replace(html, '</title>', '') ELSE
       replace(html, '<meta charset="utf-8">', concat('<meta charset="utf-8">',
         CASE page_id % 11
           WHEN 0 THEN concat('<meta name="description" content="d', CAST(page_id AS STRING), '">')
           WHEN 1 THEN concat('<META property="og:description" content="og', CAST(page_id AS STRING), '">')
           WHEN 2 THEN '<meta name="description" content=""><meta property="og:description" content="fb">'
           WHEN 3 THEN '<meta name="description" content="a > b">'
           WHEN 4 THEN concat('<meta data-x="p>q" name="description" content="x', CAST(page_id AS STRING), '">')
           WHEN 5 THEN '<meta name=description content=bare>'
           WHEN 6 THEN '<meta name="x" content="<title>not this</title>">'
           WHEN 7 THEN '<!-- <title>nor this</title><meta name="description" content="no"> -->'
           WHEN 8 THEN '<script>var s = "<title>never</title>";</script><meta content=''&lt;one&gt; &amp; two'' name=''description''/>'
           ELSE '' END)) END,
       CASE WHEN page_id % 5 = 0 THEN '<p>end <!-- <title>unclosed' ELSE '' END) AS html
FROM pages""",
    # Fetch outcomes per page and scrape method.
    # A url is fetched several times.
    "fetch_v": """
SELECT page_id AS seq, concat('https://example.com/p', CAST(floor(page_id / 4) AS BIGINT)) AS url,
       CASE page_id % 3 WHEN 0 THEN 'sequential' WHEN 1 THEN 'threaded' ELSE 'async' END AS method,
       CASE page_id % 10 WHEN 7 THEN 404 WHEN 8 THEN 503 WHEN 9 THEN NULL ELSE 200 END AS status_code,
       CASE WHEN page_id % 10 = 9 THEN 'Timeout' END AS fetch_error,
       CAST(page_id * 37 % 400 AS BIGINT) AS elapsed_ms
FROM pages""",
    # Employees of three kinds, base pay from negative to 1.5 M.
    "employees_v": """
SELECT c_custkey AS seq, c_custkey AS employee_id,
       CASE WHEN c_custkey % 37 = 0 THEN '  ' ELSE c_name END AS name,
       c_mktsegment AS department,
       CASE c_custkey % 3 WHEN 0 THEN 'fulltime' WHEN 1 THEN 'contract' ELSE 'intern' END AS emp_type,
       CASE WHEN c_custkey % 3 <> 1 THEN CAST(floor(c_acctbal * 150) AS DOUBLE) END AS base_pay,
       CASE WHEN c_custkey % 3 = 1 THEN CAST(c_custkey % 200 AS DOUBLE) END AS hours,
       CASE WHEN c_custkey % 3 = 1 THEN CAST(5000 + c_custkey % 50 AS DOUBLE) + 0.0625 * (c_custkey % 7) END AS rate,
       CAST(CASE WHEN c_custkey % 29 = 0 THEN -1 ELSE c_custkey % 7 * 1000 END AS DOUBLE) AS bonus
FROM customer""",
    # The same employees as typed in: numbers as text, some blank, padded or no numbers.
    "employees_text_v": """
SELECT c_custkey AS seq, c_custkey AS employee_id, c_name AS name, c_mktsegment AS department,
       CASE c_custkey % 3 WHEN 0 THEN ' FullTime ' WHEN 1 THEN 'contract' ELSE 'Intern' END AS emp_type,
       CASE WHEN c_custkey % 41 = 0 THEN 'abc' WHEN c_custkey % 43 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN concat(' ', CAST(c_custkey * 10 AS STRING), '.5 ')
            ELSE CAST(c_custkey * 10 AS STRING) END AS base_pay,
       CASE WHEN c_custkey % 47 = 0 THEN '1.2.3' WHEN c_custkey % 53 = 0 THEN '1e2' ELSE CAST(c_custkey % 200 AS STRING) END AS hours,
       CASE WHEN c_custkey % 59 = 0 THEN '+7_0' ELSE CAST(c_custkey % 90 AS STRING) END AS rate,
       CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 61 = 0 THEN 'x'
            WHEN c_custkey % 67 = 0 THEN '-3' ELSE CAST(c_custkey % 9 AS STRING) END AS bonus
FROM customer""",
    # Salary / bonus change log; every 11th change names an unknown employee.
    "pay_changes_v": """
SELECT event_id AS seq,
       CASE WHEN event_id % 11 = 0 THEN user_id + 1000000000 ELSE user_id END AS employee_id,
       CASE WHEN event_type IN ('click', 'view') THEN 'salary' ELSE 'bonus' END AS field,
       CAST(floor((value - 20) * 5000) AS DOUBLE) AS new_value
FROM events""",
    # Removal requests for employees; every 13th names an unknown id.
    "employee_removals_v": """
SELECT event_id AS seq,
       CASE WHEN event_id % 13 = 0 THEN user_id + 1000000000 ELSE user_id * 3 END AS employee_id
FROM events""",
    # Rental fleet (every customer is a vehicle) and its rent / return log.
    "vehicles_v": """
SELECT c_custkey AS seq, c_custkey AS vehicle_id, CAST(20 + c_custkey % 80 AS DOUBLE) AS base_price,
       CASE c_custkey % 3 WHEN 0 THEN 'car' WHEN 1 THEN 'bike' ELSE 'truck' END AS vehicle_type
FROM customer""",
    "vehicle_events_v": """
SELECT event_id AS seq, ts,
       CASE WHEN event_id % 13 = 0 THEN user_id + 1000000000 ELSE user_id END AS vehicle_id,
       CAST(event_id % 14 + 1 AS BIGINT) AS days,
       CASE WHEN event_type IN ('click', 'purchase') THEN 'rent' ELSE 'return' END AS kind
FROM events""",
    # Library: every part is a book, every order a loan of the part with key o_custkey.
    "books_v": """
SELECT p_partkey AS seq,
       CAST(CASE WHEN p_partkey % 61 = 0 THEN p_partkey - 1 ELSE p_partkey END AS STRING) AS isbn,
       CASE WHEN p_partkey % 53 = 0 THEN concat(p_name, ' 2nd') ELSE concat(p_name, ' ', lower(p_type)) END AS title,
       CASE WHEN p_partkey % 41 = 0 THEN NULL
            ELSE CASE p_type WHEN 'STANDARD' THEN 'Fiction' WHEN 'ECONOMY' THEN 'Self-Help'
                             WHEN 'MEDIUM' THEN 'Science Fiction' WHEN 'PROMO' THEN 'History'
                             WHEN 'LARGE' THEN 'Technology' ELSE 'Cooking' END END AS category,
       CASE WHEN p_partkey % 43 = 0 THEN 'Scroll'
            ELSE CASE p_partkey % 5 WHEN 0 THEN 'Hardcover' WHEN 1 THEN 'Paperback' WHEN 2 THEN 'Ebook'
                                    WHEN 3 THEN 'Audiobook' END END AS book_type,
       CASE WHEN p_partkey % 47 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS copies,
       CAST(1900 + p_size AS STRING) AS year,
       CASE WHEN p_partkey % 59 = 0 THEN NULL ELSE p_brand END AS author_name
FROM part""",
    "loans_v": """
SELECT o.o_orderkey AS seq, concat('b', CAST(o.o_custkey - o.o_custkey % 3 AS STRING)) AS borrower_name,
       concat(p.p_name, ' ', lower(p.p_type)) AS book_title,
       CAST(o.o_orderdate AS DATE) AS borrow_date,
       CASE WHEN o.o_orderkey % 5 <> 0 THEN CAST(o.o_orderdate AS DATE) + 14 END AS due_date,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderdate AS DATE) + 10 END AS return_date
FROM orders o JOIN part p ON p.p_partkey = o.o_custkey""",
    # Borrow / return / delete requests against the catalogue.
    "borrow_requests_v": """
SELECT o_orderkey AS seq, concat('b', CAST(o_custkey - o_custkey % 2 AS STRING)) AS borrower_name,
       CASE WHEN o_orderkey % 29 = 0 THEN 'unknown' ELSE CAST(o_custkey + o_orderkey % 3 AS STRING) END AS isbn
FROM orders""",
    "return_requests_v": """
SELECT o_orderkey AS seq, concat('b', CAST(o_custkey - o_custkey % 3 AS STRING)) AS borrower_name,
       CASE WHEN o_orderkey % 31 = 0 THEN 'unknown' ELSE CAST(o_custkey AS STRING) END AS isbn
FROM orders""",
    # A borrow / return log whose every second event names one book.
    "hot_ledger_v": """
SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 4 < 2 THEN 'borrow' ELSE 'return' END AS kind,
       concat('b', CAST(o_custkey - o_custkey % 3 AS STRING)) AS borrower_name,
       CASE WHEN o_orderkey % 3 <> 0 THEN '1' ELSE CAST(o_custkey AS STRING) END AS isbn
FROM orders""",
    # Search requests, as many as books.
    "search_requests_v": """
SELECT p_partkey AS request,
       CASE p_partkey % 5 WHEN 1 THEN 'title' WHEN 2 THEN 'category' WHEN 3 THEN 'publisher' ELSE 'isbn' END AS field,
       CASE p_partkey % 5 WHEN 1 THEN concat('No Such ', CAST(p_partkey AS STRING)) WHEN 2 THEN concat('zz', CAST(p_partkey AS STRING))
            ELSE CAST(p_partkey AS STRING) END AS query
FROM part""",
    "delete_requests_v": """
SELECT event_id AS seq, CASE WHEN event_id % 17 = 0 THEN 'unknown' ELSE CAST(user_id AS STRING) END AS isbn
FROM events""",
    "authors_v": """
SELECT s_suppkey AS seq, concat('Brand#', CAST(s_suppkey - s_suppkey % 2 AS STRING)) AS name,
       CASE s_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('N', CAST(s_nationkey AS STRING)) END
         AS nationality,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(1900 + s_suppkey % 90 AS STRING) END AS birth_year
FROM supplier""",
    # Academics: students, courses (every part), enrolment requests, grade changes.
    "students_v": """
SELECT c_custkey AS seq,
       CASE WHEN c_custkey % 43 = 0 THEN CAST(c_custkey - 1 AS STRING) WHEN c_custkey % 67 = 0 THEN ' '
            ELSE CAST(c_custkey AS STRING) END AS student_id,
       CASE WHEN c_custkey % 37 = 0 THEN '  ' WHEN c_custkey % 41 = 0 THEN c_name
            ELSE concat(lower(c_mktsegment), ' ', translate(substr(c_name, 10), '0123456789', 'abcdefghij')) END
         AS name,
       CASE WHEN c_custkey % 71 = 0 THEN 'other'
            ELSE CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'female' WHEN 2 THEN 'FEMALE' ELSE 'male' END END
         AS gender,
       CASE WHEN c_custkey % 73 = 0 THEN 'no-at-sign' ELSE concat('s', CAST(c_custkey AS STRING), '@uni.edu') END
         AS email,
       CASE WHEN c_custkey % 47 = 0 THEN 'phd' WHEN c_custkey % 2 = 0 THEN 'undergraduate' ELSE 'graduate' END
         AS level,
       CASE WHEN c_custkey % 53 = 0 THEN 'history'
            ELSE CASE c_custkey % 6 WHEN 0 THEN 'science' WHEN 1 THEN 'arts' WHEN 2 THEN 'commerce'
                                    WHEN 3 THEN 'engineering' WHEN 4 THEN 'medicine' ELSE 'law' END END AS field
FROM customer""",
    "courses_v": """
SELECT p_partkey AS seq,
       CAST(CASE WHEN p_partkey % 83 = 0 THEN p_partkey - 1 ELSE p_partkey END AS STRING) AS course_id,
       CASE WHEN p_partkey % 59 = 0 THEN concat(p_name, '!') WHEN p_partkey % 97 = 0 THEN ' ' ELSE p_name END
         AS title,
       CASE WHEN p_partkey % 89 = 0 THEN 'doctorate' WHEN p_partkey % 79 = 0 THEN NULL
            ELSE CASE p_partkey % 3 WHEN 0 THEN 'undergraduate' WHEN 1 THEN 'graduate'
                                    ELSE 'undergraduate, graduate' END END AS allowed_levels,
       CASE WHEN p_partkey % 71 = 0 THEN 'science, poetry' WHEN p_partkey % 73 = 0 THEN NULL
            ELSE CASE p_partkey % 4 WHEN 0 THEN 'science, arts' WHEN 1 THEN 'law' WHEN 2 THEN 'medicine,engineering'
                                    ELSE 'commerce, science ,law' END END AS allowed_fields
FROM part""",
    "course_changes_v": """
SELECT event_id AS seq, CAST(user_id + event_id % 3 AS STRING) AS course_id,
       CASE WHEN event_id % 7 = 0 THEN '  ' ELSE concat(' Renamed ', CAST(user_id AS STRING), ' ') END AS new_title
FROM events""",
    "unenroll_requests_v": """
SELECT event_id AS seq, CAST(user_id AS STRING) AS student_id, CAST(CAST(floor(user_id / 8) AS BIGINT) + event_id % 4 AS STRING) AS course_id
FROM events""",
    "enroll_requests_v": """
SELECT o_orderkey AS seq, CAST(o_custkey AS STRING) AS student_id,
       CAST(CAST(floor(o_custkey / 8) AS BIGINT) + o_orderkey % 4 AS STRING) AS course_id
FROM orders""",
    "grade_changes_v": """
SELECT o_orderkey AS seq, CAST(o_custkey AS STRING) AS student_id,
       CAST(CAST(floor(o_custkey / 8) AS BIGINT) + o_orderkey % 4 AS STRING) AS course_id,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(100 + o_orderkey % 7 AS DOUBLE)
            ELSE CAST(floor(o_totalprice / 4500) AS DOUBLE) END AS grade
FROM orders""",
    # Registration / login attempts.
    "attempts_v": """
SELECT event_id AS seq, concat('u', CAST(user_id - user_id % 5 AS STRING), '@example.com') AS email,
       CAST(event_id % 14 AS BIGINT) AS password_length,
       concat('h', CAST(event_id % 5 AS STRING)) AS credential
FROM events""",
    # Forecast requests ('Kigali' vs 'kigali' checks case sensitivity).
    "city_requests_v": """
SELECT c_custkey AS seq, CASE c_custkey % 6 WHEN 0 THEN 'Kigali' WHEN 1 THEN 'Nairobi' WHEN 2 THEN 'Addis Ababa'
       WHEN 3 THEN 'Dar es Salaam' WHEN 4 THEN 'kigali' ELSE 'Paris' END AS city
FROM customer""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` in ``sf_dir``, resolved once per session.

    ``spark.read.parquet`` lists the files and runs a small job to read the
    schema from a footer; resolving each table once (instead of once per
    view) keeps that out of every query. The scan itself stays lazy, so
    filters and column pruning still reach each query's plan.
    """
    cache = spark.__dict__.setdefault("_tessera_tables", {})
    key = (sf_dir.rstrip("/"), name)
    if key not in cache:
        cache[key] = spark.read.parquet(f"{key[0]}/{name}.parquet")
    return cache[key]


def tables_in(sql: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for t in names:
        table(spark, sf_dir, t).createOrReplaceTempView(t)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived view ``name`` over the tables in ``sf_dir``."""
    register_tables(spark, sf_dir, tables_in(VIEWS[name]))
    return spark.sql(VIEWS[name])


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named views as CTEs (for the DuckDB oracle)."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    return f"WITH {ctes}\n{sql.strip()}"
