"""Registered library queries and SQL oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tessera.operators import library as B
from tessera.plans.tables import VIEWS, view, with_views

AS_OF = "1998-06-30"
SEARCHES = (("title", "ring"), ("author", "brand#1"), ("isbn", "12"), ("category", "fic"), ("year", "19"))
FILTER = (("available", None), ("category", " science fiction "))


def _books(spark, sf):
    return B.normalise_books(view(spark, sf, "books_v"))


def _loans(spark, sf):
    return B.normalise_loans(view(spark, sf, "loans_v"), AS_OF)


#: Events of a chunk in the log with a hot title.
HOT_CHUNK = 1 << 11


def _search(spark, sf):
    books = _books(spark, sf)
    parts = [B.book_search(books, q, f).select("seq", F.lit(f).alias("field")) for f, q in SEARCHES]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _new_authors(spark, sf):
    return view(spark, sf, "books_v").filter(F.col("author_name").isNotNull()).select(
        "seq", F.col("author_name").alias("name"), F.lit(None).cast("string").alias("nationality"),
        F.lit(None).cast("string").alias("birth_year"))


def _ledger(spark, sf):
    b = view(spark, sf, "borrow_requests_v").select((F.col("seq") * 2).alias("seq"), F.lit("borrow").alias("kind"),
                                                    "borrower_name", "isbn")
    r = view(spark, sf, "return_requests_v").select((F.col("seq") * 2 + 1).alias("seq"),
                                                    F.lit("return").alias("kind"), "borrower_name", "isbn")
    return B.loan_ledger(b.unionByName(r), _books(spark, sf), _loans(spark, sf))


def _hot_ledger(spark, sf):
    """The log with half of its events naming one book, in chunks that a title
    has several of."""
    return B.loan_ledger(view(spark, sf, "hot_ledger_v"), _books(spark, sf), _loans(spark, sf), chunk_rows=HOT_CHUNK)


QUERIES = {
    "book_searches": lambda spark, sf: B.book_searches(_books(spark, sf), view(spark, sf, "search_requests_v")),
    "loan_ledger_hot_title": _hot_ledger,
    "books_normalise": lambda spark, sf: _books(spark, sf)
    .select("seq", "isbn", "title", "category", "book_type", "copies"),
    "book_validate": lambda spark, sf: _books(spark, sf).select("seq", "isbn", "error_code"),
    "loans_normalise": lambda spark, sf: _loans(spark, sf).select("seq", "borrow_date", "due_date", "return_date"),
    "authors_normalise": lambda spark, sf: B.normalise_authors(view(spark, sf, "authors_v")),
    "loan_status": lambda spark, sf: B.loan_status(_loans(spark, sf), AS_OF).select("seq", "status", "days_overdue"),
    "active_loans": lambda spark, sf: B.active_loans(_loans(spark, sf)),
    "book_availability": lambda spark, sf: B.book_availability(_books(spark, sf), _loans(spark, sf))
    .select("seq", "isbn", "title", "copies", "borrowed", "available"),
    "book_search": _search,
    "book_filter": lambda spark, sf: B.book_filter(_books(spark, sf), _loans(spark, sf), list(FILTER))
    .select("seq", "isbn", "title", "available"),
    "loan_return": lambda spark, sf: B.loan_returns(view(spark, sf, "return_requests_v"), _books(spark, sf),
                                                    _loans(spark, sf)),
    "book_delete": lambda spark, sf: B.book_deletes(view(spark, sf, "delete_requests_v"),
                                                    view(spark, sf, "books_v"), _loans(spark, sf)),
    "author_upsert": lambda spark, sf: B.author_upsert(view(spark, sf, "authors_v"), _new_authors(spark, sf)),
    "author_listing": lambda spark, sf: B.author_listing(view(spark, sf, "authors_v")),
    "borrow_outcomes": lambda spark, sf: B.borrow_outcomes(view(spark, sf, "borrow_requests_v"),
                                                           _books(spark, sf), _loans(spark, sf)),
    "loan_ledger": _ledger,
}

_NB = """nb AS (SELECT seq, isbn, title, coalesce(category, 'General') AS category,
       coalesce(book_type, 'Hardcover') AS book_type, coalesce(copies, 1) AS copies, year, author_name FROM books_v),
fb AS (SELECT isbn AS fisbn, arg_min(title, seq) AS ftitle, arg_min(copies, seq) AS fcopies FROM nb GROUP BY isbn),
al AS (SELECT book_title AS al_title, count(*) AS al_n FROM loans_v WHERE return_date IS NULL GROUP BY book_title)"""

_CATS = ("'Fiction', 'Non-Fiction', 'Science Fiction', 'Fantasy', 'Mystery', 'Thriller', 'Romance', 'Biography', "
         "'History', 'Children', 'Poetry', 'Cookbooks', 'Self-Help', 'Technology', 'Science', 'General'")
_LETTERS = "regexp_matches(title, '^ *\\p{L}[\\p{L} ]*\\z')"
_BLANK = lambda c: f"({c} IS NULL OR trim({c}) = '')"
_DUE = "coalesce(due_date, borrow_date + 14)"
_STATUS = (f"CASE WHEN return_date IS NOT NULL THEN 'Returned' WHEN DATE '{AS_OF}' > {_DUE} THEN 'Overdue' "
           "ELSE 'Borrowed' END")


def _search_sql() -> str:
    cols = {"title": "title", "author": "author_name", "isbn": "isbn", "category": "category", "year": "year"}
    parts = []
    for f, q in SEARCHES:
        c = cols[f]
        cond = f"contains({c}, '{q}')" if f == "year" else f"contains(lower({c}), '{q}')"
        if f in ("category", "year"):
            cond += f" AND NOT {_BLANK(c)}"
        parts.append(f"SELECT seq, '{f}' AS field FROM nb WHERE {cond}")
    return " UNION ALL ".join(parts)


ORACLE = {
    "books_normalise": with_views(f", {_NB} SELECT seq, isbn, title, category, book_type, copies FROM nb", "books_v",
                                  "loans_v"),
    "book_validate": with_views(f""", {_NB}
SELECT seq, isbn, CASE WHEN NOT coalesce({_LETTERS}, false) THEN 'invalid_title'
  WHEN {_BLANK('author_name')} THEN 'missing_author' WHEN {_BLANK('isbn')} THEN 'missing_isbn'
  WHEN category NOT IN ({_CATS}) THEN 'invalid_category'
  WHEN book_type NOT IN ('Hardcover', 'Paperback', 'Ebook', 'Audiobook') THEN 'invalid_book_type' END AS error_code
FROM nb""", "books_v", "loans_v"),
    "loans_normalise": with_views(f"SELECT seq, borrow_date, {_DUE} AS due_date, return_date FROM loans_v", "loans_v"),
    "authors_normalise": with_views(f"""
SELECT seq, name, CASE WHEN NOT {_BLANK('nationality')} THEN nationality END AS nationality,
  CASE WHEN NOT {_BLANK('birth_year')} THEN birth_year END AS birth_year,
  CASE WHEN {_BLANK('name')} THEN 'missing_name' END AS error_code FROM authors_v""", "authors_v"),
    "loan_status": with_views(f"""
SELECT seq, {_STATUS} AS status, CAST(CASE WHEN {_STATUS} = 'Overdue'
  THEN date_diff('day', {_DUE}, DATE '{AS_OF}') ELSE 0 END AS INTEGER) AS days_overdue FROM loans_v""", "loans_v"),
    "active_loans": with_views("""
SELECT book_title, count(*) AS active_loans FROM loans_v WHERE return_date IS NULL GROUP BY book_title""", "loans_v"),
    "book_availability": with_views(f""", {_NB}
SELECT seq, isbn, title, copies, coalesce(al_n, 0) AS borrowed, copies - coalesce(al_n, 0) AS available
FROM nb LEFT JOIN al ON title = al_title""", "books_v", "loans_v"),
    "book_search": with_views(f", {_NB} {_search_sql()}", "books_v", "loans_v"),
    "book_filter": with_views(f""", {_NB}
SELECT seq, isbn, title, copies - coalesce(al_n, 0) AS available
FROM nb LEFT JOIN al ON title = al_title WHERE copies - coalesce(al_n, 0) > 0 AND lower(category) = 'science fiction'""",
                              "books_v", "loans_v"),
    "loan_return": with_views(f""", {_NB},
f AS (SELECT r.seq, r.borrower_name, r.isbn, fb.ftitle AS book_title FROM return_requests_v r
      LEFT JOIN fb ON r.isbn = fb.fisbn),
fk AS (SELECT *, row_number() OVER (PARTITION BY borrower_name, book_title ORDER BY seq) AS k FROM f
       WHERE book_title IS NOT NULL),
l AS (SELECT borrower_name AS lb, book_title AS lt, seq AS loan_seq,
             row_number() OVER (PARTITION BY borrower_name, book_title ORDER BY seq) AS k2
      FROM loans_v WHERE return_date IS NULL)
SELECT fk.seq, fk.borrower_name, fk.isbn, fk.book_title, l.loan_seq,
       CASE WHEN l.loan_seq IS NOT NULL THEN 'returned' ELSE 'no_active_loan' END AS outcome
FROM fk LEFT JOIN l ON l.lb = fk.borrower_name AND l.lt = fk.book_title AND l.k2 = fk.k
UNION ALL SELECT seq, borrower_name, isbn, NULL, NULL, 'book_not_found' FROM f WHERE book_title IS NULL""",
                              "books_v", "loans_v", "return_requests_v"),
    "book_delete": with_views("""
, act AS (SELECT DISTINCT book_title FROM loans_v WHERE return_date IS NULL),
bp AS (SELECT isbn, seq AS book_seq, row_number() OVER (PARTITION BY isbn ORDER BY seq) AS pos,
              act.book_title IS NOT NULL AS blocked FROM books_v LEFT JOIN act ON title = act.book_title),
pi AS (SELECT isbn, count(*) AS n, min(CASE WHEN blocked THEN pos END) AS fbl FROM bp GROUP BY isbn),
rq AS (SELECT d.seq, d.isbn, row_number() OVER (PARTITION BY d.isbn ORDER BY d.seq) AS k, pi.n, pi.fbl
       FROM delete_requests_v d LEFT JOIN pi ON d.isbn = pi.isbn),
o AS (SELECT seq, isbn, k, CASE WHEN n IS NULL THEN 'not_found' WHEN k <= least(coalesce(fbl - 1, n), n) THEN 'removed'
                              WHEN fbl IS NOT NULL THEN 'blocked' ELSE 'not_found' END AS outcome FROM rq)
SELECT o.seq, o.isbn, o.outcome, bp.book_seq FROM o
LEFT JOIN bp ON o.isbn = bp.isbn AND o.k = bp.pos AND o.outcome = 'removed'""",
                              "books_v", "loans_v", "delete_requests_v"),
    "author_upsert": with_views("""
, ex AS (SELECT seq, name, nationality, birth_year, 'existing' AS source FROM authors_v),
nw AS (SELECT seq, author_name AS name FROM books_v WHERE author_name IS NOT NULL),
ad AS (SELECT seq, name, CAST(NULL AS VARCHAR) AS nationality, CAST(NULL AS VARCHAR) AS birth_year,
              'added' AS source
       FROM (SELECT nw.*, row_number() OVER (PARTITION BY nw.name ORDER BY nw.seq) AS rn FROM nw
             WHERE nw.name NOT IN (SELECT name FROM ex WHERE name IS NOT NULL)) WHERE rn = 1)
SELECT * FROM ex UNION ALL SELECT * FROM ad""", "authors_v", "books_v"),
    "author_listing": with_views(f"""
SELECT seq, name, CASE WHEN {_BLANK('nationality')} THEN 'N/A' ELSE nationality END AS nationality,
  CASE WHEN {_BLANK('birth_year')} THEN 'N/A' ELSE birth_year END AS birth_year FROM authors_v""", "authors_v"),
    "borrow_outcomes": with_views(f""", {_NB},
q AS (SELECT r.seq, r.borrower_name, r.isbn, fb.ftitle AS book_title, fb.fcopies AS copies,
             coalesce(al.al_n, 0) AS a0, row_number() OVER (PARTITION BY fb.ftitle ORDER BY r.seq) AS k
      FROM borrow_requests_v r JOIN fb ON r.isbn = fb.fisbn LEFT JOIN al ON al.al_title = fb.ftitle),
rec AS (
  SELECT seq, book_title, k, a0 + CASE WHEN a0 < copies THEN 1 ELSE 0 END AS act,
         CASE WHEN a0 < copies THEN 'borrowed' ELSE 'no_copies' END AS outcome FROM q WHERE k = 1
  UNION ALL
  SELECT q.seq, q.book_title, q.k, rec.act + CASE WHEN rec.act < q.copies THEN 1 ELSE 0 END,
         CASE WHEN rec.act < q.copies THEN 'borrowed' ELSE 'no_copies' END
  FROM rec JOIN q ON q.book_title = rec.book_title AND q.k = rec.k + 1)
SELECT q.seq, q.borrower_name, q.isbn, q.book_title, q.copies, rec.outcome,
       CASE WHEN rec.outcome = 'borrowed' THEN 14 END AS due_offset_days FROM q JOIN rec ON q.seq = rec.seq
UNION ALL SELECT r.seq, r.borrower_name, r.isbn, NULL, NULL, 'book_not_found', NULL
FROM borrow_requests_v r LEFT JOIN fb ON r.isbn = fb.fisbn WHERE fb.fisbn IS NULL""",
                                  "books_v", "loans_v", "borrow_requests_v").replace("WITH ", "WITH RECURSIVE ", 1),
    # Mixed borrow / return ledger: each title's events are walked in order,
    # carrying the active count and a map borrower -> active loans (a seed row
    # k = 0 per title holds the initial count and an empty map).
    "loan_ledger": with_views(f""", {_NB},
ev AS (SELECT seq * 2 AS seq, 'borrow' AS kind, borrower_name, isbn FROM borrow_requests_v
       UNION ALL SELECT seq * 2 + 1, 'return', borrower_name, isbn FROM return_requests_v),
hl AS (SELECT book_title AS h_title, borrower_name AS h_who, count(*) AS h_n FROM loans_v
       WHERE return_date IS NULL GROUP BY book_title, borrower_name),
q AS (SELECT e.seq, e.kind, e.borrower_name, e.isbn, fb.ftitle AS book_title, fb.fcopies AS copies,
             coalesce(al.al_n, 0) AS a0, coalesce(hl.h_n, 0) AS h0,
             row_number() OVER (PARTITION BY fb.ftitle ORDER BY e.seq) AS k
      FROM ev e JOIN fb ON e.isbn = fb.fisbn LEFT JOIN al ON al.al_title = fb.ftitle
      LEFT JOIN hl ON hl.h_title = fb.ftitle AND hl.h_who = e.borrower_name),
rec AS (
  SELECT DISTINCT CAST(NULL AS BIGINT) AS seq, book_title, CAST(0 AS BIGINT) AS k, CAST(a0 AS BIGINT) AS act,
         map([]::VARCHAR[], []::BIGINT[]) AS held, CAST(NULL AS VARCHAR) AS outcome FROM q
  UNION ALL
  SELECT q.seq, q.book_title, q.k,
         CASE WHEN q.kind = 'borrow' AND rec.act < q.copies THEN rec.act + 1
              WHEN q.kind = 'return' AND coalesce(rec.held[q.borrower_name], q.h0) > 0 THEN rec.act - 1
              ELSE rec.act END,
         CASE WHEN q.kind = 'borrow' AND rec.act < q.copies
                THEN map_concat(rec.held, map([q.borrower_name], [coalesce(rec.held[q.borrower_name], q.h0) + 1]))
              WHEN q.kind = 'return' AND coalesce(rec.held[q.borrower_name], q.h0) > 0
                THEN map_concat(rec.held, map([q.borrower_name], [coalesce(rec.held[q.borrower_name], q.h0) - 1]))
              ELSE rec.held END,
         CASE WHEN q.kind = 'borrow' THEN CASE WHEN rec.act < q.copies THEN 'borrowed' ELSE 'no_copies' END
              WHEN coalesce(rec.held[q.borrower_name], q.h0) > 0 THEN 'returned' ELSE 'no_active_loan' END
  FROM rec JOIN q ON q.book_title = rec.book_title AND q.k = rec.k + 1)
SELECT q.seq, q.kind, q.borrower_name, q.isbn, q.book_title, rec.outcome FROM q JOIN rec ON q.seq = rec.seq
UNION ALL SELECT e.seq, e.kind, e.borrower_name, e.isbn, NULL, 'book_not_found'
FROM ev e LEFT JOIN fb ON e.isbn = fb.fisbn WHERE fb.fisbn IS NULL""",
                              "books_v", "loans_v", "borrow_requests_v", "return_requests_v")
    .replace("WITH ", "WITH RECURSIVE ", 1),
}

_RECURSIVE = ORACLE["loan_ledger"]
_EVENTS = _RECURSIVE[_RECURSIVE.index("ev AS (SELECT"):_RECURSIVE.index("hl AS (SELECT")]
ORACLE["loan_ledger_hot_title"] = _RECURSIVE.replace(_EVENTS, f"ev AS ({VIEWS['hot_ledger_v']}),\n")
ORACLE["book_searches"] = with_views(f""", {_NB}
SELECT q.request, nb.seq FROM nb JOIN search_requests_v q ON
  CASE q.field WHEN 'title' THEN contains(lower(nb.title), lower(q.query)) WHEN 'isbn' THEN contains(lower(nb.isbn), lower(q.query))
  WHEN 'author' THEN contains(lower(nb.author_name), lower(q.query))
  WHEN 'category' THEN NOT {_BLANK('nb.category')} AND contains(lower(nb.category), lower(q.query))
  WHEN 'year' THEN NOT {_BLANK('nb.year')} AND contains(nb.year, lower(q.query)) END""", "books_v", "loans_v", "search_requests_v")
