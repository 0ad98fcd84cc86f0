import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import email_ok, is_letters_and_spaces
from tessera.operators import payroll as P
from tessera.operators import web as W
from tessera.operators.ordering import flag_first, position_in_key
from tessera.sources import records as R
from tessera.sources import users_csv as U


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_many_csv_files_keep_path_and_row_order(spark, tmp, small_splits):
    folder = os.path.join(tmp, "two words")
    os.makedirs(folder)
    n = 0
    for k, rows in enumerate([200, 1, 60, 5, 0, 300]):
        with open(os.path.join(folder, f"p {k}.csv"), "w") as f:
            f.write("user_id,name,email\n")
            for _ in range(rows):
                f.write(f"{n},name {n},u{n}@x.io\n")
                n += 1
    rows = U.read_users_csv(spark, folder).orderBy("seq").collect()
    assert [int(r["user_id"]) for r in rows] == list(range(n))
    assert len({r["seq"] for r in rows}) == n


def test_first_bad_id_stops_the_lenient_load_over_files(spark, tmp):
    for k, ids in enumerate(("1 2 3", "4 x 5", "6 7")):
        with open(os.path.join(tmp, f"{k}.csv"), "w") as f:
            f.write("user_id,name,email\n" + "".join(f"{i},a,b@c.d\n" for i in ids.split()))
    assert sorted(r["user_id"] for r in U.read_users_csv_lenient(spark, tmp).collect()) == [1, 2, 3, 4]


def test_json_lines_keep_order_over_splits_and_files(spark, tmp, small_splits):
    n = 0
    for k in range(3):
        with open(os.path.join(tmp, f"a{k}.json"), "w") as f:
            for _ in range(400):
                f.write(json.dumps({"name": f"n{n}", "nationality": None, "birth_year": "1900"}) + "\n")
                n += 1
    df = R.read_authors(spark, tmp, layout="lines")
    rows = df.orderBy("seq").collect()
    assert [r["name"] for r in rows] == [f"n{k}" for k in range(n)] and len({r["seq"] for r in rows}) == n


def test_json_arrays_of_books_loans_and_authors(spark, tmp):
    def put(name, parts):
        os.makedirs(os.path.join(tmp, name))
        for k, part in enumerate(parts):
            with open(os.path.join(tmp, name, f"{k}.json"), "w") as f:
                json.dump(part, f, indent=2)
        return os.path.join(tmp, name)

    book = lambda t: {"title": t, "isbn": t, "category": None, "copies": 2, "author": {"name": "N", "nationality": "X"}}
    books = R.read_books(spark, put("b", [[book("q"), book("a")], [], [book("m")]])).orderBy("seq").collect()
    assert [(r["title"], r["author_name"], r["author_nationality"], r["copies"]) for r in books] == [("q", "N", "X", 2), ("a", "N", "X", 2), ("m", "N", "X", 2)]
    loans = R.read_loans(spark, put("l", [[{"borrower_name": "z", "book_title": "q", "borrow_date": "2020-01-02"}], [{"borrower_name": "b"}]])).orderBy("seq").collect()
    assert [(r["borrower_name"], r["borrow_date"]) for r in loans] == [("z", "2020-01-02"), ("b", None)]
    authors = R.read_authors(spark, put("a", [[{"name": "t"}, {"name": "c"}]])).orderBy("seq").collect()
    assert [r["name"] for r in authors] == ["t", "c"]


def test_object_store_at_any_size(spark, tmp):
    users = spark.range(1, 2501).select(F.col("id").alias("user_id"), F.lit("n").alias("name"), F.lit("e").alias("email"))
    R.export_user_store_objects(users, os.path.join(tmp, "s"), object_rows=300)
    back = R.read_user_store_object(spark, os.path.join(tmp, "s"), layout="lines")
    assert sorted(r["user_id"] for r in back.collect()) == list(range(1, 2501))


def test_flag_first_never_multiplies_rows(spark):
    rows = [("a", 1), ("a", 1), ("b", 1), (None, 2), ("a", 3), (None, 2)]
    out = flag_first(spark.createDataFrame(rows, "k string, seq long"), "k", "seq", "first").collect()
    assert sorted((str(r["k"]), r["seq"], r["first"]) for r in out) == sorted((str(k), s, s < 3) for k, s in rows)


def test_positions_with_sparse_and_negative_seq(spark):
    rng = random.Random(1)
    seqs = rng.sample(range(-(10**17), 10**17), 400)
    df = spark.createDataFrame([(s, "k" if s % 3 else "j") for s in seqs], "seq long, k string")
    got = {r["seq"]: r["p"] for r in position_in_key(df, None, "seq", "p").collect()}
    assert got == {s: i + 1 for i, s in enumerate(sorted(seqs))}
    got = {r["seq"]: r["p"] for r in position_in_key(df, "k", "seq", "p").collect()}
    for key in "jk":
        own = sorted(s for s in seqs if ("k" if s % 3 else "j") == key)
        assert [got[s] for s in own] == list(range(1, len(own) + 1))


def test_line_ends_are_no_letters(spark):
    values = ["Book", "Book\n", "Book\r", "Book\u2028", "Book\u0085", " Bo ok "]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r["ok"] for r in df.select(is_letters_and_spaces(F.col("v")).alias("ok")).collect()] == [True, False, False, False, False, True]
    emails = ["a@b.io", "a@b.io\n", "a@b.io\r", "a@b.io\u2028", "a@b.io\n\n", "a@b.io\r\n"]
    df = spark.createDataFrame([(v,) for v in emails], "v string")
    assert [r["ok"] for r in df.select(email_ok(F.col("v")).alias("ok")).collect()] == [True, True, False, False, False, False]


FETCH = "seq long, url string, method string, status_code int, fetch_error string, elapsed_ms long"


def test_repeated_urls_give_one_row_per_fetch(spark):
    f = spark.createDataFrame([(i, "u", "async", 200, None, 10) for i in range(4)], FETCH)
    by_page = spark.createDataFrame([(i, "u", f"t{i}", None) for i in range(4)], "page_id long, url string, title string, description string")
    assert sorted((r["seq"], r["title"]) for r in W.fetch_outcomes(f, by_page).collect()) == [(i, f"t{i}") for i in range(4)]
    by_url = by_page.drop("page_id")
    out = W.fetch_outcomes(f, by_url).collect()
    assert len(out) == 4 and {r["title"] for r in out} == {"t0"}
    assert W.fetch_summary(W.fetch_outcomes(f, by_url)).first()["total"] == 4


def test_totals_keep_parts_of_a_cent(spark):
    schema = "seq long, employee_id long, name string, department string, emp_type string, base_pay double, hours double, rate double, bonus double"
    emps = spark.createDataFrame([(i, i, "n", "d", "contract", None, 1.0, 0.004, 0.0) for i in range(1000)], schema)
    assert P.payroll_totals(P.payslips(P.validate_employees(emps))).first()["total_gross"] == 4.0


def test_employees_from_text(spark):
    schema = "seq long, name string, emp_type string, base_pay string, hours string, rate string, bonus string"
    rows = [(1, "a", " FullTime", " 1_000.5 ", None, None, " "), (2, "a", "fulltime", "12x", None, None, "1"), (3, "a", "contract", None, "1e1", "+.5", "x"),
            (4, "a", "intern", "5", None, None, "x"), (5, " ", "contract", None, "1", "2", "3"), (6, "a", "fulltime", "1d", None, None, "0"), (7, "a", "boss", "1", None, None, "x"), (8, "a", "fulltime", "5\n", None, None, "-1")]
    out = {r["seq"]: r for r in P.parse_employees(spark.createDataFrame(rows, schema)).collect()}
    assert (out[1]["base_pay"], out[1]["bonus"], out[1]["error_code"]) == (1000.5, 0.0, None)
    assert [out[k]["error_code"] for k in range(2, 9)] == ["bad_number", "bad_number", None, "missing_name", "bad_number", "invalid_type", "negative_bonus"]
