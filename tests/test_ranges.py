import csv
import io
import json
import os
import random

import pytest

from tessera.sources import ranges
from tessera.sources import records as R
from tessera.sources import users_csv as U

PARTS = ["a", "b c", ",", '"', '""', "\n", "\r\n", "x,y", '"q"', "é", "\\", " ", "1"]


@pytest.fixture()
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def in_order(rows):
    return [r.fields for r in sorted(rows.collect(), key=lambda r: r.seq)]


def tasks(df):
    return df.rdd.getNumPartitions()


@pytest.mark.parametrize("seed,sent", [(1, 1000), (2, 1000), (3, 0), (4, 0)])
def test_csv_equals_python_over_many_splits(spark, tmp, tiny_splits, seed, sent):
    rng = random.Random(seed)
    want, expect = [], 0
    for k in range(3):
        rows = [["".join(rng.choices(PARTS, k=rng.randint(0, 6))) for _ in range(rng.randint(1, 4))] for _ in range(40)]
        buffer = io.StringIO()
        csv.writer(buffer, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerows(rows)
        with open(os.path.join(tmp, f"{k}.csv"), "w", newline="") as f:
            f.write(buffer.getvalue())
        want += list(csv.reader(io.StringIO(buffer.getvalue().replace("\r\n", "\n"))))
    source = ranges.pieces(spark, tmp, ranges.CSV)
    assert tasks(source) >= 8
    assert in_order(ranges.records(source, ranges.CSV, sent_splits=sent)) == want


@pytest.mark.parametrize("text", [
    'a,b\n"open to\nthe end\n\nof the file, all of it ' + "z" * 200, 'h\nx"y"z,"a"b"c,d\n"q" "r,s\n' * 9, "", "\n\n", 'one', '"' * 301 + "\nq,r",
    '"a\n' + "line without quotes\n" * 30 + 'end","next"\nlast,1\n',
])
def test_csv_odd_texts_equal_python(spark, tmp, tiny_splits, text):
    with open(os.path.join(tmp, "odd.csv"), "w", newline="") as f:
        f.write(text)
    assert in_order(ranges.records(ranges.pieces(spark, tmp, ranges.CSV), ranges.CSV)) == list(csv.reader(io.StringIO(text)))


def test_one_user_file_with_quoted_line_ends_by_many_tasks(spark, tmp, tiny_splits):
    path = os.path.join(tmp, "users.csv")
    rows = [(str(k), f'name "{k}"\nsecond, line' if k % 3 else f"plain {k}", f"u{k}@x.io") for k in range(200)]
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(U.HEADER)
        w.writerows(rows)
        f.write("\n7\n")
    got = sorted(U.read_users_csv(spark, path).collect(), key=lambda r: r.seq)
    assert [(r.user_id, r.name, r.email) for r in got] == [*rows, ("7", None, None)]
    assert tasks(ranges.pieces(spark, path, ranges.CSV)) >= 8
    again = os.path.join(tmp, "again")
    U.write_users_csv(U.read_users_csv(spark, path).orderBy("seq").limit(200).coalesce(1), again)
    back = sorted(U.read_users_csv_lenient(spark, again).collect(), key=lambda r: r.seq)
    assert [(str(r.user_id), r.name, r.email) for r in back] == rows


def author(rng, k):
    return {"name": "".join(rng.choices(['"', "\\", "{", "}", "[", "]", "a", "é", "\n", ","], k=rng.randint(0, 8))), "nationality": rng.choice([None, "N"]), "birth_year": str(k)}


@pytest.mark.parametrize("seed,indent,sent", [(1, None, 1000), (2, 2, 1000), (3, None, 0)])
def test_array_files_equal_python_over_many_splits(spark, tmp, tiny_splits, monkeypatch, seed, indent, sent):
    monkeypatch.setattr(ranges.records, "__defaults__", (sent,))
    rng, want = random.Random(seed), []
    for k in range(3):
        members = [author(rng, n) for n in range(50 if k != 1 else 0)]
        with open(os.path.join(tmp, f"{k}.json"), "w") as f:
            json.dump(members, f, indent=indent, ensure_ascii=bool(seed % 2))
            f.write(rng.choice(["", "\n"]))
        want += members
    assert tasks(ranges.pieces(spark, tmp, ranges.JSON_MEMBERS)) >= 8
    rows = sorted(R.read_authors(spark, tmp).collect(), key=lambda r: r.seq)
    assert [{"name": r.name, "nationality": r.nationality, "birth_year": r.birth_year} for r in rows] == want


def test_nested_members(spark, tmp, tiny_splits):
    books = [{"title": f"T{k}", "isbn": str(k), "copies": k, "author": {"name": "}{", "nationality": None, "birth_year": "1"}} for k in range(40)]
    path = os.path.join(tmp, "books.json")
    with open(path, "w") as f:
        json.dump(books, f, indent=4)
    rows = sorted(R.read_books(spark, path).collect(), key=lambda r: r.seq)
    assert [(r.title, r.copies, r.author_name) for r in rows] == [(b["title"], b["copies"], "}{") for b in books]


@pytest.mark.parametrize("end", ["", "\n", " \n\n"])
def test_object_store_over_many_splits(spark, tmp, tiny_splits, end):
    path = os.path.join(tmp, "store.json")
    users = {str(k): {"name": f'n"{k}}}', "email": None if k % 4 else "e{"} for k in range(30)}
    with open(path, "w") as f:
        f.write(json.dumps(users) + end)
    got = {str(r.user_id): {"name": r.name, "email": r.email} for r in R.read_user_store_object(spark, path).collect()}
    assert got == users


@pytest.mark.parametrize("text", ['{"1": {"name": "a"}', '{"1": {"name": "a"}}}x', "[1]", "", "  ", "nope", '{"1": {"name": "a"} "2": {"name": "b"}}', '{"1": {"na'])
def test_broken_object_stores_are_empty(spark, tmp, text):
    path = os.path.join(tmp, "store.json")
    with open(path, "w") as f:
        f.write(text)
    assert R.read_user_store_object(spark, path).collect() == []
