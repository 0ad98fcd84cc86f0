import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import importer as I
from tessera.sources import users_csv as U


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def outcomes(spark, path, existing=()):
    raw = U.read_users_csv(spark, path)
    store = spark.createDataFrame([(i,) for i in existing], "user_id long")
    return I.import_users(raw, store).orderBy("seq").collect()


def test_sample_file(spark, tmp):
    p = write(os.path.join(tmp, "in.csv"),
              "user_id,name,email\n1,Alice,alice@example.com\n2,Bob,bob@example.com\n"
              "3,,bad-email\n1,Alice Again,alice2@example.com\n")
    got = [r["outcome"] for r in outcomes(spark, p)]
    assert got == ["added", "added", "invalid", "duplicate"]
    audit = {r["outcome"]: r["n_rows"] for r in I.import_audit(
        I.import_users(U.read_users_csv(spark, p), spark.createDataFrame([], "user_id long"))).collect()}
    assert audit == {"added": 2, "invalid": 1, "duplicate": 1}


def test_stored_and_validation_order(spark, tmp):
    p = write(os.path.join(tmp, "in.csv"),
              "user_id,name,email\n5,Eve,eve@example.com\n0,Zed,z@example.com\n7,,x@example.com\n"
              "8,Ann,nope\n 9 ,  Padded  , p@example.com \n")
    rows = outcomes(spark, p, existing=[5])
    assert [(r["outcome"], r["error_code"]) for r in rows] == [
        ("duplicate", "already_stored"), ("invalid", "invalid_user_id"), ("invalid", "missing_name"),
        ("invalid", "invalid_email"), ("added", None)]
    assert (rows[4]["user_id"], rows[4]["name"], rows[4]["email"]) == (9, "Padded", "p@example.com")


def test_malformed_rows(spark, tmp):
    p = write(os.path.join(tmp, "in.csv"),
              "user_id,name,email\nabc,A,a@example.com\n2,OnlyTwo\n3,Long,l@example.com,extra\n4,\"Quoted, Name\",q@x.io\n"
              "1.0,F,f@example.com\n1_0,U,u@example.com\n")
    rows = outcomes(spark, p)
    assert [r["outcome"] for r in rows] == ["malformed", "malformed", "added", "added", "malformed", "added"]
    assert rows[3]["name"] == "Quoted, Name" and rows[5]["user_id"] == 10


def test_header_rules(spark, tmp):
    empty = write(os.path.join(tmp, "empty.csv"), "")
    assert U.read_users_csv(spark, empty).count() == 0
    header_only = write(os.path.join(tmp, "h.csv"), "user_id,name,email\n")
    assert U.read_users_csv(spark, header_only).count() == 0
    bad = write(os.path.join(tmp, "bad.csv"), "user_id,name\n1,A\n")
    with pytest.raises(U.FileFormatError):
        U.read_users_csv(spark, bad)
    with pytest.raises(FileNotFoundError):
        U.read_users_csv(spark, os.path.join(tmp, "missing.csv"))


def test_first_wins_independent_of_partitioning(spark):
    rows = [(i, str(i % 7), f"n{i}", f"u{i}@example.com") for i in range(300)]
    raw = spark.createDataFrame(rows, "seq long, user_id string, name string, email string")
    store = spark.createDataFrame([(3,)], "user_id long")
    a = sorted(map(tuple, I.import_users(raw.repartition(1), store).collect()))
    b = sorted(map(tuple, I.import_users(raw.repartition(8), store).collect()))
    assert a == b
    added = [r for r in a if r[4] == "added"]
    assert sorted(r[1] for r in added) == [1, 2, 4, 5, 6]   # 0 invalid, 3 stored
    assert all(r[0] < 7 for r in added)


def test_lenient_prefix(spark, tmp):
    p = write(os.path.join(tmp, "l.csv"),
              "anything\n1, A ,a@x.io\n2,short\n3,C,c@x.io\nbad,D,d@x.io\n4,E,e@x.io\n")
    rows = U.read_users_csv_lenient(spark, p).orderBy("seq").collect()
    assert [(r["user_id"], r["name"]) for r in rows] == [(1, " A "), (3, "C")]
    assert U.read_users_csv_lenient(spark, os.path.join(tmp, "none.csv")).count() == 0


def test_csv_roundtrip(spark, tmp):
    users = spark.createDataFrame([(1, "A", "a@x.io"), (2, "B, b", "b@x.io")], "user_id long, name string, email string")
    U.write_users_csv(users, os.path.join(tmp, "out"))
    back = U.read_users_csv(spark, os.path.join(tmp, "out"))
    assert sorted((r["user_id"], r["name"]) for r in back.collect()) == [("1", "A"), ("2", "B, b")]


def test_int_parse_matches_python_for_every_decimal_digit(spark):
    import unicodedata
    from pyspark.sql import functions as F
    from tessera.functions.text import py_int

    digits = [chr(c) for c in range(0x110000) if unicodedata.decimal(chr(c), None) is not None]
    vals = [f" +{d}{d}_{d} " for d in digits] + [f"-{d}" for d in digits] + [f"{d}.{d}" for d in digits[:20]]
    got = {r["i"]: r["n"] for r in spark.createDataFrame(list(enumerate(vals)), "i int, v string")
           .select("i", py_int(F.col("v")).alias("n")).collect()}

    def python_int(v):
        try:
            return int(v)
        except ValueError:
            return None
    assert got == {i: python_int(v) for i, v in enumerate(vals)}


def test_store_object_missing_blank_or_invalid_is_empty(spark, tmp):
    import os
    from tessera.sources.records import read_user_store_object

    def write(name, text):
        p = os.path.join(tmp, name)
        with open(p, "w") as f:
            f.write(text)
        return p

    ok = write("ok.json", '{"1": {"name": "Ann", "email": "a@x.io"}, "2": {"name": "Bo", "email": "b@x.io"}}')
    assert sorted(map(tuple, read_user_store_object(spark, ok).collect())) == [(1, "Ann", "a@x.io"),
                                                                             (2, "Bo", "b@x.io")]
    for p in (write("blank.json", "   \n"), write("bad.json", '{"1": {"name": '),
              os.path.join(tmp, "missing.json")):
        assert read_user_store_object(spark, p).count() == 0


def test_counts_are_observed_while_the_outcomes_are_written(spark, tmp):
    from pyspark.sql import Observation

    raw = spark.createDataFrame([(1, "1", "Ann", "a@x.io"), (2, "1", "Ann", "a@x.io"), (3, "x", "B", "b@x.io"), (4, "4", "", "c@x.io"), (5, "5", "E", None)],
                                "seq long, user_id string, name string, email string")
    out = I.import_users(raw, spark.createDataFrame([(9,)], "user_id long"))
    counts = Observation("test")
    I.observed_audit(out, counts).write.parquet(tmp + "/out")
    audit = {r.outcome: r.n_rows for r in I.import_audit(spark.read.parquet(tmp + "/out")).collect()}
    assert counts.get == {"n_rows": 5, **{o: audit.get(o, 0) for o in I.OUTCOMES}}


def test_a_write_repeated_under_its_id_adds_nothing(spark, tmp):
    from tessera.sources import sinks as K

    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v long")
    path = tmp + "/table"
    assert K.append_once(rows(1, 2), path, "a") and not K.append_once(rows(1, 2), path, "a")
    assert K.append_once(rows(2, 3), path, "b/2")
    rows(7).write.parquet(path + "/rows/part=dead")  # a job that ended before its log entry
    assert sorted(r.v for r in K.read_once(spark, path).collect()) == [1, 2, 2, 3]
