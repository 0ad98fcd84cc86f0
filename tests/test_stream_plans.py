import os

from pyspark.sql import functions as F

from tessera.operators import library as B
from tessera.streaming import stateful


def test_a_ledger_batch_broadcasts_no_table(spark, tmp, monkeypatch):
    """What a micro-batch joins is merged, so nothing is sent to the driver
    batch after batch."""
    books = B.normalise_books(spark.createDataFrame(
        [(i, str(i), f"T{i % 3}", None, None, 2, None, "A") for i in range(5)],
        "seq long, isbn string, title string, category string, book_type string, copies long, year string, author_name string"))
    loans = spark.createDataFrame([(1, "p", "T1", None, None, None)],
                                  "seq long, borrower_name string, book_title string, borrow_date date, due_date date, return_date date")
    ev = spark.createDataFrame([(s, "borrow" if s % 3 else "return", "p" if s % 2 else None, str(s % 7)) for s in range(60)],
                               "seq long, kind string, borrower_name string, isbn string")
    src, sink, plans = os.path.join(tmp, "src"), os.path.join(tmp, "sink"), []
    ev.coalesce(1).write.parquet(src)
    plan_of = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    write, staged = stateful.write_batch, stateful._staged
    monkeypatch.setattr(stateful, "write_batch", lambda rows, *a: (plan_of(rows), write(rows, *a))[1])
    monkeypatch.setattr(stateful, "_staged", lambda df, label: (label == "ledger-batch" and plan_of(df), staged(df, label))[1])
    stream = spark.readStream.schema(ev.schema).parquet(src)
    stateful.start_ledger_stream(stream, books, loans, sink, os.path.join(tmp, "state"), os.path.join(tmp, "ck"), 4).awaitTermination()
    assert len(plans) == 2 and not any("Broadcast" in p for p in plans)
    got = sorted(map(tuple, spark.read.parquet(sink).select("seq", "outcome").collect()))
    assert got == sorted(map(tuple, B.loan_ledger(ev, books, loans).select("seq", "outcome").collect()))


def test_text_batches_are_scored_once_over_all_slots(spark, tmp):
    from tessera.streaming.text import start_text_stream

    src, sink, quarantine = (os.path.join(tmp, n) for n in ("src", "sink", "quarantine"))
    rows = [(i, "en", [f"A good day {i}", None, "?!", " ", "bad, bad"][i % 5]) for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1).write.parquet(src)
    start_text_stream(spark, src, "doc_id long, lang string, text string", sink, quarantine, os.path.join(tmp, "ck")).awaitTermination()
    ok = spark.read.parquet(sink)
    assert sorted((r.doc_id, r.text, r.sentiment, r.score) for r in ok.collect()) == sorted(
        (i, f"a good day {i}", "positive", 1) if i % 5 == 0 else (i, "bad bad", "negative", -1) for i in range(100) if i % 5 in (0, 4))
    assert {r.error_code for r in spark.read.parquet(quarantine).collect()} == {"null_text", "empty_after_cleaning", "empty_text"}
    assert ok.select(F.input_file_name()).distinct().count() > 1
    assert not spark.sparkContext._jsc.getPersistentRDDs()
