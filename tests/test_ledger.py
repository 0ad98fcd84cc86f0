import random

import pytest

from tessera.operators import ledger
from tessera.operators import library as B

EVENTS = "seq long, kind string, borrower_name string, isbn string"
LOANS = "seq long, borrower_name string, book_title string, borrow_date date, due_date date, return_date date"
BOOKS = "seq long, isbn string, title string, category string, book_type string, copies long, year string, author_name string"


def in_order(books, loans, events):
    """Outcomes of the events, one after the other."""
    first = {}
    for b in sorted(books):
        first.setdefault(b[1], b)
    active, held, out = {}, {}, {}
    for _, who, title, *_ in loans:
        active[title] = active.get(title, 0) + 1
        if who is not None:
            held[title, who] = held.get((title, who), 0) + 1
    for seq, kind, who, isbn in sorted(events):
        if isbn not in first:
            out[seq] = "book_not_found"
            continue
        title, copies = first[isbn][2], first[isbn][5]
        if kind == "borrow":
            ok = active.get(title, 0) < copies
            out[seq] = "borrowed" if ok else "no_copies"
            step = 1 if ok else 0
        else:
            ok = held.get((title, who), 0) > 0
            out[seq] = "returned" if ok else "no_active_loan"
            step = -1 if ok else 0
        active[title] = active.get(title, 0) + step
        held[title, who] = held.get((title, who), 0) + step
    return out


def case(seed, n, borrowers, copies, returns=0.5):
    rng = random.Random(seed)
    titles = ["Hot", "Cold", "Warm"]
    books = [(k, str(k), titles[k % 3], None, None, rng.randint(*copies), None, "A") for k in range(6)]
    loans = [(k, rng.choice(["p0", "p1", None]), rng.choice(titles), None, None, None) for k in range(5)]
    names = [f"p{k}" for k in range(borrowers)] + [None]
    isbn = lambda: rng.choice(["0", "3", "0", "3", "1", "2", "4", "9"])  # noqa: E731  half of the log names one title
    seqs = rng.sample(range(10 * n), n - 3) + [3 << 40, (3 << 40) + 1, (1 << 61) + 1]
    events = [(s, "return" if rng.random() < returns else "borrow", rng.choice(names), isbn()) for s in seqs]
    return books, loans, events


def frames(spark, books, loans, events):
    return spark.createDataFrame(events, EVENTS).repartition(3), spark.createDataFrame(books, BOOKS), spark.createDataFrame(loans, LOANS)


@pytest.mark.parametrize("seed,n,borrowers,copies,returns,chunk", [
    (1, 150, 4, (1, 3), 0.5, 20), (2, 120, 9, (0, 2), 0.2, 9), (3, 90, 2, (2, 6), 0.7, 11), (4, 60, 5, (1, 4), 0.5, 1 << 17),
])
def test_chunks_give_the_outcomes_in_order(spark, seed, n, borrowers, copies, returns, chunk):
    books, loans, events = case(seed, n, borrowers, copies, returns)
    got = B.loan_ledger(*frames(spark, books, loans, events), chunk_rows=chunk, chunk_width=64).collect()
    assert {r.seq: r.outcome for r in got} == in_order(books, loans, events)
    assert len(got) == n


def test_no_task_reads_more_than_a_chunk_of_a_title(spark, monkeypatch):
    """Half of the log names one title; every replay gets chunks of at most 25
    events, and the rounds end by themselves."""
    books, loans, events = case(6, 400, 30, (3, 5))
    sizes, rounds, plain = [], [], ledger._in_order

    def watched(rows, starts):
        found = rows.groupBy("book_title", "chunk").count().collect()
        sizes.extend(r["count"] for r in found)
        rounds.append(len(found))
        return plain(rows, starts)

    monkeypatch.setattr(ledger, "_in_order", watched)
    got = B.loan_ledger(*frames(spark, books, loans, events), chunk_rows=25, chunk_width=1 << 20).collect()
    assert {r.seq: r.outcome for r in got} == in_order(books, loans, events)
    assert max(sizes) <= 25 and rounds[0] > 8 and len(rounds) <= rounds[0] + 2
    assert rounds[-2] < rounds[0]  # later rounds replay only what changed


def test_a_difference_passes_many_chunks_a_round(spark, monkeypatch):
    """Readers who seldom return: what a chunk starts with matters in all the
    chunks after it, yet rounds grow with the logarithm of their number."""
    books, loans, events = case(8, 600, 250, (3, 3))
    ends, plain = [], ledger._staged
    monkeypatch.setattr(ledger, "_staged", lambda df, label: (ends.append(label), plain(df, label))[1])
    got = B.loan_ledger(*frames(spark, books, loans, events), chunk_rows=6, chunk_width=1 << 20).collect()
    assert {r.seq: r.outcome for r in got} == in_order(books, loans, events)
    assert ends.count("ends") <= 6


@pytest.mark.parametrize("most", [1, 2, 3])
def test_spans_of_any_size_give_the_outcomes_in_order(spark, most):
    books, loans, events = case(9, 150, 20, (1, 4))
    ev, bk, ln = frames(spark, books, loans, events)
    found = ev.join(B.first_titles(bk), ev["isbn"] == B.F.col("__isbn")).select("seq", "book_title", "kind", "borrower_name", "copies")
    got = ledger.ledger_outcomes(found, ledger.counters(ln), chunk_rows=12, span_rows=12 * most).collect()
    want = in_order(books, loans, events)
    assert {r.seq: r.outcome for r in got} == {s: o for s, o in want.items() if o != "book_not_found"}


def test_empty_log_and_unknown_books(spark):
    books, loans, _ = case(1, 10, 2, (1, 1))
    assert B.loan_ledger(*frames(spark, books, loans, [(1, "borrow", "x", "none")])).collect()[0].outcome == "book_not_found"
    ev, bk, ln = frames(spark, books, loans, [(1, "borrow", "x", "0")])
    assert B.loan_ledger(ev.limit(0), bk, ln).collect() == []
    assert B.loan_ledger(ev, bk, ln.limit(0)).collect()[0].outcome == "borrowed"


def test_a_log_is_read_a_fixed_number_of_times(spark, monkeypatch):
    """Readers who seldom return, a hundred chunks and spans of four: the log
    is packed once, walked once and replayed once, in batches of a few rows."""
    books, loans, events = case(10, 1200, 250, (3, 3))
    ev, bk, ln = frames(spark, books, loans, events)
    found = ev.join(B.first_titles(bk), ev["isbn"] == B.F.col("__isbn")).select("seq", "book_title", "kind", "borrower_name", "copies")
    calls, plain = [], ledger._in_order
    monkeypatch.setattr(ledger, "_in_order", lambda rows, starts: (calls.append(rows.columns), plain(rows, starts))[1])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        got = ledger.ledger_outcomes(found, ledger.counters(ln), chunk_rows=6, span_rows=24).collect()
    finally:
        spark.conf.set(key, before)
    assert {r.seq: r.outcome for r in got} == {s: o for s, o in in_order(books, loans, events).items() if o != "book_not_found"}
    assert len(calls) == 3


@pytest.mark.parametrize("chunk", [2, 100])
def test_a_count_below_zero_is_no_loan(spark, chunk):
    """A stream's state may hold one where a seq came twice."""
    known = spark.createDataFrame([("Hot", "bx", -1), ("Hot", "by", 1)], ledger.COUNTERS)
    events = [(1, "borrow", "x"), (2, "return", "y"), (3, "return", "x"), (4, "borrow", "x"), (5, "return", "x")]
    df = spark.createDataFrame([(s, "Hot", k, w, 9) for s, k, w in events], "seq long, book_title string, kind string, borrower_name string, copies long")
    got = {r.seq: r.outcome for r in ledger.ledger_outcomes(df, known, chunk_rows=chunk).collect()}
    assert got == {1: "borrowed", 2: "returned", 3: "no_active_loan", 4: "borrowed", 5: "returned"}
