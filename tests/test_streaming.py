import os

from pyspark.sql import functions as F

from tessera.operators import library as B
from tessera.operators import rental as R
from tessera.plans.replay import write_stream_chunks
from tessera.streaming.importer import start_import_stream
from tessera.streaming.bucket_state import BucketState
from tessera.streaming.stateful import start_ledger_stream, start_rental_stream

EV = "seq long, vehicle_id long, days long, kind string"


def test_rental_stream_matches_batch(spark, tmp):
    import random
    rnd = random.Random(3)
    ev = spark.createDataFrame([(s, rnd.choice([0, 0, 0, 0, 1, 2, 3, 5]), 1, rnd.choice(["rent", "return"]))
                                for s in rnd.sample(range(10_000), 300)], EV)
    veh = spark.createDataFrame([(i, i, 10.0, "car") for i in range(5)],
                                "seq long, vehicle_id long, base_price double, vehicle_type string")
    src = os.path.join(tmp, "src")
    write_stream_chunks(ev, src, "vehicle_id", n_chunks=3, files_per_chunk=2)
    stream = spark.readStream.schema(EV).option("maxFilesPerTrigger", 2).parquet(src)
    sink = os.path.join(tmp, "sink")
    start_rental_stream(stream, veh, sink, os.path.join(tmp, "state"), os.path.join(tmp, "ck"), 4).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(sink).select("seq", "outcome").collect()))
    exp = sorted(map(tuple, R.rental_outcomes(ev, veh).select("seq", "outcome").collect()))
    assert got == exp


def test_ledger_stream_matches_batch(spark, tmp):
    import random
    rnd = random.Random(5)
    books = B.normalise_books(spark.createDataFrame(
        [(i, str(i), ["Alpha", "Beta"][i % 2], None, None, rnd.randint(1, 3), None, "A") for i in range(4)],
        "seq long, isbn string, title string, category string, book_type string, copies long, year string, "
        "author_name string"))
    loans = spark.createDataFrame([(1, "p", "Alpha", None, None, None)],
                                  "seq long, borrower_name string, book_title string, borrow_date date, "
                                  "due_date date, return_date date")
    ev = spark.createDataFrame([(s, rnd.choice(["borrow", "return"]), rnd.choice(["p", "q", "r"]),
                                 rnd.choice(["0", "1", "2", "3", "9"])) for s in rnd.sample(range(5000), 200)],
                               "seq long, kind string, borrower_name string, isbn string")
    title = {"0": "Alpha", "1": "Beta", "2": "Alpha", "3": "Beta"}
    keyed = ev.withColumn("__t", F.coalesce(F.element_at(F.create_map(*[x for k, v in title.items()
                                                                         for x in (F.lit(k), F.lit(v))]),
                                                         F.col("isbn")), F.lit("")))
    src = os.path.join(tmp, "src")
    write_stream_chunks(keyed, src, "__t", n_chunks=3, files_per_chunk=2)
    stream = spark.readStream.schema(keyed.schema).option("maxFilesPerTrigger", 2).parquet(src).drop("__t")
    sink = os.path.join(tmp, "sink")
    # half of every batch names one title and is cut into chunks of 16 events
    start_ledger_stream(stream, books, loans, sink, os.path.join(tmp, "state"), os.path.join(tmp, "ck"), 4, chunk_rows=16).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(sink).select("seq", "outcome").collect()))
    exp = sorted(map(tuple, B.loan_ledger(ev, books, loans).select("seq", "outcome").collect()))
    assert got == exp


def test_import_stream_dedups_across_batches(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    for i, body in enumerate(["1,A,a@x.io\n2,B,b@x.io\n", "1,A2,a2@x.io\n3,,c@x.io\n", "4,D,d@x.io\n2,B,b@x.io\n"]):
        p = os.path.join(src, f"f{i}.csv")
        with open(p, "w") as f:
            f.write("user_id,name,email\n" + body)
        os.utime(p, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    store, out = os.path.join(tmp, "store"), os.path.join(tmp, "out")
    existing = spark.createDataFrame([(4,)], "user_id long")
    counts = {}
    q = start_import_stream(spark, src, store, out, os.path.join(tmp, "ck"), existing, on_metrics=counts.__setitem__)
    q.awaitTermination()
    assert counts == {0: {"n_rows": 2, "added": 2, "duplicate": 0, "invalid": 0, "malformed": 0},
                      1: {"n_rows": 2, "added": 0, "duplicate": 1, "invalid": 1, "malformed": 0},
                      2: {"n_rows": 2, "added": 0, "duplicate": 2, "invalid": 0, "malformed": 0}}
    rows = spark.read.parquet(out).orderBy("batch_id", "seq").select("user_id", "outcome", "error_code").collect()
    assert [(r[0], r[1]) for r in rows] == [(1, "added"), (2, "added"), (1, "duplicate"), (3, "invalid"),
                                            (4, "duplicate"), (2, "duplicate")]
    assert sorted(r["user_id"] for r in spark.read.parquet(store).collect()) == [1, 2]


def test_bucket_state_reads_only_touched_buckets(spark, tmp):
    state = BucketState(spark, os.path.join(tmp, "s"), "id long, v string", ["id"], 8)
    frame = lambda rows: spark.createDataFrame(rows, "id long, v string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    every = list(range(8))
    assert state.read(every, 0).collect() == []
    state.seed(frame([(k, "seed") for k in range(20)]))
    state.seed(frame([(99, "not again")]))
    one = state.touched(frame([(3, "")]))
    assert len(one) == 1
    before = state.read(one, 5)
    kept = rows(before)
    assert (3, "seed") in kept and len(kept) < 20 and {f.split("bucket=")[1].split("/")[0] for f in before.inputFiles()} == {str(one[0])}
    state.write(before.filter("id <> 3").unionByName(frame([(3, "new")])), 5)
    assert rows(state.read(one, 5)) == kept  # run again, batch 5 finds what it found
    assert (3, "new") in rows(state.read(one, 6)) and len(rows(state.read(every, 6))) == 20
    state.write(state.read(one, 6), 6)
    state.write(state.read(one, 7), 7)
    assert state.versions()[one[0]] == [6, 7]  # what batch 7 replaced, and 7


def test_import_batch_leaves_other_buckets_alone(spark, tmp):
    src, store, out, ids = (os.path.join(tmp, n) for n in ("in", "store", "out", "ids"))
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write('user_id,name,email\n7,"Ann\nB",a@x.io\n7,C,c@x.io\n')
    existing = spark.range(200).select(F.col("id").alias("user_id")).filter("user_id <> 7")
    start_import_stream(spark, src, store, out, os.path.join(tmp, "ck"), existing, ids_path=ids, buckets=32).awaitTermination()
    state = BucketState(spark, ids, "user_id long", ["user_id"], 32)
    assert [b for b, n in state.versions().items() if 0 in n] == state.touched(spark.createDataFrame([(7,)], "user_id long"))
    assert spark.read.parquet(out).count() == 2


def test_repeats_within_the_watermark_are_dropped_and_state_expires(spark, tmp):
    import datetime

    from tessera.streaming.dedup import start_deduplicated

    schema, at = "id long, ts timestamp", lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    batches = [[(k, at(10, 0)) for k in range(20)], [(1, at(10, 4)), (2, at(9, 58)), (30, at(10, 5))], [(99, at(12, 0))], [(98, at(12, 1))], [(1, at(12, 2))]]
    src = os.path.join(tmp, "in")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_deduplicated(stream, ["id"], "ts", "10 minutes", os.path.join(tmp, "out"), os.path.join(tmp, "ck"))
    q.awaitTermination()
    rows = sorted((r.id, r.ts) for r in spark.read.parquet(os.path.join(tmp, "out")).collect())
    assert [r for r in rows if r[0] in (1, 2, 30)] == [(1, at(10, 0)), (1, at(12, 2)), (2, at(10, 0)), (30, at(10, 5))]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) >= 21 and held[-1] < 10  # the keys of ten o'clock are forgotten
