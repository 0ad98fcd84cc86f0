import random
import zlib

import numpy as np

from tessera.llm.rules import STATISTICS, fit, holds, quality_scores, sampled_labels, statistics, training_rows, with_statistics

DOCS = "doc_id long, text string, lang string, source string, score string"


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 3


def test_fit_learns_a_conjunction_and_is_sparse():
    rng = np.random.default_rng(1)
    x = rng.random((2000, len(STATISTICS)))
    y = ((x[:, 3] > 0.4) & (x[:, 7] <= 0.6)).astype(float)
    model = fit(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.97
    assert 0 < len(model.rules) < 120
    assert fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert (fit(x[:9], np.ones(9)).score(x) > 0.9).all()


def test_held_out_accuracy_on_the_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality_scores(docs, labels)
    assert out.count() == docs.count()
    rows = [r for r in out.join(labels, "doc_id").collect()]
    assert all(r.held_out == (fold(r.doc_id) == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.quality for r in held)
    assert right / len(held) > 0.96
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(240):
        words = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 8))) for _ in range(60)]
        rows.append((i, " ".join(w + "%%" for w in words) if i % 3 == 0 else " ".join(words) + ".", "en", "s", "clash"))
    return rows


def test_compiled_column_equals_the_model(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(240)], "doc_id long, quality int")
    stats = with_statistics(df)
    x, y = training_rows(stats, sampled_labels(stats, labels))
    assert len(y) == sum(fold(i) != 1 for i in range(240))
    model = fit(x, y)
    got = {r.doc_id: r.s for r in stats.select("doc_id", model.column().alias("s")).collect()}
    want = model.score(np.array([statistics(r[1]) for r in rows]))
    assert max(abs(got[r[0]] - w) for r, w in zip(rows, want)) < 1e-9
    assert all(holds(rule, x).any() for rule, _ in model.rules)


def test_held_out_labels_teach_nothing(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    labels = [(i, int(i % 3 != 0)) for i in range(240)]
    other = [(i, 1 - q if fold(i) == 1 else q) for i, q in labels]
    schema = "doc_id long, quality int"
    one = {r.doc_id: r.score for r in quality_scores(df, spark.createDataFrame(labels, schema)).collect()}
    two = {r.doc_id: r.score for r in quality_scores(df, spark.createDataFrame(other, schema)).collect()}
    assert one == two


def test_odd_rows(spark):
    rows = corpus() + [(500, None, "en", "s", "x"), (501, "", "en", "s", "x"), (502, " \n ", None, None, None), (None, "w", "en", "s", "x"), (3, "again", "en", "s", "x"), (504, "long " * 40000, "en", "s", "x")]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(240)] + [(None, 1), (1, None), (2, 7)], "doc_id long, quality int")
    out = quality_scores(spark.createDataFrame(rows, DOCS), labels).collect()
    assert len(out) == len(rows) and len({r.score for r in out if r.doc_id in (500, 501, 502)}) == 1
    none = quality_scores(spark.createDataFrame(rows, DOCS), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_scores(spark.createDataFrame([], DOCS), labels).collect() == []


def test_samples_are_bounded_and_whole_when_small(spark):
    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    labels = ids.selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    every = sum(fold(i) != 1 for i in range(20000))
    assert sampled_labels(ids, labels, rows=10**6).count() == every
    assert abs(sampled_labels(ids, labels, rows=2000).count() - 2000) < 250
    assert sampled_labels(ids.limit(0), labels).count() == 0


def test_equal_statistics_give_the_share_of_good_labels():
    x, y = np.ones((8, 3)), np.array([1.0, 1, 1, 0, 1, 1, 0, 1])
    assert abs(1 / (1 + np.exp(-fit(x, y).bias)) - 0.75) < 1e-9
