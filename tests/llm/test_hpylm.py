import math
import re
import zlib
from collections import Counter

import numpy as np

from tessera.llm.hpylm import CONTEXTS, PARENT_STRENGTH, Sampler, Totals, block_draw, context_of, perplexity, reseat, sampled_tables, scores

D = "/root/testdata/sf0.01"


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def tokens(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t) + [None]


def base(rows):
    c = Counter(w for i, t in rows if not fold(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(i, fold(i), len(ws := tokens(t)), sum(w in c for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, t in rows]


def test_block_draw_seats_everybody():
    rng = np.random.default_rng(1)
    n = rng.integers(2, 5000, 300)
    dish, size = block_draw(n, rng.random(300) * 50, rng)
    assert (np.bincount(dish, size) == n).all() and (size > 0).all()


def test_moves_reach_the_restaurant_distribution():
    """Three customers: P(tables) from the seating rule, against Gibbs moves."""
    strength, d = 0.7, 0.4
    weight = {1: 1 * (1 - d) * (2 - d), 2: 3 * strength * (1 - d), 3: strength**2}  # partitions of 3 by tables
    total = sum(weight.values())
    tables = np.zeros((40000, 32), np.int64)
    tables[:, 0] = 3
    reseat(tables, np.full(40000, strength), d, 25, np.random.default_rng(2))
    assert (tables.sum(axis=1) == 3).all()
    got = Counter((tables > 0).sum(axis=1).tolist())
    for k, w in weight.items():
        assert abs(got[k] / 40000 - w / total) < 0.012


def test_tables_are_possible():
    rng = np.random.default_rng(3)
    n = np.r_[0, 1, 1, 2, 3, 50, 100000, rng.integers(0, 9, 500)]
    t = sampled_tables(n, rng.random(len(n)) * 3, 0.6, 6, rng)
    assert (t <= n).all() and (t[n > 0] > 0).all() and (t[n == 1] == 1).all()


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    words = np.sort(rng.integers(0, 1 << 62, 60).astype(np.uint64))
    many = rng.integers(1, 5, 60)
    context = np.concatenate([np.sort(rng.choice(9, m, replace=False)) for m in many])
    counts = (words, many, context, rng.integers(1, 30, len(context)))
    history = []
    for _ in range(4):
        s = Sampler(0, counts)
        for k, t in enumerate(history):
            s.sweep(k + 1, t)
        history.append(Totals(dict(enumerate(s.totals()))))
    for c in (0, 5, CONTEXTS - 1):
        asked = np.r_[words, np.uint64(1 << 63)]  # every word and one unseen
        logs, n = Sampler(0, counts).averaged(history, asked, np.ones(61, np.int64), np.full(61, c))
        assert abs((10.0**logs).sum() - 1) < 1e-9 and n[-1] == 0 and PARENT_STRENGTH > 0


def test_columns_match_brute_force_and_the_model_learns(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = scores(docs).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    for i, held, n, known, train, score in base(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert abs(r.base_score - score) < 1e-9 * max(1, abs(score)) and r.score < 0
    per = {h: 10 ** (-sum(r.score for r in out if r.held_out == h) / sum(r.n_tokens for r in out if r.held_out == h)) for h in (True, False)}
    flat = 10 ** (-sum(r.base_score for r in out if r.held_out) / sum(r.n_tokens for r in out if r.held_out))
    assert per[True] < flat and per[False] < per[True]


def test_odd_rows_and_repetition(spark):
    rows = [(0, None), (2, ""), (3, " \n"), (4, "The the THE cat"), (4, "The the THE cat"), (None, "é cat"), (7, "word " * 30000), (11, "never seen"), (1, "cat")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, score int").repartition(3)
    first, second = (sorted((str(x) for x in scores(df).drop("score").collect())) for _ in range(2))
    assert first == second
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scores(df).collect()), key=str)
    assert got == sorted(((*b[:5], round(b[5], 6)) for b in base(rows)), key=str)
    assert scores(df.limit(0)).collect() == []
    held = [r[0] for r in rows if fold(r[0])]
    only = scores(df.where(f"doc_id = {held[0]}")).collect()
    assert only[0].train_tokens == 0 and only[0].score == 0 and only[0].base_score == 0
    assert {r.held_out for r in perplexity(scores(df)).collect()} <= {True, False}


def test_contexts_are_bounded():
    assert all(0 < context_of(w) < CONTEXTS for w in (b"", b"a", b"the", b"longer", "é日本語".encode()))


def test_chunks_of_any_size_give_the_same_scores(spark, monkeypatch):
    """Sliced batches, several chunks a batch: the same text, the same columns."""
    import tessera.llm.hpylm as module

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    whole = {r.doc_id: r for r in scores(docs).collect()}
    monkeypatch.setattr(module, "CHUNK_BYTES", 20_000)
    cut = {r.doc_id: r for r in scores(docs).collect()}
    want = {b[0]: b for b in base([(r.doc_id, r.text) for r in docs.collect()])}
    assert len(cut) == len(whole) == len(want)
    for i, r in cut.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[i][2:5] and abs(r.base_score - want[i][5]) < 1e-6
        assert abs(r.score - whole[i].score) < 1e-3 * abs(r.score)


def test_words_of_slices():
    import pyarrow as pa

    from tessera.llm.common import words_of

    texts = ["AB cd", None, "É\x1ca b", " x\x0b\x0cy z ", "", "q"] * 50
    for lo, hi in ((0, 300), (7, 200), (290, 300), (3, 3)):
        flat, n = words_of(pa.array(texts)[lo:hi])
        want = [[w.decode() for w in (t or "").encode().lower().split()] for t in texts[lo:hi]]
        assert n.tolist() == [len(w) for w in want] and flat.to_pylist() == [w for ws in want for w in ws]


def test_every_previous_word_is_a_context_of_its_own():
    """Words of one ending, and more words than there once were restaurants."""
    words = [b"nation", b"lemon", b"prison", b"the", *(f"word{k}".encode() for k in range(20000))]
    assert len({context_of(w) for w in words}) == len(words)


def test_words_of_one_ending_predict_their_own_successors(spark):
    """After 60 words of one ending the next word is certain, each its own."""
    rows = [(k, " ".join(f"x{i}nation y{i}" for i in range(k % 7, 60, 7)) + f" x{k % 60}nation") for k in range(700)]
    out = scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(out) == 700
    held = [r for r in out if r.held_out]
    per_token = -sum(r.score for r in held) / sum(r.n_tokens for r in held)
    assert per_token < 0.55 < -sum(r.base_score for r in held) / sum(r.n_tokens for r in held)


def exact_tables(n, strength, d):
    """P(t tables) for t = 1, 2, ...: strength^t S(n, t), by the recurrence."""
    logs = np.array([0.0])
    for m in range(1, n):
        t = np.arange(1, m + 2)
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(m - d * t, 0)) + np.r_[logs, -np.inf]
        logs = np.logaddexp(stay, np.r_[-np.inf, logs])
    logs = logs + np.arange(1, n + 1) * math.log(strength)
    p = np.exp(logs - logs.max())
    return p / p.sum()


def test_sampled_tables_follow_the_exact_distribution():
    """Few and thousands of customers, small and large strengths and discounts."""
    rng = np.random.default_rng(5)
    for n, strength, d in ((3, 0.7, 0.4), (40, 2.0, 0.8), (512, 9.0, 0.3), (513, 9.0, 0.3), (600, 7200.0, 0.8), (600, 1e5, 0.5), (600, 1e-4, 0.95), (1500, 1500.0, 0.3), (3000, 300.0, 0.05), (3000, 2.0, 0.5), (5000, 5.0, 0.8), (5000, 50.0, 0.8)):
        want = exact_tables(n, strength, d)
        t = np.arange(1, n + 1)
        mean = (want * t).sum()
        deviation = math.sqrt(max((want * (t - mean) ** 2).sum(), 0.0))
        got = sampled_tables(np.full(1500, n), np.full(1500, strength), d, 6, rng)
        assert abs(got.mean() - mean) < 4.5 * deviation / math.sqrt(1500) + 1e-3, (n, strength, d, got.mean(), mean)
        upto = np.searchsorted(np.sort(got), t, "right") / 1500
        assert np.abs(upto - want.cumsum()).max() < 0.055, (n, strength, d)


def test_sampled_tables_of_millions_of_customers():
    """Then t - 1 is a Poisson number with mean strength / discount."""
    got = sampled_tables(np.full(1500, 10_000_000), np.full(1500, 5.0), 0.8, 6, np.random.default_rng(6))
    assert abs(got.mean() - 7.25) < 0.3 and abs(got.var() - 6.25) < 1.2


def some_documents(spark):
    rng = np.random.default_rng(8)
    rows = [(k, " ".join(f"w{x}" for x in rng.zipf(1.3, 80) % 5000)) for k in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_bucketed_rows_are_grouped_where_they_lie(spark, capsys):
    from tessera.llm.common import bucketed

    df = spark.range(100).selectExpr("id % 7 as k", "id").repartition(5)
    out = bucketed(df, "test-rows", "k", 3)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    counted = out.groupBy("k").count()
    assert sorted(map(tuple, counted.collect())) == [(k, 15 if k < 2 else 14) for k in range(7)]
    assert "Exchange" not in plan_of(counted, capsys)
    assert not [t for t in spark.catalog.listTables() if "test_rows" in t.name]
    assert bucketed(df.limit(0), "test-rows", "k", 3).collect() == []


def test_chunks_and_counts_are_not_exchanged(spark, capsys):
    """What partitions tell each other is; texts and counts are read in buckets."""
    plan = plan_of(scores(some_documents(spark)), capsys)
    assert plan.count("Bucketed: true") == 2 and plan.count("FlatMapCoGroupsInArrow") >= 2


def test_pairs_are_not_staged(spark, monkeypatch):
    """Chunks keep a number a token; their pairs are only sent."""
    import tessera.llm.hpylm as module

    seen = {}

    def noted(name):
        plain = getattr(module, name)

        def wrapped(df, label, *more):
            seen[label] = plain(df, label, *more)
            return seen[label]

        monkeypatch.setattr(module, name, wrapped)

    noted("staged")
    noted("bucketed")
    scores(some_documents(spark))
    kinds = {label: {r.kind for r in df.select("kind").distinct().collect()} for label, df in seen.items()}
    assert kinds["lm-chunks"] == {module._DOCS} and not any(module._PAIRS in k for k in kinds.values())
    assert not any(module._CORE in k for label, k in kinds.items() if label != "lm-core")


def test_partitions_of_the_contexts_change_nothing(spark, monkeypatch):
    """Any number of them gives the same scores, and sweeps send no more rows than they need."""
    import tessera.llm.hpylm as module

    docs, out = some_documents(spark), {}
    for n in (1, 16):
        monkeypatch.setattr(module, "CONTEXT_PARTS", n)
        out[n] = sorted(map(tuple, scores(docs).collect()))
    assert len(out[1]) == 300 and out[1] == out[16]


def test_stirling_tables_are_shared():
    """The same draws, whatever the largest dish is beside the others."""
    from tessera.llm.hpylm import _log_stirling

    _log_stirling.cache_clear()
    for most in range(260, 500, 20):
        sampled_tables(np.array([3, most]), np.ones(2), 0.5, 6, np.random.default_rng(1))
    assert _log_stirling.cache_info().misses == 1
    small, large = _log_stirling(16, 0.4), _log_stirling(64, 0.4)
    assert np.array_equal(small, large[:17, :17])
