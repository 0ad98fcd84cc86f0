import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import source_audit
from tessera.llm.source_audit import in_skyband, skybands, source_divergence, term_counts


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", low)


def brute(rows, least, top):
    """rows: (lang, source, text)"""
    rows = [(a or "", b or "", c) for a, b, c in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        docs, total, by_source = Counter(), Counter(), defaultdict(Counter)
        for _, s, t in own:
            docs.update(set(terms(t)))
            by_source[s].update(terms(t))
        kept = [t for t, n in docs.items() if n >= least]
        for c in by_source.values():
            total.update(c)
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        of, q = {s: p(c) for s, c in by_source.items()}, p(total)
        for s in by_source:
            pair = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in by_source if o != s]
            over = [(t, of[s][t] - q[t]) for t in kept if by_source[s][t] and of[s][t] > q[t]]
            for part, items, limit in (("pair", pair, None), ("term", over, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:limit], 1)]
    return sorted(out)


def corpus(seed, n=240):
    rng = random.Random(seed)
    words = ["the", "The", "a", "été", "ÉTÉ", "日本", "x1y", "it's", "b_c", "z\x00q", "\x85m"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    rows = []
    for k in range(n):
        source = rng.choice(["hot", "hot", "hot", "s1", "s2", None, ""])
        pool = words if source == "hot" else words[: 40 + 20 * len(source or "")]
        text = " ".join(rng.choices(pool, [1 / (1 + j) for j in range(len(pool))], k=rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None]), source, rng.choice([text, text, text, None, "", "12 !? \n"])))
    return rows + rows[:9] + [("en", "silent", None), ("de", "quiet", "1 2"), ("xx", "alone", "rare words"), ("yy", "p", None), ("yy", "q", "...")]


@pytest.mark.parametrize("seed,least,top,tile", [(1, 5, 4, 256), (2, 1, 50, 2), (3, 30, 3, 1), (4, 500, 5, 256)])
def test_equals_brute_force(spark, monkeypatch, seed, least, top, tile):
    monkeypatch.setattr(source_audit, "TILE", tile)
    rows = corpus(seed)
    schema = "lang string, source string, text string, term string, n int, value double, rank string"
    df = spark.createDataFrame([(*r, "t", 1, 0.5, "r") for r in rows], schema).repartition(5)
    got = source_divergence(df, least_docs=least, top=top)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_many_small_shares(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "SHARE_ROWS", 20)
    monkeypatch.setattr(source_audit, "TASK_ROWS", 50)
    monkeypatch.setattr(source_audit, "TILE", 2)
    rows = corpus(7)
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert sorted(map(tuple, source_divergence(df, 3, 6).collect())) == brute(rows, 3, 6)


def test_no_rows_and_long_texts(spark):
    schema = "lang string, source string, text string"
    assert source_divergence(spark.createDataFrame([], schema)).collect() == []
    rows = [("en", "a", "big " * 300_000 + "word"), ("en", "b", "x" * 500_000), ("en", "b", "word big word")]
    got = source_divergence(spark.createDataFrame(rows, schema), 1, 5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 1, 5)


def dominators(rows, i):
    a = rows[i]
    return sum(b is not a and b[0] >= a[0] and b[1] <= a[1] and b[2] < a[2] for b in rows)


@pytest.mark.parametrize("seed", range(4))
def test_skyband_keeps_what_fewer_than_k_dominate(spark, monkeypatch, seed):
    monkeypatch.setattr(source_audit, "STEP", 7)
    rng = random.Random(seed)
    rows = [(rng.randint(1, 9), 0, f"t{k:03d}") for k in range(150)]
    rows = [(n, n + rng.randint(0, 4) if seed % 2 else rng.randint(9, 18), t) for n, _, t in rows]
    want = {r[2] for k, r in enumerate(rows) if dominators(rows, k) < 5}
    rng.shuffle(rows)
    df = spark.createDataFrame([("l", "s", t, n, m) for n, m, t in rows], "lang string, source string, term string, n long, lang_n long")
    assert {r.term for r in skybands(df.coalesce(1), 5).collect()} == want
    # merged skybands of shares are the skyband of the whole
    assert {r.term for r in skybands(skybands(df.repartition(4), 5).coalesce(1), 5).collect()} == want


def test_empty_skyband():
    none = np.zeros((0, 3), np.int64)
    assert in_skyband(np.array([[3, 4, 0], [3, 4, 1]]), none, 1).tolist() == [True, False]


def test_counts_have_a_row_for_every_group(spark):
    df = spark.createDataFrame([("en", "a", "b B c"), ("en", "a", "b"), ("en", "z", "7")], "lang string, source string, text string")
    got = {(r.source, r.term): (r.n, r.docs) for r in term_counts(df).collect()}
    assert got == {("a", None): (0, 0), ("z", None): (0, 0), ("a", "b"): (3, 2), ("a", "c"): (1, 1)}
