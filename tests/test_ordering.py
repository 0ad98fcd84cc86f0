import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators.ordering import flag_first, position_in_key, previous_in_key

SCHEMA = "k string, seq long, v string"


def brute(rows):
    df = pd.DataFrame(rows, columns=["k", "seq", "v"]).sort_values("seq")
    df["pos"] = df.groupby("k", dropna=False).cumcount() + 1
    df["prev"] = df.groupby("k", dropna=False)["v"].shift(1)
    df["gpos"] = range(1, len(df) + 1)
    return df


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["x", "y", None])),
                min_size=1, max_size=60), st.integers(1, 9))
def test_chunked_windows_match_brute_force(spark, events, width):
    seqs = random.Random(len(events)).sample(range(0, 500), len(events))
    rows = [(k, s, v) for (k, v), s in zip(events, seqs)]
    df = spark.createDataFrame(rows, SCHEMA)
    exp = brute(rows).set_index("seq")
    got = previous_in_key(position_in_key(df, "k", "seq", "pos", width), "k", "seq", "v", "prev", width)
    got = position_in_key(got, None, "seq", "gpos", width).toPandas().set_index("seq")
    for s in exp.index:
        assert got.loc[s, "pos"] == exp.loc[s, "pos"]
        assert got.loc[s, "gpos"] == exp.loc[s, "gpos"]
        e, g = exp.loc[s, "prev"], got.loc[s, "prev"]
        assert (pd.isna(e) and pd.isna(g)) or e == g


def test_flag_first_with_candidates(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "y"), ("b", 4, "x")], SCHEMA)
    from pyspark.sql import functions as F
    got = {r["seq"]: r["f"] for r in flag_first(df, "k", "seq", "f", F.col("v") == "y").collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


@pytest.mark.parametrize("together", [1, 3, 1 << 16])
def test_carries_over_groups_of_chunks(spark, monkeypatch, together):
    """A sparse seq: every row is a chunk of its own, few chunks are a group."""
    from tessera.operators import ordering

    monkeypatch.setattr(ordering, "CHUNKS_TOGETHER", together)
    rng = random.Random(together)
    rows = [(s, rng.choice(["a", "a", "b", None]), rng.choice([1, 2, 5, None])) for s in rng.sample(range(-2000, 100_000), 120)]
    df = spark.createDataFrame(rows, "seq long, k string, v int").repartition(3)
    before, last = {}, {}
    means, seen = {}, {}
    for s, k, v in sorted(rows):
        before[s] = last.get(k)
        last[k] = v
        seen.setdefault(k, []).append(v)
        window = [x for x in seen[k][-3:] if x is not None]
        means[s] = (len(seen[k]), sum(window) / len(window) if window else None)
    got = {r.seq: r.p for r in ordering.previous_in_key(df, "k", "seq", "v", "p", chunk_width=16).collect()}
    assert got == before
    out = ordering.trailing_mean_in_key(df, "k", "seq", "v", 3, "m", chunk_width=16).collect()
    assert {r.seq: r.position for r in out} == {s: n for s, (n, _) in means.items()}
    for r in out:
        want = means[r.seq][1]
        assert (r.m is None) == (want is None) and (want is None or abs(float(r.m) - want) <= 0.0051)


def test_no_window_holds_a_row_for_every_event_of_a_key(spark, monkeypatch):
    from tessera.operators import ordering

    monkeypatch.setattr(ordering, "CHUNKS_TOGETHER", 8)
    chunks = spark.range(400).selectExpr("'hot' AS k", "id AS __chunk", "id * 10 AS t")
    out = ordering._earlier_chunk(chunks, ["k"], "t", "before")
    assert {r["__chunk"]: r.before for r in out.collect()} == {k: None if k == 0 else (k - 1) * 10 for k in range(400)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("__group") > 2 and "Window [lag(" in plan
