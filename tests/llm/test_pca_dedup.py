import numpy as np

from tessera.llm.pca_dedup import compare, embedding_components
from tests_llm_util import brute_components


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def linked(a, b):
    if not good(a) or not good(b) or len(a) != len(b):
        return False
    a, b = (np.array(v, dtype=float) / max(map(abs, v)) for v in (a, b))
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)) >= 0.95


def expected(rows):
    comp = brute_components(rows, linked)
    n = [sum(linked(v, w) for k, (_, w) in enumerate(rows) if k != i) for i, (_, v) in enumerate(rows)]
    return sorted(((i, k, c, i == c) for (i, _), k, c in zip(rows, n, comp)), key=str)


def cluster(rng, n, d, spread, centres):
    base = rng.normal(size=(centres, d))
    return base[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, d))


def test_compare_equals_all_pairs():
    rng = np.random.default_rng(1)
    for d in (2, 16, 40, 64):
        a, b = cluster(rng, 300, d, 0.25, 12), cluster(rng, 200, d, 0.25, 12)
        a = np.vstack([a, b[:20]])
        turn = np.linalg.eigh(a.T @ a)[1][:, ::-1]
        norm = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
        i, j = compare(a, b, turn, 0.95, False)
        assert set(zip(i, j)) == set(zip(*np.nonzero(norm(a) @ norm(b).T >= 0.95))) and len(i)
        i, j = compare(a, a, turn, 0.95, True)
        assert set(zip(i, j)) == {(p, q) for p, q in zip(*np.nonzero(norm(a) @ norm(a).T >= 0.95)) if p < q}


def test_components_match_brute_force(spark, monkeypatch):
    import tessera.llm.pca_dedup as module

    monkeypatch.setattr(module, "TILE", 40)
    rng = np.random.default_rng(2)
    vectors = np.vstack([cluster(rng, 200, 12, 0.15, 40), cluster(rng, 60, 12, 0.08, 1)]).tolist()
    vectors += [vectors[0]] * 25 + [[3 * x for x in vectors[1]], [1e-200 * x for x in vectors[2]], [0.0] * 12, [0.0] * 12, [-0.0] * 12, None, [], [float("nan")] * 12, [1.0, None] * 6, [float("inf")] * 12, [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 3.0]]
    rows = [(k, v) for k, v in enumerate(vectors)]
    rows += [(3, vectors[3]), (None, vectors[4]), (None, [5.0, -7.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int").repartition(4)
    got = sorted(map(tuple, embedding_components(df).collect()), key=str)
    assert got == expected(rows)


def test_floats_and_empty(spark):
    rows = [(1, [1.0, 0.5]), (2, [1.0, 0.5]), (9, [0.5, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, embedding_components(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (9, 0, 9, True)]
    assert embedding_components(df.limit(0)).collect() == []


def test_no_tile_is_exchanged_for_its_pairs(spark, monkeypatch):
    """Pairs of tiles grow with the square of the vectors; what tasks write to
    each other must not. Every pair of tiles that may hold links comes once."""
    import tessera.llm.pca_dedup as module

    monkeypatch.setattr(module, "TILE", 10)
    plans, made, plain = {}, [], module.staged

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        out = plain(df, label)
        made.extend([out] if label == "tiles" else [])
        return out

    monkeypatch.setattr(module, "staged", watched)
    rng = np.random.default_rng(3)
    vectors = cluster(rng, 300, 12, 0.15, 30).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(3)
    assert sorted(map(tuple, embedding_components(df).collect()), key=str) == expected(list(enumerate(vectors)))
    assert "Exchange" not in plans["vector-links"] and "Exchange" in plans["tiles"]
    held = {r.tile: np.frombuffer(r.x).reshape(-1, 12) for r in made[0].collect()}
    pairs = [(r.a_tile, r.b_tile) for r in module.tile_pairs(made[0], 0.95).collect()]
    assert len(held) > 20 and len(pairs) == len({frozenset(p) for p in pairs})
    linked_tiles = {frozenset((s, t)) for s, a in held.items() for t, b in held.items() if any(linked(v, w) for v in a for w in b)}
    assert linked_tiles <= {frozenset(p) for p in pairs}
