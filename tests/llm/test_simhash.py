import random

import xxhash

from tessera.llm.simhash import GrayIndex, fingerprint, gray_rank, node_masks, simhash_components
from tests_llm_util import brute_components

import numpy as np


def brute_fingerprint(text):
    words, cur = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += ch.lower() if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    sh = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_fingerprint_matches_brute_force():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        t = " ".join(rng.choice(["The", "of", "É", "a b", "x\x1cy", "Z"]) for _ in range(n)) + rng.choice(["", "\n", "\x0b "])
        assert fingerprint(t) == brute_fingerprint(t)


def test_spark_xxhash_agrees(spark):
    v = spark.sql("select xxhash64('a b c') h").first().h
    assert v % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_node_masks_lose_no_pair():
    rng = random.Random(2)
    masks = node_masks(2)
    for _ in range(3000):
        d = 0
        for b in rng.sample(range(64), rng.randint(0, 2)):
            d |= 1 << b
        assert any(d & m == 0 for m in masks)


def test_gray_index_matches_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = set()
    for b in base:
        for _ in range(300):
            x = int(b)
            for k in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(k)
            fps.add(x)
    fp = np.array(sorted(fps), dtype=np.uint64)
    group = (fp & np.uint64(3)).astype(np.int64)
    order = np.lexsort((gray_rank(fp), group))
    fp, group = fp[order], group[order]
    got = {(int(a), int(b)) for i, j in GrayIndex(fp, group).within(2) for a, b in zip(i, j)}
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if group[i] == group[j] and int(fp[i] ^ fp[j]).bit_count() <= 2}
    assert got == want and want


def corpus():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "one two"), (4, "one two"), (5, "Two ONE")]
    for k in range(12):
        base = [rng.choice(vocab) for _ in range(120)]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((100 + len(rows), " ".join(w)))
    rows.append((900, " ".join(rng.choice(vocab) for _ in range(60000))))
    return rows


def test_components_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, fp int, component_id string").repartition(5)
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash_components(df).collect())
    fp = {t: brute_fingerprint(t) for _, t in rows}
    want = brute_components([(i, fp[t]) for i, t in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    assert got == sorted((i, f"{fp[t]:016x}", c) for (i, t), c in zip(rows, want))
    assert len({c for _, _, c in got}) < len(rows) - 20


def test_empty_and_all_alone(spark):
    schema = "doc_id long, text string"
    assert simhash_components(spark.createDataFrame([], schema)).collect() == []
    out = simhash_components(spark.createDataFrame([(5, "alpha beta gamma delta"), (None, "q")], schema)).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(5, 5), (None, None)}
