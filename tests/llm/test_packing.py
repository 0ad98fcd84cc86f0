import os
import random
import zlib
from collections import Counter, defaultdict
from math import ceil

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from tessera.llm.packing import SegmentIds, cut, knapsack, pack, pieces, plan

JSON = P.path("byte_bpe_50k.json")


def test_knapsack_equals_brute_force():
    lengths, price = np.array([3, 4, 7]), np.array([2.0, 3.1, 5.0])
    best, _ = knapsack(lengths, price, 20)
    want = [max(2.0 * a + 3.1 * b + 5.0 * c for a in range(7) for b in range(6) for c in range(3) if 3 * a + 4 * b + 7 * c <= s) for s in range(21)]
    assert np.allclose(best, want)


def test_plans_are_whole_and_tight():
    rng = random.Random(1)
    for case in range(6):
        hist = Counter(rng.choice([rng.randint(1, 100), rng.randint(30, 60), 100, 51]) for _ in range([0, 1, 50, 700, 5000, 20000][case]))
        chosen = plan(dict(hist), 100)
        held = Counter()
        for bins, items in chosen:
            assert bins > 0 and sum(n * c for n, c in items) <= 100
            for n, c in items:
                held[n] += bins * c
        assert held == hist
        used, least = sum(b for b, _ in chosen), max(ceil(sum(n * c for n, c in hist.items()) / 100), sum(c for n, c in hist.items() if n > 50))
        assert used <= least * 1.02 + 2


def test_segment_ids_equal_the_library():
    lib, enc = Tokenizer.from_file(JSON), SegmentIds(JSON)
    texts = ["", "a", " a  b\n c", "x <|endoftext|> y<|endoftext|>", "word, word. word " * 50, "z" * 200 + " " + "q" * 100, "é \xa0 \x1c ñ"] * 2
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_cut():
    assert cut(1, 8) == [(0, 1)] and cut(8, 8) == [(0, 8)] and cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


def test_pack_places_every_piece(spark):
    rng = random.Random(2)
    texts = [None, "", "same words here"] + ["same words here"] * 40 + [" ".join(rng.choice(["ab", "the", "of"]) for _ in range(rng.choice([5, 90, 300]))) for _ in range(60)]
    rows = [(i if i % 9 else None, t, i) for i, t in enumerate(texts)] + [(1, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length long").repartition(4)
    out = pack(df, JSON, capacity=64).collect()
    lib = Tokenizer.from_file(JSON)
    want = Counter()
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        for k, (s, n) in enumerate(cut(len(ids), 64)):
            want[(i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for seq in sequences.values():
        at = 0
        for offset, n in sorted(seq):
            assert offset == at
            at += n
        assert at <= 64
    assert len(sequences) <= ceil(sum(r.length for r in out) / 64) * 1.05 + 1
    assert pack(df.limit(0), JSON, capacity=64).collect() == []


def test_rows_of_several_blocks_keep_their_ids(spark):
    """A batch is handled in blocks of text; each row keeps its own id."""
    texts = [w * (300_000 * k) for k, w in enumerate(["ab ", "cd ", "ef gh ", "x, ", "é ", "the "])] + [None, "last"]
    df = spark.createDataFrame([(10 + i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces(df, JSON, 2048).collect())
    lib, want = Tokenizer.from_file(JSON), Counter()
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        for k, (s, n) in enumerate(cut(len(ids), 2048)):
            want[(10 + i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))] += 1
    assert got == want


def test_white_space_without_end():
    lib, enc = Tokenizer.from_file(JSON), SegmentIds(JSON)
    text = "a" + " " * 1_200_000 + "b"
    assert np.frombuffer(next(enc.encode([text])), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
