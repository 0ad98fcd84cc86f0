import hashlib
import os
import random
from collections import Counter

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tessera.llm.alignment import align, aligned_blocks, cut_ends, least_count, pair_counts
from tessera.llm.token_count import byte_alphabet

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   ", "a", "a  b ", " x", "x▁y", "▁", "<s> </s><0x41><unk>", "\x00a\tb\nc", "😀日本 q̀ Ꮳ𐌰", "<|endoftext|> x", "é¨ﬁ", "\r\n a", "a\xa0b",
    "\u0085   z", "don't we'll", "x" * 2000, "ab " * 5000, "日" * 700, "  lead", "trail  ",
]


def texts():
    rng = random.Random(3)
    parts = ["a", "be", "the", " the", " ", " ", "  ", "\n", "'s", "日", "é", "😀", "<|endoftext|>", "1", "22", "!", "\x1c", "ing", "\u0085", "ﬁ", "aaaa", "<s>", "\x00", "Ꮳ"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(400)] + ["x▁y again", "the same", "the same"]


def brute(every):
    tok, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    of_char = {c: k for k, c in enumerate(byte_alphabet())}
    name = {i: t for t, i in tok.get_vocab().items()}
    docs, count = [], Counter()
    for t in every:
        a, b = tok.encode(" " + (t or ""), add_special_tokens=False).ids, sp.encode(t or "")
        spelt = [bytes(of_char[c] for c in name[i]) for i in a], [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or any(b"".join(x) != b" " + t.encode() for x in spelt):
            docs.append(None)
            continue
        of_byte = [[k for k, x in enumerate(s) for _ in x] for s in spelt]
        links = list(dict.fromkeys(zip(*of_byte)))
        ends = [set(np.cumsum(list(map(len, s))).tolist()) for s in spelt]
        both = sorted(ends[0] & ends[1])
        parts, low = [], 0
        for stop in both:
            parts.append("|".join(",".join(str(ids[k]) for k in dict.fromkeys(o[low:stop])) for ids, o in zip((a, b), of_byte)))
            low = stop
        linked = [(a[x], b[y]) for x, y in links]
        count.update(linked)
        docs.append((len(a), len(b), len(both), linked, ";".join(parts)))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    out = [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(count[p] == top[p[1]] for p in d[3]), sum(count[p] for p in d[3]), d[4]) for d in docs]
    return out, count


@pytest.fixture(scope="module")
def case(spark):
    every = texts()
    df = spark.createDataFrame([(k, t, "x", 5) for k, t in enumerate(every)], "doc_id long, text string, pair string, rest int").repartition(3)
    return df, *brute(every)


@pytest.mark.parametrize("table", [1 << 20, 200, 0])
def test_equals_brute_force(case, table):
    df, want, _ = case
    got = {r.doc_id: tuple(r)[1:] for r in align(df, A, B, table_pairs=table).collect()}
    assert len(got) == len(want)
    for k, w in enumerate(want):
        assert got[k] == w, k


def test_digest_and_pair_counts(case):
    df, want, count = case
    got = {r.doc_id: r.groups_sha256 for r in align(df, A, B, digest=True).collect()}
    assert got == {k: hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "" for k, w in enumerate(want)}
    pairs = pair_counts(aligned_blocks(df, A, B))
    assert {(r.pair & 0xFFFFF, r.pair >> 20): r.n for r in pairs.collect()} == count
    least = least_count(pairs, 50)
    assert 0 < sum(n >= least for n in count.values()) <= 50 < sum(n >= least // 2 for n in count.values())


def test_repeated_null_and_no_rows(spark):
    df = spark.createDataFrame([(1, "the the"), (1, "the the"), (None, "the")], "doc_id long, text string")
    rows = [tuple(r) for r in align(df, A, B).collect()]
    assert sorted(map(repr, rows)) == sorted([repr((1, 2, 2, 2, 2, 2, 10, "262|272;262|272"))] * 2 + [repr((None, 1, 1, 1, 1, 1, 5, "262|272"))])
    assert align(df.limit(0), A, B).collect() == []


def test_ends_between_coarse_cuts():
    # three byte tokens of one character between two words
    cut = np.array([True, False, False, True, True])
    assert cut_ends(cut, np.array([3, 6, 6, 6, 9]), np.array([3, 1, 1, 1, 3])).tolist() == [3, 4, 5, 6, 9]
    assert cut_ends(np.array([False, True]), np.array([0, 2]), np.array([1, 1])).tolist() == [1, 2]
