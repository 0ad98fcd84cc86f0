import hashlib
import os
import random
from itertools import product

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import public_tokenizers as P
import pytest
from test_tokens import ODD, texts
from tokenizers import Tokenizer

from tessera.llm.merge_automaton import MergeAutomaton, codec, decode_ids, encode_digests, encode_ids

JSON = P.path("byte_bpe_50k.json")


def merged(data, merges):
    """Tokens of ``data`` by applying the merges in order, left to right."""
    seq = list(data)
    for a, b, ab in merges:
        out = []
        for t in seq:
            if out and (out[-1], t) == (a, b):
                out[-1] = ab
            else:
                out.append(t)
        seq = out
    return seq


@pytest.mark.parametrize("seed", range(25))
def test_automaton_accepts_what_the_merges_produce(seed):
    rng = random.Random(seed)
    spelt, merges = {k: bytes([k]) for k in range(3)}, []
    for k in range(3, 11):
        while True:
            a, b = rng.choice(list(spelt)), rng.choice(list(spelt))
            if spelt[a] + spelt[b] not in spelt.values():
                break
        merges.append((a, b, k))
        spelt[k] = spelt[a] + spelt[b]
    auto = MergeAutomaton([0, 1, 2], merges)
    for n in range(1, 7):
        for data in product(range(3), repeat=n):
            want = merged(data, merges)
            assert auto.encode(bytes(data)) == want
            assert auto.accepts(want)
    for seq in product(range(11), repeat=3):  # and accepts nothing else
        data = b"".join(spelt[t] for t in seq)
        assert auto.accepts(list(seq)) == (merged(data, merges) == list(seq))


def test_equals_the_library(spark):
    lib, c = Tokenizer.from_file(JSON), codec(JSON)
    every = texts()
    for t, e in zip(every, lib.encode_batch(every, add_special_tokens=False)):
        assert c.encode(t) == e.ids, t
        assert c.decode(e.ids).decode() == lib.decode(e.ids, skip_special_tokens=False)


def test_digests_of_odd_rows(spark):
    lib = Tokenizer.from_file(JSON)
    rows = [(k, t) for k, t in enumerate([None, *ODD, ODD[-1], "word " * 40_000, "x  y " * 9_000])] + [(None, "a b"), (1, "a b")]
    df = spark.createDataFrame([(i, t, "z", 7) for i, t in rows], "doc_id long, text string, ids string, n_tokens int").repartition(3)
    got = sorted(map(tuple, encode_digests(df, JSON).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text))))
    assert got == sorted(want, key=repr)
    assert encode_digests(df.limit(0), JSON).collect() == []


def test_round_trip_through_id_arrays(spark):
    rows = [(k, t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    back = {r.doc_id: r.text for r in decode_ids(encode_ids(df, JSON), JSON).collect()}
    assert back == dict(rows)
    broken = spark.createDataFrame([(1, [codec(JSON).automaton.token["é".encode()[:1]]]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in decode_ids(broken, JSON).collect()} == {1: "�", 2: ""}


def test_a_token_of_two_merges_is_refused():
    with pytest.raises(ValueError):
        MergeAutomaton([0, 1, 2], [(0, 1, 3), (1, 2, 4), (3, 2, 5), (0, 4, 5)])
