import base64
import hashlib
import os
import random

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from tessera.llm.bpe import PieceEditor, encode_digests, encode_ids, vocabulary
from tessera.llm.pieces import segments
from tessera.llm.token_count import counter, token_counts

TIK, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "\n\n", "x'll y's 'sa '''s", "é́ ñandú", "日本語 テキスト", "🙂🙂 ok",
    "a\xa0b \xa0 c", "a\x1cb \x1c c", "a\x85b \x85c", "​ ᠎ x", "  a", "٣٤ 12 x1y2", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
    "<|endoftext|><|endoftext|>\n<|endoftext|> ", "<|endof text|>", "a" * 3000, " " * 500, "ab" * 400 + "\t\t" + "!?" * 300, "\r\n\r\nfoo\tbar  baz   ", "_a_b __c",
]


def texts():
    import duckdb

    rows = duckdb.connect().execute("select text from '/root/testdata/sf0.001/documents.parquet' order by doc_id").fetchall()
    rng = random.Random(7)
    mixed = ["".join(rng.choice(" \n\t'aéxs1日.<|>🙂\xa0\x1c") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    return ODD + mixed + [t for (t,) in rows]


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(TIK, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_prefix_encoding_equals_the_library():
    lib, v = library(), vocabulary(TIK)
    for t in texts():
        ids = v.encode(t)
        assert ids == lib.encode_ordinary(t), repr(t[:80])
        assert v.decode(ids) == t.encode()


def test_appends_and_edits_equal_encoding_anew():
    rng, v = random.Random(3), vocabulary(TIK)
    e, data = PieceEditor(v), b""
    for _ in range(150):
        more = rng.choice([b"the", b"ing", b" a", "é".encode(), b"tion", b"x", b"\n", b"ere"])
        e.append(more)
        data += more
        assert e.ids() == PieceEditor(v, data).ids()
    for _ in range(150):
        i = rng.randrange(len(data) + 1)
        j = min(len(data), i + rng.randrange(4))
        new = rng.choice([b"", b"q", b"there", b"ou"])
        data = data[:i] + new + data[j:]
        e.replace(i, j, new)
        assert e.data == data and e.ids() == PieceEditor(v, data).ids()
    e = PieceEditor(v, b"thereand" * 400)
    assert e.replace(8, 9, b"x") < 600


def test_merge_counts_equal_the_library():
    lib, c = Tokenizer.from_file(JSON), counter(JSON)
    for t in texts():
        assert c.count(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t[:80])


def test_segments_rebuild_the_text():
    for t in texts():
        assert " ".join(segments(t)) == t


def test_queries_keep_every_row(spark):
    rows = [(1, "the cat"), (1, "the cat"), (None, "x"), (2, None), (3, ""), (4, "word " * 5000)]
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, n_tokens string").repartition(3)
    lib = library()
    got = sorted(map(tuple, encode_digests(df, TIK).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = {t: lib.encode_ordinary(t or "") for _, t in rows}
    assert got == sorted(((i, len(ids[t]), sha(",".join(map(str, ids[t])).encode()), sha((t or "").encode())) for i, t in rows), key=str)
    hf = Tokenizer.from_file(JSON)
    want = sorted(((i, len((t or "").encode()), n := len(hf.encode(t or "").ids), n > 512) for i, t in rows), key=str)
    assert sorted(map(tuple, token_counts(df, JSON).collect()), key=str) == want
    assert token_counts(df.limit(0), JSON).collect() == [] and encode_digests(df.limit(0), TIK).collect() == []
    assert {(r.doc_id, tuple(r.ids)) for r in encode_ids(df, TIK).collect()} == {(i, tuple(ids[t])) for i, t in rows}
