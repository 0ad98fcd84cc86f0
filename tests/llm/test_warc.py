import gzip
import hashlib
import random
from base64 import b32encode
from collections import defaultdict
from pathlib import Path

import pytest

from tessera.llm.warc import CHUNK_BYTES, archive_round_trip, classified, read_archives, write_archives


def rows():
    rng = random.Random(5)
    big = "".join(rng.choice("abcé日 \r\n") for _ in range(3 * CHUNK_BYTES))
    out = [(1, "http://a/1", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\nWARC/1.1", "<p>y</p>\r\n\r\nWARC/1.1\r\n"), (4, "b", None), (5, "c", ""), (6, "d", big), (7, "e", big), (8, "f", big + "!"),
           (None, "n", "<p>x</p>"), (None, "n", "only null"), (9, "g", "same"), (9, "g", "same"), (10, "z", "x" * CHUNK_BYTES), (11, "z", "x" * (CHUNK_BYTES + 1))]
    return out + [(100 + i, "hot", "hot payload") for i in range(60)]


def expected(data):
    top = {}
    for i, _, h in data:
        h = h or ""
        if i is not None:
            top[h] = max(top.get(h, i), i)
    out = []
    for i, _, h in data:
        b = (h or "").encode()
        t = top.get(h or "")
        out.append((i, len(b), b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == t else "revisit", None if i == t else t))
    return sorted(out, key=str)


def frame(spark, data):
    return spark.createDataFrame([(i, u, h, "q") for i, u, h in data], "page_id long, url string, html string, record_type string").repartition(3)


def test_round_trip(spark):
    data = rows()
    assert sorted(map(tuple, archive_round_trip(frame(spark, data)).collect()), key=str) == expected(data)
    assert archive_round_trip(frame(spark, [])).collect() == []


def test_chunk_table_rebuilds_payloads(spark, tmp_path):
    data = [r for r in rows() if r[0] is not None and r[0] < 9]
    manifest = write_archives(classified(frame(spark, data)), f"file://{tmp_path}/w")
    chunks = read_archives(spark, manifest).collect()
    by = defaultdict(dict)
    for c in chunks:
        assert len(c.data or b"") <= CHUNK_BYTES
        by[c.page_id][c.chunk] = c
    html = {i: (h or "").encode() for i, _, h in data}
    for i, parts in by.items():
        if parts[0].record_type == "response":
            body = b"".join(parts[k].data for k in range(len(parts)))
            assert body == html[i]
            so_far = b""
            for k in range(len(parts)):
                so_far += parts[k].data
                assert parts[k].bytes_so_far == len(so_far)
                assert parts[k].digest_so_far == b32encode(hashlib.sha1(so_far).digest()).decode()
            assert [parts[k].last for k in range(len(parts))] == [False] * (len(parts) - 1) + [True]
    assert len(by[8]) == -(-len(html[8]) // CHUNK_BYTES) > 3
    stored = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path, "w").glob("*.warc.gz"))
    assert stored.count(b"WARC-Type: revisit") == sum(1 for r in expected(data) if r[3] == "revisit")


def test_damage_is_noticed(spark, tmp_path):
    manifest = write_archives(classified(frame(spark, [(1, "u", "hello world")])), f"file://{tmp_path}/w")
    (path,) = Path(tmp_path, "w").glob("*.warc.gz")
    path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"hello", b"jello")))
    with pytest.raises(Exception, match="does not match its digest"):
        read_archives(spark, manifest).collect()


def test_least_bytes_keeps_small_payloads(spark):
    out = archive_round_trip(frame(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), least=3).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in out) == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]
