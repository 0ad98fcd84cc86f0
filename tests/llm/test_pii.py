import hashlib
import random
import re

import numpy as np

from tessera.llm.pii import ADDED, BASE, KINDS, SpanClassifier, base_spans, candidates, expectation_maximisation, luhn, masked, personal_data, redacted

RAW = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, kind in enumerate(BASE):
        for m in re.finditer(RAW[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((k, m.start(), m.end()))
    return out


def test_luhn():
    assert luhn("4532015112830366") and not luhn("4532015112830367")


def test_base_spans_equal_the_plain_patterns():
    import duckdb

    rng = random.Random(8)
    texts = ["", "a@b.c", "@a@b.c@d.e.f", "x@@y.z", "a@b", "a@b..c", "1.2.3.4.5.6.7.8", "01.002.255.0256 1.1.1.1.", "999.1.1.1 1.2.3.4", "4532 0151-1283 0366 ", "+1 (269) 555-3296 4524132264652876", "+49 30 123456  + 1", "é+12345678901234567", "a.b%c+d-e@f-g.h-i.", "4532015112830366" * 3]
    texts += ["".join(rng.choice("ab1259.@+- ()é\n%_") for _ in range(rng.randint(1, 120))) for _ in range(4000)]
    texts += [t for (t,) in duckdb.connect().execute("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    for t in texts:
        assert base_spans(t) == brute(t), t[:200]


def test_very_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1" * 100_000, "a@" * 100_000, "+1 " + "(" * 200_000, "=" * 50_000, "0123-" * 50_000, "=abcdef1 " * 30_000):
        candidates(t, base_spans(t))


def test_em_finds_reliable_labelers():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.4
    right = [0.95, 0.9, 0.85, 0.6]
    votes = np.stack([np.where(rng.random(4000) < r, np.where(truth, 1, -1), np.where(truth, -1, 1)) for r in right], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, index, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, table = expectation_maximisation(patterns.astype(float), n.astype(float))
    assert ((post[index.ravel()] > 0.5) == truth).mean() > 0.93
    plus = table[1, :, 2] / (table[1, :, 0] + table[1, :, 2])
    assert plus[0] > plus[3] and plus[1] > plus[3]


def planted():
    rng = random.Random(4)
    rows, spans = [], {}
    filler = lambda n: " ".join("".join(rng.choice("abcdehinorst") for _ in range(rng.randint(2, 8))) for _ in range(n))
    for i in range(120):
        hidden = [f'token = "{rng.getrandbits(160):040x}"', "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), f"password={rng.getrandbits(48):012x}", "+1 (269) 555-3296 4532015112830366", f"j.doe{i}@mail.example.com", f"10.{i}.3.4"][i % 6]
        rows.append((i, filler(20) + " " + hidden + " " + filler(20)))
        spans[i] = re.findall(r"[0-9a-f]{40}|AKIA\w+|(?<=password=)\w+|4532\d+|j\.doe\S+|10\.\d+\.3\.4", hidden)[0]
    return rows + [(500 + i, filler(60) + ": the end. " + filler(5)) for i in range(100)], spans


def test_planted_data_is_found_and_clean_texts_left_alone(spark):
    rows, hidden = planted()
    text = dict(rows)
    out = {r.doc_id: r for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, value in hidden.items():
        found = [text[i][int(a) : int(b)] for _, a, b in (x.split(":") for x in out[i].spans.split(","))]
        assert any(value in f for f in found), (i, value, out[i].spans)
    assert all(out[i].spans == "" for i in text if i >= 500)


def test_rows_and_digests(spark):
    rows = [(1, "a@b.co 1.2.3.4"), (1, "a@b.co 1.2.3.4"), (None, "x 4532015112830366"), (2, None), (3, ""), (4, "é +1 (269) 555-3296 z")]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, spans string").repartition(3)
    got = sorted(map(tuple, personal_data(df).collect()), key=str)
    want = []
    for i, t in rows:
        base = brute(t or "")
        joined = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
        want.append((i, *([k for k, _, _ in base].count(n) for n in range(4)), hashlib.sha256(joined.encode()).hexdigest(), joined))
    assert got == sorted(want, key=str)
    assert personal_data(df.limit(0)).collect() == []
    assert SpanClassifier([]).accepts(len(BASE), "000000", "000") is False and len(ADDED) == 5


def test_masking(spark):
    assert masked("mail a@b.co now", base_spans("mail a@b.co now")) == "mail [EMAIL] now"
    assert masked("abcdef", [(0, 1, 4), (1, 3, 5)]) == "a[EMAIL]f"
    df = spark.createDataFrame([(1, "x a@b.co y 1.2.3.4"), (2, None), (3, "plain")], "doc_id long, text string")
    assert {r.doc_id: r.t for r in df.select("doc_id", redacted(df).alias("t")).collect()} == {1: "x [EMAIL] y [IP]", 2: None, 3: "plain"}


def test_long_secrets_are_candidates():
    from tessera.llm.pii import KINDS, candidates

    for span in ("eyJ" + "aB3x" * 75, "Zk9_" * 50000):
        got = candidates(f"token={span} end", [])
        assert [(KINDS[k], s, e) for k, s, e, _, _ in got] == [("secret", 6, 6 + len(span))]
    for span in ("0123456789abcdef" * 20, "ghp_" + "a1B2" * 100, "sk_live_" + "a1B2" * 100):
        assert [(KINDS[k], s, e) for k, s, e, _, _ in candidates(f"see {span} end", [])] == [("secret", 4, 4 + len(span))]


def test_the_checksum_labeler_votes_on_every_card_candidate():
    from tessera.llm.pii import KINDS, LABELERS, candidates

    votes = {t: [v[LABELERS.index("checksum")] for k, _, _, v, _ in candidates(f"card {t} end", []) if KINDS[k] == "card_part"] for t in ("4111 1111 1111 1111", "4111 1111 1111 1112")}
    assert votes == {"4111 1111 1111 1111": ["+"], "4111 1111 1111 1112": ["-"]}
