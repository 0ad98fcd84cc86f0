import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm.divergence import CLASSES, COMMON_WORDS, WORDS, distance, features, quality_rules, references

LONG = "doc_id long, text string, lang string, kept string"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(win)
    covered = {p for i, x in enumerate(win) if n[x] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def corpus():
    rng = random.Random(6)
    rows = [(0, None, "en", "x"), (1, "", "en", "x"), (2, " \n\t\n", None, "x"), (3, "a b", "xx", "x"), (None, "the of", "en", "x")]
    for k in range(90):
        words = [rng.choice(COMMON_WORDS["en"]) if rng.random() < 0.4 else "".join(rng.choice("abcdehinorst") for _ in range(rng.randint(2, 9))) for _ in range(rng.choice([60, 150, 600]))]
        rows.append((10 + k, " ".join(words), "en", "x"))
        if k % 40 == 0:
            rows += [(1000 + k, " ".join(w + "%%%" for w in words), "en", "x"), (2000 + k, " | ".join(w for w in words if w not in COMMON_WORDS["en"]), "en", "x"),
                     (3000 + k, " ".join(w.upper() + "!!" for w in words), "en", "x"), (4000 + k, ("\n".join(" ".join(words[:30]) for _ in range(9))), "en", "x")]
    rows.append((900, "a b c a b c\x0bd e f\n" * 30 + "é \xa0 z\n\n x\n x", "en", "x"))
    rows.append((901, " ".join(str(rng.randint(0, 5000)) for _ in range(30000)), "xx", "x"))
    return rows + [rows[7], rows[7]]


def test_base_counts_match_brute_force(spark):
    rows = corpus()
    out = quality_rules(spark.createDataFrame(rows, LONG).repartition(4)).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)


def test_junk_goes_and_clean_text_stays(spark):
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(corpus(), LONG)).collect()}
    for i, r in out.items():
        if i is not None and 10 <= i < 100 and r.n_words > 100:
            assert r.kept, r
        elif i is not None and i >= 1000 and r.n_words >= 150:
            assert not r.kept, r


def test_distance_matches_brute_force(spark):
    p, q = [5, 0, 3, 2], [1, 1, 0, 8]
    P, Q = [x / 10 for x in p], [x / 10 for x in q]
    js = sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(P, Q)) / 2
    got = spark.range(1).select(distance(F.lit(p).cast("array<bigint>"), q).alias("d")).first().d
    assert abs(got - math.sqrt(js)) < 1e-12


def test_histograms_and_references(spark):
    rows = [(1, "The the of LA 12 #é\t." + " the dog" * 60, "en", "x"), (2, "x", "en", "x")]
    feats = features(spark.createDataFrame(rows, LONG)).orderBy("doc_id").collect()
    assert dict(zip([c for c, _ in CLASSES] + ["other"], feats[0].classes))["digit"] == 2 and sum(feats[0].classes) == len(rows[0][1])
    assert dict(zip(WORDS, feats[0].common))["the"] == 61 and sum(feats[0].common) == feats[0].n_words
    assert references(features(spark.createDataFrame([], LONG))) == {}


def test_empty_table_and_no_language(spark):
    assert quality_rules(spark.createDataFrame([], LONG)).collect() == []
    out = quality_rules(spark.createDataFrame([(1, "word " * 10 + " ".join(map(str, range(90))), None, "x")], LONG)).collect()
    assert [r.kept for r in out] == [True]


def test_other_languages_have_references_of_their_own(spark):
    """Clean text of other scripts stays, its junk goes; a language of which
    there is little is left to the base rules, one of the lists is not."""
    rng = random.Random(8)
    prose = lambda letters, n=150: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))
    cyrillic, greek = "абвгдежзиклмнопрстуя", "αβγδεζηθικλμνοπρστ"
    junk = " ".join(f"{rng.randint(0, 5000)}#|%" for _ in range(150))
    rows = [r for r in corpus() if r[2] == "en"]
    clean = [(5000 + k, prose(cyrillic), "ru", "x") for k in range(40)] + [(5100, prose(greek), "el", "x"), (5101, prose(cyrillic), None, "x")]
    bad = [(6000, junk, "ru", "x"), (6001, prose(cyrillic), "en", "x"), (6002, junk, None, "x")]
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows + clean + bad, LONG)).collect()}
    assert all(out[r[0]].kept for r in clean)
    assert not any(out[r[0]].kept for r in bad)
    assert out[5000].class_distance < 0.2 and out[5000].word_distance is None
    assert out[5100].class_distance is None and out[5101].word_distance is None
