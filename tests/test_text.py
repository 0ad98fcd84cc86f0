import pytest

from tessera.operators import text as T

SCHEMA = "doc_id long, text string"


def run(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), SCHEMA)
    return {r["doc_id"]: r for r in T.clean_and_score(df).collect()}


def test_cleaning(spark):
    r = run(spark, ["\t Rain; again (MONDAY)?  ", "x  y\r\nz", "Über  naïve-9"])
    assert r[0]["clean_text"] == "rain again monday"
    assert r[1]["clean_text"] == "x y z"
    assert r[2]["clean_text"] == "ber nave9"


def test_guards(spark):
    r = run(spark, [None, "", "   ", "?!", " "])
    assert (r[0]["error_stage"], r[0]["error_code"]) == ("cleaning", "null_text")
    assert (r[1]["error_stage"], r[1]["error_code"]) == ("cleaning", "empty_text")
    assert (r[2]["error_stage"], r[2]["error_code"]) == ("cleaning", "empty_text")
    assert (r[3]["error_stage"], r[3]["error_code"]) == ("analysis", "empty_after_cleaning")
    assert r[4]["error_stage"] == "cleaning"  # non-breaking space is whitespace


@pytest.mark.parametrize("text,label,score", [
    ("This is good and excellent", "positive", 1),
    ("bad and terrible", "negative", -1),
    ("nothing here", "neutral", 0),
    ("good but bad", "neutral", 0),
    ("goodness badly", "neutral", 0),
])
def test_sentiment(spark, text, label, score):
    r = run(spark, [text])[0]
    assert (r["sentiment"], r["score"]) == (label, score)


def test_clean_matches_python_for_every_code_point(spark):
    import re
    from pyspark.sql import functions as F
    from tessera.functions.text import clean_text
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    # each code point framed by letters so deletions / whitespace are visible
    rows = [(i, f"A{c}b {c}{c} Z") for i, c in enumerate(chars)]
    got = dict(spark.createDataFrame(rows, "i long, t string").select("i", clean_text(F.col("t")).alias("c")).collect())
    for i, c in enumerate(chars):
        t = f"A{c}b {c}{c} Z"
        exp = re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", "", t.lower())).strip()
        assert got[i] == exp, (hex(ord(c)), got[i], exp)


def test_strip_and_blank_match_python_for_every_code_point(spark):
    from pyspark.sql import functions as F
    from tessera.functions.text import py_is_blank, py_strip
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    rows = [(i, f"{c}{c}x{c}y{c}", f"{c}{c}") for i, c in enumerate(chars)]
    got = {r["i"]: (r["s"], r["b"]) for r in spark.createDataFrame(rows, "i long, t string, u string").select(
        "i", py_strip(F.col("t")).alias("s"), py_is_blank(F.col("u")).alias("b")).collect()}
    for i, c in enumerate(chars):
        assert got[i] == (f"{c}{c}x{c}y{c}".strip(), not f"{c}{c}".strip()), hex(ord(c))
