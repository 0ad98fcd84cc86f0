import os
import random

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm.common import staged
from tessera.llm.divergence import quality_rules
from tessera.llm.pii import base_spans
from tessera.llm.rules import statistics
from tessera.llm.simhash import fingerprint
from tests_llm_util import brute_components

D = "/root/testdata/sf0.001"


def test_stage_list_matches_the_queries(spark):
    import __spark_entry__

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_dedup", "personal_data", "best_fit_packing"]
    assert "pipeline" in __spark_entry__.queries() and corpus_pipeline.ORACLE_SQL is None


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    step = dict(corpus_pipeline.STAGES)

    kept = staged(step["quality_rules"](spark, docs, D), "t")
    verdict = {r.doc_id for r in quality_rules(docs).where("kept").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == verdict

    good = staged(step["quality_classifier"](spark, kept, D), "t")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    ids = {r.doc_id for r in good.collect()}
    clean = {i for i in verdict if labels.get(i) == 1}
    assert good.columns == columns and len(clean & ids) >= 0.97 * len(clean)

    alone = staged(step["simhash_dedup"](spark, good, D), "t")
    rows = [(r.doc_id, fingerprint(r.text)) for r in good.collect()]
    parts = brute_components(rows, lambda a, b: (a ^ b).bit_count() <= 2)
    assert alone.columns == columns and sorted(r.doc_id for r in alone.collect()) == sorted(set(parts))

    safe = staged(step["personal_data"](spark, alone, D), "t")
    before = {r.doc_id: r.text for r in alone.collect()}
    after = safe.collect()
    assert safe.columns == columns and len(after) == len(before)
    for r in after:
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if r.text != before[r.doc_id]:
            assert "[" in r.text
    assert any(base_spans(t) for t in before.values())

    packed = step["best_fit_packing"](spark, safe, D).collect()
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    total = sum(len(lib.encode(r.text, add_special_tokens=False).ids) + 1 for r in after)
    assert sum(r.length for r in packed) == total and {r.doc_id for r in packed} == set(before)


def test_stages_take_odd_rows(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdeinorst") for _ in range(5)) + (" the of" if k % 4 == 0 else "") for k in range(90))
    rows = [(1, text, "en", "s", 1, "x"), (1, text, "en", "s", 1, "x"), (None, text + " z", None, None, None, None), (2, None, "en", "s", 0, "x"), (3, "", "en", "s", 0, "x"), (4, text[::-1], "en", "s", 9, "x"), (4, text, "en", "s", 9, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, D), "odd")
            if name == "simhash_dedup" and data:
                left = [(r.doc_id, r.text) for r in docs.collect()]
                assert len({t for _, t in left}) == len(left)
        assert (docs.count() > 0) == bool(data)


def test_statistics_of_masked_text_are_finite():
    assert all(x == x for x in statistics("[EMAIL] x"))


def clean_text(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeinorst") for _ in range(5)) + (" the of" if k % 4 == 0 else "") for k in range(90))


def test_one_text_in_two_languages_is_judged_twice(spark):
    """A document is rejected in a language it is far from and kept in one
    without a reference; rows of one id and text do not share the verdict."""
    far = " ".join("1234 5678 9012" for _ in range(3)) + " " + " ".join(str(k * 7919) for k in range(300))
    rows = [(k, clean_text(k), "en", "s", 1) for k in range(60)] + [(100, far, "en", "s", 1), (100, far, "ru", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.lang) for r in dict(corpus_pipeline.STAGES)["quality_rules"](spark, docs, D).collect() if r.doc_id == 100]
    assert kept == [(100, "ru")]


def test_stages_keep_columns_of_any_name(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __id string, __hash long, __row string, __n_words double, _kept int, part string, own string, w string"
    rows = [(k, clean_text(k), "en", "s", 1, f"i{k}", k, f"r{k}", k / 2, k, "p", "o", "w") for k in range(40)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, D)
        assert got.columns == docs.columns
        left = [tuple(r) for r in got.collect()]
        if name != "personal_data":
            assert left and set(left) <= set(rows), name
        else:
            assert sorted(x[5:] for x in left) == sorted(x[5:] for x in rows)
