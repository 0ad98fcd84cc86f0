"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import table
from tessera.llm.divergence import CLASSES, COMMON_WORDS, MAX_CLASS_DISTANCE, MIN_CHARS, MIN_WORDS, WORD_BASE, WORD_NOISE, WORDS
from tessera.operators.parallel import spread


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a scan of fewer tasks than cores is dealt over them."""
    return spread(table(spark, sf_dir, "documents"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash import simhash_components

    return simhash_components(documents(spark, sf_dir), shingle=3, distance=2)


def op2_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.hpylm import scores

    return scores(documents(spark, sf_dir))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"), least=0)


def op4_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.divergence import quality_rules

    return quality_rules(documents(spark, sf_dir)).drop("class_distance", "word_distance")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.pii import personal_data

    return personal_data(documents(spark, sf_dir))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.pca_dedup import embedding_components

    return embedding_components(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op7_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessera.llm.bpe import encode_digests

    return encode_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessera.llm.token_count import token_counts

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.rules import quality_scores

    return quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessera.llm.packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessera.llm.alignment import align

    a, b = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(documents(spark, sf_dir), a, b, digest=True)


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.source_audit import source_divergence

    return source_divergence(documents(spark, sf_dir), least_docs=30, top=50)


def op13_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessera.llm.merge_automaton import encode_digests

    return encode_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_hpylm": op2_hpylm,
    "op3_warc": op3_warc,
    "op4_divergence": op4_divergence,
    "op5_personal_data": op5_personal_data,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_prefix_bpe": op7_prefix_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_rule_ensemble": op9_rule_ensemble,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_merge_automaton": op13_merge_automaton,
}

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"  # fixed value: the base-32 alphabet

_SPACES = r"[\x20\x09-\x0D]+"
_COUNT = {"lower": "[^a-z]+", "space": r"[^\x20\x09-\x0D]+", "upper": "[^A-Z]+", "digit": "[^0-9]+", "symbol": "[^#*$%&|<>]+",
          "ascii": r"[a-zA-Z0-9#*$%&|<>\x20\x09-\x0D]+|[^\x00-\x7F]+", "other": r"[\x00-\x7F]+"}  # what is not of the class


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
  list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM d, unnest(range(1, CAST(len(w) AS BIGINT) - 1)) AS u(i)),
twice AS (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1),
cover AS (SELECT r, count(DISTINCT i + o) AS n FROM win JOIN twice USING (r, s), (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
dup AS (SELECT r, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n FROM
  (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d)),
f AS (SELECT d.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, length(t) AS chars, coalesce(cover.n, 0) AS n_repeat_words, dup.n AS n_dup_lines,
  [{", ".join(f"CAST(length(regexp_replace(t, '{p}', '', 'g')) AS BIGINT)" for p in _COUNT.values())}] AS classes,
  list_transform({_sql_list(WORDS)}, lambda c: CAST(len(list_filter(w, lambda x: x = c)) AS BIGINT)) AS common
  FROM d JOIN dup USING (r) LEFT JOIN cover USING (r)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, list_append(common, n_words - CAST(list_sum(common) AS BIGINT)) AS words FROM f),
h AS (SELECT r, lang, base_failed, n_words, chars, kind, k, v FROM
  (SELECT r, lang, base_failed, n_words, chars, 'c' AS kind, unnest(range(1, {len(CLASSES) + 2})) AS k, unnest(classes) AS v FROM g
   UNION ALL SELECT r, lang, base_failed, n_words, chars, 'w', unnest(range(1, {len(WORDS) + 2})), unnest(words) FROM g)),
q AS (SELECT lang, kind, k, sum(v) / sum(sum(v)) OVER (PARTITION BY lang, kind) AS q FROM h
  WHERE NOT base_failed AND list_contains({_sql_list(sorted(COMMON_WORDS))}, lang) GROUP BY lang, kind, k),
p AS (SELECT r, kind, k, v / CASE WHEN kind = 'c' THEN chars ELSE n_words END AS p FROM h
  WHERE CASE WHEN kind = 'c' THEN chars >= {MIN_CHARS} ELSE n_words >= {MIN_WORDS} END),
j AS (SELECT r, q.lang, kind, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 0)) AS js
  FROM p JOIN q USING (kind, k) GROUP BY r, q.lang, kind),
m AS (SELECT r, min(js) FILTER (WHERE kind = 'c') AS cd, min(js) FILTER (WHERE kind = 'w') AS wd FROM j GROUP BY r)
SELECT doc_id, n_words, CAST(chars - classes[2] AS BIGINT) AS word_chars, classes[5] AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(cd, 0) > {MAX_CLASS_DISTANCE} OR coalesce(wd, 0) > {WORD_BASE} + {WORD_NOISE} / n_words) AS kept
FROM g LEFT JOIN m USING (r)"""

_AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
lt AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS total FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gt.lang, gt.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (gt.total + 5 * lt.v) AS p,
  1 + 1000000000::HUGEINT * (kept.c + 5) // (lt.total + 5 * lt.v) AS q
  FROM gt JOIN lt USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""

ORACLE: dict[str, str] = {
    "op12_divergence_audit": _AUDIT_SQL,
    "op4_divergence": _DIVERGENCE_SQL,
    "op3_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
t AS (SELECT h, max(page_id) AS top FROM p GROUP BY h),
r AS (SELECT p.page_id, p.h, sha1(p.h) AS hex, t.top FROM p JOIN t USING (h))
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr({_BASE32}, CAST(((list_sum(list_transform(range(0, 5), lambda k:
      CAST((instr('0123456789abcdef', substr(hex, CAST(5 * g + k + 1 AS BIGINT), 1)) - 1) AS BIGINT) << CAST(4 * (4 - k) AS BIGINT)))::BIGINT >> s) & 31) + 1 AS BIGINT), 1)), '')), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM r""",
    "op6_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.95),
reach(vec_id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM reach r JOIN link l ON l.a = r.vec_id),
least AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)""",
}
