"""Registered text queries (clean, sentiment, quarantine) and SQL oracles."""

from __future__ import annotations

from tessera.operators import text as T
from tessera.operators.parallel import spread
from tessera.plans.sqlfrag import clean_text, py_blank
from tessera.plans.tables import view, with_views


def _scored(spark, sf):
    return T.clean_and_score(spread(view(spark, sf, "text_v")))


QUERIES = {
    "text_clean": lambda spark, sf: T.clean(spread(view(spark, sf, "text_v"))).select("doc_id", "clean_text"),
    "text_sentiment": lambda spark, sf: T.split_outcomes(_scored(spark, sf))[0]
    .select("doc_id", "score", "sentiment"),
    "text_quarantine": lambda spark, sf: T.split_outcomes(_scored(spark, sf))[1]
    .select("doc_id", "error_stage", "error_code"),
    "text_clean_sentiment": lambda spark, sf: _scored(spark, sf)
    .select("doc_id", "lang", "clean_text", "score", "sentiment", "error_stage", "error_code"),
}

_C = f"""c AS (SELECT doc_id, lang, text,
       CASE WHEN NOT {py_blank('text')} THEN {clean_text('text')} END AS clean_text FROM text_v),
s AS (SELECT *,
       CASE WHEN text IS NULL THEN 'null_text' WHEN {py_blank('text')} THEN 'empty_text'
            WHEN {py_blank('clean_text')} THEN 'empty_after_cleaning' END AS error_code,
       CASE WHEN {py_blank('text')} THEN 'cleaning' WHEN {py_blank('clean_text')} THEN 'analysis' END
         AS error_stage,
       CASE WHEN NOT {py_blank('clean_text')} THEN
         CAST((CASE WHEN list_has_any(string_split(clean_text, ' '), ['good', 'excellent']) THEN 1 ELSE 0 END)
            - (CASE WHEN list_has_any(string_split(clean_text, ' '), ['bad', 'terrible']) THEN 1 ELSE 0 END)
            AS INTEGER) END AS score
  FROM c),
r AS (SELECT *, CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative'
                     WHEN score = 0 THEN 'neutral' END AS sentiment FROM s)"""

ORACLE = {
    "text_clean": with_views(f", {_C} SELECT doc_id, clean_text FROM c", "text_v"),
    "text_sentiment": with_views(f", {_C} SELECT doc_id, score, sentiment FROM r WHERE error_stage IS NULL",
                                 "text_v"),
    "text_quarantine": with_views(
        f", {_C} SELECT doc_id, error_stage, error_code FROM r WHERE error_stage IS NOT NULL", "text_v"),
    "text_clean_sentiment": with_views(
        f", {_C} SELECT doc_id, lang, clean_text, score, sentiment, error_stage, error_code FROM r", "text_v"),
}
