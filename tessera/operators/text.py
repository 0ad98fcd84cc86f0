"""Text cleaning, lexicon sentiment and the two-stage text flow with quarantine.

All expressions are built-in string/array functions (JVM, codegen); nothing
leaves the JVM and no row stops the job: failing rows carry an error column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import clean_text, py_is_blank

# The sentiment lexicon.
POSITIVE_WORDS = ("good", "excellent")
NEGATIVE_WORDS = ("bad", "terrible")

STAGE_CLEAN = "cleaning"
STAGE_ANALYZE = "analysis"


def _lexicon(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def clean(df: DataFrame, text: str = "text", out: str = "clean_text") -> DataFrame:
    """Lower, keep [a-z0-9] and whitespace, collapse whitespace, strip.
    Rows that fail the cleaning guard (null / blank) get null."""
    return df.withColumn(out, F.when(~py_is_blank(F.col(text)), clean_text(F.col(text))))


def sentiment_columns(cleaned: Column, positive: Sequence[str] = POSITIVE_WORDS,
                      negative: Sequence[str] = NEGATIVE_WORDS) -> tuple[Column, Column]:
    """+1 if any positive token, -1 if any negative token (presence in
    the token set), label from the sign. Returns (score, sentiment)."""
    tokens = F.split(cleaned, " ")
    pos = F.coalesce(F.arrays_overlap(tokens, _lexicon(positive)), F.lit(False))
    neg = F.coalesce(F.arrays_overlap(tokens, _lexicon(negative)), F.lit(False))
    score = (pos.cast("int") - neg.cast("int")).cast("int")
    return score, sentiment_label(score)


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


def text_errors(df: DataFrame, text: str = "text", cleaned: str = "clean_text") -> DataFrame:
    """Which stage rejects the row. Null/blank input fails cleaning;
    text that is empty after cleaning (e.g. punctuation only) fails analysis."""
    raw = F.col(text)
    blank_raw = py_is_blank(raw)
    empty_clean = F.coalesce(F.col(cleaned) == F.lit(""), F.lit(True))  # cleaned text is already stripped
    return df.withColumn(
        "error_stage",
        F.when(blank_raw, F.lit(STAGE_CLEAN)).when(empty_clean, F.lit(STAGE_ANALYZE))
    ).withColumn(
        "error_code",
        F.when(raw.isNull(), F.lit("null_text"))
        .when(F.col("error_stage") == STAGE_CLEAN, F.lit("empty_text"))
        .when(F.col("error_stage") == STAGE_ANALYZE, F.lit("empty_after_cleaning")))


def clean_and_score(df: DataFrame, text: str = "text", positive: Sequence[str] = POSITIVE_WORDS,
                    negative: Sequence[str] = NEGATIVE_WORDS) -> DataFrame:
    """P25: clean -> analyse with per-row error columns. Result columns:
    input columns + clean_text, score, sentiment, error_stage, error_code.
    The cleaned text and the score are computed once; the later columns refer
    to them."""
    out = text_errors(clean(df, text), text)
    score, _ = sentiment_columns(F.col("clean_text"), positive, negative)
    ok = F.col("error_stage").isNull()
    return out.withColumn("score", F.when(ok, score)).withColumn("sentiment", F.when(ok, sentiment_label(F.col("score"))))


def split_outcomes(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows) of ``clean_and_score`` output."""
    return scored.filter(F.col("error_stage").isNull()), scored.filter(F.col("error_stage").isNotNull())
