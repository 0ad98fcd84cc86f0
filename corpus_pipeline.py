"""Training-corpus pipeline: from raw documents to packed token sequences.

Each stage takes what its predecessor kept, written as Parquet and read again.
All but the last return the columns of their documents, whatever they are
named; repeated rows and null ids are rows like others, very long texts are
handled whole, an empty table gives no rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the distribution divergence keep.

    Null and empty texts are rejected; rows of one id and text in two
    languages are judged apart."""
    from tessera.llm.divergence import kept_documents

    return kept_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.5 or more (null and empty
    texts by their statistics, which are zero)."""
    from tessera.llm.rules import good_documents

    return good_documents(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (3-word shingles, 2 bits):
    the smallest id, null ids last; null and empty texts are one group."""
    from tessera.llm.simhash import one_of_each

    return one_of_each(docs, shingle=3, distance=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked and n_chars counted anew (null
    texts stay null, their n_chars too)."""
    from tessera.llm.pii import redacted

    masked = docs.withColumn("text", redacted(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of 2048 tokens; a null or
    empty text is its end id alone."""
    import public_tokenizers

    from tessera.llm.packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL twin: fitted rules, fingerprints, learned spans and tokens are not
#: SQL expressions; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
