"""Registered user-import queries and SQL oracles."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessera.functions.text import email_ok as email_ok_col
from tessera.operators import importer as I
from tessera.plans.sqlfrag import email_ok, py_int, py_strip
from tessera.plans.tables import view, with_views
from tessera.session import staging_path


def _outcomes(spark, sf):
    return I.import_users(view(spark, sf, "users_raw_v"), view(spark, sf, "users_existing_v"))


def _observed(spark, sf):
    """The audit's counts from the one run that writes the outcomes."""
    counts = Observation("import")
    I.observed_audit(_outcomes(spark, sf), counts).write.parquet(staging_path(spark, "import-outcomes"))
    found = counts.get
    return spark.createDataFrame([(o, found[o]) for o in I.OUTCOMES if found[o]], "outcome string, n_rows long")


QUERIES = {
    "user_validate": lambda spark, sf: I.validate_users(I.parse_user_rows(view(spark, sf, "users_raw_v")))
    .select("seq", "user_id", "name", "email", "parse_error", "error_code"),
    "email_valid": lambda spark, sf: view(spark, sf, "users_raw_v")
    .select("seq", "email", email_ok_col(F.col("email")).alias("email_valid")),
    "import_outcome": _outcomes,
    "import_audit": lambda spark, sf: I.import_audit(_outcomes(spark, sf)),
    "import_audit_observed": _observed,
    "append_last_wins": lambda spark, sf: I.append_last_wins(
        view(spark, sf, "attempts_v").filter(F.col("password_length") >= 8),
        view(spark, sf, "attempts_v").filter(F.col("password_length") < 8), "email", "seq", ["credential"]),
    "append_bag": lambda spark, sf: I.append_last_wins(
        view(spark, sf, "attempts_v").select("seq", "credential"),
        view(spark, sf, "attempts_v").select("seq", "credential"), None, "seq", ["credential"]),
    "unique_insert": lambda spark, sf: I.unique_insert(
        view(spark, sf, "users_raw_v").select("seq", F.col("user_id").alias("key")), "key", "seq",
        view(spark, sf, "users_existing_v").select(F.col("user_id").cast("string").alias("key")), "key"),
}

_V = f"""p AS (SELECT seq, {py_int('user_id')} AS user_id, {py_strip('name')} AS name,
       {py_strip('email')} AS email,
       CASE WHEN email IS NULL THEN 'short_row' WHEN {py_int('user_id')} IS NULL THEN 'bad_user_id' END
         AS parse_error
  FROM users_raw_v),
v AS (SELECT *, CASE WHEN parse_error IS NULL THEN
         CASE WHEN user_id IS NULL OR user_id <= 0 THEN 'invalid_user_id'
              WHEN name IS NULL OR name = '' THEN 'missing_name'
              WHEN NOT {email_ok('email')} THEN 'invalid_email' END END AS error_code FROM p)"""

_O = f""", {_V},
s AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS sid FROM users_existing_v),
w AS (SELECT v.*, s.sid IS NOT NULL AS stored,
             parse_error IS NULL AND error_code IS NULL AND s.sid IS NULL AS cand
      FROM v LEFT JOIN s ON v.user_id = s.sid),
f AS (SELECT *, cand AND seq = min(CASE WHEN cand THEN seq END) OVER (PARTITION BY user_id) AS first FROM w),
o AS (SELECT seq, user_id, name, email,
        CASE WHEN parse_error IS NOT NULL THEN 'malformed' WHEN error_code IS NOT NULL THEN 'invalid'
             WHEN stored OR NOT coalesce(first, false) THEN 'duplicate' ELSE 'added' END AS outcome,
        CASE WHEN parse_error IS NOT NULL THEN parse_error WHEN error_code IS NOT NULL THEN error_code
             WHEN stored THEN 'already_stored' WHEN NOT coalesce(first, false) THEN 'repeated_in_batch' END
          AS error_code
      FROM f)"""

ORACLE = {
    "user_validate": with_views(f", {_V} SELECT seq, user_id, name, email, parse_error, error_code FROM v",
                                "users_raw_v"),
    "email_valid": with_views(f"SELECT seq, email, {email_ok('email')} AS email_valid FROM users_raw_v",
                              "users_raw_v"),
    "import_outcome": with_views(f"{_O} SELECT * FROM o", "users_raw_v", "users_existing_v"),
    "import_audit": with_views(f"{_O} SELECT outcome, count(*) AS n_rows FROM o GROUP BY outcome",
                               "users_raw_v", "users_existing_v"),
    "import_audit_observed": with_views(f"{_O} SELECT outcome, count(*) AS n_rows FROM o GROUP BY outcome",
                                        "users_raw_v", "users_existing_v"),
    "append_last_wins": with_views("""
, b AS (SELECT 0 AS src, seq, email, credential FROM attempts_v WHERE password_length >= 8
        UNION ALL SELECT 1, seq, email, credential FROM attempts_v WHERE password_length < 8)
SELECT email, arg_max(seq, src * 1000000000000 + seq) AS seq, arg_max(credential, src * 1000000000000 + seq)
  AS credential FROM b GROUP BY email""", "attempts_v"),
    "append_bag": with_views("""
SELECT seq, credential FROM attempts_v UNION ALL SELECT seq, credential FROM attempts_v""", "attempts_v"),
    "unique_insert": with_views("""
, e AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS k FROM users_existing_v),
r AS (SELECT u.seq, u.user_id AS key, e.k IS NOT NULL AS ex FROM users_raw_v u LEFT JOIN e ON u.user_id = e.k)
SELECT seq, key, CASE WHEN ex THEN 'exists'
  WHEN seq = min(CASE WHEN NOT ex THEN seq END) OVER (PARTITION BY key) THEN 'inserted' ELSE 'duplicate' END
  AS outcome FROM r""", "users_raw_v", "users_existing_v"),
}
