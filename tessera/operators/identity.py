"""Registration and login outcomes over ordered attempt logs.

Only lengths / pre-hashed credentials are carried — never plaintext passwords.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_PASSWORD_LENGTH = 8


def registration_outcomes(attempts: DataFrame, existing_emails: DataFrame | None = None,
                          min_length: int = MIN_PASSWORD_LENGTH) -> DataFrame:
    """Per attempt (seq, email, password_length):
    email already registered -> ``already_exists``; else too short ->
    ``invalid_password``; else ``registered``. A rejected attempt does not
    claim the email, so the first attempt with a long-enough password wins.

    Plan: per-email min(seq) over qualifying attempts (partial aggregate,
    bounded by distinct emails) joined back on email.
    """
    long_enough = F.col("password_length") >= F.lit(min_length)
    winners = attempts.filter(long_enough).groupBy("email").agg(F.min("seq").alias("__win"))
    df = attempts.join(winners.withColumnRenamed("email", "__e"),
                       attempts["email"] == F.col("__e"), "left").drop("__e")
    if existing_emails is not None:
        ex = existing_emails.select(F.col("email").alias("__x")).distinct().withColumn("__pre", F.lit(True))
        df = df.join(ex, df["email"] == ex["__x"], "left").drop("__x")
    else:
        df = df.withColumn("__pre", F.lit(None).cast("boolean"))
    pre = F.coalesce(F.col("__pre"), F.lit(False))
    outcome = (F.when(pre | (F.col("seq") > F.col("__win")), F.lit("already_exists"))
               .when(~long_enough, F.lit("invalid_password"))
               .otherwise(F.lit("registered")))
    return df.withColumn("outcome", outcome).drop("__win", "__pre")


def registered_users(outcomes: DataFrame, namespace: str = "users") -> DataFrame:
    """(user_id, email) of the registered attempts. The id is a UUID made from
    the email (version 8, from the MD5 of namespace and email), so a job that
    is run again gives everyone the same id."""
    h = F.md5(F.concat(F.lit(namespace + ":"), F.col("email")).cast("binary"))
    variant = F.translate(F.substring(h, 17, 1), "01234567cdef", "89ab89ab89ab")
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)),
             F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return outcomes.filter(F.col("outcome") == "registered").select(F.concat_ws("-", *parts).alias("user_id"), "email")


def login_outcomes(attempts: DataFrame, users: DataFrame) -> DataFrame:
    """Per login attempt (seq, email, credential) against registered
    ``users(email, password_hash)``: not_found / invalid_password / success."""
    u = users.select(F.col("email").alias("__e"), F.col("password_hash").alias("__h"))
    df = attempts.join(u, attempts["email"] == u["__e"], "left")
    outcome = (F.when(F.col("__e").isNull(), F.lit("not_found"))
               .when(~F.col("credential").eqNullSafe(F.col("__h")), F.lit("invalid_password"))
               .otherwise(F.lit("success")))
    return df.withColumn("outcome", outcome).drop("__e", "__h")
