"""User import: parse, validate, first-wins insert against a keyed store.

Input rows: ``seq, user_id, name, email`` as text (a NULL email marks a row
with fewer than three columns). Outcomes partition the input:
``malformed`` (short row or unparsable id), ``invalid`` (first failing rule),
``duplicate`` (id already stored, or not the first valid row of its id) and
``added``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.text import email_ok, py_int, py_strip
from tessera.operators.ordering import flag_first

OUTCOMES = ("malformed", "invalid", "duplicate", "added")


def parse_user_rows(raw: DataFrame) -> DataFrame:
    """Typed parse: ``user_id`` via Python ``int()`` rules, name/email stripped.
    Adds ``parse_error`` ('short_row' / 'bad_user_id') for malformed rows."""
    return raw.select(
        "seq",
        py_int(F.col("user_id")).alias("user_id"),
        py_strip(F.col("name")).alias("name"),
        py_strip(F.col("email")).alias("email"),
        F.when(F.col("email").isNull(), F.lit("short_row"))
        .when(py_int(F.col("user_id")).isNull(), F.lit("bad_user_id")).alias("parse_error"),
    )


def validation_error(user_id, name, email):
    """First failing rule, in order id -> name -> email; null when valid."""
    return (F.when(user_id.isNull() | (user_id <= 0), F.lit("invalid_user_id"))
            .when(name.isNull() | (name == F.lit("")), F.lit("missing_name"))
            .when(~email_ok(email), F.lit("invalid_email")))


def validate_users(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("error_code", F.when(
        F.col("parse_error").isNull(),
        validation_error(F.col("user_id"), F.col("name"), F.col("email"))))


def import_users(raw: DataFrame, existing_ids: DataFrame) -> DataFrame:
    """Import ``raw`` into a store holding ``existing_ids(user_id)``.

    Plan: one parse/validate projection; the store is reduced to distinct ids
    (partial aggregate) and hash-joined (AQE broadcasts it when it is measured
    small, and splits skewed id partitions otherwise); first-wins among valid
    new rows is ``min(seq)`` per id joined back on ``seq``.
    """
    v = validate_users(parse_user_rows(raw))
    store = existing_ids.select(F.col("user_id").cast("bigint").alias("__sid")).distinct() \
        .withColumn("__stored", F.lit(True))
    v = v.join(store, v["user_id"] == store["__sid"], "left").drop("__sid")
    stored = F.coalesce(F.col("__stored"), F.lit(False))
    valid = F.col("parse_error").isNull() & F.col("error_code").isNull()
    v = flag_first(v, "user_id", "seq", "__first", candidates=valid & ~stored)
    outcome = (F.when(F.col("parse_error").isNotNull(), F.lit("malformed"))
               .when(F.col("error_code").isNotNull(), F.lit("invalid"))
               .when(stored | ~F.col("__first"), F.lit("duplicate"))
               .otherwise(F.lit("added")))
    code = (F.when(F.col("parse_error").isNotNull(), F.col("parse_error"))
            .when(F.col("error_code").isNotNull(), F.col("error_code"))
            .when(stored, F.lit("already_stored"))
            .when(~F.col("__first"), F.lit("repeated_in_batch")))
    return v.select("seq", "user_id", "name", "email", outcome.alias("outcome"), code.alias("error_code"))


def added_users(outcomes: DataFrame) -> DataFrame:
    """The rows to append to the store (one per new id)."""
    return outcomes.filter(F.col("outcome") == "added").select("user_id", "name", "email")


def import_audit(outcomes: DataFrame) -> DataFrame:
    """Number of rows per outcome."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


OUTCOMES = ("added", "duplicate", "invalid", "malformed")


def observed_audit(outcomes: DataFrame, metrics: Observation) -> DataFrame:
    """``outcomes``, counted while they are written: after the action that runs
    them ``metrics.get`` has their number in all (``n_rows``) and of each
    outcome, without a second pass."""
    of = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    return outcomes.observe(metrics, F.count(F.lit(1)).alias("n_rows"), *of)


def unique_insert(requests: DataFrame, key: str, seq: str, existing_keys: DataFrame | None = None,
                  existing_key: str | None = None) -> DataFrame:
    """Exact-key insert guard — the first request per key is inserted unless
    the key already exists; every other request is a duplicate."""
    df = requests
    if existing_keys is not None:
        ek = existing_key or key
        keys = existing_keys.select(F.col(ek).alias("__ek")).distinct().withColumn("__exists", F.lit(True))
        df = df.join(keys, df[key] == keys["__ek"], "left").drop("__ek")
    else:
        df = df.withColumn("__exists", F.lit(None).cast("boolean"))
    exists = F.coalesce(F.col("__exists"), F.lit(False))
    df = flag_first(df, key, seq, "__first", candidates=~exists)
    return df.withColumn("outcome", F.when(exists, "exists").when(F.col("__first"), "inserted")
                         .otherwise("duplicate")).drop("__exists", "__first")


def append_last_wins(base: DataFrame, new: DataFrame, key: str, seq: str, cols: list[str]) -> DataFrame:
    """Append ``new`` to ``base``; a keyed repository keeps the last
    written row per key (``new`` after ``base``, then ``seq`` order).
    Without a key (``key=None``) it is a plain bag union."""
    from tessera.operators.ordering import latest_per_key

    both = base.select(F.lit(0).alias("__src"), seq, *([key] if key else []), *cols) \
        .unionByName(new.select(F.lit(1).alias("__src"), seq, *([key] if key else []), *cols))
    if key is None:
        return both.drop("__src")
    ordered = both.withColumn("__ord", F.struct("__src", seq))
    last = latest_per_key(ordered, key, "__ord", [seq] + list(cols))
    return last.drop("__ord")
