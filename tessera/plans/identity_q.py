"""Registered identity / lookup queries and SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import identity as A
from tessera.operators import lookup as L
from tessera.plans.tables import view, with_views


def _registrations(spark, sf):
    return A.registration_outcomes(view(spark, sf, "attempts_v").select("seq", "email", "password_length"))


def _login(spark, sf):
    att = view(spark, sf, "attempts_v")
    reg = A.registration_outcomes(att)
    users = reg.filter(F.col("outcome") == "registered").select("email", F.col("credential").alias("password_hash"))
    return A.login_outcomes(att.select("seq", "email", "credential"), users)


def _forecast(spark, sf):
    return L.forecast_lookup(view(spark, sf, "city_requests_v"), L.forecast_dimension(spark))


def _keyed_lookup(spark, sf):
    req = view(spark, sf, "pay_changes_v").select(F.col("seq").alias("request_seq"), "employee_id")
    emp = view(spark, sf, "employees_v").select("seq", "employee_id", "name", "department")
    return L.keyed_lookup(req, emp, "employee_id", "seq", ["name", "department"])


QUERIES = {
    "registration_outcome": _registrations,
    "registered_user_ids": lambda spark, sf: A.registered_users(_registrations(spark, sf)),
    "login_outcome": _login,
    "forecast_lookup": _forecast,
    "keyed_lookup": _keyed_lookup,
}

_REG = """r AS (SELECT seq, email, password_length, credential,
       min(CASE WHEN password_length >= 8 THEN seq END) OVER (PARTITION BY email) AS win FROM attempts_v),
o AS (SELECT seq, email, password_length, credential,
       CASE WHEN seq > win THEN 'already_exists' WHEN password_length < 8 THEN 'invalid_password'
            ELSE 'registered' END AS outcome FROM r)"""

ORACLE = {
    "registration_outcome": with_views(f", {_REG} SELECT seq, email, password_length, outcome FROM o",
                                       "attempts_v"),
    "registered_user_ids": with_views(f""", {_REG}, h AS (SELECT email, md5(concat('users:', email)) AS x FROM o WHERE outcome = 'registered')
SELECT concat(substr(x, 1, 8), '-', substr(x, 9, 4), '-8', substr(x, 14, 3), '-', translate(substr(x, 17, 1), '01234567cdef', '89ab89ab89ab'),
  substr(x, 18, 3), '-', substr(x, 21, 12)) AS user_id, email FROM h""", "attempts_v"),
    "login_outcome": with_views(f""", {_REG},
u AS (SELECT email AS ue, credential AS h FROM o WHERE outcome = 'registered')
SELECT a.seq, a.email, a.credential,
       CASE WHEN u.ue IS NULL THEN 'not_found' WHEN a.credential IS DISTINCT FROM u.h THEN 'invalid_password'
            ELSE 'success' END AS outcome
FROM attempts_v a LEFT JOIN u ON a.email = u.ue""", "attempts_v"),
    "forecast_lookup": with_views("""
, d(city_d, temperature, description) AS (VALUES ('Kigali', 25.0::DOUBLE, 'Sunny'), ('Nairobi', 22.0, 'Cloudy'),
    ('Addis Ababa', 20.0, 'Rainy'), ('Dar es Salaam', 28.0, 'Sunny'))
SELECT seq, city, temperature, description, CASE WHEN city_d IS NULL THEN 'city_not_found' ELSE 'ok' END AS status
FROM city_requests_v LEFT JOIN d ON city = city_d""", "city_requests_v"),
    "keyed_lookup": with_views("""
, e AS (SELECT employee_id AS k, arg_min(name, seq) AS name, arg_min(department, seq) AS department
        FROM employees_v GROUP BY employee_id)
SELECT p.seq AS request_seq, p.employee_id, e.name, e.department, e.k IS NOT NULL AS found
FROM pay_changes_v p LEFT JOIN e ON p.employee_id = e.k""", "pay_changes_v", "employees_v"),
}
