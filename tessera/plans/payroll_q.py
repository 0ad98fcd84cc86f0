"""Registered payroll and rental queries and SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import progressive_tax
from tessera.operators import payroll as P
from tessera.operators import rental as R
from tessera.plans.sqlfrag import py_blank, py_strip, tax
from tessera.plans.tables import view, with_views


def _emps(spark, sf):
    return P.validate_employees(view(spark, sf, "employees_v"))


def _changes(spark, sf):
    return P.apply_changes(_emps(spark, sf), view(spark, sf, "pay_changes_v"))


def _events(spark, sf):
    return view(spark, sf, "vehicle_events_v").select("seq", "vehicle_id", "days", "kind")


def _state(spark, sf):
    return R.vehicle_state(_events(spark, sf), view(spark, sf, "vehicles_v"))


QUERIES = {
    "employee_validate": lambda spark, sf: _emps(spark, sf).select("seq", "employee_id", "emp_type", "error_code"),
    "employee_parse": lambda spark, sf: P.parse_employees(view(spark, sf, "employees_text_v"))
    .select("seq", "emp_type", "base_pay", "hours", "rate", "bonus", "error_code"),
    "employee_ids": lambda spark, sf: P.assign_ids(_emps(spark, sf)).select("seq", "employee_id", "auto_id"),
    "payroll_payslips": lambda spark, sf: P.payslips(_emps(spark, sf)),
    "payroll_tax": lambda spark, sf: _emps(spark, sf).filter(F.col("error_code").isNull()).select(
        "employee_id", F.col("base_pay").alias("salary"),
        progressive_tax(F.col("base_pay")).alias("tax")).filter(F.col("salary").isNotNull()),
    "payroll_totals": lambda spark, sf: P.payroll_totals(P.payslips(_emps(spark, sf))),
    "payroll_apply_changes": lambda spark, sf: _changes(spark, sf)[0]
    .select("seq", "employee_id", "field", "new_value", "outcome"),
    "payroll_after_changes": lambda spark, sf: P.payslips(_changes(spark, sf)[1]),
    "keyed_delete": lambda spark, sf: P.remove_by_key(
        _emps(spark, sf).filter(F.col("error_code").isNull()), view(spark, sf, "employee_removals_v"),
        "employee_id", "seq")[0],
    "keyed_remaining": lambda spark, sf: P.remove_by_key(
        _emps(spark, sf).filter(F.col("error_code").isNull()), view(spark, sf, "employee_removals_v"),
        "employee_id", "seq")[1].select("seq", "employee_id", "name", "emp_type"),
    "rental_outcomes": lambda spark, sf: R.rental_outcomes(_events(spark, sf), view(spark, sf, "vehicles_v"))
    .select("seq", "vehicle_id", "kind", "outcome"),
    "vehicle_state": _state,
    "vehicles_available": lambda spark, sf: R.available_vehicles(_state(spark, sf)),
    "vehicles_rented": lambda spark, sf: R.rented_vehicles(_state(spark, sf)),
    "rental_cost": lambda spark, sf: R.rental_cost(
        _events(spark, sf).select("seq", "vehicle_id", "days"), _state(spark, sf)),
}

_NUM = lambda c: (f"CASE WHEN regexp_matches({py_strip(c)}, '{P._FLOAT}') "  # noqa: E731
                  f"THEN TRY_CAST(replace({py_strip(c)}, '_', '') AS DOUBLE) END")
_T = f"lower({py_strip('emp_type')})"
_V = f"""v AS (SELECT seq, employee_id, name, department, {_T} AS emp_type, base_pay, hours, rate,
       CASE WHEN {_T} = 'intern' THEN 0.0 ELSE coalesce(bonus, 0.0) END AS bonus FROM employees_v),
w AS (SELECT *, CASE WHEN emp_type IS NULL OR emp_type NOT IN ('fulltime', 'contract', 'intern') THEN 'invalid_type'
       WHEN NOT (CASE WHEN emp_type = 'fulltime' THEN base_pay IS NOT NULL
                      WHEN emp_type = 'contract' THEN hours IS NOT NULL AND rate IS NOT NULL
                      ELSE base_pay IS NOT NULL END) THEN 'bad_number'
       WHEN {py_blank('name')} THEN 'missing_name'
       WHEN bonus < 0 THEN 'negative_bonus' END AS error_code FROM v)"""

_GROSS = """CASE WHEN emp_type = 'fulltime' THEN base_pay + bonus
     WHEN emp_type = 'contract' THEN hours * rate + bonus ELSE base_pay END"""


def _slips(src: str, base: str) -> str:
    return f"""SELECT employee_id, name, department, emp_type, {_GROSS} AS gross, {tax(base)} AS tax,
       ({_GROSS}) - {tax(base)} AS net FROM {src}"""


_CH = f""", {_V},
r AS (SELECT * FROM w WHERE error_code IS NULL),
c AS (SELECT p.seq, p.employee_id, p.field, p.new_value,
        CASE WHEN k.employee_id IS NULL THEN 'not_found' WHEN p.new_value < 0 THEN 'rejected' ELSE 'applied' END
          AS outcome
      FROM pay_changes_v p LEFT JOIN (SELECT DISTINCT employee_id FROM r) k ON p.employee_id = k.employee_id),
l AS (SELECT employee_id AS eid, arg_max(CASE WHEN field = 'salary' THEN new_value END,
                                         CASE WHEN field = 'salary' THEN seq END) AS s,
             arg_max(CASE WHEN field = 'bonus' THEN new_value END, CASE WHEN field = 'bonus' THEN seq END) AS b
      FROM c WHERE outcome = 'applied' GROUP BY employee_id),
u AS (SELECT r.seq, r.employee_id, r.name, r.department, r.emp_type,
        CASE WHEN r.emp_type = 'contract' THEN r.base_pay ELSE coalesce(l.s, r.base_pay) END AS base_pay,
        r.hours, r.rate, coalesce(l.b, r.bonus) AS bonus,
        coalesce(l.s, CASE WHEN r.emp_type = 'contract' THEN 0.0 ELSE r.base_pay END) AS tax_base
      FROM r LEFT JOIN l ON r.employee_id = l.eid)"""

_RENT = """k AS (SELECT DISTINCT vehicle_id AS vid FROM vehicles_v),
e AS (SELECT x.seq, x.vehicle_id, x.days, x.kind, k.vid IS NOT NULL AS known
      FROM vehicle_events_v x LEFT JOIN k ON x.vehicle_id = k.vid),
fr AS (SELECT vehicle_id AS fid, min(seq) AS fseq FROM vehicles_v GROUP BY vehicle_id),
st AS (SELECT v.seq, v.vehicle_id, v.vehicle_type, v.base_price,
              coalesce(v.seq = fr.fseq AND l.last = 'rent', false) AS is_rented
       FROM vehicles_v v JOIN fr ON v.vehicle_id = fr.fid
       LEFT JOIN (SELECT vehicle_id, arg_max(kind, seq) AS last FROM vehicle_events_v GROUP BY vehicle_id) l
       ON v.vehicle_id = l.vehicle_id),
st1 AS (SELECT st.* FROM st JOIN fr ON st.vehicle_id = fr.fid AND st.seq = fr.fseq)"""

ORACLE = {
    "employee_validate": with_views(f", {_V} SELECT seq, employee_id, emp_type, error_code FROM w", "employees_v"),
    "employee_ids": with_views(f""", {_V}
SELECT seq, employee_id, CASE WHEN error_code IS NULL OR error_code = 'negative_bonus' THEN
  CAST(row_number() OVER (PARTITION BY error_code IS NULL OR error_code = 'negative_bonus' ORDER BY seq) AS BIGINT)
  END AS auto_id FROM w""", "employees_v"),
    "payroll_payslips": with_views(f""", {_V}, r AS (SELECT *, CASE WHEN emp_type = 'contract' THEN 0.0
  ELSE base_pay END AS tb FROM w WHERE error_code IS NULL) {_slips('r', 'tb')}""", "employees_v"),
    "payroll_tax": with_views(f""", {_V} SELECT employee_id, base_pay AS salary, {tax('base_pay')} AS tax
FROM w WHERE error_code IS NULL AND base_pay IS NOT NULL""", "employees_v"),
    "payroll_totals": with_views(f""", {_V}, r AS (SELECT *, CASE WHEN emp_type = 'contract' THEN 0.0
  ELSE base_pay END AS tb FROM w WHERE error_code IS NULL), s AS ({_slips('r', 'tb')})
SELECT count(*) AS n_employees,
  CAST(coalesce(sum(CAST(gross AS DECIMAL(38,12))), 0) AS DOUBLE) AS total_gross,
  CAST(coalesce(sum(CAST(tax AS DECIMAL(38,12))), 0) AS DOUBLE) AS total_tax,
  CAST(coalesce(sum(CAST(net AS DECIMAL(38,12))), 0) AS DOUBLE) AS total_net FROM s""", "employees_v"),
    "payroll_apply_changes": with_views(f"{_CH} SELECT * FROM c", "employees_v", "pay_changes_v"),
    "payroll_after_changes": with_views(f"{_CH} {_slips('u', 'tax_base')}", "employees_v", "pay_changes_v"),
    "keyed_delete": with_views(f""", {_V},
k AS (SELECT DISTINCT employee_id AS k FROM w WHERE error_code IS NULL)
SELECT seq, employee_id, CASE WHEN k.k IS NOT NULL AND seq = min(seq) OVER (PARTITION BY employee_id)
  THEN 'removed' ELSE 'not_found' END AS outcome
FROM employee_removals_v LEFT JOIN k ON employee_id = k.k""", "employees_v", "employee_removals_v"),
    "keyed_remaining": with_views(f""", {_V} SELECT seq, employee_id, name, emp_type FROM w WHERE error_code IS NULL
AND employee_id NOT IN (SELECT employee_id FROM employee_removals_v)""", "employees_v", "employee_removals_v"),
    "employee_parse": with_views(f""", p AS (SELECT seq, name, {_T} AS emp_type, {_NUM('base_pay')} AS base_pay, {_NUM('hours')} AS hours,
  {_NUM('rate')} AS rate, {py_blank('bonus')} AS no_bonus, {_NUM('bonus')} AS typed FROM employees_text_v),
b AS (SELECT *, CASE WHEN emp_type = 'intern' OR no_bonus THEN 0.0 ELSE coalesce(typed, 0.0) END AS bonus FROM p)
SELECT seq, emp_type, base_pay, hours, rate, bonus, CASE WHEN emp_type NOT IN ('fulltime', 'contract', 'intern') THEN 'invalid_type'
  WHEN CASE WHEN emp_type = 'contract' THEN hours IS NULL OR rate IS NULL ELSE base_pay IS NULL END THEN 'bad_number'
  WHEN emp_type <> 'intern' AND NOT no_bonus AND typed IS NULL THEN 'bad_number'
  WHEN {py_blank('name')} THEN 'missing_name' WHEN bonus < 0 THEN 'negative_bonus' END AS error_code FROM b""", "employees_text_v"),
    "vehicles_rented": with_views(f", {_RENT} SELECT seq, vehicle_id, vehicle_type, base_price, is_rented "
                                  "FROM st WHERE is_rented", "vehicles_v", "vehicle_events_v"),
    "rental_outcomes": with_views(f""", {_RENT},
p AS (SELECT *, lag(kind) OVER (PARTITION BY vehicle_id ORDER BY seq) AS prev FROM e WHERE known)
SELECT seq, vehicle_id, kind, CASE WHEN kind = 'rent' THEN
  CASE WHEN prev = 'rent' THEN 'already_rented' ELSE 'rented' END
  ELSE CASE WHEN prev = 'rent' THEN 'returned' ELSE 'not_rented' END END AS outcome FROM p
UNION ALL SELECT seq, vehicle_id, kind, 'not_found' FROM e WHERE NOT known""", "vehicles_v", "vehicle_events_v"),
    "vehicle_state": with_views(f", {_RENT} SELECT seq, vehicle_id, vehicle_type, base_price, is_rented FROM st",
                                "vehicles_v", "vehicle_events_v"),
    "vehicles_available": with_views(f", {_RENT} SELECT seq, vehicle_id, vehicle_type, base_price, is_rented "
                                     "FROM st WHERE NOT is_rented",
                                     "vehicles_v", "vehicle_events_v"),
    "rental_cost": with_views(f""", {_RENT}
SELECT x.seq, x.vehicle_id, x.days,
  CASE WHEN st1.vehicle_id IS NULL THEN 'not_found' WHEN NOT st1.is_rented THEN 'not_rented' ELSE 'ok' END AS status,
  CASE WHEN st1.is_rented THEN st1.base_price * x.days END AS cost
FROM vehicle_events_v x LEFT JOIN st1 ON x.vehicle_id = st1.vehicle_id""",
                              "vehicles_v", "vehicle_events_v"),
}
