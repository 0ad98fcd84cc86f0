"""Payroll: typed validation, auto ids, gross / progressive tax / net, totals,
change logs and removals.

Employee rows: ``seq, employee_id, name, department, emp_type, base_pay,
hours, rate, bonus`` (``base_pay`` is the salary of full-time staff and the
stipend of interns; ``hours``/``rate`` belong to contract staff).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import progressive_tax
from tessera.functions.text import py_is_blank, py_strip
from tessera.operators.ordering import DEFAULT_CHUNK, position_in_key

EMP_TYPES = ("fulltime", "contract", "intern")
#: Wide enough to sum pay without rounding each row first.
MONEY = "decimal(38,12)"


def validate_employees(emps: DataFrame) -> DataFrame:
    """``error_code`` of the first failing rule (type -> numbers -> name ->
    bonus), null when the row is valid. Type is matched stripped and
    lower-cased; a missing bonus counts as 0 (interns take no bonus)."""
    t = F.lower(py_strip(F.col("emp_type")))
    numbers_ok = (F.when(t == "fulltime", F.col("base_pay").isNotNull())
                  .when(t == "contract", F.col("hours").isNotNull() & F.col("rate").isNotNull())
                  .otherwise(F.col("base_pay").isNotNull()))
    bonus = F.when(t == "intern", F.lit(0.0)).otherwise(F.coalesce(F.col("bonus"), F.lit(0.0)))
    code = (F.when(~t.isin(*EMP_TYPES) | t.isNull(), F.lit("invalid_type"))
            .when(~numbers_ok, F.lit("bad_number"))
            .when(py_is_blank(F.col("name")), F.lit("missing_name"))
            .when(bonus < 0, F.lit("negative_bonus")))
    return emps.withColumn("emp_type", t).withColumn("bonus", bonus).withColumn("error_code", code)


#: Python ``float()`` text without infinities and NaN, which are no pay.
_FLOAT = r"^[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?\z"


def parse_employees(raw: DataFrame) -> DataFrame:
    """P7 from text: numbers as typed in become doubles (null where they do
    not parse, which ``validate_employees`` reports as ``bad_number``); a blank
    bonus is 0, a bonus that is no number a bad number."""
    def number(c):
        t = py_strip(F.col(c))
        return F.when(t.rlike(_FLOAT), F.regexp_replace(t, "_", "").try_cast("double"))

    blank = py_is_blank(F.col("bonus"))
    bonus = F.when(blank, F.lit(0.0)).otherwise(number("bonus"))
    parsed = raw.withColumns({"__bad": ~blank & number("bonus").isNull(), "base_pay": number("base_pay"),
                              "hours": number("hours"), "rate": number("rate"), "bonus": bonus})
    v = validate_employees(parsed)
    bad = F.col("__bad") & (F.col("emp_type") != "intern") & (F.col("error_code").isNull() | ~F.col("error_code").isin("invalid_type"))
    return v.withColumn("error_code", F.when(bad, F.lit("bad_number")).otherwise(F.col("error_code"))).drop("__bad")


def assign_ids(emps: DataFrame, name: str = "auto_id", chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """Ids 1, 2, 3... in creation order. An id is taken by every row that
    reaches construction (type, numbers and name pass) — a negative bonus still
    consumes one; other rejected rows get null."""
    v = emps if "error_code" in emps.columns else validate_employees(emps)
    takes = F.col("error_code").isNull() | (F.col("error_code") == "negative_bonus")
    ranked = position_in_key(v.filter(takes), None, "seq", name, chunk_width)
    rest = v.filter(~takes).withColumn(name, F.lit(None).cast("bigint"))
    return ranked.unionByName(rest)


def payslips(emps: DataFrame) -> DataFrame:
    """Gross, tax (on the base salary only) and net for valid rows.

    Contract staff have a zero tax base unless a salary change set one
    (``tax_base`` column, see ``apply_changes``)."""
    v = emps if "error_code" in emps.columns else validate_employees(emps)
    v = v.filter(F.col("error_code").isNull())
    if "tax_base" not in v.columns:
        v = v.withColumn("tax_base", F.when(F.col("emp_type") == "contract", F.lit(0.0))
                         .otherwise(F.col("base_pay")))
    gross = (F.when(F.col("emp_type") == "fulltime", F.col("base_pay") + F.col("bonus"))
             .when(F.col("emp_type") == "contract", F.col("hours") * F.col("rate") + F.col("bonus"))
             .otherwise(F.col("base_pay")))
    tax = progressive_tax(F.col("tax_base"))
    return v.select("employee_id", "name", "department", "emp_type", gross.alias("gross"),
                    tax.alias("tax"), (gross - tax).alias("net"))


def payroll_totals(slips: DataFrame) -> DataFrame:
    """Totals over all employees, 0 when empty. Amounts are summed as
    decimals of twelve places, so the total does not depend on the order of
    the rows and parts of a cent count."""
    def tot(c):
        return F.coalesce(F.sum(F.col(c).cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")
    return slips.agg(F.count(F.lit(1)).alias("n_employees"), tot("gross").alias("total_gross"),
                     tot("tax").alias("total_tax"), tot("net").alias("total_net"))


def apply_changes(emps: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply a salary / bonus change log (seq, employee_id, field, new_value).

    Returns (per-change outcomes, updated employees). Unknown ids are
    ``not_found``; negative values are ``rejected``; the last valid change per
    (employee, field) wins. A salary change on contract staff only alters the
    tax base; on interns it changes the stipend.
    """
    v = emps if "error_code" in emps.columns else validate_employees(emps)
    roster = v.filter(F.col("error_code").isNull())
    ids = roster.select(F.col("employee_id").alias("__id")).distinct().withColumn("__known", F.lit(True))
    c = changes.join(ids, changes["employee_id"] == F.col("__id"), "left").drop("__id")
    known = F.coalesce(F.col("__known"), F.lit(False))
    outcome = (F.when(~known, F.lit("not_found"))
               .when(F.col("new_value") < 0, F.lit("rejected"))
               .otherwise(F.lit("applied")))
    c = c.withColumn("outcome", outcome).drop("__known")
    # Last accepted value per field, pivoted, in one aggregation per employee
    # (max_by skips rows whose ordering is NULL, i.e. the other field). Changes
    # of unknown ids simply find no roster row in the join below.
    good = changes.filter(~F.coalesce(F.col("new_value") < 0, F.lit(False)))
    last_of = lambda f: F.max_by(F.col("new_value"), F.when(F.col("field") == f, F.col("seq")))
    wide = good.groupBy(F.col("employee_id").alias("__eid")).agg(
        last_of("salary").alias("__salary"), last_of("bonus").alias("__bonus"))
    u = roster.join(wide, roster["employee_id"] == F.col("__eid"), "left").drop("__eid")
    base_tax = F.when(F.col("emp_type") == "contract", F.lit(0.0)).otherwise(F.col("base_pay"))
    u = u.withColumn("tax_base", F.coalesce(F.col("__salary"), base_tax)) \
        .withColumn("base_pay", F.when(F.col("emp_type") == "contract", F.col("base_pay"))
                    .otherwise(F.coalesce(F.col("__salary"), F.col("base_pay")))) \
        .withColumn("bonus", F.coalesce(F.col("__bonus"), F.col("bonus"))) \
        .drop("__salary", "__bonus")
    return c, u


def remove_by_key(table: DataFrame, requests: DataFrame, key: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """Ordered removal requests. The first request for an existing key
    removes it; later ones (and unknown keys) are ``not_found``.
    Returns (per-request outcomes, remaining rows)."""
    present = table.select(F.col(key).alias("__k")).distinct().withColumn("__p", F.lit(True))
    firsts = requests.groupBy(key).agg(F.min(seq).alias("__first"))
    r = requests.join(present, requests[key] == F.col("__k"), "left").drop("__k")
    r = r.join(firsts.withColumnRenamed(key, "__k2"), r[key] == F.col("__k2"), "left").drop("__k2")
    r = r.withColumn("outcome", F.when(F.coalesce(F.col("__p"), F.lit(False)) & (F.col(seq) == F.col("__first")),
                                       F.lit("removed")).otherwise(F.lit("not_found"))).drop("__p", "__first")
    remaining = table.join(requests.select(F.col(key).alias("__rk")).distinct(),
                           table[key] == F.col("__rk"), "left_anti")
    return r, remaining
