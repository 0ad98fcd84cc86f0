import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import progressive_tax
from tessera.operators import payroll as P
from tessera.operators import rental as R

EMP = ("seq long, employee_id long, name string, department string, emp_type string, base_pay double, "
       "hours double, rate double, bonus double")


@pytest.mark.parametrize("salary,tax", [(0, 0.0), (30000, 0.0), (100000, 14000.0), (250000, 51500.0),
                                        (500000, 126500.0), (1000000, 276500.0), (1500000, 451500.0),
                                        (-5, 0.0)])
def test_tax_bands(spark, salary, tax):
    df = spark.createDataFrame([(float(salary),)], "s double")
    assert df.select(progressive_tax(F.col("s")).alias("t")).first()["t"] == pytest.approx(tax)


def test_tax_monotone_and_continuous(spark):
    edges = [30000, 100000, 250000, 1000000]
    vals = [float(e + d) for e in edges for d in (-1, 0, 1)]
    rows = spark.createDataFrame([(v,) for v in vals], "s double") \
        .select("s", progressive_tax(F.col("s")).alias("t")).orderBy("s").collect()
    taxes = [r["t"] for r in rows]
    assert taxes == sorted(taxes)
    for i in range(0, len(rows), 3):
        assert taxes[i + 2] - taxes[i] < 2.0


def test_payslips_and_validation(spark):
    emps = spark.createDataFrame([
        (1, 1, "Ann", "IT", " FullTime ", 120000.0, None, None, 500.0),
        (2, 2, "Bob", "IT", "contract", None, 10.0, 50.0, None),
        (3, 3, "Cy", "IT", "intern", 40000.0, None, None, -1.0),
        (4, 4, "  ", "IT", "intern", 1.0, None, None, 0.0),
        (5, 5, "Di", "IT", "boss", 1.0, None, None, 0.0),
        (6, 6, "Ed", "IT", "fulltime", 10.0, None, None, -5.0),
    ], EMP)
    v = {r["seq"]: r["error_code"] for r in P.validate_employees(emps).collect()}
    assert v == {1: None, 2: None, 3: None, 4: "missing_name", 5: "invalid_type", 6: "negative_bonus"}
    ids = {r["seq"]: r["auto_id"] for r in P.assign_ids(emps).collect()}
    assert ids == {1: 1, 2: 2, 3: 3, 4: None, 5: None, 6: 4}
    slips = {r["employee_id"]: r for r in P.payslips(emps).collect()}
    assert slips[1]["gross"] == 120500.0 and slips[1]["tax"] == pytest.approx(19000.0)
    assert slips[2]["gross"] == 500.0 and slips[2]["tax"] == 0.0     # contract: zero tax base
    assert slips[3]["gross"] == 40000.0 and slips[3]["tax"] == pytest.approx(2000.0)
    tot = P.payroll_totals(P.payslips(emps)).first()
    assert tot["total_gross"] == 161000.0


def test_change_log(spark):
    emps = spark.createDataFrame([(1, 1, "Ann", "IT", "fulltime", 100.0, None, None, 0.0),
                                  (2, 2, "Bob", "IT", "contract", None, 10.0, 5.0, 0.0)], EMP)
    changes = spark.createDataFrame([(1, 1, "salary", 200.0), (2, 1, "salary", -1.0), (3, 1, "bonus", 7.0),
                                     (4, 9, "salary", 1.0), (5, 2, "salary", 300000.0), (6, 1, "salary", 150.0)],
                                    "seq long, employee_id long, field string, new_value double")
    out, upd = P.apply_changes(emps, changes)
    assert [r["outcome"] for r in out.orderBy("seq").collect()] == [
        "applied", "rejected", "applied", "not_found", "applied", "applied"]
    s = {r["employee_id"]: r for r in P.payslips(upd).collect()}
    assert s[1]["gross"] == 157.0
    assert s[2]["gross"] == 50.0 and s[2]["tax"] == pytest.approx(66500.0)  # 15000 + 37500 + 14000


def test_remove(spark):
    t = spark.createDataFrame([(1,), (2,)], "employee_id long")
    req = spark.createDataFrame([(1, 1), (2, 1), (3, 5)], "seq long, employee_id long")
    out, rest = P.remove_by_key(t, req, "employee_id", "seq")
    assert [r["outcome"] for r in out.orderBy("seq").collect()] == ["removed", "not_found", "not_found"]
    assert [r["employee_id"] for r in rest.collect()] == [2]


VEH = "seq long, vehicle_id long, base_price double, vehicle_type string"
EV = "seq long, vehicle_id long, days long, kind string"


@pytest.mark.parametrize("width", [1, 2, 1 << 20])
def test_rent_return_machine(spark, width):
    veh = spark.createDataFrame([(1, 7, 50.0, "car"), (2, 7, 99.0, "bike"), (3, 8, 20.0, "truck")], VEH)
    ev = spark.createDataFrame([(1, 7, 2, "rent"), (2, 7, 2, "rent"), (3, 7, 1, "return"), (4, 7, 1, "return"),
                                (5, 9, 1, "rent"), (6, 8, 3, "return"), (7, 8, 3, "rent")], EV)
    got = [r["outcome"] for r in R.rental_outcomes(ev, veh, chunk_width=width).orderBy("seq").collect()]
    assert got == ["rented", "already_rented", "returned", "not_rented", "not_found", "not_rented", "rented"]
    st = {r["seq"]: r for r in R.vehicle_state(ev, veh).collect()}   # by registration
    assert st[1]["is_rented"] is False and st[3]["is_rented"] is True and st[1]["base_price"] == 50.0
    assert st[2]["vehicle_id"] == 7 and st[2]["is_rented"] is False   # a second registration of id 7
    req = spark.createDataFrame([(1, 8, 3), (2, 7, 1), (3, 9, 1)], "seq long, vehicle_id long, days long")
    cost = {r["seq"]: (r["status"], r["cost"]) for r in R.rental_cost(req, R.vehicle_state(ev, veh)).collect()}
    assert cost == {1: ("ok", 60.0), 2: ("not_rented", None), 3: ("not_found", None)}
    # listings show every registration, like the source's vehicle list
    assert sorted(r["seq"] for r in R.available_vehicles(R.vehicle_state(ev, veh)).collect()) == [1, 2]
    # rented, so a cost: the first registration of 7 (price 50), not the later one
    ev2 = ev.unionByName(spark.createDataFrame([(8, 7, 1, "rent")], EV))
    cost2 = R.rental_cost(spark.createDataFrame([(9, 7, 2)], "seq long, vehicle_id long, days long"),
                          R.vehicle_state(ev2, veh)).collect()
    assert [(r["status"], r["cost"]) for r in cost2] == [("ok", 100.0)]


@pytest.mark.parametrize("seed", [3, 4])
def test_change_log_matches_in_order_model(spark, seed):
    import random

    rnd = random.Random(seed)
    kinds = ["fulltime", "contract", "intern"]
    emps = []
    for i in range(1, 9):
        k = kinds[i % 3]
        emps.append((i, i, f"E{i}", "D", k, None if k == "contract" else float(rnd.randint(0, 9) * 1000),
                     10.0 if k == "contract" else None, 7.0 if k == "contract" else None, 100.0))
    changes = [(s, rnd.randint(1, 10), rnd.choice(["salary", "bonus"]), float(rnd.choice([-50, 0, 500, 42000])))
               for s in rnd.sample(range(1000), 60)]                 # ids 9, 10 are unknown
    # in-order model
    state = {e[1]: {"kind": e[4], "base": e[5], "bonus": 0.0 if e[4] == "intern" else e[8],
                    "tax_base": 0.0 if e[4] == "contract" else e[5]} for e in emps}
    want = {}
    for seq, eid, field, v in sorted(changes):
        if eid not in state:
            want[seq] = "not_found"
        elif v < 0:
            want[seq] = "rejected"
        else:
            want[seq] = "applied"
            st = state[eid]
            if field == "bonus":
                st["bonus"] = v
            else:
                st["tax_base"] = v
                if st["kind"] != "contract":
                    st["base"] = v
    out, upd = P.apply_changes(spark.createDataFrame(emps, EMP), spark.createDataFrame(
        changes, "seq long, employee_id long, field string, new_value double"))
    assert {r["seq"]: r["outcome"] for r in out.collect()} == want
    got = {r["employee_id"]: {"base": r["base_pay"], "bonus": r["bonus"], "tax_base": r["tax_base"]}
           for r in upd.collect()}
    assert got == {k: {"base": v["base"], "bonus": v["bonus"], "tax_base": v["tax_base"]} for k, v in state.items()}
