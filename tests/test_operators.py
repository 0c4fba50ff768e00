from __future__ import annotations

import datetime as dt
import itertools
import math
import random
from decimal import Decimal
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from conftest import subscribed
from revlattice.functions.normal import two_sided_p
from revlattice.operators import intervals
from revlattice.operators.intervals import compress_runs, latest_before, overlapping_pairs, valid_on
from revlattice.plans import acquisition, billing, derive, experiments, quality, reports

D = dt.date


def test_compress_breaks_on_change_and_on_a_missing_month(spark):
    months = [(1, "A", 9), (2, "A", 8), (3, "B", 7), (4, "A", 6), (6, "A", 5), (7, None, 4), (8, None, 3)]
    frame = spark.createDataFrame([("s", D(2024, m, 1), p, v) for m, p, v in months], "k string, m date, p string, v int")
    runs = [tuple(r) for r in compress_runs(frame, "k", "m", ["p"], ["v"]).orderBy("effective_start").collect()]
    assert runs == [
        ("s", "A", D(2024, 1, 1), D(2024, 2, 29), 9),
        ("s", "B", D(2024, 3, 1), D(2024, 3, 31), 7),
        ("s", "A", D(2024, 4, 1), D(2024, 4, 30), 6),
        ("s", "A", D(2024, 6, 1), D(2024, 6, 30), 5),
        ("s", None, D(2024, 7, 1), D(2024, 8, 31), 4),
    ]


def test_overlap_is_inclusive_and_needs_equal_product(tables):
    def item(ident, start, end, kind="plan", product="p"):
        return {
            "subscription_item_id": ident,
            "subscription_id": "s",
            "item_type": kind,
            "plan_id": product if kind == "plan" else None,
            "add_on_id": product if kind == "add_on" else None,
            "effective_start": start,
            "effective_end": end,
        }

    t = tables(
        subscription_items=[
            item("b", "2024-01-01", "2024-01-31"),
            item("a", "2024-01-31", "2024-02-10"),
            item("c", "2024-02-11", "2024-02-12"),
            item("d", "2024-01-05", "2024-01-06", "add_on"),
            item("e", "2024-01-05", "2024-01-06", "plan", None),
        ]
    )
    got = [(r["left_item_id"], r["right_item_id"], r["left_start"]) for r in quality.subscription_item_overlap(t).collect()]
    assert got == [("a", "b", D(2024, 1, 31))]


def test_overlap_matches_brute_force(spark):
    rng = random.Random(7)
    start = D(2024, 1, 1)
    rows = []
    for i in range(300):
        first = start + dt.timedelta(days=rng.randrange(400))
        rows.append((i, rng.randrange(3), first, first + dt.timedelta(days=rng.randrange(-2, 90))))
    frame = spark.createDataFrame(rows, "id int, k int, s date, e date")
    got = {(r["left_id"], r["right_id"]) for r in overlapping_pairs(frame, "id", [F.col("k")], "s", "e").collect()}
    want = {
        (a[0], b[0])
        for a, b in itertools.combinations(rows, 2)
        if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3] and a[2] <= a[3] and b[2] <= b[3]
    }
    assert got == want


def test_overlap_leaves_rows_without_a_partner_behind(spark):
    # Intervals of 60 years that follow each other, and three that overlap around the end of a year; b comes twice.
    rows = [(f"r{i}", "k", D(1000 + 60 * i, 1, 1), D(1059 + 60 * i, 12, 31)) for i in range(5)]
    pair = [("a", "l", D(2023, 11, 5), D(2025, 2, 1)), ("b", "l", D(2024, 12, 31), D(2024, 12, 31)), ("b", "l", D(2024, 12, 31), D(2024, 12, 31))]
    rows += [*pair, ("c", "l", D(2025, 1, 1), D(2025, 1, 1)), ("d", None, D(2023, 1, 1), D(2025, 1, 1)), ("e", None, D(2023, 1, 1), D(2025, 1, 1))]
    frame = spark.createDataFrame(rows, "id string, k string, s date, e date")
    pairs = overlapping_pairs(frame, "id", ["k"], "s", "e", keep=("k", "s"))
    got = sorted((r["left_id"], r["right_id"], r["k"], r["s"]) for r in pairs.collect())
    assert got == [("a", "b", "l", D(2023, 11, 5))] * 2 + [("a", "c", "l", D(2023, 11, 5))]
    plan = pairs._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    assert "ReusedExchange" in plan
    # Months of 60 years do not move for rows that meet no other.
    assert overlapping_pairs(frame.where("k = 'k'"), "id", ["k"], "s", "e").count() == 0


def test_as_of_takes_the_due_month_and_falls_back_to_the_first_value(spark):
    history = spark.createDataFrame([("s", D(2024, 3, 1), 10), ("s", D(2024, 5, 1), 20)], "k string, m date, v int")
    points = spark.createDataFrame([("s", D(2024, m, 1), m) for m in (1, 3, 4, 5, 9)], "k string, at date, n int")
    got = {r["n"]: r["v"] for r in latest_before(points, history, "k", "at", "m", "v").collect()}
    assert got == {1: 10, 3: 10, 4: 10, 5: 20, 9: 20}


def test_rule_in_force(spark):
    facts = spark.createDataFrame([("a", D(2024, 6, 30)), ("a", D(2024, 7, 1)), ("a", D(2030, 1, 1))], "k string, d date")
    rules = spark.createDataFrame(
        [("a", D(2024, 1, 1), D(2024, 6, 30), 1), ("a", D(2024, 7, 1), D(2024, 12, 31), 2)], "k string, s date, e date, p int"
    )
    got = {r["d"]: r["p"] for r in valid_on(facts, rules, ["k"], "d", "s", "e").collect()}
    assert got == {D(2024, 6, 30): 1, D(2024, 7, 1): 2, D(2030, 1, 1): None}


@pytest.mark.parametrize("z", [0.0, 0.3, 1.0, 1.959964, 3.5, 7.0, 7.5, 9.0])
def test_two_sided_p(spark, z):
    got = spark.range(1).select(two_sided_p(F.lit(z)).alias("p")).collect()[0]["p"]
    want = 2 * (1 - NormalDist().cdf(z))
    assert got == pytest.approx(want, abs=1e-13)
    if z > 8:
        assert got == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-3)


def _experiment(arms):
    assignments, exposures, outcomes = [], [], []
    for variant, values in arms.items():
        for i, value in enumerate(values):
            ident = f"{variant}{i}"
            assignments.append(
                {"assignment_id": ident, "experiment_id": "e", "account_id": ident, "variant": variant, "stratum": "DE|small"}
            )
            exposures.append({"exposure_id": ident, "assignment_id": ident, "exposure_count": 1})
            outcomes.append(
                {"outcome_id": ident, "assignment_id": ident, "primary_outcome": value, "guardrail_outcome": 1, "revenue_outcome_eur": 2}
            )
    return {
        "experiments": [{"experiment_id": "e", "experiment_name": "E", "minimum_detectable_effect": "0.05"}],
        "experiment_assignments": assignments,
        "experiment_exposures": exposures,
        "experiment_outcomes": outcomes,
    }


@pytest.mark.parametrize(
    "control, treatment, decision",
    [
        ([0] * 40 + [1] * 10, [0] * 10 + [1] * 40, "LAUNCH"),
        ([0] * 10 + [1] * 40, [0] * 40 + [1] * 10, "DO NOT LAUNCH"),
        ([0, 1, 0, 1], [1, 0, 1, 0], "INCONCLUSIVE"),
    ],
)
def test_experiment_decision(tables, control, treatment, decision):
    row = experiments.experiment_decisions(tables(**_experiment({"control": control, "treatment": treatment}))).collect()[0]
    assert row["decision"] == decision
    assert row["ci_lower"] <= row["absolute_effect"] <= row["ci_upper"]


def test_experiment_without_variance_has_p_one_and_small_arms_are_skipped(tables):
    row = experiments.experiment_decisions(tables(**_experiment({"control": [1, 1], "treatment": [1, 1]}))).collect()[0]
    assert row["p_value"] == 1.0 and row["decision"] == "INCONCLUSIVE"
    assert experiments.experiment_decisions(tables(**_experiment({"control": [1], "treatment": [1, 1]}))).count() == 0


def test_funnel_does_not_multiply_children(tables):
    given = subscribed([], accounts=("a", "b"))
    given["leads"] = [
        {"lead_id": f"l{i}", "account_id": "a", "mql_at": "2024-01-01 00:00:00" if i else None} for i in range(2)
    ]
    given["opportunities"] = [
        {"opportunity_id": f"o{i}", "account_id": "a", "status": "won" if i == 0 else "lost", "expected_arr_eur": 5} for i in range(3)
    ]
    given["subscriptions"] = [{"subscription_id": f"s{i}", "account_id": "a"} for i in range(2)]
    row = acquisition.sales_funnel(tables(**given)).collect()[0].asDict()
    assert {k: row[k] for k in ("accounts", "leads", "mqls", "sqls", "opportunities", "won_opportunities", "paid_accounts")} == {
        "accounts": 2,
        "leads": 2,
        "mqls": 1,
        "sqls": 0,
        "opportunities": 3,
        "won_opportunities": 1,
        "paid_accounts": 1,
    }
    assert row["account_to_paid_rate"] == 0.5


def test_multiplied_reconciliation_counts_a_payment_per_refund(tables):
    t = tables(
        invoices=[{"invoice_id": "i", "total_eur": 10, "invoice_status": "paid"}],
        payments=[{"payment_id": "p", "invoice_id": "i", "amount_eur": 10}],
        refunds=[{"refund_id": f"r{i}", "payment_id": "p", "amount_eur": 1} for i in range(2)],
    )
    single = billing.invoice_payment_reconciliation(t).collect()[0]
    double = billing.invoice_payment_reconciliation(t, multiplied=True).collect()[0]
    assert (int(single["captured_eur"]), int(double["captured_eur"]), int(single["refunded_eur"])) == (10, 20, 2)


def test_dunning_recovers_on_the_next_attempt_only(tables):
    attempts = [("failed", 1), ("failed", 2), ("succeeded", 3), ("failed", 4)]
    t = tables(
        payment_attempts=[
            {"payment_attempt_id": f"p{n}", "invoice_id": "i", "attempt_at": f"2024-01-0{n} 10:00:00", "attempt_number": n, "attempt_status": s}
            for s, n in attempts
        ]
    )
    got = {r["dunning_step"]: (r["recovered_after_event_flag"], r["event_at"].hour) for r in derive.dunning_from_attempts(t).collect()}
    assert got == {1: (False, 14), 2: (True, 14), 4: (False, 14)}
    assert [r["payment_id"] for r in derive.captured_payments(t).collect()] == ["p3"]


def test_renewals_stop_at_the_end_and_use_the_month_known_by_then(tables):
    given = subscribed([("a", "2021-03-01", "2021-12-31", 10), ("a", "2022-01-01", "2022-01-31", 30)])
    given["subscriptions"] = [
        {
            "subscription_id": "s_a",
            "account_id": "a",
            "billing_frequency": "annual",
            "subscription_start_date": "2020-01-15",
            "ended_date": "2022-06-30",
        }
    ]
    got = [
        (r["renewal_due_date"], int(r["renewal_arr_eur"]))
        for r in derive.renewal_schedule(tables(**given), F.lit("2024-01-01").cast("date")).orderBy("renewal_due_date").collect()
    ]
    assert got == [(D(2021, 1, 15), 120), (D(2022, 1, 15), 360)]


def test_tasks_of_renewals_follow_their_rows(tables, monkeypatch):
    monkeypatch.setattr(intervals, "TASK_ROWS", 100)
    rows = subscribed([(f"a{i:02}", "2015-01-01", "2024-12-31", 10 + i) for i in range(40)])
    for subscription in rows["subscriptions"]:
        subscription["billing_frequency"] = "annual"
    due = derive.renewal_schedule(tables(**rows), F.lit("2024-12-31").cast("date"))
    held = [r["count"] for r in due.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 164 and len(held) > 16


def test_bands(spark):
    one = lambda column: spark.range(1).select(column.alias("v")).collect()[0]["v"]
    lit = F.lit
    assert [one(derive.health_band(lit(s))) for s in (75, 74.9, 62, 45, 44)] == ["healthy", "watch", "watch", "at_risk", "critical"]
    assert [one(derive.employee_band(lit(n))) for n in (9, 10, 249, 250, 1000)] == ["1-9", "10-49", "50-249", "250-999", "1000+"]
    assert [one(derive.nps_group(lit(n))) for n in (10, 9, 8, 7, 6)] == ["promoter", "promoter", "passive", "passive", "detractor"]
    assert one(derive.lead_status(lit(False), lit(55))) == "qualified" and one(derive.is_mql(lit(45)))
    day = lambda s: lit(s).cast("date")
    assert one(derive.contract_status(day(None), day("2024-01-01"), day("2024-01-01"))) == "active"
    assert one(derive.contract_status(day(None), day("2023-01-01"), day("2024-01-01"))) == "expired"
    assert one(derive.invoice_status(lit(False), day("2024-01-01"), day("2024-01-01"))) == "overdue"


def test_unreadable_text_becomes_null(spark):
    frame = spark.createDataFrame([(" 12.50 ", "2024-02-29"), ("x", "2024-02-30"), ("", None)], "n string, d string")
    got = [tuple(r) for r in frame.select(reports.to_number("n"), reports.to_day("d")).collect()]
    assert got == [(Decimal("12.5"), D(2024, 2, 29)), (None, None), (None, None)]


def test_missing_rate_raises_or_stays_null(tables, spark):
    t = tables(
        invoices=[{"invoice_id": "i", "invoice_date": "2024-02-10", "currency_code": "GBP", "total_local": 2}],
        fx_rates=[
            {"rate_date": "2024-01-01", "currency_code": "GBP", "eur_rate": "1.2"},
            {"rate_date": "2024-01-15", "currency_code": "GBP", "eur_rate": "7.7"},
        ],
    )
    with pytest.raises(Exception, match="no rate for GBP"):
        derive.fx_convert(t).collect()
    kept = derive.with_fx_rate(t["invoices"], t["fx_rates"], "currency_code", "invoice_date", missing="null")
    assert kept.collect()[0]["eur_rate"] is None


def test_rate_inside_a_month_neither_counts_nor_multiplies(tables):
    t = tables(
        invoices=[{"invoice_id": "i", "invoice_date": "2024-01-20", "currency_code": "GBP", "total_local": 2}],
        fx_rates=[{"rate_date": f"2024-01-{d}", "currency_code": "GBP", "eur_rate": r} for d, r in (("01", "1.2"), ("15", "7.7"))],
    )
    rated = derive.with_fx_rate(t["invoices"], t["fx_rates"], "currency_code", "invoice_date").collect()
    assert [r["eur_rate"] for r in rated] == [Decimal("1.2")]


def test_plan_revenue_formula(tables):
    given = subscribed([("a", "2024-02-01", "2024-12-31", 0, "plan", 8)])
    given["subscriptions"] = [{"subscription_id": "s_a", "account_id": "a", "contract_id": "c", "billing_frequency": "annual"}]
    given["contracts"] = [{"contract_id": "c", "account_id": "a", "discount_pct": "0.25"}]
    given["plans"] = [{"plan_id": "p1", "plan_name": "Team", "included_seats": 5}]
    given["plan_prices"] = [
        {
            "plan_price_id": "pp",
            "plan_id": "p1",
            "country_code": "DE",
            "billing_frequency": "annual",
            "effective_start": "2024-01-01",
            "effective_end": "2024-12-31",
            "base_price": 100,
            "seat_price": 10,
            "annual_discount_pct": "0.10",
        }
    ]
    row = derive.plan_mrr(tables(**given)).collect()[0]
    assert row["gross_mrr"] == Decimal("117.000000")
    assert row["plan_mrr"] == Decimal("99.450000")


def test_of_rules_sharing_a_day_the_last_to_start_is_in_force(spark):
    rules = spark.createDataFrame(
        [("a", 1, 100, "base"), ("a", 50, 60, "sale"), ("a", 100, 120, "next"), ("a", 110, 120, "n1"), ("a", 110, 120, "n2")],
        "k string, s int, e int, p string",
    ).selectExpr("k", "date_add(date '2024-01-01', s) s", "date_add(date '2024-01-01', e) e", "p")
    facts = spark.createDataFrame([("a", d) for d in (0, 1, 49, 50, 60, 61, 99, 100, 109, 110, 120, 121)], "k string, n int")
    got = valid_on(facts.selectExpr("*", "date_add(date '2024-01-01', n) d"), rules, ["k"], "d", "s", "e").collect()
    assert {r["n"]: r["p"] for r in got} == {
        0: None, 1: "base", 49: "base", 50: "sale", 60: "sale", 61: "base", 99: "base", 100: "next", 109: "next",
        110: "n2", 120: "n2", 121: None,
    } and len(got) == 12


def test_rules_in_force_against_brute_force(spark):
    import random

    rng = random.Random(11)
    day = dt.date(1969, 6, 1)
    rules = []
    for i in range(300):
        first = rng.randrange(800)
        rules.append((rng.choice("ab"), day + dt.timedelta(first), day + dt.timedelta(first + rng.choice([-1, 0, 1, 3, 30, 500, 4000])), i))
    frame = spark.createDataFrame(rules, "k string, s date, e date, p int")
    facts = spark.createDataFrame([(k, day + dt.timedelta(d)) for k in "abc" for d in range(-5, 900, 3)], "k string, d date")
    for got in (valid_on(facts, frame, ["k"], "d", "s", "e").collect(), valid_on(facts.limit(0), frame, ["k"], "d", "s", "e").collect()):
        for row in got:
            held = [(s, e, p) for k, s, e, p in rules if k == row["k"] and s <= row["d"] <= e]
            assert row["p"] == (max(held)[2] if held else None)
    assert valid_on(facts, frame.limit(0), ["k"], "d", "s", "e").where("p is not null").isEmpty()


def test_a_key_with_very_many_rules_takes_linear_work(spark):
    rules = spark.range(100_000).selectExpr("'a' k", "date_add(date '1900-01-01', int(id % 50000)) s", "date_add(date '1900-01-01', int(id % 50000 + id % 900)) e", "id p")
    facts = spark.range(20_000).selectExpr("'a' k", "date_add(date '1900-01-01', int(id * 2)) d", "id")
    found = valid_on(facts, rules, ["k"], "d", "s", "e").where("d between s and e and s = d")
    # The rule that starts on the day itself is the last one to start, of two the one that ends later.
    assert found.count() == 20_000 and found.where("p % 900 < (p + 50000) % 900 and p < 50000").isEmpty()


def test_assignment_takes_the_first_accounts_by_digest(spark, tables, monkeypatch):
    import hashlib

    accounts = [{"account_id": f"a{i}", "created_at": "2024-01-01 00:00:00", "country_code": "DE", "segment": "small", "sales_motion": "x"} for i in range(700)]
    ends = {"e1": "2024-05-01", "e2": "2023-05-01", "e3": "2024-06-01"}
    t = tables(accounts=accounts, experiments=[{"experiment_id": e, "end_date": d} for e, d in ends.items()])
    monkeypatch.setattr(derive, "EXPERIMENTS_AT_ONCE", 1)
    got = {(r["experiment_id"], r["account_id"]): r["variant"] for r in derive.experiment_assign(t, {"e3": "account_id < 'a2'"}).collect()}
    want = {}
    for e in ("e1", "e3"):
        mine = sorted((hashlib.md5(f"{e}|{a['account_id']}".encode()).hexdigest(), a["account_id"]) for a in accounts if e == "e1" or a["account_id"] < "a2")
        for i, (_, a) in enumerate(mine[: min(len(mine), max(80, int(len(mine) * 0.35)))]):
            want[e, a] = "treatment" if i % 2 else "control"
    assert got == want
    assert derive.experiment_assign(tables(accounts=accounts)).isEmpty()
