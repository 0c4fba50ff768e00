from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import subscribed
from revlattice.operators import intervals
from revlattice.operators.ranking import rank_in_slices, top_shares
from revlattice.plans import derive, executive, marts, reports, revenue

D = dt.date


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_item_months_touch_whole_months_and_both_items_of_a_month_count(tables):
    t = tables(
        **subscribed(
            [
                ("a", "2023-12-31", "2024-01-01", 10),
                ("a", "2024-01-15", "2024-01-15", 5),
                ("a", "2024-03-01", "2024-02-01", 99),
            ]
        )
    )
    assert rows(marts.subscription_item_monthly(t), "month_start", "subscription_item_id") == [
        (D(2023, 12, 1), "i0"),
        (D(2024, 1, 1), "i0"),
        (D(2024, 1, 1), "i1"),
    ]
    monthly = {r["month_start"]: r["mrr_eur"] for r in marts.account_mrr_monthly(t).collect()}
    assert monthly == {D(2023, 12, 1): Decimal(10), D(2024, 1, 1): Decimal(15)}


def held_by_tasks(frame):
    """Rows of each task that returns any."""
    return [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]


def test_tasks_follow_the_months_that_items_expand_to(tables, monkeypatch):
    monkeypatch.setattr(intervals, "TASK_ROWS", 100)
    t = tables(**subscribed([(f"a{i:02}", "2015-01-01", "2024-12-31", 10 + i) for i in range(40)]))
    history = [F.lit(d).cast("date") for d in ("2000-01-01", "2024-12-01")]
    for build, rows_in_all in (
        (reports.mrr_snapshot, 4800),
        (marts.subscription_monthly, 4800),
        (marts.account_mrr_monthly, 4800),
        (marts.mrr_movements, 4800),
        (lambda t: marts.account_grid(t, "usage", "support", "payments", "health"), 4800),
        (lambda t: reports.account_mrr_movements(t, *history), 12000),
        (derive.compress_to_effective_dates, 40),
    ):
        held = held_by_tasks(build(t))
        assert sum(held) == rows_in_all and len(held) > 16 and max(held) < rows_in_all / 8


def test_extent_counts_months_of_valid_items(tables):
    t = tables(**subscribed([("a", "2023-12-31", "2024-01-01", 10), ("b", "2024-03-01", "2024-02-01", 5), ("c", "2024-05-05", "2024-05-05", 1)]))
    assert marts.item_extent(t) == (3, 6)
    assert marts.item_extent(tables()) == (0, 0) and marts.mrr_movements(tables()).count() == 0


def test_grid_fills_every_account_and_month(tables):
    t = tables(**subscribed([("a", "2024-01-01", "2024-01-31", 1), ("b", "2024-04-01", "2024-04-30", 2)]))
    grid = rows(marts.account_mrr_complete(t), "account_id", "month_start", F.col("mrr_eur").cast("int"))
    months = [D(2024, m, 1) for m in (1, 2, 3, 4)]
    assert grid == [("a", m, 1 if m.month == 1 else 0) for m in months] + [
        ("b", m, 2 if m.month == 4 else 0) for m in months
    ]


MOVES = [
    ("a", "2024-02-01", "2024-02-29", 10),
    ("a", "2024-04-01", "2024-04-30", 10),
    ("a", "2024-05-01", "2024-05-31", 15),
    ("a", "2024-06-01", "2024-06-30", 12),
    ("a", "2024-07-01", "2024-07-31", 12),
    ("b", "2024-01-01", "2024-08-31", 1),
]


def test_movement_types(tables):
    t = tables(**subscribed(MOVES))
    moved = [
        (r["month_start"].month, r["movement_type"], int(r["movement_mrr"]))
        for r in marts.mrr_movements(t).where("account_id = 'a'").orderBy("month_start").collect()
    ]
    assert moved == [
        (1, "no_change", 0),
        (2, "new", 10),
        (3, "churn", -10),
        (4, "reactivation", 10),
        (5, "expansion", 5),
        (6, "contraction", -3),
        (7, "no_change", 0),
        (8, "churn", -12),
    ]


def test_sparse_totals_equal_dense_totals(tables):
    t = tables(**subscribed(MOVES))
    dense = marts.mrr_movements(t).groupBy("month_start", "movement_type").agg(F.sum("movement_mrr").alias("m"))
    sparse = (
        marts.active_movements(t)
        .where("month_start <= date '2024-08-01'")
        .groupBy("month_start", "movement_type")
        .agg(F.sum("movement_mrr").alias("m"))
    )
    moving = "movement_type <> 'no_change'"
    assert rows(dense.where(moving), "month_start", "movement_type", "m") == rows(
        sparse.where(moving), "month_start", "movement_type", "m"
    )


def test_bridge_explains_closing_and_fills_silent_months(tables):
    t = tables(**subscribed([("a", "2024-01-01", "2024-01-31", 7), ("a", "2024-05-01", "2024-05-31", 9)]))
    bridge = revenue.bridge_reconciliation(t).orderBy("month_start").collect()
    assert [r["month_start"].month for r in bridge] == [1, 2, 3, 4, 5]
    assert all(abs(r["reconciliation_difference"]) < Decimal("0.01") for r in bridge)
    assert [int(r["closing_mrr"]) for r in bridge] == [7, 0, 0, 0, 9]
    assert int(bridge[1]["churned_mrr"]) == -7 and int(bridge[4]["reactivation_mrr"]) == 9


def test_retention_stays_in_bounds_and_skips_empty_opening(tables):
    t = tables(**subscribed(MOVES))
    for r in revenue.revenue_retention(t).collect():
        if r["gross_revenue_retention"] is None:
            assert r["opening_mrr"] == 0
        else:
            assert 0 <= r["gross_revenue_retention"] <= 1


def test_facts_outside_the_grid_do_not_enter_it(tables):
    usage = [
        {"account_id": "a", "activity_date": "2024-01-05", "active_users": 3, "sessions": 4},
        {"account_id": "a", "activity_date": "2023-01-05", "active_users": 9, "sessions": 9},
        {"account_id": "z", "activity_date": "2024-01-05", "active_users": 9, "sessions": 9},
    ]
    t = tables(**subscribed([("a", "2024-01-01", "2024-02-01", 5)]), account_usage_daily=usage)
    got = rows(marts.account_month(t, "usage"), "account_id", "month_start", "active_users", "sessions")
    assert got == [("a", D(2024, 1, 1), 3, 4), ("a", D(2024, 2, 1), 0, 0)]


def test_cohorts_skip_months_without_revenue(tables):
    t = tables(
        **subscribed(
            [
                ("a", "2024-01-01", "2024-01-31", 10),
                ("a", "2024-03-01", "2024-03-31", 4),
                ("b", "2024-01-01", "2024-02-29", 6),
                ("c", "2024-02-01", "2024-02-29", 1),
            ]
        )
    )
    cells = rows(reports.cohort_retention(t), "cohort_month", "cohort_age", "retained_accounts", "logo_retention", "revenue_retention")
    assert cells == [
        (D(2024, 1, 1), 0, 2, 1.0, 1.0),
        (D(2024, 1, 1), 1, 1, 0.5, 6 / 16),
        (D(2024, 1, 1), 2, 1, 0.5, 4 / 16),
        (D(2024, 2, 1), 0, 1, 1.0, 1.0),
    ]


def test_report_retention_follows_accounts_of_the_month_before(tables):
    t = tables(
        **subscribed(
            [("a", "2024-01-01", "2024-01-31", 10), ("a", "2024-02-01", "2024-02-29", 14), ("b", "2024-01-01", "2024-01-31", 6)]
        )
    )
    got = rows(reports.revenue_retention(t), "month", "gross_revenue_retention", "net_revenue_retention")
    assert got[0] == (D(2024, 1, 1), None, None)
    assert got[1] == (D(2024, 2, 1), 10 / 16, 14 / 16)


def test_report_bridge_counts_only_the_stated_months(tables):
    t = tables(**subscribed([("a", "2023-12-01", "2024-02-01", 10)]))
    day = lambda s: F.lit(s).cast("date")
    bridge = reports.mrr_bridge(t, day("2024-01-01"), day("2024-03-01")).orderBy("month").collect()
    assert [(int(r["new_mrr"]), int(r["churned_mrr"]), int(r["closing_mrr"])) for r in bridge] == [
        (10, 0, 10),
        (0, 0, 10),
        (0, -10, 0),
    ]


def test_scorecard_keeps_accounts_without_master_row_in_the_bridge_only(tables):
    given = subscribed([("a", "2024-01-01", "2024-01-31", 10, "plan", 4), ("b", "2024-01-01", "2024-01-31", 5, "plan", 7)])
    given["accounts"] = given["accounts"][:1]
    row = executive.executive_monthly_scorecard(tables(**given)).collect()[0]
    assert int(row["closing_mrr"]) == 15 and row["paid_seats"] == 4


@pytest.mark.parametrize("count", [1, 7, 100, 437])
def test_top_shares_match_a_plain_sort(spark, count):
    values = [((i * 7919) % 131 + 1) * 1.25 for i in range(count)]
    frame = spark.createDataFrame([(Decimal(str(v)),) for v in values], "v decimal(20,4)")
    got = top_shares(frame, "v", {"one": 0.01, "ten": 0.10}).collect()[0]
    ordered = sorted(values, reverse=True)
    for name, p in (("one", 0.01), ("ten", 0.10)):
        top = max(1, -(-count * int(p * 100) // 100))
        assert got[name] == pytest.approx(sum(ordered[:top]) / sum(values))


def test_rank_in_slices_matches_row_number(spark):
    frame = spark.createDataFrame([(i % 2, f"{(i * 37) % 101:03d}") for i in range(101)], "g int, v string")
    ranked = rank_in_slices(frame, ["g"], F.substring("v", 1, 1), ["v"]).collect()
    for g in (0, 1):
        ordered = sorted(r["v"] for r in ranked if r["g"] == g)
        assert {r["v"]: r["_rank"] for r in ranked if r["g"] == g} == {v: i + 1 for i, v in enumerate(ordered)}
        assert all(r["_group_rows"] == len(ordered) for r in ranked if r["g"] == g)
