"""Recurring-revenue views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlattice.functions.measures import count, divide, mean, rate, summarise, total
from revlattice.operators.intervals import fill_month_gaps
from revlattice.operators.ranking import top_shares
from revlattice.plans.marts import account_month, account_mrr_in, active_movements, latest_month, mrr_movements

PAYING = "mrr_eur > 0"


def movement_measures() -> list:
    kind = F.col("movement_type")
    return [
        total("opening_mrr", "previous_mrr"),
        total("new_mrr", "movement_mrr", kind == "new"),
        total("expansion_mrr", "movement_mrr", kind == "expansion"),
        total("contraction_mrr", "movement_mrr", kind == "contraction"),
        total("churned_mrr", "movement_mrr", kind == "churn"),
        total("reactivation_mrr", "movement_mrr", kind == "reactivation"),
        total("lost_mrr", "movement_mrr", kind.isin("churn", "contraction")),
        total("closing_mrr", "mrr_eur"),
        count("opening_accounts", F.col("previous_mrr") > 0),
        count("churned_accounts", kind == "churn"),
        count("new_accounts", kind == "new"),
        count("reactivated_accounts", kind == "reactivation"),
    ]


def with_movement_ratios(monthly: DataFrame) -> DataFrame:
    lost, gained = F.coalesce(-F.col("lost_mrr"), F.lit(0)), F.coalesce("expansion_mrr", F.lit(0))
    opening = F.col("opening_mrr")
    return monthly.select(
        "*",
        (F.col("closing_mrr") * 12).alias("closing_arr"),
        (F.lit(1.0) - divide(lost, opening)).alias("gross_revenue_retention"),
        divide(opening - lost + gained, opening).alias("net_revenue_retention"),
        divide(F.col("churned_accounts"), F.col("opening_accounts")).alias("logo_churn_rate"),
    )


def monthly_movements(t) -> DataFrame:
    """All monthly movement totals in one pass over the active account-months.

    Months are completed at month grain, where the frame has one row per month.
    """
    monthly = summarise(
        active_movements(t), ["month_start"], [*movement_measures(), count("_revenue_rows", F.col("is_revenue_month"))]
    )
    revenue_month = F.when(F.col("_revenue_rows") > 0, F.col("month_start"))
    bounded = monthly.withColumn("_last", F.max(revenue_month).over(Window.partitionBy()))
    complete = fill_month_gaps(bounded.where("month_start <= _last").drop("_last", "_revenue_rows"), "month_start")
    counts = ("opening_accounts", "churned_accounts", "new_accounts", "reactivated_accounts")
    return with_movement_ratios(complete.fillna(0, ["opening_mrr", "closing_mrr", *counts]))


_BRIDGE = (
    "month_start",
    "opening_mrr",
    "new_mrr",
    "expansion_mrr",
    "contraction_mrr",
    "churned_mrr",
    "reactivation_mrr",
    "closing_mrr",
)


def monthly_mrr_bridge(t) -> DataFrame:
    return monthly_movements(t).select(*_BRIDGE, "closing_arr")


def revenue_retention(t) -> DataFrame:
    return monthly_movements(t).select(
        "month_start", "opening_mrr", "gross_revenue_retention", "net_revenue_retention"
    )


def logo_churn(t) -> DataFrame:
    return monthly_movements(t).select(
        "month_start",
        "opening_accounts",
        "churned_accounts",
        "new_accounts",
        "reactivated_accounts",
        "logo_churn_rate",
    )


def bridge_reconciliation(t) -> DataFrame:
    """The bridge with empty movements as zero and the amount it fails to explain."""
    parts = _BRIDGE[2:7]
    filled = monthly_movements(t).select(*_BRIDGE).fillna(0, list(parts))
    explained = sum((F.col(p) for p in parts), F.col("opening_mrr"))
    return filled.withColumn("reconciliation_difference", F.col("closing_mrr") - explained)


def mrr_by_geography(t) -> DataFrame:
    return summarise(
        account_month(t),
        ["month_start", "region_id", "country_code"],
        [
            total("mrr_eur", "mrr_eur"),
            total("arr_eur", F.col("mrr_eur") * 12),
            count("active_accounts", PAYING),
            mean("arpa_eur", "mrr_eur", PAYING),
        ],
    )


def mrr_by_segment(t) -> DataFrame:
    return summarise(
        account_month(t),
        ["month_start", "segment", "primary_plan_name"],
        [
            total("mrr_eur", "mrr_eur"),
            count("active_accounts", PAYING),
            total("paid_seats", "paid_seats"),
            rate("mrr_per_paid_seat", total("mrr", "mrr_eur"), total("seats", "paid_seats")),
        ],
    )


def add_on_attachment(t) -> DataFrame:
    attached = f"active_add_ons > 0 and {PAYING}"
    return summarise(
        account_month(t),
        ["month_start", "segment", "primary_plan_name"],
        [
            count("active_accounts", PAYING),
            count("accounts_with_add_ons", attached),
            mean("average_add_ons", "active_add_ons", PAYING),
            rate("attachment_rate", count("attached", attached), count("active", PAYING)),
        ],
    )


def revenue_concentration(t) -> DataFrame:
    """Revenue share of the largest one and ten percent of paying accounts, latest month."""
    known = t["accounts"].select("account_id")
    latest = account_mrr_in(t, latest_month(t)).join(known, "account_id", "left_semi")
    return top_shares(latest, "mrr_eur", {"top_1_pct_share": 0.01, "top_10_pct_share": 0.10}).withColumnRenamed(
        "total", "total_mrr"
    )


def movement_totals(t) -> DataFrame:
    """Movement sum per type, smallest first."""
    kinds = summarise(mrr_movements(t), ["movement_type"], [total("movement_mrr", "movement_mrr")])
    return kinds.orderBy("movement_mrr", "movement_type")
