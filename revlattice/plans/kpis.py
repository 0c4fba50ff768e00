"""Dashboard measures over the marts, by month or region instead of a report filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import month_of
from revlattice.functions.measures import count, count_keys, divide, mean, rate, share, summarise, summarise_through, total
from revlattice.plans.marts import account_month, active_movements, attempt_outcomes
from revlattice.plans.revenue import movement_measures


def measures_revenue(t) -> DataFrame:
    """Bridge measures, retention, accounts with revenue rows and revenue per such account."""
    monthly = summarise(
        active_movements(t),
        ["month_start"],
        [*movement_measures(), count("active_accounts", F.col("is_revenue_month"))],
    )
    bridge = ("opening_mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "reactivation_mrr")
    opening, change = F.col("opening_mrr"), lambda c: F.coalesce(c, F.lit(0))
    kept = opening + change("contraction_mrr") + change("churned_mrr")
    return monthly.where("active_accounts > 0").select(
        "month_start",
        F.col("closing_mrr"),
        (F.col("closing_mrr") * 12).alias("arr"),
        *bridge,
        divide(kept + change("expansion_mrr"), opening).alias("nrr"),
        divide(kept, opening).alias("grr"),
        "active_accounts",
        divide(F.col("closing_mrr"), F.col("active_accounts")).alias("arpa"),
    )


def measures_billing(t) -> DataFrame:
    """Invoice payment and recovery; a recovered invoice failed its first attempt and succeeded later."""
    outcomes = attempt_outcomes(t).select("invoice_id", "first_attempt_status", "eventually_succeeded")
    paid = F.col("invoice_status") == "paid"
    failed = F.col("first_attempt_status") == "failed"
    recovered = failed & F.col("eventually_succeeded")
    invoices = t["invoices"].select("invoice_id", "invoice_status", "total_eur", month_of("invoice_date").alias("month_start"))
    return summarise(
        invoices.join(outcomes, "invoice_id", "left"),
        ["month_start"],
        [
            total("invoiced_revenue_eur", "total_eur"),
            count("paid_invoices", paid),
            count("invoices"),
            share("paid_invoice_rate", paid),
            count("failed_invoices", failed),
            count("recovered_invoices", recovered),
            rate("payment_recovery_rate", count("recovered", recovered), count("failed", failed)),
        ],
    )


def measures_product(t) -> DataFrame:
    using = F.col("active_users") > 0
    flag = lambda c: F.when(F.col(c) > 0, 1).otherwise(0)
    return summarise(
        account_month(t, "usage", "health"),
        ["month_start"],
        [
            total("active_users", "active_users"),
            total("paid_seats", "paid_seats"),
            rate("seat_utilisation", total("used", "active_users"), total("seats", "paid_seats")),
            mean("automation_adoption", flag("automation_runs"), using),
            mean("api_adoption", flag("api_calls"), using),
            mean("average_health_score", "health_score"),
            total("at_risk_mrr_eur", "mrr_eur", F.col("health_segment").isin("critical", "at_risk")),
        ],
    )


def measures_sales(t) -> DataFrame:
    """Win and renewal rates by region."""
    accounts = t["accounts"].select("account_id", "region_id")
    won = F.col("status") == "won"
    sales = summarise_through(
        t["opportunities"],
        "account_id",
        accounts,
        ["region_id"],
        [count("won_opportunities", won), count("qualified_opportunities"), share("win_rate", won)],
    )
    renewed = F.col("renewal_status") == "renewed"
    owners = t["subscriptions"].select("subscription_id", "account_id")
    renewals = summarise_through(
        t["renewals"].join(owners, "subscription_id"),
        "account_id",
        accounts,
        ["region_id"],
        [
            count_keys("renewed_accounts", renewed),
            count_keys("renewal_accounts"),
            rate("renewal_rate", count_keys("renewed", renewed), count_keys("all")),
        ],
    )
    return sales.join(renewals, "region_id", "full_outer")
