"""Executive views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.functions.measures import count, mean, rate, summarise, total
from revlattice.plans.marts import STORED, account_grid, account_month, latest_month, mrr_movements, with_movement
from revlattice.plans.revenue import PAYING, movement_measures, with_movement_ratios


def _scorecard_rows(t, month: Column | None) -> DataFrame:
    """Rows whose sums by month make the scorecard; ``_known`` marks those that count for seats, users and risk.

    Stored marts are stacked: their movements, and beside them the account months of known accounts without movements.
    """
    if STORED[1] not in t or STORED[2] not in t:
        known = t["accounts"].select("account_id", F.lit(True).alias("_known"))
        rows = with_movement(account_grid(t, "usage", "health")).join(known, "account_id", "left").withColumn("_known_mrr", F.col("mrr_eur"))
        return rows if month is None else rows.where(F.col("month_start") == month)
    moves = mrr_movements(t).withColumn("_known", F.lit(None).cast("boolean"))
    facts = account_month(t, "usage", "health").select(
        "month_start", "paid_seats", "active_users", "renewal_risk_flag", F.col("mrr_eur").alias("_known_mrr"), F.lit(True).alias("_known")
    )
    frames = [f if month is None else f.where(F.col("month_start") == month) for f in (moves, facts)]
    return frames[0].unionByName(frames[1], allowMissingColumns=True)


def executive_monthly_scorecard(t, month: Column | None = None) -> DataFrame:
    """Bridge, retention, churn, seats and risk per month, or of one month, from one pass over the grid.

    Movements cover every account; seats, users and risk only accounts with a master row.
    """
    facts = _scorecard_rows(t, month)
    in_scope = F.col("_known").isNotNull()
    at_risk = in_scope & F.col("renewal_risk_flag")
    monthly = summarise(
        facts,
        ["month_start"],
        [
            *movement_measures(),
            total("paid_seats", "paid_seats", in_scope),
            total("active_users", "active_users", in_scope),
            rate("seat_utilisation", total("used", "active_users", in_scope), total("seats", "paid_seats", in_scope)),
            count("risk_accounts", at_risk),
            total("risk_mrr_eur", "_known_mrr", at_risk),
        ],
    )
    return with_movement_ratios(monthly).select(
        "month_start",
        "closing_mrr",
        "closing_arr",
        "new_mrr",
        "expansion_mrr",
        "contraction_mrr",
        "churned_mrr",
        "reactivation_mrr",
        "gross_revenue_retention",
        "net_revenue_retention",
        "opening_accounts",
        "churned_accounts",
        "logo_churn_rate",
        "paid_seats",
        "active_users",
        "seat_utilisation",
        "risk_accounts",
        "risk_mrr_eur",
    )


def latest_executive_scorecard(t) -> DataFrame:
    """The scorecard of the last month; stored marts are read for that month only."""
    if STORED[1] in t and STORED[2] in t:
        return executive_monthly_scorecard(t, latest_month(t))
    return executive_monthly_scorecard(t).orderBy(F.col("month_start").desc()).limit(1)


def regional_operating_review(t) -> DataFrame:
    return summarise(
        account_month(t, "usage", "support", "health"),
        ["month_start", "region_id"],
        [
            total("mrr_eur", "mrr_eur"),
            count("active_accounts", PAYING),
            total("paid_seats", "paid_seats"),
            total("active_users", "active_users"),
            total("completed_work_orders", "work_orders_completed"),
            total("support_tickets", "support_tickets"),
            count("renewal_risk_accounts", F.col("renewal_risk_flag")),
            mean("average_health_score", "health_score"),
        ],
    )
