"""Customer success, renewal and support views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import MICROS_PER_HOUR, micros_between, month_of
from revlattice.functions.measures import combine, count, divide, mean, share, summarise, summarise_through, total
from revlattice.plans.marts import account_month, account_mrr_complete
from revlattice.plans.product import PLACE


def _accounts(t, *columns: str) -> DataFrame:
    return t["accounts"].select("account_id", *columns)


def account_health_distribution(t) -> DataFrame:
    accounts = _accounts(t, "region_id", "country_code", "segment")
    revenue = account_mrr_complete(t).select("account_id", F.col("month_start").alias("health_month"), "mrr_eur")
    scored = t["account_health_history"].select("account_id", "health_month", "health_segment", "health_score")
    return summarise(
        scored.join(revenue, ["account_id", "health_month"], "left").join(accounts, "account_id"),
        ["health_month", "region_id", "country_code", "segment", "health_segment"],
        [count("accounts"), mean("average_health_score", "health_score"), total("mrr_eur", "mrr_eur")],
    )


def renewal_risk(t) -> DataFrame:
    at_risk = F.col("renewal_risk_flag")
    return summarise(
        account_month(t, "support", "payments", "health"),
        PLACE,
        [
            count("risk_accounts", at_risk),
            total("risk_mrr_eur", "mrr_eur", at_risk),
            mean("average_risk_health_score", "health_score", at_risk),
            count("payment_risk_accounts", F.col("unpaid_invoices") > 0),
            count("support_risk_accounts", F.col("support_tickets") >= 2),
        ],
    )


def renewal_pipeline(t) -> DataFrame:
    renewals = t["renewals"].join(t["subscriptions"].select("subscription_id", "account_id"), "subscription_id")
    return summarise_through(
        renewals.withColumn("renewal_month", month_of("renewal_due_date")),
        "account_id",
        _accounts(t, "region_id", "country_code", "segment"),
        ["renewal_month", "region_id", "country_code", "segment", "renewal_status"],
        [
            count("renewals"),
            total("renewal_arr_eur", "renewal_arr_eur"),
            mean("average_renewal_probability", "renewal_probability"),
            total("probability_weighted_arr", F.col("renewal_arr_eur") * F.col("renewal_probability")),
        ],
    )


def customer_success_intervention(t) -> DataFrame:
    return summarise_through(
        t["customer_success_interactions"].withColumn("month_start", month_of("interaction_at")),
        "account_id",
        _accounts(t, "region_id", "segment"),
        ["month_start", "region_id", "segment", "interaction_type", "reason"],
        [
            count("interactions"),
            mean("average_health_before", "health_score_before"),
            mean("average_health_after", "health_score_after"),
            mean("average_health_lift", F.col("health_score_after") - F.col("health_score_before")),
        ],
    )


def support_service_levels(t) -> DataFrame:
    return summarise_through(
        t["support_tickets"].withColumn("month_start", month_of("created_at")),
        "account_id",
        _accounts(t, "region_id", "country_code", "segment"),
        [*PLACE, "priority", "category"],
        [
            count("tickets"),
            mean(
                "average_first_response_hours",
                micros_between("first_response_at", "created_at"),
                unit=MICROS_PER_HOUR,
            ),
            mean("average_resolution_hours", micros_between("resolved_at", "created_at"), unit=MICROS_PER_HOUR),
            share("escalation_rate", F.col("escalated_flag")),
            mean("average_csat", "csat_score"),
        ],
    )


def nps(t) -> DataFrame:
    """Net promoter score and most frequent theme; equal frequencies take the first theme by name."""
    responses = t["nps_responses"].withColumn("month_start", month_of("response_date"))
    by_theme = summarise_through(
        responses,
        "account_id",
        _accounts(t, "region_id", "country_code", "segment"),
        [*PLACE, "comment_theme"],
        [
            count("n"),
            total("scores", "nps_score"),
            count("scored", of="nps_score"),
            count("promoters", F.col("nps_group") == "promoter"),
            count("detractors", F.col("nps_group") == "detractor"),
        ],
    )
    n = F.sum("n")
    named = F.when(F.col("comment_theme").isNotNull(), F.struct(-F.col("n"), F.col("comment_theme").alias("theme")))
    return by_theme.groupBy(*PLACE).agg(
        n.alias("responses"),
        divide(F.sum("scores"), F.sum("scored")).alias("average_score"),
        (F.lit(100.0) * (divide(F.sum("promoters"), n) - divide(F.sum("detractors"), n))).alias("nps"),
        F.min(named)["theme"].alias("leading_comment_theme"),
    )


def churn_reasons(t) -> DataFrame:
    """Churned subscriptions by reason: the last stated cancellation reason, else the churn event's own."""
    events = t["subscription_events"]
    latest = F.max(F.struct("event_at", "subscription_event_id", "event_reason"))["event_reason"]
    cancelled = (
        events.where("event_type = 'cancellation_requested'")
        .groupBy("subscription_id")
        .agg(latest.alias("stated_reason"))
    )
    churned = summarise(
        events.where("event_type = 'subscription_churned'").withColumn("churn_month", month_of("event_at")),
        ["subscription_id", "churn_month", "event_reason"],
        [count("n"), total("change", "mrr_change_eur")],
    )
    owners = t["subscriptions"].select("subscription_id", "account_id", "churn_type")
    rows = (
        churned.join(cancelled, "subscription_id", "left")
        .join(owners, "subscription_id")
        .withColumn("churn_reason", F.coalesce("stated_reason", "event_reason"))
    )
    return summarise_through(
        rows,
        "account_id",
        _accounts(t, "region_id", "country_code", "segment"),
        ["churn_month", "region_id", "country_code", "segment", "churn_type", "churn_reason"],
        [
            total("churned_accounts", "n"),
            combine("churned_mrr_eur", [total("change", "change")], lambda change: -change),
        ],
    )
