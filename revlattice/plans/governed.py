"""Governed rates whose definition differs from that of the view of the same subject."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import month_of
from revlattice.functions.measures import count, share, summarise, summarise_through
from revlattice.plans.derive import nps_group
from revlattice.plans.success import nps

SELF_SERVICE = "self_service"


def trial_to_paid(t) -> DataFrame:
    """Per month of account creation: accounts that pay after a recorded trial over accounts eligible for one.

    Self-service accounts are eligible, and so is any account with a recorded trial.
    """
    trials = t["subscriptions"].where("trial_start_date is not null").select("account_id").distinct()
    accounts = t["accounts"].select("account_id", "sales_motion", month_of("created_at").alias("cohort_month"))
    known = accounts.join(trials.withColumn("_trial", F.lit(True)), "account_id", "left")
    converted = F.coalesce("_trial", F.lit(False))
    return summarise(
        known.where(converted | (F.col("sales_motion") == SELF_SERVICE)),
        ["cohort_month"],
        [count("eligible_accounts"), count("paid_after_trial", converted), share("trial_to_paid_rate", converted)],
    )


def closed_win_rate(t) -> DataFrame:
    """Per month of close, region and segment: won over closed opportunities; open ones do not count."""
    closed = t["opportunities"].where(F.col("status").isin("won", "lost")).withColumn("month_start", month_of("close_date"))
    won = F.col("status") == "won"
    return summarise_through(
        closed,
        "account_id",
        t["accounts"],
        ["month_start", "region_id", "segment"],
        [count("closed"), count("won", won), share("closed_win_rate", won)],
    )


def renewal_rate(t) -> DataFrame:
    """Per month in which renewals fall due: renewed over decided renewals of annual subscriptions."""
    annual = t["subscriptions"].where("billing_frequency = 'annual'").select("subscription_id")
    decided = t["renewals"].where("decision_date is not null").join(annual, "subscription_id", "left_semi")
    renewed = F.col("renewal_status") == "renewed"
    return summarise(
        decided.withColumn("renewal_month", month_of("renewal_due_date")),
        ["renewal_month"],
        [count("decided"), count("renewed", renewed), share("renewal_rate", renewed)],
    )


def nps_by_score(t) -> DataFrame:
    """``nps`` with groups from the scores instead of the stored ones; an answer without a score is in none."""
    score = F.col("nps_score")
    grouped = t["nps_responses"].withColumn("nps_group", F.when(score.isNotNull(), nps_group(score)))
    return nps({"nps_responses": grouped, "accounts": t["accounts"]})
