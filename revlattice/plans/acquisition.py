"""Sales and acquisition views.

Children (opportunities, subscriptions, contracts) are reduced to one row per
account before they meet the account, so joins move one row per account and no
child multiplies another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import days_between, month_of
from revlattice.functions.measures import (
    count,
    count_keys,
    divide,
    mean,
    share,
    summarise,
    summarise_through,
    total,
)
from revlattice.plans.marts import ACCOUNT_DIMENSIONS, account_mrr_in, latest_month

FUNNEL_KEYS = ("country_code", "region_id", "sales_motion", "acquisition_channel")


def funnel_by_account(t) -> DataFrame:
    """One row per account with what its leads, opportunities and subscriptions add up to.

    The three children are stacked and reduced in one shuffle.
    """
    facts = {
        "leads": [],
        "mqls": [],
        "sqls": [],
        "opportunities": [],
        "won_opportunities": [],
        "pipeline_arr_eur": [],
        "subscriptions": [],
    }
    one, zero = F.lit(1), F.lit(0)
    flag = lambda condition: F.when(condition, 1).otherwise(0)

    def child(frame: DataFrame, **values) -> DataFrame:
        return frame.select(
            "account_id",
            *(values.get(n, zero).cast("decimal(24,6)" if n == "pipeline_arr_eur" else "bigint").alias(n) for n in facts),
        )

    rows = reduce(
        DataFrame.unionByName,
        [
            child(
                t["leads"], leads=one, mqls=flag(F.col("mql_at").isNotNull()), sqls=flag(F.col("sql_at").isNotNull())
            ),
            child(
                t["opportunities"],
                opportunities=one,
                won_opportunities=flag(F.col("status") == "won"),
                pipeline_arr_eur=F.coalesce("expected_arr_eur", zero),
            ),
            child(t["subscriptions"], subscriptions=one),
        ],
    )
    sums = rows.groupBy("account_id").agg(*(F.sum(n).alias(n) for n in facts))
    return (
        t["accounts"].select("account_id", *ACCOUNT_DIMENSIONS).join(sums, "account_id", "left").fillna(0, list(facts))
    )


def sales_funnel(t) -> DataFrame:
    """Stage counts; a lead, opportunity or account counts once however many children it has."""
    paid = F.col("subscriptions") > 0
    return summarise(
        funnel_by_account(t),
        FUNNEL_KEYS,
        [
            count("accounts"),
            total("leads", "leads"),
            count("mqls", F.col("mqls") > 0),
            count("sqls", F.col("sqls") > 0),
            total("opportunities", "opportunities"),
            total("won_opportunities", "won_opportunities"),
            count("paid_accounts", paid),
            share("account_to_paid_rate", paid),
        ],
    )


def _accounts(t, *columns: str) -> DataFrame:
    return t["accounts"].select("account_id", *columns)


def opportunity_win_rate(t) -> DataFrame:
    """Won over all opportunities, open ones included."""
    by = ["region_id", "country_code", "segment", "sales_motion"]
    won = F.col("status") == "won"
    return summarise_through(
        t["opportunities"],
        "account_id",
        _accounts(t, *by),
        by,
        [
            count("opportunities"),
            count("won", won),
            share("win_rate", won),
            mean("average_expected_arr", "expected_arr_eur"),
        ],
    )


def median_of_days(frame: DataFrame, key: str, dimension: DataFrame, by: list[str], days, average: str, median: str):
    """Average and exact median of a day count, from how often each count occurs."""
    counted = summarise_through(
        frame.withColumn("_days", days), key, dimension, [*by, "_days"], [count("_n")]
    )
    return counted.groupBy(*by).agg(
        divide(F.sum(F.col("_days") * F.col("_n")), F.sum(F.when(F.col("_days").isNotNull(), F.col("_n")))).alias(average),
        F.percentile("_days", 0.5, F.col("_n")).alias(median),
    )


def sales_cycle(t) -> DataFrame:
    by = ["region_id", "country_code", "segment", "sales_motion"]
    return median_of_days(
        t["opportunities"].select("account_id", "status", "close_date", "created_at"),
        "account_id",
        _accounts(t, *by),
        [*by, "status"],
        days_between("close_date", "created_at"),
        "average_sales_cycle_days",
        "median_sales_cycle_days",
    )


def partner_performance(t, per_subscription: bool = False) -> DataFrame:
    """Referrals, conversions and current MRR per partner.

    ``per_subscription`` repeats an account's MRR for each of its subscriptions,
    as joining subscriptions with monthly revenue does.
    """
    subscriptions = t["subscriptions"].groupBy("account_id").agg(F.count(F.lit(1)).alias("subscriptions"))
    current = account_mrr_in(t, latest_month(t)).select("account_id", F.col("mrr_eur").alias("current"))
    weight = F.coalesce("subscriptions", F.lit(1)) if per_subscription else F.lit(1)
    accounts = (
        _accounts(t, "partner_id")
        .where(F.col("partner_id").isNotNull())
        .join(subscriptions, "account_id", "left")
        .join(current, "account_id", "left")
    )
    totals = accounts.groupBy("partner_id").agg(
        F.count(F.lit(1)).alias("referred_accounts"),
        F.count("subscriptions").alias("converted_accounts"),
        F.sum(F.col("current") * weight).alias("current_mrr_eur"),
    )
    return (
        t["partners"]
        .select("partner_id", "partner_name", "partner_type", "country_code")
        .join(totals, "partner_id", "left")
        .fillna(0, ["referred_accounts", "converted_accounts"])
        .withColumn("conversion_rate", divide(F.col("converted_accounts"), F.col("referred_accounts")))
        .select(
            "partner_id",
            "partner_name",
            "partner_type",
            "country_code",
            "referred_accounts",
            "converted_accounts",
            "conversion_rate",
            "current_mrr_eur",
        )
    )


def trial_conversion(t) -> DataFrame:
    by = ["country_code", "segment", "acquisition_channel"]
    had_trial = F.col("trial_start_date").isNotNull()
    return summarise_through(
        t["subscriptions"],
        "account_id",
        _accounts(t, *by),
        by,
        [
            count("paid_after_trial", had_trial),
            mean("average_trial_days", days_between("subscription_start_date", "trial_start_date"), had_trial),
        ],
    )


def contract_mix(t) -> DataFrame:
    contracts = t["contracts"].withColumn("contract_month", month_of("start_date"))
    return summarise_through(
        contracts,
        "account_id",
        _accounts(t, "region_id", "segment"),
        ["contract_month", "region_id", "segment", "billing_frequency", "contract_term_months"],
        [
            count("contracts"),
            mean("average_discount", "discount_pct"),
            share("auto_renew_share", F.col("auto_renew_flag")),
        ],
    )


def _acquired_accounts(t, name: str) -> DataFrame:
    """Distinct accounts by subscription start month, country and channel."""
    starts = t["subscriptions"].select("account_id", month_of("subscription_start_date").alias("month_start"))
    accounts = _accounts(t, "country_code", F.col("acquisition_channel").alias("channel"))
    return summarise_through(
        starts, "account_id", accounts, ["month_start", "country_code", "channel"], [count_keys(name)]
    )


def spend_and_acquisition(t, acquired: str) -> DataFrame:
    spend = summarise(
        t["marketing_campaigns"].withColumn("month_start", month_of("start_date")),
        ["month_start", "country_code", "channel"],
        [total("spend_eur", "spend_eur")],
    )
    keys = ["month_start", "country_code", "channel"]
    return (
        spend.join(_acquired_accounts(t, acquired), keys, "left")
        .fillna(0, [acquired])
        .withColumn("cac_eur", divide(F.col("spend_eur"), F.col(acquired)))
    )


def marketing_efficiency(t) -> DataFrame:
    return spend_and_acquisition(t, "acquired_accounts")
