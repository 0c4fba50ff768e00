"""Report pack: the second set of definitions, kept apart from the views because they differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.functions.dates import add_months, month_of, months_apart
from revlattice.functions.measures import count, divide, highest, mean, rate, summarise, summarise_through, total
from revlattice.operators.intervals import dealt, expand_months, fill_calendar
from revlattice.plans.acquisition import FUNNEL_KEYS, funnel_by_account, spend_and_acquisition
from revlattice.plans.marts import (
    ACCOUNT_DIMENSIONS,
    account_mrr_in,
    account_mrr_monthly,
    attempt_outcomes,
    item_extent,
    latest_month,
    with_movement,
)


def to_number(column: Column | str) -> Column:
    """Text as an exact number; what does not parse is NULL."""
    return F.nullif(F.trim(column), F.lit("")).try_cast("decimal(38,6)")


def to_day(column: Column | str) -> Column:
    """Text as a date; what does not parse is NULL."""
    return F.nullif(F.trim(column), F.lit("")).try_cast("timestamp_ntz").cast("date")


def mrr_snapshot(t) -> DataFrame:
    """Recurring revenue per month and subscription with account attributes; orphans are kept."""
    spans = (
        t["subscription_items"]
        .select(
            "subscription_id",
            "item_type",
            month_of("effective_start").alias("first_month"),
            month_of("effective_end").alias("last_month"),
            F.coalesce("mrr_eur", F.lit(0)).alias("mrr_eur"),
        )
        .where("first_month <= last_month")
    )
    measures = [total("mrr_eur", "mrr_eur"), count("recurring_items", of="item_type")]
    reduced = summarise(spans, ["subscription_id", "first_month", "last_month"], measures)
    owned = reduced.join(t["subscriptions"].select("subscription_id", "account_id"), "subscription_id", "left").join(
        t["accounts"].select("account_id", *ACCOUNT_DIMENSIONS), "account_id", "left"
    )
    # The spans of a frequent account spread over its subscriptions before they become months.
    return summarise(
        expand_months(dealt(owned, "subscription_id", item_extent(t).item_months), "first_month", "last_month", "month"),
        ["month", "subscription_id", "account_id", *ACCOUNT_DIMENSIONS],
        [total("mrr_eur", "mrr_eur"), total("recurring_items", "recurring_items")],
    )


def account_mrr_movements(t, first_month: Column, last_month: Column) -> DataFrame:
    """Movements of every account over a stated calendar; revenue outside it does not count."""
    calendar = t["accounts"].sparkSession.range(1).select(months_apart(last_month, first_month) + 1).first()[0]
    monthly = account_mrr_monthly(t, calendar or 0).select("account_id", "month_start", "mrr_eur")
    inside = F.col("month_start").between(first_month, last_month)
    kept = (
        monthly.select(
            "account_id",
            F.when(inside, F.col("month_start")).otherwise(first_month).alias("month"),
            F.when(inside, F.col("mrr_eur")).otherwise(F.lit(0)).alias("mrr_eur"),
        )
        .groupBy("account_id", "month")
        .agg(F.sum("mrr_eur").alias("mrr_eur"))
    )
    grid = fill_calendar(kept, "account_id", "month", first_month, last_month, zero=("mrr_eur",))
    moved = with_movement(grid.withColumnRenamed("month", "month_start"))
    order = Window.partitionBy("account_id").orderBy("month_start")
    return moved.select(
        "account_id",
        F.col("month_start").alias("month"),
        "mrr_eur",
        "previous_mrr",
        (F.max("previous_mrr").over(order.rowsBetween(Window.unboundedPreceding, 0)) > 0).alias("ever_active_before"),
        "movement_type",
        "movement_mrr",
    )


_KINDS = {
    "new_mrr": "new",
    "expansion_mrr": "expansion",
    "contraction_mrr": "contraction",
    "churned_mrr": "churn",
    "reactivation_mrr": "reactivation",
}


def mrr_bridge(t, first_month: Column, last_month: Column) -> DataFrame:
    """Rounded bridge with the residual it leaves."""
    kind = F.col("movement_type")
    monthly = summarise(
        account_mrr_movements(t, first_month, last_month),
        ["month"],
        [
            total("opening_mrr", "previous_mrr"),
            *(total(name, "movement_mrr", kind == value, empty=0) for name, value in _KINDS.items()),
            total("closing_mrr", "mrr_eur"),
        ],
    )
    explained = sum((F.col(c) for c in _KINDS), F.col("opening_mrr"))
    money = ("opening_mrr", *_KINDS, "closing_mrr")
    return monthly.select(
        "month",
        *(F.round(c, 2).alias(c) for c in money),
        F.round(F.col("closing_mrr") - explained, 6).alias("bridge_reconciliation"),
    )


def bridge_tail(t, first_month: Column, last_month: Column, months: int = 18) -> DataFrame:
    return mrr_bridge(t, first_month, last_month).orderBy(F.col("month").desc()).limit(months)


def cohort_retention(t) -> DataFrame:
    """Accounts and revenue left at each age of the cohorts by first paying month."""
    account = Window.partitionBy("account_id")
    monthly = account_mrr_monthly(t).select("account_id", "month_start", "mrr_eur")
    aged = monthly.withColumn(
        "cohort_month", F.min(F.when(F.col("mrr_eur") > 0, F.col("month_start"))).over(account)
    ).where(F.col("cohort_month").isNotNull())
    cells = summarise(
        aged.withColumn("cohort_age", months_apart("month_start", "cohort_month")),
        ["cohort_month", "cohort_age"],
        [count("retained_accounts"), total("retained_mrr", "mrr_eur")],
    )
    cohort = Window.partitionBy("cohort_month")
    at_start = lambda c: F.max(F.when(F.col("cohort_age") == 0, F.col(c))).over(cohort)
    return cells.select(
        "*", at_start("retained_accounts").alias("cohort_accounts"), at_start("retained_mrr").alias("cohort_mrr")
    ).select(
        "*",
        divide(F.col("retained_accounts"), F.col("cohort_accounts")).alias("logo_retention"),
        divide(F.col("retained_mrr"), F.col("cohort_mrr")).alias("revenue_retention"),
    )


def revenue_retention(t) -> DataFrame:
    """Retention of the accounts present a month earlier, per month with revenue rows."""
    order = Window.partitionBy("account_id").orderBy("month_start")
    following = add_months("month_start", 1)
    mrr = F.col("mrr_eur")
    placed = account_mrr_monthly(t).select(
        "month_start",
        "mrr_eur",
        F.when(F.lead("month_start").over(order).eqNullSafe(following), F.lead("mrr_eur").over(order))
        .otherwise(F.lit(0))
        .alias("_then"),
    )
    change = mrr - F.col("_then")
    money = placed.schema["mrr_eur"].dataType
    none = F.lit(None).cast(money)
    present = F.struct(
        F.col("month_start").alias("month"),
        F.lit(True).alias("present"),
        none.alias("opening"),
        none.alias("lost"),
        none.alias("gained"),
    )
    carried = F.struct(
        following.alias("month"),
        F.lit(False).alias("present"),
        mrr.alias("opening"),
        F.greatest(change, F.lit(0)).cast(money).alias("lost"),
        F.greatest(-change, F.lit(0)).cast(money).alias("gained"),
    )
    monthly = summarise(
        placed.select(F.inline(F.array(present, carried))),
        ["month"],
        [
            count("present", F.col("present")),
            total("opening", "opening", empty=0),
            total("lost", "lost", empty=0),
            total("gained", "gained", empty=0),
        ],
    ).where("present > 0")
    kept = F.col("opening") - F.col("lost")
    return monthly.select(
        "month",
        divide(kept, F.col("opening")).alias("gross_revenue_retention"),
        divide(kept + F.col("gained"), F.col("opening")).alias("net_revenue_retention"),
        F.col("opening").alias("opening_mrr"),
    )


def sales_funnel(t) -> DataFrame:
    """Funnel counts by lead and by opportunity with stage-to-stage ratios."""
    groups = summarise(
        funnel_by_account(t),
        FUNNEL_KEYS,
        [
            count("accounts"),
            *(total(c, c) for c in ("leads", "mqls", "sqls", "opportunities", "won_opportunities", "pipeline_arr_eur")),
            count("paid_accounts", F.col("subscriptions") > 0),
        ],
    )
    ratio = lambda a, b: divide(F.col(a), F.col(b))
    return groups.select(
        "*",
        ratio("mqls", "leads").alias("lead_to_mql"),
        ratio("sqls", "mqls").alias("mql_to_sql"),
        ratio("won_opportunities", "opportunities").alias("opportunity_win_rate"),
        ratio("paid_accounts", "accounts").alias("account_to_paid"),
    )


def payment_recovery(t) -> DataFrame:
    """Invoices whose first attempt failed, by the month of that attempt."""
    outcomes = (
        attempt_outcomes(t)
        .where("first_attempt_status = 'failed'")
        .select(
            "invoice_id",
            month_of("first_numbered_attempt_at").alias("attempt_month"),
            "attempt_count",
            "eventually_succeeded",
        )
    )
    invoices = t["invoices"].select("invoice_id", "account_id", F.coalesce("total_eur", F.lit(0)).alias("total_eur"))
    recovered = F.col("eventually_succeeded")
    return summarise_through(
        outcomes.join(invoices, "invoice_id"),
        "account_id",
        t["accounts"].select("account_id", "country_code", "segment"),
        ["attempt_month", "country_code", "segment"],
        [
            count("failed_invoices"),
            count("recovered_invoices", recovered),
            total("failed_value_eur", "total_eur"),
            total("recovered_value_eur", "total_eur", recovered, empty=0),
            mean("average_attempts", "attempt_count"),
            rate("recovery_rate", count("recovered", recovered), count("failed")),
        ],
    )


def product_adoption(t) -> DataFrame:
    """Adoption over the accounts that used the product; completion is the mean of account ratios."""
    sums = ("sessions", "work_orders_created", "work_orders_completed", "automation_runs", "api_calls")
    monthly = summarise(
        t["account_usage_daily"].withColumn("activity_month", month_of("activity_date")),
        ["account_id", "activity_month"],
        [
            highest("active_users", "active_users"),
            *(total(c, c) for c in sums),
            highest("feature_breadth", "feature_breadth"),
        ],
    ).fillna(0)
    completion = divide(F.col("work_orders_completed"), F.col("work_orders_created"))
    adopted = lambda c: F.when(F.col(c) > 0, 1).otherwise(0)
    return summarise(
        monthly.join(t["accounts"].select("account_id", "country_code", "region_id", "segment"), "account_id"),
        ["activity_month", "country_code", "region_id", "segment"],
        [
            count("active_accounts"),
            total("active_users", "active_users"),
            total("sessions", "sessions"),
            total("work_orders_created", "work_orders_created"),
            # A fixed number of digits keeps the mean independent of row order.
            mean("work_order_completion_rate", completion.cast("decimal(20,12)")),
            mean("automation_adoption_rate", adopted("automation_runs")),
            mean("api_adoption_rate", adopted("api_calls")),
            mean("average_feature_breadth", "feature_breadth"),
        ],
    )


def account_health(t) -> DataFrame:
    """Health history with the account's revenue of the month, 0 where it has none."""
    revenue = account_mrr_monthly(t).select("account_id", F.col("month_start").alias("health_month"), "mrr_eur")
    return t["account_health_history"].join(revenue, ["account_id", "health_month"], "left").fillna(0, ["mrr_eur"])


def country_performance(t) -> DataFrame:
    """Revenue of the latest month beside all invoices, by country."""
    place = ["country_code", "region_id"]
    accounts = t["accounts"].select("account_id", *place)
    current = account_mrr_in(t, latest_month(t)).where("running_items > 0").join(accounts, "account_id")
    revenue = summarise(current, place, [count("active_accounts"), total("mrr_eur", "mrr_eur")])
    paid = F.col("invoice_status") == "paid"
    billed = summarise_through(
        t["invoices"],
        "account_id",
        accounts,
        place,
        [
            total("invoiced_revenue_eur", F.coalesce("total_eur", F.lit(0))),
            count("invoices"),
            rate("paid_invoice_rate", count("paid", paid), count("all")),
        ],
    )
    return revenue.join(billed, place, "full_outer").fillna(0)


def unit_economics(t) -> DataFrame:
    return spend_and_acquisition(t, "new_customers").withColumnRenamed("month_start", "month")


def executive_summary(t, quality: DataFrame, first_month: Column, last_month: Column) -> DataFrame:
    """One row of headline figures; ``quality`` holds check results with a ``passed`` flag."""
    closing = (
        mrr_bridge(t, first_month, last_month).orderBy(F.col("month").desc()).limit(1).select("month", "closing_mrr")
    )
    active = account_mrr_in(t, latest_month(t)).agg(F.count(F.when(F.col("running_items") > 0, 1)).alias("n"))
    retained = revenue_retention(t).where("net_revenue_retention is not null").agg(
        F.max_by("net_revenue_retention", "month").alias("nrr")
    )
    failed = t["payment_attempts"].agg(F.count(F.when(F.col("attempt_status") == "failed", 1)).alias("n"))
    risk = (
        t["account_health_history"]
        .groupBy("health_month")
        .agg(F.count(F.when(F.col("renewal_risk_flag"), 1)).alias("n"))
        .agg(F.max_by("n", "health_month").alias("n"))
    )
    checks = quality.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("passed"), 1)).alias("failed"))
    scalar = lambda frame, column: frame.select(column).scalar()
    return closing.select(
        F.col("month").alias("reporting_month"),
        scalar(active, "n").alias("active_accounts"),
        F.col("closing_mrr").alias("closing_mrr_eur"),
        F.round(F.col("closing_mrr") * 12, 2).alias("arr_eur"),
        F.round(scalar(retained, "nrr"), 4).alias("net_revenue_retention"),
        scalar(failed, "n").alias("failed_payment_attempts"),
        F.coalesce(scalar(risk, "n"), F.lit(0)).alias("accounts_at_risk"),
        scalar(checks, "n").alias("quality_checks"),
        scalar(checks, "failed").alias("quality_failures"),
    )


def top_countries(t, countries: int) -> DataFrame:
    """Countries with the most revenue, largest first."""
    return country_performance(t).orderBy(F.col("mrr_eur").desc(), "country_code").limit(countries)
