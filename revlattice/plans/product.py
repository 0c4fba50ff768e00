"""Product adoption views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import add_months, days_between, month_of
from revlattice.functions.measures import (
    count,
    count_keys,
    divide,
    mean,
    rate,
    share,
    summarise,
    summarise_through,
    total,
)
from revlattice.plans.marts import account_month
from revlattice.plans.revenue import PAYING

PLACE = ["month_start", "region_id", "country_code", "segment"]
USING = "active_users > 0"


def product_adoption(t) -> DataFrame:
    paid = count("paid", PAYING)
    return summarise(
        account_month(t, "usage"),
        PLACE,
        [
            count("paid_accounts", PAYING),
            count("active_accounts", USING),
            total("active_users", "active_users"),
            total("sessions", "sessions"),
            mean("average_feature_breadth", "feature_breadth", USING),
            rate("automation_adoption_rate", count("n", F.col("automation_runs") > 0), paid),
            rate("api_adoption_rate", count("n", F.col("api_calls") > 0), paid),
        ],
    )


def seat_utilisation(t) -> DataFrame:
    seats = F.col("paid_seats")
    used = F.try_divide(F.col("active_users").cast("double"), seats.cast("double"))
    return summarise(
        account_month(t, "usage"),
        [*PLACE, "primary_plan_name"],
        [
            total("active_users", "active_users"),
            total("paid_seats", "paid_seats"),
            rate("seat_utilisation", total("used", "active_users"), total("seats", "paid_seats")),
            count("underutilised_accounts", (seats > 0) & (used < 0.40)),
        ],
    )


def workflow_completion(t) -> DataFrame:
    created, completed = total("created", "work_orders_created"), total("completed", "work_orders_completed")
    return summarise(
        account_month(t, "usage"),
        PLACE,
        [
            total("work_orders_created", "work_orders_created"),
            total("work_orders_completed", "work_orders_completed"),
            rate("completion_rate", completed, created),
            rate("work_orders_per_paid_account", created, count("paid", PAYING)),
        ],
    )


def onboarding_completion(t) -> DataFrame:
    """Tasks counted once per subscription of their account.

    The task x subscription rows are never built: with both sides summed per
    account, counts multiply and day differences split into two sums.
    """
    epoch = F.lit("1970-01-01").cast("date")
    done = F.col("task_status") == "completed"
    tasks = t["onboarding_tasks"].groupBy("account_id").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count(F.when(done, 1)).alias("completed"),
        F.count("completed_at").alias("dated"),
        F.sum(days_between("completed_at", epoch)).alias("completed_days"),
    )
    starts = t["subscriptions"].groupBy("account_id").agg(
        F.count(F.lit(1)).alias("subscriptions"),
        F.count("subscription_start_date").alias("started"),
        F.sum(days_between("subscription_start_date", epoch)).alias("start_days"),
    )
    by = ["country_code", "region_id", "segment", "sales_motion"]
    pairs = F.col("tasks") * F.col("subscriptions")
    finished = F.col("completed") * F.col("subscriptions")
    days = F.coalesce("completed_days", F.lit(0)) * F.col("started") - F.coalesce("start_days", F.lit(0)) * F.col("dated")
    return summarise(
        tasks.join(starts, "account_id").join(t["accounts"].select("account_id", *by), "account_id"),
        by,
        [
            count("onboarding_accounts"),
            total("onboarding_tasks", pairs),
            total("completed_tasks", finished),
            rate("task_completion_rate", total("finished", finished), total("pairs", pairs)),
            rate("average_days_to_task", total("days", days), total("n", F.col("dated") * F.col("started"))),
        ],
    )


def time_to_first_value(t) -> DataFrame:
    first_completed = (
        t["work_orders"]
        .where("status = 'completed'")
        .groupBy("account_id")
        .agg(F.min("completed_at").alias("first_completed_at"))
    )
    by = ["country_code", "region_id", "segment", "sales_motion"]
    accounts = first_completed.join(t["accounts"].select("account_id", *by), "account_id")
    # Subscriptions of one account differ only in their start date.
    starts = t["subscriptions"].groupBy("account_id", "subscription_start_date").agg(F.count(F.lit(1)).alias("_n"))
    counted = (
        starts.join(accounts, "account_id")
        .withColumn("_days", days_between("first_completed_at", "subscription_start_date"))
        .groupBy(*by, "_days")
        .agg(F.sum("_n").alias("_n"))
    )
    return counted.groupBy(*by).agg(
        divide(F.sum(F.col("_days") * F.col("_n")), F.sum(F.when(F.col("_days").isNotNull(), F.col("_n")))).alias(
            "average_days_to_first_completed_work_order"
        ),
        F.percentile("_days", 0.5, F.col("_n")).alias("median_days_to_first_value"),
    )


def integration_adoption(t) -> DataFrame:
    by = ["region_id", "country_code", "segment"]
    return summarise_through(
        t["integrations"],
        "account_id",
        t["accounts"].select("account_id", *by),
        [*by, "integration_type"],
        [
            count_keys("connected_accounts"),
            mean("average_monthly_sync_volume", "monthly_sync_volume"),
            share("active_integration_rate", F.col("integration_status") == "active"),
        ],
    )


def usage_before_churn(t) -> DataFrame:
    """Average usage in the three months up to each churned subscription's last month.

    Churn months are counted per account first and spread over the months they
    look back on, which turns the range condition into an equality join.
    """
    ended = month_of("ended_date")
    churned = (
        t["subscriptions"]
        .where(F.col("ended_date").isNotNull())
        .groupBy("account_id", ended.alias("ended_month"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    windows = (
        churned.select(
            "account_id",
            "_n",
            F.explode(F.array(*(add_months("ended_month", -back) for back in range(3)))).alias("month_start"),
        )
        .groupBy("account_id", "month_start")
        .agg(F.sum("_n").alias("_n"))
    )
    months = account_month(t, "usage", extra={"_n": windows}).where("_n > 0")

    def weighted(name: str, column: str):
        return rate(name, total("sum", F.col(column) * F.col("_n")), total("n", "_n"))

    return summarise(
        months,
        ["segment", "primary_plan_name"],
        [
            weighted("average_active_users", "active_users"),
            weighted("average_sessions", "sessions"),
            weighted("average_feature_breadth", "feature_breadth"),
            weighted("average_completed_work_orders", "work_orders_completed"),
        ],
    )
