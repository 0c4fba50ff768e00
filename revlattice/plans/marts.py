"""Reusable month, account and invoice grains.

Layout of the recurring-revenue marts: items are joined to their account, reduced
to one row per account and pair of months, stacked with the monthly facts a view
reads, and only then partitioned by account.  Month expansion, monthly sums, the
dense grid and the movement windows all run inside that partitioning, so the
expanded rows are never shuffled, and no account brings more rows to a task than
there are pairs of months.  How many tasks that needs is told by the number of
expanded rows, which one pass over the items' dates gives beforehand.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.functions.dates import MICROS_PER_HOUR, add_months, micros_between, month_of, months_apart
from revlattice.functions.measures import count, highest, mean, rate, summarise, total
from revlattice.operators.intervals import dealt, expand_months, fill_calendar
from revlattice.plans.core import billed_invoices, subscription_items_enriched

ACCOUNT_DIMENSIONS = ("country_code", "region_id", "segment", "sales_motion", "acquisition_channel")


def subscription_item_monthly(t) -> DataFrame:
    return expand_months(subscription_items_enriched(t), "effective_start", "effective_end").select(
        "month_start",
        "subscription_item_id",
        "subscription_id",
        "account_id",
        "item_type",
        "plan_id",
        "plan_name",
        "add_on_id",
        "add_on_name",
        "quantity",
        "mrr_local",
        "mrr_eur",
    )


def _item_spans(t, plans: DataFrame) -> DataFrame:
    """Items with their first and last month and what ``plans`` says of their plan."""
    is_plan = F.col("item_type") == "plan"
    described = [c for c in plans.columns if c != "plan_id"]
    return (
        t["subscription_items"]
        .join(plans, "plan_id", "left")
        .select(
            "subscription_id",
            month_of("effective_start").alias("first_month"),
            month_of("effective_end").alias("last_month"),
            *(F.when(is_plan, F.col(c)).alias(c) for c in ("plan_id", *described)),
            F.when(is_plan, F.col("quantity")).alias("paid_seats"),
            F.when(F.col("item_type") == "add_on", 1).otherwise(0).alias("active_add_ons"),
            "mrr_local",
            "mrr_eur",
        )
        .where("first_month <= last_month")
    )


_SPAN = ("first_month", "last_month")


class Extent(NamedTuple):
    """Months that items cover, one by one and from the first to the last of all."""

    item_months: int
    calendar: int


def item_extent(t) -> Extent:
    """One pass over the dates of the items, whoever owns them: no more months can come of them."""
    first, last = month_of("effective_start"), month_of("effective_end")
    found = t["subscription_items"].where(first <= last).agg(
        F.sum(months_apart(last, first) + 1), months_apart(F.max(last), F.min(first)) + 1
    )
    return Extent(*(n or 0 for n in found.first()))


def _distinct(frame: DataFrame, key: str) -> int:
    """About how many keys there are, as a size for tasks."""
    return frame.agg(F.approx_count_distinct(key)).first()[0]


def _span_measures(*plan_columns: str) -> list:
    return [
        *(highest(c, c) for c in plan_columns),
        highest("paid_seats", "paid_seats"),
        total("active_add_ons", "active_add_ons"),
        total("mrr_local", "mrr_local"),
        total("mrr_eur", "mrr_eur"),
    ]


def subscription_monthly(t, item_months: int | None = None) -> DataFrame:
    """Subscriptions by month; ``item_months`` is that of ``item_extent``, where the caller knows it."""
    item_months = item_extent(t).item_months if item_months is None else item_months
    measures = _span_measures("plan_id", "plan_name")
    items = _item_spans(t, t["plans"].select("plan_id", "plan_name"))
    spans = summarise(items, ["subscription_id", *_SPAN], measures)
    owned = spans.join(t["subscriptions"].select("subscription_id", "account_id"), "subscription_id")
    # Expanded rows stay where their subscription is, however the join was made.
    months = expand_months(dealt(owned, "subscription_id", item_months), "first_month", "last_month")
    return summarise(months, ["month_start", "subscription_id", "account_id"], measures)


def _plan_places(t) -> DataFrame:
    """Plans with the place of their name in alphabetical order.

    The highest place stands for the last name, and a number keeps every
    aggregation of the account marts hash-based, which text would not.
    """
    alphabetical = Window.orderBy(F.col("plan_name").asc_nulls_first())
    return t["plans"].select("plan_id", "plan_name", F.dense_rank().over(alphabetical).alias("plan_place"))


def _with_plan_name(t, frame: DataFrame) -> DataFrame:
    names = _plan_places(t).groupBy("plan_place").agg(F.max("plan_name").alias("primary_plan_name"))
    return frame.join(names, "plan_place", "left").drop("plan_place")


def account_spans(t) -> DataFrame:
    """Recurring revenue per account and (first month, last month)."""
    owners = t["subscriptions"].select("subscription_id", "account_id")
    owned = _item_spans(t, _plan_places(t).select("plan_id", "plan_place")).join(owners, "subscription_id")
    return summarise(owned, ["account_id", *_SPAN], _span_measures("plan_place"))


def _account_months(t, since: date | None = None, calendar: int = 0) -> DataFrame:
    """Sums of sums and maxima of maxima: the subscription level needs no pass of its own.

    ``calendar`` is the months to which the caller fills every account.
    """
    # The same frame of items tells the extent, which expands nothing, and gives the spans.
    t = ChainMap({"subscription_items": t["subscription_items"]}, t)
    spans = account_spans(t)
    if since is not None:
        spans = spans.withColumn("first_month", F.greatest("first_month", F.lit(since)))
    accounts, extent = _distinct(t["subscriptions"], "account_id"), item_extent(t)
    rows = max(min(extent.item_months, accounts * extent.calendar), accounts * calendar)
    months = expand_months(dealt(spans, "account_id", rows), "first_month", "last_month")
    return summarise(months, ["account_id", "month_start"], _span_measures("plan_place"))


_ACCOUNT_MONTH = (
    "month_start",
    "account_id",
    "mrr_eur",
    "mrr_local",
    "paid_seats",
    "active_add_ons",
    "primary_plan_name",
)


#: Marts that ``write_marts`` stores once per run; plans read them where the tables hold them under these names.
STORED = ("mart_account_mrr_monthly", "mart_mrr_movements", "mart_account_month")
#: What a refresh carries of the months before: each account's first month, and its first one with revenue above zero.
STATE = "mart_account_state"


def account_mrr_monthly(t, calendar: int = 0) -> DataFrame:
    if STORED[0] in t:
        return t[STORED[0]]
    return _with_plan_name(t, _account_months(t, calendar=calendar)).select(*_ACCOUNT_MONTH)


def account_mrr_since(t, since: date) -> DataFrame:
    """The months of ``account_mrr_monthly`` from ``since`` on, without expanding earlier ones."""
    running = {"subscription_items": t["subscription_items"].where(F.col("effective_end") >= F.lit(since))}
    return _with_plan_name(t, _account_months(ChainMap(running, t), since)).select(*_ACCOUNT_MONTH)


def next_month(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def month_bounds(t) -> DataFrame:
    """First and last month with recurring revenue (one row), from the stored mart's partitions where there is one."""
    if STORED[0] in t:
        return t[STORED[0]].agg(F.min("month_start").alias("first_month"), F.max("month_start").alias("last_month"))
    items = t["subscription_items"].select(
        "subscription_id",
        month_of("effective_start").alias("first_month"),
        month_of("effective_end").alias("last_month"),
    )
    owned = items.where("first_month <= last_month").join(
        t["subscriptions"].select("subscription_id"), "subscription_id", "left_semi"
    )
    return owned.agg(F.min("first_month").alias("first_month"), F.max("last_month").alias("last_month"))


_MRR_ZERO = ("mrr_eur", "mrr_local", "paid_seats", "active_add_ons")


def account_mrr_complete(t) -> DataFrame:
    """Every account with revenue in every month between the first and last with revenue."""
    return _with_plan_name(t, account_grid(t)).select(*_ACCOUNT_MONTH)


def _revenue_spans(t) -> DataFrame:
    """Revenue per account and months: single months where the mart is stored, else the spans of the items."""
    if STORED[0] not in t:
        return account_spans(t)
    places = _plan_places(t).groupBy("plan_name").agg(F.max("plan_place").alias("plan_place"))
    stored = t[STORED[0]].join(places.withColumnRenamed("plan_name", "primary_plan_name"), "primary_plan_name", "left")
    return stored.select("account_id", *(F.col("month_start").alias(c) for c in _SPAN), *(m.name for m in _span_measures("plan_place")))


def account_grid(t, *facts: str, extra: dict[str, DataFrame] | None = None) -> DataFrame:
    """Dense account-month grid with recurring revenue and monthly facts.

    Revenue spans and facts are stacked, partitioned by account once, expanded
    and merged there; no grid row is joined or shuffled.  ``extra`` adds integer
    columns, each from a frame of (account_id, month_start, value).  Facts of
    accounts without revenue, and outside the months with revenue, drop out.
    """
    bounds = month_bounds(t).select(F.struct("first_month", "last_month")).scalar()
    owners = t[STORED[0]] if STORED[0] in t else t["subscriptions"]
    calendar = _stored_calendar(t) if STORED[0] in t else item_extent(t).calendar
    # Facts of accounts without revenue are dropped only where all rows of an account have met.
    accounts = max(_distinct(owners, "account_id"), t["accounts"].count() if facts or extra else 0)
    return _grid(t, _revenue_spans(t), facts, extra or {}, bounds["first_month"], bounds["last_month"], accounts * calendar)


def _stored_calendar(t) -> int:
    return month_bounds(t).select(months_apart("last_month", "first_month") + 1).first()[0] or 0


def _grid(
    t, revenue: DataFrame, facts: Sequence[str], extra: dict[str, DataFrame], first_month: Column, last_month: Column, size: int
) -> DataFrame:
    """The grid of the accounts in ``revenue`` (spans) between two months, of about ``size`` rows."""
    added = {name: _fact(t, name) for name in facts}
    counts = [c for name in facts for c in FACTS[name] if name != "health"]
    scores = [c for name in facts for c in FACTS[name] if name == "health"]
    rows = revenue.withColumn("_revenue", F.lit(1))
    monthly = [*added.values(), *extra.values()]
    for frame in monthly:
        spans = frame.withColumnsRenamed({"month_start": "first_month"}).withColumn("last_month", F.col("first_month"))
        rows = rows.unionByName(spans, allowMissingColumns=True)
    months = expand_months(dealt(rows, "account_id", size), "first_month", "last_month")
    others = [*counts, *scores, *extra]
    merged = summarise(
        months,
        ["account_id", "month_start"],
        [*_span_measures("plan_place"), highest("_revenue", "_revenue"), *(highest(c, c) for c in others)],
    )
    if monthly:
        has_revenue = F.max("_revenue").over(Window.partitionBy("account_id"))
        inside = F.col("month_start").between(first_month, last_month)
        merged = merged.withColumn("_any", has_revenue).where((F.col("_any") == 1) & inside)
    return fill_calendar(
        merged,
        key="account_id",
        month="month_start",
        first_month=first_month,
        last_month=last_month,
        zero=(*_MRR_ZERO, *counts, *extra),
        blank=("plan_place", *scores),
    )


def account_state(t) -> DataFrame:
    """First month of every account in the revenue mart, and its first month with revenue above zero."""
    return account_mrr_monthly(t).groupBy("account_id").agg(
        F.min("month_start").alias("first_month"), F.min(F.when(F.col("mrr_eur") > 0, F.col("month_start"))).alias("first_active")
    )


def carried_state(before: DataFrame, later: DataFrame, since: date) -> DataFrame:
    """The state after months from ``since`` on were replaced by ``later``; what ``before`` says of them is forgotten."""
    known = before.select(
        "account_id", *(F.when(F.col(c) < F.lit(since), F.col(c)).alias(c) for c in ("first_month", "first_active"))
    ).where("first_month is not null")
    fresh = account_state({STORED[0]: later})
    return known.unionByName(fresh).groupBy("account_id").agg(F.min("first_month").alias("first_month"), F.min("first_active").alias("first_active"))


#: The dates by which the source tables of the monthly facts are cut.
_FACT_DATES = {
    "account_usage_daily": "activity_date",
    "support_tickets": "created_at",
    "invoices": "invoice_date",
    "account_health_history": "health_month",
}


def _grid_between(t, state: DataFrame, facts: Sequence[str], since: date | None, until: date | None) -> DataFrame:
    """Months of the grid from ``since`` on, or before ``until``, for the accounts of ``state``, with ``_active_before``.

    ``t`` holds the revenue mart; without ``until``, all accounts with revenue from the month before ``since`` on are in
    ``state``, so that revenue need not be held against it.  Every account gets a row in the month before, so that its last revenue is at hand; whether
    it had revenue above zero before that month, the state tells.
    """
    bounds = month_bounds(t).select(F.struct("first_month", "last_month")).scalar()
    first = bounds["first_month"] if since is None else F.add_months(F.lit(since), -1)
    last = bounds["last_month"] if until is None else F.add_months(F.lit(until), -1)
    cut = {}
    for table, column in _FACT_DATES.items():
        inside = F.lit(True) if since is None else F.col(column) >= F.lit(since)
        cut[table] = t[table].where(inside if until is None else inside & (F.col(column) < F.lit(until)))
    revenue = _revenue_spans(t).where((F.col("first_month") >= first) & (F.col("last_month") <= last))
    if until is not None:
        revenue = revenue.join(state.select("account_id"), "account_id", "left_semi")
    # Sums over no rows are NULL, as in a month without revenue.
    carried = state.select("account_id", F.when(F.col("first_active") < first, 1).otherwise(0).alias("active"))
    seeds = carried.select("account_id", first.alias("first_month"), first.alias("last_month"))
    extra = {"_carried": carried.select("account_id", first.alias("month_start"), F.col("active").alias("_carried"))}
    size = state.count() * _stored_calendar(t)
    grid = _grid(ChainMap(cut, t), revenue.unionByName(seeds, allowMissingColumns=True), facts, extra, first, last, size)
    moved = with_movement(grid, F.greatest(F.when(F.col("mrr_eur") > 0, 1).otherwise(0), F.col("_carried")))
    return moved if since is None else moved.where(F.col("month_start") >= F.lit(since))


def movements_between(t, state: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """The rows of ``mrr_movements`` from ``since`` on, or before ``until``, for the accounts of ``state``."""
    return _grid_between(t, state, (), since, until).select(*_MOVEMENT)


def account_month_between(t, state: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """The same rows of ``account_month`` with all facts."""
    grid = _with_plan_name(t, _grid_between(t, state, tuple(FACTS), since, until))
    accounts = t["accounts"].select("account_id", *ACCOUNT_DIMENSIONS)
    return grid.join(accounts, "account_id").select(*_account_month_columns(FACTS))


def movement_type(previous: Column, current: Column, active_before: Column) -> Column:
    starts = (previous == 0) & (current > 0)
    return (
        F.when(starts & ~active_before, "new")
        .when(starts, "reactivation")
        .when((previous > 0) & (current == 0), "churn")
        .when((previous > 0) & (current > previous), "expansion")
        .when((current > 0) & (current < previous), "contraction")
        .otherwise("no_change")
    )


def with_movement(frame: DataFrame, paying: Column | None = None) -> DataFrame:
    """Add previous MRR, movement and its type to a dense account-month frame.

    ``paying`` is 1 where an account counts as active from that month on: where it has revenue, unless told otherwise.
    """
    order = Window.partitionBy("account_id").orderBy("month_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(frame.schema["mrr_eur"].dataType)
    paying = F.when(F.col("mrr_eur") > 0, 1).otherwise(0) if paying is None else paying
    return (
        frame.withColumn("previous_mrr", F.coalesce(F.lag("mrr_eur").over(order), zero))
        .withColumn("_active_before", F.coalesce(F.max(paying).over(before), F.lit(0)) == 1)
        .withColumn("movement_mrr", F.col("mrr_eur") - F.col("previous_mrr"))
        .withColumn(
            "movement_type", movement_type(F.col("previous_mrr"), F.col("mrr_eur"), F.col("_active_before"))
        )
    )


_MOVEMENT = ("month_start", "account_id", "previous_mrr", "mrr_eur", "movement_mrr", "movement_type")


def mrr_movements(t) -> DataFrame:
    if STORED[1] in t:
        return t[STORED[1]]
    return with_movement(account_mrr_complete(t).select("month_start", "account_id", "mrr_eur")).select(*_MOVEMENT)


def active_movements(t) -> DataFrame:
    """The movements of ``mrr_movements`` without the empty account-months.

    A row outside the grid's activity (no revenue now or a month ago) moves
    nothing, so monthly totals need only each month with revenue and the month
    after it.  ``is_revenue_month`` is false for that added month, which may lie
    one past the last month of the grid.
    """
    order = Window.partitionBy("account_id").orderBy("month_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    paying = F.when(F.col("mrr_eur") > 0, 1).otherwise(0)
    account_mrr = account_mrr_monthly(t).select("month_start", "account_id", "mrr_eur")
    zero = F.lit(0).cast(account_mrr.schema["mrr_eur"].dataType)
    placed = account_mrr.select(
        "account_id",
        "month_start",
        "mrr_eur",
        F.lag("month_start").over(order).alias("_last"),
        F.lag("mrr_eur").over(order).alias("_last_mrr"),
        F.lead("month_start").over(order).alias("_next"),
        (F.coalesce(F.max(paying).over(before), F.lit(0)) == 1).alias("_active_before"),
    )
    following = add_months("month_start", 1)
    own = F.struct(
        F.col("month_start"),
        F.when(F.col("_last").eqNullSafe(add_months("month_start", -1)), F.col("_last_mrr"))
        .otherwise(zero)
        .alias("previous_mrr"),
        F.col("mrr_eur"),
        F.lit(True).alias("is_revenue_month"),
    )
    after = F.struct(
        following.alias("month_start"),
        F.col("mrr_eur").alias("previous_mrr"),
        zero.alias("mrr_eur"),
        F.lit(False).alias("is_revenue_month"),
    )
    falls_silent = ~F.col("_next").eqNullSafe(following) & (F.col("mrr_eur") != 0)
    rows = placed.select(
        "account_id",
        "_active_before",
        F.inline(F.when(falls_silent, F.array(own, after)).otherwise(F.array(own))),
    )
    return rows.select(
        *_MOVEMENT[:4],
        (F.col("mrr_eur") - F.col("previous_mrr")).alias("movement_mrr"),
        movement_type(F.col("previous_mrr"), F.col("mrr_eur"), F.col("_active_before")).alias("movement_type"),
        "is_revenue_month",
    )


def account_usage_monthly(t) -> DataFrame:
    usage = t["account_usage_daily"].withColumn("month_start", month_of("activity_date"))
    return summarise(
        usage,
        ["month_start", "account_id"],
        [
            highest("active_users", "active_users"),
            highest("active_mobile_users", "active_mobile_users"),
            total("sessions", "sessions"),
            total("work_orders_created", "work_orders_created"),
            total("work_orders_completed", "work_orders_completed"),
            total("automation_runs", "automation_runs"),
            total("api_calls", "api_calls"),
            total("documents_uploaded", "documents_uploaded"),
            highest("feature_breadth", "feature_breadth"),
        ],
    )


def support_monthly(t) -> DataFrame:
    tickets = t["support_tickets"].withColumn("month_start", month_of("created_at"))
    return summarise(
        tickets,
        ["month_start", "account_id"],
        [
            count("tickets"),
            count("escalated_tickets", F.col("escalated_flag")),
            mean("avg_first_response_hours", micros_between("first_response_at", "created_at"), unit=MICROS_PER_HOUR),
            mean("avg_resolution_hours", micros_between("resolved_at", "created_at"), unit=MICROS_PER_HOUR),
            mean("avg_csat", "csat_score"),
            total("reopened_count", "reopened_count"),
        ],
    )


def payment_monthly(t) -> DataFrame:
    invoices = t["invoices"].withColumn("month_start", month_of("invoice_date"))
    paid = F.col("invoice_status") == "paid"
    return summarise(
        invoices,
        ["month_start", "account_id"],
        [
            count("invoices"),
            count("paid_invoices", paid),
            count("unpaid_invoices", F.col("invoice_status").isin("overdue", "open")),
            total("invoiced_eur", "total_eur"),
            total("paid_eur", "total_eur", paid),
        ],
    )


_USAGE_COUNTS = (
    "active_users",
    "sessions",
    "work_orders_created",
    "work_orders_completed",
    "automation_runs",
    "api_calls",
    "feature_breadth",
)
FACTS = {
    "usage": _USAGE_COUNTS,
    "support": ("support_tickets", "escalated_tickets"),
    "payments": ("unpaid_invoices",),
    "health": ("health_score", "health_segment", "renewal_risk_flag"),
}


def _fact(t, name: str) -> DataFrame:
    """One row per account and month with the fact's columns."""
    keys = ("account_id", "month_start")
    if name == "usage":
        return account_usage_monthly(t).select(*keys, *_USAGE_COUNTS)
    if name == "support":
        return support_monthly(t).select(*keys, F.col("tickets").alias("support_tickets"), "escalated_tickets")
    if name == "payments":
        return payment_monthly(t).select(*keys, "unpaid_invoices")
    return t["account_health_history"].select(
        "account_id", F.col("health_month").alias("month_start"), *FACTS["health"]
    )


def _account_month_columns(facts: Sequence[str]) -> list[str]:
    added = [c for name in facts for c in FACTS[name]]
    return ["month_start", "account_id", *ACCOUNT_DIMENSIONS, "mrr_eur", "paid_seats", "active_add_ons", "primary_plan_name", *added]


def account_month(t, *facts: str, extra: dict[str, DataFrame] | None = None) -> DataFrame:
    """Account-month fact over the dense grid; accounts without a master row drop out.

    Views name the facts they read (``FACTS`` for all), so no unused table is scanned.
    """
    accounts = t["accounts"].select("account_id", *ACCOUNT_DIMENSIONS)
    columns = _account_month_columns(facts)
    if STORED[2] in t and not extra:
        return t[STORED[2]].select(*columns)
    grid = _with_plan_name(t, account_grid(t, *facts, extra=extra))
    return grid.join(accounts, "account_id").select(*columns, *(extra or {}))


def latest_month(t) -> Column:
    """Last month with recurring revenue, as a scalar subquery."""
    return month_bounds(t).select("last_month").scalar()


def account_mrr_in(t, month: Column) -> DataFrame:
    """Recurring revenue of one month for every account of the grid, without expanding months.

    Where the marts are stored, only that month's partitions of two of them are read.
    """
    if STORED[0] in t and STORED[1] in t:
        in_month = lambda name: t[name].where(F.col("month_start") == month)
        running = in_month(STORED[0]).select("account_id", F.lit(1).cast("bigint").alias("running_items"))
        grid = in_month(STORED[1]).select("account_id", "mrr_eur").join(running, "account_id", "left")
        return grid.select("account_id", "mrr_eur", F.coalesce("running_items", F.lit(0)).alias("running_items"))
    items = t["subscription_items"].select(
        "subscription_id",
        month_of("effective_start").alias("first_month"),
        month_of("effective_end").alias("last_month"),
        "mrr_eur",
    )
    owned = items.where("first_month <= last_month").join(
        t["subscriptions"].select("subscription_id", "account_id"), "subscription_id"
    )
    running = (F.col("first_month") <= month) & (F.col("last_month") >= month)
    return owned.groupBy("account_id").agg(
        F.coalesce(F.sum(F.when(running, F.col("mrr_eur"))), F.lit(0)).alias("mrr_eur"),
        F.count(F.when(running, 1)).alias("running_items"),
    )


def attempt_outcomes(t) -> DataFrame:
    """Payment attempts reduced to one row per invoice, in one pass."""
    succeeded = F.col("attempt_status") == "succeeded"
    first = F.col("attempt_number") == 1
    earliest = F.min(F.struct("attempt_number", "payment_attempt_id", "attempt_status", "attempt_at"))
    return t["payment_attempts"].groupBy("invoice_id").agg(
        F.count("payment_attempt_id").alias("attempt_count"),
        F.min("attempt_at").alias("first_attempt_at"),
        F.min(F.when(succeeded, F.col("attempt_at"))).alias("successful_attempt_at"),
        F.bool_or(F.col("attempt_status") == "failed").alias("any_failure"),
        F.bool_or(succeeded).alias("eventually_succeeded"),
        F.max("attempt_number").alias("maximum_attempt_number"),
        F.max(F.when(first, F.col("payment_method_id"))).alias("first_payment_method_id"),
        earliest["attempt_status"].alias("first_attempt_status"),
        earliest["attempt_at"].alias("first_numbered_attempt_at"),
    )


_INVOICE = (
    "invoice_id",
    "account_id",
    "subscription_id",
    "invoice_date",
    "due_date",
    "total_eur",
    "invoice_status",
)
_OUTCOME = (
    "attempt_count",
    "first_attempt_at",
    "successful_attempt_at",
    "any_failure",
    "eventually_succeeded",
    "maximum_attempt_number",
)


def invoice_outcomes(t) -> DataFrame:
    """Billed invoices with their attempt outcome, without account attributes."""
    outcomes = attempt_outcomes(t)
    return (
        billed_invoices(t)
        .select(*_INVOICE)
        .join(outcomes, "invoice_id", "left")
        .withColumn("attempt_count", F.coalesce("attempt_count", F.lit(0)))
    )


def invoice_payment_summary(t) -> DataFrame:
    accounts = t["accounts"].select("account_id", "country_code", "region_id", "segment")
    return (
        invoice_outcomes(t)
        .join(accounts, "account_id")
        .select(
            *_INVOICE[:5], "country_code", "region_id", "segment", "total_eur", "invoice_status", *_OUTCOME
        )
    )


def sales_funnel_account(t) -> DataFrame:
    """Accounts with their leads, opportunities and subscriptions, one row per child.

    Children of different kinds never share a row, so an account with many
    opportunities and many subscriptions adds their number, not their product.
    What a row's own child cannot say, its account does: off lead rows
    ``reached_mql`` and ``reached_sql`` tell whether any lead of the account got
    there, and ``has_won``, ``became_customer`` and ``first_subscription_date``
    hold for the account on every row.  Distinct counts under flags of two kinds
    of children thus equal those over the multiplied form.
    """
    columns = {
        "lead_id": t["leads"],
        "opportunity_id": t["opportunities"],
        "subscription_id": t["subscriptions"],
        "opportunity_status": t["opportunities"],
        "expected_arr_eur": t["opportunities"],
        "subscription_start_date": t["subscriptions"],
    }
    source = {"opportunity_status": "status"}
    types = {c: f.schema[source.get(c, c)].dataType for c, f in columns.items()}
    unknown = F.lit(None).cast("boolean")

    def children(frame: DataFrame, mql: Column = unknown, sql: Column = unknown, **present: str) -> DataFrame:
        return frame.select(
            "account_id",
            mql.alias("_mql"),
            sql.alias("_sql"),
            *(
                (F.col(present[c]) if c in present else F.lit(None).cast(types[c])).alias(c)
                for c in columns
            ),
        )

    rows = (
        children(
            t["leads"], F.col("mql_at").isNotNull(), F.col("sql_at").isNotNull(), lead_id="lead_id"
        )
        .unionByName(
            children(
                t["opportunities"],
                opportunity_id="opportunity_id",
                opportunity_status="status",
                expected_arr_eur="expected_arr_eur",
            )
        )
        .unionByName(
            children(
                t["subscriptions"],
                subscription_id="subscription_id",
                subscription_start_date="subscription_start_date",
            )
        )
    )
    told = rows.groupBy("account_id").agg(
        F.bool_or("_mql").alias("_any_mql"),
        F.bool_or("_sql").alias("_any_sql"),
        F.bool_or(F.col("opportunity_status") == "won").alias("_won"),
        F.bool_or(F.col("subscription_id").isNotNull()).alias("_customer"),
        F.min("subscription_start_date").alias("first_subscription_date"),
    )
    accounts = t["accounts"].select("account_id", *ACCOUNT_DIMENSIONS).join(told, "account_id", "left")
    # An inner join may split a frequent account among tasks, an outer one could not.
    owned = rows.join(accounts.where("_customer is not null"), "account_id")
    childless = accounts.where("_customer is null")
    flag = lambda *columns: F.coalesce(*columns, F.lit(False))
    return owned.unionByName(childless, allowMissingColumns=True).select(
        "account_id",
        *ACCOUNT_DIMENSIONS,
        "lead_id",
        flag("_mql", "_any_mql").alias("reached_mql"),
        flag("_sql", "_any_sql").alias("reached_sql"),
        "opportunity_id",
        "opportunity_status",
        "expected_arr_eur",
        "subscription_id",
        "subscription_start_date",
        flag("_customer").alias("became_customer"),
        flag("_won").alias("has_won"),
        "first_subscription_date",
    )


def sales_funnel_crossings(t) -> DataFrame:
    """Accounts, leads and opportunities by segment that meet conditions on children of two kinds."""
    won = F.col("opportunity_status") == "won"
    crossings = {
        "mql_accounts_with_win": ("account_id", F.col("reached_mql") & won),
        "sql_customers": ("account_id", F.col("reached_sql") & F.col("became_customer")),
        "won_opportunities_of_mql": ("opportunity_id", F.col("reached_mql") & won),
        "mql_leads_of_customers": ("lead_id", F.col("reached_mql") & F.col("became_customer")),
        "sql_leads_with_win": ("lead_id", F.col("reached_sql") & F.col("has_won")),
        "winners_without_subscription": ("account_id", won & ~F.col("became_customer")),
    }
    rows = sales_funnel_account(t)
    # One row per account first: its own children are distinct there, so counts of them add up.
    per_account = rows.groupBy("segment", "account_id").agg(
        *(
            (F.max(F.when(when, 1).otherwise(0)) if key == "account_id" else F.count(F.when(when, F.col(key)))).alias(name)
            for name, (key, when) in crossings.items()
        )
    )
    return per_account.groupBy("segment").agg(*(F.sum(name).alias(name) for name in crossings))


def assignment_results(t) -> DataFrame:
    """One row per assignment: exposure rows, outcome rows and outcome sums.

    Joining exposures with outcomes row by row would weight every outcome by the
    number of exposures; ``seen`` and ``measured`` carry those weights instead.
    """
    exposures = t["experiment_exposures"].groupBy("assignment_id").agg(
        F.count(F.lit(1)).alias("exposure_rows"),
        F.sum("exposure_count").alias("exposure_sum"),
        F.count("exposure_count").alias("exposure_values"),
    )
    values = ("primary_outcome", "guardrail_outcome", "revenue_outcome_eur")
    outcomes = t["experiment_outcomes"].groupBy("assignment_id").agg(
        F.count(F.lit(1)).alias("outcome_rows"),
        *(F.sum(v).alias(f"{v}_sum") for v in values),
        *(F.count(v).alias(f"{v}_n") for v in values),
    )
    return (
        t["experiment_assignments"]
        .join(exposures, "assignment_id", "left")
        .join(outcomes, "assignment_id", "left")
        .withColumn("seen", F.greatest(F.coalesce("exposure_rows", F.lit(0)), F.lit(1)))
    )


def weighted_mean(name: str, value: str, weight: Column, when: Column | None = None):
    """Mean over rows repeated ``weight`` times, from per-row sums and counts."""
    return rate(
        name,
        total("sum", F.col(f"{value}_sum") * weight, when),
        total("n", F.col(f"{value}_n") * weight, when),
    )


def experiment_analysis(t) -> DataFrame:
    experiments = t["experiments"].select("experiment_id", "experiment_name")
    results = assignment_results(t)
    weight = F.col("seen")
    return summarise_experiments(
        results,
        experiments,
        [
            count("assigned_accounts"),
            count("exposed_accounts", F.col("exposure_rows").isNotNull()),
            weighted_mean("primary_mean", "primary_outcome", weight),
            weighted_mean("guardrail_mean", "guardrail_outcome", weight),
            weighted_mean("average_revenue_outcome_eur", "revenue_outcome_eur", weight),
        ],
    )


def summarise_experiments(results: DataFrame, experiments: DataFrame, measures: list) -> DataFrame:
    """Aggregate assignments by experiment and variant, then add the experiment's name."""
    arms = summarise(results, ["experiment_id", "variant"], measures)
    return arms.join(experiments, "experiment_id").select(
        "experiment_id", "experiment_name", "variant", *(m.name for m in measures)
    )
