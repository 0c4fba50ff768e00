"""Deterministic warehouse jobs: pricing, invoicing, dunning, renewals, health and assignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.functions.dates import add_months, month_of, months_apart
from revlattice.functions.measures import count, divide, highest, summarise, total
from revlattice.operators.intervals import compress_runs, latest_before, valid_on
from revlattice.plans.marts import account_mrr_monthly, item_extent, subscription_monthly, support_monthly

# Scoring weights, band limits and payment terms.
HEALTH_WEIGHTS = {"usage_score": 0.50, "support_score": 0.15, "payment_score": 0.20, "relationship_score": 0.15}
HEALTH_BANDS = ((75, "healthy"), (62, "watch"), (45, "at_risk"))
EMPLOYEE_BANDS = ((10, "1-9"), (50, "10-49"), (250, "50-249"), (1000, "250-999"))
MQL_SCORE = 45
QUALIFIED_SCORE = 55
TRANSFER_DUE_DAYS, OTHER_DUE_DAYS = 30, 3


def banded(value: Column, limits, rest: str, below: bool) -> Column:
    """First label whose limit the value is under (``below``) or at least reaches."""
    chosen = F
    for limit, label in limits:
        chosen = chosen.when(value < limit if below else value >= limit, label)
    return chosen.otherwise(rest)


def employee_band(employees: Column) -> Column:
    return banded(employees, EMPLOYEE_BANDS, "1000+", below=True)


def health_band(score: Column) -> Column:
    return banded(score, HEALTH_BANDS, "critical", below=False)


def nps_group(score: Column) -> Column:
    return banded(score, ((9, "promoter"), (7, "passive")), "detractor", below=False)


def is_mql(score: Column) -> Column:
    return score >= MQL_SCORE


def lead_status(converted: Column, score: Column) -> Column:
    return F.when(converted, "converted").when(score >= QUALIFIED_SCORE, "qualified").otherwise("disqualified")


def contract_status(ended: Column, contract_end: Column, as_of: Column) -> Column:
    return F.when(ended.isNotNull(), "terminated").when(contract_end >= as_of, "active").otherwise("expired")


def invoice_status(paid: Column, due: Column, as_of: Column) -> Column:
    return F.when(paid, "paid").when(due <= as_of, "overdue").otherwise("open")


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def _plan_items(t) -> DataFrame:
    """Plan items with what their price depends on."""
    subscriptions = t["subscriptions"].select("subscription_id", "account_id", "contract_id", "billing_frequency")
    return (
        t["subscription_items"]
        .where("item_type = 'plan' and plan_id is not null")
        .select("subscription_item_id", "subscription_id", "plan_id", "quantity", "effective_start")
        .join(subscriptions, "subscription_id")
        .join(t["accounts"].select("account_id", "country_code"), "account_id")
    )


def price_as_of(t) -> DataFrame:
    """The price-list row in force when each plan item starts."""
    prices = t["plan_prices"].select(
        "plan_id",
        "country_code",
        "billing_frequency",
        F.col("effective_start").alias("price_start"),
        F.col("effective_end").alias("price_end"),
        "plan_price_id",
        "base_price",
        "seat_price",
        "annual_discount_pct",
    )
    keys = ["plan_id", "country_code", "billing_frequency"]
    starts = t["subscription_items"].agg(F.struct(F.min("effective_start").alias("first"), F.max("effective_start").alias("last"))).scalar()
    return valid_on(_plan_items(t), prices, keys, "effective_start", "price_start", "price_end", (starts["first"], starts["last"]))


def plan_mrr(t) -> DataFrame:
    """Plan revenue: base and extra seats, less annual discount, less the extra negotiated discount."""
    plans = t["plans"].select("plan_id", "included_seats")
    contracts = t["contracts"].select("contract_id", F.col("discount_pct").alias("negotiated"))
    small = "decimal(9,4)"
    extra_seats = F.greatest(F.lit(0), F.col("quantity") - F.col("included_seats")).cast("int")
    list_mrr = F.col("base_price").cast("decimal(12,4)") + extra_seats * F.col("seat_price").cast("decimal(12,4)")
    annual = F.col("annual_discount_pct").cast(small)
    extra = F.greatest(F.lit(0).cast(small), F.col("negotiated").cast(small) - annual)
    gross = (list_mrr * (1 - annual)).cast("decimal(24,6)")
    return (
        price_as_of(t)
        .join(plans, "plan_id")
        .join(contracts, "contract_id")
        .select(
            "subscription_item_id",
            "plan_id",
            F.col("quantity").alias("seats"),
            "plan_price_id",
            gross.alias("gross_mrr"),
            (gross * (1 - extra)).cast("decimal(24,6)").alias("plan_mrr"),
        )
    )


def with_fx_rate(frame: DataFrame, rates: DataFrame, currency: str, on: str, missing: str = "raise") -> DataFrame:
    """Add ``eur_rate`` dated the first day of the month of ``on``; EUR is 1, a missing rate raises or stays NULL.

    Rates dated inside a month are not those of the month; date and currency are a rate's key, so no row multiplies.
    """
    monthly = rates.select(
        F.col("currency_code").alias("_currency"), F.col("rate_date").alias("_rate_month"), F.col("eur_rate").alias("_rate")
    )
    joined = frame.join(
        monthly, (F.col(currency) == F.col("_currency")) & (month_of(on) == F.col("_rate_month")), "left"
    )
    rate = F.when(F.col(currency) == "EUR", F.lit(1).cast("decimal(20,6)")).otherwise(F.col("_rate"))
    if missing == "raise":
        rate = F.coalesce(
            rate,
            F.raise_error(F.concat(F.lit("no rate for "), F.col(currency), F.lit(" on "), F.col(on).cast("string"))).cast(
                "decimal(20,6)"
            ),
        )
    return joined.withColumn("eur_rate", rate).drop("_currency", "_rate_month", "_rate")


def fx_convert(t) -> DataFrame:
    """Invoice totals in EUR at the rate of the invoice month."""
    invoices = t["invoices"].select("invoice_id", "invoice_date", "currency_code", "total_local")
    rated = with_fx_rate(invoices, t["fx_rates"], "currency_code", "invoice_date")
    return rated.withColumn(
        "converted_eur", (F.col("total_local").cast("decimal(20,4)") * F.col("eur_rate").cast("decimal(12,6)")).cast("decimal(24,6)")
    )


def compress_to_effective_dates(t) -> DataFrame:
    """Monthly plan and seats as effective-dated rows; a run keeps the revenue of its first month."""
    monthly = subscription_monthly(t).select("subscription_id", "month_start", "plan_id", "paid_seats", "mrr_eur")
    return compress_runs(monthly, "subscription_id", "month_start", ["plan_id", "paid_seats"], first_of=["mrr_eur"])


def account_method(t) -> DataFrame:
    """Each account's first payment method."""
    first = F.min(F.struct("payment_method_id", "method_type"))["method_type"]
    return t["payment_methods"].groupBy("account_id").agg(first.alias("method_type"))


def _billing_terms(t) -> DataFrame:
    """Subscriptions with all their invoices depend on, so monthly rows need no join of their own by account."""
    countries = t["countries"].select("country_code", F.col("vat_rate").cast("decimal(6,4)").alias("vat_rate"), "currency_code")
    due_days = F.when(F.col("method_type") == "bank_transfer", TRANSFER_DUE_DAYS).otherwise(OTHER_DUE_DAYS)
    accounts = (
        t["accounts"]
        .select("account_id", "country_code")
        .join(countries, "country_code")
        .join(account_method(t), "account_id", "left")
        .select("account_id", "vat_rate", "currency_code", due_days.alias("due_days"))
    )
    return (
        t["subscriptions"]
        .select("subscription_id", "account_id", "subscription_start_date", "ended_date", "billing_frequency")
        .join(accounts, "account_id")
    )


def invoice_run(t, as_of: Column) -> DataFrame:
    """Invoices due from monthly subscription revenue: every month, or each twelfth for annual billing."""
    annual = F.col("billing_frequency") == "annual"
    month, started = F.col("month_start"), F.col("subscription_start_date")
    yearly_end = F.least(F.date_sub(add_months("month_start", 12), 1), F.coalesce("ended_date", as_of))
    monthly_end = F.least(F.last_day("month_start"), F.coalesce("ended_date", F.last_day("month_start")))
    subtotal = F.when(annual, F.col("mrr_local") * 12).otherwise(F.col("mrr_local")).cast("decimal(20,4)")
    billed = (
        subscription_monthly(t)
        .select("month_start", "subscription_id", "mrr_local")
        .join(_billing_terms(t), "subscription_id")
        .where(~annual | (F.pmod(months_apart(month, started), F.lit(12)) == 0))
        .select(
            "subscription_id",
            "account_id",
            month.alias("service_period_start"),
            F.when(annual, yearly_end).otherwise(monthly_end).alias("service_period_end"),
            F.greatest(started, month).alias("invoice_date"),
            "due_days",
            "currency_code",
            subtotal.alias("subtotal_local"),
            (subtotal * F.col("vat_rate")).cast("decimal(24,8)").alias("tax_local"),
        )
    )
    taxed = billed.withColumn("due_date", F.date_add("invoice_date", F.col("due_days"))).withColumn(
        "total_local", (F.col("subtotal_local") + F.col("tax_local")).cast("decimal(24,8)")
    )
    rated = with_fx_rate(taxed, t["fx_rates"], "currency_code", "invoice_date")
    total_eur = (F.col("total_local") * F.col("eur_rate").cast("decimal(12,6)")).cast("decimal(34,12)")
    return rated.select(
        "subscription_id",
        "account_id",
        "service_period_start",
        "service_period_end",
        "invoice_date",
        "due_date",
        "currency_code",
        *(F.round(c, 2).alias(c) for c in ("subtotal_local", "tax_local", "total_local")),
        F.round(total_eur, 2).alias("total_eur"),
        invoice_status(F.lit(False), F.col("due_date"), as_of).alias("invoice_status"),
    )


def derived_invoice_status(t, as_of: Column) -> DataFrame:
    """Status each invoice should have given its attempts and due date."""
    succeeded = F.col("attempt_status") == "succeeded"
    paid = t["payment_attempts"].groupBy("invoice_id").agg(F.bool_or(succeeded).alias("paid"))
    return (
        t["invoices"]
        .select("invoice_id", "due_date")
        .join(paid, "invoice_id", "left")
        .select(
            "invoice_id",
            invoice_status(F.coalesce("paid", F.lit(False)), F.col("due_date"), as_of).alias("invoice_status"),
        )
    )


def dunning_from_attempts(t) -> DataFrame:
    """A dunning event for each failed attempt, recovered when the next attempt succeeds.

    The next attempt is met by its number, so attempts of one invoice spread
    over the cluster instead of forming one ordered group.
    """
    attempts = t["payment_attempts"]
    following = (
        attempts.where("attempt_status = 'succeeded'")
        .select("invoice_id", (F.col("attempt_number") - 1).alias("attempt_number"))
        .distinct()
        .withColumn("_next_succeeded", F.lit(True))
    )
    return (
        attempts.where("attempt_status = 'failed'")
        .join(following, ["invoice_id", "attempt_number"], "left")
        .select(
            F.col("payment_attempt_id").alias("dunning_event_id"),
            "invoice_id",
            (F.col("attempt_at") + F.expr("interval 4 hours")).alias("event_at"),
            F.col("attempt_number").alias("dunning_step"),
            F.coalesce("_next_succeeded", F.lit(False)).alias("recovered_after_event_flag"),
        )
    )


def captured_payments(t) -> DataFrame:
    """One captured payment per invoice, from its first successful attempt."""
    first = F.min(F.struct("attempt_number", "payment_attempt_id", "attempt_at", "amount_local", "currency_code"))
    won = t["payment_attempts"].where("attempt_status = 'succeeded'").groupBy("invoice_id").agg(first.alias("a"))
    return won.select(
        F.col("a.payment_attempt_id").alias("payment_id"),
        "invoice_id",
        F.col("a.payment_attempt_id").alias("payment_attempt_id"),
        F.col("a.attempt_at").alias("captured_at"),
        F.col("a.amount_local").alias("amount_local"),
        F.col("a.currency_code").alias("currency_code"),
        F.date_add(F.col("a.attempt_at").cast("date"), 2).alias("settlement_date"),
    )


def renewal_schedule(t, as_of: Column) -> DataFrame:
    """Anniversaries of annual subscriptions with twelve times the revenue known by then."""
    first_due, last_due = add_months("subscription_start_date", 12), F.least(as_of, F.coalesce("ended_date", as_of))
    due = (
        t["subscriptions"]
        .where("billing_frequency = 'annual'")
        .select("subscription_id", first_due.alias("first_due"), last_due.alias("last_due"))
        .where("first_due <= last_due")
        .select(
            "subscription_id",
            F.explode(F.sequence("first_due", "last_due", F.expr("interval 1 year"))).alias("renewal_due_date"),
        )
        .withColumn("due_month", month_of("renewal_due_date"))
    )
    item_months = item_extent(t).item_months
    monthly = subscription_monthly(t, item_months).select("subscription_id", "month_start", "mrr_eur")
    known = latest_before(due, monthly, "subscription_id", "due_month", "month_start", "mrr_eur", item_months + due.count())
    return known.select(
        "subscription_id",
        "renewal_due_date",
        "mrr_eur",
        F.round(F.col("mrr_eur") * 12, 2).alias("renewal_arr_eur"),
        F.lit("renewed").alias("renewal_status"),
    )


def usage_summary_monthly(t) -> DataFrame:
    """Monthly users, seats, utilisation and distinct feature areas per account."""
    usage = summarise(
        t["account_usage_daily"].withColumn("month_start", month_of("activity_date")),
        ["account_id", "month_start"],
        [
            highest("active_users", "active_users"),
            total("sessions", "sessions"),
            total("work_orders", "work_orders_created"),
            total("completed_work_orders", "work_orders_completed"),
            total("automation_runs", "automation_runs"),
        ],
    )
    areas = (
        t["product_events"]
        .select("account_id", month_of("event_at").alias("month_start"), "feature_area")
        .distinct()
        .groupBy("account_id", "month_start")
        .agg(F.count("feature_area").alias("feature_breadth"))
    )
    seats = account_mrr_monthly(t).select("account_id", "month_start", F.col("paid_seats").alias("seats"))
    keys = ["account_id", "month_start"]
    return (
        usage.join(areas, keys, "left")
        .join(seats, keys, "left")
        .fillna(0, ["feature_breadth", "seats"])
        .withColumn(
            "seat_utilisation",
            F.round(divide(F.col("active_users"), F.greatest("seats", F.lit(1))), 4),
        )
        .select(
            *keys,
            "active_users",
            "seats",
            "seat_utilisation",
            "sessions",
            "work_orders",
            "completed_work_orders",
            "automation_runs",
            "feature_breadth",
        )
    )


def invoice_outcomes_monthly(t) -> DataFrame:
    """Unpaid invoices, failed first attempts and recoveries per account and month."""
    succeeded = F.col("attempt_status") == "succeeded"
    attempts = t["payment_attempts"].groupBy("invoice_id").agg(
        F.bool_or((F.col("attempt_number") == 1) & ~succeeded).alias("first_failed"),
        F.bool_or((F.col("attempt_number") > 1) & succeeded).alias("later_success"),
    )
    failed = F.col("first_failed")
    return summarise(
        t["invoices"].join(attempts, "invoice_id", "left").withColumn("month_start", month_of("invoice_date")),
        ["account_id", "month_start"],
        [
            count("overdue_invoices", F.col("invoice_status") != "paid"),
            count("failed_attempts", failed),
            count("recovered", failed & F.col("later_success")),
        ],
    )


def account_health_score(t) -> DataFrame:
    """Sub-scores, weighted score, band and risk flag per account and month of usage."""
    keys = ["account_id", "month_start"]
    support = support_monthly(t).select(*keys, "tickets", "escalated_tickets", "avg_csat")
    accounts = t["accounts"].select("account_id", "sales_motion")
    known = (
        usage_summary_monthly(t)
        .join(support, keys, "left")
        .join(invoice_outcomes_monthly(t), keys, "left")
        .fillna(0)
        .join(accounts, "account_id")
    )
    # Scores are exact to four digits, so rounding and band limits do not depend on float noise.
    exact = lambda c: F.col(c).cast("decimal(14,4)")
    usage = (
        10
        + 50 * exact("seat_utilisation")
        + 3 * exact("feature_breadth")
        + F.least(exact("automation_runs") * F.lit(0.25).cast("decimal(4,2)"), F.lit(5))
    )
    support_score = (
        92
        - 10 * exact("tickets")
        - 20 * exact("escalated_tickets")
        + 4 * F.greatest(F.lit(0), exact("avg_csat") - 3)
    )
    payment = 95 - 48 * exact("overdue_invoices") - 14 * exact("failed_attempts") + 8 * exact("recovered")
    relationship = F.when(F.col("sales_motion") != "self_service", 59).otherwise(48)
    scores = {
        "usage_score": usage,
        "support_score": support_score,
        "payment_score": payment,
        "relationship_score": relationship,
    }
    scored = known.select(*keys, *(clamp(s, 0, 100).cast("decimal(14,4)").alias(n) for n, s in scores.items()))
    weighted = sum(F.lit(w).cast("decimal(4,2)") * F.col(n) for n, w in HEALTH_WEIGHTS.items())
    banded_rows = scored.withColumn("_score", weighted).withColumn("health_segment", health_band(F.col("_score")))
    return banded_rows.select(
        "account_id",
        F.col("month_start").alias("health_month"),
        F.round("_score", 2).alias("health_score"),
        "health_segment",
        *(F.round(n, 2).alias(n) for n in scores),
        F.col("health_segment").isin("at_risk", "critical").alias("renewal_risk_flag"),
    )


#: Experiments that an account meets at once, and the slices of a digest that are counted.
EXPERIMENTS_AT_ONCE, SLICE_DIGITS = 256, 3


def _eligible(t, eligibility: dict[str, str]) -> DataFrame:
    """Accounts with every experiment that they are eligible for, and the digest that orders them there.

    Accounts meet experiments as arrays of bounded size, so that no pair is moved to be made.
    """
    accounts = t["accounts"].select("account_id", "created_at", "country_code", "segment", "sales_motion")
    blocks = max(1, -(-t["experiments"].count() // EXPERIMENTS_AT_ONCE))
    experiments = t["experiments"].select("experiment_id", "end_date", F.pmod(F.xxhash64("experiment_id"), F.lit(blocks)).alias("_block"))
    frames = []
    for block in range(blocks):
        listed = experiments.where(F.col("_block") == block).agg(F.collect_list(F.struct("experiment_id", "end_date"))).scalar()
        frames.append(accounts.select("*", F.inline(listed)).where(F.col("created_at").cast("date") <= F.col("end_date")))
    eligible = reduce(DataFrame.unionByName, frames)
    for experiment, rule in eligibility.items():
        eligible = eligible.where((F.col("experiment_id") != experiment) | F.expr(rule))
    return eligible.withColumn("_digest", F.md5(F.concat_ws("|", "experiment_id", F.col("account_id").cast("string"))))


def experiment_assign(t, eligibility: dict[str, str] | None = None, floor: int = 80, fraction: float = 0.35) -> DataFrame:
    """Balanced assignment of a hash-ordered sample of eligible accounts per experiment.

    The order is a digest of experiment and account, so it is stable and spreads evenly.  Accounts are counted by slice of the
    digest first, which tells the slice where the sample ends; only rows up to there are moved and ranked.
    """
    eligible = _eligible(t, eligibility or {}).withColumn("_slice", F.substring("_digest", 1, SLICE_DIGITS))
    whole = Window.partitionBy("experiment_id")
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.sum("_n").over(whole)
    slices = eligible.groupBy("experiment_id", "_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        "experiment_id",
        "_slice",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.least(rows, F.greatest(F.lit(floor), F.floor(rows * F.lit(fraction)))).alias("_wanted"),
    )
    # Slices up to the end of the sample: as many at most as a digest has, for every experiment.
    sampled = eligible.join(slices.where("_before < _wanted"), ["experiment_id", "_slice"])
    inside = Window.partitionBy("experiment_id", "_slice").orderBy("_digest", "account_id")
    ranked = sampled.withColumn("_rank", F.col("_before") + F.row_number().over(inside))
    return ranked.where(F.col("_rank") <= F.col("_wanted")).select(
        "experiment_id",
        "account_id",
        F.when(F.col("_rank") % 2 == 1, "control").otherwise("treatment").alias("variant"),
        F.concat_ws("|", "country_code", "segment").alias("stratum"),
    )
