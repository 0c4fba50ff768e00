"""Data quality: contract checks on landed text, business rules, controls and reconciliations.

A table is scanned once for all its predicates, which are counted as it is
read: one row of counts per task is all that moves.  Keys of all tables share
one shuffle each for uniqueness and for references.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.contracts import CONTRACTS, WHOLE_NUMBER, references_of
from revlattice.operators.intervals import overlapping_pairs
from revlattice.plans.billing import invoice_reconciliation
from revlattice.plans.reports import to_number
from revlattice.plans.revenue import bridge_reconciliation
from revlattice.session import shuffles_dropped

CHECK_COLUMNS = ("check_id", "table_name", "check_type", "severity", "passed", "failure_count", "details")
CHECKED = (
    "check_id string, table_name string, check_type string, severity string, passed boolean,"
    " failure_count bigint, details string"
)


@dataclass(frozen=True)
class Check:
    check_id: str
    table: str
    kind: str
    details: str
    severity: str = "error"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union in pairs, so that building n branches does not analyse n growing plans."""
    frames = list(frames)
    while len(frames) > 1:
        paired = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = paired + frames[len(paired) * 2 :]
    return frames[0]


def failing_counts(frame: DataFrame, failing: Sequence[tuple[str, Column | str]]) -> DataFrame:
    """How many rows fail each check: one aggregate over one scan, so no row is made per predicate.

    A predicate is a column or SQL text; where it is unknown a row does not fail.
    """
    counts = [F.count(F.when(F.expr(bad) if isinstance(bad, str) else bad, 1)).alias(f"_{i}") for i, (_, bad) in enumerate(failing)]
    cells = ", ".join(f"struct('{name}' as check_id, _{i} as failure_count)" for i, (name, _) in enumerate(failing))
    return frame.agg(*counts).selectExpr(f"inline(array({cells}))")


def _summed(counted: Sequence[DataFrame]) -> DataFrame:
    """Failures per check over all frames; each brings one row per check."""
    return _union(counted).groupBy("check_id").agg(F.sum("failure_count").alias("failure_count"))


def _described(counted: DataFrame, checks: Sequence[Check], how: str = "right") -> DataFrame:
    """Complete (check_id, failure_count) rows with what each check declares.

    Checks without a row have no failures; with ``how="inner"`` they are left out.
    """
    rows = [(c.check_id, c.table, c.kind, c.severity, c.details) for c in checks]
    declared = counted.sparkSession.createDataFrame(
        rows, "check_id string, table_name string, check_type string, severity string, details string"
    )
    return (
        counted.join(declared, "check_id", how)
        .withColumn("failure_count", F.coalesce("failure_count", F.lit(0)))
        .withColumn("passed", F.col("failure_count") == 0)
        .select(*CHECK_COLUMNS)
    )


# What makes non-null text unreadable as a logical type; {c} is the column as text.
_UNREADABLE = {
    # As the cast reads it: digits, and zeros only behind a point.
    "integer": "not (trim({c}) rlike '" + WHOLE_NUMBER + "') or try_cast(try_cast(trim({c}) as decimal(38,6)) as bigint) is null",
    "decimal": "try_cast(trim({c}) as decimal(38,6)) is null",
    "date": "try_cast(trim({c}) as timestamp_ntz) is null",
    "timestamp": "try_cast(trim({c}) as timestamp_ntz) is null",
    "boolean": "{c} not in ('true', 'false', 'True', 'False', '1', '0')",
}


def type_failure(column: str, logical: str) -> str:
    """SQL text that is true where a non-null value does not read as the logical type."""
    if logical == "string":
        return "false"
    return f"({column} is not null and ({_UNREADABLE[logical].format(c=f'cast({column} as string)')}))"


def column_checks(landing: Mapping[str, DataFrame], tables: Sequence[str] = tuple(CONTRACTS)) -> DataFrame:
    """Missing tables and columns, and values that do not fit their type.

    A table without a declared column reports that and is not checked further.
    """
    frames, checks, declared = [], [], []
    for table in tables:
        contract = CONTRACTS[table]
        if table not in landing:
            declared.append((f"{table}.exists", table, "table_exists", "error", False, 1, "No such table was landed."))
            continue
        frame = landing[table]
        missing = sorted(set(contract.columns) - set(frame.columns))
        unexpected = sorted(set(frame.columns) - set(contract.columns))
        details = f"Columns not found: {missing}; not in the contract: {unexpected}"
        declared.append((f"{table}.columns", table, "schema", "error", not missing, len(missing), details))
        if missing:
            continue
        checks += [
            Check(f"{table}.{c}.type", table, "type", f"Every value of {c} reads as {kind}.")
            for c, kind in contract.columns.items()
        ]
        # Text columns cannot fail, so only the others are looked at.
        typed = [
            (f"{table}.{c}.type", type_failure(c, kind)) for c, kind in contract.columns.items() if kind != "string"
        ]
        if typed:
            frames.append(failing_counts(frame, typed))
    if not frames:
        return landing[tables[0]].sparkSession.createDataFrame(declared, CHECKED)
    counted = _described(_summed(frames), checks)
    return counted.sparkSession.createDataFrame(declared, CHECKED).unionByName(counted)


def _key_text(columns: Sequence[str]) -> Column:
    """One text per key: the value itself, or every part with its length so that parts cannot run together."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat(*(part(F.col(c).cast("string")) for c in columns))


def primary_key_checks(landing: Mapping[str, DataFrame], tables: Sequence[str] = tuple(CONTRACTS)) -> DataFrame:
    """Rows with a null key part, and all rows that share their key with another.

    The keys of all tables are counted in one shuffle, under the table's number.
    """
    keyed, checks = [], []
    for table in tables:
        key = list(CONTRACTS[table].key)
        if table not in landing or set(key) - set(landing[table].columns):
            continue
        has_null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
        keyed.append(
            landing[table].select(
                F.lit(len(keyed)).alias("_table"), _key_text(key).alias("_key"), has_null.alias("_has_null")
            )
        )
        checks += [
            Check(f"{table}.pk_not_null", table, "primary_key", f"No part of the key {key} is empty."),
            Check(f"{table}.pk_unique", table, "primary_key", f"No two rows share the key {key}."),
        ]
    per_key = _union(keyed).groupBy("_table", "_key", "_has_null").agg(F.count(F.lit(1)).alias("n"))
    per_table = per_key.groupBy("_table").agg(
        F.sum(F.when(F.col("_has_null"), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeats"),
    )
    counted = per_table.select(
        F.inline(
            F.array(
                F.struct((F.col("_table") * 2).alias("_check"), F.col("nulls").alias("failure_count")),
                F.struct((F.col("_table") * 2 + 1).alias("_check"), F.col("repeats").alias("failure_count")),
            )
        )
    )
    return _described(_named(counted, checks), checks)


def _named(counted: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Replace the check's number, which is what moved through the shuffles, by its id."""
    ids = F.array(*(F.lit(c.check_id) for c in checks))
    return counted.select(F.element_at(ids, F.col("_check") + 1).alias("check_id"), "failure_count")


def _made(landing: Mapping[str, DataFrame], table: str) -> list[tuple[str, str, str]]:
    """Check, column and parent of each reference of a table that was landed with its column."""
    if table not in landing:
        return []
    named = enumerate(references_of(table), start=1)
    return [(f"{table}.fk_{i}", column, parent) for i, (column, parent) in named if column in landing[table].columns]


def foreign_key_checks(
    landing: Mapping[str, DataFrame], tables: Sequence[str] = tuple(CONTRACTS), to: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose reference has no parent (of the tables ``to``, if given); an empty child gives no check.

    Parents and children of all tables are stacked and grouped by key once, with
    a count for each reference to the parent, so a frequent key is one row per
    task and nothing is joined.
    """
    children, checks, slots = [], [], []
    parents: list[str] = []
    places: dict[str, int] = {}
    for table in tables:
        cells = []
        for name, column, parent in _made(landing, table):
            if to is not None and parent not in to:
                continue
            if parent not in parents:
                parents.append(parent)
            place = parents.index(parent)
            slot = places.get(parent, 0)
            places[parent] = slot + 1
            cells.append(f"struct({place} as _parent, cast({column} as string) as _key, {slot} as _slot)")
            details = f"Every {column} is a {CONTRACTS[parent].key[0]} of {parent}."
            checks.append(Check(name, table, "foreign_key", details))
            slots.append((name, place, slot))
        if cells:
            children.append(landing[table].selectExpr(f"inline(array({', '.join(cells)}))"))
    known = [
        landing[p].select(
            F.lit(place).alias("_parent"), F.col(CONTRACTS[p].key[0]).cast("string").alias("_key"), F.lit(-1).alias("_slot")
        )
        for place, p in enumerate(parents)
        if p in landing and CONTRACTS[p].key[0] in landing[p].columns
    ]
    each = range(max(places.values()))
    per_key = (
        _union(children + known)
        .groupBy("_parent", "_key")
        .agg(F.max(F.col("_slot") == -1).alias("_found"), *(F.count(F.when(F.col("_slot") == i, 1)).alias(f"n{i}") for i in each))
    )
    orphan = F.col("_key").isNotNull() & ~F.col("_found")
    sums = [f(F.col(f"n{i}")).alias(f"{k}{i}") for i in each for k, f in (("all", F.sum), ("bad", lambda n: F.sum(F.when(orphan, n).otherwise(0))))]
    cells = ", ".join(f"struct({i} as _slot, all{i} as _rows, bad{i} as failure_count)" for i in each)
    counted = per_key.groupBy("_parent").agg(*sums).selectExpr("_parent", f"inline(array({cells}))").where("_rows > 0")
    named = counted.sparkSession.createDataFrame(slots, "check_id string, _parent int, _slot int")
    return _described(counted.join(named, ["_parent", "_slot"]).select("check_id", "failure_count"), checks, how="inner")


def _moment(column: str) -> Column:
    return F.nullif(F.trim(F.col(column)), F.lit("")).try_cast("timestamp_ntz")


_USAGE = (
    "active_users",
    "sessions",
    "work_orders_created",
    "work_orders_completed",
    "automation_runs",
    "api_calls",
    "documents_uploaded",
    "feature_breadth",
)


def _tolerance() -> Column:
    return F.lit(0.02).cast("decimal(4,2)")


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _rule(check_id: str, table: str, details: str) -> Check:
    return Check(check_id, table, "business_rule", details)


# The ids, tables and numeric bounds of the rules.
BUSINESS_RULES = (
    _rule("subscriptions.date_order", "subscriptions", "A trial begins no later than the paid subscription."),
    _rule("subscriptions.end_after_start", "subscriptions", "A subscription does not end before it starts."),
    _rule(
        "subscription_items.valid_interval",
        "subscription_items",
        "An item is in force for at least a day.",
    ),
    _rule("subscription_items.non_negative_mrr", "subscription_items", "Recurring revenue of an item is zero or more."),
    _rule("invoices.arithmetic", "invoices", "Subtotal and tax add up to the total of the invoice."),
    _rule("invoice_lines.non_negative", "invoice_lines", "The total of an invoice line is zero or more."),
    _rule("payment_attempts.positive_amount", "payment_attempts", "An attempt asks for more than zero."),
    _rule("payments.positive_amount", "payments", "A captured payment is more than zero."),
    _rule("usage.non_negative", "account_usage_daily", "Counts of usage are zero or more."),
    _rule(
        "work_orders.completed_chronology", "work_orders", "A work order is completed no earlier than it was created."
    ),
    _rule("support.resolution_chronology", "support_tickets", "A ticket is resolved no earlier than it was opened."),
    _rule("health.score_range", "account_health_history", "Health scores lie in 0..100."),
    _rule("nps.score_range", "nps_responses", "Answers to the recommendation question lie in 0..10."),
)


def business_predicates() -> dict[str, Column]:
    """When a row fails each rule; unknown counts as passing.

    The two score ranges are stated the other way round: an unknown score fails.
    """
    outside = lambda column, low, high: ~F.coalesce(to_number(column).between(low, high), F.lit(False))
    arithmetic = to_number("subtotal_local") + to_number("tax_local") - to_number("total_local")
    return {
        "subscriptions.date_order": _moment("trial_start_date") > _moment("subscription_start_date"),
        "subscriptions.end_after_start": _moment("ended_date") < _moment("subscription_start_date"),
        "subscription_items.valid_interval": _moment("effective_end") < _moment("effective_start"),
        "subscription_items.non_negative_mrr": to_number("mrr_eur") < 0,
        "invoices.arithmetic": F.abs(arithmetic) > _tolerance(),
        "invoice_lines.non_negative": to_number("line_total_local") < 0,
        "payment_attempts.positive_amount": to_number("amount_local") <= 0,
        "payments.positive_amount": to_number("amount_eur") <= 0,
        "usage.non_negative": _any(to_number(c) < 0 for c in _USAGE),
        "work_orders.completed_chronology": _moment("completed_at") < _moment("created_at"),
        "support.resolution_chronology": _moment("resolved_at") < _moment("created_at"),
        "health.score_range": outside("health_score", 0, 100),
        "nps.score_range": outside("nps_score", 0, 10),
    }


def business_check(landing: Mapping[str, DataFrame], failing: Sequence[tuple[Check, Column]]) -> DataFrame:
    """Count the rows failing each predicate, one scan per table."""
    by_table: dict[str, list] = {}
    for check, bad in failing:
        by_table.setdefault(check.table, []).append((check.check_id, bad))
    counted = _summed([failing_counts(landing[table], rules) for table, rules in by_table.items()])
    return _described(counted, [check for check, _ in failing])


def business_rule_checks(landing: Mapping[str, DataFrame]) -> DataFrame:
    predicates = business_predicates()
    return business_check(landing, [(rule, predicates[rule.check_id]) for rule in BUSINESS_RULES])


def invoice_line_checks(landing: Mapping[str, DataFrame]) -> DataFrame:
    """Invoices whose subtotal differs from the sum of their lines; an invoice without lines has zero.

    Without any invoices, or any lines, there is nothing to reconcile and no check.
    """
    lines = landing["invoice_lines"].groupBy("invoice_id").agg(F.sum(to_number("line_total_local")).alias("_lines"))
    check = Check(
        "invoices.lines_reconcile", "invoices", "reconciliation", "The lines of an invoice add up to its subtotal."
    )
    gap = F.abs(to_number("subtotal_local") - F.coalesce("_lines", F.lit(0)))
    joined = landing["invoices"].select("invoice_id", "subtotal_local").join(lines, "invoice_id", "left")
    counted = joined.agg(F.count("*").alias("_rows"), F.count(F.when(gap > _tolerance(), 1)).alias("failure_count"))
    return _reconciled(counted, landing["invoice_lines"], check)


def _reconciled(counted: DataFrame, other: DataFrame, check: Check) -> DataFrame:
    """A check between two tables from its one row of counts; it is not made where either table has no rows."""
    some = other.limit(1).agg((F.count(F.lit(1)) > 0).alias("_some")).scalar()
    made = counted.where((F.col("_rows") > 0) & some).select(F.lit(check.check_id).alias("check_id"), "failure_count")
    return _described(made, [check], how="inner")


def payment_attempt_checks(landing: Mapping[str, DataFrame]) -> DataFrame:
    """Payments without a succeeded attempt; without any payments, or any attempts, there is no check."""
    payments = landing["payments"].groupBy("payment_attempt_id").agg(F.count(F.lit(1)).alias("n"))
    succeeded = landing["payment_attempts"].where("attempt_status = 'succeeded'").select("payment_attempt_id")
    check = Check(
        "payments.successful_attempt",
        "payments",
        "reconciliation",
        "A payment stems from an attempt that succeeded.",
    )
    known = payments.join(succeeded.distinct().withColumn("_known", F.lit(True)), "payment_attempt_id", "left")
    failed = F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0))
    return _reconciled(known.agg(F.sum("n").alias("_rows"), failed.alias("failure_count")), landing["payment_attempts"], check)


#: How many tables ``validate`` takes at once for their primary keys, and for the references to them.
KEYED_AT_ONCE, PARENTS_AT_ONCE = 14, 2


def _slices(names: Sequence[str], size: int) -> list[Sequence[str]]:
    return [names[i : i + size] for i in range(0, len(names), size)]


def validate(landing: Mapping[str, DataFrame]) -> DataFrame:
    """Every contract check, rule and reconciliation, as one stored row per check.

    The parts run one after the other and leave no shuffle files: as one query, the shuffles of all of them would lie on
    disk until the last had ended.  A parent of more than two references is a part of its own, as a key carries a count
    for each.
    """
    names = tuple(CONTRACTS)
    keyed = [t for t in names if t in landing and not set(CONTRACTS[t].key) - set(landing[t].columns)]
    parents = Counter(parent for table in names for _, _, parent in _made(landing, table))
    alone = [[p] for p, n in parents.items() if n > 2]
    together = _slices([p for p, n in parents.items() if n <= 2], PARENTS_AT_ONCE)
    parts = [
        column_checks,
        *(partial(primary_key_checks, tables=some) for some in _slices(keyed, KEYED_AT_ONCE)),
        *(partial(foreign_key_checks, to=some) for some in alone + together),
        business_rule_checks,
        invoice_line_checks,
        payment_attempt_checks,
    ]
    spark, results = next(landing[t] for t in names if t in landing).sparkSession, []
    with shuffles_dropped(spark):
        for part in parts:
            results += part(landing).select(*CHECK_COLUMNS).collect()
    return spark.createDataFrame(results, CHECKED)


class GateClosed(RuntimeError):
    """Contract checks of error severity failed."""


def require(landing: Mapping[str, DataFrame]) -> None:
    """Raise ``GateClosed`` unless the landed tables pass the gate; there is one result per check, however many rows."""
    failed = validate(landing).where("severity = 'error' and not passed").select("check_id", "failure_count").collect()
    if failed:
        told = ", ".join(f"{r['check_id']} ({r['failure_count']})" for r in sorted(failed))
        raise GateClosed(f"{len(failed)} checks failed: {told}")


def gate_columns() -> dict[str, Column]:
    """The gate's aggregates over check results."""
    blocking = F.col("severity") == "error"
    return {
        "checks": F.count(F.lit(1)),
        "blocking_failures": F.count(F.when(blocking & ~F.col("passed"), 1)),
        "gate_passed": (F.count(F.lit(1)) > 0) & F.coalesce(F.bool_and(F.col("passed") | ~blocking), F.lit(False)),
    }


def gate(results: DataFrame) -> DataFrame:
    """Whether loading may go on: some results exist and no error-severity check failed."""
    return results.agg(*(c.alias(n) for n, c in gate_columns().items()))


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("passed"))


def integer_guard(landing: Mapping[str, DataFrame], tables: Sequence[str] = tuple(CONTRACTS)) -> DataFrame:
    """Values of integer columns that are not numbers, or not whole."""
    frames = []
    for table in tables:
        columns = [c for c, kind in CONTRACTS[table].columns.items() if kind == "integer" and c in landing[table].columns]
        if not columns:
            continue
        counts, cells = [], []
        for i, c in enumerate(columns):
            given, number = F.nullif(F.trim(F.col(c)), F.lit("")).isNotNull(), to_number(c)
            counts.append(F.count(F.when(given & number.isNull(), 1)).alias(f"text{i}"))
            counts.append(F.count(F.when(number % 1 != 0, 1)).alias(f"part{i}"))
            cells.append(f"struct('{table}' as table_name, '{c}' as column_name, text{i} as non_numeric, part{i} as non_integral)")
        frames.append(landing[table].agg(*counts).selectExpr(f"inline(array({', '.join(cells)}))"))
    return _union(frames).where("non_numeric + non_integral > 0")


@dataclass(frozen=True)
class Control:
    control_id: str
    name: str
    bad: Column
    severity: str = "error"


# The control ids and names.
def _controls(t) -> list[tuple[str, DataFrame, list[Control]]]:
    """Controls grouped by the frame that is scanned once for all of them."""
    c = F.col
    outside = lambda column, low, high: (c(column) < low) | (c(column) > high)
    negative = lambda *columns: _any(c(name) < 0 for name in columns)
    cent = _tolerance()

    countries = t["countries"].select(
        "country_code", c("region_id").alias("_country_region"), F.lit(1).alias("_country")
    )
    accounts = t["accounts"].join(countries, "country_code", "left")
    regions = t["regions"].select("region_id", F.lit(1).alias("_region"))
    attempts = t["payment_attempts"].select("payment_attempt_id", c("attempt_status").alias("_attempt_status"))
    paid = t["payments"].select("payment_id", c("amount_local").alias("_paid_local"))
    totals = t["invoices"].select("invoice_id", c("total_local").alias("_total_local"), c("invoice_date").alias("_invoiced"))
    owners = t["users"].select("user_id", c("account_id").alias("_user_account"))
    repeated = t["experiment_assignments"].groupBy("experiment_id", "account_id").agg(F.count(F.lit(1)).alias("_n"))

    return [
        (
            "subscriptions",
            t["subscriptions"],
            [
                Control("Q001", "subscription_start_before_end", c("ended_date") < c("subscription_start_date")),
                Control(
                    "Q019", "churn_status_consistent", (c("current_status") == "churned") != c("ended_date").isNotNull()
                ),
                Control(
                    "Q033",
                    "trial_and_subscription_date_order",
                    (c("trial_end_date") < c("trial_start_date"))
                    | (c("subscription_start_date") < c("trial_start_date")),
                ),
            ],
        ),
        (
            "subscription_items",
            t["subscription_items"],
            [
                Control("Q002", "effective_interval_valid", c("effective_end") < c("effective_start")),
                Control("Q003", "non_negative_mrr", negative("mrr_eur", "mrr_local")),
                Control(
                    "Q034",
                    "item_type_reference_exclusive",
                    ((c("item_type") == "plan") & (c("plan_id").isNull() | c("add_on_id").isNotNull()))
                    | ((c("item_type") == "add_on") & (c("add_on_id").isNull() | c("plan_id").isNotNull())),
                ),
                Control("Q035", "positive_item_quantity", c("quantity") <= 0),
            ],
        ),
        (
            "invoices",
            t["invoices"],
            [
                Control(
                    "Q004", "invoice_arithmetic", F.abs(c("subtotal_local") + c("tax_local") - c("total_local")) > cent
                ),
                Control(
                    "Q020", "paid_invoice_has_paid_date", (c("invoice_status") == "paid") & c("paid_date").isNull()
                ),
                Control(
                    "Q037",
                    "invoice_date_order",
                    (c("due_date") < c("invoice_date")) | (c("service_period_end") < c("service_period_start")),
                ),
                Control(
                    "Q038",
                    "invoice_amounts_non_negative",
                    negative("subtotal_local", "tax_local", "total_local", "total_eur"),
                ),
            ],
        ),
        (
            "invoice_lines",
            invoice_reconciliation(t),
            [Control("Q005", "invoice_line_reconciliation", ~c("reconciled"))],
        ),
        (
            "invoice_lines",
            t["invoice_lines"],
            [
                Control(
                    "Q039",
                    "invoice_line_arithmetic",
                    F.abs(c("quantity") * c("unit_price_local") - c("discount_local") - c("line_total_local")) > cent,
                )
            ],
        ),
        (
            "payments",
            t["payments"].join(attempts, "payment_attempt_id", "left"),
            [
                Control("Q006", "payment_references_successful_attempt", c("_attempt_status") != "succeeded"),
                Control(
                    "Q040", "captured_payment_amounts_positive", (c("amount_local") <= 0) | (c("amount_eur") <= 0)
                ),
            ],
        ),
        (
            "payment_attempts",
            t["payment_attempts"],
            [
                Control(
                    "Q007",
                    "attempt_numbers_and_amounts_positive",
                    (c("attempt_number") < 1) | (c("amount_local") <= 0),
                )
            ],
        ),
        (
            "account_usage_daily",
            t["account_usage_daily"],
            [Control("Q008", "usage_counts_non_negative", negative(*_USAGE[:-1], "active_mobile_users"))],
        ),
        (
            "work_orders",
            t["work_orders"],
            [
                Control("Q009", "work_order_chronology", c("completed_at") < c("created_at")),
                Control(
                    "Q047",
                    "scheduled_and_completed_date_order",
                    (c("scheduled_at") < c("created_at")) | (c("completed_at") < c("scheduled_at")),
                ),
            ],
        ),
        (
            "support_tickets",
            t["support_tickets"],
            [
                Control(
                    "Q010",
                    "ticket_chronology",
                    (c("first_response_at") < c("created_at"))
                    | (c("resolved_at") < c("created_at"))
                    | (c("closed_at") < c("resolved_at")),
                ),
                Control("Q050", "csat_score_range", outside("csat_score", 1, 5)),
            ],
        ),
        (
            "account_health_history",
            t["account_health_history"],
            [Control("Q011", "health_score_range", outside("health_score", 0, 100))],
        ),
        ("nps_responses", t["nps_responses"], [Control("Q012", "nps_score_range", outside("nps_score", 0, 10))]),
        (
            "mrr_movements",
            bridge_reconciliation(t),
            [Control("Q013", "mrr_bridge_reconciliation", F.abs("reconciliation_difference") > cent)],
        ),
        (
            "experiment_assignments",
            repeated,
            [Control("Q014", "one_assignment_per_account_experiment", c("_n") > 1)],
        ),
        (
            "contracts",
            t["contracts"],
            [
                Control(
                    "Q015",
                    "contract_date_order",
                    (c("end_date") < c("start_date")) | (c("signed_date") > c("start_date")),
                )
            ],
        ),
        (
            "renewals",
            t["renewals"],
            [
                Control(
                    "Q016", "renewal_decision_before_due", c("decision_date") > c("renewal_due_date"), "warning"
                ),
                Control("Q036", "renewal_probability_range", outside("renewal_probability", 0, 1)),
            ],
        ),
        (
            "accounts",
            accounts,
            [
                Control("Q017", "country_mapping_complete", c("_country").isNull()),
                Control("Q025", "account_region_matches_country", c("region_id") != c("_country_region")),
                Control(
                    "Q026",
                    "partner_led_accounts_have_partner",
                    (c("sales_motion") == "partner_led") & c("partner_id").isNull(),
                ),
            ],
        ),
        (
            "subscription_events",
            t["subscription_events"],
            [
                Control(
                    "Q018",
                    "churn_event_negative_mrr",
                    (c("event_type") == "subscription_churned") & (c("mrr_change_eur") >= 0),
                )
            ],
        ),
        (
            "countries",
            t["countries"].join(regions, "region_id", "left"),
            [
                Control("Q021", "region_mapping_complete", c("_region").isNull()),
                Control(
                    "Q022",
                    "vat_rate_range",
                    (c("vat_rate") < 0) | (c("vat_rate") > F.lit(0.30).cast("decimal(4,2)")),
                ),
            ],
        ),
        ("fx_rates", t["fx_rates"], [Control("Q023", "positive_eur_rate", c("eur_rate") <= 0)]),
        (
            "plan_prices",
            t["plan_prices"],
            [
                Control(
                    "Q024",
                    "price_and_effective_date_validity",
                    (c("effective_end") < c("effective_start"))
                    | negative("base_price", "seat_price", "annual_discount_pct")
                    | (c("annual_discount_pct") >= 1),
                )
            ],
        ),
        (
            "leads",
            t["leads"],
            [
                Control(
                    "Q027",
                    "lead_lifecycle_order",
                    (c("mql_at") < c("created_at")) | (c("sql_at") < F.coalesce("mql_at", "created_at")),
                ),
                Control("Q028", "lead_score_range", outside("lead_score", 0, 100)),
            ],
        ),
        (
            "opportunities",
            t["opportunities"],
            [
                Control("Q029", "opportunity_date_order", c("close_date").cast("timestamp_ntz") < c("created_at")),
                Control("Q030", "opportunity_probability_range", outside("probability", 0, 1)),
            ],
        ),
        (
            "opportunity_stage_history",
            t["opportunity_stage_history"],
            [Control("Q031", "stage_history_date_order", c("exited_at") < c("entered_at"))],
        ),
        (
            "users",
            t["users"],
            [
                Control(
                    "Q032",
                    "user_lifecycle_order",
                    (c("invited_at") < c("created_at"))
                    | (c("activated_at") < c("invited_at"))
                    | (c("deactivated_at") < c("activated_at")),
                )
            ],
        ),
        (
            "refunds",
            t["refunds"].join(paid, "payment_id", "left"),
            [
                Control(
                    "Q041",
                    "refund_date_and_amount_validity",
                    (c("processed_at") < c("requested_at")) | (c("amount_local") <= 0) | (c("amount_eur") <= 0),
                ),
                Control("Q042", "refund_does_not_exceed_payment", c("amount_local") > c("_paid_local") + cent),
            ],
        ),
        (
            "credit_notes",
            t["credit_notes"].join(totals, "invoice_id"),
            [
                Control(
                    "Q043",
                    "credit_note_does_not_exceed_invoice",
                    (c("amount_local") <= 0) | (c("amount_local") > c("_total_local") + cent),
                )
            ],
        ),
        (
            "dunning_events",
            t["dunning_events"].join(totals, "invoice_id"),
            [Control("Q044", "dunning_not_before_invoice", c("event_at").cast("date") < c("_invoiced"))],
        ),
        (
            "product_events",
            t["product_events"].join(owners, "user_id"),
            [Control("Q045", "event_account_matches_user", c("account_id") != c("_user_account"))],
        ),
        (
            "integrations",
            t["integrations"],
            [Control("Q046", "integration_date_order", c("disconnected_at") < c("connected_at"))],
        ),
        (
            "onboarding_tasks",
            t["onboarding_tasks"],
            [
                Control(
                    "Q048",
                    "completed_task_has_completion_date",
                    (c("task_status") == "completed") & c("completed_at").isNull(),
                )
            ],
        ),
        (
            "customer_success_interactions",
            t["customer_success_interactions"],
            [
                Control(
                    "Q049",
                    "health_score_components_range",
                    outside("health_score_before", 0, 100) | outside("health_score_after", 0, 100),
                )
            ],
        ),
    ]


def control_results(t) -> DataFrame:
    """Failing rows per control; a predicate that is unknown does not fail."""
    frames, declared = [], []
    for table, frame, controls in _controls(t):
        frames.append(failing_counts(frame, [(k.control_id, k.bad) for k in controls]))
        declared += [(k.control_id, table, k.name, k.severity) for k in controls]
    counted = _summed(frames)
    named = counted.sparkSession.createDataFrame(
        declared, "check_id string, table_name string, control_name string, severity string"
    )
    return counted.join(named, "check_id", "right").select(
        F.col("check_id").alias("control_id"),
        "table_name",
        "control_name",
        F.coalesce("failure_count", F.lit(0)).alias("failure_count"),
        "severity",
    )


def quality_summary(t) -> DataFrame:
    failed = F.col("failure_count") > 0
    broken = F.count(F.when(failed & (F.col("severity") == "error"), 1))
    return control_results(t).agg(
        F.count(F.lit(1)).alias("controls"),
        F.count(F.when(~failed, 1)).alias("passed_controls"),
        F.count(F.when(failed, 1)).alias("failed_controls"),
        F.sum("failure_count").alias("total_failures"),
        F.when(broken == 0, "PASS").otherwise("FAIL").alias("quality_status"),
    )


def subscription_item_overlap(t) -> DataFrame:
    """Pairs of items of one subscription, type and product that are in force on the same day."""
    same = ["subscription_id", "item_type", F.coalesce("plan_id", "add_on_id")]
    return overlapping_pairs(
        t["subscription_items"],
        "subscription_item_id",
        same,
        "effective_start",
        "effective_end",
        keep=("subscription_id", "item_type"),
    ).withColumnsRenamed({"left_id": "left_item_id", "right_id": "right_item_id"})
