"""Billing and collection views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import days_between, month_of
from revlattice.functions.measures import count, mean, rate, share, summarise, summarise_through, total
from revlattice.plans.core import billed_invoices
from revlattice.plans.marts import invoice_outcomes
from revlattice.plans.product import PLACE

UNPAID = "invoice_status in ('overdue', 'open')"


def _places(t) -> DataFrame:
    return t["accounts"].select("account_id", "region_id", "country_code", "segment")


def payment_success(t) -> DataFrame:
    """Eventual and first-attempt success by the method of the first attempt."""
    methods = t["payment_methods"].select(F.col("payment_method_id").alias("first_payment_method_id"), "method_type")
    settled = F.coalesce("eventually_succeeded", F.lit(False))
    at_once = settled & (F.col("maximum_attempt_number") == 1)
    invoices = (
        invoice_outcomes(t)
        .join(methods, "first_payment_method_id", "left")
        .withColumn("month_start", month_of("invoice_date"))
    )
    return summarise_through(
        invoices,
        "account_id",
        _places(t),
        [*PLACE, "method_type"],
        [
            count("invoices"),
            count("successful_invoices", settled),
            count("first_attempt_successes", at_once),
            share("eventual_success_rate", settled),
            share("first_attempt_success_rate", at_once),
        ],
    )


def payment_recovery(t) -> DataFrame:
    failed = F.col("any_failure")
    recovered = failed & F.col("eventually_succeeded")
    return summarise_through(
        invoice_outcomes(t).withColumn("month_start", month_of("invoice_date")),
        "account_id",
        _places(t),
        PLACE,
        [
            count("failed_first_or_later_invoices", failed),
            count("recovered_invoices", recovered),
            total("failed_value_eur", "total_eur", failed),
            total("recovered_value_eur", "total_eur", recovered),
            rate("recovery_rate", count("recovered", recovered), count("failed", failed)),
        ],
    )


def dunning_effectiveness(t) -> DataFrame:
    recovered = F.col("recovered_after_event_flag")
    return summarise(
        t["dunning_events"].withColumn("month_start", month_of("event_at")),
        ["month_start", "dunning_step", "channel"],
        [count("dunning_events"), count("recovered_after_event", recovered), share("recovery_rate", recovered)],
    )


def overdue_receivables(t, as_of: Column) -> DataFrame:
    """Unpaid invoices by due month; days overdue are counted at ``as_of``."""
    return summarise_through(
        billed_invoices(t).withColumn("due_month", month_of("due_date")),
        "account_id",
        _places(t),
        ["due_month", "region_id", "country_code", "segment"],
        [
            count("unpaid_invoices", UNPAID),
            total("unpaid_eur", "total_eur", UNPAID),
            mean("average_days_overdue", days_between(as_of, "due_date"), F.col("invoice_status") == "overdue"),
        ],
    )


def _credits_by_invoice(t) -> DataFrame:
    return t["credit_notes"].groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("credit_rows"), F.sum("amount_eur").alias("credit_eur")
    )


def _settlements_by_invoice(t) -> DataFrame:
    """Payments and their refunds summed per invoice.

    ``settlement_rows`` is how many rows payments joined with refunds would have,
    ``repeated_captured_eur`` what their payment amounts would then add up to.
    """
    refunds = t["refunds"].groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("refund_rows"), F.sum("amount_eur").alias("refunded_eur")
    )
    rows = F.coalesce("refund_rows", F.lit(1))
    return (
        t["payments"]
        .select("payment_id", "invoice_id", "amount_eur")
        .join(refunds, "payment_id", "left")
        .groupBy("invoice_id")
        .agg(
            F.sum(rows).alias("settlement_rows"),
            F.sum("amount_eur").alias("captured_eur"),
            F.sum(F.col("amount_eur") * rows).alias("repeated_captured_eur"),
            F.sum("refunded_eur").alias("refund_eur"),
        )
    )


def refunds_and_credits(t, multiplied: bool = False) -> DataFrame:
    """Credits and refunds against invoiced revenue.

    By default every invoice, credit note and refund counts once.  ``multiplied``
    gives what joining the four tables row by row adds up to: an invoice is then
    counted per credit note and per payment or refund.
    """
    one = F.lit(1)
    credit_rows = F.coalesce("credit_rows", one) if multiplied else one
    settlement_rows = F.coalesce("settlement_rows", one) if multiplied else one
    invoices = (
        billed_invoices(t)
        .select("invoice_id", "account_id", "total_eur", month_of("invoice_date").alias("month_start"))
        .join(_credits_by_invoice(t), "invoice_id", "left")
        .join(_settlements_by_invoice(t), "invoice_id", "left")
    )
    invoiced = F.col("total_eur") * credit_rows * settlement_rows
    credit = F.coalesce(F.col("credit_eur") * settlement_rows, F.lit(0))
    refund = F.coalesce(F.col("refund_eur") * credit_rows, F.lit(0))
    return summarise_through(
        invoices,
        "account_id",
        _places(t),
        PLACE,
        [
            total("invoiced_eur", invoiced),
            total("credit_eur", credit),
            total("refund_eur", refund),
            rate("adjustment_rate", total("adjusted", credit + refund), total("invoiced", invoiced)),
        ],
    )


def invoice_payment_reconciliation(t, multiplied: bool = False) -> DataFrame:
    """Captured and refunded amounts against each invoice.

    ``multiplied`` counts a payment once per refund, as the row-by-row join does.
    """
    captured = "repeated_captured_eur" if multiplied else "captured_eur"
    zero = F.lit(0)
    return (
        t["invoices"]
        .select("invoice_id", "total_eur", "invoice_status")
        .join(_settlements_by_invoice(t), "invoice_id", "left")
        .select(
            "invoice_id",
            "total_eur",
            F.coalesce(captured, zero).alias("captured_eur"),
            F.coalesce("refund_eur", zero).alias("refunded_eur"),
            (F.col("total_eur") - F.coalesce(captured, zero)).alias("unpaid_difference_eur"),
            "invoice_status",
        )
    )


def line_totals(t) -> DataFrame:
    return t["invoice_lines"].groupBy("invoice_id").agg(F.sum("line_total_local").alias("invoice_line_total_local"))


def invoice_reconciliation(t) -> DataFrame:
    difference = F.col("subtotal_local") - F.col("invoice_line_total_local")
    return (
        t["invoices"]
        .select("invoice_id", "subtotal_local")
        .join(line_totals(t), "invoice_id")
        .withColumn("difference_local", difference)
        .withColumn("reconciled", F.abs("difference_local") <= F.lit(0.02).cast("decimal(4,2)"))
    )
