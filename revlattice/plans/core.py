"""Typed tables joined with their reference data.

Every plan takes ``t``, a mapping from contract table name to DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.measures import count, summarise


def accounts_enriched(t) -> DataFrame:
    countries = t["countries"].select(
        "country_code", "country_name", F.col("currency_code").alias("country_currency"), "vat_rate"
    )
    regions = t["regions"].select("region_id", "region_name")
    columns = t["accounts"].columns
    return (
        t["accounts"]
        .join(countries, "country_code")
        .join(regions, "region_id")
        .select(*columns, "country_name", "country_currency", "vat_rate", "region_name")
    )


def subscriptions_enriched(t) -> DataFrame:
    columns = t["subscriptions"].columns
    accounts = t["accounts"].select(
        "account_id", "country_code", "region_id", "segment", "sales_motion", "acquisition_channel"
    )
    plans = t["plans"].select("plan_id", "plan_name", "plan_rank")
    contracts = t["contracts"].select(
        "contract_id",
        "account_id",
        F.col("discount_pct").alias("contract_discount_pct"),
        "contract_term_months",
        "auto_renew_flag",
    )
    return (
        t["subscriptions"]
        .join(plans, "plan_id")
        .join(contracts, ["contract_id", "account_id"])
        .join(accounts, "account_id")
        .select(
            *columns,
            *(c for c in accounts.columns if c != "account_id"),
            "plan_name",
            "plan_rank",
            "contract_discount_pct",
            "contract_term_months",
            "auto_renew_flag",
        )
    )


def subscription_items_enriched(t) -> DataFrame:
    columns = t["subscription_items"].columns
    subscriptions = t["subscriptions"].select("subscription_id", "account_id", "currency_code")
    return (
        t["subscription_items"]
        .join(t["plans"].select("plan_id", "plan_name"), "plan_id", "left")
        .join(t["add_ons"].select("add_on_id", "add_on_name"), "add_on_id", "left")
        .join(subscriptions, "subscription_id")
        .select(*columns, "account_id", "currency_code", "plan_name", "add_on_name")
    )


def invoices_enriched(t) -> DataFrame:
    columns = t["invoices"].columns
    accounts = t["accounts"].select("account_id", "country_code", "region_id", "segment", "sales_motion")
    subscriptions = t["subscriptions"].select("subscription_id", "account_id", "billing_frequency", "plan_id")
    return (
        t["invoices"]
        .join(subscriptions, ["subscription_id", "account_id"])
        .join(accounts, "account_id")
        .select(
            *columns, "country_code", "region_id", "segment", "sales_motion", "billing_frequency", "plan_id"
        )
    )


def billed_invoices(t) -> DataFrame:
    """Invoices whose subscription belongs to the same account, without its columns."""
    return t["invoices"].join(
        t["subscriptions"].select("subscription_id", "account_id"), ["subscription_id", "account_id"], "left_semi"
    )


def business_key_uniqueness(t) -> DataFrame:
    """Business keys that occur more than once."""
    repeated = []
    for table, key in (("contracts", "contract_number"), ("invoices", "invoice_number")):
        counted = summarise(t[table].where(F.col(key).isNotNull()), [key], [count("occurrences")])
        repeated.append(
            counted.where("occurrences > 1").select(
                F.lit(table).alias("table_name"),
                F.lit(key).alias("key_column"),
                F.col(key).alias("key_value"),
                "occurrences",
            )
        )
    return repeated[0].unionByName(repeated[1])


ROW_COUNTED = (
    "accounts",
    "subscriptions",
    "subscription_items",
    "invoices",
    "payment_attempts",
    "account_usage_daily",
    "product_events",
    "support_tickets",
    "experiment_assignments",
)


def table_row_counts(t, names) -> DataFrame:
    """Rows per table, empty ones included; reads no columns and shuffles one row per task and table."""
    named = [t[name].select(F.lit(name).alias("table_name")) for name in names]
    counted = reduce(DataFrame.unionByName, named).groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
    listed = counted.sparkSession.createDataFrame([(name,) for name in names], "table_name string")
    return counted.join(listed, "table_name", "right").fillna(0, ["row_count"])


def source_row_counts(t) -> DataFrame:
    return table_row_counts(t, ROW_COUNTED)
