"""Declared table contracts: columns, logical types, keys and references.

A column is text unless its type is named.  A reference points at the table whose
single key has the column's name.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOGICAL_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "decimal": T.DecimalType(20, 6),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Contract:
    table: str
    columns: Mapping[str, str]
    key: tuple[str, ...]
    references: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, LOGICAL_TYPES[kind], c not in self.key) for c, kind in self.columns.items()]
        )

    @property
    def landing_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


def _contract(table: str, columns: str, references: str = "", key: str | None = None) -> Contract:
    typed = {name: kind or "string" for name, _, kind in (c.partition(":") for c in columns.split())}
    return Contract(table, typed, tuple((key or next(iter(typed))).split()), tuple(references.split()))


# The names of the governed tables, their columns, and the type of every column that is not text.
CONTRACTS: dict[str, Contract] = {
    c.table: c
    for c in (
        _contract(
            "regions",
            "region_id region_name commercial_owner",
        ),
        _contract(
            "countries",
            "country_code country_name region_id currency_code vat_rate:decimal language_code",
            "region_id",
        ),
        _contract(
            "currencies",
            "currency_code currency_name minor_units:integer",
        ),
        _contract(
            "fx_rates",
            "rate_date:date currency_code eur_rate:decimal",
            "currency_code",
            key="rate_date currency_code",
        ),
        _contract(
            "plans",
            "plan_id plan_name plan_rank:integer included_seats:integer active_flag:boolean",
        ),
        _contract(
            "plan_prices",
            "plan_price_id plan_id country_code currency_code billing_frequency effective_start:date effective_end:date"
            " base_price:decimal seat_price:decimal annual_discount_pct:decimal",
            "plan_id currency_code",
        ),
        _contract(
            "add_ons",
            "add_on_id add_on_name monthly_price_eur:decimal category active_flag:boolean",
        ),
        _contract(
            "accounts",
            "account_id account_name created_at:timestamp country_code region_id industry segment employee_band"
            " acquisition_channel sales_motion partner_id account_status legal_currency tax_id_present:boolean",
            "country_code",
        ),
        _contract(
            "partners",
            "partner_id partner_name partner_type country_code active_from:date active_flag:boolean",
        ),
        _contract(
            "leads",
            "lead_id account_id created_at:timestamp source_channel lead_status mql_at:timestamp sql_at:timestamp"
            " lead_score:integer campaign_id",
            "account_id",
        ),
        _contract(
            "marketing_campaigns",
            "campaign_id campaign_name channel country_code start_date:date end_date:date spend_local:decimal currency_code"
            " spend_eur:decimal",
        ),
        _contract(
            "opportunities",
            "opportunity_id account_id created_at:timestamp close_date:date stage status owner_team expected_arr_eur:decimal"
            " probability:decimal loss_reason",
            "account_id",
        ),
        _contract(
            "opportunity_stage_history",
            "stage_event_id opportunity_id stage_name entered_at:timestamp exited_at:timestamp stage_sequence:integer",
            "opportunity_id",
        ),
        _contract(
            "workspaces",
            "workspace_id account_id workspace_name created_at:timestamp country_code active_flag:boolean",
            "account_id",
        ),
        _contract(
            "users",
            "user_id account_id workspace_id created_at:timestamp role_name user_status invited_at:timestamp"
            " activated_at:timestamp deactivated_at:timestamp mobile_user_flag:boolean",
            "account_id workspace_id",
        ),
        _contract(
            "contracts",
            "contract_id account_id contract_number signed_date:date start_date:date end_date:date auto_renew_flag:boolean"
            " contract_term_months:integer billing_frequency currency_code discount_pct:decimal contract_status sales_motion",
            "account_id",
        ),
        _contract(
            "subscriptions",
            "subscription_id account_id contract_id plan_id trial_start_date:date trial_end_date:date"
            " subscription_start_date:date current_status cancel_requested_date:date ended_date:date churn_type billing_frequency"
            " currency_code",
            "account_id contract_id plan_id",
        ),
        _contract(
            "subscription_items",
            "subscription_item_id subscription_id item_type plan_id add_on_id quantity:integer unit_price_local:decimal"
            " discount_pct:decimal effective_start:date effective_end:date mrr_local:decimal mrr_eur:decimal",
            "subscription_id",
        ),
        _contract(
            "subscription_events",
            "subscription_event_id subscription_id event_at:timestamp event_type previous_plan_id new_plan_id"
            " previous_quantity:integer new_quantity:integer mrr_change_eur:decimal event_reason initiated_by",
            "subscription_id",
        ),
        _contract(
            "renewals",
            "renewal_id subscription_id renewal_due_date:date decision_date:date renewal_status renewal_arr_eur:decimal"
            " renewal_probability:decimal risk_reason",
            "subscription_id",
        ),
        _contract(
            "invoices",
            "invoice_id account_id subscription_id invoice_number invoice_date:date due_date:date service_period_start:date"
            " service_period_end:date currency_code subtotal_local:decimal tax_local:decimal total_local:decimal total_eur:decimal"
            " invoice_status paid_date:date",
            "account_id subscription_id",
        ),
        _contract(
            "invoice_lines",
            "invoice_line_id invoice_id line_type description quantity:decimal unit_price_local:decimal discount_local:decimal"
            " line_total_local:decimal service_period_start:date service_period_end:date subscription_item_id",
            "invoice_id",
        ),
        _contract(
            "payment_methods",
            "payment_method_id account_id method_type provider created_at:timestamp expiry_month:integer expiry_year:integer"
            " active_flag:boolean",
            "account_id",
        ),
        _contract(
            "payment_attempts",
            "payment_attempt_id invoice_id payment_method_id attempt_at:timestamp attempt_number:integer amount_local:decimal"
            " currency_code attempt_status failure_reason provider_response_code",
            "invoice_id payment_method_id",
        ),
        _contract(
            "payments",
            "payment_id invoice_id payment_attempt_id captured_at:timestamp amount_local:decimal currency_code amount_eur:decimal"
            " payment_status settlement_date:date",
            "invoice_id payment_attempt_id",
        ),
        _contract(
            "credit_notes",
            "credit_note_id invoice_id issued_date:date reason amount_local:decimal amount_eur:decimal credit_note_status",
            "invoice_id",
        ),
        _contract(
            "refunds",
            "refund_id payment_id requested_at:timestamp processed_at:timestamp amount_local:decimal amount_eur:decimal reason"
            " refund_status",
            "payment_id",
        ),
        _contract(
            "dunning_events",
            "dunning_event_id invoice_id event_at:timestamp dunning_step:integer channel event_status"
            " recovered_after_event_flag:boolean",
            "invoice_id",
        ),
        _contract(
            "product_events",
            "product_event_id account_id user_id event_at:timestamp event_name feature_area platform session_id workspace_id"
            " numeric_value:decimal",
            "account_id user_id",
        ),
        _contract(
            "account_usage_daily",
            "account_id activity_date:date active_users:integer active_mobile_users:integer sessions:integer"
            " work_orders_created:integer work_orders_completed:integer automation_runs:integer api_calls:integer"
            " documents_uploaded:integer feature_breadth:integer",
            "account_id",
            key="account_id activity_date",
        ),
        _contract(
            "integrations",
            "integration_id account_id integration_type connected_at:timestamp disconnected_at:timestamp integration_status"
            " monthly_sync_volume:integer",
            "account_id",
        ),
        _contract(
            "work_orders",
            "work_order_id account_id workspace_id created_at:timestamp scheduled_at:timestamp completed_at:timestamp status"
            " priority service_category assigned_users:integer customer_signature_flag:boolean completion_minutes:integer",
            "account_id",
        ),
        _contract(
            "onboarding_tasks",
            "onboarding_task_id account_id task_name task_sequence:integer due_date:date completed_at:timestamp task_status"
            " owner_type",
            "account_id",
        ),
        _contract(
            "customer_success_interactions",
            "cs_interaction_id account_id interaction_at:timestamp interaction_type reason outcome health_score_before:decimal"
            " health_score_after:decimal owner_team",
            "account_id",
        ),
        _contract(
            "support_tickets",
            "ticket_id account_id created_at:timestamp first_response_at:timestamp resolved_at:timestamp closed_at:timestamp"
            " priority category ticket_status channel escalated_flag:boolean reopened_count:integer csat_score:integer",
            "account_id",
        ),
        _contract(
            "nps_responses",
            "nps_response_id account_id response_date:date nps_score:integer nps_group response_channel comment_theme",
            "account_id",
        ),
        _contract(
            "account_health_history",
            "account_id health_month:date health_score:decimal health_segment usage_score:decimal support_score:decimal"
            " payment_score:decimal relationship_score:decimal renewal_risk_flag:boolean",
            "account_id",
            key="account_id health_month",
        ),
        _contract(
            "experiments",
            "experiment_id experiment_name start_date:date end_date:date unit_of_randomisation primary_metric guardrail_metric"
            " minimum_detectable_effect:decimal status",
        ),
        _contract(
            "experiment_assignments",
            "assignment_id experiment_id account_id variant assigned_at:timestamp eligible_flag:boolean stratum",
            "experiment_id account_id",
        ),
        _contract(
            "experiment_exposures",
            "exposure_id assignment_id exposed_at:timestamp exposure_surface exposure_count:integer",
            "assignment_id",
        ),
        _contract(
            "experiment_outcomes",
            "outcome_id assignment_id observation_end:date primary_outcome:decimal guardrail_outcome:decimal"
            " revenue_outcome_eur:decimal",
            "assignment_id",
        ),
    )
}

PARENTS: dict[str, str] = {c.key[0]: c.table for c in reversed(CONTRACTS.values()) if len(c.key) == 1}


def references_of(table: str) -> list[tuple[str, str]]:
    """(column, parent table) for each declared reference, in order."""
    return [(column, PARENTS[column]) for column in CONTRACTS[table].references]


WHOLE_NUMBER = r"^[+-]?[0-9]+([.]0+)?$"


def cast_column(name: str, logical: str, strict: bool = True) -> Column:
    """Trimmed text as its logical type; blank is NULL.

    ``strict`` raises on text that does not convert, otherwise it becomes NULL.
    """
    text = F.nullif(F.trim(F.col(name)), F.lit(""))
    if logical == "string":
        return text.alias(name)
    convert = (lambda c, kind: c.cast(kind)) if strict else (lambda c, kind: c.try_cast(kind))
    if logical == "integer":
        whole = convert(convert(text, "decimal(38,6)"), "bigint")
        value = F.when(text.rlike(WHOLE_NUMBER), whole).otherwise(convert(text, "bigint"))
        if not strict:
            value = F.when(text.rlike(WHOLE_NUMBER), whole)
        return value.alias(name)
    return convert(text, LOGICAL_TYPES[logical]).alias(name)


def cast_to_contract(landing: DataFrame, table: str, strict: bool = True) -> DataFrame:
    return landing.select(*(cast_column(c, kind, strict) for c, kind in CONTRACTS[table].columns.items()))


#: Why a landed row is set aside; the mask of a row holds every reason it has.
REASONS = {"wrong_width": 1, "failed_cast": 2, "null_key": 4}


def _given(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit("")).isNotNull()


def _unconverted(table: str) -> list[tuple[str, Column]]:
    """For each column that is not text: whether its text is given but does not convert."""
    kinds = CONTRACTS[table].columns.items()
    return [(c, _given(c) & cast_column(c, kind, strict=False).isNull()) for c, kind in kinds if kind != "string"]


def split_quarantine(landing: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the text rows with a value that does not convert."""
    broken = reduce(lambda a, b: a | b, (bad for _, bad in _unconverted(table)), F.lit(False))
    return cast_to_contract(landing.where(~broken), table, strict=False), landing.where(broken)


def with_reasons(landing: DataFrame, table: str, corrupt: str | None = None) -> DataFrame:
    """Landed rows with their typed columns, ``reasons`` (a mask of ``REASONS``) and what they are set aside for.

    ``corrupt`` names the column that holds the raw text of rows whose fields do not match the header; such a row has no
    other reason, as its fields cannot be told apart.  ``failed_columns`` lists the columns that do not convert, ``fields`` is
    the row's text as JSON and ``raw`` the line where its width is wrong.  Rows without a reason have neither.
    """
    contract = CONTRACTS[table]
    wide = F.lit(False) if corrupt is None else F.col(corrupt).isNotNull()
    failed = F.filter(F.array(*(F.when(bad, F.lit(c)) for c, bad in _unconverted(table)), F.lit(None).cast("string")), lambda c: c.isNotNull())
    keyless = reduce(lambda a, b: a | b, (~_given(c) for c in contract.key))
    texts = [c for c in landing.columns if c != corrupt]
    bit = lambda reason, holds: F.when(holds, F.lit(REASONS[reason])).otherwise(F.lit(0))
    marked = landing.withColumn("_wide", wide).withColumn("_failed", F.when(~F.col("_wide"), failed))
    mask = bit("wrong_width", F.col("_wide")) + F.when(F.col("_wide"), 0).otherwise(bit("failed_cast", F.size("_failed") > 0) + bit("null_key", keyless))
    aside = F.col("reasons") != 0
    return marked.withColumn("reasons", mask).select(
        *(F.when(~aside, cast_column(c, kind, strict=False)).alias(c) for c, kind in contract.columns.items()),
        "reasons",
        F.when(F.size("_failed") > 0, F.col("_failed")).alias("failed_columns"),
        F.when(aside, F.to_json(F.struct(*texts))).alias("fields"),
        (F.lit(None).cast("string") if corrupt is None else F.col(corrupt)).alias("raw"),
    )


def export_contracts(folder: str | Path) -> None:
    """Write one JSON document per contract and a catalogue."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    for contract in CONTRACTS.values():
        document = {
            "table": contract.table,
            "grain": "One row per " + " and ".join(contract.key),
            "primary_key": list(contract.key),
            "foreign_keys": [{"column": c, "references": p} for c, p in references_of(contract.table)],
            "columns": [
                {"name": c, "type": kind, "nullable": c not in contract.key}
                for c, kind in contract.columns.items()
            ],
        }
        (out / f"{contract.table}.json").write_text(json.dumps(document, indent=2) + "\n", encoding="utf-8")
    catalogue = {"version": 1, "tables": {name: f"{name}.json" for name in CONTRACTS}}
    (out / "catalog.json").write_text(json.dumps(catalogue, indent=2) + "\n", encoding="utf-8")
