"""Named queries over the bound tables, each with its output contract and oracle."""

from __future__ import annotations

import datetime as dt
import uuid
from collections import ChainMap
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlattice.contracts import CONTRACTS, cast_to_contract, references_of
from revlattice.folders import shared_folder
from revlattice.plans import (
    acquisition,
    billing,
    core,
    derive,
    executive,
    experiments,
    governed,
    kpis,
    marts,
    product,
    quality,
    reports,
    revenue,
    success,
)
from revlattice.session import tune
from revlattice.sources import tables as sources
from revlattice.testbed.bind import BoundTables
from revlattice.testbed.landing import ADDED, DROPPED, LandedTables, land_csv
from revlattice.testbed.oracle import avg, compose, hours, month, n, ratio

AS_OF = "1999-12-31"
HISTORY = ("1996-01-01", "2001-12-01")


def _day(text: str):
    return F.lit(text).cast("date")


@dataclass(frozen=True)
class Query:
    build: Callable[[BoundTables], DataFrame]
    columns: dict[str, str]
    oracle: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        frame = self.build(BoundTables.shared(tune(spark), folder))
        kinds = {"timestamp": "timestamp_ntz"}
        return frame.select(*(F.col(c).cast(kinds.get(k, k)).alias(c) for c, k in self.columns.items()))

    def oracle_sql(self) -> str | None:
        return None if self.oracle is None else compose(self.oracle, self.columns)


QUERIES: dict[str, Query] = {}



def columns(text: str) -> dict[str, str]:
    """``"date: a b; double: c"`` as an ordered mapping of column to type."""
    out = {}
    for part in text.split(";"):
        kind, names = part.split(":")
        for name in names.split():
            out[name] = kind.strip()
    return out


def query(name: str, spec: str, build: Callable[[BoundTables], DataFrame], oracle: str | None) -> None:
    QUERIES[name] = Query(build, columns(spec), oracle)


def from_contract(table: str) -> str:
    """Output contract of a typed table: its columns with doubles for decimals."""
    kinds = {"integer": "bigint", "decimal": "double"}
    return "; ".join(f"{kinds.get(k, k)}: {c}" for c, k in CONTRACTS[table].columns.items())


_PLACE = "date: month_start; string: region_id country_code segment"
PLACE = "month_start, region_id, country_code, segment"

# --- tables and enrichment -------------------------------------------------------------------

query(
    "source_row_counts",
    "string: table_name; bigint: row_count",
    core.source_row_counts,
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {{{t}}}" for t in core.ROW_COUNTED),
)
query(
    "load_row_counts",
    "string: table_name; bigint: row_count",
    lambda t: core.table_row_counts(LandedTables(t), tuple(CONTRACTS)),
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {{{t}}}" for t in CONTRACTS),
)


def _duck_cast(column: str, kind: str) -> str:
    text = f"nullif(trim({column}), '')"
    if kind == "string":
        return text
    if kind == "integer":
        return (
            f"case when regexp_matches({text}, '^[+-]?[0-9]+([.]0+)?$')"
            f" then cast(try_cast({text} as decimal(38,6)) as bigint) end"
        )
    return f"try_cast({text} as {'decimal(20,6)' if kind == 'decimal' else kind})"


for _name, _table in (("contract_cast", "subscription_items"), ("contract_cast_leads", "leads")):
    query(
        _name,
        from_contract(_table),
        lambda t, table=_table: cast_to_contract(LandedTables(t)[table], table, strict=False),
        f"select {', '.join(f'{_duck_cast(c, k)} as {c}' for c, k in CONTRACTS[_table].columns.items())} from {{text:{_table}}}",
    )

_INTEGERS = [(t, c) for t, k in CONTRACTS.items() for c, kind in k.columns.items() if kind == "integer"]
query(
    "integer_guard",
    "string: table_name column_name; bigint: non_numeric non_integral",
    lambda t: quality.integer_guard(LandedTables(t)),
    "select * from ("
    + " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name,"
        f" count(*) filter (where trim({c}) <> '' and try_cast(trim({c}) as decimal(38,6)) is null) as non_numeric,"
        f" count(*) filter (where try_cast(trim({c}) as decimal(38,6)) % 1 <> 0) as non_integral from {{text:{t}}}"
        for t, c in _INTEGERS
    )
    + ") g where non_numeric + non_integral > 0",
)
_PRINT_KINDS = {"integer": "bigint", "decimal": "decimal(20,6)", "string": "varchar"}


def _fingerprint(table: str, month_of: str | None = None) -> str:
    texts = (f"cast(cast({c} as {_PRINT_KINDS.get(k, k)}) as varchar)" for c, k in CONTRACTS[table].columns.items())
    told = " || ',' || ".join(f"coalesce(length({x}) || ':' || {x}, 'N')" for x in texts)
    month = "" if month_of is None else f", cast(date_trunc('month', cast({month_of} as timestamp)) as date) as month_start"
    return (
        f"select '{table}' as table_name{', month_start' if month else ''}, count(*) as rows, sum(d) as digest_sum, bit_xor(d) as digest_xor"
        f" from (select cast('0x' || substr(md5({told}), 1, 15) as bigint) as d{month} from {{{table}}}) f{' group by month_start' if month else ''}"
    )


_FINGERPRINTS = " union all ".join(_fingerprint(t) for t in CONTRACTS)
_LISTED_COLUMNS = ", ".join(f"('{t}', '{','.join(k.columns)}')" for t, k in CONTRACTS.items())
query(
    "dataset_manifest",
    "string: table_name file columns; bigint: rows total_rows; string: digest_sum; bigint: digest_xor",
    sources.dataset_manifest,
    "select f.*, f.table_name || '.csv' as file, c.columns, sum(f.rows) over () as total_rows"
    f" from ({_FINGERPRINTS}) f join (values {_LISTED_COLUMNS}) c(name, columns) on c.name = f.table_name",
)
query(
    "table_fingerprint",
    "string: table_name; bigint: rows; string: digest_sum; bigint: digest_xor",
    sources.table_fingerprints,
    _FINGERPRINTS,
)
query(
    "month_fingerprint",
    "string: table_name; date: month_start; bigint: rows; string: digest_sum; bigint: digest_xor",
    sources.month_fingerprints,
    " union all ".join(_fingerprint(t, sources.month_column(t) or "null") for t in CONTRACTS),
)


def _scratch(t: BoundTables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _landed_again(t: BoundTables) -> DataFrame:
    """Fingerprints of all tables after they went to CSV and were loaded from it."""
    folder = _scratch(t, "round-trip")
    # CSV, landed text and typed tables all lie on disk when the load ends; plain CSV alone is several times the rest.
    sources.write_dataset(t, f"{folder}/csv", compression="gzip")
    audit = sources.RunAudit(t.spark, f"{folder}/audit")
    sources.run_load(t.spark, f"{folder}/csv", f"{folder}/core", audit, require=None)
    return sources.table_fingerprints(sources.current(t.spark, f"{folder}/core"))


query("landing_round_trip", "string: table_name; bigint: rows; string: digest_sum; bigint: digest_xor", _landed_again, _FINGERPRINTS)

_ROUTED = ("invoices", "leads", "payments", "subscription_items", "users")


def _quarantined(t: BoundTables) -> DataFrame:
    """Rows per table, reason and columns at fault after a quarantining load; reason 0 are the typed rows."""
    folder = _scratch(t, "quarantine")
    land_csv(t, f"{folder}/csv", _ROUTED)
    audit = sources.RunAudit(t.spark, f"{folder}/audit")
    paths = sources.run_load(t.spark, f"{folder}/csv", f"{folder}/core", audit, _ROUTED, require=None, mode="quarantine")
    run = next(iter(paths.values())).rsplit("/", 2)[0]
    typed = core.table_row_counts(sources.current(t.spark, f"{folder}/core"), _ROUTED)
    kept = typed.select("table_name", F.lit(0).alias("reasons"), F.lit(None).cast("string").alias("failed_columns"), F.col("row_count").alias("n"))
    aside = sources.read_quarantine(t.spark, run, _ROUTED).withColumn("failed_columns", F.array_join("failed_columns", ","))
    return kept.unionByName(aside.groupBy("table_name", "reasons", "failed_columns").agg(F.count(F.lit(1)).alias("n")))


def _quarantine_sql(table: str) -> str:
    contract, given = CONTRACTS[table], lambda c: f"nullif(trim({c}), '')"
    failed = [f"case when {given(c)} is not null and {_duck_cast(c, k)} is null then '{c}' end" for c, k in contract.columns.items() if k != "string"]
    keyless = " or ".join(f"{given(c)} is null" for c in contract.key)
    return f"""select '{table}' as table_name, reasons, failed_columns, count(*) as n from (
        select case when wide_row then 1 else case when failed <> '' then 2 else 0 end + case when keyless then 4 else 0 end end as reasons,
               case when not wide_row then nullif(failed, '') end as failed_columns
        from (select wide_row, {keyless} as keyless, concat_ws(',', {', '.join(failed)}) as failed from {{wide:{table}}}) f) g group by all"""


query(
    "load_quarantine",
    "string: table_name; int: reasons; string: failed_columns; bigint: n",
    _quarantined,
    " union all ".join(map(_quarantine_sql, _ROUTED)),
)
query(
    "accounts_enriched",
    from_contract("accounts") + "; string: country_name country_currency; double: vat_rate; string: region_name",
    core.accounts_enriched,
    """select a.*, c.country_name, c.currency_code as country_currency, c.vat_rate, r.region_name
       from {accounts} a join {countries} c on c.country_code = a.country_code join {regions} r on r.region_id = a.region_id""",
)
query(
    "subscriptions_enriched",
    from_contract("subscriptions")
    + "; string: country_code region_id segment sales_motion acquisition_channel plan_name; bigint: plan_rank;"
    " double: contract_discount_pct; bigint: contract_term_months; boolean: auto_renew_flag",
    core.subscriptions_enriched,
    """select s.*, a.country_code, a.region_id, a.segment, a.sales_motion, a.acquisition_channel, p.plan_name, p.plan_rank,
              c.discount_pct as contract_discount_pct, c.contract_term_months, c.auto_renew_flag
       from {subscriptions} s join {accounts} a on a.account_id = s.account_id join {plans} p on p.plan_id = s.plan_id
       join {contracts} c on c.contract_id = s.contract_id and c.account_id = s.account_id""",
)
query(
    "subscription_items_enriched",
    from_contract("subscription_items") + "; bigint: account_id; string: currency_code plan_name add_on_name",
    core.subscription_items_enriched,
    """select i.*, s.account_id, s.currency_code, p.plan_name, x.add_on_name
       from {subscription_items} i join {subscriptions} s on s.subscription_id = i.subscription_id
       left join {plans} p on p.plan_id = i.plan_id left join {add_ons} x on x.add_on_id = i.add_on_id""",
)
query(
    "invoices_enriched",
    from_contract("invoices") + "; string: country_code region_id segment sales_motion billing_frequency plan_id",
    core.invoices_enriched,
    "select * from {mart:invoice}",
)
query(
    "business_key_uniqueness",
    "string: table_name key_column key_value; bigint: occurrences",
    core.business_key_uniqueness,
    """select 'contracts' as table_name, 'contract_number' as key_column, contract_number as key_value, count(*) as occurrences
       from {contracts} where contract_number is not null group by contract_number having count(*) > 1
       union all
       select 'invoices', 'invoice_number', invoice_number, count(*)
       from {invoices} where invoice_number is not null group by invoice_number having count(*) > 1""",
)

# --- marts -----------------------------------------------------------------------------------

query(
    "subscription_item_monthly",
    "date: month_start; string: subscription_item_id; bigint: subscription_id account_id; string: item_type plan_id"
    " plan_name add_on_id add_on_name; bigint: quantity; double: mrr_local mrr_eur",
    marts.subscription_item_monthly,
    "select * from {mart:item_month}",
)
query(
    "subscription_monthly",
    "date: month_start; bigint: subscription_id account_id; string: plan_id plan_name; bigint: paid_seats active_add_ons;"
    " double: mrr_local mrr_eur",
    marts.subscription_monthly,
    "select * from {mart:sub_month}",
)
_ACCOUNT_MRR = (
    "date: month_start; bigint: account_id; double: mrr_eur mrr_local; bigint: paid_seats active_add_ons;"
    " string: primary_plan_name"
)
query("account_mrr_monthly", _ACCOUNT_MRR, marts.account_mrr_monthly, "select * from {mart:account_mrr}")
query("account_mrr_complete", _ACCOUNT_MRR, marts.account_mrr_complete, "select * from {mart:grid}")
query(
    "mrr_movements",
    "date: month_start; bigint: account_id; double: previous_mrr mrr_eur movement_mrr; string: movement_type",
    marts.mrr_movements,
    "select * from {mart:move}",
)
_SINCE = dt.date(1997, 6, 1)


def _refreshed(t: BoundTables) -> DataFrame:
    """Movements after the marts were written from what was known before a month, and then refreshed from that month on."""
    folder = _scratch(t, "marts")
    known = t["subscription_items"].where(F.col("effective_start") < F.lit(_SINCE))
    known = known.withColumn("effective_end", F.least("effective_end", F.date_sub(F.lit(_SINCE), 1)))
    sources.write_marts(ChainMap({"subscription_items": known}, t), folder)
    return marts.mrr_movements(sources.refresh_marts(t, folder, _SINCE))


query(
    "mrr_movements_refreshed",
    "date: month_start; bigint: account_id; double: previous_mrr mrr_eur movement_mrr; string: movement_type",
    _refreshed,
    "select * from {mart:move}",
)
query(
    "account_usage_monthly",
    "date: month_start; bigint: account_id active_users active_mobile_users sessions work_orders_created"
    " work_orders_completed automation_runs api_calls documents_uploaded feature_breadth",
    marts.account_usage_monthly,
    "select * from {mart:usage}",
)
query(
    "support_monthly",
    "date: month_start; bigint: account_id tickets escalated_tickets; double: avg_first_response_hours"
    " avg_resolution_hours avg_csat; bigint: reopened_count",
    marts.support_monthly,
    "select * from {mart:support}",
)
query(
    "payment_monthly",
    "date: month_start; bigint: account_id invoices paid_invoices unpaid_invoices; double: invoiced_eur paid_eur",
    marts.payment_monthly,
    "select * from {mart:payment}",
)
query(
    "account_month",
    "date: month_start; bigint: account_id; string: country_code region_id segment sales_motion acquisition_channel;"
    " double: mrr_eur; bigint: paid_seats active_add_ons; string: primary_plan_name; bigint: active_users sessions"
    " work_orders_created work_orders_completed automation_runs api_calls feature_breadth support_tickets"
    " escalated_tickets unpaid_invoices; double: health_score; string: health_segment; boolean: renewal_risk_flag",
    lambda t: marts.account_month(t, *marts.FACTS),
    "select * from {mart:account_month}",
)
query(
    "invoice_payment_summary",
    "bigint: invoice_id account_id subscription_id; date: invoice_date due_date; string: country_code region_id segment;"
    " double: total_eur; string: invoice_status; bigint: attempt_count; timestamp: first_attempt_at successful_attempt_at;"
    " boolean: any_failure eventually_succeeded; bigint: maximum_attempt_number",
    marts.invoice_payment_summary,
    "select * from {mart:invoice_payment}",
)
_FUNNEL = """
    select a.account_id, a.country_code, a.region_id, a.segment, a.sales_motion, a.acquisition_channel, l.lead_id,
           (l.mql_at is not null) as reached_mql, (l.sql_at is not null) as reached_sql, o.opportunity_id,
           o.status as opportunity_status, o.expected_arr_eur, s.subscription_id, s.subscription_start_date,
           (s.subscription_id is not null) as became_customer
    from {accounts} a left join {leads} l using (account_id) left join {opportunities} o using (account_id)
    left join {subscriptions} s using (account_id)"""
_ACCOUNT = "account_id, country_code, region_id, segment, sales_motion, acquisition_channel"
_TOLD = (
    "became_customer, coalesce(bool_or(opportunity_status = 'won'), false) as has_won,"
    " min(subscription_start_date) as first_subscription_date"
)
_ANY = "bool_or(reached_mql) as reached_mql, bool_or(reached_sql) as reached_sql"
query(
    "sales_funnel_account",
    "bigint: account_id; string: country_code region_id segment sales_motion acquisition_channel; bigint: lead_id;"
    " boolean: reached_mql reached_sql; bigint: opportunity_id; string: opportunity_status; double: expected_arr_eur;"
    " bigint: subscription_id; date: subscription_start_date; boolean: became_customer has_won;"
    " date: first_subscription_date",
    marts.sales_funnel_account,
    f"""with r as ({_FUNNEL})
        select {_ACCOUNT}, lead_id, reached_mql, reached_sql, null as opportunity_id, null as opportunity_status,
               null as expected_arr_eur, null as subscription_id, null as subscription_start_date, {_TOLD}
        from r where lead_id is not null group by {_ACCOUNT}, lead_id, reached_mql, reached_sql, became_customer
        union all
        select {_ACCOUNT}, null, {_ANY}, opportunity_id, opportunity_status, expected_arr_eur, null, null, became_customer,
               (select coalesce(bool_or(o.status = 'won'), false) from {{opportunities}} o where o.account_id = r.account_id),
               min(subscription_start_date)
        from r where opportunity_id is not null
        group by {_ACCOUNT}, opportunity_id, opportunity_status, expected_arr_eur, became_customer
        union all
        select {_ACCOUNT}, null, {_ANY}, null, null, null, subscription_id, subscription_start_date, became_customer,
               coalesce(bool_or(opportunity_status = 'won'), false),
               (select min(s.subscription_start_date) from {{subscriptions}} s where s.account_id = r.account_id)
        from r where subscription_id is not null group by {_ACCOUNT}, subscription_id, subscription_start_date, became_customer
        union all
        select {_ACCOUNT}, null, false, false, null, null, null, null, null, false, false, null from r
        where lead_id is null and opportunity_id is null and subscription_id is null""",
)
_CROSSINGS = {
    "mql_accounts_with_win": ("account_id", "reached_mql and opportunity_status = 'won'"),
    "sql_customers": ("account_id", "reached_sql and became_customer"),
    "won_opportunities_of_mql": ("opportunity_id", "reached_mql and opportunity_status = 'won'"),
    "mql_leads_of_customers": ("lead_id", "reached_mql and became_customer"),
    "sql_leads_with_win": ("lead_id", "reached_sql and opportunity_status = 'won'"),
    "winners_without_subscription": ("account_id", "opportunity_status = 'won' and not became_customer"),
}
query(
    "sales_funnel_crossings",
    f"string: segment; bigint: {' '.join(_CROSSINGS)}",
    marts.sales_funnel_crossings,
    f"select segment, {', '.join(f'count(distinct {k}) filter (where {w}) as {c}' for c, (k, w) in _CROSSINGS.items())}"
    f" from ({_FUNNEL}) r group by segment",
)
_ARM = "string: experiment_id experiment_name variant"
_MEANS = "primary_mean guardrail_mean average_revenue_outcome_eur"
query(
    "experiment_analysis",
    f"{_ARM}; bigint: assigned_accounts exposed_accounts; double: {_MEANS}",
    marts.experiment_analysis,
    "select * from {mart:experiment}",
)

# --- revenue ---------------------------------------------------------------------------------

_BRIDGE = "opening_mrr new_mrr expansion_mrr contraction_mrr churned_mrr reactivation_mrr closing_mrr"
query(
    "monthly_mrr_bridge",
    f"date: month_start; double: {_BRIDGE} closing_arr",
    revenue.monthly_mrr_bridge,
    "select * from {mart:bridge}",
)
query(
    "mrr_by_geography",
    "date: month_start; string: region_id country_code; double: mrr_eur arr_eur; bigint: active_accounts; double: arpa_eur",
    revenue.mrr_by_geography,
    f"""select month_start, region_id, country_code, sum(mrr_eur) as mrr_eur, 12 * sum(mrr_eur) as arr_eur,
               {n('mrr_eur > 0')} as active_accounts, {avg('mrr_eur', 'mrr_eur > 0')} as arpa_eur
        from {{mart:account_month}} group by 1, 2, 3""",
)
query(
    "mrr_by_segment",
    "date: month_start; string: segment primary_plan_name; double: mrr_eur; bigint: active_accounts paid_seats;"
    " double: mrr_per_paid_seat",
    revenue.mrr_by_segment,
    f"""select month_start, segment, primary_plan_name, sum(mrr_eur) as mrr_eur, {n('mrr_eur > 0')} as active_accounts,
               sum(paid_seats) as paid_seats, {ratio('sum(mrr_eur)', 'sum(paid_seats)')} as mrr_per_paid_seat
        from {{mart:account_month}} group by 1, 2, 3""",
)
query(
    "revenue_retention",
    "date: month_start; double: opening_mrr gross_revenue_retention net_revenue_retention",
    revenue.revenue_retention,
    "select * from {mart:retention}",
)
query(
    "logo_churn",
    "date: month_start; bigint: opening_accounts churned_accounts new_accounts reactivated_accounts; double: logo_churn_rate",
    revenue.logo_churn,
    "select * from {mart:retention}",
)
_ATTACHED = "active_add_ons > 0 and mrr_eur > 0"
query(
    "add_on_attachment",
    "date: month_start; string: segment primary_plan_name; bigint: active_accounts accounts_with_add_ons;"
    " double: average_add_ons attachment_rate",
    revenue.add_on_attachment,
    f"""select month_start, segment, primary_plan_name, {n('mrr_eur > 0')} as active_accounts,
               {n(_ATTACHED)} as accounts_with_add_ons, {avg('active_add_ons', 'mrr_eur > 0')} as average_add_ons,
               {ratio(n(_ATTACHED), n('mrr_eur > 0'))} as attachment_rate
        from {{mart:account_month}} group by 1, 2, 3""",
)
query(
    "revenue_concentration",
    "double: top_1_pct_share top_10_pct_share total_mrr",
    revenue.revenue_concentration,
    f"""with ranked as (
            select mrr_eur, row_number() over (order by mrr_eur desc) as place, count(*) over () as accounts
            from {{mart:account_month}}
            where mrr_eur > 0 and month_start = (select max(month_start) from {{mart:account_month}}))
        select {ratio('sum(mrr_eur) filter (where place <= greatest(1, ceil(accounts * 0.01)))', 'sum(mrr_eur)')} as top_1_pct_share,
               {ratio('sum(mrr_eur) filter (where place <= greatest(1, ceil(accounts * 0.1)))', 'sum(mrr_eur)')} as top_10_pct_share,
               sum(mrr_eur) as total_mrr from ranked""",
)
query(
    "movement_totals",
    "string: movement_type; double: movement_mrr",
    revenue.movement_totals,
    "select movement_type, sum(movement_mrr) as movement_mrr from {mart:move} group by 1",
)

# --- acquisition -----------------------------------------------------------------------------

query(
    "sales_funnel",
    "string: country_code region_id sales_motion acquisition_channel; bigint: accounts leads mqls sqls opportunities"
    " won_opportunities paid_accounts; double: account_to_paid_rate",
    acquisition.sales_funnel,
    f"""select country_code, region_id, sales_motion, acquisition_channel, count(distinct account_id) as accounts,
               count(distinct lead_id) as leads, count(distinct case when reached_mql then account_id end) as mqls,
               count(distinct case when reached_sql then account_id end) as sqls,
               count(distinct opportunity_id) as opportunities,
               count(distinct case when opportunity_status = 'won' then opportunity_id end) as won_opportunities,
               count(distinct case when became_customer then account_id end) as paid_accounts,
               {ratio('count(distinct case when became_customer then account_id end)', 'count(distinct account_id)')} as account_to_paid_rate
        from {{mart:funnel}} group by 1, 2, 3, 4""",
)
_SELLER = "string: region_id country_code segment sales_motion"
query(
    "opportunity_win_rate",
    f"{_SELLER}; bigint: opportunities won; double: win_rate average_expected_arr",
    acquisition.opportunity_win_rate,
    f"""select region_id, country_code, segment, sales_motion, count(*) as opportunities, {n("status = 'won'")} as won,
               {ratio(n("status = 'won'"), 'count(*)')} as win_rate, {avg('expected_arr_eur')} as average_expected_arr
        from {{opportunities}} join {{accounts}} using (account_id) group by 1, 2, 3, 4""",
)
_CYCLE = "date_diff('day', cast(o.created_at as date), o.close_date)"
query(
    "sales_cycle",
    f"{_SELLER} status; double: average_sales_cycle_days median_sales_cycle_days",
    acquisition.sales_cycle,
    f"""select region_id, country_code, segment, sales_motion, o.status, {avg(_CYCLE)} as average_sales_cycle_days,
               quantile_cont({_CYCLE}, 0.5) as median_sales_cycle_days
        from {{opportunities}} o join {{accounts}} using (account_id) group by 1, 2, 3, 4, 5""",
)
_PARTNER = (
    "bigint: partner_id; string: partner_name partner_type country_code; bigint: referred_accounts converted_accounts;"
    " double: conversion_rate current_mrr_eur"
)
_LATEST = "(select account_id, mrr_eur from {mart:grid} where month_start = (select max(month_start) from {mart:grid}))"
_CONVERTED = ratio("count(distinct s.account_id)", "count(distinct a.account_id)")
query(
    "partner_performance",
    _PARTNER,
    acquisition.partner_performance,
    f"""select p.partner_id, p.partner_name, p.partner_type, p.country_code, count(distinct a.account_id) as referred_accounts,
               count(distinct s.account_id) as converted_accounts, {_CONVERTED} as conversion_rate,
               sum(m.mrr_eur) as current_mrr_eur
        from {{partners}} p left join {{accounts}} a on a.partner_id = p.partner_id
        left join (select distinct account_id from {{subscriptions}}) s on s.account_id = a.account_id
        left join {_LATEST} m on m.account_id = a.account_id group by 1, 2, 3, 4""",
)
query(
    "partner_performance_fanout",
    _PARTNER,
    lambda t: acquisition.partner_performance(t, per_subscription=True),
    f"""select p.partner_id, p.partner_name, p.partner_type, p.country_code, count(distinct a.account_id) as referred_accounts,
               count(distinct s.account_id) as converted_accounts, {_CONVERTED} as conversion_rate,
               sum(m.mrr_eur) as current_mrr_eur
        from {{partners}} p left join {{accounts}} a on a.partner_id = p.partner_id
        left join {{subscriptions}} s on s.account_id = a.account_id
        left join {_LATEST} m on m.account_id = a.account_id group by 1, 2, 3, 4""",
)
query(
    "trial_conversion",
    "string: country_code segment acquisition_channel; bigint: paid_after_trial; double: average_trial_days",
    acquisition.trial_conversion,
    f"""select country_code, segment, acquisition_channel, count(trial_start_date) as paid_after_trial,
               {avg("date_diff('day', trial_start_date, subscription_start_date)", 'trial_start_date is not null')} as average_trial_days
        from {{subscriptions}} join {{accounts}} using (account_id) group by 1, 2, 3""",
)
query(
    "contract_mix",
    "date: contract_month; string: region_id segment billing_frequency; bigint: contract_term_months contracts;"
    " double: average_discount auto_renew_share",
    acquisition.contract_mix,
    f"""select {month('c.start_date')} as contract_month, a.region_id, a.segment, c.billing_frequency, c.contract_term_months,
               count(*) as contracts, {avg('c.discount_pct')} as average_discount,
               {ratio(n('c.auto_renew_flag'), 'count(*)')} as auto_renew_share
        from {{contracts}} c join {{accounts}} a using (account_id) group by 1, 2, 3, 4, 5""",
)


def _acquisition_sql(month_name: str, acquired: str) -> str:
    return f"""select c.month_start as {month_name}, c.country_code, c.channel, c.spend_eur, coalesce(q.accounts, 0) as {acquired},
               {ratio('c.spend_eur', 'q.accounts')} as cac_eur
        from (select {month('start_date')} as month_start, country_code, channel, sum(spend_eur) as spend_eur
              from {{marketing_campaigns}} group by 1, 2, 3) c
        left join (select {month('s.subscription_start_date')} as month_start, a.country_code, a.acquisition_channel as channel,
                          count(distinct a.account_id) as accounts
                   from {{subscriptions}} s join {{accounts}} a using (account_id) group by 1, 2, 3) q
          using (month_start, country_code, channel)"""


query(
    "marketing_efficiency",
    "date: month_start; string: country_code channel; double: spend_eur; bigint: acquired_accounts; double: cac_eur",
    acquisition.marketing_efficiency,
    _acquisition_sql("month_start", "acquired_accounts"),
)

# --- product ---------------------------------------------------------------------------------

query(
    "product_adoption",
    f"{_PLACE}; bigint: paid_accounts active_accounts active_users sessions; double: average_feature_breadth"
    " automation_adoption_rate api_adoption_rate",
    product.product_adoption,
    f"""select {PLACE}, {n('mrr_eur > 0')} as paid_accounts, {n('active_users > 0')} as active_accounts,
               sum(active_users) as active_users, sum(sessions) as sessions,
               {avg('feature_breadth', 'active_users > 0')} as average_feature_breadth,
               {ratio(n('automation_runs > 0'), n('mrr_eur > 0'))} as automation_adoption_rate,
               {ratio(n('api_calls > 0'), n('mrr_eur > 0'))} as api_adoption_rate
        from {{mart:account_month}} group by 1, 2, 3, 4""",
)
query(
    "seat_utilisation",
    f"{_PLACE} primary_plan_name; bigint: active_users paid_seats; double: seat_utilisation; bigint: underutilised_accounts",
    product.seat_utilisation,
    f"""select {PLACE}, primary_plan_name, sum(active_users) as active_users, sum(paid_seats) as paid_seats,
               {ratio('sum(active_users)', 'sum(paid_seats)')} as seat_utilisation,
               {n('paid_seats > 0 and cast(active_users as double) / nullif(paid_seats, 0) < 0.40')} as underutilised_accounts
        from {{mart:account_month}} group by 1, 2, 3, 4, 5""",
)
query(
    "workflow_completion",
    f"{_PLACE}; bigint: work_orders_created work_orders_completed; double: completion_rate work_orders_per_paid_account",
    product.workflow_completion,
    f"""select {PLACE}, sum(work_orders_created) as work_orders_created, sum(work_orders_completed) as work_orders_completed,
               {ratio('sum(work_orders_completed)', 'sum(work_orders_created)')} as completion_rate,
               {ratio('sum(work_orders_created)', n('mrr_eur > 0'))} as work_orders_per_paid_account
        from {{mart:account_month}} group by 1, 2, 3, 4""",
)
_ONBOARD_DAYS = "date_diff('day', s.subscription_start_date, cast(o.completed_at as date))"
query(
    "onboarding_completion",
    "string: country_code region_id segment sales_motion; bigint: onboarding_accounts onboarding_tasks completed_tasks;"
    " double: task_completion_rate average_days_to_task",
    product.onboarding_completion,
    f"""select a.country_code, a.region_id, a.segment, a.sales_motion, count(distinct a.account_id) as onboarding_accounts,
               count(*) as onboarding_tasks, {n("o.task_status = 'completed'")} as completed_tasks,
               {ratio(n("o.task_status = 'completed'"), 'count(*)')} as task_completion_rate,
               {avg(_ONBOARD_DAYS)} as average_days_to_task
        from {{onboarding_tasks}} o join {{accounts}} a using (account_id) join {{subscriptions}} s using (account_id)
        group by 1, 2, 3, 4""",
)
_VALUE_DAYS = "date_diff('day', s.subscription_start_date, cast(w.first_done as date))"
query(
    "time_to_first_value",
    "string: country_code region_id segment sales_motion; double: average_days_to_first_completed_work_order"
    " median_days_to_first_value",
    product.time_to_first_value,
    f"""select a.country_code, a.region_id, a.segment, a.sales_motion,
               {avg(_VALUE_DAYS)} as average_days_to_first_completed_work_order,
               quantile_cont({_VALUE_DAYS}, 0.5) as median_days_to_first_value
        from {{subscriptions}} s join {{accounts}} a using (account_id)
        join (select account_id, min(completed_at) as first_done from {{work_orders}} where status = 'completed' group by 1) w
          using (account_id) group by 1, 2, 3, 4""",
)
query(
    "integration_adoption",
    "string: region_id country_code segment integration_type; bigint: connected_accounts;"
    " double: average_monthly_sync_volume active_integration_rate",
    product.integration_adoption,
    f"""select region_id, country_code, segment, integration_type, count(distinct account_id) as connected_accounts,
               {avg('monthly_sync_volume')} as average_monthly_sync_volume,
               {ratio(n("integration_status = 'active'"), 'count(*)')} as active_integration_rate
        from {{integrations}} join {{accounts}} using (account_id) group by 1, 2, 3, 4""",
)
query(
    "usage_before_churn",
    "string: segment primary_plan_name; double: average_active_users average_sessions average_feature_breadth"
    " average_completed_work_orders",
    product.usage_before_churn,
    f"""select m.segment, m.primary_plan_name, {avg('m.active_users')} as average_active_users,
               {avg('m.sessions')} as average_sessions, {avg('m.feature_breadth')} as average_feature_breadth,
               {avg('m.work_orders_completed')} as average_completed_work_orders
        from {{mart:account_month}} m join {{subscriptions}} s on s.account_id = m.account_id
         and m.month_start <= date_trunc('month', s.ended_date)
         and m.month_start >= date_trunc('month', s.ended_date) - interval 2 month
        group by 1, 2""",
)

# --- customer success and support ------------------------------------------------------------

query(
    "account_health_distribution",
    "date: health_month; string: region_id country_code segment health_segment; bigint: accounts;"
    " double: average_health_score mrr_eur",
    success.account_health_distribution,
    f"""select h.health_month, a.region_id, a.country_code, a.segment, h.health_segment, count(*) as accounts,
               {avg('h.health_score')} as average_health_score, sum(m.mrr_eur) as mrr_eur
        from {{account_health_history}} h join {{accounts}} a on a.account_id = h.account_id
        left join {{mart:account_month}} m on m.account_id = h.account_id and m.month_start = h.health_month
        group by 1, 2, 3, 4, 5""",
)
query(
    "renewal_risk",
    f"{_PLACE}; bigint: risk_accounts; double: risk_mrr_eur average_risk_health_score; bigint: payment_risk_accounts"
    " support_risk_accounts",
    success.renewal_risk,
    f"""select {PLACE}, {n('renewal_risk_flag')} as risk_accounts, sum(case when renewal_risk_flag then mrr_eur end) as risk_mrr_eur,
               {avg('health_score', 'renewal_risk_flag')} as average_risk_health_score,
               {n('unpaid_invoices > 0')} as payment_risk_accounts, {n('support_tickets >= 2')} as support_risk_accounts
        from {{mart:account_month}} group by 1, 2, 3, 4""",
)
query(
    "renewal_pipeline",
    "date: renewal_month; string: region_id country_code segment renewal_status; bigint: renewals; double: renewal_arr_eur"
    " average_renewal_probability probability_weighted_arr",
    success.renewal_pipeline,
    f"""select {month('r.renewal_due_date')} as renewal_month, a.region_id, a.country_code, a.segment, r.renewal_status,
               count(*) as renewals, sum(r.renewal_arr_eur) as renewal_arr_eur,
               {avg('r.renewal_probability')} as average_renewal_probability,
               sum(r.renewal_probability * r.renewal_arr_eur) as probability_weighted_arr
        from {{renewals}} r join {{subscriptions}} s using (subscription_id) join {{accounts}} a using (account_id)
        group by 1, 2, 3, 4, 5""",
)
query(
    "customer_success_intervention",
    "date: month_start; string: region_id segment interaction_type reason; bigint: interactions;"
    " double: average_health_before average_health_after average_health_lift",
    success.customer_success_intervention,
    f"""select {month('c.interaction_at')} as month_start, a.region_id, a.segment, c.interaction_type, c.reason,
               count(*) as interactions, {avg('health_score_before')} as average_health_before,
               {avg('health_score_after')} as average_health_after,
               {avg('health_score_after - health_score_before')} as average_health_lift
        from {{customer_success_interactions}} c join {{accounts}} a using (account_id) group by 1, 2, 3, 4, 5""",
)
query(
    "support_service_levels",
    f"{_PLACE} priority category; bigint: tickets; double: average_first_response_hours average_resolution_hours"
    " escalation_rate average_csat",
    success.support_service_levels,
    f"""select {month('t.created_at')} as month_start, a.region_id, a.country_code, a.segment, t.priority, t.category,
               count(*) as tickets,
               {hours("date_diff('microsecond', t.created_at, t.first_response_at)")} as average_first_response_hours,
               {hours("date_diff('microsecond', t.created_at, t.resolved_at)")} as average_resolution_hours,
               {ratio(n('t.escalated_flag'), 'count(*)')} as escalation_rate, {avg('t.csat_score')} as average_csat
        from {{support_tickets}} t join {{accounts}} a using (account_id) group by 1, 2, 3, 4, 5, 6""",
)
query(
    "nps",
    f"{_PLACE}; bigint: responses; double: average_score nps; string: leading_comment_theme",
    success.nps,
    f"""with answered as (
            select {month('r.response_date')} as month_start, a.region_id, a.country_code, a.segment, r.*
            from {{nps_responses}} r join {{accounts}} a using (account_id)),
        counted as (select {PLACE}, comment_theme, count(*) as times from answered group by 1, 2, 3, 4, 5),
        themes as (
            select {PLACE}, comment_theme, row_number() over (partition by {PLACE} order by times desc, comment_theme) as place
            from counted)
        select {PLACE}, s.responses, s.average_score, s.nps, themes.comment_theme as leading_comment_theme
        from (select {PLACE}, count(*) as responses, {avg('nps_score')} as average_score,
                     100.0::double * ({ratio(n("nps_group = 'promoter'"), 'count(*)')}
                     - {ratio(n("nps_group = 'detractor'"), 'count(*)')}) as nps
              from answered group by 1, 2, 3, 4) s join themes using ({PLACE}) where themes.place = 1""",
)
query(
    "churn_reasons",
    "date: churn_month; string: region_id country_code segment churn_type churn_reason; bigint: churned_accounts;"
    " double: churned_mrr_eur",
    success.churn_reasons,
    f"""select {month('e.event_at')} as churn_month, a.region_id, a.country_code, a.segment, s.churn_type,
               coalesce((select x.event_reason from {{subscription_events}} x
                         where x.subscription_id = e.subscription_id and x.event_type = 'cancellation_requested'
                         order by x.event_at desc, x.subscription_event_id desc limit 1), e.event_reason) as churn_reason,
               count(*) as churned_accounts, -sum(e.mrr_change_eur) as churned_mrr_eur
        from {{subscription_events}} e join {{subscriptions}} s using (subscription_id) join {{accounts}} a using (account_id)
        where e.event_type = 'subscription_churned' group by 1, 2, 3, 4, 5, 6""",
)

# --- billing ---------------------------------------------------------------------------------

_AT_ONCE = "p.maximum_attempt_number = 1 and p.eventually_succeeded"
query(
    "payment_success",
    f"{_PLACE} method_type; bigint: invoices successful_invoices first_attempt_successes; double: eventual_success_rate"
    " first_attempt_success_rate",
    billing.payment_success,
    f"""select {month('p.invoice_date')} as month_start, p.region_id, p.country_code, p.segment, k.method_type,
               count(*) as invoices, {n('p.eventually_succeeded')} as successful_invoices,
               {n(_AT_ONCE)} as first_attempt_successes,
               {ratio(n('p.eventually_succeeded'), 'count(*)')} as eventual_success_rate,
               {ratio(n(_AT_ONCE), 'count(*)')} as first_attempt_success_rate
        from {{mart:invoice_payment}} p
        left join {{payment_attempts}} f on f.invoice_id = p.invoice_id and f.attempt_number = 1
        left join {{payment_methods}} k on k.payment_method_id = f.payment_method_id group by 1, 2, 3, 4, 5""",
)
query(
    "payment_recovery",
    f"{_PLACE}; bigint: failed_first_or_later_invoices recovered_invoices; double: failed_value_eur recovered_value_eur"
    " recovery_rate",
    billing.payment_recovery,
    f"""select {month('invoice_date')} as month_start, region_id, country_code, segment,
               {n('any_failure')} as failed_first_or_later_invoices,
               {n('any_failure and eventually_succeeded')} as recovered_invoices,
               sum(case when any_failure then total_eur end) as failed_value_eur,
               sum(case when any_failure and eventually_succeeded then total_eur end) as recovered_value_eur,
               {ratio(n('any_failure and eventually_succeeded'), n('any_failure'))} as recovery_rate
        from {{mart:invoice_payment}} group by 1, 2, 3, 4""",
)
query(
    "dunning_effectiveness",
    "date: month_start; bigint: dunning_step; string: channel; bigint: dunning_events recovered_after_event;"
    " double: recovery_rate",
    billing.dunning_effectiveness,
    f"""select {month('event_at')} as month_start, dunning_step, channel, count(*) as dunning_events,
               {n('recovered_after_event_flag')} as recovered_after_event,
               {ratio(n('recovered_after_event_flag'), 'count(*)')} as recovery_rate
        from {{dunning_events}} group by 1, 2, 3""",
)
_UNPAID = "invoice_status in ('overdue', 'open')"
query(
    "overdue_receivables",
    "date: due_month; string: region_id country_code segment; bigint: unpaid_invoices; double: unpaid_eur"
    " average_days_overdue",
    lambda t: billing.overdue_receivables(t, _day(AS_OF)),
    f"""select {month('due_date')} as due_month, region_id, country_code, segment, {n(_UNPAID)} as unpaid_invoices,
               sum(case when {_UNPAID} then total_eur end) as unpaid_eur,
               {avg(f"date_diff('day', due_date, date '{AS_OF}')", "invoice_status = 'overdue'")} as average_days_overdue
        from {{mart:invoice}} group by 1, 2, 3, 4""",
)
_ADJUST = f"{_PLACE}; double: invoiced_eur credit_eur refund_eur adjustment_rate"
query(
    "refunds_and_credits",
    _ADJUST,
    billing.refunds_and_credits,
    f"""select {month('i.invoice_date')} as month_start, i.region_id, i.country_code, i.segment, sum(i.total_eur) as invoiced_eur,
               coalesce(sum(c.credit), 0) as credit_eur, coalesce(sum(r.refund), 0) as refund_eur,
               {ratio('coalesce(sum(c.credit), 0) + coalesce(sum(r.refund), 0)', 'sum(i.total_eur)')} as adjustment_rate
        from {{mart:invoice}} i
        left join (select invoice_id, sum(amount_eur) as credit from {{credit_notes}} group by 1) c using (invoice_id)
        left join (select invoice_id, sum(f.amount_eur) as refund from {{payments}} p join {{refunds}} f using (payment_id)
                   group by 1) r using (invoice_id) group by 1, 2, 3, 4""",
)
query(
    "refunds_and_credits_fanout",
    _ADJUST,
    lambda t: billing.refunds_and_credits(t, multiplied=True),
    f"""select {month('i.invoice_date')} as month_start, i.region_id, i.country_code, i.segment, sum(i.total_eur) as invoiced_eur,
               coalesce(sum(c.amount_eur), 0) as credit_eur, coalesce(sum(f.amount_eur), 0) as refund_eur,
               {ratio('coalesce(sum(c.amount_eur), 0) + coalesce(sum(f.amount_eur), 0)', 'sum(i.total_eur)')} as adjustment_rate
        from {{mart:invoice}} i left join {{credit_notes}} c on c.invoice_id = i.invoice_id
        left join {{payments}} p on p.invoice_id = i.invoice_id left join {{refunds}} f on f.payment_id = p.payment_id
        group by 1, 2, 3, 4""",
)
query(
    "invoice_reconciliation",
    "bigint: invoice_id; double: subtotal_local invoice_line_total_local difference_local; boolean: reconciled",
    billing.invoice_reconciliation,
    """select invoice_id, subtotal_local, lines as invoice_line_total_local, subtotal_local - lines as difference_local,
              abs(subtotal_local - lines) <= 0.02 as reconciled
       from {invoices} join (select invoice_id, sum(line_total_local) as lines from {invoice_lines} group by 1) l
         using (invoice_id)""",
)

# --- experiments and executive ---------------------------------------------------------------

query(
    "experiment_assignment_integrity",
    f"{_ARM}; bigint: assignments; double: assignment_share; bigint: unique_accounts duplicate_assignments",
    experiments.experiment_assignment_integrity,
    f"""select experiment_id, experiment_name, variant, count(*) as assignments,
               cast(count(*) as double) / sum(count(*)) over (partition by experiment_id) as assignment_share,
               count(distinct account_id) as unique_accounts, count(*) - count(distinct account_id) as duplicate_assignments
        from {{experiments}} join {{experiment_assignments}} using (experiment_id) group by 1, 2, 3""",
)
query(
    "experiment_exposure",
    f"{_ARM}; bigint: assigned exposed; double: exposure_rate average_exposures",
    experiments.experiment_exposure,
    f"""select e.experiment_id, e.experiment_name, a.variant, count(distinct a.assignment_id) as assigned,
               count(distinct x.assignment_id) as exposed,
               {ratio('count(distinct x.assignment_id)', 'count(distinct a.assignment_id)')} as exposure_rate,
               {avg('x.exposure_count')} as average_exposures
        from {{experiments}} e join {{experiment_assignments}} a using (experiment_id)
        left join {{experiment_exposures}} x on x.assignment_id = a.assignment_id group by 1, 2, 3""",
)
query(
    "experiment_outcomes",
    f"{_ARM}; bigint: assigned_accounts exposed_accounts; double: {_MEANS} absolute_effect_vs_control"
    " relative_effect_vs_control",
    experiments.experiment_outcomes,
    """select v.*, v.primary_mean - k.primary_mean as absolute_effect_vs_control,
              v.primary_mean / nullif(k.primary_mean, 0) - 1 as relative_effect_vs_control
       from {mart:experiment} v left join {mart:experiment} k on k.experiment_id = v.experiment_id and k.variant = 'control'""",
)
query(
    "experiment_segment_effects",
    f"string: experiment_id variant country_code segment; bigint: observations; double: {_MEANS}",
    experiments.experiment_segment_effects,
    f"""select experiment_id, variant, split_part(stratum, '|', 1) as country_code, split_part(stratum, '|', 2) as segment,
               count(*) as observations, {avg('primary_outcome')} as primary_mean, {avg('guardrail_outcome')} as guardrail_mean,
               {avg('revenue_outcome_eur')} as average_revenue_outcome_eur
        from {{mart:experiment_rows}} where seen_id is not null and outcome_id is not null group by 1, 2, 3, 4""",
)
_SCORECARD = (
    "date: month_start; double: closing_mrr closing_arr new_mrr expansion_mrr contraction_mrr churned_mrr reactivation_mrr"
    " gross_revenue_retention net_revenue_retention; bigint: opening_accounts churned_accounts; double: logo_churn_rate;"
    " bigint: paid_seats active_users; double: seat_utilisation; bigint: risk_accounts; double: risk_mrr_eur"
)
_SCORECARD_SQL = f"""select r.*, k.paid_seats, k.active_users, {ratio('k.active_users', 'k.paid_seats')} as seat_utilisation,
               k.risk_accounts, k.risk_mrr_eur
        from {{mart:retention}} r left join (
            select month_start, sum(paid_seats) as paid_seats, sum(active_users) as active_users,
                   {n('renewal_risk_flag')} as risk_accounts, sum(case when renewal_risk_flag then mrr_eur end) as risk_mrr_eur
            from {{mart:account_month}} group by 1) k using (month_start)"""
query("executive_monthly_scorecard", _SCORECARD, executive.executive_monthly_scorecard, _SCORECARD_SQL)
query(
    "latest_executive_scorecard",
    _SCORECARD,
    executive.latest_executive_scorecard,
    _SCORECARD_SQL + " order by month_start desc limit 1",
)
query(
    "regional_operating_review",
    "date: month_start; string: region_id; double: mrr_eur; bigint: active_accounts paid_seats active_users"
    " completed_work_orders support_tickets renewal_risk_accounts; double: average_health_score",
    executive.regional_operating_review,
    f"""select month_start, region_id, sum(mrr_eur) as mrr_eur, {n('mrr_eur > 0')} as active_accounts,
               sum(paid_seats) as paid_seats, sum(active_users) as active_users,
               sum(work_orders_completed) as completed_work_orders, sum(support_tickets) as support_tickets,
               {n('renewal_risk_flag')} as renewal_risk_accounts, {avg('health_score')} as average_health_score
        from {{mart:account_month}} group by 1, 2""",
)

# --- report pack -----------------------------------------------------------------------------



def _history():
    return _day(HISTORY[0]), _day(HISTORY[1])


_BY_ACCOUNT = "country_code region_id segment sales_motion acquisition_channel"
query(
    "report_mrr_snapshot",
    f"date: month; bigint: subscription_id account_id; string: {_BY_ACCOUNT}; double: mrr_eur; bigint: recurring_items",
    reports.mrr_snapshot,
    """select m.month_start as month, m.subscription_id, m.account_id, a.country_code, a.region_id, a.segment, a.sales_motion,
              a.acquisition_channel, sum(m.mrr_eur) as mrr_eur, count(m.item_type) as recurring_items
       from {mart:item_month} m left join {accounts} a using (account_id) group by all""",
)
_REPORT_BRIDGE = f"date: month; double: {_BRIDGE} bridge_reconciliation"
query(
    "report_mrr_bridge",
    _REPORT_BRIDGE,
    lambda t: reports.mrr_bridge(t, *_history()),
    "select * from {mart:report_bridge}",
)
query(
    "report_bridge_tail18",
    _REPORT_BRIDGE,
    lambda t: reports.bridge_tail(t, *_history()),
    "select * from {mart:report_bridge} order by month desc limit 18",
)
query(
    "report_account_mrr_movements",
    "bigint: account_id; date: month; double: mrr_eur previous_mrr; boolean: ever_active_before; string: movement_type;"
    " double: movement_mrr",
    lambda t: reports.account_mrr_movements(t, *_history()),
    "select * from {mart:report_movement}",
)
query(
    "cohort_retention",
    "date: cohort_month; bigint: cohort_age retained_accounts; double: retained_mrr; bigint: cohort_accounts;"
    " double: cohort_mrr logo_retention revenue_retention",
    reports.cohort_retention,
    f"""with aged as (
            select m.account_id, m.mrr_eur, f.cohort_month, date_diff('month', f.cohort_month, m.month_start) as cohort_age
            from {{mart:account_mrr}} m join (
                select account_id, min(month_start) as cohort_month from {{mart:account_mrr}} where mrr_eur > 0 group by 1) f
              using (account_id))
        select c.cohort_month, c.cohort_age, c.retained_accounts, c.retained_mrr, b.cohort_accounts, b.cohort_mrr,
               {ratio('c.retained_accounts', 'b.cohort_accounts')} as logo_retention,
               {ratio('c.retained_mrr', 'b.cohort_mrr')} as revenue_retention
        from (select cohort_month, cohort_age, count(distinct account_id) as retained_accounts, sum(mrr_eur) as retained_mrr
              from aged group by 1, 2) c
        left join (select cohort_month, count(distinct account_id) as cohort_accounts, sum(mrr_eur) as cohort_mrr
                   from aged where cohort_age = 0 group by 1) b using (cohort_month)""",
)
query(
    "report_revenue_retention",
    "date: month; double: gross_revenue_retention net_revenue_retention opening_mrr",
    reports.revenue_retention,
    "select * from {mart:report_retention}",
)


def _by_funnel(name: str, body: str) -> str:
    return (
        "select a.country_code, a.region_id, a.sales_motion, a.acquisition_channel, "
        f"{body} from {name} join {{accounts}} a using (account_id) group by 1, 2, 3, 4"
    )


_FUNNEL = "country_code, region_id, sales_motion, acquisition_channel"
query(
    "report_sales_funnel",
    "string: country_code region_id sales_motion acquisition_channel; bigint: accounts leads mqls sqls opportunities"
    " won_opportunities; double: pipeline_arr_eur; bigint: paid_accounts; double: lead_to_mql mql_to_sql"
    " opportunity_win_rate account_to_paid",
    reports.sales_funnel,
    f"""with counted as (
            select {_FUNNEL}, b.accounts, coalesce(l.leads, 0) as leads, coalesce(l.mqls, 0) as mqls, coalesce(l.sqls, 0) as sqls,
                   coalesce(o.opportunities, 0) as opportunities, coalesce(o.won, 0) as won_opportunities,
                   coalesce(o.pipeline, 0) as pipeline_arr_eur, coalesce(p.paid, 0) as paid_accounts
            from (select {_FUNNEL}, count(distinct account_id) as accounts from {{accounts}} group by 1, 2, 3, 4) b
            left join ({_by_funnel('{leads}', 'count(distinct lead_id) as leads, count(mql_at) as mqls, count(sql_at) as sqls')}) l using ({_FUNNEL})
            left join ({_by_funnel('{opportunities}', "count(distinct opportunity_id) as opportunities, count(*) filter (where status = 'won') as won, sum(expected_arr_eur) as pipeline")}) o using ({_FUNNEL})
            left join ({_by_funnel('{subscriptions}', 'count(distinct account_id) as paid')}) p using ({_FUNNEL}))
        select *, {ratio('mqls', 'leads')} as lead_to_mql, {ratio('sqls', 'mqls')} as mql_to_sql,
               {ratio('won_opportunities', 'opportunities')} as opportunity_win_rate, {ratio('paid_accounts', 'accounts')} as account_to_paid
        from counted""",
)
query(
    "report_payment_recovery",
    "date: attempt_month; string: country_code segment; bigint: failed_invoices recovered_invoices;"
    " double: failed_value_eur recovered_value_eur average_attempts recovery_rate",
    reports.payment_recovery,
    f"""with numbered as (
            select *, row_number() over (partition by invoice_id order by attempt_number, payment_attempt_id) as place,
                   count(*) over (partition by invoice_id) as attempts,
                   bool_or(attempt_status = 'succeeded') over (partition by invoice_id) as recovered
            from {{payment_attempts}})
        select {month('f.attempt_at')} as attempt_month, a.country_code, a.segment, count(*) as failed_invoices,
               {n('f.recovered')} as recovered_invoices, sum(i.total_eur) as failed_value_eur,
               sum(case when f.recovered then i.total_eur else 0 end) as recovered_value_eur,
               {avg('f.attempts')} as average_attempts, {ratio(n('f.recovered'), 'count(*)')} as recovery_rate
        from numbered f join {{invoices}} i using (invoice_id) join {{accounts}} a using (account_id)
        where f.place = 1 and f.attempt_status = 'failed' group by 1, 2, 3""",
)
query(
    "report_product_adoption",
    "date: activity_month; string: country_code region_id segment; bigint: active_accounts active_users sessions"
    " work_orders_created; double: work_order_completion_rate automation_adoption_rate api_adoption_rate"
    " average_feature_breadth",
    reports.product_adoption,
    f"""select u.month_start as activity_month, a.country_code, a.region_id, a.segment, count(*) as active_accounts,
               sum(u.active_users) as active_users, sum(u.sessions) as sessions, sum(u.work_orders_created) as work_orders_created,
               {avg("cast(cast(u.work_orders_completed as double) / nullif(u.work_orders_created, 0) as decimal(20,12))")} as work_order_completion_rate,
               {ratio(n('u.automation_runs > 0'), 'count(*)')} as automation_adoption_rate,
               {ratio(n('u.api_calls > 0'), 'count(*)')} as api_adoption_rate, {avg('u.feature_breadth')} as average_feature_breadth
        from {{mart:usage}} u join {{accounts}} a using (account_id) group by 1, 2, 3, 4""",
)
query(
    "report_account_health",
    from_contract("account_health_history") + "; double: mrr_eur",
    reports.account_health,
    """select h.*, coalesce(m.mrr_eur, 0) as mrr_eur from {account_health_history} h
       left join {mart:account_mrr} m on m.account_id = h.account_id and m.month_start = h.health_month""",
)
_COUNTRY_SQL = f"""select coalesce(m.country_code, i.country_code) as country_code, coalesce(m.region_id, i.region_id) as region_id,
               coalesce(m.active_accounts, 0) as active_accounts, coalesce(m.mrr_eur, 0) as mrr_eur,
               coalesce(i.invoiced, 0) as invoiced_revenue_eur, coalesce(i.invoices, 0) as invoices,
               coalesce(i.paid_rate, 0) as paid_invoice_rate
        from (select a.country_code, a.region_id, count(distinct a.account_id) as active_accounts, sum(r.mrr_eur) as mrr_eur
              from {{mart:account_mrr}} r join {{accounts}} a using (account_id)
              where r.month_start = (select max(month_start) from {{mart:account_mrr}}) group by 1, 2) m
        full join (select a.country_code, a.region_id, sum(v.total_eur) as invoiced, count(distinct v.invoice_id) as invoices,
                          {ratio(n("v.invoice_status = 'paid'"), 'count(*)')} as paid_rate
                   from {{invoices}} v join {{accounts}} a using (account_id) group by 1, 2) i
          on i.country_code = m.country_code and i.region_id = m.region_id"""
_COUNTRY = (
    "string: country_code region_id; bigint: active_accounts; double: mrr_eur invoiced_revenue_eur; bigint: invoices;"
    " double: paid_invoice_rate"
)
query("report_country_performance", _COUNTRY, reports.country_performance, _COUNTRY_SQL)
query(
    "report_top_countries",
    _COUNTRY,
    lambda t: reports.top_countries(t, 10),
    _COUNTRY_SQL + " order by mrr_eur desc, country_code limit 10",
)
_DIGITS = ("control_mean", "treatment_mean", "absolute_effect", "relative_effect", "ci_lower", "ci_upper", "p_value")
_DIGITS += ("guardrail_control", "guardrail_treatment", "average_revenue_effect_eur")


def _rounded(frame: DataFrame, names: tuple[str, ...], digits: int = 9) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in names})


_POLY_NUM = "((((((0.0352624965998911e0 * z + 0.700383064443688e0) * z + 6.37396220353165e0) * z + 33.912866078383e0) * z + 112.079291497871e0) * z + 221.213596169931e0) * z + 220.206867912376e0)"
_POLY_DEN = "(((((((0.0883883476483184e0 * z + 1.75566716318264e0) * z + 16.064177579207e0) * z + 86.7807322029461e0) * z + 296.564248779674e0) * z + 637.333633378831e0) * z + 793.826512519948e0) * z + 440.413735824752e0)"
_TAIL = f"case when z > 37 then 0 when z < 7.07106781186547e0 then exp(-z * z / 2) * {_POLY_NUM} / {_POLY_DEN} else exp(-z * z / 2) / (z + 1 / (z + 2 / (z + 3 / (z + 4 / (z + 0.65e0))))) / 2.506628274631e0 end"
query(
    "experiment_decisions",
    "string: experiment_id experiment_name; bigint: control_n treatment_n; double: " + " ".join(_DIGITS) + "; string: decision",
    lambda t: _rounded(experiments.experiment_decisions(t), _DIGITS),
    f"""with arms as (
            select experiment_id, experiment_name, variant, count(primary_outcome) as n, avg(primary_outcome::double) as m,
                   var_samp(primary_outcome::double) as v, avg(guardrail_outcome::double) as g, avg(revenue_outcome_eur::double) as r
            from {{mart:experiment_rows}} where seen_id is not null and outcome_id is not null group by 1, 2, 3),
        effects as (
            select c.experiment_id, c.experiment_name, c.n as control_n, t.n as treatment_n, c.m as control_mean, t.m as treatment_mean,
                   t.m - c.m as effect, sqrt(t.v / t.n + c.v / c.n) as err, c.g as gc, t.g as gt, t.r - c.r as re
            from arms c join arms t on t.experiment_id = c.experiment_id and c.variant = 'control' and t.variant = 'treatment'
            where c.n >= 2 and t.n >= 2),
        tested as (select *, abs(effect / nullif(err, 0)) as z from effects),
        judged as (select *, coalesce(2 * ({_TAIL}), 1.0) as p from tested)
        select experiment_id, experiment_name, control_n, treatment_n, round(control_mean, 9) as control_mean,
               round(treatment_mean, 9) as treatment_mean, round(effect, 9) as absolute_effect,
               round(effect / nullif(control_mean, 0), 9) as relative_effect, round(effect - 1.96 * err, 9) as ci_lower,
               round(effect + 1.96 * err, 9) as ci_upper, round(p, 9) as p_value, round(gc, 9) as guardrail_control,
               round(gt, 9) as guardrail_treatment, round(re, 9) as average_revenue_effect_eur,
               case when p < 0.05 and effect > 0 and effect - 1.96 * err > -0.25 * minimum_detectable_effect::double then 'LAUNCH'
                    when p < 0.05 and effect < 0 then 'DO NOT LAUNCH' else 'INCONCLUSIVE' end as decision
        from judged join (select experiment_id, minimum_detectable_effect from {{experiments}}) d using (experiment_id)""",
)
query(
    "unit_economics",
    "date: month; string: country_code channel; double: spend_eur; bigint: new_customers; double: cac_eur",
    reports.unit_economics,
    _acquisition_sql("month", "new_customers"),
)

# --- data quality ----------------------------------------------------------------------------

_CHECK = "string: check_id table_name check_type severity; boolean: passed; bigint: failure_count; string: details"


def _check_row(check_id: str, table: str, kind: str, failures: str, details: str, source: str = "") -> str:
    quoted = details.replace("'", "''")
    return (
        f"select '{check_id}' as check_id, '{table}' as table_name, '{kind}' as check_type, 'error' as severity,"
        f" ({failures}) = 0 as passed, ({failures}) as failure_count, '{quoted}' as details{source}"
    )


_NOT_TYPE = {
    "integer": "{c} is not null and (try_cast(trim({c}) as decimal(38,6)) is null or try_cast(trim({c}) as decimal(38,6)) % 1 <> 0)",
    "decimal": "{c} is not null and try_cast(trim({c}) as decimal(38,6)) is null",
    "date": "{c} is not null and try_cast(trim({c}) as timestamp) is null",
    "timestamp": "{c} is not null and try_cast(trim({c}) as timestamp) is null",
    "boolean": "{c} is not null and {c} not in ('true', 'false', 'True', 'False', '1', '0')",
    "string": "false",
}


def _column_check_sql() -> str:
    rows = []
    for table, contract in CONTRACTS.items():
        missing, extra = sorted(DROPPED.get(table, ())), sorted(ADDED.get(table, {}))
        details = f"Columns not found: {missing}; not in the contract: {extra}"
        rows.append(_check_row(f"{table}.columns", table, "schema", str(len(missing)), details))
        if missing:
            continue
        counts = ", ".join(f"{n(_NOT_TYPE[k].format(c=c))} as \"{c}\"" for c, k in contract.columns.items())
        kinds = "map {" + ", ".join(f"'{c}': '{k}'" for c, k in contract.columns.items()) + "}"
        rows.append(
            f"select '{table}.' || c || '.type', '{table}', 'type', 'error', bad = 0, bad,"
            f" 'Every value of ' || c || ' reads as ' || {kinds}[c] || '.'"
            f" from (unpivot (select {counts} from {{text:{table}}}) on columns(*) into name c value bad) u"
        )
    return " union all ".join(rows)


def _primary_key_sql() -> str:
    rows = []
    for table, contract in CONTRACTS.items():
        keys, names = ", ".join(contract.key), list(contract.key)
        nulls = " or ".join(f"{k} is null" for k in contract.key)
        rows.append(
            _check_row(
                f"{table}.pk_not_null", table, "primary_key", n(nulls), f"No part of the key {names} is empty.", f" from {{text:{table}}}"
            )
        )
        rows.append(
            _check_row(
                f"{table}.pk_unique",
                table,
                "primary_key",
                "coalesce(sum(n) filter (where n > 1), 0)",
                f"No two rows share the key {names}.",
                f" from (select count(*) as n from {{text:{table}}} group by {keys}) k",
            )
        )
    return " union all ".join(rows)


def _foreign_key_sql() -> str:
    rows = []
    for table in CONTRACTS:
        for number, (column, parent) in enumerate(references_of(table), start=1):
            key = CONTRACTS[parent].key[0]
            rows.append(
                _check_row(
                    f"{table}.fk_{number}",
                    table,
                    "foreign_key",
                    n("orphan"),
                    f"Every {column} is a {key} of {parent}.",
                    f" from (select {column} is not null and not exists (select 1 from {{text:{parent}}} p"
                    f" where p.{key} = c.{column}) as orphan from {{text:{table}}} c) o",
                )
            )
    return " union all ".join(rows)


def _num(column: str) -> str:
    return f"try_cast(trim({column}) as decimal(38,6))"


def _ts(column: str) -> str:
    return f"try_cast(trim({column}) as timestamp)"


_RULE_SQL = {
    "subscriptions.date_order": f"{_ts('trial_start_date')} > {_ts('subscription_start_date')}",
    "subscriptions.end_after_start": f"{_ts('ended_date')} < {_ts('subscription_start_date')}",
    "subscription_items.valid_interval": f"{_ts('effective_end')} < {_ts('effective_start')}",
    "subscription_items.non_negative_mrr": f"{_num('mrr_eur')} < 0",
    "invoices.arithmetic": f"abs({_num('subtotal_local')} + {_num('tax_local')} - {_num('total_local')}) > 0.02",
    "invoice_lines.non_negative": f"{_num('line_total_local')} < 0",
    "payment_attempts.positive_amount": f"{_num('amount_local')} <= 0",
    "payments.positive_amount": f"{_num('amount_eur')} <= 0",
    "usage.non_negative": " or ".join(
        f"{_num(c)} < 0" for c in CONTRACTS["account_usage_daily"].columns if c not in ("account_id", "activity_date", "active_mobile_users")
    ),
    "work_orders.completed_chronology": f"{_ts('completed_at')} < {_ts('created_at')}",
    "support.resolution_chronology": f"{_ts('resolved_at')} < {_ts('created_at')}",
    "health.score_range": f"coalesce({_num('health_score')} not between 0 and 100, true)",
    "nps.score_range": f"coalesce({_num('nps_score')} not between 0 and 10, true)",
}


def _business_sql() -> str:
    return " union all ".join(
        _check_row(k.check_id, k.table, k.kind, n(_RULE_SQL[k.check_id]), k.details, f" from {{text:{k.table}}}")
        for k in quality.BUSINESS_RULES
    )


_LINES_SQL = _check_row(
    "invoices.lines_reconcile",
    "invoices",
    "reconciliation",
    n(f"abs({_num('subtotal_local')} - coalesce(lines, 0)) > 0.02"),
    "The lines of an invoice add up to its subtotal.",
    f" from {{text:invoices}} left join (select invoice_id, sum({_num('line_total_local')}) as lines"
    " from {text:invoice_lines} group by 1) l using (invoice_id)",
)
_ATTEMPT_SQL = _check_row(
    "payments.successful_attempt",
    "payments",
    "reconciliation",
    n("ok is null"),
    "A payment stems from an attempt that succeeded.",
    " from {text:payments} p left join (select payment_attempt_id, true as ok from {text:payment_attempts}"
    " where attempt_status = 'succeeded') s using (payment_attempt_id)",
)
_ALL_CHECKS = " union all ".join(
    [_column_check_sql(), _primary_key_sql(), _foreign_key_sql(), _business_sql(), _LINES_SQL, _ATTEMPT_SQL]
)
query("dq_contract_checks", _CHECK, lambda t: quality.column_checks(LandedTables(t)), _column_check_sql())
query("dq_primary_keys", _CHECK, lambda t: quality.primary_key_checks(LandedTables(t)), _primary_key_sql())
query("dq_foreign_keys", _CHECK, lambda t: quality.foreign_key_checks(LandedTables(t)), _foreign_key_sql())
query("dq_business_rules", _CHECK, lambda t: quality.business_rule_checks(LandedTables(t)), _business_sql())
query("dq_invoice_lines_reconcile", _CHECK, lambda t: quality.invoice_line_checks(LandedTables(t)), _LINES_SQL)
query("dq_payment_attempts", _CHECK, lambda t: quality.payment_attempt_checks(LandedTables(t)), _ATTEMPT_SQL)
query(
    "dq_gate",
    "bigint: checks blocking_failures; boolean: gate_passed",
    lambda t: quality.gate(quality.validate(LandedTables(t))),
    f"""select count(*) as checks, {n("severity = 'error' and not passed")} as blocking_failures,
               count(*) > 0 and bool_and(passed or severity <> 'error') as gate_passed from ({_ALL_CHECKS}) v""",
)
query(
    "dq_failures",
    _CHECK,
    lambda t: quality.failures(quality.validate(LandedTables(t))),
    f"select * from ({_ALL_CHECKS}) v where not passed",
)
query(
    "executive_summary",
    "date: reporting_month; bigint: active_accounts; double: closing_mrr_eur arr_eur net_revenue_retention;"
    " bigint: failed_payment_attempts accounts_at_risk quality_checks quality_failures",
    lambda t: reports.executive_summary(t, quality.validate(LandedTables(t)), *_history()),
    f"""select b.month as reporting_month,
               (select count(distinct account_id) from {{mart:account_mrr}}
                where month_start = (select max(month_start) from {{mart:account_mrr}})) as active_accounts,
               b.closing_mrr as closing_mrr_eur, round(b.closing_mrr * 12, 2) as arr_eur,
               (select round(net_revenue_retention, 4) from {{mart:report_retention}} where net_revenue_retention is not null
                order by month desc limit 1) as net_revenue_retention,
               (select count(*) from {{payment_attempts}} where attempt_status = 'failed') as failed_payment_attempts,
               (select {n('renewal_risk_flag')} from {{account_health_history}}
                where health_month = (select max(health_month) from {{account_health_history}})) as accounts_at_risk,
               (select count(*) from ({_ALL_CHECKS}) v) as quality_checks,
               (select count(*) from ({_ALL_CHECKS}) v where not passed) as quality_failures
        from {{mart:report_bridge}} b order by b.month desc limit 1""",
)


def _control_sql() -> str:
    rows = [
        ("Q001", "subscriptions", "subscription_start_before_end", "ended_date < subscription_start_date", "{subscriptions}"),
        ("Q002", "subscription_items", "effective_interval_valid", "effective_end < effective_start", "{subscription_items}"),
        ("Q003", "subscription_items", "non_negative_mrr", "least(mrr_eur, mrr_local) < 0", "{subscription_items}"),
        ("Q004", "invoices", "invoice_arithmetic", "abs(subtotal_local + tax_local - total_local) > 0.02", "{invoices}"),
        (
            "Q005",
            "invoice_lines",
            "invoice_line_reconciliation",
            "abs(subtotal_local - lines) > 0.02",
            "{invoices} join (select invoice_id, sum(line_total_local) as lines from {invoice_lines} group by 1) l using (invoice_id)",
        ),
        (
            "Q006",
            "payments",
            "payment_references_successful_attempt",
            "attempt_status <> 'succeeded'",
            "{payments} p join {payment_attempts} k on k.payment_attempt_id = p.payment_attempt_id",
        ),
        ("Q007", "payment_attempts", "attempt_numbers_and_amounts_positive", "attempt_number < 1 or amount_local <= 0", "{payment_attempts}"),
        (
            "Q008",
            "account_usage_daily",
            "usage_counts_non_negative",
            "least(active_users, active_mobile_users, sessions, work_orders_created, work_orders_completed, automation_runs, api_calls, documents_uploaded) < 0",
            "{account_usage_daily}",
        ),
        ("Q009", "work_orders", "work_order_chronology", "completed_at < created_at", "{work_orders}"),
        (
            "Q010",
            "support_tickets",
            "ticket_chronology",
            "first_response_at < created_at or resolved_at < created_at or closed_at < resolved_at",
            "{support_tickets}",
        ),
        ("Q011", "account_health_history", "health_score_range", "health_score not between 0 and 100", "{account_health_history}"),
        ("Q012", "nps_responses", "nps_score_range", "nps_score not between 0 and 10", "{nps_responses}"),
        (
            "Q013",
            "mrr_movements",
            "mrr_bridge_reconciliation",
            "abs(closing_mrr - opening_mrr - coalesce(new_mrr, 0) - coalesce(expansion_mrr, 0) - coalesce(contraction_mrr, 0)"
            " - coalesce(churned_mrr, 0) - coalesce(reactivation_mrr, 0)) > 0.02",
            "{mart:bridge}",
        ),
        (
            "Q014",
            "experiment_assignments",
            "one_assignment_per_account_experiment",
            "times > 1",
            "(select count(*) as times from {experiment_assignments} group by experiment_id, account_id) d",
        ),
        ("Q015", "contracts", "contract_date_order", "end_date < start_date or signed_date > start_date", "{contracts}"),
        ("Q016", "renewals", "renewal_decision_before_due", "decision_date > renewal_due_date", "{renewals}"),
        (
            "Q017",
            "accounts",
            "country_mapping_complete",
            "c.country_code is null",
            "{accounts} a left join {countries} c on c.country_code = a.country_code",
        ),
        ("Q018", "subscription_events", "churn_event_negative_mrr", "event_type = 'subscription_churned' and mrr_change_eur >= 0", "{subscription_events}"),
        ("Q019", "subscriptions", "churn_status_consistent", "(current_status = 'churned') <> (ended_date is not null)", "{subscriptions}"),
        ("Q020", "invoices", "paid_invoice_has_paid_date", "invoice_status = 'paid' and paid_date is null", "{invoices}"),
        (
            "Q021",
            "countries",
            "region_mapping_complete",
            "r.region_id is null",
            "{countries} c left join {regions} r on r.region_id = c.region_id",
        ),
        ("Q022", "countries", "vat_rate_range", "vat_rate not between 0 and 0.30", "{countries}"),
        ("Q023", "fx_rates", "positive_eur_rate", "eur_rate <= 0", "{fx_rates}"),
        (
            "Q024",
            "plan_prices",
            "price_and_effective_date_validity",
            "effective_end < effective_start or least(base_price, seat_price, annual_discount_pct) < 0 or annual_discount_pct >= 1",
            "{plan_prices}",
        ),
        (
            "Q025",
            "accounts",
            "account_region_matches_country",
            "a.region_id <> c.region_id",
            "{accounts} a join {countries} c on c.country_code = a.country_code",
        ),
        ("Q026", "accounts", "partner_led_accounts_have_partner", "sales_motion = 'partner_led' and partner_id is null", "{accounts}"),
        ("Q027", "leads", "lead_lifecycle_order", "mql_at < created_at or sql_at < coalesce(mql_at, created_at)", "{leads}"),
        ("Q028", "leads", "lead_score_range", "lead_score not between 0 and 100", "{leads}"),
        ("Q029", "opportunities", "opportunity_date_order", "close_date < created_at", "{opportunities}"),
        ("Q030", "opportunities", "opportunity_probability_range", "probability not between 0 and 1", "{opportunities}"),
        ("Q031", "opportunity_stage_history", "stage_history_date_order", "exited_at < entered_at", "{opportunity_stage_history}"),
        (
            "Q032",
            "users",
            "user_lifecycle_order",
            "invited_at < created_at or activated_at < invited_at or deactivated_at < activated_at",
            "{users}",
        ),
        (
            "Q033",
            "subscriptions",
            "trial_and_subscription_date_order",
            "trial_end_date < trial_start_date or subscription_start_date < trial_start_date",
            "{subscriptions}",
        ),
        (
            "Q034",
            "subscription_items",
            "item_type_reference_exclusive",
            "item_type = 'plan' and (plan_id is null or add_on_id is not null)"
            " or item_type = 'add_on' and (add_on_id is null or plan_id is not null)",
            "{subscription_items}",
        ),
        ("Q035", "subscription_items", "positive_item_quantity", "quantity <= 0", "{subscription_items}"),
        ("Q036", "renewals", "renewal_probability_range", "renewal_probability not between 0 and 1", "{renewals}"),
        ("Q037", "invoices", "invoice_date_order", "due_date < invoice_date or service_period_end < service_period_start", "{invoices}"),
        ("Q038", "invoices", "invoice_amounts_non_negative", "least(subtotal_local, tax_local, total_local, total_eur) < 0", "{invoices}"),
        ("Q039", "invoice_lines", "invoice_line_arithmetic", "abs(quantity * unit_price_local - discount_local - line_total_local) > 0.02", "{invoice_lines}"),
        ("Q040", "payments", "captured_payment_amounts_positive", "least(amount_local, amount_eur) <= 0", "{payments}"),
        ("Q041", "refunds", "refund_date_and_amount_validity", "processed_at < requested_at or least(amount_local, amount_eur) <= 0", "{refunds}"),
        (
            "Q042",
            "refunds",
            "refund_does_not_exceed_payment",
            "r.amount_local > p.amount_local + 0.02",
            "{refunds} r join {payments} p on p.payment_id = r.payment_id",
        ),
        (
            "Q043",
            "credit_notes",
            "credit_note_does_not_exceed_invoice",
            "c.amount_local <= 0 or c.amount_local > i.total_local + 0.02",
            "{credit_notes} c join {invoices} i on i.invoice_id = c.invoice_id",
        ),
        (
            "Q044",
            "dunning_events",
            "dunning_not_before_invoice",
            "cast(d.event_at as date) < i.invoice_date",
            "{dunning_events} d join {invoices} i on i.invoice_id = d.invoice_id",
        ),
        (
            "Q045",
            "product_events",
            "event_account_matches_user",
            "e.account_id <> u.account_id",
            "{product_events} e join {users} u on u.user_id = e.user_id",
        ),
        ("Q046", "integrations", "integration_date_order", "disconnected_at < connected_at", "{integrations}"),
        ("Q047", "work_orders", "scheduled_and_completed_date_order", "scheduled_at < created_at or completed_at < scheduled_at", "{work_orders}"),
        ("Q048", "onboarding_tasks", "completed_task_has_completion_date", "task_status = 'completed' and completed_at is null", "{onboarding_tasks}"),
        (
            "Q049",
            "customer_success_interactions",
            "health_score_components_range",
            "health_score_before not between 0 and 100 or health_score_after not between 0 and 100",
            "{customer_success_interactions}",
        ),
        ("Q050", "support_tickets", "csat_score_range", "csat_score not between 1 and 5", "{support_tickets}"),
    ]
    return " union all ".join(
        f"select '{k}' as control_id, '{table}' as table_name, '{name}' as control_name, {n(bad)} as failure_count,"
        f" '{'warning' if k == 'Q016' else 'error'}' as severity from {source}"
        for k, table, name, bad, source in rows
    )


query(
    "control_results",
    "string: control_id table_name control_name; bigint: failure_count; string: severity",
    quality.control_results,
    _control_sql(),
)
query(
    "quality_summary",
    "bigint: controls passed_controls failed_controls total_failures; string: quality_status",
    quality.quality_summary,
    f"""select count(*) as controls, {n('failure_count = 0')} as passed_controls, {n('failure_count > 0')} as failed_controls,
               sum(failure_count) as total_failures,
               case when count(*) filter (where failure_count > 0 and severity = 'error') > 0 then 'FAIL' else 'PASS' end as quality_status
        from ({_control_sql()}) q""",
)
query(
    "mrr_bridge_reconciliation",
    f"date: month_start; double: {_BRIDGE} reconciliation_difference",
    revenue.bridge_reconciliation,
    """select month_start, opening_mrr, coalesce(new_mrr, 0) as new_mrr, coalesce(expansion_mrr, 0) as expansion_mrr,
              coalesce(contraction_mrr, 0) as contraction_mrr, coalesce(churned_mrr, 0) as churned_mrr,
              coalesce(reactivation_mrr, 0) as reactivation_mrr, closing_mrr,
              closing_mrr - opening_mrr - coalesce(new_mrr, 0) - coalesce(expansion_mrr, 0) - coalesce(contraction_mrr, 0)
                - coalesce(churned_mrr, 0) - coalesce(reactivation_mrr, 0) as reconciliation_difference
       from {mart:bridge}""",
)
_RECONCILED = "bigint: invoice_id; double: total_eur captured_eur refunded_eur unpaid_difference_eur; string: invoice_status"
query(
    "invoice_payment_reconciliation",
    _RECONCILED,
    billing.invoice_payment_reconciliation,
    """select i.invoice_id, i.total_eur, coalesce(p.captured, 0) as captured_eur, coalesce(r.refunded, 0) as refunded_eur,
              i.total_eur - coalesce(p.captured, 0) as unpaid_difference_eur, i.invoice_status
       from {invoices} i
       left join (select invoice_id, sum(amount_eur) as captured from {payments} group by 1) p using (invoice_id)
       left join (select p.invoice_id, sum(f.amount_eur) as refunded from {payments} p join {refunds} f using (payment_id)
                  group by 1) r using (invoice_id)""",
)
query(
    "invoice_payment_reconciliation_fanout",
    _RECONCILED,
    lambda t: billing.invoice_payment_reconciliation(t, multiplied=True),
    """select i.invoice_id, i.total_eur, coalesce(sum(p.amount_eur), 0) as captured_eur,
              coalesce(sum(f.amount_eur), 0) as refunded_eur, i.total_eur - coalesce(sum(p.amount_eur), 0) as unpaid_difference_eur,
              i.invoice_status
       from {invoices} i left join {payments} p on p.invoice_id = i.invoice_id
       left join {refunds} f on f.payment_id = p.payment_id group by i.invoice_id, i.total_eur, i.invoice_status""",
)
query(
    "subscription_item_overlap",
    "string: left_item_id right_item_id; bigint: subscription_id; string: item_type; date: left_start left_end right_start"
    " right_end",
    quality.subscription_item_overlap,
    """select a.subscription_item_id as left_item_id, b.subscription_item_id as right_item_id, a.subscription_id, a.item_type,
              a.effective_start as left_start, a.effective_end as left_end, b.effective_start as right_start,
              b.effective_end as right_end
       from {subscription_items} a join {subscription_items} b
         on b.subscription_id = a.subscription_id and b.item_type = a.item_type
        and coalesce(b.plan_id, b.add_on_id) = coalesce(a.plan_id, a.add_on_id)
        and a.subscription_item_id < b.subscription_item_id
        and a.effective_start <= b.effective_end and b.effective_start <= a.effective_end""",
)

# --- derivations -----------------------------------------------------------------------------

query(
    "price_as_of",
    "string: subscription_item_id plan_id country_code billing_frequency; date: effective_start; string: plan_price_id;"
    " double: base_price seat_price annual_discount_pct",
    derive.price_as_of,
    "select * from {mart:plan_item}",
)
_GROSS = (
    "(cast(i.base_price as decimal(12,4)) + cast(greatest(0, i.quantity - p.included_seats) as int)"
    " * cast(i.seat_price as decimal(12,4))) * (1 - cast(i.annual_discount_pct as decimal(9,4)))"
)
query(
    "plan_mrr",
    "string: subscription_item_id plan_id; bigint: seats; string: plan_price_id; double: gross_mrr plan_mrr",
    derive.plan_mrr,
    f"""select i.subscription_item_id, i.plan_id, i.quantity as seats, i.plan_price_id,
               cast({_GROSS} as decimal(24,6)) as gross_mrr,
               cast(cast({_GROSS} as decimal(24,6)) * (1 - greatest(0, cast(c.discount_pct as decimal(9,4))
                    - cast(i.annual_discount_pct as decimal(9,4)))) as decimal(24,6)) as plan_mrr
        from {{mart:plan_item}} i join {{plans}} p using (plan_id) join {{contracts}} c using (contract_id)""",
)
_RATE = "case when i.currency_code = 'EUR' then 1 else f.eur_rate end"
query(
    "fx_convert",
    "bigint: invoice_id; date: invoice_date; string: currency_code; double: total_local eur_rate converted_eur",
    derive.fx_convert,
    f"""select i.invoice_id, i.invoice_date, i.currency_code, i.total_local, {_RATE} as eur_rate,
               cast(cast(i.total_local as decimal(20,4)) * cast({_RATE} as decimal(12,6)) as decimal(24,6)) as converted_eur
        from {{invoices}} i left join {{fx_rates}} f on f.currency_code = i.currency_code
         and f.rate_date = date_trunc('month', i.invoice_date)""",
)
query(
    "compress_to_effective_dates",
    "bigint: subscription_id; string: plan_id; bigint: paid_seats; date: effective_start effective_end; double: mrr_eur",
    derive.compress_to_effective_dates,
    """with flagged as (
           select *, case when lag(month_start) over w = cast(month_start - interval 1 month as date)
                           and lag(plan_id) over w is not distinct from plan_id
                           and lag(paid_seats) over w is not distinct from paid_seats then 0 else 1 end as starts
           from {mart:sub_month} window w as (partition by subscription_id order by month_start)),
       runs as (select *, sum(starts) over (partition by subscription_id order by month_start) as run from flagged)
       select subscription_id, plan_id, paid_seats, min(month_start) as effective_start,
              last_day(max(month_start)) as effective_end, arg_min(mrr_eur, month_start) as mrr_eur
       from runs group by subscription_id, run, plan_id, paid_seats""",
)
_MONTHS = "date_diff('month', date_trunc('month', s.subscription_start_date), m.month_start)"
query(
    "invoice_run",
    "bigint: subscription_id account_id; date: service_period_start service_period_end invoice_date due_date;"
    " string: currency_code; double: subtotal_local tax_local total_local total_eur; string: invoice_status",
    lambda t: derive.invoice_run(t, _day(AS_OF)),
    f"""with billed as (
            select m.subscription_id, m.account_id, m.month_start as service_period_start,
                   case when s.billing_frequency = 'annual'
                        then least(cast(m.month_start + interval 1 year - interval 1 day as date), coalesce(s.ended_date, date '{AS_OF}'))
                        else least(last_day(m.month_start), coalesce(s.ended_date, last_day(m.month_start))) end as service_period_end,
                   greatest(s.subscription_start_date, m.month_start) as invoice_date,
                   case when k.method_type = 'bank_transfer' then 30 else 3 end as due_days, c.currency_code,
                   cast(case when s.billing_frequency = 'annual' then m.mrr_local * 12 else m.mrr_local end as decimal(20,4)) as subtotal,
                   cast(c.vat_rate as decimal(6,4)) as vat
            from {{mart:sub_month}} m join {{subscriptions}} s on s.subscription_id = m.subscription_id
            join {{accounts}} a on a.account_id = m.account_id join {{countries}} c on c.country_code = a.country_code
            left join {{payment_methods}} k on k.account_id = m.account_id
            where s.billing_frequency <> 'annual' or (({_MONTHS}) % 12 + 12) % 12 = 0),
        taxed as (
            select *, invoice_date + due_days as due_date, cast(subtotal * vat as decimal(24,8)) as tax,
                   cast(subtotal + subtotal * vat as decimal(24,8)) as total from billed)
        select subscription_id, account_id, service_period_start, service_period_end, invoice_date, due_date, i.currency_code,
               round(subtotal, 2) as subtotal_local, round(tax, 2) as tax_local, round(total, 2) as total_local,
               round(cast(total * cast({_RATE} as decimal(12,6)) as decimal(34,12)), 2) as total_eur,
               case when due_date <= date '{AS_OF}' then 'overdue' else 'open' end as invoice_status
        from taxed i left join {{fx_rates}} f on f.currency_code = i.currency_code
         and f.rate_date = date_trunc('month', i.invoice_date)""",
)
query(
    "invoice_status",
    "bigint: invoice_id; string: invoice_status",
    lambda t: derive.derived_invoice_status(t, _day(AS_OF)),
    f"""select invoice_id, case when exists (select 1 from {{payment_attempts}} p where p.invoice_id = i.invoice_id
                                             and p.attempt_status = 'succeeded') then 'paid'
                                when due_date <= date '{AS_OF}' then 'overdue' else 'open' end as invoice_status
        from {{invoices}} i""",
)
query(
    "dunning_from_attempts",
    "bigint: dunning_event_id invoice_id; timestamp: event_at; bigint: dunning_step; boolean: recovered_after_event_flag",
    derive.dunning_from_attempts,
    """select payment_attempt_id as dunning_event_id, invoice_id, attempt_at + interval 4 hour as event_at,
              attempt_number as dunning_step, coalesce(following = 'succeeded', false) as recovered_after_event_flag
       from (select *, lead(attempt_status) over (partition by invoice_id order by attempt_number) as following
             from {payment_attempts}) a where attempt_status = 'failed'""",
)
query(
    "captured_payments",
    "bigint: payment_id invoice_id payment_attempt_id; timestamp: captured_at; double: amount_local; string: currency_code;"
    " date: settlement_date",
    derive.captured_payments,
    """select payment_attempt_id as payment_id, invoice_id, payment_attempt_id, attempt_at as captured_at, amount_local,
              currency_code, cast(attempt_at as date) + 2 as settlement_date
       from (select *, row_number() over (partition by invoice_id order by attempt_number) as place
             from {payment_attempts} where attempt_status = 'succeeded') a where place = 1""",
)
query(
    "renewal_schedule",
    "bigint: subscription_id; date: renewal_due_date; double: mrr_eur renewal_arr_eur; string: renewal_status",
    lambda t: derive.renewal_schedule(t, _day(AS_OF)),
    f"""with due as (
            select subscription_id, cast(unnest(generate_series(cast(subscription_start_date + interval 1 year as date),
                   least(date '{AS_OF}', coalesce(ended_date, date '{AS_OF}')), interval 1 year)) as date) as renewal_due_date
            from {{subscriptions}} where billing_frequency = 'annual'),
        priced as (
            select d.*, coalesce((select m.mrr_eur from {{mart:sub_month}} m where m.subscription_id = d.subscription_id
                                  and m.month_start <= date_trunc('month', d.renewal_due_date) order by m.month_start desc limit 1),
                                 (select m.mrr_eur from {{mart:sub_month}} m where m.subscription_id = d.subscription_id
                                  order by m.month_start limit 1)) as mrr_eur from due d)
        select subscription_id, renewal_due_date, mrr_eur, round(mrr_eur * 12, 2) as renewal_arr_eur, 'renewed' as renewal_status
        from priced""",
)
query(
    "usage_summary_monthly",
    "bigint: account_id; date: month_start; bigint: active_users seats; double: seat_utilisation; bigint: sessions"
    " work_orders completed_work_orders automation_runs feature_breadth",
    derive.usage_summary_monthly,
    "select * from {mart:usage_summary}",
)
query(
    "account_health_score",
    "bigint: account_id; date: health_month; double: health_score; string: health_segment; double: usage_score support_score"
    " payment_score relationship_score; boolean: renewal_risk_flag",
    derive.account_health_score,
    f"""with outcomes as (
            select i.account_id, {month('i.invoice_date')} as month_start, {n("i.invoice_status <> 'paid'")} as overdue,
                   {n('k.first_failed')} as failed, {n('k.first_failed and k.later_success')} as recovered
            from {{invoices}} i left join (
                select invoice_id, bool_or(attempt_number = 1 and attempt_status <> 'succeeded') as first_failed,
                       bool_or(attempt_number > 1 and attempt_status = 'succeeded') as later_success
                from {{payment_attempts}} group by 1) k using (invoice_id) group by 1, 2),
        parts as (
            select u.account_id, u.month_start, u.seat_utilisation::decimal(14,4) as util, u.feature_breadth, u.automation_runs,
                   coalesce(s.tickets, 0) as tickets, coalesce(s.escalated_tickets, 0) as escalated,
                   coalesce(s.avg_csat, 0)::decimal(14,4) as csat, coalesce(o.overdue, 0) as overdue,
                   coalesce(o.failed, 0) as failed, coalesce(o.recovered, 0) as recovered, a.sales_motion
            from {{mart:usage_summary}} u left join {{mart:support}} s using (account_id, month_start)
            left join outcomes o using (account_id, month_start) join {{accounts}} a using (account_id)),
        clamped as (
            select account_id, month_start,
                   greatest(0, least(100, 10 + 50 * util + 3 * feature_breadth + least(automation_runs * 0.25, 5)))::decimal(14,4) as u,
                   greatest(0, least(100, 92 - 10 * tickets - 20 * escalated + 4 * greatest(0, csat - 3)))::decimal(14,4) as s,
                   greatest(0, least(100, 95 - 48 * overdue - 14 * failed + 8 * recovered))::decimal(14,4) as p,
                   case when sales_motion <> 'self_service' then 59 else 48 end::decimal(14,4) as r from parts),
        scored as (select *, 0.5 * u + 0.15 * s + 0.2 * p + 0.15 * r as score from clamped),
        banded as (select *, case when score >= 75 then 'healthy' when score >= 62 then 'watch' when score >= 45 then 'at_risk'
                              else 'critical' end as health_segment from scored)
        select account_id, month_start as health_month, round(score, 2) as health_score, health_segment,
               round(u, 2) as usage_score, round(s, 2) as support_score, round(p, 2) as payment_score,
               round(r, 2) as relationship_score, health_segment in ('at_risk', 'critical') as renewal_risk_flag from banded""",
)
_ELIGIBILITY = {"exp_1": "sales_motion = 'self_service'", "exp_2": "segment in ('BUILDING', 'MACHINERY')"}
query(
    "experiment_assign",
    "string: experiment_id; bigint: account_id; string: variant stratum",
    lambda t: derive.experiment_assign(t, _ELIGIBILITY),
    """with eligible as (
           select e.experiment_id, a.account_id, a.country_code, a.segment,
                  row_number() over (partition by e.experiment_id
                      order by md5(concat_ws('|', e.experiment_id, cast(a.account_id as varchar))), a.account_id) as place,
                  count(*) over (partition by e.experiment_id) as accounts
           from {accounts} a join {experiments} e on cast(a.created_at as date) <= e.end_date
           where (e.experiment_id <> 'exp_1' or a.sales_motion = 'self_service')
             and (e.experiment_id <> 'exp_2' or a.segment in ('BUILDING', 'MACHINERY')))
       select experiment_id, account_id, case when place % 2 = 1 then 'control' else 'treatment' end as variant,
              concat_ws('|', country_code, segment) as stratum
       from eligible where place <= least(accounts, greatest(80, floor(accounts * 0.35)))""",
)

# --- dashboard measures ----------------------------------------------------------------------

_KEPT = "opening_mrr + coalesce(contraction_mrr, 0) + coalesce(churned_mrr, 0)"
query(
    "measures_revenue",
    "date: month_start; double: closing_mrr arr opening_mrr new_mrr expansion_mrr contraction_mrr churned_mrr"
    " reactivation_mrr nrr grr; bigint: active_accounts; double: arpa",
    kpis.measures_revenue,
    f"""select b.*, closing_arr as arr, {ratio(_KEPT + ' + coalesce(expansion_mrr, 0)', 'opening_mrr')} as nrr,
               {ratio(_KEPT, 'opening_mrr')} as grr, m.active_accounts, {ratio('closing_mrr', 'm.active_accounts')} as arpa
        from {{mart:bridge}} b join (select month_start, count(distinct account_id) as active_accounts
                                     from {{mart:account_mrr}} group by 1) m using (month_start)""",
)
query(
    "measures_billing",
    "date: month_start; double: invoiced_revenue_eur; bigint: paid_invoices invoices; double: paid_invoice_rate;"
    " bigint: failed_invoices recovered_invoices; double: payment_recovery_rate",
    kpis.measures_billing,
    f"""select {month('i.invoice_date')} as month_start, sum(i.total_eur) as invoiced_revenue_eur,
               {n("i.invoice_status = 'paid'")} as paid_invoices, count(*) as invoices,
               {ratio(n("i.invoice_status = 'paid'"), 'count(*)')} as paid_invoice_rate,
               {n("f.attempt_status = 'failed'")} as failed_invoices,
               {n("f.attempt_status = 'failed' and w.won")} as recovered_invoices,
               {ratio(n("f.attempt_status = 'failed' and w.won"), n("f.attempt_status = 'failed'"))} as payment_recovery_rate
        from {{invoices}} i left join {{payment_attempts}} f on f.invoice_id = i.invoice_id and f.attempt_number = 1
        left join (select invoice_id, bool_or(attempt_status = 'succeeded') as won from {{payment_attempts}} group by 1) w
          on w.invoice_id = i.invoice_id group by 1""",
)
query(
    "measures_product",
    "date: month_start; bigint: active_users paid_seats; double: seat_utilisation automation_adoption api_adoption"
    " average_health_score at_risk_mrr_eur",
    kpis.measures_product,
    f"""select month_start, sum(active_users) as active_users, sum(paid_seats) as paid_seats,
               {ratio('sum(active_users)', 'sum(paid_seats)')} as seat_utilisation,
               {ratio(n('active_users > 0 and automation_runs > 0'), n('active_users > 0'))} as automation_adoption,
               {ratio(n('active_users > 0 and api_calls > 0'), n('active_users > 0'))} as api_adoption,
               {avg('health_score')} as average_health_score,
               sum(case when health_segment in ('critical', 'at_risk') then mrr_eur end) as at_risk_mrr_eur
        from {{mart:account_month}} group by 1""",
)
query(
    "measures_sales",
    "string: region_id; bigint: won_opportunities qualified_opportunities; double: win_rate; bigint: renewed_accounts"
    " renewal_accounts; double: renewal_rate",
    kpis.measures_sales,
    f"""select o.*, r.renewed_accounts, r.renewal_accounts, {ratio('r.renewed_accounts', 'r.renewal_accounts')} as renewal_rate
        from (select a.region_id, {n("o.status = 'won'")} as won_opportunities, count(*) as qualified_opportunities,
                     {ratio(n("o.status = 'won'"), 'count(*)')} as win_rate
              from {{opportunities}} o join {{accounts}} a using (account_id) group by 1) o
        full join (select a.region_id, count(distinct case when n.renewal_status = 'renewed' then a.account_id end) as renewed_accounts,
                          count(distinct a.account_id) as renewal_accounts
                   from {{renewals}} n join {{subscriptions}} s using (subscription_id) join {{accounts}} a using (account_id)
                   group by 1) r using (region_id)""",
)

# --- governed rates --------------------------------------------------------------------------

query(
    "trial_to_paid",
    "date: cohort_month; bigint: eligible_accounts paid_after_trial; double: trial_to_paid_rate",
    governed.trial_to_paid,
    f"""select {month('created_at')} as cohort_month, count(*) as eligible_accounts, {n('tried')} as paid_after_trial,
               {ratio(n('tried'), 'count(*)')} as trial_to_paid_rate
        from (select *, account_id in (select account_id from {{subscriptions}} where trial_start_date is not null) as tried
              from {{accounts}}) a
        where sales_motion = 'self_service' or tried group by 1""",
)
query(
    "closed_win_rate",
    "date: month_start; string: region_id segment; bigint: closed won; double: closed_win_rate",
    governed.closed_win_rate,
    f"""select {month('close_date')} as month_start, region_id, segment, count(*) as closed, {n("status = 'won'")} as won,
               {ratio(n("status = 'won'"), 'count(*)')} as closed_win_rate
        from {{opportunities}} join {{accounts}} using (account_id) where status in ('won', 'lost') group by 1, 2, 3""",
)
query(
    "renewal_rate",
    "date: renewal_month; bigint: decided renewed; double: renewal_rate",
    governed.renewal_rate,
    f"""select {month('renewal_due_date')} as renewal_month, count(*) as decided, {n("renewal_status = 'renewed'")} as renewed,
               {ratio(n("renewal_status = 'renewed'"), 'count(*)')} as renewal_rate
        from {{renewals}} where decision_date is not null
          and subscription_id in (select subscription_id from {{subscriptions}} where billing_frequency = 'annual') group by 1""",
)
_SCORED = """(select * replace (case when nps_score >= 9 then 'promoter' when nps_score >= 7 then 'passive'
                                when nps_score is not null then 'detractor' end as nps_group) from {nps_responses})"""
query(
    "nps_by_score",
    f"{_PLACE}; bigint: responses; double: average_score nps; string: leading_comment_theme",
    governed.nps_by_score,
    QUERIES["nps"].oracle.replace("{nps_responses}", _SCORED),
)
