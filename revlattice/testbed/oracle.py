"""Composes oracle statements from bound tables, landed text and shared marts.

``{name}`` in a statement is a bound table, ``{text:name}`` its landed text,
``{wide:name}`` that text with a mark on rows of the wrong width, and ``{mart:name}``
a mart below.  A statement gets the common table expressions it
needs, each once, and its columns are cast to the query's output contract.
"""

from __future__ import annotations

import re

from revlattice.testbed.bind import BASE_TABLES, BINDINGS, duckdb_text
from revlattice.testbed.landing import landing_text


def avg(value: str, when: str | None = None) -> str:
    """Exact sum over count, as a double."""
    only = f" filter (where {when})" if when else ""
    return f"(cast(sum({value}){only} as double) / nullif(count({value}){only}, 0))"


def ratio(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def n(when: str) -> str:
    return f"count(*) filter (where {when})"


def month(column: str) -> str:
    return f"cast(date_trunc('month', {column}) as date)"


def hours(value: str) -> str:
    return f"({avg(value)} / 3600000000.0)"


MARTS: dict[str, str] = {
    "item_month": f"""
        select cast(unnest(generate_series({month('i.effective_start')}, {month('i.effective_end')}, interval 1 month)) as date) as month_start,
               i.*, s.account_id, p.plan_name, x.add_on_name
        from {{subscription_items}} i join {{subscriptions}} s using (subscription_id)
        left join {{plans}} p on p.plan_id = i.plan_id left join {{add_ons}} x on x.add_on_id = i.add_on_id""",
    "sub_month": """
        select month_start, subscription_id, account_id,
               max(plan_id) filter (where item_type = 'plan') as plan_id,
               max(plan_name) filter (where item_type = 'plan') as plan_name,
               max(quantity) filter (where item_type = 'plan') as paid_seats,
               count(*) filter (where item_type = 'add_on') as active_add_ons,
               sum(mrr_local) as mrr_local, sum(mrr_eur) as mrr_eur
        from {mart:item_month} group by all""",
    "account_mrr": """
        select month_start, account_id, sum(mrr_eur) as mrr_eur, sum(mrr_local) as mrr_local,
               max(paid_seats) as paid_seats, sum(active_add_ons) as active_add_ons, max(plan_name) as primary_plan_name
        from {mart:sub_month} group by month_start, account_id""",
    "grid": """
        select g.month_start, k.account_id, coalesce(r.mrr_eur, 0) as mrr_eur, coalesce(r.mrr_local, 0) as mrr_local,
               coalesce(r.paid_seats, 0) as paid_seats, coalesce(r.active_add_ons, 0) as active_add_ons, r.primary_plan_name
        from (select cast(unnest(generate_series(min(month_start), max(month_start), interval 1 month)) as date) as month_start
              from {mart:account_mrr}) g
        cross join (select distinct account_id from {mart:account_mrr}) k
        left join {mart:account_mrr} r on r.account_id = k.account_id and r.month_start = g.month_start""",
    "move": """
        select month_start, account_id, before as previous_mrr, mrr_eur, mrr_eur - before as movement_mrr,
               case when before = 0 and mrr_eur > 0 then case when paid_before > 0 then 'reactivation' else 'new' end
                    when before > 0 and mrr_eur = 0 then 'churn'
                    when before > 0 and mrr_eur > before then 'expansion'
                    when mrr_eur > 0 and mrr_eur < before then 'contraction'
                    else 'no_change' end as movement_type
        from (select *, lag(mrr_eur, 1, 0) over w as before,
                     coalesce(count(case when mrr_eur > 0 then 1 end) over (partition by account_id order by month_start
                              rows between unbounded preceding and 1 preceding), 0) as paid_before
              from {mart:grid} window w as (partition by account_id order by month_start)) s""",
    "bridge": """
        select month_start, sum(previous_mrr) as opening_mrr,
               sum(movement_mrr) filter (where movement_type = 'new') as new_mrr,
               sum(movement_mrr) filter (where movement_type = 'expansion') as expansion_mrr,
               sum(movement_mrr) filter (where movement_type = 'contraction') as contraction_mrr,
               sum(movement_mrr) filter (where movement_type = 'churn') as churned_mrr,
               sum(movement_mrr) filter (where movement_type = 'reactivation') as reactivation_mrr,
               sum(mrr_eur) as closing_mrr, 12 * sum(mrr_eur) as closing_arr,
               count(*) filter (where previous_mrr > 0) as opening_accounts,
               count(*) filter (where movement_type = 'churn') as churned_accounts,
               count(*) filter (where movement_type = 'new') as new_accounts,
               count(*) filter (where movement_type = 'reactivation') as reactivated_accounts
        from {mart:move} group by month_start""",
    "retention": f"""
        select *, 1.0 - {ratio('-(coalesce(churned_mrr, 0) + coalesce(contraction_mrr, 0))', 'opening_mrr')} as gross_revenue_retention,
               {ratio('opening_mrr + coalesce(churned_mrr, 0) + coalesce(contraction_mrr, 0) + coalesce(expansion_mrr, 0)', 'opening_mrr')} as net_revenue_retention,
               {ratio('churned_accounts', 'opening_accounts')} as logo_churn_rate
        from {{mart:bridge}}""",
    "usage": f"""
        select {month('activity_date')} as month_start, account_id, max(active_users) as active_users,
               max(active_mobile_users) as active_mobile_users, sum(sessions) as sessions,
               sum(work_orders_created) as work_orders_created, sum(work_orders_completed) as work_orders_completed,
               sum(automation_runs) as automation_runs, sum(api_calls) as api_calls,
               sum(documents_uploaded) as documents_uploaded, max(feature_breadth) as feature_breadth
        from {{account_usage_daily}} group by 1, 2""",
    "support": f"""
        select {month('created_at')} as month_start, account_id, count(*) as tickets, {n('escalated_flag')} as escalated_tickets,
               {hours("date_diff('microsecond', created_at, first_response_at)")} as avg_first_response_hours,
               {hours("date_diff('microsecond', created_at, resolved_at)")} as avg_resolution_hours,
               {avg('csat_score')} as avg_csat, sum(reopened_count) as reopened_count
        from {{support_tickets}} group by 1, 2""",
    "payment": f"""
        select {month('invoice_date')} as month_start, account_id, count(*) as invoices,
               {n("invoice_status = 'paid'")} as paid_invoices,
               {n("invoice_status = 'overdue' or invoice_status = 'open'")} as unpaid_invoices,
               sum(total_eur) as invoiced_eur, sum(case when invoice_status = 'paid' then total_eur end) as paid_eur
        from {{invoices}} group by 1, 2""",
    "account_month": """
        select g.month_start, g.account_id, a.country_code, a.region_id, a.segment, a.sales_motion, a.acquisition_channel,
               g.mrr_eur, g.paid_seats, g.active_add_ons, g.primary_plan_name,
               coalesce(u.active_users, 0) as active_users, coalesce(u.sessions, 0) as sessions,
               coalesce(u.work_orders_created, 0) as work_orders_created,
               coalesce(u.work_orders_completed, 0) as work_orders_completed,
               coalesce(u.automation_runs, 0) as automation_runs, coalesce(u.api_calls, 0) as api_calls,
               coalesce(u.feature_breadth, 0) as feature_breadth, coalesce(s.tickets, 0) as support_tickets,
               coalesce(s.escalated_tickets, 0) as escalated_tickets, coalesce(p.unpaid_invoices, 0) as unpaid_invoices,
               h.health_score, h.health_segment, h.renewal_risk_flag
        from {mart:grid} g join {accounts} a on a.account_id = g.account_id
        left join {mart:usage} u on u.account_id = g.account_id and u.month_start = g.month_start
        left join {mart:support} s on s.account_id = g.account_id and s.month_start = g.month_start
        left join {mart:payment} p on p.account_id = g.account_id and p.month_start = g.month_start
        left join {account_health_history} h on h.account_id = g.account_id and h.health_month = g.month_start""",
    "invoice": """
        select i.*, a.country_code, a.region_id, a.segment, a.sales_motion, s.billing_frequency, s.plan_id
        from {invoices} i join {accounts} a using (account_id)
        join {subscriptions} s on s.subscription_id = i.subscription_id and s.account_id = i.account_id""",
    "invoice_payment": """
        select i.invoice_id, i.account_id, i.subscription_id, i.invoice_date, i.due_date, i.country_code, i.region_id,
               i.segment, i.total_eur, i.invoice_status, count(p.payment_attempt_id) as attempt_count,
               min(p.attempt_at) as first_attempt_at,
               min(case when p.attempt_status = 'succeeded' then p.attempt_at end) as successful_attempt_at,
               bool_or(p.attempt_status = 'failed') as any_failure,
               bool_or(p.attempt_status = 'succeeded') as eventually_succeeded,
               max(p.attempt_number) as maximum_attempt_number
        from {mart:invoice} i left join {payment_attempts} p on p.invoice_id = i.invoice_id group by all""",
    "funnel": """
        select a.account_id, a.country_code, a.region_id, a.segment, a.sales_motion, a.acquisition_channel, l.lead_id,
               l.mql_at is not null as reached_mql, l.sql_at is not null as reached_sql, o.opportunity_id,
               o.status as opportunity_status, o.expected_arr_eur, s.subscription_id, s.subscription_start_date,
               s.subscription_id is not null as became_customer
        from {accounts} a left join {leads} l on l.account_id = a.account_id
        left join {opportunities} o on o.account_id = a.account_id
        left join {subscriptions} s on s.account_id = a.account_id""",
    "experiment_rows": """
        select e.experiment_id, e.experiment_name, a.variant, a.assignment_id, a.account_id, a.stratum,
               x.assignment_id as seen_id, x.exposure_count, o.assignment_id as outcome_id,
               o.primary_outcome, o.guardrail_outcome, o.revenue_outcome_eur
        from {experiments} e join {experiment_assignments} a using (experiment_id)
        left join {experiment_exposures} x on x.assignment_id = a.assignment_id
        left join {experiment_outcomes} o on o.assignment_id = a.assignment_id""",
    "experiment": f"""
        select experiment_id, experiment_name, variant, count(distinct assignment_id) as assigned_accounts,
               count(distinct seen_id) as exposed_accounts, {avg('primary_outcome')} as primary_mean,
               {avg('guardrail_outcome')} as guardrail_mean, {avg('revenue_outcome_eur')} as average_revenue_outcome_eur
        from {{mart:experiment_rows}} group by 1, 2, 3""",
    "plan_item": """
        select i.subscription_item_id, i.subscription_id, i.plan_id, i.quantity, i.effective_start, s.account_id,
               s.contract_id, s.billing_frequency, a.country_code, pp.plan_price_id, pp.base_price, pp.seat_price,
               pp.annual_discount_pct
        from {subscription_items} i join {subscriptions} s using (subscription_id) join {accounts} a using (account_id)
        left join {plan_prices} pp on pp.plan_id = i.plan_id and pp.country_code = a.country_code
             and pp.billing_frequency = s.billing_frequency
             and i.effective_start between pp.effective_start and pp.effective_end
        where i.item_type = 'plan' and i.plan_id is not null""",
    "usage_summary": f"""
        select u.account_id, u.month_start, u.active_users, coalesce(r.paid_seats, 0) as seats,
               round(cast(u.active_users as double) / greatest(coalesce(r.paid_seats, 0), 1), 4) as seat_utilisation,
               u.sessions, u.work_orders_created as work_orders, u.work_orders_completed as completed_work_orders,
               u.automation_runs, coalesce(f.areas, 0) as feature_breadth
        from {{mart:usage}} u left join {{mart:account_mrr}} r using (account_id, month_start)
        left join (select account_id, {month('event_at')} as month_start, count(distinct feature_area) as areas
                   from {{product_events}} group by 1, 2) f using (account_id, month_start)""",
    "report_move": """
        select account_id, month, mrr_eur, previous_mrr,
               max(previous_mrr) over (partition by account_id order by month
                   rows between unbounded preceding and current row) > 0 as ever_active_before
        from (select k.account_id, g.month, coalesce(r.mrr_eur, 0) as mrr_eur,
                     lag(coalesce(r.mrr_eur, 0), 1, 0) over (partition by k.account_id order by g.month) as previous_mrr
              from (select cast(unnest(generate_series(date '1996-01-01', date '2001-12-01', interval 1 month)) as date) as month) g
              cross join (select distinct account_id from {mart:account_mrr}) k
              left join {mart:account_mrr} r on r.account_id = k.account_id and r.month_start = g.month) s""",
    "report_movement": """
        select *, mrr_eur - previous_mrr as movement_mrr,
               case when previous_mrr = 0 and mrr_eur > 0 and not ever_active_before then 'new'
                    when previous_mrr = 0 and mrr_eur > 0 then 'reactivation'
                    when previous_mrr > 0 and mrr_eur = 0 then 'churn'
                    when previous_mrr > 0 and mrr_eur > previous_mrr then 'expansion'
                    when mrr_eur > 0 and mrr_eur < previous_mrr then 'contraction' else 'no_change' end as movement_type
        from {mart:report_move}""",
    "report_bridge": """
        select month, round(sum(previous_mrr), 2) as opening_mrr,
               round(sum(case when movement_type = 'new' then movement_mrr else 0 end), 2) as new_mrr,
               round(sum(case when movement_type = 'expansion' then movement_mrr else 0 end), 2) as expansion_mrr,
               round(sum(case when movement_type = 'contraction' then movement_mrr else 0 end), 2) as contraction_mrr,
               round(sum(case when movement_type = 'churn' then movement_mrr else 0 end), 2) as churned_mrr,
               round(sum(case when movement_type = 'reactivation' then movement_mrr else 0 end), 2) as reactivation_mrr,
               round(sum(mrr_eur), 2) as closing_mrr,
               round(sum(mrr_eur) - sum(previous_mrr) - sum(case when movement_type <> 'no_change' then movement_mrr else 0 end), 6)
                   as bridge_reconciliation
        from {mart:report_movement} group by month""",
    "report_retention": f"""
        select m.month, {ratio('opening - lost', 'opening')} as gross_revenue_retention,
               {ratio('opening - lost + gained', 'opening')} as net_revenue_retention, coalesce(opening, 0) as opening_mrr
        from (select distinct month_start as month from {{mart:account_mrr}}) m
        left join (select cast(p.month_start + interval 1 month as date) as month, sum(p.mrr_eur) as opening,
                          sum(greatest(p.mrr_eur - coalesce(c.mrr_eur, 0), 0)) as lost,
                          sum(greatest(coalesce(c.mrr_eur, 0) - p.mrr_eur, 0)) as gained
                   from {{mart:account_mrr}} p left join {{mart:account_mrr}} c
                     on c.account_id = p.account_id and c.month_start = p.month_start + interval 1 month
                   group by 1) q on q.month = m.month""",
}

_REFERENCE = re.compile(r"\{(?:(text|wide|mart):)?(\w+)\}")


def _definition(kind: str | None, name: str) -> tuple[str, str | None]:
    """Alias of a referenced relation and its text (None for a test table)."""
    if kind == "mart":
        return f"m_{name}", MARTS[name]
    if kind == "text":
        return f"l_{name}", landing_text(name)
    if kind == "wide":
        return f"w_{name}", landing_text(name, wide=True)
    if name in BASE_TABLES:
        return name, None
    return f"a_{name}", duckdb_text(BINDINGS[name])


def compose(statement: str, columns: dict[str, str]) -> str:
    """A single statement with every relation it needs and typed output columns."""
    parts: dict[str, str] = {}

    def resolve(text: str) -> str:
        def replace(match: re.Match) -> str:
            alias, body = _definition(match[1], match[2])
            if body is not None and alias not in parts:
                parts[alias] = resolve(body)
            return alias

        return _REFERENCE.sub(replace, text)

    body = resolve(statement)
    kinds = {"string": "varchar"}
    outputs = ", ".join(f"cast({c} as {kinds.get(kind, kind)}) as {c}" for c, kind in columns.items())
    relations = ",\n".join(f"{alias} as ({text})" for alias, text in parts.items())
    with_clause = f"with {relations}\n" if relations else ""
    return f"{with_clause}select {outputs} from ({body}) result"
