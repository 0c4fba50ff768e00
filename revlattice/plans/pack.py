"""All business views and the whole report pack by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from revlattice.plans import (
    acquisition,
    billing,
    executive,
    experiments,
    product,
    quality,
    reports,
    revenue,
    success,
)


def business_views(as_of: Column) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """View name to plan; receivables are aged at ``as_of``."""
    plans = {
        revenue: "monthly_mrr_bridge mrr_by_geography mrr_by_segment revenue_retention logo_churn add_on_attachment"
        " revenue_concentration",
        acquisition: "sales_funnel opportunity_win_rate sales_cycle partner_performance trial_conversion contract_mix"
        " marketing_efficiency",
        product: "product_adoption seat_utilisation workflow_completion onboarding_completion time_to_first_value"
        " integration_adoption usage_before_churn",
        success: "account_health_distribution renewal_risk renewal_pipeline customer_success_intervention"
        " support_service_levels nps churn_reasons",
        billing: "payment_success payment_recovery dunning_effectiveness overdue_receivables refunds_and_credits"
        " invoice_reconciliation",
        experiments: "experiment_assignment_integrity experiment_exposure experiment_outcomes experiment_segment_effects",
        executive: "executive_monthly_scorecard latest_executive_scorecard regional_operating_review",
    }
    views = {name: getattr(module, name) for module, names in plans.items() for name in names.split()}
    views["overdue_receivables"] = lambda t: billing.overdue_receivables(t, as_of)
    return views


def report_pack(
    t: Mapping[str, DataFrame], landing: Mapping[str, DataFrame], first_month: Column, last_month: Column
) -> dict[str, DataFrame]:
    """The thirteen reports; ``landing`` is the text the contract checks read."""
    return {
        "mrr_snapshot": reports.mrr_snapshot(t),
        "mrr_bridge": reports.mrr_bridge(t, first_month, last_month),
        "account_mrr_movements": reports.account_mrr_movements(t, first_month, last_month),
        "cohort_retention": reports.cohort_retention(t),
        "revenue_retention": reports.revenue_retention(t),
        "sales_funnel": reports.sales_funnel(t),
        "payment_recovery": reports.payment_recovery(t),
        "product_adoption": reports.product_adoption(t),
        "account_health": reports.account_health(t),
        "country_performance": reports.country_performance(t),
        "experiment_decisions": experiments.experiment_decisions(t),
        "unit_economics": reports.unit_economics(t),
        "data_quality_results": quality.validate(landing),
    }


# Governed metric to the query that gives it.
METRICS = {
    **{f"M{i:03d}": "account_mrr_monthly" for i in (1, 2)},
    **{f"M{i:03d}": "monthly_mrr_bridge" for i in range(3, 8)},
    "M008": "revenue_retention",
    "M009": "revenue_retention",
    "M010": "logo_churn",
    "M011": "mrr_by_geography",
    "M012": "mrr_by_segment",
    "M013": "add_on_attachment",
    "M014": "trial_to_paid",
    "M015": "closed_win_rate",
    "M016": "sales_cycle",
    "M017": "marketing_efficiency",
    "M018": "seat_utilisation",
    "M019": "account_month",
    "M020": "account_usage_monthly",
    "M021": "product_adoption",
    "M022": "product_adoption",
    "M023": "workflow_completion",
    "M024": "time_to_first_value",
    "M025": "onboarding_completion",
    "M026": "account_health_score",
    "M027": "renewal_risk",
    "M028": "renewal_rate",
    **{f"M{i:03d}": "support_service_levels" for i in range(29, 33)},
    "M033": "nps",
    "M034": "payment_success",
    "M035": "payment_recovery",
    "M036": "payment_recovery",
    "M037": "overdue_receivables",
    "M038": "refunds_and_credits",
    "M039": "experiment_decisions",
    "M040": "mrr_by_geography",
}


def business_cases() -> dict[str, str]:
    """Case id to view, in catalogue order."""
    return {f"BC{i:03d}": name for i, name in enumerate(business_views(None), start=1)}


