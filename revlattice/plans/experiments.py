"""Experiment views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.functions.measures import count, divide, rate, summarise, total
from revlattice.functions.normal import two_sided_p
from revlattice.plans.marts import assignment_results, experiment_analysis, summarise_experiments, weighted_mean

Z_95 = 1.96
SIGNIFICANCE = 0.05
MDE_MARGIN = 0.25


def experiment_assignment_integrity(t) -> DataFrame:
    """Assignments, their share within the experiment, and accounts assigned more than once."""
    per_account = t["experiment_assignments"].groupBy("experiment_id", "variant", "account_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    arms = summarise(
        per_account, ["experiment_id", "variant"], [total("assignments", "n"), count("unique_accounts", of="account_id")]
    )
    experiment = Window.partitionBy("experiment_id")
    names = t["experiments"].select("experiment_id", "experiment_name")
    return arms.join(names, "experiment_id").select(
        "experiment_id",
        "experiment_name",
        "variant",
        "assignments",
        divide(F.col("assignments"), F.sum("assignments").over(experiment)).alias("assignment_share"),
        "unique_accounts",
        (F.col("assignments") - F.col("unique_accounts")).alias("duplicate_assignments"),
    )


def experiment_exposure(t) -> DataFrame:
    seen = F.col("exposure_rows").isNotNull()
    return summarise_experiments(
        assignment_results(t),
        t["experiments"].select("experiment_id", "experiment_name"),
        [
            count("assigned"),
            count("exposed", seen),
            rate("exposure_rate", count("seen", seen), count("all")),
            rate("average_exposures", total("sum", "exposure_sum"), total("n", "exposure_values")),
        ],
    )


def experiment_outcomes(t) -> DataFrame:
    experiment = Window.partitionBy("experiment_id")
    control = F.max(F.when(F.col("variant") == "control", F.col("primary_mean"))).over(experiment)
    return experiment_analysis(t).select(
        "*",
        (F.col("primary_mean") - control).alias("absolute_effect_vs_control"),
        (F.try_divide(F.col("primary_mean"), control) - 1).alias("relative_effect_vs_control"),
    )


def experiment_segment_effects(t) -> DataFrame:
    """Means by stratum over exposed assignments with an outcome."""
    results = assignment_results(t).where("exposure_rows is not null and outcome_rows is not null")
    placed = results.select(
        "*",
        F.split_part("stratum", F.lit("|"), F.lit(1)).alias("country_code"),
        F.split_part("stratum", F.lit("|"), F.lit(2)).alias("segment"),
    )
    weight = F.col("exposure_rows")
    return summarise(
        placed,
        ["experiment_id", "variant", "country_code", "segment"],
        [
            total("observations", F.col("exposure_rows") * F.col("outcome_rows")),
            weighted_mean("primary_mean", "primary_outcome", weight),
            weighted_mean("guardrail_mean", "guardrail_outcome", weight),
            weighted_mean("average_revenue_outcome_eur", "revenue_outcome_eur", weight),
        ],
    )


def experiment_decisions(t) -> DataFrame:
    """Two-sample readout per experiment with a launch decision.

    Observations are exposure rows with an outcome; arms with fewer than two are skipped.
    """
    exposures = t["experiment_exposures"].groupBy("assignment_id").agg(F.count(F.lit(1)).alias("weight"))
    outcomes = t["experiment_outcomes"].select(
        "assignment_id", *(F.col(c).cast("decimal(18,6)").alias(c) for c in ("primary_outcome", "guardrail_outcome", "revenue_outcome_eur"))
    )
    # An outcome counts once per exposure by its weight; long exposure logs multiply no rows.
    observed = (
        t["experiment_assignments"]
        .select("assignment_id", "experiment_id", "variant")
        .join(exposures, "assignment_id")
        .join(outcomes, "assignment_id")
    )

    def mean(name: str, column: str) -> Column:
        of = (F.col("variant") == name) & F.col(column).isNotNull()
        total = F.sum(F.when(of, F.col(column) * F.col("weight").cast("decimal(12,0)")))
        return total.cast("double") / F.sum(F.when(of, F.col("weight")))

    def arm(name: str) -> list:
        of, x, weight = F.col("variant") == name, F.col("primary_outcome"), F.col("weight").cast("decimal(10,0)")
        n = F.sum(F.when(of & x.isNotNull(), F.col("weight")))
        sums, squares = F.sum(F.when(of, x * weight)), F.sum(F.when(of, x * x * weight))
        # Exact sums, so the result does not depend on the order in which tasks end.
        spread = squares.cast("decimal(38,12)").cast("double") - sums.cast("double") * sums.cast("double") / n
        return [
            F.coalesce(n, F.lit(0)).alias(f"{name}_n"),
            mean(name, "primary_outcome").alias(f"{name}_mean"),
            F.when(n > 1, F.greatest(spread, F.lit(0.0)) / (n - 1)).alias(f"{name}_variance"),
            mean(name, "guardrail_outcome").alias(f"guardrail_{name}"),
            mean(name, "revenue_outcome_eur").alias(f"revenue_{name}"),
        ]

    arms = (
        observed.groupBy("experiment_id")
        .agg(*arm("control"), *arm("treatment"))
        .where("control_n >= 2 and treatment_n >= 2")
        .withColumn("absolute_effect", F.col("treatment_mean") - F.col("control_mean"))
        .withColumn(
            "_error",
            F.sqrt(F.col("treatment_variance") / F.col("treatment_n") + F.col("control_variance") / F.col("control_n")),
        )
        .withColumn("ci_lower", F.col("absolute_effect") - Z_95 * F.col("_error"))
        .withColumn("ci_upper", F.col("absolute_effect") + Z_95 * F.col("_error"))
        .withColumn(
            "p_value", F.coalesce(two_sided_p(F.try_divide(F.col("absolute_effect"), F.col("_error"))), F.lit(1.0))
        )
    )
    definitions = t["experiments"].select("experiment_id", "experiment_name", "minimum_detectable_effect")
    effect, significant = F.col("absolute_effect"), F.col("p_value") < SIGNIFICANCE
    margin = -F.col("minimum_detectable_effect").cast("double") * MDE_MARGIN
    decision = (
        F.when(significant & (effect > 0) & (F.col("ci_lower") > margin), "LAUNCH")
        .when(significant & (effect < 0), "DO NOT LAUNCH")
        .otherwise("INCONCLUSIVE")
    )
    return arms.join(definitions, "experiment_id").select(
        "experiment_id",
        "experiment_name",
        "control_n",
        "treatment_n",
        "control_mean",
        "treatment_mean",
        "absolute_effect",
        F.try_divide(effect, F.col("control_mean")).alias("relative_effect"),
        "ci_lower",
        "ci_upper",
        "p_value",
        "guardrail_control",
        "guardrail_treatment",
        (F.col("revenue_treatment") - F.col("revenue_control")).alias("average_revenue_effect_eur"),
        decision.alias("decision"),
    )
