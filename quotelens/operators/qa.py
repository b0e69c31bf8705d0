"""QA gates (K1-K4): a measures table joined with a thresholds table.

Measures are one-row aggregates already computed elsewhere (metrics per
split, panel summary, quality profile, rolling-anchor summary), unioned to a
long (check, value) table; each check compares its value with its threshold.
Roll-up: overall = every blocking check passes; human review = any advisory
check fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.spec import PanelSpec


def thresholds(spec: PanelSpec) -> list[tuple[str, str, float, bool]]:
    """(check, comparison, threshold, blocking)."""
    return [
        ("data_contract_valid", ">", 0.0, True),
        ("time_based_split", "==", 1.0, True),
        ("validation_d2_threshold", ">=", spec.gate("d2"), True),
        ("validation_rmse_threshold", "<=", spec.gate("rmse"), True),
        ("test_d2_threshold", ">=", spec.gate("d2"), True),
        ("test_rmse_threshold", "<=", spec.gate("rmse"), True),
        ("validation_mape_threshold", "<=", spec.gate("mape"), False),
        ("validation_gini_threshold", ">=", spec.gate("gini"), False),
        ("validation_bias_threshold", "abs<=", spec.gate("bias_pct"), False),
        ("monthly_competitor_coverage", ">=", spec.gate("monthly_coverage"), True),
        ("monthly_target_eligibility", ">=", spec.gate("monthly_eligibility"), True),
        ("incomplete_panel_target_bias", "abs<=", spec.gate("bias_pct"), False),
        ("premium_comparability_fields_complete", "==", 0.0, True),
        ("rolling_origin_historical_anchors", ">", 0.0, True),
        ("model_export_available", ">", 0.0, True),
        ("runtime_budget", "<", 1.0, True),
        ("leakage_review", "==", 0.0, False),
        ("standalone_demand_signal", ">", 0.0, False),
    ]


def _of_split(metrics: DataFrame, split: str, columns: dict[str, str]) -> DataFrame:
    """(check, value) rows from the metrics row of one split."""
    row = metrics.where(F.col("_split") == split).select(*[F.col(c).cast("double").alias(check) for check, c in columns.items()])
    return row.unpivot([], list(columns), "check", "value")


def _one(df: DataFrame, check: str, value) -> DataFrame:
    return df.select(F.lit(check).alias("check"), value.cast("double").alias("value"))


def measures(metrics_by_split: DataFrame, panel_summary: DataFrame, profile: DataFrame, comparability: DataFrame,
             hist_summary: DataFrame, split_dates: DataFrame | None = None, leakage: DataFrame | None = None,
             exported: int | None = None, runtime_seconds: float | None = None, max_runtime_seconds: float | None = None,
             improvement: DataFrame | None = None) -> DataFrame:
    """Long (check, value) table from small summaries; a summary that is not given leaves its check unmeasured.

    ``split_dates``: rows of ``split_metadata``; 1 if each part ends before the next begins.
    ``leakage``: findings, counted. ``exported``: saved models. The runtime counts whole budgets used."""
    spark = metrics_by_split.sparkSession
    parts = [
        _of_split(metrics_by_split, "validation", {
            "validation_d2_threshold": "d2", "validation_rmse_threshold": "rmse", "validation_mape_threshold": "mape",
            "validation_gini_threshold": "gini", "validation_bias_threshold": "mean_bias_pct"}),
        _of_split(metrics_by_split, "test", {"test_d2_threshold": "d2", "test_rmse_threshold": "rmse"}),
        _one(profile, "data_contract_valid", F.col("rows_eligible_for_target")),
        _one(panel_summary, "monthly_competitor_coverage", F.col("minimum_monthly_competitor_coverage")),
        _one(panel_summary, "monthly_target_eligibility", F.col("minimum_monthly_target_eligibility")),
        _one(panel_summary, "incomplete_panel_target_bias", F.col("incomplete_vs_complete_target_bias_pct")),
        _one(comparability.agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("m")), "premium_comparability_fields_complete", F.col("m")),
        _one(hist_summary, "rolling_origin_historical_anchors", F.col("rows_scored")),
    ]
    if split_dates is not None:
        edge = lambda part, column: F.max(F.when(F.col("_split") == part, F.col(column)))
        ordered = (edge("train", "date_max") <= edge("validation", "date_min")) & (edge("validation", "date_max") <= edge("test", "date_min"))
        parts.append(_one(split_dates.agg(F.coalesce(ordered, F.lit(False)).cast("int").alias("m")), "time_based_split", F.col("m")))
    if leakage is not None:
        parts.append(_one(leakage.agg(F.count("*").alias("m")), "leakage_review", F.col("m")))
    if improvement is not None:
        parts.append(_one(improvement, "standalone_demand_signal", F.col("passes_incremental_signal_check").cast("int")))
    scalars = [("model_export_available", float(exported))] if exported is not None else []
    if runtime_seconds is not None and max_runtime_seconds:
        scalars.append(("runtime_budget", float(runtime_seconds // max_runtime_seconds)))
    parts.append(spark.createDataFrame(scalars, "check string, value double"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def checklist(measured: DataFrame, spec: PanelSpec) -> DataFrame:
    """check, value, threshold, blocking, passed for every gate; one without a value fails."""
    spark = measured.sparkSession
    th = spark.createDataFrame(thresholds(spec), "check string, op string, threshold double, blocking boolean")
    j = th.join(measured, "check", "left")
    v, t, op = F.col("value"), F.col("threshold"), F.col("op")
    passed = (F.when(op == ">", v > t).when(op == ">=", v >= t).when(op == "<=", v <= t).when(op == "<", v < t)
              .when(op == "abs<=", F.abs(v) <= t).when(op == "==", v == t))
    return j.select("check", "value", "threshold", "blocking", F.coalesce(passed, F.lit(False)).alias("passed"))


def rollup(checks: DataFrame) -> DataFrame:
    """overall_passed (all blocking pass), human_review_required (any advisory fails)."""
    return checks.agg(
        F.coalesce(F.bool_and(F.when(F.col("blocking"), F.col("passed"))), F.lit(True)).alias("overall_passed"),
        F.coalesce(F.bool_or(F.when(~F.col("blocking"), ~F.col("passed"))), F.lit(False))
        .alias("human_review_required"),
        F.count("*").alias("checks"))
