"""The three runs: train, score and monitor, each a composition of operators over a run folder.

``train`` writes every table, model and record of a run and lists them in a manifest; ``score`` and
``monitor`` refuse artifacts that the manifest does not verify. All results are written by Spark jobs;
only scalars and the lists of competitors, months and features pass through the driver.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelens.operators import anchors as A
from quotelens.operators import basket as B
from quotelens.operators import contract as C
from quotelens.operators import demand as Q
from quotelens.operators import drift as D
from quotelens.operators import metrics as M
from quotelens.operators import models as ML
from quotelens.operators import panel as P
from quotelens.operators import qa
from quotelens.operators import splits as S
from quotelens.operators.components import engineer_market_features
from quotelens.operators.features import leakage_findings
from quotelens.plans.pipeline import ANCHOR_CELLS, evaluate_engineered
from quotelens.sources import io as IO
from quotelens.sources import manifest as G
from quotelens.spec import PanelSpec

TABLES = ("market_data", "predictions", "metrics", "importance", "reference_features", "reference_profile", "historical", "basket_index", "competitor_metrics", "qa")
MODELS = ("evaluation_model", "production_model")


def _artifacts(run: str) -> dict[str, str]:
    return {name: f"{run}/{name}" for name in (*TABLES, *MODELS)}


def reference_features(ev, spec: PanelSpec) -> DataFrame:
    """Drift reference: test rows with id, date, target, all model features (the calendar ones too) and errors."""
    rows = ev.scored.where(F.col(S.SPLIT) == "test")
    residual = F.col(spec.target_column) - F.col("prediction")
    keep = dict.fromkeys([*spec.id_columns, spec.date_column, spec.target_column, *ev.features])
    return rows.select(*keep, "prediction", residual.alias("residual"), F.abs(residual).alias("absolute_error"))


def production_model(eng: DataFrame, spec: PanelSpec, ev, kind: str, cells) -> ML.PriceModel:
    """Refit on the latest window; too few rows are an error."""
    window = ML.production_window(eng, spec.target_column, spec.date_column, spec.lookback_months)
    row = window.agg(F.count("*").alias("n"), F.max(spec.date_column).alias("cutoff")).first()
    if row.n < spec.min_train_rows:
        raise ValueError(f"The production window has {row.n} rows; min_train_rows is {spec.min_train_rows}")
    params = {"rounds": len(ev.model.boosted["trees"])} if ev.model.boosted else None  # as many as the validation part found best
    return ML.fit_price_model(S.recency_weight(window, spec, as_of=row.cutoff), spec.target_column, ev.features, ev.categorical, ev.numeric,
                              kind=kind, weight="training_weight", params=params, cells=list(cells), date_column=spec.date_column)


def train(spark: SparkSession, quotes: DataFrame, spec: PanelSpec, run: str, kind: str = "glm_gamma", cells=ANCHOR_CELLS) -> DataFrame:
    """Everything of a training run below ``run``; returns its QA checklist."""
    began = time.time()
    spec.validate()
    C.validate_input(quotes, spec)
    quotes = C.coerce_types(quotes, spec)
    eng, meta = engineer_market_features(quotes, spec)
    ev = evaluate_engineered(eng, meta, spec, kind, cells=cells)
    key, target, at = spec.id_columns[0], spec.target_column, _artifacts(run)
    IO.write_table(S.market_data(ev.split, spec, meta), at["market_data"])
    IO.write_table(M.prediction_frame(ev.scored, spec, target), at["predictions"])
    scored = M.regression_metrics(ev.scored, target, "prediction", by=[S.SPLIT], tiebreak=key)
    IO.write_table(scored, at["metrics"])
    metrics = spark.read.parquet(at["metrics"])
    validation = ev.split.where(F.col(S.SPLIT) == "validation")
    IO.write_table(ML.permutation_importance(ev.model, validation, key, spec.importance_repeats), at["importance"])
    IO.write_table(reference_features(ev, spec), at["reference_features"])
    IO.write_table(D.reference_profile(spark.read.parquet(at["reference_features"]), ev.numeric, ev.categorical), at["reference_profile"])
    if kind != "segment_mean":
        each = ML.competitor_models(ev.split, meta.competitor_columns, ev.features, ev.categorical, ev.numeric, spec, kind, save_to=f"{run}/competitors")
    else:
        each = ML.competitor_eligibility(ev.split, meta.competitor_columns, spec.competitor_skip_missing_threshold)
    IO.write_table(each, at["competitor_metrics"])
    basket = B.reference_basket(ev.split.where(F.col(S.SPLIT) == "train"), list(spec.categorical_columns), list(spec.numeric_columns))
    IO.write_table(B.basket_index(basket, ev.model, ev.split, spec.date_column), at["basket_index"])
    hist = A.historical_features(eng, spec, cells=list(cells), kind=kind, features=ev.features, categorical=ev.categorical, numeric=ev.numeric)
    IO.write_table(hist, at["historical"])
    hist = spark.read.parquet(at["historical"])
    improvement = None
    if spec.conversion_column and spec.own_premium_column:
        _, gain = Q.demand_diagnostic(hist, spec)
        improvement = gain.where("passes_incremental_signal_check is not null")
    ML.save_model(ev.model, at["evaluation_model"])
    ML.save_model(production_model(eng, spec, ev, kind, cells), at["production_model"])
    measured = qa.measures(
        metrics, P.panel_summary(eng, spec, meta.competitor_columns), C.quality_profile(quotes, spec), C.comparability_missing(quotes, spec),
        A.historical_summary(hist, spec.date_column), S.split_metadata(ev.split, spec), leakage_findings(eng, spec, meta.competitor_columns),
        exported=len(MODELS), runtime_seconds=time.time() - began, max_runtime_seconds=spec.gate("seconds"), improvement=improvement)
    IO.write_table(qa.checklist(measured, spec), at["qa"])
    settings = {"spec": repr(spec), "features": ev.features, "categorical": ev.categorical, "leakage_warnings": meta.leakage_warnings}
    G.write_manifest(G.artifact_manifest(spark, at, settings), f"{run}/manifest")
    spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1).write.mode("overwrite").text(f"{run}/settings")
    return spark.read.parquet(at["qa"])


def _verified(spark: SparkSession, run: str, *names: str) -> dict[str, str]:
    listed, at = G.read_manifest(spark, f"{run}/manifest"), _artifacts(run)
    for name in names:
        G.require_verified(spark, listed, name, at[name])
    return at


def score(spark: SparkSession, quotes: DataFrame, spec: PanelSpec, run: str) -> DataFrame:
    """Scores new quotes with the verified production model of a run."""
    at = _verified(spark, run, "production_model")
    model = ML.load_model(spark, at["production_model"])
    return A.score_anchor(quotes, spec, model, A.model_digest(spark, at["production_model"]))


def monitor(spark: SparkSession, quotes: DataFrame, spec: PanelSpec, run: str, baseline_quotes: DataFrame) -> dict[str, DataFrame]:
    """Drift, coverage, health and refresh reasons of current quotes against a verified run."""
    at = _verified(spark, run, "reference_profile", "metrics", "production_model")
    settings = json.loads(spark.read.text(f"{run}/settings").first().value)
    eng, meta = engineer_market_features(C.coerce_types(quotes, spec), spec)
    drift = D.profile_drift_table(spark.read.parquet(at["reference_profile"]), eng, settings["features"], spec.limit("psi"))
    drops = D.coverage_drops(C.competitor_quote_rates(baseline_quotes, spec), C.competitor_quote_rates(quotes, spec))
    model = ML.load_model(spark, at["production_model"])
    priced = ML.predict(model, eng.where(F.col(spec.target_column).isNotNull()))
    current = M.regression_metrics(priced, spec.target_column, "prediction", tiebreak=spec.id_columns[0])
    now = current.first()
    old = spark.read.parquet(at["metrics"]).where(F.col(S.SPLIT) == "test").first()
    horizon = D.prediction_horizon(eng, spec.date_column, model.training_cutoff).first().prediction_horizon_days
    reasons = D.refresh_reasons(drift, horizon, drops, old.asDict() if old else None, now.asDict() if now and now.n else None, spec)
    return {"drift": drift, "coverage_drops": drops, "performance": current, "reasons": reasons,
            "panel": P.panel_summary(eng, spec, meta.competitor_columns)}
