"""Composed runs: training evaluation, rolling anchors, scoring, monitoring.

Each step is a DataFrame function; actions happen only at scalar look-ups
(cut dates, medians, weights' mean), fits and sinks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.operators.components import FeatureMeta, engineer_market_features
from quotelens.operators.features import select_model_features
from quotelens.operators.models import STOPS_EARLY, PriceModel, fit_price_model, predict
from quotelens.operators.splits import SPLIT, recency_weight, time_split, train_lookback
from quotelens.spec import PanelSpec

# Risk cells of the closed-form segment-mean anchor used by the SQL-checked queries.
ANCHOR_CELLS = ("vehicle_segment", "coverage_type")


@dataclass
class Evaluation:
    engineered: DataFrame
    meta: FeatureMeta
    split: DataFrame          # after the training look-back, labelled by _split
    features: list[str]
    categorical: list[str]
    numeric: list[str]
    model: PriceModel
    scored: DataFrame         # split + prediction


def evaluate(panel: DataFrame, spec: PanelSpec, kind: str = "segment_mean",
             params: dict | None = None, cells=ANCHOR_CELLS) -> Evaluation:
    eng, meta = engineer_market_features(panel, spec)
    return evaluate_engineered(eng, meta, spec, kind, params, cells)


def evaluate_engineered(eng: DataFrame, meta: FeatureMeta, spec: PanelSpec, kind: str = "segment_mean",
                        params: dict | None = None, cells=ANCHOR_CELLS) -> Evaluation:
    """Split, look-back, recency-weighted fit on train, predictions for all parts."""
    split = train_lookback(time_split(eng, spec), spec)
    feats, cat, num = select_model_features(eng, spec, meta)
    train = split.where(F.col(SPLIT) == "train")
    cutoff = train.agg(F.max(spec.date_column).alias("c")).first().c
    train_w = recency_weight(train, spec, as_of=cutoff)
    held_out = None
    if kind in STOPS_EARLY:  # the validation part decides when boosting ends
        held_out = "__held_out"
        watched = split.where(F.col(SPLIT) == "validation").withColumn("training_weight", F.lit(1.0))
        train_w = train_w.withColumn(held_out, F.lit(False)).unionByName(watched.withColumn(held_out, F.lit(True)))
    model = fit_price_model(train_w, spec.target_column, feats, cat, num, kind=kind,
                            weight="training_weight", params=params, cells=list(cells),
                            date_column=spec.date_column, validation_indicator=held_out)
    scored = predict(model, split)
    return Evaluation(eng, meta, split, feats, cat, num, model, scored)
