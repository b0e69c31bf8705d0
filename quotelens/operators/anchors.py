"""Leakage-safe rolling market anchors (H1-H5) and batch scoring.

For each calendar month m the anchor model is trained on rows dated in
[m - k months, m) with a target, weighted by recency as of m, and scores every
row of m; months with fewer than ``min_train_rows`` training rows stay
unscored (warm-up).

* ``rolling_segment_anchor``: the closed-form segment-mean model in ONE job.
  Each training row is exploded into exactly the k months whose window
  contains it (months trunc(d)+1 .. trunc(d)+k), then ``groupBy(month, cell)``
  with map-side partial sums; no range join, no per-month loop, and a hot
  month or cell is pre-aggregated before the shuffle.
* ``rolling_glm_anchor``: the gamma GLM of every month in one batched fit (``batched_glm``): a row counts in each
  window that contains it without being copied, and an iteration is one job for all months.
* ``rolling_model_anchor``: any other estimator, one pruned fit per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import elapsed_days, floor_at
from quotelens.functions.temporal import temporal_columns
from quotelens.operators import batched_glm
from quotelens.operators.joins import attach_group_values, maybe_broadcast
from quotelens.operators.models import PriceModel, check_features, fit_price_model, predict
from quotelens.operators.splits import recency_weight, ts_lit
from quotelens.session import materialize
from quotelens.spec import PanelSpec

PERIOD = "__score_period"
METHOD = "rolling_origin_finite_lookback"
#: Fixed columns of the hand-off table after the roles, in order.
HANDOFF_COLUMNS = (
    "market_anchor", "relative_price_ratio", "log_relative_price", "price_gap_to_market_anchor",
    "anchor_training_start", "anchor_training_cutoff", "anchor_training_rows",
    "anchor_method", "anchor_is_frozen_for_optimization", "anchor_model_backend",
)


def _periodize(df: DataFrame, spec: PanelSpec) -> DataFrame:
    d = F.col(spec.date_column)
    return df.where(d.isNotNull()).withColumn(PERIOD, F.date_trunc("month", d).cast("timestamp_ntz"))


def rolling_segment_anchor(df: DataFrame, spec: PanelSpec, cells: list[str]) -> DataFrame:
    """Rows with market_anchor, anchor_training_start/cutoff/rows (segment-mean model)."""
    d = F.col(spec.date_column)
    t = F.col(spec.target_column)
    k = spec.lookback_months
    rows = _periodize(df, spec)
    start = F.col(PERIOD)
    months = F.sequence(start + F.make_ym_interval(F.lit(0), F.lit(1)),
                        start + F.make_ym_interval(F.lit(0), F.lit(k)),
                        F.make_ym_interval(F.lit(0), F.lit(1)))
    contrib = (rows.where(t.isNotNull())
               .select(*cells, t.alias("__y"), d.alias("__d"), F.explode(months).alias(PERIOD)))
    w = F.lit(1.0)
    if spec.recency_half_life_days is not None:
        age = F.greatest(elapsed_days(F.col(PERIOD), F.col("__d")), F.lit(0))
        w = F.pow(F.lit(0.5), age / F.lit(float(spec.recency_half_life_days)))
    if spec.weight_column:
        raise ValueError("rolling_segment_anchor takes recency weights only; use rolling_model_anchor")
    contrib = contrib.withColumn("__w", w)
    # one small table of (month, cell) sums, written: the month sums come from it, and the joins below are
    # planned by its real size
    sums = materialize(contrib.groupBy(PERIOD, *cells).agg(
        F.sum(F.col("__w") * F.col("__y")).alias("__wy"), F.sum("__w").alias("__ws"), F.count("*").alias("__n"),
        F.min("__d").alias("__lo"), F.max("__d").alias("__hi")), "anchor-cells")
    per_period = sums.groupBy(PERIOD).agg(
        F.sum("__n").cast("double").alias("anchor_training_rows"),
        F.min("__lo").alias("anchor_training_start"), F.max("__hi").alias("anchor_training_cutoff"),
        (F.sum("__wy") / F.sum("__ws")).alias("__gm"))
    per_period = materialize(per_period.where(F.col("anchor_training_rows") >= spec.min_train_rows), "anchor-months")
    per_cell = sums.select(PERIOD, *cells, (F.col("__wy") / F.col("__ws")).alias("__cm"))
    scored = rows.join(maybe_broadcast(per_period), PERIOD, "left")
    scored = attach_group_values(scored, per_cell, [PERIOD, *cells])
    anchor = F.when(F.col("__gm").isNotNull(), F.coalesce(F.col("__cm"), F.col("__gm")))
    return scored.withColumn("market_anchor", anchor).drop("__gm", "__cm", PERIOD)


def _window_months(month, k: int):
    """The k months whose windows contain rows of a month."""
    step = F.make_ym_interval(F.lit(0), F.lit(1))
    return F.sequence(month + step, month + F.make_ym_interval(F.lit(0), F.lit(k)), step)


def _month_number(month):
    return F.year(month) * 12 + F.month(month)


def rolling_glm_anchor(df: DataFrame, spec: PanelSpec, categorical: list[str], numeric: list[str],
                       power: float = 2.0, ridge: float = 0.0) -> DataFrame:
    """Rows with market_anchor, anchor_training_start/cutoff/rows by a GLM for each month (log link, recency weights as of it)."""
    d, t = F.col(spec.date_column), F.col(spec.target_column)
    rows = _periodize(df, spec)
    fit_rows = rows.where(t > 0 if power == 2.0 else t >= 0)
    windows = (fit_rows.select(d.alias("__d"), F.explode(_window_months(F.col(PERIOD), spec.lookback_months)).alias(PERIOD))
               .groupBy(PERIOD).agg(F.count("*").cast("double").alias("anchor_training_rows"), F.min("__d").alias("anchor_training_start"),
                                    F.max("__d").alias("anchor_training_cutoff")).where(F.col("anchor_training_rows") >= spec.min_train_rows))
    windows = materialize(windows.join(rows.select(PERIOD).distinct(), PERIOD, "left_semi"), "anchor-months")
    months = [r[0] for r in windows.select(_month_number(F.col(PERIOD))).collect()]  # one number a month
    base = F.col(spec.weight_column).try_cast("double") if spec.weight_column else F.lit(1.0)

    def in_window(month):
        w = F.coalesce(base, F.lit(0.0))
        if spec.recency_half_life_days is not None:
            w = w * F.pow(F.lit(0.5), F.greatest(elapsed_days(month, d), F.lit(0)) / F.lit(float(spec.recency_half_life_days)))
        return batched_glm.member(_month_number(month), t, w)

    design = batched_glm.learn_design(fit_rows, categorical, numeric)
    betas = batched_glm.fit_groups(fit_rows, design, F.transform(_window_months(F.col(PERIOD), spec.lookback_months), in_window), sorted(months), power, ridge)
    scored = batched_glm.predict_groups(rows, _month_number(F.col(PERIOD)), design, betas, "market_anchor")
    return scored.join(maybe_broadcast(windows), PERIOD, "left").drop(PERIOD)


def rolling_model_anchor(df: DataFrame, spec: PanelSpec, features: list[str], categorical: list[str],
                         numeric: list[str], kind: str = "glm_gamma", params: dict | None = None,
                         workers: int = 8) -> DataFrame:
    """Rolling anchors with a Spark ML estimator: one fit per month on its window.

    The month list is read once (one row per month); window sizes come from one
    aggregate over the same explode as the closed-form anchor; fits of
    eligible months run as concurrent Spark jobs from a small thread pool.
    """
    d = F.col(spec.date_column)
    rows = _periodize(df, spec)
    start = F.col(PERIOD)
    windows = (rows.where(F.col(spec.target_column).isNotNull())
               .select(F.explode(F.sequence(start + F.make_ym_interval(F.lit(0), F.lit(1)),
                                            start + F.make_ym_interval(F.lit(0), F.lit(spec.lookback_months)),
                                            F.make_ym_interval(F.lit(0), F.lit(1)))).alias(PERIOD))
               .groupBy(PERIOD).count())
    present = rows.select(PERIOD).distinct()
    eligible = [r[0] for r in present.join(windows, PERIOD).where(F.col("count") >= spec.min_train_rows)
                .select(PERIOD).collect()]

    import uuid
    from quotelens.session import stage_path
    spark = df.sparkSession
    root = stage_path(spark, f"anchors-{uuid.uuid4().hex[:12]}")
    cols = rows.columns

    def fit_month(i_p):
        i, p = i_p
        lo = ts_lit(p) - F.make_ym_interval(F.lit(0), F.lit(spec.lookback_months))
        train = rows.where((d >= lo) & (d < ts_lit(p)) & F.col(spec.target_column).isNotNull())
        train_w = recency_weight(train, spec, as_of=p)
        model = fit_price_model(train_w, spec.target_column, features, categorical, numeric, kind=kind,
                                weight="training_weight", params=params, date_column=spec.date_column)
        month_rows = rows.where(F.col(PERIOD) == ts_lit(p))
        scored = predict(model, month_rows, "market_anchor").select(*cols, "market_anchor").withColumns({
            "anchor_training_start": ts_lit(model.training_start),
            "anchor_training_cutoff": ts_lit(model.training_cutoff),
            "anchor_training_rows": F.lit(model.training_rows).cast("double"),
        })
        # one folder per month: a small plan per job, and a retried month rewrites only its folder
        scored.write.mode("overwrite").parquet(f"{root}/month={i}")

    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        list(pool.map(fit_month, enumerate(sorted(eligible))))
    done = spark.read.parquet(root).drop("month") if eligible else None
    scored_keys = F.broadcast(spark.createDataFrame([(p,) for p in eligible], f"{PERIOD} timestamp_ntz")) \
        if eligible else None
    rest = rows if scored_keys is None else rows.join(scored_keys, PERIOD, "left_anti")
    rest = rest.withColumns({"market_anchor": F.lit(None).cast("double"),
                             "anchor_training_start": F.lit(None).cast("timestamp_ntz"),
                             "anchor_training_cutoff": F.lit(None).cast("timestamp_ntz"),
                             "anchor_training_rows": F.lit(None).cast("double")})
    out = rest if done is None else done.unionByName(rest)
    return out.drop(PERIOD)


def relative_price(df: DataFrame, own: str, anchor: str = "market_anchor") -> DataFrame:
    """Ratio, log ratio and gap of own price to the anchor, both floored at 1e-6; NULL stays NULL."""
    a = floor_at(F.col(anchor))
    o = floor_at(F.col(own).cast("double"))
    return df.withColumns({
        "relative_price_ratio": o / a,
        "log_relative_price": F.log(o / a),
        "price_gap_to_market_anchor": o - a,
    })


def handoff(df: DataFrame, spec: PanelSpec, backend: str) -> DataFrame:
    """Hand-off projection in fixed column order with constant provenance flags (H4)."""
    flags = {"anchor_method": F.lit(METHOD), "anchor_is_frozen_for_optimization": F.lit(True),
             "anchor_model_backend": F.lit(backend)}
    df = df.withColumns(flags)
    roles = (*spec.id_columns, spec.date_column, *spec.categorical_columns, *spec.numeric_columns,
             spec.own_premium_column, spec.conversion_column, spec.weight_column, spec.target_column)
    present = set(df.columns)
    return df.select(*dict.fromkeys(c for c in roles + HANDOFF_COLUMNS if c in present))


def historical_features(df: DataFrame, spec: PanelSpec, cells: list[str] | None = None,
                        kind: str = "segment_mean", features=None, categorical=None, numeric=None,
                        params: dict | None = None) -> DataFrame:
    """H1-H4: rolling anchors, relative price, hand-off projection."""
    if kind == "segment_mean":
        scored = rolling_segment_anchor(df, spec, list(cells or spec.categorical_columns))
    elif kind == "glm_gamma":
        scored = rolling_glm_anchor(df, spec, list(categorical or []), list(numeric or []), **(params or {}))
    else:
        scored = rolling_model_anchor(df, spec, features, categorical, numeric, kind, params)
    if spec.own_premium_column and spec.own_premium_column in df.columns:
        scored = relative_price(scored, spec.own_premium_column)
    return handoff(scored, spec, kind)


def historical_summary(hist: DataFrame, date_column: str) -> DataFrame:
    """rows_total, rows_scored, rows_warmup_unscored, periods_scored: months with a scored row (H5)."""
    return hist.agg(
        F.count("*").alias("rows_total"),
        F.count("market_anchor").alias("rows_scored"),
        F.count_if(F.col("market_anchor").isNull()).alias("rows_warmup_unscored"),
        F.count_distinct(F.when(F.col("market_anchor").isNotNull(), F.trunc(date_column, "month")))
        .alias("periods_scored"))


def historical_windows(hist: DataFrame, spec: PanelSpec) -> DataFrame:
    """Window provenance per scored month (H2)."""
    m = F.trunc(F.col(spec.date_column), "month")
    return (hist.where(F.col("market_anchor").isNotNull())
            .groupBy(m.alias("quote_month"))
            .agg(F.min("anchor_training_start").alias("anchor_training_start"),
                 F.max("anchor_training_cutoff").alias("anchor_training_cutoff"),
                 F.max("anchor_training_rows").alias("anchor_training_rows"),
                 F.count("*").alias("rows_scored")))


def model_digest(spark, path: str) -> str:
    """sha-256 over names and contents of a saved model folder's files."""
    from quotelens.sources.manifest import folder_digest
    return folder_digest(spark, path).first().sha256


def score_anchor(df: DataFrame, spec: PanelSpec, model: PriceModel, model_sha256: str | None = None) -> DataFrame:
    """Batch score new quotes with a frozen anchor model."""
    d = spec.date_column
    if d not in df.columns:
        raise ValueError(f"No column {d!r} in the quotes to score")
    frame = df.withColumn(d, F.col(d).try_cast("timestamp_ntz"))
    bad = frame.where(F.col(d).isNull()).limit(1).count()
    if bad:
        raise ValueError("Some quotes to score have no valid date")
    frame = frame.withColumns({c: F.col(c).try_cast("double") for c in spec.numeric_columns if c in df.columns})
    frame = frame.withColumns({c: F.col(c).cast("string") for c in spec.categorical_columns if c in df.columns})
    frame = frame.withColumns(temporal_columns(F.col(d)))
    check_features(model, frame)
    scored = predict(model, frame, "__pred").withColumn("market_anchor", floor_at("__pred"))
    keep = [c for c in [*spec.id_columns, d] if c in frame.columns]
    cols = [*keep, "market_anchor"]
    own = spec.own_premium_column
    if own and own in frame.columns:
        scored = scored.withColumn(own, floor_at(F.col(own).cast("double")))
        scored = relative_price(scored, own)
        cols += [own, "relative_price_ratio", "log_relative_price", "price_gap_to_market_anchor"]
    out = scored.select(*cols).withColumns({
        "anchor_is_frozen_for_optimization": F.lit(True),
        "anchor_model_sha256": F.lit(model_sha256).cast("string"),
        "anchor_training_cutoff": F.lit(model.training_cutoff).cast("string"),
    })
    if model.training_cutoff:
        out = out.withColumn("prediction_horizon_days", elapsed_days(F.col(d), ts_lit(model.training_cutoff)))
    return out
