"""Accuracy metrics as aggregates (optionally grouped, e.g. by split or month).

Everything except the Gini and AUC is one hash aggregate of sums; the gamma
deviance of the mean-only model is rewritten so it needs no second pass:
sum 2(ln(m/y) + y/m - 1) = 2(n ln m - sum ln y) with m the mean of y.
Gini and AUC use ordered prefix sums (``functions.prefix``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import safe_div
from quotelens.functions.prefix import ordered_cross_sum
from quotelens.functions.quantiles import quantiles
from quotelens.operators.joins import attach_group_values

METRIC_COLUMNS = ("d2", "r2", "rmse", "rmsle", "mae", "mape", "mean_bias", "mean_bias_pct", "gini", "n")


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def usable_rows(df: DataFrame, actual: str, pred: str) -> DataFrame:
    y, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    return df.where(_finite(y) & _finite(p))


def regression_metrics(df: DataFrame, actual: str, pred: str, weight: str | None = None,
                       by: list[str] | tuple = (), tiebreak: str | None = None,
                       with_gini: bool = True) -> DataFrame:
    """d2, r2, rmse, rmsle, mae, mape, mean_bias, mean_bias_pct, gini, n per group."""
    by = list(by)
    base = usable_rows(df, actual, pred)
    y, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    e = p - y
    nz = y != 0
    pc = F.greatest(p, F.lit(1e-6))
    sw = F.sum(w)
    agg = base.groupBy(*by).agg(
        F.count("*").alias("n"),
        sw.alias("__sw"),
        F.sum(w * e * e).alias("__swe2"),
        F.sum(w * F.abs(e)).alias("__swae"),
        F.sum(w * e).alias("__swe"),
        F.sum(F.when(nz, w)).alias("__swnz"),
        F.sum(F.when(nz, w * F.abs(e / y))).alias("__swape"),
        F.sum(F.when(nz, w * (e / y))).alias("__swpe"),
        F.sum(w * F.pow(F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(F.greatest(y, F.lit(0.0))), 2)).alias("__swle2"),
        F.sum(w * y).alias("__swy"),
        F.sum(w * y * y).alias("__swy2"),
        F.var_pop(y).alias("__vy"),
        F.count_if(y <= 0).alias("__nonpos"),
        F.sum(F.when(y > 0, F.log(y))).alias("__sly"),
        F.sum(y).alias("__sy"),
        F.sum(F.when(y > 0, 2 * (F.log(pc / y) + y / pc - 1))).alias("__dev"),
    )
    n = F.col("n").cast("double")
    mean_y = F.col("__sy") / n
    dev_null = 2 * (n * F.log(mean_y) - F.col("__sly"))
    # unweighted: the merged central moment, which keeps its digits where a difference of huge sums does not
    sst = F.col("__vy") * n if weight is None else F.col("__swy2") - F.col("__swy") * F.col("__swy") / F.col("__sw")
    sse = F.col("__swe2")
    out = agg.select(
        *by,
        F.when((F.col("__nonpos") == 0) & (F.col("n") >= 2) & (dev_null != 0),
               1 - F.col("__dev") / dev_null).alias("d2"),
        F.when(sst > 0, 1 - sse / sst).when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("r2"),
        F.sqrt(sse / F.col("__sw")).alias("rmse"),
        F.sqrt(F.col("__swle2") / F.col("__sw")).alias("rmsle"),
        (F.col("__swae") / F.col("__sw")).alias("mae"),
        (safe_div(F.col("__swape"), F.col("__swnz")) * 100).alias("mape"),
        (F.col("__swe") / F.col("__sw")).alias("mean_bias"),
        (safe_div(F.col("__swpe"), F.col("__swnz")) * 100).alias("mean_bias_pct"),
        F.col("n"),
    )
    if not with_gini:
        return out.withColumn("gini", F.lit(None).cast("double"))
    g = gini(base, actual, pred, weight, by, tiebreak)
    if by:
        return attach_group_values(out, g, by)
    return out.withColumn("gini", F.lit(g.first().gini))


def _concentration(df: DataFrame, by: list[str], score: Column, tie: Column, y: Column, w: Column) -> dict:
    """Per group 1 - 2 * trapezoid area of (cum weight share, cum loss share), (0,0) excluded.

    With C_i the cumulative loss up to row i, the area is
    (2 * sum w_i C_i - sum w_i l_i - w_1 l_1) / (2 W L); all terms come from one ordered pass.
    """
    cross = ordered_cross_sum(df, by, [score, tie], w, y * w, c=1.0)
    out = {}
    for key, acc in cross.items():
        W, L = acc["A"], acc["B"]
        if W == 0 or L == 0:
            out[key] = None
            continue
        area = (2 * acc["S"] - acc["AB"] - acc["first_a"] * acc["first_b"]) / (2 * W * L)
        out[key] = 1 - 2 * area
    return out


def gini(df: DataFrame, actual: str, pred: str, weight: str | None = None,
         by: list[str] | tuple = (), tiebreak: str | None = None) -> DataFrame:
    """Normalised Gini per group: concentration by prediction over that by actual, round 6.

    Ties in the score are broken by ``tiebreak`` (an id column) when given,
    else by the monotonically increasing row id of the input.
    """
    from pyspark import StorageLevel
    by = list(by)
    y, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    base = usable_rows(df, actual, pred)
    if tiebreak is None:
        base = base.withColumn("__tie", F.monotonically_increasing_id())
        tiebreak = "__tie"
    # two orderings read the same rows: keep only the needed columns, once
    base = base.select(*by, y.alias("__y"), p.alias("__p"), w.alias("__w"),
                       F.col(tiebreak).alias("__t")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yy, pp, ww, tie = F.col("__y"), F.col("__p"), F.col("__w"), F.col("__t")
        raw = _concentration(base, by, pp, tie, yy, ww)
        perfect = _concentration(base, by, yy, tie, yy, ww)
        stats = {tuple(r[g] for g in by): (r.n, r.sy) for r in
                 base.groupBy(*by).agg(F.count("*").alias("n"), F.sum("__y").alias("sy")).collect()}
    finally:
        base.unpersist()
    rows = []
    for key, (n, sy) in stats.items():
        r, pf = raw.get(key), perfect.get(key)
        val = None
        if n >= 2 and sy != 0 and r is not None and pf is not None and abs(pf) > 1e-12:
            val = round(r / pf, 6)
        rows.append((*key, val))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in by]
                       + ["gini double"])
    if not rows and not by:
        rows = [(None,)]
    return df.sparkSession.createDataFrame(rows, schema)


def lift_table(df: DataFrame, actual: str, pred: str, n_quantiles: int = 10,
               weight: str | None = None) -> DataFrame:
    """Buckets by interior percentile edges of the prediction: bucket = #edges <= x."""
    base = usable_rows(df, actual, pred)
    probs = [i / n_quantiles for i in range(n_quantiles + 1)]
    edges = quantiles(base, pred, probs)
    interior = [e for e in edges[1:-1] if e is not None]
    p = F.col(pred).cast("double")
    y = F.col(actual).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    bucket = reduce(lambda a, b: a + b, [F.when(F.lit(e) <= p, 1).otherwise(0) for e in interior], F.lit(0))
    bucket = F.least(bucket, F.lit(n_quantiles - 1))
    overall = base.agg((F.sum(w * y) / F.sum(w)).alias("m")).first().m
    agg = base.groupBy(bucket.alias("b")).agg(
        F.count("*").alias("n"), (F.sum(w * p) / F.sum(w)).alias("mp"), (F.sum(w * y) / F.sum(w)).alias("ma"))
    return agg.select(
        (F.col("b") + 1).cast("long").alias("quantile"), F.col("n"),
        F.round("mp", 4).alias("mean_predicted"), F.round("ma", 4).alias("mean_actual"),
        (F.round(F.col("ma") / F.lit(overall), 4) if overall else F.lit(None).cast("double")).alias("lift"),
        F.round(safe_div(F.col("mp"), F.col("ma")), 4).alias("pred_actual_ratio"))


def prediction_frame(df: DataFrame, spec, target: str, pred: str = "prediction") -> DataFrame:
    """id, date, target, prediction, residual, absolute error, APE % (0 target -> NULL)."""
    keep = [c for c in [*spec.id_columns, spec.date_column, target] if c in df.columns]
    extra = ["_split"] if "_split" in df.columns else []
    res = F.col(target) - F.col(pred)
    return df.select(*keep, *extra, F.col(pred).alias("prediction")).withColumns({
        "residual": res,
        "absolute_error": F.abs(res),
    }).withColumn("absolute_percentage_error",
                  safe_div(F.col("absolute_error"), F.col(target)) * 100)


def binary_metrics(df: DataFrame, actual: str, prob: str, by: list[str] | tuple = ()) -> DataFrame:
    """log loss (clipped), Brier, AUC (average ranks for ties), mean prediction,
    actual rate and calibration bias, per group."""
    by = list(by)
    eps = 2.220446049250313e-16
    y = F.col(actual).cast("double")
    p = F.col(prob).cast("double")
    pc = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    agg = df.groupBy(*by).agg(
        (-F.avg(y * F.log(pc) + (1 - y) * F.log(1 - pc))).alias("log_loss"),
        F.avg(F.pow(p - y, 2)).alias("brier"),
        F.avg(p).alias("mean_prediction"),
        F.avg(y).alias("actual_rate"),
    ).withColumn("calibration_bias", F.col("mean_prediction") - F.col("actual_rate"))
    auc_df = auc(df, actual, prob, by)
    if by:
        return attach_group_values(agg, auc_df, by)
    return agg.withColumn("auc", F.lit(auc_df.first().auc))


def auc(df: DataFrame, actual: str, prob: str, by: list[str] | tuple = ()) -> DataFrame:
    """ROC AUC = P(score_pos > score_neg) + 0.5 P(tie), from per-score counts."""
    by = list(by)
    y = F.col(actual).cast("double")
    per_score = df.groupBy(*by, F.col(prob).cast("double").alias("__s")).agg(
        F.sum(F.when(y == 1, 1.0).otherwise(0.0)).alias("pos"),
        F.sum(F.when(y == 0, 1.0).otherwise(0.0)).alias("neg"))
    cross = ordered_cross_sum(per_score, by, [F.col("__s")], F.col("pos"), F.col("neg"), c=0.5)
    rows = []
    for key, acc in cross.items():
        P, N = acc["A"], acc["B"]
        rows.append((*key, acc["S"] / (P * N) if P and N else None))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in by]
                       + ["auc double"])
    if not rows and not by:
        rows = [(None,)]
    return df.sparkSession.createDataFrame(rows, schema)
