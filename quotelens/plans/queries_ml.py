"""Registered queries: QA gates, demand signal, binary metrics and Spark ML models."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelens.operators import contract as C
from quotelens.operators import demand as Q
from quotelens.operators import metrics as M
from quotelens.operators import models as ML
from quotelens.operators import panel as P
from quotelens.operators import qa
from quotelens.operators import splits as S
from quotelens.operators.features import leakage_findings
from quotelens.operators.anchors import historical_summary
from quotelens.plans.oracle import COMPS, metrics_sql, wrap
from quotelens.plans.queries_model import CAT_F, EVAL_SQL, FEAT, HIST_SQL, NUM_F, evaluation, historical
from quotelens.plans.registry import SPEC, engineered, panel, register

T = SPEC.target_column
BOTH_SQL = EVAL_SQL + HIST_SQL[len(FEAT):]


# ---------------------------------------------------------------- QA (K*)
def _checks(spark, sf_dir):
    ev = evaluation(spark, sf_dir)
    eng, meta = engineered(spark, sf_dir)
    mbs = M.regression_metrics(ev.scored, T, "prediction", by=["_split"], tiebreak="quote_id")
    measured = qa.measures(mbs, P.panel_summary(eng, SPEC, meta.competitor_columns),
                           C.quality_profile(panel(spark, sf_dir), SPEC),
                           C.comparability_missing(panel(spark, sf_dir), SPEC),
                           historical_summary(historical(spark, sf_dir), SPEC.date_column),
                           split_dates=S.split_metadata(ev.split, SPEC),
                           leakage=leakage_findings(eng, SPEC, meta.competitor_columns))
    return qa.checklist(measured, SPEC)


_cov = ("(SELECT min(r) FROM (SELECT avg(CASE WHEN c.premium IS NOT NULL THEN 1.0 ELSE 0.0 END) AS r FROM feat, "
        "LATERAL (SELECT unnest([" + ", ".join(COMPS) + "]) AS premium, unnest(['" + "', '".join(COMPS)
        + "']) AS competitor) c GROUP BY qmonth, c.competitor))")
_eli = "(SELECT min(r) FROM (SELECT avg(CASE WHEN tgt IS NOT NULL THEN 1.0 ELSE 0.0 END) AS r FROM feat GROUP BY qmonth))"
_bias = ("(SELECT (avg(tgt) FILTER (WHERE NOT complete_panel) / NULLIF(avg(tgt) FILTER (WHERE complete_panel), 0) - 1) "
         "* 100 FROM feat)")
_n_present = "(" + " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in COMPS) + ")"
QA_SQL = BOTH_SQL + f""",
mbs AS (SELECT * FROM {metrics_sql("pred", ["_split"])}),
measured AS (
  SELECT 'data_contract_valid' AS "check", CAST((SELECT count(*) FROM quotes WHERE {_n_present} >= 3) AS DOUBLE) AS value
  UNION ALL SELECT 'validation_d2_threshold', d2 FROM mbs WHERE _split = 'validation'
  UNION ALL SELECT 'validation_rmse_threshold', rmse FROM mbs WHERE _split = 'validation'
  UNION ALL SELECT 'test_d2_threshold', d2 FROM mbs WHERE _split = 'test'
  UNION ALL SELECT 'test_rmse_threshold', rmse FROM mbs WHERE _split = 'test'
  UNION ALL SELECT 'validation_mape_threshold', mape FROM mbs WHERE _split = 'validation'
  UNION ALL SELECT 'validation_gini_threshold', gini FROM mbs WHERE _split = 'validation'
  UNION ALL SELECT 'validation_bias_threshold', mean_bias_pct FROM mbs WHERE _split = 'validation'
  UNION ALL SELECT 'monthly_competitor_coverage', {_cov}
  UNION ALL SELECT 'monthly_target_eligibility', {_eli}
  UNION ALL SELECT 'incomplete_panel_target_bias', {_bias}
  UNION ALL SELECT 'premium_comparability_fields_complete', CAST((SELECT count(*) FROM quotes WHERE coverage_type IS NULL) AS DOUBLE)
  UNION ALL SELECT 'rolling_origin_historical_anchors', CAST((SELECT count(market_anchor) FROM hist) AS DOUBLE)
  UNION ALL SELECT 'time_based_split', CAST(max(quote_date) FILTER (WHERE _split = 'train') <= min(quote_date) FILTER (WHERE _split = 'validation')
    AND max(quote_date) FILTER (WHERE _split = 'validation') <= min(quote_date) FILTER (WHERE _split = 'test') AS DOUBLE) FROM lb
  UNION ALL SELECT 'leakage_review', 0.0),
th AS (SELECT * FROM (VALUES
  ('data_contract_valid', '>', 0.0, TRUE), ('time_based_split', '==', 1.0, TRUE),
  ('validation_d2_threshold', '>=', 0.75, TRUE), ('validation_rmse_threshold', '<=', 60.0, TRUE),
  ('test_d2_threshold', '>=', 0.75, TRUE), ('test_rmse_threshold', '<=', 60.0, TRUE),
  ('validation_mape_threshold', '<=', 15.0, FALSE), ('validation_gini_threshold', '>=', 0.3, FALSE),
  ('validation_bias_threshold', 'abs<=', 5.0, FALSE), ('monthly_competitor_coverage', '>=', 0.7, TRUE),
  ('monthly_target_eligibility', '>=', 0.8, TRUE), ('incomplete_panel_target_bias', 'abs<=', 5.0, FALSE),
  ('premium_comparability_fields_complete', '==', 0.0, TRUE), ('rolling_origin_historical_anchors', '>', 0.0, TRUE),
  ('model_export_available', '>', 0.0, TRUE), ('runtime_budget', '<', 1.0, TRUE), ('leakage_review', '==', 0.0, FALSE),
  ('standalone_demand_signal', '>', 0.0, FALSE)) v("check", op, threshold, blocking)),
checks AS (
  SELECT th."check", m.value, th.threshold, th.blocking,
    coalesce(CASE th.op WHEN '>' THEN m.value > th.threshold WHEN '>=' THEN m.value >= th.threshold
      WHEN '<=' THEN m.value <= th.threshold WHEN 'abs<=' THEN abs(m.value) <= th.threshold
      WHEN '<' THEN m.value < th.threshold WHEN '==' THEN m.value = th.threshold END, FALSE) AS passed
  FROM th LEFT JOIN measured m ON th."check" = m."check")"""


@register("qa_checklist", wrap("SELECT * FROM checks", "check:s, value:d, threshold:d, blocking:b, passed:b", QA_SQL))
def qa_checklist(spark, sf_dir):
    """QA checklist of all 18 gates: metrics, panel, comparability, rolling anchors, split order, leakage. Export,
    runtime and demand signal belong to a training run; unmeasured here, they fail (K1, K2)."""
    return _checks(spark, sf_dir)


@register("qa_rollup", wrap(
    "SELECT coalesce(bool_and(passed) FILTER (WHERE blocking), TRUE) AS overall_passed, "
    "coalesce(bool_or(NOT passed) FILTER (WHERE NOT blocking), FALSE) AS human_review_required, count(*) AS checks "
    "FROM checks", "overall_passed:b, human_review_required:b, checks:i", QA_SQL))
def qa_rollup(spark, sf_dir):
    """Overall pass (all blocking) and human review (any advisory fails) (K3)."""
    return qa.rollup(_checks(spark, sf_dir))


@register("report_performance", wrap(
    "SELECT _split, n, round(d2, 4) AS d2, round(rmse, 2) AS rmse, round(mape, 2) AS mape, round(gini, 4) AS gini, "
    "round(mean_bias_pct, 2) AS mean_bias_pct FROM mbs",
    "_split:s, n:i, d2:d, rmse:d, mape:d, gini:d, mean_bias_pct:d", QA_SQL))
def report_performance(spark, sf_dir):
    """Performance by sample for the business report (K4)."""
    ev = evaluation(spark, sf_dir)
    m = M.regression_metrics(ev.scored, T, "prediction", by=["_split"], tiebreak="quote_id")
    return m.select("_split", "n", F.round("d2", 4).alias("d2"), F.round("rmse", 2).alias("rmse"),
                    F.round("mape", 2).alias("mape"), F.round("gini", 4).alias("gini"),
                    F.round("mean_bias_pct", 2).alias("mean_bias_pct"))


# ---------------------------------------------------------------- demand (Q*) and binary metrics
DEMAND_SQL = HIST_SQL + f""",
du AS (SELECT *, ln(greatest(own_premium, 1e-6)) AS log_own_premium, ln(greatest(market_anchor, 1e-6)) AS log_market_anchor
       FROM hist WHERE converted IS NOT NULL AND own_premium IS NOT NULL AND market_anchor IS NOT NULL AND converted IN (0, 1)),
dn AS (SELECT count(*) AS n FROM du),
dc AS (SELECT du.*, CASE WHEN row_number() OVER (ORDER BY quote_date, quote_id) <= CAST(floor(n * (1 - 0.2)) AS BIGINT)
         THEN 'train' ELSE 'test' END AS _demand_part FROM du, dn)"""


@register("demand_rows", wrap(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE converted = 1) AS positives, count(*) FILTER (WHERE converted = 0) "
    "AS negatives, CASE WHEN count(*) >= 500 AND count(*) FILTER (WHERE converted = 1) > 0 AND count(*) FILTER "
    "(WHERE converted = 0) > 0 THEN 'ready' ELSE 'insufficient_data' END AS status FROM du",
    "rows:i, positives:i, negatives:i, status:s", DEMAND_SQL))
def demand_rows(spark, sf_dir):
    """Usable rows for the demand diagnostic and its gates (Q1)."""
    return Q.readiness(Q.usable_rows(historical(spark, sf_dir), SPEC), SPEC)


@register("demand_split", wrap("SELECT quote_id, _demand_part FROM dc", "quote_id:i, _demand_part:s", DEMAND_SQL))
def demand_split(spark, sf_dir):
    """Chronological cut at int(n * 0.8) rows by (date, id) (Q2)."""
    return Q.chronological_cut(Q.usable_rows(historical(spark, sf_dir), SPEC), SPEC).select("quote_id", Q.PART)


BIN_SQL = DEMAND_SQL + """,
rate AS (SELECT region, channel, avg(converted) AS p FROM dc WHERE _demand_part = 'train' GROUP BY 1, 2),
sc AS (SELECT d.converted AS y, coalesce(r.p, (SELECT avg(converted) FROM dc WHERE _demand_part = 'train')) AS p
       FROM dc d LEFT JOIN rate r ON d.region IS NOT DISTINCT FROM r.region AND d.channel IS NOT DISTINCT FROM r.channel
       WHERE d._demand_part = 'test'),
ps AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY p),
auc AS (SELECT sum(pos * (coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 + 0.5 * neg)) / (sum(pos) OVER () * sum(neg) OVER ()) AS auc FROM ps)"""


@register("binary_metrics", wrap("""
SELECT -avg(y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
            + (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))) AS log_loss,
  avg(pow(p - y, 2)) AS brier, avg(p) AS mean_prediction, avg(y) AS actual_rate, avg(p) - avg(y) AS calibration_bias,
  (SELECT sum(pos * (cneg + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS
    BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cneg FROM ps)) AS auc
FROM sc""", "log_loss:d, brier:d, mean_prediction:d, actual_rate:d, calibration_bias:d, auc:d", BIN_SQL))
def binary_metrics(spark, sf_dir):
    """Log loss, Brier, AUC (ties averaged), calibration of a segment conversion-rate score."""
    cut = Q.chronological_cut(Q.usable_rows(historical(spark, sf_dir), SPEC), SPEC)
    train = cut.where(F.col(Q.PART) == "train")
    test = cut.where(F.col(Q.PART) == "test")
    model = ML.fit_price_model(train, "__conv", [], ["region", "channel"], [], kind="segment_mean",
                               cells=["region", "channel"])
    scored = ML.predict(model, test, "p_convert")
    return M.binary_metrics(scored, "__conv", "p_convert")


@register("demand_models")
def demand_models(spark, sf_dir):
    """Logistic conversion models with and without the log anchor, test metrics (Q3)."""
    metrics, _ = Q.demand_diagnostic(historical(spark, sf_dir), SPEC)
    return metrics


@register("demand_improvement_given", wrap("""
SELECT 'diagnostic_only' AS status, b.log_loss - a.log_loss AS incremental_log_loss_improvement,
  b.brier - a.brier AS incremental_brier_improvement, a.log_loss < b.log_loss AS passes_incremental_signal_check FROM gm b, gm a WHERE b.model = 'baseline' AND a.model = 'with_market_anchor'""",
    "status:s, incremental_log_loss_improvement:d, incremental_brier_improvement:d, passes_incremental_signal_check:b", BIN_SQL + """,
gm AS (SELECT model, -avg(y * ln(p) + (1 - y) * ln(1 - p)) AS log_loss, avg(pow(p - y, 2)) AS brier FROM
  (SELECT 'baseline' AS model, y, (SELECT avg(converted) FROM dc WHERE _demand_part = 'train') AS p FROM sc
   UNION ALL SELECT 'with_market_anchor', y, least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16) FROM sc) GROUP BY model)"""))
def demand_improvement_given(spark, sf_dir):
    """Improvement over a metrics table of two closed-form scores: the overall rate, and the rate by region and channel (Q4)."""
    cut = Q.chronological_cut(Q.usable_rows(historical(spark, sf_dir), SPEC), SPEC)
    train, test = cut.where(F.col(Q.PART) == "train"), cut.where(F.col(Q.PART) == "test")
    out = None
    for name, cells in (("baseline", []), ("with_market_anchor", ["region", "channel"])):
        model = ML.fit_price_model(train, "__conv", [], cells, [], kind="segment_mean", cells=cells)
        m = M.binary_metrics(ML.predict(model, test, "p_convert").select("__conv", "p_convert"), "__conv", "p_convert").withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return Q.improvement_of(out)


@register("demand_improvement")
def demand_improvement(spark, sf_dir):
    """Log-loss and Brier improvement from the anchor; passes if log loss falls (Q4)."""
    _, improvement = Q.demand_diagnostic(historical(spark, sf_dir), SPEC)
    return improvement


# ---------------------------------------------------------------- Spark ML models (M*)
def _glm(spark, sf_dir, kind="glm_gamma"):
    from quotelens.plans.pipeline import evaluate_engineered
    key = ("_ml", kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _ML:
        eng, meta = engineered(spark, sf_dir)
        _ML[key] = evaluate_engineered(eng, meta, SPEC, kind=kind)
    return _ML[key]


_ML: dict = {}


def _split_metrics(ev):
    """Metrics of all parts from written predictions: rows are scored once, not for each pass of the metrics."""
    from quotelens.session import materialize
    scored = materialize(ev.scored.select("_split", "quote_id", T, "prediction"), "scored")
    return M.regression_metrics(scored, T, "prediction", by=["_split"], tiebreak="quote_id")


@register("train_anchor_glm")
def train_anchor_glm(spark, sf_dir):
    """Gamma GLM (log link) on the train part, metrics on all parts (M1, M2, M5)."""
    ev = _glm(spark, sf_dir)
    return _split_metrics(ev)


@register("train_anchor_gbt")
def train_anchor_gbt(spark, sf_dir):
    """Boosted trees on ln(target), back-transformed (M2, M4)."""
    ev = _glm(spark, sf_dir, "gbt_log")
    return _split_metrics(ev)


@register("train_anchor_gamma_boost")
def train_anchor_gamma_boost(spark, sf_dir):
    """Boosted trees on the gamma deviance, stopped by the validation part, metrics on all parts (M2)."""
    ev = _glm(spark, sf_dir, "gamma_boost")
    return _split_metrics(ev)


@register("train_anchor_tweedie_boost")
def train_anchor_tweedie_boost(spark, sf_dir):
    """Boosted trees on the Tweedie deviance of power 1.5 (M4)."""
    ev = _glm(spark, sf_dir, "tweedie_boost")
    return _split_metrics(ev)


TS_SQL = EVAL_SQL + """,
tsr AS (SELECT *, md5('7|' || CAST(quote_id AS VARCHAR)) AS o FROM trw_n),
tsp AS (SELECT sum(training_weight * tgt) / sum(training_weight) AS prior FROM trw_n)"""
_TS = ", ".join(f"""(coalesce(sum(training_weight * tgt) OVER (PARTITION BY {c} ORDER BY o, quote_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + prior)
  / (coalesce(sum(training_weight) OVER (PARTITION BY {c} ORDER BY o, quote_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1) AS ts_{c}""" for c in CAT_F)


@register("ordered_target_statistics", wrap(f"SELECT quote_id, {_TS} FROM tsr, tsp", "quote_id:i, " + ", ".join(f"ts_{c}:d" for c in CAT_F), TS_SQL))
def ordered_target_statistics(spark, sf_dir):
    """Leakage-free encodings of the categorical features over the train part: prefix means in a hashed order (M4)."""
    from quotelens.operators import target_stats
    train = _weighted_train(spark, sf_dir)
    found = target_stats.ordered_statistics(train, "quote_id", CAT_F, T, "training_weight")
    return found.select("quote_id", *[F.col(target_stats.prefix(c)).alias(f"ts_{c}") for c in CAT_F])


def _weighted_train(spark, sf_dir):
    from quotelens.operators.splits import recency_weight
    ev = evaluation(spark, sf_dir)
    train = ev.split.where(F.col("_split") == "train")
    return recency_weight(train, SPEC, as_of=train.agg(F.max("quote_date").alias("c")).first().c)


BOOST_F = ["driver_age", "vehicle_age", "claim_count_3y", "sum_insured"]
BOOST_BINS, BOOST_RATE = 16, 0.2
_EDGES = "[" + ", ".join(f"{i}/{BOOST_BINS}.0" for i in range(1, BOOST_BINS)) + "]"


def _round_sql(r: int) -> str:
    """One tree of one split on the margins of round r - 1 (all features present): gradient sums by bin, gains, leaf values."""
    return f""",
hist{r} AS (SELECT f, b, sum(w * (1 - y * exp(-m{r - 1}))) AS g, sum(w * y * exp(-m{r - 1})) AS h, count(*) AS n
  FROM (SELECT w, y, m{r - 1}, unnest(generate_series(0, {len(BOOST_F) - 1})) AS f, unnest([{', '.join(f'b{i}' for i in range(len(BOOST_F)))}]) AS b FROM mar{r - 1}) GROUP BY f, b),
acc{r} AS (SELECT f, b, sum(g) OVER up AS gl, sum(h) OVER up AS hl, sum(n) OVER up AS nl, sum(g) OVER al AS gt, sum(h) OVER al AS ht, sum(n) OVER al AS nt
  FROM hist{r} WINDOW up AS (PARTITION BY f ORDER BY b ROWS UNBOUNDED PRECEDING), al AS (PARTITION BY f)),
split{r} AS (SELECT f, b, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain,
    -{BOOST_RATE} * gl / (hl + 1) AS lv, -{BOOST_RATE} * (gt - gl) / (ht - hl + 1) AS rv FROM acc{r} WHERE nl >= 20 AND nt - nl >= 20
    QUALIFY row_number() OVER (ORDER BY round(gain, 4) DESC, f, b) = 1),
mar{r} AS (SELECT mar{r - 1}.*, m{r - 1} + CASE WHEN [{', '.join(f'b{i}' for i in range(len(BOOST_F)))}][split{r}.f + 1] <= split{r}.b THEN lv ELSE rv END AS m{r} FROM mar{r - 1}, split{r})"""


BOOST_SQL = EVAL_SQL + f""",
btr AS (SELECT quote_id, tgt AS y, training_weight AS w, {', '.join(BOOST_F)} FROM trw_n WHERE tgt > 0),
edg AS (SELECT {', '.join(f'list_distinct(quantile_cont({f}, {_EDGES})) AS e{i}' for i, f in enumerate(BOOST_F))} FROM btr),
mar0 AS (SELECT quote_id, y, w, {', '.join(f'1 + len(list_filter(e{i}, lambda e: e < {f})) AS b{i}' for i, f in enumerate(BOOST_F))},
  (SELECT ln(sum(w * y) / sum(w)) FROM btr) AS m0 FROM btr, edg)""" + _round_sql(1) + _round_sql(2)


def _stumps(spark, sf_dir, rounds):
    from quotelens.operators import boosting as BO
    train = _weighted_train(spark, sf_dir).where(F.col(T) > 0)
    return train, BO.fit_boosted(train, BOOST_F, T, "training_weight", params=BO.BoostParams(rounds=rounds, depth=1, rate=BOOST_RATE, bins=BOOST_BINS))


@register("boost_first_split", wrap("SELECT f AS feature, b AS bin, round(gain, 4) AS gain, lv AS left_value, rv AS right_value FROM split1",
                                    "feature:i, bin:i, gain:d, left_value:d, right_value:d", BOOST_SQL))
def boost_first_split(spark, sf_dir):
    """The first tree of one split: feature, bin, gain and leaf values on the gamma deviance (M2)."""
    _, model = _stumps(spark, sf_dir, 1)
    t = model.trees[0]
    return spark.createDataFrame([(t["feature"], t["bin"], round(t["gain"], 4), t["left"]["leaf"], t["right"]["leaf"])],
                                 "feature long, bin long, gain double, left_value double, right_value double")


@register("boost_two_rounds", wrap("SELECT quote_id, m2 AS margin FROM mar2", "quote_id:i, margin:d", BOOST_SQL))
def boost_two_rounds(spark, sf_dir):
    """Margins of all train rows after two rounds of one split (M2)."""
    from quotelens.operators import boosting as BO
    train, model = _stumps(spark, sf_dir, 2)
    return BO.margins(model, train, "margin").select("quote_id", "margin")


IMP_SQL = EVAL_SQL + """,
val AS (SELECT quote_id, tgt, vehicle_segment, coverage_type FROM pred WHERE _split = 'validation' AND tgt IS NOT NULL),
rep AS (SELECT unnest(range(5)) AS r),
pl AS (SELECT val.*, r, row_number() OVER (PARTITION BY r ORDER BY md5(CAST(r AS VARCHAR) || '|' || CAST(quote_id AS VARCHAR)), quote_id) AS place
       FROM val, rep),
vl AS (SELECT f, r, CASE f WHEN 'vehicle_segment' THEN vehicle_segment ELSE coverage_type END AS v,
         row_number() OVER (PARTITION BY f, r ORDER BY md5(CAST(r AS VARCHAR) || '|' || f || '|' || CAST(quote_id AS VARCHAR)), quote_id) AS place
       FROM val, rep, (SELECT unnest(['vehicle_segment', 'coverage_type']) AS f)),
cs AS (SELECT vl.f, pl.r, pl.tgt, CASE WHEN vl.f = 'vehicle_segment' THEN vl.v ELSE pl.vehicle_segment END AS vs,
         CASE WHEN vl.f = 'coverage_type' THEN vl.v ELSE pl.coverage_type END AS ct FROM pl JOIN vl ON pl.r = vl.r AND pl.place = vl.place),
sc AS (SELECT cs.f, cs.r, cs.tgt, coalesce(c.cell_mean, (SELECT gm FROM gmean)) AS p FROM cs LEFT JOIN cellm c
         ON cs.vs IS NOT DISTINCT FROM c.vehicle_segment AND cs.ct IS NOT DISTINCT FROM c.coverage_type),
br AS (SELECT 1 - sum(pow(tgt - prediction, 2)) / (sum(pow(tgt, 2)) - pow(sum(tgt), 2) / count(*)) AS r2 FROM pred
       WHERE _split = 'validation' AND tgt IS NOT NULL),
dr AS (SELECT f, r, (SELECT r2 FROM br) - (1 - sum(pow(tgt - p, 2)) / (sum(pow(tgt, 2)) - pow(sum(tgt), 2) / count(*))) AS d FROM sc GROUP BY f, r)"""
_UNUSED = [f for f in CAT_F + NUM_F if f not in ("vehicle_segment", "coverage_type")]


@register("train_anchor_rf")
def train_anchor_rf(spark, sf_dir):
    """Random forest on the raw target (M4)."""
    ev = _glm(spark, sf_dir, "rf")
    return _split_metrics(ev)


@register("train_anchor_log1p")
def train_anchor_log1p(spark, sf_dir):
    """Boosted trees with squared error on ln(1 + target) (M3)."""
    ev = _glm(spark, sf_dir, "gbt_log1p")
    return _split_metrics(ev)


@register("permutation_importance", wrap(
    "SELECT f AS feature, avg(d) AS importance_mean, stddev_pop(d) AS importance_std FROM dr GROUP BY f "
    f"UNION ALL SELECT unnest({_UNUSED!r}), 0.0, 0.0", "feature:s, importance_mean:d, importance_std:d", IMP_SQL))
def permutation_importance(spark, sf_dir):
    """Drop in R2 per permuted feature over all validation rows, 5 repeats, segment-mean model (M6)."""
    ev = evaluation(spark, sf_dir)
    val = ev.split.where(F.col("_split") == "validation")
    return ML.permutation_importance(ev.model, val, "quote_id", SPEC.importance_repeats)


@register("top_drivers")
def top_drivers(spark, sf_dir):
    """Top-15 drivers by permutation importance."""
    ev = _glm(spark, sf_dir)
    val = ev.split.where(F.col("_split") == "validation")
    imp = ML.permutation_importance(ev.model, val, "quote_id", SPEC.importance_repeats)
    return imp.orderBy(F.desc("importance_mean")).limit(15)


_ELIG = ", ".join(
    f"SELECT '{c}' AS competitor, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FILTER (WHERE _split = 'train') "
    f"AS missing_rate_train, count(*) FILTER (WHERE _split = 'train' AND {c} IS NOT NULL) AS n_train, "
    f"count(*) FILTER (WHERE _split = 'validation' AND {c} IS NOT NULL) AS n_validation, "
    f"count(*) FILTER (WHERE _split = 'test' AND {c} IS NOT NULL) AS n_test FROM lb" for c in COMPS)


@register("competitor_model_eligibility", wrap(
    "SELECT *, missing_rate_train <= 0.4 AND n_train >= 20 AND n_validation >= 10 AND n_test >= 10 AS eligible FROM ("
    + _ELIG.replace(", SELECT", " UNION ALL SELECT") + ")",
    "competitor:s, missing_rate_train:d, n_train:i, n_validation:i, n_test:i, eligible:b", EVAL_SQL))
def competitor_model_eligibility(spark, sf_dir):
    """Per competitor: train missing rate and quoted rows per part; model trained if eligible (M7)."""
    ev = evaluation(spark, sf_dir)
    return ML.competitor_eligibility(ev.split, ev.meta.competitor_columns, SPEC.competitor_skip_missing_threshold)


@register("competitor_models")
def competitor_models(spark, sf_dir):
    """One gamma GLM per eligible competitor, unweighted metrics per part."""
    ev = evaluation(spark, sf_dir)
    return ML.competitor_models(ev.split, ev.meta.competitor_columns, ev.features, ev.categorical, ev.numeric, SPEC)


@register("production_window", wrap(
    "SELECT count(*) AS training_rows, min(quote_date) AS training_start, max(quote_date) AS training_cutoff FROM feat "
    "WHERE tgt IS NOT NULL AND quote_date >= (SELECT max(quote_date) FROM feat) - INTERVAL 4 MONTH",
    "training_rows:i, training_start:ts, training_cutoff:ts", FEAT))
def production_window(spark, sf_dir):
    """Latest 4-month window over all rows used by the production refit (M8)."""
    eng, _ = engineered(spark, sf_dir)
    w = ML.production_window(eng, T, SPEC.date_column, SPEC.lookback_months)
    return w.agg(F.count("*").alias("training_rows"), F.min("quote_date").alias("training_start"),
                 F.max("quote_date").alias("training_cutoff"))


@register("production_refit")
def production_refit(spark, sf_dir):
    """Production refit of the gamma GLM on the latest window; predictions over all rows (M8)."""
    eng, meta = engineered(spark, sf_dir)
    from quotelens.operators.features import select_model_features
    from quotelens.operators.splits import recency_weight
    feats, cat, num = select_model_features(eng, SPEC, meta)
    w = ML.production_window(eng, T, SPEC.date_column, SPEC.lookback_months)
    cutoff = w.agg(F.max("quote_date").alias("c")).first().c
    model = ML.fit_price_model(recency_weight(w, SPEC, as_of=cutoff), T, feats, cat, num, kind="glm_gamma",
                               weight="training_weight", date_column=SPEC.date_column)
    return ML.predict(model, eng).select("quote_id", "quote_date", T, "prediction")


_CAL = ["quote_year", "quote_month", "quote_quarter", "quote_weekofyear", "quote_dayofweek", "quote_time_days", "quote_month_sin",
        "quote_month_cos", "quote_dayofweek_sin", "quote_dayofweek_cos"]
_CAL_SQL = (", quote_year, quote_month_num AS quote_month, quote_quarter, quote_weekofyear, quote_dayofweek, quote_time_days, "
            "sin(2 * pi() * quote_month_num / 12) AS quote_month_sin, cos(2 * pi() * quote_month_num / 12) AS quote_month_cos, "
            "sin(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_sin, cos(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_cos")
REF = ("quote_id:i, quote_date:ts, " + T + ":d, channel:s, region:s, vehicle_segment:s, coverage_type:s, driver_age:d, "
       "vehicle_age:d, claim_count_3y:d, sum_insured:d, " + ", ".join(f"{c}:{'d' if c.endswith(('sin', 'cos')) else 'i'}" for c in _CAL)
       + ", prediction:d, residual:d, absolute_error:d")


@register("reference_features", wrap(
    "SELECT quote_id, quote_date, tgt AS " + T + ", channel, region, vehicle_segment, coverage_type, driver_age, "
    "vehicle_age, claim_count_3y, sum_insured" + _CAL_SQL + ", prediction, tgt - prediction AS residual, abs(tgt - prediction) AS "
    "absolute_error FROM pred WHERE _split = 'test'", REF, EVAL_SQL))
def reference_features(spark, sf_dir):
    """Drift reference: test rows with all features, prediction, residual, absolute error (M9)."""
    from quotelens.plans.runs import reference_features as frame
    return frame(evaluation(spark, sf_dir), SPEC)


SEARCH_GRID = [{"regParam": r} for r in (0.0, 0.001, 0.01, 0.1)]


@register("time_validated_search")
def time_validated_search(spark, sf_dir):
    """Parameter search on the time-ordered validation part; trials with running best."""
    ev = evaluation(spark, sf_dir)
    from quotelens.operators.splits import recency_weight
    train = ev.split.where(F.col("_split") == "train")
    cutoff = train.agg(F.max("quote_date").alias("c")).first().c
    trials = ML.time_validated_search(
        recency_weight(train, SPEC, as_of=cutoff), ev.split.where(F.col("_split") == "validation"), T,
        ev.features, ev.categorical, ev.numeric, "glm_gamma", SEARCH_GRID, "mape", weight="training_weight",
        date_column=SPEC.date_column, key="quote_id")
    return ML.best_trial(trials)


TRIAL_SQL = EVAL_SQL + """,
tri AS (SELECT row_number() OVER (ORDER BY region, channel) - 1 AS trial, avg(abs(tgt - prediction) / tgt) * 100 AS value FROM pred WHERE tgt > 0 GROUP BY region, channel),
run AS (SELECT trial, value, min(value) OVER (ORDER BY trial) AS running_best, row_number() OVER (ORDER BY value, trial) = 1 AS is_best FROM tri)"""


def _trial_table(spark, sf_dir):
    """A trial table of the panel: one trial for each region and channel, its value the error there."""
    from pyspark.sql import Window
    scored = evaluation(spark, sf_dir).scored.where(F.col(T) > 0)
    errors = scored.groupBy("region", "channel").agg((F.avg(F.abs(F.col(T) - F.col("prediction")) / F.col(T)) * 100).alias("value"))
    place = (F.row_number().over(Window.orderBy("region", "channel")) - 1).alias("trial")  # a row for each region and channel
    return errors.select(place, "value", F.lit("minimize").alias("direction"))


@register("search_running_best", wrap("SELECT * FROM run", "trial:i, value:d, running_best:d, is_best:b", TRIAL_SQL))
def search_running_best(spark, sf_dir):
    """Running best over a trial table."""
    return ML.best_trial(_trial_table(spark, sf_dir)).select("trial", "value", "running_best", "is_best")


@register("search_best", wrap("SELECT trial, value FROM run WHERE is_best", "trial:i, value:d", TRIAL_SQL))
def search_best(spark, sf_dir):
    """Best trial of a trial table."""
    return ML.best_trial(_trial_table(spark, sf_dir)).where("is_best").select("trial", "value")


@register("halving_search")
def halving_search(spark, sf_dir):
    """Random search of the gamma GLM's ridge by successive halving on the time-ordered validation part."""
    from quotelens.operators.search import halving_search as search
    ev = evaluation(spark, sf_dir)
    return search(_weighted_train(spark, sf_dir), ev.split.where(F.col("_split") == "validation").withColumn("training_weight", F.lit(1.0)), T,
                  ev.features, ev.categorical, ev.numeric, "glm_gamma", SPEC.date_column, trials=6, rungs=2, weight="training_weight", key="quote_id")


# ---------------------------------------------------------------- sources, sinks, artifacts (S*, G*)
import uuid  # noqa: E402

from quotelens.operators import views as V  # noqa: E402
from quotelens.plans.oracle import quotes_cte  # noqa: E402
from quotelens.plans.queries_core import QCOLS  # noqa: E402
from quotelens.session import stage_path  # noqa: E402
from quotelens.sources import io as IO  # noqa: E402
from quotelens.sources import manifest as G  # noqa: E402


def _stage(spark, name):
    return stage_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("scan_csv", wrap("SELECT * FROM quotes", QCOLS, quotes_cte()))
def scan_csv(spark, sf_dir):
    """CSV round trip of the quote panel: write with header, read back with inferred schema."""
    path = _stage(spark, "quotes") + ".csv"
    IO.write_table(panel(spark, sf_dir), path, fmt="csv")
    return IO.load_dataset(spark, path)


@register("sink_roundtrip", wrap(
    "SELECT quote_id, CAST(qmonth AS DATE) AS quote_month, tgt AS " + T + " FROM feat WHERE qmonth IS NOT NULL",
    f"quote_id:i, quote_month:date, {T}:d", FEAT))
def sink_roundtrip(spark, sf_dir):
    """Market table written as parquet partitioned by month and read back whole."""
    eng, _ = engineered(spark, sf_dir)
    path = _stage(spark, "market")
    IO.write_table(V.add_month(eng, SPEC.date_column).select("quote_id", V.MONTH, T), path,
                   partition_by=[V.MONTH])
    return IO.load_dataset(spark, path)


@register("handoff_export", wrap(
    "SELECT quote_id, quote_date, _split, prediction FROM pred WHERE quote_date >= TIMESTAMP '1997-01-01' "
    "AND quote_date <= TIMESTAMP '2000-12-31' AND region IN ('EUROPE', 'ASIA') AND _split IN ('train', 'validation')",
    "quote_id:i, quote_date:ts, _split:s, prediction:d", EVAL_SQL))
def handoff_export(spark, sf_dir):
    """Filtered view exported as CSV and read back (V1 + S7)."""
    ev = evaluation(spark, sf_dir)
    f = V.apply_filters(ev.scored, SPEC.date_column, "1997-01-01", "2000-12-31", {"region": ["EUROPE", "ASIA"]},
                        ["train", "validation"]).select("quote_id", "quote_date", "_split", "prediction")
    path = _stage(spark, "handoff") + ".csv"
    IO.export_filtered(f, path)
    return IO.load_dataset(spark, path, "quote_id long, quote_date timestamp_ntz, _split string, prediction double")


@register("score_anchor")
def score_anchor(spark, sf_dir):
    """Frozen anchor model saved, hashed, loaded and used to batch-score raw quotes."""
    from quotelens.operators.anchors import model_digest, score_anchor as score
    ev = evaluation(spark, sf_dir)
    path = _stage(spark, "model")
    ML.save_model(ev.model, path)
    digest = model_digest(spark, path)
    loaded = ML.load_model(spark, path)
    return score(panel(spark, sf_dir), SPEC, loaded, digest)


def _artifacts(spark, sf_dir):
    ev = evaluation(spark, sf_dir)
    root = _stage(spark, "run")
    arts = {"model": root + "/model", "market_data": root + "/market_data", "quality": root + "/data_quality"}
    ML.save_model(ev.model, arts["model"])
    IO.write_table(ev.scored.select("quote_id", "quote_date", "_split", T, "prediction"), arts["market_data"])
    IO.write_records(C.quality_profile(panel(spark, sf_dir), SPEC), arts["quality"])
    return arts


@register("artifact_manifest")
def artifact_manifest(spark, sf_dir):
    """Manifest of run artifacts: sha-256 and bytes per artifact, config hash."""
    arts = _artifacts(spark, sf_dir)
    return G.artifact_manifest(spark, arts, {"spec": repr(SPEC)}).drop("path")


@register("manifest_verify")
def manifest_verify(spark, sf_dir):
    """Listed vs recomputed hashes: verified / mismatch / missing."""
    arts = _artifacts(spark, sf_dir)
    listed = G.read_manifest(spark, G.write_manifest(G.artifact_manifest(spark, arts), _stage(spark, "manifest")))
    IO.write_table(panel(spark, sf_dir).limit(0), arts["market_data"])  # stale artifact replaced
    return G.verify_manifest(spark, listed, arts).select("artifact", "status")


@register("stream_score")
def stream_score(spark, sf_dir):
    """Quote files scored incrementally by a Structured Streaming job with a checkpoint (C1 on a stream)."""
    from quotelens.streaming.score_stream import score_stream
    ev = evaluation(spark, sf_dir)
    src, out = _stage(spark, "stream-in"), _stage(spark, "stream-out")
    q = panel(spark, sf_dir)
    IO.write_table(q, src)
    query = score_stream(spark, src, q.schema, SPEC, ev.model, out, _stage(spark, "stream-ckpt"))
    query.awaitTermination()
    return spark.read.parquet(out)


# ---------------------------------------------------------------- remaining inventory items
_PRESENT = ", ".join(f"count({'quote_date' if c.startswith('quote_') else c}) AS {c}" for c in CAT_F + NUM_F)


@register("model_features", wrap(
    "SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS position, feature, CASE WHEN feature IN ('" + "', '".join(CAT_F) + "') THEN 'categorical' "
    f"ELSE 'numeric' END AS kind, n_present FROM (UNPIVOT (SELECT {_PRESENT} FROM feat) ON {', '.join(CAT_F + NUM_F)} INTO NAME feature VALUE n_present)",
    "position:i, feature:s, kind:s, n_present:i", FEAT))
def model_features(spark, sf_dir):
    """Model features after leakage exclusions, in order, with the rows that have each."""
    from quotelens.operators.features import select_model_features
    eng, meta = engineered(spark, sf_dir)
    feats, cat, _ = select_model_features(eng, SPEC, meta)
    present = eng.agg(*[F.count(f).alias(f) for f in feats]).unpivot([], feats, "feature", "n_present")
    places = spark.createDataFrame([(i, f, "categorical" if f in cat else "numeric") for i, f in enumerate(feats)],
                                   "position long, feature string, kind string")
    return places.join(present, "feature").select("position", "feature", "kind", "n_present")


_TR = "(SELECT * FROM lb WHERE _split = 'train' AND tgt IS NOT NULL AND tgt > 0)"


@register("impute_encode", wrap(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, quantile_cont({c}, 0.5) AS median, NULL AS mode, CAST(0 AS BIGINT) AS levels FROM {_TR} t"
                       for c in ("driver_age", "vehicle_age", "claim_count_3y", "sum_insured"))
    + "".join(f" UNION ALL SELECT '{c}', NULL, (SELECT {c} FROM {_TR} u WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), "
              f"count(DISTINCT {c}) FROM {_TR} t" for c in CAT_F),
    "feature:s, median:d, mode:s, levels:i", EVAL_SQL))
def impute_encode(spark, sf_dir):
    """What the preprocessing learns from the train part: exact medians, most frequent levels, level counts (M1)."""
    from quotelens.functions.quantiles import grouped_quantiles
    ev = evaluation(spark, sf_dir)
    train = ev.split.where((F.col("_split") == "train") & (F.col(T) > 0))
    plain = ["driver_age", "vehicle_age", "claim_count_3y", "sum_insured"]
    long = train.select(*[F.col(c).cast("double").alias(c) for c in plain]).unpivot([], plain, "c", "v")
    rows = [(c, q[0], None, 0) for c, q in grouped_quantiles(long, "c", "v", [0.5]).items()]
    rows += [(c, None, mode, n) for c, (mode, n) in ML.category_levels(train, CAT_F).items()]
    return spark.createDataFrame(rows, "feature string, median double, mode string, levels long")


@register("basket_index")
def basket_index(spark, sf_dir):
    """Fixed-basket price index per month scored with the gamma GLM."""
    from quotelens.operators import basket as B
    from quotelens.plans.queries_model import CATS, NUMS
    ev = _glm(spark, sf_dir)
    train = ev.split.where(F.col("_split") == "train")
    basket = B.reference_basket(train, list(CATS), list(NUMS))
    return B.basket_index(basket, ev.model, ev.split, SPEC.date_column)


def _per_competitor_predictions(spark, sf_dir):
    from quotelens.operators.splits import recency_weight
    from quotelens.plans.pipeline import ANCHOR_CELLS
    ev = evaluation(spark, sf_dir)
    out = ev.scored
    for c in ev.meta.competitor_columns:
        train = ev.split.where((F.col("_split") == "train") & F.col(c).isNotNull())
        cutoff = train.agg(F.max("quote_date").alias("m")).first().m
        m = ML.fit_price_model(recency_weight(train, SPEC, as_of=cutoff), c, [], list(ANCHOR_CELLS), [],
                               kind="segment_mean", weight="training_weight", cells=list(ANCHOR_CELLS))
        out = ML.predict(m, out, f"pred_{c}")
    preds = [f"pred_{c}" for c in ev.meta.competitor_columns]
    s = F.sort_array(F.array(*[F.col(p) for p in preds]))
    return V.add_month(out.withColumn("derived_top3", (F.get(s, 0) + F.get(s, 1) + F.get(s, 2)) / 3.0),
                       SPEC.date_column)


_PC = ",\n".join(
    f"""c_{c} AS (SELECT vehicle_segment, coverage_type, sum(w * {c}) / sum(w) AS cm FROM (
      SELECT *, pow(0.5, greatest(floor((epoch_us((SELECT max(quote_date) FROM lb WHERE _split = 'train'
        AND {c} IS NOT NULL)) - epoch_us(quote_date)) / 86400000000.0), 0) / 60.0) AS w
      FROM lb WHERE _split = 'train' AND {c} IS NOT NULL) GROUP BY 1, 2),
g_{c} AS (SELECT sum(w * {c}) / sum(w) AS gm FROM (
      SELECT *, pow(0.5, greatest(floor((epoch_us((SELECT max(quote_date) FROM lb WHERE _split = 'train'
        AND {c} IS NOT NULL)) - epoch_us(quote_date)) / 86400000000.0), 0) / 60.0) AS w
      FROM lb WHERE _split = 'train' AND {c} IS NOT NULL))""" for c in COMPS)
_JOINS = " ".join(
    f"LEFT JOIN c_{c} ON p.vehicle_segment IS NOT DISTINCT FROM c_{c}.vehicle_segment AND p.coverage_type "
    f"IS NOT DISTINCT FROM c_{c}.coverage_type" for c in COMPS)
_PREDS = "[" + ", ".join(f"coalesce(c_{c}.cm, (SELECT gm FROM g_{c}))" for c in COMPS) + "]"


@register("derived_top3", wrap(
    "SELECT CAST(qmonth AS DATE) AS quote_month, _split, avg(derived_top3) AS mean_derived_top3, "
    "avg(prediction) AS mean_prediction, avg(tgt) AS mean_actual FROM (SELECT p.*, (list_sort(" + _PREDS
    + ")[1] + list_sort(" + _PREDS + ")[2] + list_sort(" + _PREDS + ")[3]) / 3.0 AS derived_top3 FROM pred p "
    + _JOINS + ") GROUP BY 1, 2",
    "quote_month:date, _split:s, mean_derived_top3:d, mean_prediction:d, mean_actual:d",
    EVAL_SQL + ",\n" + _PC))
def derived_top3(spark, sf_dir):
    """Top-3 mean derived from per-competitor anchors vs the aggregate anchor vs actual, by month."""
    d = _per_competitor_predictions(spark, sf_dir)
    return d.groupBy(V.MONTH, "_split").agg(
        F.avg("derived_top3").alias("mean_derived_top3"), F.avg("prediction").alias("mean_prediction"),
        F.avg(T).alias("mean_actual"))


@register("current_performance", wrap(
    "SELECT * FROM " + metrics_sql("cp", []), "d2:d, r2:d, rmse:d, rmsle:d, mae:d, mape:d, mean_bias:d, "
    "mean_bias_pct:d, gini:d, n:i",
    EVAL_SQL + """,
cp AS (SELECT f.*, coalesce(c.cell_mean, (SELECT gm FROM gmean)) AS prediction FROM feat f
       LEFT JOIN cellm c ON f.vehicle_segment IS NOT DISTINCT FROM c.vehicle_segment
        AND f.coverage_type IS NOT DISTINCT FROM c.coverage_type
       WHERE f.quote_date >= TIMESTAMP '2000-01-01')"""))
def current_performance(spark, sf_dir):
    """Accuracy of the frozen anchor on current (from 2000) quotes that have a target."""
    from quotelens.plans.queries_model import sides
    ev = evaluation(spark, sf_dir)
    _, cur = sides(spark, sf_dir)
    return M.regression_metrics(ML.predict(ev.model, cur), T, "prediction", tiebreak="quote_id")
