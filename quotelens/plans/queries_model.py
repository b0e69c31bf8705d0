"""Registered queries: splits, weights, evaluation metrics, models, anchors, basket, drift, QA."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelens.operators import metrics as M
from quotelens.operators import splits as S
from quotelens.plans.oracle import eval_ctes, features_ctes, metrics_sql, split_ctes, wrap
from quotelens.plans.pipeline import evaluate_engineered
from quotelens.plans.registry import SPEC, engineered, panel, register

T = SPEC.target_column
FEAT = features_ctes()
SPLIT_SQL = FEAT + ",\n" + split_ctes()
EVAL_SQL = SPLIT_SQL + ",\n" + eval_ctes()
EXPLICIT = {"train_end_date": "1999-06-30", "validation_end_date": "2000-06-30"}

_EVAL_CACHE: dict = {}


def evaluation(spark, sf_dir):
    """The segment-mean evaluation run over the quote panel (memoised per session and folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EVAL_CACHE:
        eng, meta = engineered(spark, sf_dir)
        _EVAL_CACHE[key] = evaluate_engineered(eng, meta, SPEC)
    return _EVAL_CACHE[key]


# ---------------------------------------------------------------- splits (T*)
@register("time_split", wrap("SELECT quote_id, _split FROM labelled", "quote_id:i, _split:s", SPLIT_SQL))
def time_split(spark, sf_dir):
    """Fraction split by exact date order statistics; ties go to the earlier part."""
    eng, _ = engineered(spark, sf_dir)
    return S.time_split(eng, SPEC).select("quote_id", S.SPLIT)


@register("time_split_dates", wrap("SELECT quote_id, _split FROM labelled", "quote_id:i, _split:s",
                                   FEAT + ",\n" + split_ctes("1999-06-30", "2000-06-30")))
def time_split_dates(spark, sf_dir):
    """Split at explicit cut-off dates."""
    eng, _ = engineered(spark, sf_dir)
    return S.time_split(eng, SPEC.with_(**EXPLICIT)).select("quote_id", S.SPLIT)


@register("split_metadata", wrap(
    "SELECT _split, count(*) AS rows, CAST(min(quote_date) AS DATE) AS date_min, "
    "CAST(max(quote_date) AS DATE) AS date_max FROM labelled GROUP BY 1",
    "_split:s, rows:i, date_min:date, date_max:date", SPLIT_SQL))
def split_metadata(spark, sf_dir):
    """Rows and date range per part (T4)."""
    eng, _ = engineered(spark, sf_dir)
    return S.split_metadata(S.time_split(eng, SPEC), SPEC)


@register("train_lookback", wrap("SELECT quote_id, _split FROM lb", "quote_id:i, _split:s", EVAL_SQL))
def train_lookback(spark, sf_dir):
    """Train rows within 4 months of the last train date; other parts kept (T5)."""
    return evaluation(spark, sf_dir).split.select("quote_id", S.SPLIT)


@register("sample_weight", wrap(
    "SELECT quote_id, coalesce(claim_count_3y, 0.0) AS sample_weight FROM quotes",
    "quote_id:i, sample_weight:d", FEAT))
def sample_weight(spark, sf_dir):
    """Portfolio weight with NULL as 0 and a guard on negatives (T6), weight = claim count."""
    return S.sample_weight(panel(spark, sf_dir), SPEC.with_(weight_column="claim_count_3y")).select(
        "quote_id", "sample_weight")


@register("recency_weight", wrap("SELECT quote_id, training_weight FROM trw_n", "quote_id:i, training_weight:d",
                                 EVAL_SQL))
def recency_weight(spark, sf_dir):
    """0.5 ** (age days / 60) as of the last train date, over the mean positive weight."""
    ev = evaluation(spark, sf_dir)
    train = ev.split.where(F.col(S.SPLIT) == "train")
    cutoff = train.agg(F.max("quote_date").alias("c")).first().c
    return S.recency_weight(train, SPEC, as_of=cutoff).select("quote_id", "training_weight")


MD_COLS = ("quote_id:i, quote_date:ts, channel:s, region:s, vehicle_segment:s, coverage_type:s, driver_age:d, "
           "vehicle_age:d, claim_count_3y:d, sum_insured:d, own_premium:d, converted:i, "
           "comp_a_premium:d, comp_b_premium:d, comp_c_premium:d, comp_d_premium:d, comp_e_premium:d, "
           f"avg_top_3_competitor_premium:d, avg_top_5_competitor_premium:d, competitor_count:i, "
           "competitor_panel_signature:s, top_n_competitor_signature:s, market_price_index:d, "
           "rank_own_premium:d, _split:s")


_CALENDAR = ("quote_year:i, quote_month:i, quote_quarter:i, quote_weekofyear:i, quote_dayofweek:i, quote_time_days:i, quote_month_sin:d, "
             "quote_month_cos:d, quote_dayofweek_sin:d, quote_dayofweek_cos:d")


@register("market_data", wrap(
    "SELECT *, quote_month_num AS quote_month, sin(2 * pi() * quote_month_num / 12) AS quote_month_sin, cos(2 * pi() * quote_month_num / 12) AS quote_month_cos, "
    "sin(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_sin, cos(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_cos FROM lb",
    f"{MD_COLS}, {_CALENDAR}", EVAL_SQL))
def market_data(spark, sf_dir):
    """Role and market columns of all parts labelled by split."""
    ev = evaluation(spark, sf_dir)
    md = S.market_data(ev.split, SPEC, ev.meta)
    return md.select(*[c.split(":")[0] for c in f"{MD_COLS}, {_CALENDAR}".split(", ")])


# ---------------------------------------------------------------- metrics (E*)
PF = "quote_id:i, quote_date:ts, _split:s, prediction:d, residual:d, absolute_error:d, absolute_percentage_error:d"


@register("prediction_frame", wrap(
    "SELECT quote_id, quote_date, _split, prediction, tgt - prediction AS residual, "
    "abs(tgt - prediction) AS absolute_error, abs(tgt - prediction) / NULLIF(tgt, 0) * 100 "
    "AS absolute_percentage_error, tgt AS " + T + " FROM pred", PF + f", {T}:d", EVAL_SQL))
def prediction_frame(spark, sf_dir):
    """Prediction frame of the three parts."""
    ev = evaluation(spark, sf_dir)
    return M.prediction_frame(ev.scored, SPEC, T)


METRICS = "d2:d, r2:d, rmse:d, rmsle:d, mae:d, mape:d, mean_bias:d, mean_bias_pct:d, gini:d, n:i"


@register("metrics_by_split", wrap("SELECT * FROM " + metrics_sql("pred", ["_split"]),
                                   "_split:s, " + METRICS, EVAL_SQL))
def metrics_by_split(spark, sf_dir):
    """E1-E10 per split."""
    ev = evaluation(spark, sf_dir)
    return M.regression_metrics(ev.scored, T, "prediction", by=[S.SPLIT], tiebreak="quote_id")


@register("regression_metrics", wrap(
    "SELECT * FROM " + metrics_sql("(SELECT * FROM pred WHERE _split = 'test')", []), METRICS, EVAL_SQL))
def regression_metrics(spark, sf_dir):
    """RMSE, MAE, MAPE, bias, bias %, RMSLE, D2, R2, Gini, n on the test part."""
    ev = evaluation(spark, sf_dir)
    return M.regression_metrics(ev.scored.where(F.col(S.SPLIT) == "test"), T, "prediction", tiebreak="quote_id")


@register("gini", wrap("SELECT _split, gini FROM " + metrics_sql("pred", ["_split"]), "_split:s, gini:d", EVAL_SQL))
def gini(spark, sf_dir):
    """Normalised Gini per split, ties by quote id."""
    ev = evaluation(spark, sf_dir)
    return M.gini(ev.scored, T, "prediction", by=[S.SPLIT], tiebreak="quote_id")


@register("lift_table", wrap("""
SELECT b + 1 AS quantile, count(*) AS n, round(avg(prediction), 4) AS mean_predicted, round(avg(tgt), 4) AS mean_actual,
  round(avg(tgt) / (SELECT avg(tgt) FROM t), 4) AS lift, round(avg(prediction) / NULLIF(avg(tgt), 0), 4) AS pred_actual_ratio
FROM (SELECT t.*, least(9, (SELECT count(*) FROM unnest(e.edges[2:10]) x(v) WHERE v <= t.prediction)) AS b
      FROM t, (SELECT quantile_cont(prediction, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q,
                      list_prepend(min(prediction), q) AS edges FROM t) e) z
GROUP BY b""", "quantile:i, n:i, mean_predicted:d, mean_actual:d, lift:d, pred_actual_ratio:d",
    EVAL_SQL + ",\nt AS (SELECT * FROM pred WHERE _split = 'test')"))
def lift_table(spark, sf_dir):
    """Decile lift table of the test part."""
    ev = evaluation(spark, sf_dir)
    return M.lift_table(ev.scored.where(F.col(S.SPLIT) == "test"), T, "prediction")


# ---------------------------------------------------------------- rolling anchors (H*)
from quotelens.operators import anchors as A  # noqa: E402
from quotelens.operators import basket as B  # noqa: E402
from quotelens.plans.pipeline import ANCHOR_CELLS  # noqa: E402

HIST_SQL = FEAT + """,
rows AS (SELECT *, date_trunc('month', quote_date) AS period FROM feat WHERE quote_date IS NOT NULL),
periods AS (SELECT DISTINCT period FROM rows),
contrib AS (
  SELECT p.period, r.vehicle_segment, r.coverage_type, r.tgt, r.quote_date,
    pow(0.5, greatest(floor((epoch_us(p.period) - epoch_us(r.quote_date)) / 86400000000.0), 0) / 60.0) AS w
  FROM rows r JOIN periods p ON r.quote_date >= p.period - INTERVAL 4 MONTH AND r.quote_date < p.period
  WHERE r.tgt IS NOT NULL),
pp AS (SELECT period, count(*) AS n, min(quote_date) AS st, max(quote_date) AS cu, sum(w * tgt) / sum(w) AS gm
       FROM contrib GROUP BY period HAVING count(*) >= 200),
pc AS (SELECT period, vehicle_segment, coverage_type, sum(w * tgt) / sum(w) AS cm FROM contrib GROUP BY ALL),
hist0 AS (
  SELECT r.*, CASE WHEN pp.gm IS NOT NULL THEN coalesce(pc.cm, pp.gm) END AS market_anchor,
    pp.st AS anchor_training_start, pp.cu AS anchor_training_cutoff, pp.n AS anchor_training_rows
  FROM rows r LEFT JOIN pp ON pp.period = r.period
  LEFT JOIN pc ON pc.period = r.period AND pc.vehicle_segment IS NOT DISTINCT FROM r.vehicle_segment
              AND pc.coverage_type IS NOT DISTINCT FROM r.coverage_type),
hist AS (
  SELECT *, (CASE WHEN own_premium IS NOT NULL THEN greatest(own_premium, 1e-6) END) / (CASE WHEN market_anchor IS NOT NULL THEN greatest(market_anchor, 1e-6) END) AS relative_price_ratio,
    ln((CASE WHEN own_premium IS NOT NULL THEN greatest(own_premium, 1e-6) END) / (CASE WHEN market_anchor IS NOT NULL THEN greatest(market_anchor, 1e-6) END)) AS log_relative_price,
    (CASE WHEN own_premium IS NOT NULL THEN greatest(own_premium, 1e-6) END) - (CASE WHEN market_anchor IS NOT NULL THEN greatest(market_anchor, 1e-6) END) AS price_gap_to_market_anchor
  FROM hist0)"""

_HIST_CACHE: dict = {}


def historical(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HIST_CACHE:
        eng, _ = engineered(spark, sf_dir)
        _HIST_CACHE[key] = A.historical_features(eng, SPEC, cells=list(ANCHOR_CELLS))
    return _HIST_CACHE[key]


HA = ("quote_id:i, market_anchor:d, relative_price_ratio:d, log_relative_price:d, price_gap_to_market_anchor:d, "
      "anchor_training_start:ts, anchor_training_cutoff:ts, anchor_training_rows:d")


@register("historical_anchor_segmean", wrap(
    "SELECT " + ", ".join(c.split(":")[0] for c in HA.split(", ")) + " FROM hist", HA, HIST_SQL))
def historical_anchor_segmean(spark, sf_dir):
    """Rolling-origin anchors, 4-month look-back, warm-up unscored (H1, H3), segment-mean model."""
    return historical(spark, sf_dir).select(*[c.split(":")[0] for c in HA.split(", ")])


@register("relative_price", wrap(
    "SELECT quote_id, relative_price_ratio, log_relative_price, price_gap_to_market_anchor FROM hist",
    "quote_id:i, relative_price_ratio:d, log_relative_price:d, price_gap_to_market_anchor:d", HIST_SQL))
def relative_price(spark, sf_dir):
    """Own price relative to the anchor, floored at 1e-6 (H3)."""
    return historical(spark, sf_dir).select("quote_id", "relative_price_ratio", "log_relative_price",
                                            "price_gap_to_market_anchor")


HW = "quote_month:date, anchor_training_start:ts, anchor_training_cutoff:ts, anchor_training_rows:d, rows_scored:i"


@register("historical_windows", wrap(
    "SELECT CAST(period AS DATE) AS quote_month, min(anchor_training_start) AS anchor_training_start, "
    "max(anchor_training_cutoff) AS anchor_training_cutoff, max(anchor_training_rows) AS anchor_training_rows, "
    "count(*) AS rows_scored FROM hist WHERE market_anchor IS NOT NULL GROUP BY 1", HW, HIST_SQL))
def historical_windows(spark, sf_dir):
    """Training window provenance per scored month (H2)."""
    return A.historical_windows(historical(spark, sf_dir), SPEC)


HO = ("quote_id:i, quote_date:ts, channel:s, region:s, vehicle_segment:s, coverage_type:s, driver_age:d, "
      "vehicle_age:d, claim_count_3y:d, sum_insured:d, own_premium:d, converted:i, "
      f"{T}:d, market_anchor:d, relative_price_ratio:d, log_relative_price:d, price_gap_to_market_anchor:d, "
      "anchor_training_start:ts, anchor_training_cutoff:ts, anchor_training_rows:d, anchor_method:s, "
      "anchor_is_frozen_for_optimization:b, anchor_model_backend:s")


@register("handoff_columns", wrap(
    "SELECT * REPLACE (tgt AS " + T + "), 'rolling_origin_finite_lookback' AS anchor_method, "
    "TRUE AS anchor_is_frozen_for_optimization, 'segment_mean' AS anchor_model_backend FROM hist", HO, HIST_SQL))
def handoff_columns(spark, sf_dir):
    """Hand-off projection with provenance flags (H4)."""
    return historical(spark, sf_dir)


@register("historical_summary", wrap(
    "SELECT count(*) AS rows_total, count(market_anchor) AS rows_scored, "
    "count(*) FILTER (WHERE market_anchor IS NULL) AS rows_warmup_unscored, "
    "count(DISTINCT CASE WHEN market_anchor IS NOT NULL THEN date_trunc('month', quote_date) END) AS periods_scored FROM hist",
    "rows_total:i, rows_scored:i, rows_warmup_unscored:i, periods_scored:i", HIST_SQL))
def historical_summary(spark, sf_dir):
    """Rows total / scored / warm-up and months scored (H5)."""
    return A.historical_summary(historical(spark, sf_dir), SPEC.date_column)


@register("historical_anchor_glm_segment", wrap(
    "SELECT r.quote_id, gs.cm AS market_anchor, pp.st AS anchor_training_start, pp.cu AS anchor_training_cutoff, pp.n AS anchor_training_rows "
    "FROM rows r LEFT JOIN pp ON pp.period = r.period LEFT JOIN gs ON gs.period = pp.period AND gs.vehicle_segment = r.vehicle_segment",
    "quote_id:i, market_anchor:d, anchor_training_start:ts, anchor_training_cutoff:ts, anchor_training_rows:d",
    HIST_SQL + """,
gs AS (SELECT period, vehicle_segment, sum(w * tgt) / sum(w) AS cm FROM contrib GROUP BY ALL)"""))
def historical_anchor_glm_segment(spark, sf_dir):
    """The batched monthly GLM with one categorical feature: its means are the weighted means by month and level (H1)."""
    eng, _ = engineered(spark, sf_dir)
    return A.rolling_glm_anchor(eng, SPEC, ["vehicle_segment"], []).select(
        "quote_id", "market_anchor", "anchor_training_start", "anchor_training_cutoff", "anchor_training_rows")


@register("historical_anchor_glm")
def historical_anchor_glm(spark, sf_dir):
    """Rolling-origin anchors with a gamma GLM of all features for each month, all months in one batched fit (H1)."""
    eng, meta = engineered(spark, sf_dir)
    from quotelens.operators.features import select_model_features
    feats, cat, num = select_model_features(eng, SPEC, meta)
    return A.historical_features(eng, SPEC, kind="glm_gamma", features=feats, categorical=cat, numeric=num)


# ---------------------------------------------------------------- scoring (C*)
SC = ("quote_id:i, quote_date:ts, market_anchor:d, own_premium:d, relative_price_ratio:d, log_relative_price:d, "
      "price_gap_to_market_anchor:d, anchor_training_cutoff:s, prediction_horizon_days:i")


@register("score_projection", wrap("""
SELECT q.quote_id, q.quote_date, greatest(coalesce(c.cell_mean, (SELECT gm FROM gmean)), 1e-6) AS market_anchor,
  (CASE WHEN q.own_premium IS NOT NULL THEN greatest(q.own_premium, 1e-6) END) AS own_premium,
  (CASE WHEN q.own_premium IS NOT NULL THEN greatest(q.own_premium, 1e-6) END) / greatest(coalesce(c.cell_mean, (SELECT gm FROM gmean)), 1e-6) AS relative_price_ratio,
  ln((CASE WHEN q.own_premium IS NOT NULL THEN greatest(q.own_premium, 1e-6) END) / greatest(coalesce(c.cell_mean, (SELECT gm FROM gmean)), 1e-6)) AS log_relative_price,
  (CASE WHEN q.own_premium IS NOT NULL THEN greatest(q.own_premium, 1e-6) END) - greatest(coalesce(c.cell_mean, (SELECT gm FROM gmean)), 1e-6) AS price_gap_to_market_anchor,
  strftime((SELECT max(quote_date) FROM trw_n), '%Y-%m-%d %H:%M:%S') AS anchor_training_cutoff,
  CAST(floor((epoch_us(q.quote_date) - epoch_us((SELECT max(quote_date) FROM trw_n))) / 86400000000.0) AS BIGINT)
    AS prediction_horizon_days
FROM quotes q LEFT JOIN cellm c ON q.vehicle_segment IS NOT DISTINCT FROM c.vehicle_segment
  AND q.coverage_type IS NOT DISTINCT FROM c.coverage_type""", SC, EVAL_SQL))
def score_projection(spark, sf_dir):
    """Batch scoring of raw quotes with the frozen anchor model; horizon from its cutoff."""
    ev = evaluation(spark, sf_dir)
    out = A.score_anchor(panel(spark, sf_dir), SPEC, ev.model)
    return out.select(*[c.split(":")[0] for c in SC.split(", ")])


# ---------------------------------------------------------------- basket (B*)
NUMS = ("driver_age", "vehicle_age", "claim_count_3y", "sum_insured")
CATS = ("channel", "region", "vehicle_segment", "coverage_type")
LEVELS_SQL = EVAL_SQL + ",\ntr AS (SELECT * FROM lb WHERE _split = 'train'),\nlv AS (" + " UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", list(DISTINCT {c} ORDER BY {c}) AS vals FROM tr WHERE {c} IS NOT NULL" for c in CATS]
    + [f"SELECT '{c}', list_transform(list_sort(list_distinct([round_even(quantile_cont({c}, 0.25), 1), "
       f"round_even(quantile_cont({c}, 0.5), 1), round_even(quantile_cont({c}, 0.75), 1)])), lambda x: CAST(x AS VARCHAR)) "
       f"FROM tr" for c in NUMS]) + ")"


@register("basket_levels", wrap(
    "SELECT \"column\", CAST(i - 1 AS BIGINT) AS position, vals[i] AS level FROM lv, "
    "LATERAL (SELECT unnest(range(1, len(vals) + 1)) AS i)", "column:s, position:i, level:s", LEVELS_SQL))
def basket_levels(spark, sf_dir):
    """Basket levels: categorical values and rounded quartiles of the train part (B1, B2)."""
    ev = evaluation(spark, sf_dir)
    train = ev.split.where(F.col(S.SPLIT) == "train")
    return B.levels_frame(train, list(CATS), list(NUMS))


_dims = list(CATS) + list(NUMS)
_basket_sel = []
_stride = "1"
for _c in reversed(_dims):
    _size = f"(SELECT len(vals) FROM lv WHERE \"column\" = '{_c}')"
    _digit = f"CAST((basket_id // ({_stride})) % {_size} AS BIGINT)"
    _val = f"(SELECT vals FROM lv WHERE \"column\" = '{_c}')[{_digit} + 1]"
    _basket_sel.append(f"{_val} AS {_c}" if _c in CATS else f"CAST({_val} AS DOUBLE) AS {_c}")
    _stride = f"{_stride} * {_size}"
_total = " * ".join(f"(SELECT len(vals) FROM lv WHERE \"column\" = '{c}')" for c in _dims)
BASKET_SQL = LEVELS_SQL + f""",
ids AS (SELECT range AS basket_id FROM range(0, (SELECT {_total}))),
basket AS (SELECT basket_id, {", ".join(reversed(_basket_sel))} FROM ids)"""


@register("reference_basket", wrap(
    "SELECT * FROM basket", "basket_id:i, " + ", ".join(f"{c}:s" for c in CATS) + ", "
    + ", ".join(f"{c}:d" for c in NUMS), BASKET_SQL))
def reference_basket(spark, sf_dir):
    """Cross product of all levels."""
    ev = evaluation(spark, sf_dir)
    train = ev.split.where(F.col(S.SPLIT) == "train")
    return B.reference_basket(train, list(CATS), list(NUMS))


@register("basket_index_segmean", wrap("""
SELECT CAST(m AS DATE) AS quote_month, avg(p) AS mean_prediction, quantile_cont(p, 0.25) AS p25_prediction,
  quantile_cont(p, 0.75) AS p75_prediction, count(*) AS n_profiles
FROM (SELECT m.m, greatest(coalesce(c.cell_mean, (SELECT gm FROM gmean)), 0) AS p
      FROM basket b CROSS JOIN (SELECT unnest(generate_series(date_trunc('month', min(quote_date)),
                                date_trunc('month', max(quote_date)), INTERVAL 1 MONTH)) AS m FROM lb) m
      LEFT JOIN cellm c ON b.vehicle_segment IS NOT DISTINCT FROM c.vehicle_segment
        AND b.coverage_type IS NOT DISTINCT FROM c.coverage_type) z GROUP BY 1""",
    "quote_month:date, mean_prediction:d, p25_prediction:d, p75_prediction:d, n_profiles:i", BASKET_SQL))
def basket_index_segmean(spark, sf_dir):
    """Fixed-basket index per month under the segment-mean anchor."""
    ev = evaluation(spark, sf_dir)
    train = ev.split.where(F.col(S.SPLIT) == "train")
    basket = B.reference_basket(train, list(CATS), list(NUMS))
    return B.basket_index(basket, ev.model, ev.split, SPEC.date_column)


# ---------------------------------------------------------------- drift and monitoring (O*)
from quotelens.operators import contract as C  # noqa: E402
from quotelens.operators import drift as D  # noqa: E402

CURRENT_FROM = "2000-01-01"
CAT_F = ["channel", "region", "vehicle_segment", "coverage_type"]
NUM_F = ["driver_age", "vehicle_age", "claim_count_3y", "sum_insured", "quote_year", "quote_month",
         "quote_quarter", "quote_weekofyear", "quote_dayofweek", "quote_time_days", "quote_month_sin",
         "quote_month_cos", "quote_dayofweek_sin", "quote_dayofweek_cos"]


def sides(spark, sf_dir):
    """Engineered quotes split into reference (before 2000) and current (from 2000) data."""
    eng, _ = engineered(spark, sf_dir)
    cut = S.ts_lit(CURRENT_FROM)
    return eng.where(F.col("quote_date") < cut), eng.where(F.col("quote_date") >= cut)


def _drift_sql(cat, num):
    num_vals = ", ".join(f"CAST({c} AS DOUBLE)" for c in num)
    return FEAT + f""",
dd AS (SELECT *, quote_month_num AS quote_month, sin(2 * pi() * quote_month_num / 12) AS quote_month_sin,
         cos(2 * pi() * quote_month_num / 12) AS quote_month_cos, sin(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_sin,
         cos(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_cos,
         CASE WHEN quote_date < TIMESTAMP '{CURRENT_FROM}' THEN 'ref' ELSE 'cur' END AS side
       FROM feat),
nl AS (SELECT side, f.feature, f.x FROM dd, LATERAL (SELECT unnest({num!r}) AS feature, unnest([{num_vals}]) AS x) f
       WHERE f.x IS NOT NULL AND NOT isnan(f.x)),
cl AS (SELECT side, f.feature, coalesce(f.v, '__missing__') AS label FROM dd,
       LATERAL (SELECT unnest({cat!r}) AS feature, unnest([{", ".join(f"CAST({c} AS VARCHAR)" for c in cat)}]) AS v) f),
ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])))
              AS edges, count(DISTINCT x) AS nuniq FROM nl WHERE side = 'ref' GROUP BY feature),
nb AS (SELECT nl.side, nl.feature, CAST(len(list_filter(ed.edges[2:len(ed.edges) - 1], lambda e: e < nl.x)) AS VARCHAR) AS label
       FROM nl JOIN ed USING (feature)
       WHERE ed.nuniq > 2 AND len(ed.edges) >= 3 AND nl.x >= ed.edges[1] AND nl.x <= ed.edges[len(ed.edges)]),
nt AS (SELECT nl.side, nl.feature, CAST(nl.x AS VARCHAR) AS label FROM nl JOIN ed USING (feature)
       WHERE ed.nuniq <= 2 OR len(ed.edges) < 3),
allv AS (SELECT * FROM nb UNION ALL SELECT * FROM nt UNION ALL SELECT * FROM cl),
sh AS (SELECT side, feature, label, count(*) / sum(count(*)) OVER (PARTITION BY side, feature) AS share
       FROM allv GROUP BY side, feature, label),
ee AS (SELECT * FROM sh WHERE side = 'ref'), aa AS (SELECT * FROM sh WHERE side = 'cur'),
psi AS (SELECT coalesce(ee.feature, aa.feature) AS feature,
          sum((greatest(coalesce(aa.share, 0), 1e-6) - greatest(coalesce(ee.share, 0), 1e-6))
              * ln(greatest(coalesce(aa.share, 0), 1e-6) / greatest(coalesce(ee.share, 0), 1e-6))) AS psi
        FROM ee FULL OUTER JOIN aa ON ee.feature = aa.feature AND ee.label = aa.label
        WHERE coalesce(ee.feature, aa.feature) IN (SELECT feature FROM aa) GROUP BY 1),
names AS (SELECT * FROM (VALUES {", ".join(f"('{c}', 'categorical')" for c in cat)}{", " if cat and num else ""}{", ".join(f"('{c}', 'numeric')" for c in num)}) v(feature, type)),
dt AS (SELECT names.feature, names.type, coalesce(psi.psi, 0.0) AS psi FROM names LEFT JOIN psi USING (feature))"""


@register("drift_table", wrap(
    "SELECT feature, type, psi, CASE WHEN psi >= 0.2 THEN 'review' ELSE 'ok' END AS status, "
    "printf('PSI %.4f', psi) AS detail FROM dt", "feature:s, type:s, psi:d, status:s, detail:s",
    _drift_sql(CAT_F, NUM_F)))
def drift_table(spark, sf_dir):
    """PSI of every model feature, reference (pre-2000) vs current quotes, with review status."""
    ref, cur = sides(spark, sf_dir)
    return D.drift_table(ref, cur, CAT_F + NUM_F, set(CAT_F), SPEC.limit("psi"))


@register("psi_categorical", wrap("SELECT feature, psi FROM dt", "feature:s, psi:d", _drift_sql(CAT_F, [])))
def psi_categorical(spark, sf_dir):
    """PSI of every categorical, NULL as its own label (O2)."""
    ref, cur = sides(spark, sf_dir)
    return D.drift_psi(ref, cur, [], CAT_F).select("feature", "psi")


@register("psi_numeric", wrap("SELECT feature, psi FROM dt", "feature:s, psi:d", _drift_sql([], NUM_F)))
def psi_numeric(spark, sf_dir):
    """PSI of every numeric feature over reference deciles, out-of-range values dropped (O3)."""
    ref, cur = sides(spark, sf_dir)
    return D.drift_psi(ref, cur, NUM_F, []).select("feature", "psi")


@register("psi_distribution", wrap("""
SELECT coalesce(ee.label, aa.label) AS label, ee.share AS expected_share, aa.share AS actual_share,
  (greatest(coalesce(aa.share, 0), 1e-6) - greatest(coalesce(ee.share, 0), 1e-6))
    * ln(greatest(coalesce(aa.share, 0), 1e-6) / greatest(coalesce(ee.share, 0), 1e-6)) AS contribution
FROM ee FULL OUTER JOIN aa ON ee.label = aa.label""",
    "label:s, expected_share:d, actual_share:d, contribution:d", _drift_sql(["vehicle_segment"], [])))
def psi_distribution(spark, sf_dir):
    """Per-label PSI terms of two share distributions (O1), vehicle segment."""
    ref, cur = sides(spark, sf_dir)
    e = D._shares(ref.select(F.coalesce("vehicle_segment", F.lit(D.MISSING)).alias("v")), [], "v")
    a = D._shares(cur.select(F.coalesce("vehicle_segment", F.lit(D.MISSING)).alias("v")), [], "v")
    j = e.select("label", F.col("share").alias("expected_share")).join(
        a.select("label", F.col("share").alias("actual_share")), "label", "full_outer")
    ev = F.greatest(F.coalesce("expected_share", F.lit(0.0)), F.lit(D.EPS))
    av = F.greatest(F.coalesce("actual_share", F.lit(0.0)), F.lit(D.EPS))
    return j.withColumn("contribution", (av - ev) * F.log(av / ev))


@register("coverage_drops", wrap("""
SELECT b.competitor, b.r AS baseline_rate, c.r AS current_rate, b.r - c.r AS coverage_drop
FROM (SELECT competitor, avg(CASE WHEN premium > 0 THEN 1.0 ELSE 0.0 END) AS r FROM lq WHERE side = 'ref' GROUP BY 1) b
JOIN (SELECT competitor, avg(CASE WHEN premium > 0 THEN 1.0 ELSE 0.0 END) AS r FROM lq WHERE side = 'cur' GROUP BY 1) c
USING (competitor)""", "competitor:s, baseline_rate:d, current_rate:d, coverage_drop:d",
    FEAT + f""",
lq AS (SELECT CASE WHEN quote_date < TIMESTAMP '{CURRENT_FROM}' THEN 'ref' ELSE 'cur' END AS side, c.competitor, c.premium
       FROM quotes, LATERAL (SELECT unnest(['comp_a_premium', 'comp_b_premium', 'comp_c_premium', 'comp_d_premium',
       'comp_e_premium']) AS competitor, unnest([comp_a_premium, comp_b_premium, comp_c_premium, comp_d_premium,
       comp_e_premium]) AS premium) c)"""))
def coverage_drops(spark, sf_dir):
    """Quote-rate drop per competitor, reference vs current raw quotes."""
    q = panel(spark, sf_dir)
    cut = S.ts_lit(CURRENT_FROM)
    ref, cur = q.where(F.col("quote_date") < cut), q.where(F.col("quote_date") >= cut)
    return D.coverage_drops(C.competitor_quote_rates(ref, SPEC), C.competitor_quote_rates(cur, SPEC))


@register("market_health", wrap(f"""
SELECT count(*) FILTER (WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ["comp_a_premium", "comp_b_premium", "comp_c_premium", "comp_d_premium", "comp_e_premium"])}) / count(*) AS complete_panel_rate,
  count(*) FILTER (WHERE ({" + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in ["comp_a_premium", "comp_b_premium", "comp_c_premium", "comp_d_premium", "comp_e_premium"])}) >= 3) / count(*) AS target_available_rate,
  (SELECT mean_bias_pct FROM {metrics_sql("cp", [])}) AS mean_anchor_bias_pct,
  CAST(floor((epoch_us(max(quote_date)) - epoch_us((SELECT max(quote_date) FROM trw_n))) / 86400000000.0) AS BIGINT)
    AS prediction_horizon_days
FROM quotes WHERE quote_date >= TIMESTAMP '{CURRENT_FROM}'""",
    "complete_panel_rate:d, target_available_rate:d, mean_anchor_bias_pct:d, prediction_horizon_days:i",
    EVAL_SQL + f""",
cp AS (SELECT f.*, coalesce(c.cell_mean, (SELECT gm FROM gmean)) AS prediction FROM feat f
       LEFT JOIN cellm c ON f.vehicle_segment IS NOT DISTINCT FROM c.vehicle_segment
        AND f.coverage_type IS NOT DISTINCT FROM c.coverage_type
       WHERE f.quote_date >= TIMESTAMP '{CURRENT_FROM}')"""))
def market_health(spark, sf_dir):
    """Complete-panel and target-available rates, anchor bias % and horizon of current quotes."""
    from quotelens.operators.models import predict
    ev = evaluation(spark, sf_dir)
    q = panel(spark, sf_dir)
    cut = S.ts_lit(CURRENT_FROM)
    cur_raw = q.where(F.col("quote_date") >= cut)
    prof = C.quality_profile(cur_raw, SPEC)
    _, cur = sides(spark, sf_dir)
    perf = M.regression_metrics(predict(ev.model, cur), T, "prediction", with_gini=False)
    horizon = D.prediction_horizon(cur_raw, "quote_date", ev.model.training_cutoff).first()[0]
    bias = perf.first().mean_bias_pct
    return prof.select(
        (F.col("rows_with_complete_competitor_panel") / F.greatest(F.col("rows"), F.lit(1))).alias("complete_panel_rate"),
        (F.col("rows_with_enough_competitors") / F.greatest(F.col("rows"), F.lit(1))).alias("target_available_rate"),
        F.lit(bias).cast("double").alias("mean_anchor_bias_pct"),
        F.lit(horizon).cast("long").alias("prediction_horizon_days"))


def _refresh_sql():
    drift = _drift_sql(CAT_F, NUM_F)[len(FEAT):]
    comps = ["comp_a_premium", "comp_b_premium", "comp_c_premium", "comp_d_premium", "comp_e_premium"]
    return EVAL_SQL + drift + f""",
lq AS (SELECT CASE WHEN quote_date < TIMESTAMP '{CURRENT_FROM}' THEN 'ref' ELSE 'cur' END AS side, c.competitor, c.premium
       FROM quotes, LATERAL (SELECT unnest({comps!r}) AS competitor, unnest([{", ".join(comps)}]) AS premium) c),
drops AS (SELECT b.competitor, b.r - c.r AS d FROM
          (SELECT competitor, avg(CASE WHEN premium > 0 THEN 1.0 ELSE 0.0 END) AS r FROM lq WHERE side = 'ref' GROUP BY 1) b
          JOIN (SELECT competitor, avg(CASE WHEN premium > 0 THEN 1.0 ELSE 0.0 END) AS r FROM lq WHERE side = 'cur' GROUP BY 1) c
          USING (competitor)),
hz AS (SELECT CAST(floor((epoch_us(max(quote_date)) - epoch_us((SELECT max(quote_date) FROM trw_n))) / 86400000000.0)
              AS BIGINT) AS h FROM quotes WHERE quote_date >= TIMESTAMP '{CURRENT_FROM}'),
cp AS (SELECT f.*, coalesce(c.cell_mean, (SELECT gm FROM gmean)) AS prediction FROM feat f
       LEFT JOIN cellm c ON f.vehicle_segment IS NOT DISTINCT FROM c.vehicle_segment
        AND f.coverage_type IS NOT DISTINCT FROM c.coverage_type
       WHERE f.quote_date >= TIMESTAMP '{CURRENT_FROM}'),
mb AS (SELECT * FROM {metrics_sql("(SELECT * FROM pred WHERE _split = 'test')", [])}),
mc AS (SELECT * FROM {metrics_sql("cp", [])}),
measured AS (
  SELECT 'drift' AS "trigger", 'features' AS subject, CAST(count(*) AS DOUBLE) AS worsening FROM dt WHERE psi >= 0.2
  UNION ALL SELECT 'horizon', 'newest quote', CAST(h AS DOUBLE) FROM hz
  UNION ALL SELECT 'coverage', competitor, d FROM drops
  UNION ALL SELECT 'd2', 'accuracy', mb.d2 - mc.d2 FROM mb, mc
  UNION ALL SELECT 'rmse', 'accuracy', mc.rmse - mb.rmse FROM mb, mc
  UNION ALL SELECT 'gini', 'accuracy', mb.gini - mc.gini FROM mb, mc
  UNION ALL SELECT 'mape', 'accuracy', mc.mape - mb.mape FROM mb, mc),
limits AS (SELECT * FROM (VALUES ('drift', 0.0), ('horizon', 90.0), ('coverage', {SPEC.limit('coverage')}), ('d2', {SPEC.limit('d2')}),
  ('rmse', {SPEC.limit('rmse')}), ('gini', {SPEC.limit('gini')}), ('mape', {SPEC.limit('mape')})) v("trigger", "limit")),
reasons AS (
  SELECT "trigger", subject, worsening, "limit" FROM measured JOIN limits USING ("trigger")
  WHERE CASE WHEN "trigger" IN ('drift', 'horizon') THEN worsening > "limit" ELSE worsening >= "limit" END
     OR ("trigger" = 'd2' AND worsening IS NULL))"""


@register("refresh_reasons", wrap("SELECT * FROM reasons", "trigger:s, subject:s, worsening:d, limit:d", _refresh_sql()))
def refresh_reasons(spark, sf_dir):
    """Retraining triggers: drift, horizon, coverage drops, D2/RMSE/Gini/MAPE changes."""
    from quotelens.operators.models import predict
    ev = evaluation(spark, sf_dir)
    ref, cur = sides(spark, sf_dir)
    drift = D.drift_table(ref, cur, CAT_F + NUM_F, set(CAT_F), SPEC.limit("psi"))
    q = panel(spark, sf_dir)
    cut = S.ts_lit(CURRENT_FROM)
    drops = D.coverage_drops(C.competitor_quote_rates(q.where(F.col("quote_date") < cut), SPEC),
                             C.competitor_quote_rates(q.where(F.col("quote_date") >= cut), SPEC))
    horizon = D.prediction_horizon(q.where(F.col("quote_date") >= cut), "quote_date",
                                   ev.model.training_cutoff).first()[0]
    base = M.regression_metrics(ev.scored.where(F.col(S.SPLIT) == "test"), T, "prediction",
                                tiebreak="quote_id").first().asDict()
    now = M.regression_metrics(predict(ev.model, cur), T, "prediction", tiebreak="quote_id").first().asDict()
    return D.refresh_reasons(drift, horizon, drops, base, now, SPEC)
