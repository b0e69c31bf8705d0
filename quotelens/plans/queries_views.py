"""Registered queries: dashboard views (V*) over the split-labelled market table with
predictions (segment-mean anchor) and over the rolling-anchor hand-off table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelens.operators import views as V
from quotelens.plans.oracle import COMPS, wrap
from quotelens.plans.queries_model import BASKET_SQL, EVAL_SQL, HIST_SQL, evaluation, historical
from quotelens.plans.registry import SPEC, register

T = SPEC.target_column
RATIO = f"own_to_{T}_ratio"
GAP = f"price_gap_to_{T}"
MK_SQL = EVAL_SQL + ",\nmk AS (SELECT *, CAST(qmonth AS DATE) AS quote_month, own_ratio AS ratio, own_gap AS gap FROM pred)"
HK_SQL = HIST_SQL + ",\nhk AS (SELECT *, CAST(date_trunc('month', quote_date) AS DATE) AS quote_month FROM hist)"
PROFILE = {"region": ["EUROPE", "ASIA"], "vehicle_segment": ["BUILDING", "AUTOMOBILE", "MACHINERY"]}
AGE_RANGE = (25.0, 60.0)
PROFILE_SQL = ("region IN ('EUROPE', 'ASIA') AND vehicle_segment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY') "
               f"AND driver_age BETWEEN {AGE_RANGE[0]} AND {AGE_RANGE[1]}")


def market(spark, sf_dir):
    """Market table: engineered quotes after the look-back, labelled by split, with predictions."""
    return V.add_month(evaluation(spark, sf_dir).scored, SPEC.date_column)


def profile(spark, sf_dir):
    m = market(spark, sf_dir)
    f = V.apply_filters(m, SPEC.date_column, segment_filters=PROFILE)
    return f.where(F.col("driver_age").between(*AGE_RANGE))


def hk(spark, sf_dir):
    return V.add_month(historical(spark, sf_dir), SPEC.date_column)


def cols(spec: str) -> list[str]:
    return [c.split(":")[0].strip() for c in spec.split(",")]


# ---------------------------------------------------------------- filters and segments
@register("dash_filter", wrap(
    "SELECT quote_id, _split FROM mk WHERE quote_date >= TIMESTAMP '1997-01-01' AND quote_date <= TIMESTAMP "
    "'2000-12-31' AND region IN ('EUROPE', 'ASIA') AND _split IN ('train', 'validation')",
    "quote_id:i, _split:s", MK_SQL))
def dash_filter(spark, sf_dir):
    """Common filter: date range, segment lists, splits (V1)."""
    return V.apply_filters(market(spark, sf_dir), SPEC.date_column, "1997-01-01", "2000-12-31",
                           {"region": ["EUROPE", "ASIA"], "channel": []}, ["train", "validation"]
                           ).select("quote_id", "_split")


SEG_CANDS = ["channel", "region", "vehicle_segment", "coverage_type", "driver_age", "vehicle_age",
             "claim_count_3y", "sum_insured", "competitor_panel_signature", "top_n_competitor_signature"]
SEG_STR = {"channel", "region", "vehicle_segment", "coverage_type", "competitor_panel_signature", "top_n_competitor_signature"}


@register("segment_columns", wrap(
    "SELECT col AS \"column\", n AS n_distinct, row_number() OVER (ORDER BY pr, n, col) AS rank FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(DISTINCT {c}) AS n, {0 if c == 'region' else 1 if c == 'channel' else 2} AS pr, "
        f"{'TRUE' if c in SEG_STR else 'FALSE'} AS is_str FROM mk" for c in SEG_CANDS)
    + ") WHERE is_str OR (n BETWEEN 2 AND 30)", "column:s, n_distinct:i, rank:i", MK_SQL))
def segment_columns(spark, sf_dir):
    """Segment detection: text columns, others with 2-30 distinct values; priority then cardinality (V3)."""
    m = market(spark, sf_dir).select(*SEG_CANDS)
    return V.segment_columns(m, set(), priority=["region", "channel"])


# ---------------------------------------------------------------- market overview
@register("avg_topn_by_month", wrap(
    "SELECT quote_month, s.series, avg(s.value) AS value FROM mk, LATERAL (SELECT unnest(['avg_top_3_competitor_premium', "
    "'avg_top_5_competitor_premium']) AS series, unnest([avg_top_3_competitor_premium, avg_top_5_competitor_premium]) "
    "AS value) s GROUP BY 1, 2", "quote_month:date, series:s, value:d", MK_SQL))
def avg_topn_by_month(spark, sf_dir):
    """Average of each top-N market price by month, melted (V4)."""
    return V.monthly_means(market(spark, sf_dir), ["avg_top_3_competitor_premium", "avg_top_5_competitor_premium"])


@register("own_vs_market", wrap(
    f"SELECT quote_month, s.series, avg(s.value) AS value FROM mk, LATERAL (SELECT unnest(['own_premium', '{T}']) "
    "AS series, unnest([own_premium, tgt]) AS value) s GROUP BY 1, 2", "quote_month:date, series:s, value:d", MK_SQL))
def own_vs_market(spark, sf_dir):
    """Own premium vs market target by month (V5)."""
    return V.monthly_means(market(spark, sf_dir), ["own_premium", T])


@register("ratio_by_month", wrap(
    "SELECT quote_month, _split, avg(ratio) AS own_to_market_ratio FROM mk GROUP BY 1, 2",
    "quote_month:date, _split:s, own_to_market_ratio:d", MK_SQL))
def ratio_by_month(spark, sf_dir):
    """Own-to-market ratio by month and split (V6)."""
    return V.grouped_means(market(spark, sf_dir), [V.MONTH, "_split"], {"own_to_market_ratio": F.col(RATIO)})


@register("conversion_by_ratio", wrap("""
SELECT b AS bin, (e.edges[b + 1] + e.edges[b + 2]) / 2 AS bin_mid, avg(converted) AS conversion_rate, count(*) AS n
FROM (SELECT ratio, converted, len(list_filter(e.edges[2:25], lambda v: v < ratio)) AS b FROM mk, e
      WHERE ratio IS NOT NULL) z, e GROUP BY b, e.edges""", "bin:i, bin_mid:d, conversion_rate:d, n:i",
    MK_SQL + """,
e AS (SELECT list_transform(range(0, 26), lambda i: CASE WHEN i = 0 THEN lo - (hi - lo) * 0.001
        WHEN i = 25 THEN hi ELSE lo + i * ((hi - lo) / 25) END) AS edges
      FROM (SELECT min(ratio) AS lo, max(ratio) AS hi FROM mk))"""))
def conversion_by_ratio(spark, sf_dir):
    """Conversion rate over 25 equal-width bins of the own-to-market ratio, bin midpoints (V7)."""
    m = market(spark, sf_dir).where(F.col(RATIO).isNotNull())
    return V.equal_width_bins(m, RATIO, 25, {"conversion_rate": F.avg("converted"), "n": F.count("*")})


_LONG = ("LATERAL (SELECT unnest(['" + "', '".join(COMPS) + "']) AS competitor, unnest(["
         + ", ".join(COMPS) + "]) AS premium) c")


@register("premium_box", wrap(
    f"SELECT quote_month, c.competitor, min(c.premium) AS min, quantile_cont(c.premium, 0.25) AS q1, "
    f"quantile_cont(c.premium, 0.5) AS median, quantile_cont(c.premium, 0.75) AS q3, max(c.premium) AS max "
    f"FROM mk, {_LONG} WHERE c.premium IS NOT NULL GROUP BY 1, 2",
    "quote_month:date, competitor:s, min:d, q1:d, median:d, q3:d, max:d", MK_SQL))
def premium_box(spark, sf_dir):
    """Competitor premium distribution (min, quartiles, max) by month (V8)."""
    m = market(spark, sf_dir)
    long = m.select(V.MONTH, *COMPS).unpivot([V.MONTH], COMPS, "competitor", "premium")
    return V.box_stats(long, [V.MONTH, "competitor"], "premium")


@register("index_heatmap", wrap(
    "SELECT region, channel, avg(market_price_index) AS mean_market_price_index FROM mk GROUP BY 1, 2",
    "region:s, channel:s, mean_market_price_index:d", MK_SQL))
def index_heatmap(spark, sf_dir):
    """Market price index by region and channel, long form, all levels."""
    return V.heat_map(market(spark, sf_dir), "region", "channel", "market_price_index")


@register("competitor_curves", wrap(
    f"SELECT quote_month, c.competitor, avg(c.premium) AS mean_premium FROM mk, {_LONG} GROUP BY 1, 2",
    "quote_month:date, competitor:s, mean_premium:d", MK_SQL))
def competitor_curves(spark, sf_dir):
    """Mean premium per competitor by month."""
    return V.monthly_means(market(spark, sf_dir), COMPS, series_name="competitor", value_name="mean_premium")


@register("missing_rate", wrap(
    f"SELECT quote_month, c.competitor, 100 * (1 - avg(CASE WHEN c.premium IS NOT NULL THEN 1.0 ELSE 0.0 END)) "
    f"AS missing_pct FROM mk, {_LONG} GROUP BY 1, 2", "quote_month:date, competitor:s, missing_pct:d", MK_SQL))
def missing_rate(spark, sf_dir):
    """Missing-quote % per competitor and month."""
    m = market(spark, sf_dir)
    long = m.select(V.MONTH, *COMPS).unpivot([V.MONTH], COMPS, "competitor", "premium")
    return long.groupBy(V.MONTH, "competitor").agg(
        (100 * (1 - F.avg(F.col("premium").isNotNull().cast("double")))).alias("missing_pct"))


@register("competitor_aggressiveness", wrap(
    "SELECT region, c.competitor, round(avg(c.premium) / (SELECT avg(c2.premium) FROM mk, LATERAL (SELECT unnest(["
    + ", ".join(COMPS) + "]) AS premium) c2), 3) AS aggressiveness FROM mk, " + _LONG + " GROUP BY 1, 2",
    "region:s, competitor:s, aggressiveness:d", MK_SQL))
def competitor_aggressiveness(spark, sf_dir):
    """Competitor mean premium per region over the mean of all quoted cells, round 3."""
    m = market(spark, sf_dir)
    long = m.select("region", *COMPS).unpivot(["region"], COMPS, "competitor", "premium")
    overall = long.agg(F.avg("premium").alias("a")).first().a
    return long.groupBy("region", "competitor").agg(
        F.round(F.avg("premium") / F.lit(overall), 3).alias("aggressiveness"))


# ---------------------------------------------------------------- accuracy views
@register("actual_vs_predicted", wrap(
    "SELECT quote_month, _split, avg(tgt) AS mean_actual, avg(prediction) AS mean_predicted FROM mk GROUP BY 1, 2",
    "quote_month:date, _split:s, mean_actual:d, mean_predicted:d", MK_SQL))
def actual_vs_predicted(spark, sf_dir):
    """Actual vs predicted target by month and split."""
    return V.grouped_means(market(spark, sf_dir), [V.MONTH, "_split"],
                           {"mean_actual": F.col(T), "mean_predicted": F.col("prediction")})


@register("rank_share", wrap(
    "SELECT quote_month, rank_own_premium, count(*) AS count, round(count(*) / sum(count(*)) OVER "
    "(PARTITION BY quote_month) * 100, 1) AS share_pct FROM mk GROUP BY 1, 2",
    "quote_month:date, rank_own_premium:d, count:i, share_pct:d", MK_SQL))
def rank_share(spark, sf_dir):
    """Share % of each own-price rank by month, NULL rank its own group."""
    return V.share_by(market(spark, sf_dir), [V.MONTH], "rank_own_premium")


@register("rank_hist", wrap("SELECT rank_own_premium, count(*) AS n FROM mk GROUP BY 1",
                            "rank_own_premium:d, n:i", MK_SQL))
def rank_hist(spark, sf_dir):
    """Own-price rank histogram."""
    return market(spark, sf_dir).groupBy("rank_own_premium").agg(F.count("*").alias("n"))


@register("gap_by_segment", wrap("SELECT quote_month, region, avg(gap) AS mean_gap FROM mk GROUP BY 1, 2",
                                 "quote_month:date, region:s, mean_gap:d", MK_SQL))
def gap_by_segment(spark, sf_dir):
    """Price gap to market by month and region."""
    return V.grouped_means(market(spark, sf_dir), [V.MONTH, "region"], {"mean_gap": F.col(GAP)})


@register("dispersion_by_month", wrap(
    "SELECT quote_month, avg(competitor_premium_std) AS mean_dispersion FROM mk GROUP BY 1",
    "quote_month:date, mean_dispersion:d", MK_SQL))
def dispersion_by_month(spark, sf_dir):
    """Mean row dispersion of competitor prices by month."""
    return V.grouped_means(market(spark, sf_dir), [V.MONTH], {"mean_dispersion": F.col("competitor_premium_std")})


@register("residual_by_month", wrap(
    "SELECT quote_month, _split, avg(tgt - prediction) AS mean_residual FROM mk GROUP BY 1, 2",
    "quote_month:date, _split:s, mean_residual:d", MK_SQL))
def residual_by_month(spark, sf_dir):
    """Mean residual by month and split."""
    return V.grouped_means(market(spark, sf_dir), [V.MONTH, "_split"],
                           {"mean_residual": F.col(T) - F.col("prediction")})


@register("residual_by_segment", wrap(
    "SELECT quote_month, region, avg(tgt - prediction) AS mean_residual FROM mk WHERE _split = 'test' GROUP BY 1, 2",
    "quote_month:date, region:s, mean_residual:d", MK_SQL))
def residual_by_segment(spark, sf_dir):
    """Mean residual by month and region on the test part."""
    m = market(spark, sf_dir).where(F.col("_split") == "test")
    return V.grouped_means(m, [V.MONTH, "region"], {"mean_residual": F.col(T) - F.col("prediction")})


@register("prediction_band", wrap(
    "SELECT quote_month, avg(prediction) AS mean_prediction, stddev_samp(prediction) AS std_prediction "
    "FROM mk GROUP BY 1", "quote_month:date, mean_prediction:d, std_prediction:d", MK_SQL))
def prediction_band(spark, sf_dir):
    """Prediction mean and standard deviation by month."""
    return market(spark, sf_dir).groupBy(V.MONTH).agg(
        F.avg("prediction").alias("mean_prediction"), F.stddev_samp("prediction").alias("std_prediction"))


_APE = "abs(tgt - prediction) / NULLIF(tgt, 0) * 100"


def _ape():
    return F.abs(F.col(T) - F.col("prediction")) / F.when(F.col(T) != 0, F.col(T)) * 100


@register("mape_by_month_segment", wrap(
    f"SELECT quote_month, region, avg({_APE}) AS mape FROM mk GROUP BY 1, 2",
    "quote_month:date, region:s, mape:d", MK_SQL))
def mape_by_month_segment(spark, sf_dir):
    """MAPE by month and region."""
    return V.grouped_means(market(spark, sf_dir), [V.MONTH, "region"], {"mape": _ape()})


@register("segment_mape", wrap(f"SELECT region, avg({_APE}) AS mape, count(*) AS n FROM mk GROUP BY 1",
                               "region:s, mape:d, n:i", MK_SQL))
def segment_mape(spark, sf_dir):
    """Segments by MAPE."""
    return market(spark, sf_dir).groupBy("region").agg(F.avg(_ape()).alias("mape"), F.count("*").alias("n")) \
        .orderBy(F.desc("mape"))


@register("scatter_bounds", wrap(
    "SELECT _split, count(*) AS n, min(tgt) AS min_actual, max(tgt) AS max_actual, min(prediction) AS min_predicted, "
    "max(prediction) AS max_predicted FROM mk WHERE tgt IS NOT NULL AND prediction IS NOT NULL GROUP BY 1",
    "_split:s, n:i, min_actual:d, max_actual:d, min_predicted:d, max_predicted:d", MK_SQL))
def scatter_bounds(spark, sf_dir):
    """Actual-vs-predicted scatter extent per split."""
    m = market(spark, sf_dir).where(F.col(T).isNotNull() & F.col("prediction").isNotNull())
    return m.groupBy("_split").agg(F.count("*").alias("n"), F.min(T).alias("min_actual"), F.max(T).alias("max_actual"),
                                   F.min("prediction").alias("min_predicted"), F.max("prediction").alias("max_predicted"))


@register("scatter_points", wrap(
    "SELECT quote_id, _split, tgt AS actual, prediction FROM mk WHERE tgt IS NOT NULL AND prediction IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY _split ORDER BY md5(CAST(quote_id AS VARCHAR)), quote_id) <= 500",
    "quote_id:i, _split:s, actual:d, prediction:d", MK_SQL))
def scatter_points(spark, sf_dir):
    """Actual-vs-predicted points: 500 of each split by hash order."""
    m = market(spark, sf_dir).where(F.col(T).isNotNull() & F.col("prediction").isNotNull()).withColumn("actual", F.col(T))
    return V.scatter_points(m, "quote_id", ["actual", "prediction"], ["_split"])


# ---------------------------------------------------------------- positioning
POS = ("region:s, channel:s, mean_own:d, mean_target:d, mean_ratio:d, mean_rank:d, mean_gap:d, action:s")


@register("segment_positioning", wrap(
    "SELECT region, channel, round(avg(own_premium), 3) AS mean_own, round(avg(tgt), 3) AS mean_target, "
    "round(avg(ratio), 3) AS mean_ratio, round(avg(rank_own_premium), 3) AS mean_rank, round(avg(gap), 3) AS mean_gap, "
    "CASE WHEN round(avg(ratio), 3) > 1.10 THEN 'reduce' WHEN round(avg(ratio), 3) < 0.90 THEN 'opportunity' "
    "ELSE 'hold' END AS action FROM mk GROUP BY 1, 2", POS, MK_SQL))
def segment_positioning(spark, sf_dir):
    """Mean own, target, ratio, rank, gap per segment (round 3) and the recommended action."""
    m = market(spark, sf_dir)
    g = m.groupBy("region", "channel").agg(
        F.round(F.avg("own_premium"), 3).alias("mean_own"), F.round(F.avg(T), 3).alias("mean_target"),
        F.round(F.avg(RATIO), 3).alias("mean_ratio"), F.round(F.avg("rank_own_premium"), 3).alias("mean_rank"),
        F.round(F.avg(GAP), 3).alias("mean_gap"))
    r = F.col("mean_ratio")
    return g.withColumn("action", F.when(r > 1.10, "reduce").when(r < 0.90, "opportunity").otherwise("hold"))


@register("opportunity_map", wrap(
    "SELECT region, channel, avg(gap) AS mean_gap, avg(rank_own_premium) AS mean_rank, count(*) AS n FROM mk GROUP BY 1, 2",
    "region:s, channel:s, mean_gap:d, mean_rank:d, n:i", MK_SQL))
def opportunity_map(spark, sf_dir):
    """Mean gap and rank by segment."""
    return market(spark, sf_dir).groupBy("region", "channel").agg(
        F.avg(GAP).alias("mean_gap"), F.avg("rank_own_premium").alias("mean_rank"), F.count("*").alias("n"))


# ---------------------------------------------------------------- profile views
@register("profile_filter", wrap(
    f"SELECT count(*) FILTER (WHERE {PROFILE_SQL}) AS matched_rows, "
    f"100.0 * count(*) FILTER (WHERE {PROFILE_SQL}) / count(*) AS matched_pct FROM mk",
    "matched_rows:i, matched_pct:d", MK_SQL))
def profile_filter(spark, sf_dir):
    """Profile filter (categorical lists + driver age range): matched rows and %."""
    total = market(spark, sf_dir).count()
    return profile(spark, sf_dir).agg(F.count("*").alias("matched_rows")).withColumn(
        "matched_pct", F.col("matched_rows") * 100.0 / F.lit(total))


@register("profile_prices", wrap(
    "SELECT quote_month, s.series, avg(s.value) AS value, max(n) AS n_quotes FROM (SELECT *, count(*) OVER "
    "(PARTITION BY quote_month) AS n FROM mk WHERE " + PROFILE_SQL + ") p, LATERAL (SELECT unnest(['own_premium', '"
    + "', '".join(COMPS) + "']) AS series, unnest([own_premium, " + ", ".join(COMPS) + "]) AS value) s GROUP BY 1, 2",
    "quote_month:date, series:s, value:d, n_quotes:i", MK_SQL))
def profile_prices(spark, sf_dir):
    """Own and competitor prices of the profile by month, with monthly counts."""
    p = profile(spark, sf_dir)
    n = p.groupBy(V.MONTH).agg(F.count("*").alias("n_quotes"))
    return V.monthly_means(p, ["own_premium", *COMPS]).join(n, V.MONTH)


@register("profile_ratio", wrap(
    "SELECT quote_month, avg(ratio) AS mean_ratio, CASE WHEN avg(ratio) > 1.05 THEN 'above' WHEN avg(ratio) < 0.95 "
    "THEN 'below' ELSE 'at' END AS band FROM mk WHERE " + PROFILE_SQL + " GROUP BY 1",
    "quote_month:date, mean_ratio:d, band:s", MK_SQL))
def profile_ratio(spark, sf_dir):
    """Profile own-to-market ratio by month with a +/-5 % band."""
    g = profile(spark, sf_dir).groupBy(V.MONTH).agg(F.avg(RATIO).alias("mean_ratio"))
    r = F.col("mean_ratio")
    return g.withColumn("band", F.when(r > 1.05, "above").when(r < 0.95, "below").otherwise("at"))


@register("profile_rank_share", wrap(
    "SELECT quote_month, rank_own_premium, count(*) AS count, round(count(*) / sum(count(*)) OVER "
    "(PARTITION BY quote_month) * 100, 1) AS share_pct FROM mk WHERE " + PROFILE_SQL + " GROUP BY 1, 2",
    "quote_month:date, rank_own_premium:d, count:i, share_pct:d", MK_SQL))
def profile_rank_share(spark, sf_dir):
    """Profile own-rank share % by month."""
    return V.share_by(profile(spark, sf_dir), [V.MONTH], "rank_own_premium")


@register("conversion_by_month", wrap(
    "SELECT quote_month, avg(converted) AS conversion_rate, count(*) AS n FROM mk GROUP BY 1",
    "quote_month:date, conversion_rate:d, n:i", MK_SQL))
def conversion_by_month(spark, sf_dir):
    """Conversion rate by month."""
    return market(spark, sf_dir).groupBy(V.MONTH).agg(F.avg("converted").alias("conversion_rate"),
                                                      F.count("*").alias("n"))


@register("profile_missing", wrap(
    f"SELECT quote_month, c.competitor, 100 * (1 - avg(CASE WHEN c.premium IS NOT NULL THEN 1.0 ELSE 0.0 END)) "
    f"AS missing_pct FROM mk, {_LONG} WHERE {PROFILE_SQL} GROUP BY 1, 2",
    "quote_month:date, competitor:s, missing_pct:d", MK_SQL))
def profile_missing(spark, sf_dir):
    """Profile missing-quote % per competitor and month."""
    long = profile(spark, sf_dir).select(V.MONTH, *COMPS).unpivot([V.MONTH], COMPS, "competitor", "premium")
    return long.groupBy(V.MONTH, "competitor").agg(
        (100 * (1 - F.avg(F.col("premium").isNotNull().cast("double")))).alias("missing_pct"))


MS = ("quote_month:date, own_premium:d, " + ", ".join(f"{c}:d" for c in COMPS)
      + ", own_to_market_ratio:d, rank_own_premium:d, n_quotes:i")


@register("monthly_summary", wrap(
    "SELECT quote_month, round(avg(own_premium), 2) AS own_premium, "
    + ", ".join(f"round(avg({c}), 2) AS {c}" for c in COMPS)
    + ", round(avg(ratio), 2) AS own_to_market_ratio, round(avg(rank_own_premium), 2) AS rank_own_premium, "
    "count(*) AS n_quotes FROM mk GROUP BY 1", MS, MK_SQL))
def monthly_summary(spark, sf_dir):
    """Monthly summary table: mean own, competitor prices, ratio, rank (round 2) and count."""
    m = market(spark, sf_dir)
    return m.groupBy(V.MONTH).agg(
        F.round(F.avg("own_premium"), 2).alias("own_premium"),
        *[F.round(F.avg(c), 2).alias(c) for c in COMPS],
        F.round(F.avg(RATIO), 2).alias("own_to_market_ratio"),
        F.round(F.avg("rank_own_premium"), 2).alias("rank_own_premium"),
        F.count("*").alias("n_quotes"))


# ---------------------------------------------------------------- rolling-anchor views
@register("anchor_kpis", wrap(
    "SELECT count(*) AS rows_total, count(market_anchor) AS rows_scored, count(market_anchor) / count(*) "
    "AS anchor_coverage_ratio, avg(relative_price_ratio) AS mean_relative_price_ratio FROM hk",
    "rows_total:i, rows_scored:i, anchor_coverage_ratio:d, mean_relative_price_ratio:d", HK_SQL))
def anchor_kpis(spark, sf_dir):
    """Anchor coverage ratio and KPIs."""
    return hk(spark, sf_dir).agg(
        F.count("*").alias("rows_total"), F.count("market_anchor").alias("rows_scored"),
        (F.count("market_anchor") / F.count("*")).alias("anchor_coverage_ratio"),
        F.avg("relative_price_ratio").alias("mean_relative_price_ratio"))


@register("anchor_vs_actual", wrap(
    f"SELECT quote_month, s.series, avg(s.value) AS value FROM hk, LATERAL (SELECT unnest(['{T}', 'market_anchor']) "
    "AS series, unnest([tgt, market_anchor]) AS value) s GROUP BY 1, 2", "quote_month:date, series:s, value:d", HK_SQL))
def anchor_vs_actual(spark, sf_dir):
    """Actual target vs rolling anchor by month."""
    return V.monthly_means(hk(spark, sf_dir), [T, "market_anchor"])


@register("anchor_coverage", wrap(
    "SELECT quote_month, 100 * avg(CASE WHEN market_anchor IS NOT NULL THEN 1.0 ELSE 0.0 END) AS coverage_pct, "
    "count(*) AS n FROM hk GROUP BY 1", "quote_month:date, coverage_pct:d, n:i", HK_SQL))
def anchor_coverage(spark, sf_dir):
    """Anchor coverage % by month."""
    return hk(spark, sf_dir).groupBy(V.MONTH).agg(
        (100 * F.avg(F.col("market_anchor").isNotNull().cast("double"))).alias("coverage_pct"),
        F.count("*").alias("n"))


@register("log_price_hist", wrap("""
SELECT b AS bin, (e.edges[b + 1] + e.edges[b + 2]) / 2 AS bin_mid, count(*) AS n
FROM (SELECT len(list_filter(e.edges[2:40], lambda v: v < log_relative_price)) AS b FROM hk, e
      WHERE log_relative_price IS NOT NULL) z, e GROUP BY b, e.edges""", "bin:i, bin_mid:d, n:i",
    HK_SQL + """,
e AS (SELECT list_transform(range(0, 41), lambda i: CASE WHEN i = 0 THEN lo - (hi - lo) * 0.001
        WHEN i = 40 THEN hi ELSE lo + i * ((hi - lo) / 40) END) AS edges
      FROM (SELECT min(log_relative_price) AS lo, max(log_relative_price) AS hi FROM hk))"""))
def log_price_hist(spark, sf_dir):
    """Histogram of the log relative price, 40 equal-width bins."""
    h = hk(spark, sf_dir).where(F.col("log_relative_price").isNotNull())
    return V.equal_width_bins(h, "log_relative_price", 40, {"n": F.count("*")})


@register("conversion_by_band", wrap("""
SELECT len(list_filter(e.edges[2:len(e.edges) - 1], lambda v: v < log_relative_price)) AS band,
  avg(converted) AS conversion_rate, count(*) AS n
FROM hk, e WHERE log_relative_price IS NOT NULL AND converted IS NOT NULL
  AND log_relative_price >= e.edges[1] AND log_relative_price <= e.edges[len(e.edges)] GROUP BY 1""",
    "band:i, conversion_rate:d, n:i",
    HK_SQL + """,
e AS (SELECT list_sort(list_distinct(quantile_cont(log_relative_price, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8,
        0.9, 1.0]))) AS edges FROM hk WHERE log_relative_price IS NOT NULL AND converted IS NOT NULL)"""))
def conversion_by_band(spark, sf_dir):
    """Conversion by relative-price decile band (exact edges, duplicates dropped, >= 20 rows)."""
    h = hk(spark, sf_dir).where(F.col("log_relative_price").isNotNull() & F.col("converted").isNotNull())
    return V.quantile_bands(h, "log_relative_price", 10,
                            {"conversion_rate": F.avg("converted"), "n": F.count("*")}, min_rows=20)


@register("index_vs_raw", wrap("""
SELECT i.quote_month, i.mean_prediction, i.p25_prediction, i.p75_prediction, i.n_profiles, r.raw_mean_target
FROM (SELECT CAST(m AS DATE) AS quote_month, avg(p) AS mean_prediction, quantile_cont(p, 0.25) AS p25_prediction,
        quantile_cont(p, 0.75) AS p75_prediction, count(*) AS n_profiles
      FROM (SELECT m.m, greatest(coalesce(c.cell_mean, (SELECT gm FROM gmean)), 0) AS p
            FROM basket b CROSS JOIN (SELECT unnest(generate_series(date_trunc('month', min(quote_date)),
                                      date_trunc('month', max(quote_date)), INTERVAL 1 MONTH)) AS m FROM lb) m
            LEFT JOIN cellm c ON b.vehicle_segment IS NOT DISTINCT FROM c.vehicle_segment
              AND b.coverage_type IS NOT DISTINCT FROM c.coverage_type) z GROUP BY 1) i
LEFT JOIN (SELECT CAST(qmonth AS DATE) AS quote_month, avg(tgt) AS raw_mean_target FROM pred GROUP BY 1) r
  USING (quote_month)""", "quote_month:date, mean_prediction:d, p25_prediction:d, p75_prediction:d, n_profiles:i, "
    "raw_mean_target:d", BASKET_SQL))
def index_vs_raw(spark, sf_dir):
    """Basket index joined to the raw monthly mean target (V9)."""
    from quotelens.plans.queries_model import basket_index_segmean
    idx = basket_index_segmean(spark, sf_dir)
    raw = market(spark, sf_dir).groupBy(V.MONTH).agg(F.avg(T).alias("raw_mean_target"))
    return idx.join(raw, V.MONTH, "left")

