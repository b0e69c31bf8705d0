"""Registered queries: sources, data contract, market components, panel diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelens.functions import rowwise as R
from quotelens.operators import contract, panel as P
from quotelens.operators.components import engineer_market_features
from quotelens.plans.oracle import COMPS, features_ctes, quotes_cte, wrap
from quotelens.plans.registry import SPEC, engineered, panel, register
from quotelens.spec import TargetSpec

FEAT = features_ctes()
QCOLS = ("quote_id:i, quote_date:ts, channel:s, region:s, vehicle_segment:s, coverage_type:s, "
         "driver_age:d, vehicle_age:d, claim_count_3y:d, sum_insured:d, "
         + ", ".join(f"{c}:d" for c in COMPS) + ", own_premium:d, converted:i")
T = SPEC.target_column


# ---------------------------------------------------------------- sources
@register("scan_quotes", wrap("SELECT * FROM quotes", QCOLS, quotes_cte()))
def scan_quotes(spark, sf_dir):
    """The quote panel read from parquet."""
    return panel(spark, sf_dir)


# ---------------------------------------------------------------- contract (D*)
@register("detect_competitors", wrap(
    "SELECT v.position, v.competitor, CASE v.position " + " ".join(
        f"WHEN {i} THEN k.n{i}" for i in range(len(COMPS))) + " END AS non_null_rows FROM (VALUES "
    + ", ".join(f"({i}, '{c}')" for i, c in enumerate(COMPS)) + ") v(position, competitor) CROSS JOIN (SELECT "
    + ", ".join(f"count({c}) AS n{i}" for i, c in enumerate(COMPS)) + " FROM quotes) k",
    "position:i, competitor:s, non_null_rows:i", quotes_cte()))
def detect_competitors(spark, sf_dir):
    """Competitor columns found by the name pattern, with their non-null counts."""
    q = panel(spark, sf_dir)
    comps = contract.detect_competitors(q, SPEC)
    counts = q.agg(*[F.count(c).alias(c) for c in comps])
    long = counts.unpivot([], comps, "competitor", "non_null_rows")
    pos = F.create_map(*[x for i, c in enumerate(comps) for x in (F.lit(c), F.lit(i))])
    return long.select(pos[F.col("competitor")].alias("position"), "competitor", "non_null_rows")


@register("invalid_dates", wrap(
    "SELECT count(*) FILTER (WHERE TRY_CAST(quote_date AS TIMESTAMP) IS NULL) AS invalid_dates FROM quotes",
    "invalid_dates:i", quotes_cte()))
def invalid_dates(spark, sf_dir):
    """Rows whose date does not parse."""
    return contract.invalid_dates(panel(spark, sf_dir), SPEC)


_n_present = "(" + " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in COMPS) + ")"


@register("data_quality_profile", wrap(f"""
SELECT count(*) AS rows, 17 AS columns,
  CAST(min(quote_date) AS DATE) AS date_min, CAST(max(quote_date) AS DATE) AS date_max,
  {" + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in COMPS)} AS missing_competitor_price_cells,
  {" + ".join(f"count(*) FILTER (WHERE {c} <= 0)" for c in COMPS)} AS non_positive_competitor_price_cells,
  count(*) FILTER (WHERE {_n_present} >= 3) AS rows_with_enough_competitors,
  count(*) FILTER (WHERE {_n_present} = 5) AS rows_with_complete_competitor_panel,
  count(*) FILTER (WHERE {_n_present} >= 3) AS rows_eligible_for_target,
  'available' AS target_missing_panel_policy
FROM quotes""", "rows:i, columns:i, date_min:date, date_max:date, missing_competitor_price_cells:i, "
   "non_positive_competitor_price_cells:i, rows_with_enough_competitors:i, "
   "rows_with_complete_competitor_panel:i, rows_eligible_for_target:i, target_missing_panel_policy:s",
   quotes_cte()))
def data_quality_profile(spark, sf_dir):
    """Quality profile in one pass over the raw panel."""
    return contract.quality_profile(panel(spark, sf_dir), SPEC)


@register("competitor_quote_rates", wrap(
    " UNION ALL ".join(f"SELECT '{c}' AS competitor, avg(CASE WHEN {c} > 0 THEN 1.0 ELSE 0.0 END) AS quote_rate FROM quotes"
                       for c in COMPS), "competitor:s, quote_rate:d", quotes_cte()))
def competitor_quote_rates(spark, sf_dir):
    """Share of all rows with a positive price per competitor."""
    return contract.competitor_quote_rates(panel(spark, sf_dir), SPEC)


@register("comparability_missing", wrap(
    "SELECT 'coverage_type' AS \"column\", count(*) FILTER (WHERE coverage_type IS NULL) AS missing FROM quotes",
    "column:s, missing:i", quotes_cte()))
def comparability_missing(spark, sf_dir):
    """Missing cells per comparability column."""
    return contract.comparability_missing(panel(spark, sf_dir), SPEC)


@register("coerce_types", wrap(
    "SELECT * REPLACE (TRY_CAST(quote_date AS TIMESTAMP) AS quote_date, "
    "TRY_CAST(converted AS DOUBLE) AS converted) FROM quotes",
    QCOLS.replace("converted:i", "converted:d"), quotes_cte()))
def coerce_types(spark, sf_dir):
    """Type coercion with unparseable values to NULL."""
    return contract.coerce_types(panel(spark, sf_dir), SPEC)


# ---------------------------------------------------------------- components (F*)
@register("mask_prices", wrap("SELECT quote_id, " + ", ".join(COMPS) + " FROM m",
                              "quote_id:i, " + ", ".join(f"{c}:d" for c in COMPS), FEAT))
def mask_prices(spark, sf_dir):
    """Premiums <= 0 masked to NULL (F1)."""
    q = panel(spark, sf_dir)
    comps = contract.detect_competitors(q, SPEC)
    return q.select("quote_id", *[R.masked(c).alias(c) for c in comps])


@register("avg_top_n", wrap(
    "SELECT quote_id, avg_top_3_competitor_premium, avg_top_5_competitor_premium FROM feat",
    "quote_id:i, avg_top_3_competitor_premium:d, avg_top_5_competitor_premium:d", FEAT))
def avg_top_n(spark, sf_dir):
    """Mean of the N cheapest quotes for N in {3, 5} (F2)."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", "avg_top_3_competitor_premium", "avg_top_5_competitor_premium")


@register("complete_panel_target", wrap(
    "SELECT quote_id, avg_top_3_competitor_premium, avg_top_5_competitor_premium, min_competitor_premium FROM feat",
    "quote_id:i, avg_top_3_competitor_premium:d, avg_top_5_competitor_premium:d, min_competitor_premium:d",
    features_ctes(policy="complete")))
def complete_panel_target(spark, sf_dir):
    """Complete-panel policy: target NULL when any competitor is missing."""
    spec = SPEC.with_(target=TargetSpec(missing_panel_policy="complete"))
    eng, _ = engineer_market_features(panel(spark, sf_dir), spec)
    return eng.select("quote_id", "avg_top_3_competitor_premium", "avg_top_5_competitor_premium",
                      "min_competitor_premium")


_tgt_aggs = {a: features_ctes(aggregation=a) for a in ("min", "median", "softmin")}


@register("target_aggregations", wrap(
    "SELECT a.quote_id, a.tgt AS target_min, b.tgt AS target_median, c.tgt AS target_softmin "
    "FROM feat a JOIN feat_median b USING (quote_id) JOIN feat_softmin c USING (quote_id)",
    "quote_id:i, target_min:d, target_median:d, target_softmin:d",
    _tgt_aggs["min"] + ",\nfeat_median AS (SELECT quote_id, " + (
        "CASE WHEN len(s) > 0 THEN (s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1]) / 2 END AS tgt FROM sl)")
    + ",\nfeat_softmin AS (SELECT quote_id, softmin_competitor_premium AS tgt FROM feat)"))
def target_aggregations(spark, sf_dir):
    """Target by aggregation: min, median, softmin."""
    q = panel(spark, sf_dir)
    comps = contract.detect_competitors(q, SPEC)
    m = q.select("quote_id", *[R.masked(c).alias(c) for c in comps])
    out = {}
    for agg in ("min", "median", "softmin"):
        spec = SPEC.with_(target=TargetSpec(name=f"target_{agg}", aggregation=agg))
        from quotelens.operators.components import market_columns
        out[f"target_{agg}"] = market_columns(m, spec, comps)[f"target_{agg}"]
    return m.select("quote_id", *[v.alias(k) for k, v in out.items()])


DIST = ("min_competitor_premium:d, max_competitor_premium:d, median_competitor_premium:d, "
        "competitor_premium_std:d, competitor_count:i")


@register("competitor_distribution", wrap(
    "SELECT quote_id, " + ", ".join(x.split(":")[0] for x in DIST.split(", ")) + " FROM feat",
    "quote_id:i, " + DIST, FEAT))
def competitor_distribution(spark, sf_dir):
    """Row min, max, median, sample std and count of quotes."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", *[x.split(":")[0] for x in DIST.split(", ")])


@register("row_softmin", wrap("SELECT quote_id, softmin_competitor_premium FROM feat",
                              "quote_id:i, softmin_competitor_premium:d", FEAT))
def row_softmin(spark, sf_dir):
    """Soft minimum of the quotes, temperature 25 (F8)."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", "softmin_competitor_premium")


@register("market_price_index", wrap("SELECT quote_id, market_price_index FROM feat",
                                     "quote_id:i, market_price_index:d", FEAT))
def market_price_index(spark, sf_dir):
    """Target over the global median target."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", "market_price_index")


@register("panel_signature", wrap("SELECT quote_id, competitor_panel_signature FROM feat",
                                  "quote_id:i, competitor_panel_signature:s", FEAT))
def panel_signature(spark, sf_dir):
    """Quoting competitors joined by '|' (F12)."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", "competitor_panel_signature")


@register("top_n_signature", wrap("SELECT quote_id, top_n_competitor_signature FROM feat",
                                  "quote_id:i, top_n_competitor_signature:s", FEAT))
def top_n_signature(spark, sf_dir):
    """Names of the 3 cheapest competitors, sorted."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", "top_n_competitor_signature")


REL = (f"own_to_{T}_ratio:d, price_gap_to_{T}:d, own_to_min_competitor_ratio:d, "
       "rank_own_premium:d, top_3_indicator:i")


@register("relative_position", wrap(
    f"SELECT quote_id, own_ratio AS own_to_{T}_ratio, own_gap AS price_gap_to_{T}, "
    "own_to_min_competitor_ratio, rank_own_premium, top_indicator AS top_3_indicator FROM feat",
    "quote_id:i, " + REL, FEAT))
def relative_position(spark, sf_dir):
    """Own-price ratio, gap, rank and top-N indicator."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", *[x.split(":")[0] for x in REL.split(", ")])


@register("segment_aggressiveness", wrap("SELECT quote_id, segment_market_aggressiveness FROM feat",
                                         "quote_id:i, segment_market_aggressiveness:d", FEAT))
def segment_aggressiveness(spark, sf_dir):
    """Mean target of the region x channel segment over the global mean."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", "segment_market_aggressiveness")


TEMP = ("quote_year:i, quote_month:i, quote_quarter:i, quote_weekofyear:i, quote_dayofweek:i, "
        "quote_time_days:i, quote_month_sin:d, quote_month_cos:d, quote_dayofweek_sin:d, quote_dayofweek_cos:d")


@register("temporal_features", wrap(
    "SELECT quote_id, quote_year, quote_month_num AS quote_month, quote_quarter, quote_weekofyear, "
    "quote_dayofweek, quote_time_days, sin(2 * pi() * quote_month_num / 12) AS quote_month_sin, "
    "cos(2 * pi() * quote_month_num / 12) AS quote_month_cos, sin(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_sin, "
    "cos(2 * pi() * quote_dayofweek / 7) AS quote_dayofweek_cos FROM feat", "quote_id:i, " + TEMP, FEAT))
def temporal_features(spark, sf_dir):
    """Calendar features: ISO week, Monday=0 weekday, days since 2000, cyclic month/weekday."""
    eng, _ = engineered(spark, sf_dir)
    return eng.select("quote_id", *[x.split(":")[0] for x in TEMP.split(", ")])


@register("leakage_corr", wrap(
    "SELECT count(*) FILTER (WHERE own_premium IS NOT NULL AND tgt IS NOT NULL) AS n_pairs, "
    "corr(own_premium, tgt) AS own_target_corr FROM feat",
    "n_pairs:i, own_target_corr:d", FEAT))
def leakage_corr(spark, sf_dir):
    """Correlation of own premium and target over valid pairs."""
    from quotelens.operators.features import leakage_correlation
    eng, _ = engineered(spark, sf_dir)
    return leakage_correlation(eng, SPEC)


# ---------------------------------------------------------------- panel (P*)
@register("coverage_by_month", wrap(
    "SELECT qmonth AS quote_month, c.competitor, avg(CASE WHEN c.premium IS NOT NULL THEN 1.0 ELSE 0.0 END) AS quote_rate, "
    "count(*) AS rows FROM feat, LATERAL (SELECT unnest(['" + "', '".join(COMPS) + "']) AS competitor, "
    "unnest([" + ", ".join(COMPS) + "]) AS premium) c GROUP BY 1, 2",
    "quote_month:date, competitor:s, quote_rate:d, rows:i", FEAT))
def coverage_by_month(spark, sf_dir):
    """Quote rate per month x competitor after masking."""
    eng, meta = engineered(spark, sf_dir)
    return P.coverage_by_month(eng, SPEC, meta.competitor_columns)


@register("eligibility_by_month", wrap(
    "SELECT qmonth AS quote_month, avg(CASE WHEN tgt IS NOT NULL THEN 1.0 ELSE 0.0 END) AS target_eligibility_rate, "
    "count(*) AS rows FROM feat GROUP BY 1", "quote_month:date, target_eligibility_rate:d, rows:i", FEAT))
def eligibility_by_month(spark, sf_dir):
    """Share of rows with a target per month."""
    eng, _ = engineered(spark, sf_dir)
    return P.eligibility_by_month(eng, SPEC)


@register("panel_composition", wrap(
    "SELECT qmonth AS quote_month, top_n_competitor_signature, count(*) AS rows, avg(tgt) AS mean_target, "
    "count(*) / sum(count(*)) OVER (PARTITION BY qmonth) AS monthly_share FROM feat "
    "WHERE top_n_competitor_signature IS NOT NULL GROUP BY 1, 2",
    "quote_month:date, top_n_competitor_signature:s, rows:i, mean_target:d, monthly_share:d", FEAT))
def panel_composition(spark, sf_dir):
    """Rows, mean target and monthly share per month x top-3 signature."""
    eng, _ = engineered(spark, sf_dir)
    return P.panel_composition(eng, SPEC)


PB = ("complete_panel_rate:d, complete_panel_mean_target:d, incomplete_panel_mean_target:d, "
      "incomplete_vs_complete_target_bias_pct:d")
_pb_body = ("SELECT avg(CASE WHEN complete_panel THEN 1.0 ELSE 0.0 END) AS complete_panel_rate, "
            "avg(tgt) FILTER (WHERE complete_panel) AS complete_panel_mean_target, "
            "avg(tgt) FILTER (WHERE NOT complete_panel) AS incomplete_panel_mean_target FROM feat")


@register("panel_bias", wrap(
    "SELECT *, CASE WHEN complete_panel_mean_target <> 0 THEN (incomplete_panel_mean_target / "
    "complete_panel_mean_target - 1) * 100 END AS incomplete_vs_complete_target_bias_pct FROM (" + _pb_body + ")",
    PB, FEAT))
def panel_bias(spark, sf_dir):
    """Incomplete vs complete panel mean target, bias %."""
    eng, meta = engineered(spark, sf_dir)
    return P.panel_bias(eng, SPEC, meta.competitor_columns)


@register("panel_summary", wrap(
    "SELECT (SELECT min(r) FROM (SELECT avg(CASE WHEN c.premium IS NOT NULL THEN 1.0 ELSE 0.0 END) AS r "
    "FROM feat, LATERAL (SELECT unnest([" + ", ".join(COMPS) + "]) AS premium, unnest(['" + "', '".join(COMPS)
    + "']) AS competitor) c GROUP BY qmonth, c.competitor)) AS minimum_monthly_competitor_coverage, "
    "(SELECT min(r) FROM (SELECT avg(CASE WHEN tgt IS NOT NULL THEN 1.0 ELSE 0.0 END) AS r FROM feat GROUP BY qmonth)) "
    "AS minimum_monthly_target_eligibility, b.*, "
    "CASE WHEN complete_panel_mean_target <> 0 THEN (incomplete_panel_mean_target / complete_panel_mean_target - 1) * 100 END "
    "AS incomplete_vs_complete_target_bias_pct, "
    "(SELECT count(DISTINCT top_n_competitor_signature) FROM feat) AS distinct_top_n_compositions, "
    "'available' AS missing_panel_policy FROM (" + _pb_body + ") b",
    "minimum_monthly_competitor_coverage:d, minimum_monthly_target_eligibility:d, " + PB
    + ", distinct_top_n_compositions:i, missing_panel_policy:s", FEAT))
def panel_summary(spark, sf_dir):
    """One-row panel summary (P5)."""
    eng, meta = engineered(spark, sf_dir)
    return P.panel_summary(eng, SPEC, meta.competitor_columns)
