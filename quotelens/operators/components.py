"""Market components per quote (projection; two scalar aggregates, one small join).

``engineer_market_features`` masks non-positive premiums, derives the
``avg_top_N`` columns, the chosen target, the price distribution, signatures,
own-price position, segment aggressiveness and calendar features.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.functions import rowwise as R
from quotelens.functions.nullsafe import safe_div
from quotelens.functions.quantiles import median
from quotelens.functions.temporal import TEMPORAL_COLUMNS, temporal_columns
from quotelens.operators.joins import attach_group_values
from quotelens.spec import PanelSpec


@dataclass
class FeatureMeta:
    competitor_columns: list[str]
    target_column: str
    market_component_columns: list[str]
    temporal_columns: list[str]
    leakage_warnings: list[str] = field(default_factory=list)


def market_columns(df: DataFrame, spec: PanelSpec, comps: list[str]) -> dict:
    """The row-wise component expressions (no aggregate), in output order."""
    t = spec.target
    cols: dict = {}
    complete = R.complete_panel(comps)
    for n in spec.all_top_ns():
        expr = R.top_n_mean(comps, n)
        if t.missing_panel_policy == "complete":
            expr = F.when(complete, expr)
        cols[f"avg_top_{n}_competitor_premium"] = expr
    target = {
        "avg_top_n": lambda: R.top_n_mean(comps, t.top_n),
        "min": lambda: R.row_min(comps),
        "median": lambda: R.row_median(comps),
        "softmin": lambda: R.row_softmin(comps, t.softmin_temperature),
    }[t.aggregation]()
    if t.missing_panel_policy == "complete":
        target = F.when(complete, target)
    cols[t.name] = target
    if spec.add_competitor_distribution:
        cols["min_competitor_premium"] = R.row_min(comps)
        cols["max_competitor_premium"] = R.row_max(comps)
        cols["median_competitor_premium"] = R.row_median(comps)
        cols["softmin_competitor_premium"] = R.row_softmin(comps, t.softmin_temperature)
        cols["competitor_premium_std"] = R.row_std(comps)
        cols["competitor_count"] = R.present_count(comps).cast("long")
    cols["competitor_panel_signature"] = R.panel_signature(comps)
    cols["top_n_competitor_signature"] = R.top_n_signature(comps, t.top_n)
    return cols


def engineer_market_features(df: DataFrame, spec: PanelSpec,
                             materialize_rows: bool = True) -> tuple[DataFrame, FeatureMeta]:
    comps = spec.resolve_competitors(df.columns)
    t = spec.target
    out = df.withColumns({c: R.masked(c) for c in comps})
    comp_cols = market_columns(out, spec, comps)
    out = out.withColumns(comp_cols)
    if materialize_rows:
        # the scalar aggregates below would otherwise recompute the input plan
        from quotelens.session import materialize
        out = materialize(out, "market-rows")
    mkt = list(comp_cols)

    if spec.add_competitor_distribution:
        med = median(out, t.name, spec.quantile_mode)
        out = out.withColumn(
            "market_price_index",
            safe_div(F.col(t.name), F.lit(med)) if med is not None else F.lit(None).cast("double"))
        mkt.append("market_price_index")

    if spec.add_relative_position and spec.own_premium_column and spec.own_premium_column in df.columns:
        own = F.col(spec.own_premium_column).cast("double")
        ratio = f"own_to_{t.name}_ratio"
        gap = f"price_gap_to_{t.name}"
        rank = R.own_rank(own, comps)
        min_col = (F.col("min_competitor_premium") if spec.add_competitor_distribution
                   else F.lit(None).cast("double"))
        out = out.withColumns({
            ratio: safe_div(own, F.col(t.name)),
            gap: own - F.col(t.name),
            "own_to_min_competitor_ratio": safe_div(own, min_col),
            "rank_own_premium": rank,
        })
        out = out.withColumn(f"top_{t.top_n}_indicator",
                             F.coalesce(F.col("rank_own_premium") <= t.top_n, F.lit(False)).cast("int"))
        mkt += [ratio, gap, "own_to_min_competitor_ratio", "rank_own_premium", f"top_{t.top_n}_indicator"]

    segs = [c for c in spec.segment_columns if c in df.columns]
    if spec.add_segment_aggressiveness and segs:
        out = segment_aggressiveness(out, t.name, segs)
        mkt.append("segment_market_aggressiveness")

    temporal: list[str] = []
    if spec.add_temporal_features:
        out = out.withColumns(temporal_columns(F.col(spec.date_column)))
        temporal = list(TEMPORAL_COLUMNS)

    meta = FeatureMeta(
        competitor_columns=comps,
        target_column=t.name,
        market_component_columns=sorted(set(mkt)),
        temporal_columns=temporal,
    )
    from quotelens.operators.features import leakage_warnings
    meta.leakage_warnings = leakage_warnings(out, spec, comps)
    return out, meta


def segment_aggressiveness(df: DataFrame, target: str, segs: list[str],
                           name: str = "segment_market_aggressiveness") -> DataFrame:
    """Mean target of the row's segment (NULL is its own segment) over the global mean.

    One partial+final aggregate per segment, joined back null-safely; the join
    broadcasts the segment table only when its counted size is small.
    """
    from quotelens.session import materialize
    # one row per segment (sum, count), written once: later reads see its real (file) size for
    # the broadcast check, and the global mean comes from this small table, not another scan
    seg = materialize(df.groupBy(*segs).agg(F.sum(target).alias("__s"), F.count(target).alias("__c")),
                      "segments")
    tot = seg.agg(F.sum("__s").alias("s"), F.sum("__c").alias("c")).first()
    overall = tot.s / tot.c if tot.c else None
    seg = seg.select(*segs, safe_div(F.col("__s"), F.col("__c")).alias("__seg_mean"))
    joined = attach_group_values(df, seg, segs)
    if overall is None:
        return joined.withColumn(name, F.lit(None).cast("double")).drop("__seg_mean")
    return joined.withColumn(
        name, safe_div(F.coalesce(F.col("__seg_mean"), F.lit(overall)), F.lit(overall))
    ).drop("__seg_mean")
