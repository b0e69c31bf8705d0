"""Competitor availability and target-composition diagnostics (group-by month).

All tables are hash aggregates with map-side partial aggregation; the
per-competitor view comes from one ``unpivot`` instead of a loop of scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelens.functions.rowwise import complete_panel
from quotelens.spec import PanelSpec

MONTH = "quote_month"


def with_month(df: DataFrame, date_column: str, name: str = MONTH) -> DataFrame:
    """Month (DATE, first day) of the quote date; rows without a date are dropped."""
    return df.withColumn(name, F.trunc(F.col(date_column), "month")).where(F.col(name).isNotNull())


def long_prices(df: DataFrame, comps: list[str], keep: list[str]) -> DataFrame:
    """(keep..., competitor, premium) long view of the competitor columns."""
    return df.select(*keep, *comps).unpivot(keep, comps, "competitor", "premium")


def coverage_by_month(eng: DataFrame, spec: PanelSpec, comps: list[str]) -> DataFrame:
    """Share of rows with a (masked) quote per month and competitor, plus month rows."""
    m = with_month(eng, spec.date_column)
    return (long_prices(m, comps, [MONTH])
            .groupBy(MONTH, "competitor")
            .agg(F.avg(F.col("premium").isNotNull().cast("double")).alias("quote_rate"),
                 F.count("*").alias("rows")))


def eligibility_by_month(eng: DataFrame, spec: PanelSpec) -> DataFrame:
    m = with_month(eng, spec.date_column)
    return m.groupBy(MONTH).agg(
        F.avg(F.col(spec.target_column).isNotNull().cast("double")).alias("target_eligibility_rate"),
        F.count("*").alias("rows"))


def panel_composition(eng: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows and mean target per month x top-N signature, with the share of the month.

    The share's month total is a window over the (small) aggregated table, not
    over the quote rows.
    """
    m = with_month(eng, spec.date_column).where(F.col("top_n_competitor_signature").isNotNull())
    agg = m.groupBy(MONTH, "top_n_competitor_signature").agg(
        F.count("*").alias("rows"), F.avg(spec.target_column).alias("mean_target"))
    return agg.withColumn(
        "monthly_share", F.col("rows") / F.sum("rows").over(Window.partitionBy(MONTH)))


def panel_bias(eng: DataFrame, spec: PanelSpec, comps: list[str]) -> DataFrame:
    """Mean target of complete and incomplete panels and the bias in percent."""
    t = F.col(spec.target_column)
    full = complete_panel(comps)
    agg = eng.agg(
        F.avg(full.cast("double")).alias("complete_panel_rate"),
        F.avg(F.when(full, t)).alias("complete_panel_mean_target"),
        F.avg(F.when(~full, t)).alias("incomplete_panel_mean_target"))
    c, i = F.col("complete_panel_mean_target"), F.col("incomplete_panel_mean_target")
    return agg.withColumn(
        "incomplete_vs_complete_target_bias_pct",
        F.when(c.isNotNull() & (c != 0) & i.isNotNull(), (i / c - 1) * 100))


def panel_summary(eng: DataFrame, spec: PanelSpec, comps: list[str]) -> DataFrame:
    """One-row summary of the panel diagnostics."""
    cov = coverage_by_month(eng, spec, comps).agg(
        F.min("quote_rate").alias("minimum_monthly_competitor_coverage"))
    eli = eligibility_by_month(eng, spec).agg(
        F.min("target_eligibility_rate").alias("minimum_monthly_target_eligibility"))
    m = with_month(eng, spec.date_column)
    distinct = m.agg(F.count_distinct("top_n_competitor_signature").alias("distinct_top_n_compositions"))
    bias = panel_bias(m, spec, comps)
    row = {}
    for part in (cov, eli, bias, distinct):
        row.update(part.first().asDict())
    spark = eng.sparkSession
    schema = ("minimum_monthly_competitor_coverage double, minimum_monthly_target_eligibility double, "
              "complete_panel_rate double, complete_panel_mean_target double, "
              "incomplete_panel_mean_target double, incomplete_vs_complete_target_bias_pct double, "
              "distinct_top_n_compositions long")
    cols = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(row[c] for c in cols)], schema).withColumn(
        "missing_panel_policy", F.lit(spec.target.missing_panel_policy))
