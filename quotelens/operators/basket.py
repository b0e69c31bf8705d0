"""Fixed reference basket and its monthly price index.

The basket's levels are one small table (column, position, level): distinct
values per categorical, rounded quartiles per numeric. Profile i of the full
product is decoded from ``spark.range(size)`` by mixed radix; each digit is
looked up by a join with its column's levels, which are written first so that
the joins are planned by their real size. Every profile of the product is kept.
The index scores the basket at every month by ``explode(sequence(...))``,
predicts once and aggregates per month.
"""

from __future__ import annotations

from math import prod

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import floor_at
from quotelens.functions.quantiles import group_quantile, grouped_quantiles, quantile_table
from quotelens.functions.temporal import temporal_columns
from quotelens.operators.models import PriceModel, predict
from quotelens.session import materialize


def levels_frame(df: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """Basket levels (column, position, level as text): sorted distinct non-null values per categorical;
    distinct p25/p50/p75 (1 decimal, half-even) per numeric."""
    spark = df.sparkSession
    out = spark.createDataFrame([], "column string, position int, level string")
    cats = [c for c in categorical if c in df.columns]
    if cats:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in cats]).unpivot([], cats, "column", "level")
        place = F.row_number().over(Window.partitionBy("column").orderBy("level")) - 1
        out = out.unionByName(long.where(F.col("level").isNotNull()).distinct().withColumn("position", place))
    nums = [c for c in numeric if c in df.columns]
    if nums:
        long = df.select(*[F.col(c).cast("double").alias(c) for c in nums]).unpivot([], nums, "column", "x")
        found = [(c, float(q)) for c, qs in grouped_quantiles(long, "column", "x", [0.25, 0.5, 0.75]).items() for q in qs]
        rounded = spark.createDataFrame(found, "column string, q double").select("column", F.bround("q", 1).alias("q")).distinct()
        place = F.row_number().over(Window.partitionBy("column").orderBy("q")) - 1
        out = out.unionByName(rounded.select("column", place.alias("position"), F.col("q").cast("string").alias("level")))
    return out


def reference_basket(df: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """The whole cross product of the levels, one row per profile."""
    spark = df.sparkSession
    levels = materialize(levels_frame(df, categorical, numeric), "levels")
    sizes = {r["column"]: r["count"] for r in levels.groupBy("column").count().collect()}
    keys = [c for c in dict.fromkeys([*categorical, *numeric]) if c in sizes]
    total = prod(sizes[k] for k in keys) if keys else 0
    if total >= 1 << 63:
        raise ValueError(f"The product of {sizes} levels has more profiles than a long can number")
    out, stride = spark.range(total).withColumnRenamed("id", "basket_id"), total
    for k in keys:
        stride //= sizes[k]
        digit = F.expr(f"cast((basket_id div {stride}) % {sizes[k]} as int)")
        value = F.col("level").cast("double") if k in numeric and k not in categorical else F.col("level")
        own = levels.where(F.col("column") == k).select(F.col("position").alias("__digit"), value.alias(k))
        out = out.withColumn("__digit", digit).join(own, "__digit").drop("__digit")
    return out.select("basket_id", *keys)


def basket_index(basket: DataFrame, model: PriceModel, dated: DataFrame, date_column: str,
                 mode: str = "exact") -> DataFrame:
    """Mean, p25, p75 and count of floored basket predictions per month."""
    bounds = dated.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi")).first()
    lo_m = F.date_trunc("month", F.lit(str(bounds.lo)).cast("timestamp_ntz")).cast("timestamp_ntz")
    hi_m = F.date_trunc("month", F.lit(str(bounds.hi)).cast("timestamp_ntz")).cast("timestamp_ntz")
    months = F.sequence(lo_m, hi_m, F.make_ym_interval(F.lit(0), F.lit(1)))
    monthly = basket.withColumn(date_column, F.explode(months))
    monthly = monthly.withColumns(temporal_columns(F.col(date_column)))
    scored = predict(model, monthly, "__p").select(F.to_date(date_column).alias("quote_month"), floor_at("__p", 0.0).alias("__p"))
    if mode == "approx":
        return scored.groupBy("quote_month").agg(
            F.avg("__p").alias("mean_prediction"), group_quantile(F.col("__p"), 0.25, mode).alias("p25_prediction"),
            group_quantile(F.col("__p"), 0.75, mode).alias("p75_prediction"), F.count("*").alias("n_profiles"))
    # profiles of equal predictions are one row from here on, with sums before the exchange
    counted = materialize(scored.groupBy("quote_month", "__p").agg(F.count("*").alias("__n")), "basket")
    means = counted.groupBy("quote_month").agg((F.sum(F.col("__p") * F.col("__n")) / F.sum(F.when(F.col("__p").isNotNull(), F.col("__n")))).alias("mean_prediction"), F.sum("__n").alias("n_profiles"))
    q = quantile_table(counted, ["quote_month"], "__p", [0.25, 0.75], "__n", counted=True)
    return means.join(q.select("quote_month", F.get("q", F.lit(0)).alias("p25_prediction"), F.get("q", F.lit(1)).alias("p75_prediction")), "quote_month").select(
        "quote_month", "mean_prediction", "p25_prediction", "p75_prediction", "n_profiles")
