"""Dashboard queries (V1-V45): filters and grouped aggregates behind each chart.

Every function is DataFrame -> DataFrame; groupings are by month (few) and
segments, so each is one partial+final hash aggregate. Shares within a month
are windows over the aggregated table, never over quote rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelens.functions.quantiles import group_quantile, quantile_table, quantiles

MONTH = "quote_month"


def add_month(df: DataFrame, date_column: str) -> DataFrame:
    """V2: month (DATE) of the quote; rows without one dropped."""
    return df.withColumn(MONTH, F.trunc(F.col(date_column), "month")).where(F.col(MONTH).isNotNull())


def apply_filters(df: DataFrame, date_column: str, date_from=None, date_to=None,
                  segment_filters: dict | None = None, splits: list[str] | None = None) -> DataFrame:
    """V1: date range, ``isin`` per segment (an empty list means no filter), splits."""
    conds: list[Column] = []
    d = F.col(date_column)
    if date_from is not None:
        conds.append(d >= F.lit(str(date_from)).cast("timestamp_ntz"))
    if date_to is not None:
        conds.append(d <= F.lit(str(date_to)).cast("timestamp_ntz"))
    for col, values in (segment_filters or {}).items():
        if values:
            conds.append(F.col(col).isin(list(values)))
    if splits:
        conds.append(F.col("_split").isin(list(splits)))
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def segment_columns(df: DataFrame, exclude: set[str], priority: list[str] | None = None,
                    max_levels: int = 30) -> DataFrame:
    """V3: text columns of any cardinality and other columns of 2..max_levels distinct values, minus
    excluded roles; ordered by priority list, then cardinality.

    Approximate counts (fixed memory) screen out the columns of far more values; the rest is
    counted exactly over (column, value) pairs."""
    cands = [f for f in df.schema.fields if f.name not in exclude]
    text = {f.name for f in cands if f.dataType.simpleString() == "string"}
    rough = df.agg(*[F.approx_count_distinct(F.col(f"`{f.name}`")).alias(f.name) for f in cands]).first()
    near = [f.name for f in cands if f.name in text or rough[f.name] <= 2 * max_levels]
    pairs = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in near]).unpivot([], near, "column", "value")
    counts = pairs.where(F.col("value").isNotNull()).distinct().groupBy("column").count()
    exact = {r["column"]: r["count"] for r in counts.collect()}
    prio = {c: i for i, c in enumerate(priority or [])}
    rows = []
    for c in near:
        n = exact.get(c, 0)
        if c in text or 2 <= n <= max_levels:
            rows.append((c, int(n), prio.get(c, len(prio))))
    rows.sort(key=lambda r: (r[2], r[1], r[0]))
    spark = df.sparkSession
    return spark.createDataFrame([(c, n, i + 1) for i, (c, n, _) in enumerate(rows)],
                                 "column string, n_distinct long, rank int")


def monthly_means(df: DataFrame, cols: list[str], by: list[str] | None = None,
                  series_name: str = "series", value_name: str = "value") -> DataFrame:
    """Mean of each column by month (and ``by``), melted to (month, by..., series, value)."""
    keys = [MONTH, *(by or [])]
    wide = df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])
    return wide.unpivot(keys, cols, series_name, value_name)


def grouped_means(df: DataFrame, keys: list[str], cols: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(v).alias(k) for k, v in cols.items()])


def share_by(df: DataFrame, keys: list[str], value: str, pct_round: int = 1) -> DataFrame:
    """Share % of each value within its key group (round), the value's NULL is its own group."""
    counts = df.groupBy(*keys, value).count()
    total = F.sum("count").over(Window.partitionBy(*keys))
    return counts.withColumn("share_pct", F.round(F.col("count") / total * 100, pct_round))


def heat_map(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Mean of ``value`` per (row, column) in long form, for whatever levels the data hold."""
    return df.groupBy(row, column).agg(F.avg(value).alias(f"mean_{value}"))


def equal_width_bins(df: DataFrame, col: str, bins: int, extra: dict[str, Column]) -> DataFrame:
    """Equal-width right-closed bins over [min, max] (lowest edge widened by 0.1 % of the
    range, as interval cutting does); bin midpoint and aggregates per bin."""
    b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = (float(b.lo), float(b.hi)) if b.lo is not None else (0.0, 1.0)  # no value: the same columns without rows
    if hi == lo:
        lo, hi = lo - 0.001 * abs(lo) if lo else -0.001, hi + 0.001 * abs(hi) if hi else 0.001
        edges = [lo + i * (hi - lo) / bins for i in range(bins + 1)]
    else:
        step = (hi - lo) / bins
        edges = [lo + i * step for i in range(bins)] + [hi]
        edges[0] = lo - (hi - lo) * 0.001
    x = F.col(col)
    idx = reduce(lambda a, e: a + F.when(F.lit(e) < x, 1).otherwise(0), edges[1:-1], F.lit(0))
    mids = F.array(*[F.lit((edges[i] + edges[i + 1]) / 2) for i in range(bins)])
    return (df.where(x.isNotNull()).groupBy(idx.alias("bin"))
            .agg(*[v.alias(k) for k, v in extra.items()])
            .withColumn("bin_mid", F.get(mids, F.col("bin"))))


def quantile_bands(df: DataFrame, col: str, q: int, extra: dict[str, Column], min_rows: int = 0) -> DataFrame:
    """Quantile bands of ``col`` (exact edges, duplicate edges dropped), right-closed with the
    lowest edge included; aggregates per band. At most as many bands as distinct values; with fewer
    than ``min_rows`` values the same columns without rows."""
    x = F.col(col)
    n = df.where(x.isNotNull()).count()
    if n < max(min_rows, 1):
        return df.where("false").groupBy(F.lit(0).alias("band")).agg(*[v.alias(k) for k, v in extra.items()])
    q = min(q, df.where(x.isNotNull()).select(x).distinct().limit(q).count())
    edges = sorted(set(quantiles(df, col, [i / q for i in range(q + 1)])))
    idx = reduce(lambda a, e: a + F.when(F.lit(e) < x, 1).otherwise(0), edges[1:-1], F.lit(0))
    return (df.where(x.isNotNull() & (x >= edges[0]) & (x <= edges[-1]))
            .groupBy(idx.alias("band")).agg(*[v.alias(k) for k, v in extra.items()]))


def box_stats(df: DataFrame, keys: list[str], value: str, mode: str = "exact") -> DataFrame:
    """V8: min, quartiles, max per group, for any number of groups (``quantile_table``)."""
    if mode == "approx":
        v = F.col(value)
        return df.where(v.isNotNull()).groupBy(*keys).agg(F.min(v).alias("min"), *[group_quantile(v, p, mode).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))], F.max(v).alias("max"))
    q = quantile_table(df, keys, value, [0.25, 0.5, 0.75])
    return q.select(*keys, F.col("lo").alias("min"), F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("median"), F.get("q", F.lit(2)).alias("q3"), F.col("hi").alias("max"))


def scatter_points(df: DataFrame, key: str, columns: list[str], by: list[str], points: int = 500) -> DataFrame:
    """At most ``points`` rows of each group, those of the smallest hash of the key (ties by the key): a fixed random sample.

    How many points a plot shows is a display parameter. Each task keeps its own smallest ones before the exchange, so a
    group's task reads ``points`` rows of each."""
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.select(key, *by, *columns).withColumn("__place", place).where(F.col("__place") <= points).drop("__place")
