"""Target statistics of categorical features, without leakage in training.

A level is encoded by the weighted mean of the target over its rows, drawn to the overall mean by a prior
weight. Training rows get the mean over the rows that come before them in a hashed order, so no row's own
target is in its encoding; other rows get the mean over all training rows of the level.

Running sums inside a level come in two steps: the hashed order is cut into ranges of equal width, sums by
(feature, level, range) are pre-aggregated before the exchange and give what precedes each range, and only
the rows of one range of one level are ordered together. So a level that holds a third of the rows is many
tasks' work, and a column of very many levels is a table, never a list on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelens.operators.joins import maybe_broadcast
from quotelens.session import materialize

MISSING = "__missing__"
PRIOR_WEIGHT = 1.0
ROWS_PER_RANGE = 100_000


def prefix(feature: str) -> str:
    return f"__ts_{feature}"


def hashed_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def _long(df: DataFrame, categorical: list[str], *kept: Column) -> DataFrame:
    levels = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in categorical]
    wide = df.select(*kept, *levels)
    return wide.unpivot([c for c in wide.columns if c not in categorical], categorical, "feature", "level")


def level_statistics(train: DataFrame, categorical: list[str], target: str, weight: str | None = None) -> DataFrame:
    """Written table (feature, level, wy, w) of all levels; the row without a feature holds the overall sums."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    base = train.select(w.alias("__w"), (w * F.col(target).cast("double")).alias("__wy"), *categorical)
    sums = [F.sum("__wy").alias("wy"), F.sum("__w").alias("w")]
    each = _long(base, categorical, F.col("__w"), F.col("__wy")).groupBy("feature", "level").agg(*sums) if categorical else None
    overall = base.agg(*sums).select(F.lit(None).cast("string").alias("feature"), F.lit(None).cast("string").alias("level"), "wy", "w")
    return materialize(overall if each is None else each.unionByName(overall), "levels")


def prior_mean(levels: DataFrame) -> float:
    row = levels.where("feature is null").first()
    return float(row.wy / row.w) if row and row.w else 0.0


def encoded(wy: Column, w: Column, prior: float, prior_weight: float = PRIOR_WEIGHT) -> Column:
    return (F.coalesce(wy, F.lit(0.0)) + F.lit(prior_weight * prior)) / (F.coalesce(w, F.lit(0.0)) + F.lit(prior_weight))


def ordered_statistics(train: DataFrame, key: str, categorical: list[str], target: str, weight: str | None = None, prior: float | None = None,
                       seed: int = 7, prior_weight: float = PRIOR_WEIGHT, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """key and one encoding a feature (``prefix``): the level's mean over the rows before this one in the hashed order.

    ``key`` is unique; rows of equal hash are ordered by it."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    base = train.select(F.col(key).alias("__key"), hashed_order(F.col(key), seed).alias("__order"), w.alias("__w"),
                        (w * F.col(target).cast("double")).alias("__wy"), *categorical)
    totals = base.agg(F.count("*").alias("n"), (F.sum("__wy") / F.sum("__w")).alias("mean")).first()
    prior = float(totals.mean or 0.0) if prior is None else prior
    ranges = max(1, -(-totals.n // rows_per_range))
    place = F.floor(F.conv(F.substring("__order", 1, 8), 16, 10).cast("double") / float(1 << 32) * ranges).cast("int")
    long = _long(base.withColumn("__range", place), categorical, *map(F.col, ("__key", "__order", "__w", "__wy", "__range")))
    group = ["feature", "level", "__range"]
    before = Window.partitionBy("feature", "level").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = long.groupBy(*group).agg(F.sum("__wy").alias("wy"), F.sum("__w").alias("w"))
    preceding = sums.select(*group, F.sum("wy").over(before).alias("wy"), F.sum("w").over(before).alias("w"))
    earlier = Window.partitionBy(*group).orderBy("__order", "__key").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    inside = long.withColumns({"__iwy": F.sum("__wy").over(earlier), "__iw": F.sum("__w").over(earlier)})
    rows = inside.join(preceding, group).select("__key", "feature", encoded(zero(F.col("wy")) + zero(F.col("__iwy")), zero(F.col("w")) + zero(F.col("__iw")),
                                                                            prior, prior_weight).alias("value"))
    return rows.groupBy(F.col("__key").alias(key)).agg(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(prefix(c)) for c in categorical])


def encode(df: DataFrame, levels: DataFrame, categorical: list[str], prior: float, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """Adds one encoding a feature from the written level table; a level without training rows gets the prior."""
    for c in categorical:
        own = levels.where(F.col("feature") == c).select(F.col("level").alias("__level"), encoded(F.col("wy"), F.col("w"), prior, prior_weight).alias(prefix(c)))
        df = df.withColumn("__of", F.coalesce(F.col(c).cast("string"), F.lit(MISSING)))
        df = df.join(maybe_broadcast(own), F.col("__of") == F.col("__level"), "left").drop("__of", "__level")
        df = df.withColumn(prefix(c), F.coalesce(F.col(prefix(c)), F.lit(prior)))
    return df
