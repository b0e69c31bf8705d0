"""Demand-signal diagnostic (Q1-Q4): does the market anchor add signal to conversion?

Usable rows (conversion in {0,1}, own premium and anchor present) are cut
chronologically: the first int(n * (1 - f)) rows by (date, id) train. The cut
is exact without a global sort: the cut date is an order statistic of the
date, and only rows ON that date are ranked by id (again an order statistic).
Two logistic regressions (with and without log anchor) are compared on log
loss and Brier score.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import ntz_micros
from quotelens.functions.quantiles import kth_smallest, order_statistics
from quotelens.operators.metrics import binary_metrics
from quotelens.operators.models import category_levels, fill_statement
from quotelens.session import materialize
from quotelens.spec import PanelSpec

PART = "_demand_part"
IMPROVEMENT = ("status string, incremental_log_loss_improvement double, incremental_brier_improvement double, "
               "passes_incremental_signal_check boolean")


def usable_rows(df: DataFrame, spec: PanelSpec, anchor: str = "market_anchor") -> DataFrame:
    conv = F.col(spec.conversion_column).try_cast("double")
    own = F.col(spec.own_premium_column).try_cast("double")
    return (df.where(conv.isNotNull() & own.isNotNull() & F.col(anchor).isNotNull() & conv.isin(0.0, 1.0))
            .withColumns({
                "__conv": conv,
                "log_own_premium": F.log(F.greatest(own, F.lit(1e-6))),
                "log_market_anchor": F.log(F.greatest(F.col(anchor), F.lit(1e-6))),
            }))


def readiness(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """rows, positives, negatives, status ('ready' / 'insufficient_data')."""
    g = df.agg(F.count("*").alias("rows"), F.count_if(F.col("__conv") == 1).alias("positives"),
               F.count_if(F.col("__conv") == 0).alias("negatives"))
    ok = (F.col("rows") >= spec.demand_minimum_rows) & (F.col("positives") > 0) & (F.col("negatives") > 0)
    return g.withColumn("status", F.when(ok, "ready").otherwise("insufficient_data"))


def chronological_cut(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Label rows train/test: the first int(n * (1 - f)) rows by (date, id) are train."""
    d = ntz_micros(spec.date_column)
    ident = F.col(spec.id_columns[0])
    n = df.count()
    cut = int(n * (1 - spec.demand_test_fraction))
    if cut <= 0:
        return df.withColumn(PART, F.lit("test"))
    if cut >= n:
        return df.withColumn(PART, F.lit("train"))
    stats, _ = order_statistics(df, d, [cut])
    cut_date = int(stats[cut])
    below = df.where(d < F.lit(cut_date)).count()
    need = cut - below  # rows of the cut date that still belong to train (>= 1)
    on_day = df.where(d == F.lit(cut_date))
    cut_id = kth_smallest(on_day, spec.id_columns[0], need)  # in the id's own type: text, or longs beyond 2**53
    train = (d < F.lit(cut_date)) | ((d == F.lit(cut_date)) & (ident <= F.lit(cut_id)))
    return df.withColumn(PART, F.when(train, "train").otherwise("test"))


def _preparation(numeric: list[str], categorical: list[str], train: DataFrame) -> Pipeline:
    """Filled, scaled numbers (``__num_std``) and one-hot categories; each column's values depend on that column alone."""
    modes = {c: mode for c, (mode, _) in category_levels(train, categorical).items()}
    stages = [SQLTransformer(statement=fill_statement(train, categorical, numeric, modes, "__c_", "__i_"))]
    stages.append(VectorAssembler(inputCols=[f"__i_{c}" for c in numeric], outputCol="__num_vec"))
    stages.append(StandardScaler(inputCol="__num_vec", outputCol="__num_std", withMean=True, withStd=True))
    if categorical:
        idx = [f"__x_{c}" for c in categorical]
        stages.append(StringIndexer(inputCols=[f"__c_{c}" for c in categorical], outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=[f"__o_{c}" for c in categorical], dropLast=False, handleInvalid="keep"))
    return Pipeline(stages=stages)


def _logistic(at: int, places: list[int], categorical: list[str], total_weight: float, weight: str | None) -> Pipeline:
    """The model over the numbers at some places of ``__num_std`` and all categories; its columns end in ``at``."""
    stages = [VectorSlicer(inputCol="__num_std", outputCol=f"__num_{at}", indices=places),
              VectorAssembler(inputCols=[f"__num_{at}", *[f"__o_{c}" for c in categorical]], outputCol=f"__features_{at}")]
    # L2 with C = 1 on the summed weighted log loss == regParam 1/sum(w) on its weighted mean
    fit = LogisticRegression(featuresCol=f"__features_{at}", labelCol="__conv", maxIter=1000,
                             regParam=1.0 / max(total_weight, 1e-12), elasticNetParam=0.0, standardization=False,
                             probabilityCol=f"__prob_{at}", rawPredictionCol=f"__raw_{at}", predictionCol=f"__pred_{at}")
    return Pipeline(stages=[*stages, fit.setWeightCol(weight) if weight else fit])


def fit_and_score_all(train: DataFrame, test: DataFrame, numeric: dict[str, list[str]], categorical: list[str],
                      weight: str | None = None) -> DataFrame:
    """Fit one logistic model for each list of numbers, and return test rows with a probability column for each name.

    Filling, scaling and indexing are learned once, over the columns of all models."""
    columns = list(dict.fromkeys(c for own in numeric.values() for c in own))
    total = train.agg(F.sum(F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w")).first().w
    prepared = _preparation(columns, categorical, train).fit(train)
    ready, scored = prepared.transform(train), prepared.transform(test)
    for at, (name, own) in enumerate(numeric.items()):
        model = _logistic(at, [columns.index(c) for c in own], categorical, float(total or 0.0), weight).fit(ready)
        scored = model.transform(scored).withColumn(name, vector_to_array(f"__prob_{at}")[1])
    return scored


def fit_and_score(train: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str],
                  weight: str | None = None) -> DataFrame:
    """Fit one logistic model and return test rows with ``p_convert``."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_and_score_all(train, test, {"p_convert": numeric}, categorical, weight)
    finally:
        train.unpersist()


def demand_diagnostic(hist: DataFrame, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    """(metrics per model, improvement row)."""
    cats = [c for c in spec.categorical_columns if c in hist.columns]
    risk = [c for c in spec.numeric_columns if c in hist.columns]
    w = spec.weight_column if spec.weight_column and spec.weight_column in hist.columns else None
    need = [spec.date_column, spec.id_columns[0], *cats, *risk, *([w] if w else []), "__conv", "log_own_premium", "log_market_anchor"]
    # written with the columns that the steps below read, so that none of them repeats the anchors' joins
    rows = materialize(usable_rows(hist, spec).select(*dict.fromkeys(need)), "demand-rows")
    ready = readiness(rows, spec).first()
    spark = hist.sparkSession
    if ready.status != "ready":
        none = spark.createDataFrame([], "__conv double, p_convert double")
        empty = binary_metrics(none, "__conv", "p_convert").withColumn("model", F.lit("")).where("false")
        return empty, spark.createDataFrame([(ready.status, None, None, None)], IMPROVEMENT)
    cut = chronological_cut(rows, spec)
    train = cut.where(F.col(PART) == "train")
    test = cut.where(F.col(PART) == "test")
    both = {"baseline": [*risk, "log_own_premium"], "with_market_anchor": [*risk, "log_own_premium", "log_market_anchor"]}
    names = {name: f"__p_{name}" for name in both}
    scored = fit_and_score_all(train, test, {names[name]: own for name, own in both.items()}, cats, w)
    scored = materialize(scored.select("__conv", *names.values()), "demand-scores")  # metrics read it several times
    out = None
    for name, column in names.items():
        m = binary_metrics(scored.select("__conv", F.col(column).alias("p_convert")), "__conv", "p_convert").withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    out = out.persist()
    return out, improvement_of(out)


def improvement_of(metrics: DataFrame) -> DataFrame:
    """Gain of the second model over the first from a metrics table (model, log_loss, brier)."""
    side = lambda name: metrics.where(F.col("model") == name).select(F.col("log_loss"), F.col("brier"))
    pair = side("baseline").toDF("l0", "b0").withColumn("k", F.lit(1)).join(side("with_market_anchor").toDF("l1", "b1").withColumn("k", F.lit(1)), "k")
    return pair.select(F.lit("diagnostic_only").alias("status"), (F.col("l0") - F.col("l1")).alias("incremental_log_loss_improvement"),
                       (F.col("b0") - F.col("b1")).alias("incremental_brier_improvement"),
                       (F.col("l1") < F.col("l0")).alias("passes_incremental_signal_check"))
