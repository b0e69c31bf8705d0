"""Price models.

Preprocessing (M1): exact-median and mode imputation (a ``SQLTransformer`` with the
values found at fit time; of equally frequent levels the smallest), string
indexing with unseen/missing-at-score-time levels kept in an extra bucket and
one-hot for the GLM, ordered target statistics for trees, ``VectorAssembler``.

Estimators (M2/M4): ``gamma_boost`` and ``tweedie_boost`` (boosted trees on the gamma and
Tweedie deviance, see ``boosting``), ``glm_gamma`` (gamma GLM, log link: the exact gamma loss),
``gbt_log`` (boosted trees on ln(target), back-transformed with the weighted
mean of exp(residual)), ``gbt_log1p`` (squared error on ln(1 + target)), ``rf`` (random forest on the raw target), and
``segment_mean`` (recency-weighted mean per risk cell, a closed-form stand-in
whose results can be checked in SQL). All take a weight column; boosting stops by held-out rows if the
training frame marks some.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.functions.quantiles import grouped_quantiles
from quotelens.operators import batched_glm, boosting, target_stats
from quotelens.operators.joins import attach_group_values

BOOSTED = {"gamma_boost": 2.0, "tweedie_boost": 1.5}  # variance power
TREES = ("gbt_log", "gbt_log1p", "rf")
ESTIMATORS = ("glm_gamma", *TREES, *BOOSTED, "segment_mean")
#: Estimators that end by the rows held out for that.
STOPS_EARLY = ("gbt_log", "gbt_log1p", *BOOSTED)
TREE_BINS = 64

DEFAULT_PARAMS = {
    "glm_gamma": {"maxIter": 50, "regParam": 1e-4},  # tiny ridge: one-hot + calendar columns are collinear
    "gbt_log": {"maxIter": 60, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 1.0},
    "gbt_log1p": {"maxIter": 60, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 1.0},
    "rf": {"numTrees": 60, "maxDepth": 8},
    "gamma_boost": {},
    "tweedie_boost": {},
    "segment_mean": {},
}


@dataclass
class PriceModel:
    kind: str
    features: list[str]
    categorical: list[str]
    numeric: list[str]
    target: str
    params: dict = field(default_factory=dict)
    training_cutoff: str | None = None
    training_start: str | None = None
    training_rows: int | None = None
    scale: float = 1.0  # back-transform factor of gbt_log
    pipeline: PipelineModel | None = None
    cells: DataFrame | None = None  # segment_mean: cell means
    global_mean: float | None = None
    levels: DataFrame | None = None  # trees: target statistics of the levels
    prior: float | None = None
    boosted: dict | None = None
    design: dict | None = None  # batched GLM
    beta: list | None = None

    def meta(self) -> dict:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("pipeline", "cells", "levels")}


def category_levels(df: DataFrame, categorical: list[str]) -> dict[str, tuple[str | None, int]]:
    """Most frequent level (of equally frequent ones the smallest) and number of levels per column;
    one grouped count over all columns."""
    if not categorical:
        return {}
    long = df.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot([], categorical, "c", "v")
    counts = long.where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count("*").alias("n"))
    found = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"), F.count("*").alias("levels"))
    return {c: (None, 0) for c in categorical} | {r.c: (r.mode, r.levels) for r in found.collect()}


def _sql_str(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def fill_statement(train: DataFrame, categorical: list[str], numeric: list[str], modes: dict,
                   cat_prefix: str, num_prefix: str) -> str:
    """SQLTransformer text that fills missing values: the mode for categories, the exact median for
    numbers (0 for a column without values)."""
    medians = {}
    if numeric:
        long = train.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot([], list(numeric), "c", "v")
        medians = {c: q[0] for c, q in grouped_quantiles(long, "c", "v", [0.5]).items()}
    fills = [f"coalesce(CAST(`{c}` AS STRING), {_sql_str(modes[c]) if modes[c] is not None else 'NULL'}) AS `{cat_prefix}{c}`" for c in categorical]
    fills += [f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {float(medians.get(c, 0.0))!r}D) AS `{num_prefix}{c}`" for c in numeric]
    return f"SELECT {', '.join(['*', *fills])} FROM __THIS__"


def build_pipeline(kind: str, train: DataFrame, categorical: list[str], numeric: list[str],
                   label: str, weight: str | None, params: dict | None = None,
                   validation_indicator: str | None = None) -> Pipeline:
    params = {**DEFAULT_PARAMS.get(kind, {}), **(params or {})}
    levels = category_levels(train, categorical)
    modes = {c: mode for c, (mode, _) in levels.items()}
    imp_out = [f"__imp_{c}" for c in numeric]
    stages = [SQLTransformer(statement=fill_statement(train, categorical, numeric, modes, "__cat_", "__imp_"))]
    idx_out = [f"__idx_{c}" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=[f"__cat_{c}" for c in categorical], outputCols=idx_out,
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
    vec_in = list(imp_out)
    if kind == "glm_gamma" and categorical:
        ohe_out = [f"__ohe_{c}" for c in categorical]
        stages.append(OneHotEncoder(inputCols=idx_out, outputCols=ohe_out, handleInvalid="keep", dropLast=True))
        vec_in += ohe_out
    else:
        vec_in += idx_out
    stages.append(VectorAssembler(inputCols=vec_in, outputCol="__features", handleInvalid="keep"))
    common = {"featuresCol": "__features", "labelCol": label, "predictionCol": "__raw_prediction"}
    if weight:
        common["weightCol"] = weight
    if kind == "glm_gamma":
        est = GeneralizedLinearRegression(family="gamma", link="log", **common, **params)
    elif kind in ("gbt_log", "gbt_log1p"):
        est = GBTRegressor(seed=42, maxBins=TREE_BINS, **common, **params)
        if validation_indicator:
            est = est.setValidationIndicatorCol(validation_indicator)  # stops when the held-out error no longer falls
    elif kind == "rf":
        est = RandomForestRegressor(seed=42, maxBins=TREE_BINS, **common, **params)
    else:
        raise ValueError(f"Unknown estimator kind {kind!r}; one of {ESTIMATORS}")
    stages.append(est)
    return Pipeline(stages=stages)


def encode_categories(data: DataFrame, model: PriceModel, weight: str | None, held_out: str | None) -> DataFrame:
    """Rows with ordered target statistics of the categorical features; held-out rows get those of whole levels."""
    from quotelens.session import materialize
    rows = materialize(data.withColumn("__row", F.monotonically_increasing_id()), "fit-rows")
    train = rows.where(~F.coalesce(F.col(held_out), F.lit(False))) if held_out else rows
    model.levels = target_stats.level_statistics(train, model.categorical, model.target, weight)
    model.prior = target_stats.prior_mean(model.levels)
    if not model.categorical:
        return rows
    ordered = target_stats.ordered_statistics(train, "__row", model.categorical, model.target, weight, model.prior)
    encoded = train.join(ordered, "__row")
    if held_out:
        rest = rows.where(F.coalesce(F.col(held_out), F.lit(False)))
        encoded = encoded.unionByName(target_stats.encode(rest, model.levels, model.categorical, model.prior))
    return encoded


def fit_price_model(train: DataFrame, target: str, features: list[str], categorical: list[str],
                    numeric: list[str], kind: str = "glm_gamma", weight: str | None = None,
                    params: dict | None = None, cells: list[str] | None = None,
                    date_column: str | None = None, validation_indicator: str | None = None) -> PriceModel:
    """Fit on rows with a non-null target (positive for the gamma/log models).

    ``validation_indicator``: boolean column of rows that only decide when boosting stops."""
    from quotelens.session import checkpoint_dir, materialize
    checkpoint_dir(train.sparkSession)
    data = train.where(F.col(target).isNotNull())
    if kind in ("glm_gamma", "gbt_log", "gamma_boost"):
        data = data.where(F.col(target) > 0)
    if kind not in STOPS_EARLY:
        validation_indicator = None
    own = data.where(~F.coalesce(F.col(validation_indicator), F.lit(False))) if validation_indicator else data
    cut = start = None
    if date_column:
        r = own.agg(F.max(date_column).alias("mx"), F.min(date_column).alias("mn"), F.count("*").alias("n")).first()
        cut, start, n = (str(r.mx) if r.mx else None), (str(r.mn) if r.mn else None), r.n
    else:
        n = None
    model = PriceModel(kind=kind, features=list(features), categorical=list(categorical),
                       numeric=list(numeric), target=target, params=dict(params or {}),
                       training_cutoff=cut, training_start=start, training_rows=n)
    w = F.col(weight) if weight else F.lit(1.0)
    used = list(dict.fromkeys([*numeric, *categorical, target, *([weight] if weight else []), *([validation_indicator] if validation_indicator else [])]))
    if kind == "segment_mean":
        keys = list(cells if cells is not None else categorical)
        model.params["cells"] = keys
        model.global_mean = data.agg((F.sum(w * F.col(target)) / F.sum(w)).alias("m")).first().m
        # written, so that the joins of ``predict`` are planned by its real size
        model.cells = (materialize(data.groupBy(*keys).agg((F.sum(w * F.col(target)) / F.sum(w)).alias("__cell_mean")), "cells")
                       if keys else None)
        return model
    if kind in BOOSTED:
        numbers = [*numeric, *map(target_stats.prefix, categorical)]
        settings = boosting.BoostParams(**{"power": BOOSTED[kind], **DEFAULT_PARAMS[kind], **(params or {})})
        rows = encode_categories(data.select(*used), model, weight, validation_indicator)
        model.boosted = boosting.fit_boosted(rows, numbers, target, weight, validation_indicator, settings).meta()
        return model
    label = target
    fit_df = data
    if kind == "gbt_log":
        fit_df = data.withColumn("__log_label", F.log(F.col(target)))
        label = "__log_label"
    elif kind == "gbt_log1p":  # squared error on ln(1 + target), predictions floored at 0
        fit_df = data.withColumn("__log_label", F.log1p(F.greatest(F.col(target), F.lit(0.0))))
        label = "__log_label"
    plain = list(categorical)
    if kind in TREES:
        fit_df = encode_categories(fit_df.select(*dict.fromkeys([*used, label])), model, weight, validation_indicator)
        numeric, plain = [*numeric, *map(target_stats.prefix, categorical)], []
    fit_df = fit_df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model.pipeline = build_pipeline(kind, fit_df, plain, numeric, label, weight, params, validation_indicator).fit(fit_df)
        if kind == "gbt_log":
            own = fit_df.where(~F.coalesce(F.col(validation_indicator), F.lit(False))) if validation_indicator else fit_df
            scored = model.pipeline.transform(own)
            r = scored.agg((F.sum(w * F.exp(F.col("__log_label") - F.col("__raw_prediction"))) / F.sum(w))
                           .alias("s")).first()
            model.scale = float(r.s) if r.s else 1.0
    finally:
        fit_df.unpersist()
    return model


def check_features(model: PriceModel, df: DataFrame) -> None:
    missing = sorted(set(model.features) - set(df.columns))
    if missing:
        raise ValueError(f"Input cannot create required model features: {missing}")


def predict(model: PriceModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Adds ``out``; the input's columns are kept."""
    check_features(model, df)
    if model.kind == "segment_mean":
        keys = model.params.get("cells", [])
        gm = F.lit(model.global_mean).cast("double")
        if not keys:
            return df.withColumn(out, gm)
        joined = attach_group_values(df, model.cells, keys)
        return joined.withColumn(out, F.coalesce(F.col("__cell_mean"), gm)).drop("__cell_mean")
    cols = df.columns
    if model.beta is not None:
        return df.withColumn(out, mean_of(model))
    if model.levels is not None:
        df = target_stats.encode(df, model.levels, model.categorical, model.prior)
    if model.boosted is not None:
        scored = boosting.margins(boosting.Boosted(**model.boosted), df, "__margin")
        return scored.select(*cols, F.exp("__margin").alias(out))
    scored = model.pipeline.transform(df)
    pred = F.col("__raw_prediction")
    if model.kind == "gbt_log":
        pred = F.exp(pred) * F.lit(model.scale)
    elif model.kind == "gbt_log1p":
        pred = F.greatest(F.expm1(pred), F.lit(0.0))
    return scored.select(*cols, pred.alias(out))


def save_model(model: PriceModel, path: str) -> None:
    """Spark ML persistence for the pipeline, parquet for cell means, JSON metadata."""
    spark = None
    if model.pipeline is not None:
        model.pipeline.write().overwrite().save(os.path.join(path, "pipeline"))
    if model.cells is not None:
        model.cells.write.mode("overwrite").parquet(os.path.join(path, "cells"))
        spark = model.cells.sparkSession
    if model.levels is not None:
        model.levels.write.mode("overwrite").parquet(os.path.join(path, "levels"))
        spark = model.levels.sparkSession
    meta = json.dumps(model.meta(), sort_keys=True, default=str)
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "meta"))


def load_model(spark, path: str) -> PriceModel:
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first().value)
    model = PriceModel(**meta)
    if model.kind in BOOSTED or model.kind in TREES:
        model.levels = spark.read.parquet(os.path.join(path, "levels"))
    if model.kind == "segment_mean":
        if model.params.get("cells"):
            model.cells = spark.read.parquet(os.path.join(path, "cells"))
    elif model.kind not in BOOSTED and model.beta is None:
        model.pipeline = PipelineModel.load(os.path.join(path, "pipeline"))
    return model


def permutation_importance(model: PriceModel, validation: DataFrame, key: str, repeats: int = 5) -> DataFrame:
    """Mean and population std of the drop in R2 when one feature is permuted, over all rows with a target.

    The segment mean and boosted trees take one pass over blocks (``importance``). Spark ML's models can't be evaluated
    inside a task: for these, with the same blocks and orders, a block's rows are exchanged once, get the values they
    take as arrays and are dealt to all tasks; the (feature, repeat) cases are one explode of them and one transform, without a join.
    """
    from quotelens.operators import importance
    from quotelens.session import materialize
    target = model.target
    rows = validation.where(F.col(target).isNotNull())
    need = list(dict.fromkeys([key, target, *model.features]))
    rows = materialize(rows.select(*need), "importance")
    n = rows.count()
    if model.kind == "segment_mean":
        cells = [c for c in model.params.get("cells", []) if c in rows.columns]
        if cells and len(cells) == len(model.params["cells"]):
            errors = importance.cell_errors(rows, key, target, cells, model.cells, model.global_mean, repeats, n)
            return importance.importances(errors, rows, target, model.features)
    if model.boosted is not None:
        trees = boosting.Boosted(**model.boosted)
        margin, used = boosting.scorer(trees), set(boosting.used_features(trees))
        inputs = {f: target_stats.prefix(f) if f in model.categorical else f for f in model.features}
        inputs = {f: c for f, c in inputs.items() if c in used}
        encoded = target_stats.encode(rows, model.levels, model.categorical, model.prior).withColumns({c: F.col(c).cast("double") for c in inputs.values()})
        if inputs:
            errors = importance.squared_errors(encoded, key, target, inputs, lambda v: np.exp(margin({inputs[f]: x for f, x in v.items()})), repeats, n)
            return importance.importances(errors, rows, target, model.features)
    base = predict(model, rows, "__p").agg(_r2(F.col(target), F.col("__p")).alias("r2")).first().r2
    names = list(model.features)
    each = F.explode(F.sequence(F.lit(0), F.lit(len(names) * repeats - 1))).alias("__case")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the models' work by rows, not by the few blocks
    cases = importance.with_permuted(rows, key, names, repeats, n).repartition(tasks, key).select("*", each)
    cases = cases.withColumns({"__at": F.floor(F.col("__case") / repeats).cast("int"), "__repeat": F.col("__case") % repeats})
    changed = cases.select("__repeat", F.get(F.array(*map(F.lit, names)), F.col("__at")).alias("__feature"), *[
        (F.when(F.col("__at") == names.index(c), F.get(f"__v{names.index(c)}", F.col("__repeat"))).otherwise(F.col(c)) if c in names else F.col(c)).alias(c) for c in need])
    per = predict(model, changed, "__p").groupBy("__feature", "__repeat").agg(_r2(F.col(target), F.col("__p")).alias("r2"))
    drop = F.lit(base) - F.col("r2")
    return (per.groupBy(F.col("__feature").alias("feature"))
            .agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
            .orderBy(F.desc("importance_mean"), "feature"))


def _r2(y, p):
    sse = F.sum(F.pow(y - p, 2))
    sst = F.sum(F.pow(y, 2)) - F.pow(F.sum(y), 2) / F.count(y)
    return F.when(sst > 0, 1 - sse / sst).otherwise(F.lit(0.0))


def competitor_eligibility(split: DataFrame, comps: list[str], skip_missing: float = 0.40) -> DataFrame:
    """Per competitor: train missing rate, rows quoted per part, and whether a model is trained."""
    parts = split.groupBy().agg(*[
        x for c in comps for x in (
            F.avg(F.when(F.col("_split") == "train", F.col(c).isNull().cast("double"))).alias(f"{c}__miss"),
            F.count_if((F.col("_split") == "train") & F.col(c).isNotNull()).alias(f"{c}__train"),
            F.count_if((F.col("_split") == "validation") & F.col(c).isNotNull()).alias(f"{c}__validation"),
            F.count_if((F.col("_split") == "test") & F.col(c).isNotNull()).alias(f"{c}__test"))])
    stacked = parts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("competitor"), F.col(f"{c}__miss").alias("missing_rate_train"),
                 F.col(f"{c}__train").alias("n_train"), F.col(f"{c}__validation").alias("n_validation"),
                 F.col(f"{c}__test").alias("n_test")) for c in comps])).alias("s")).select("s.*")
    ok = ((F.col("missing_rate_train") <= skip_missing) & (F.col("n_train") >= 20)
          & (F.col("n_validation") >= 10) & (F.col("n_test") >= 10))
    return stacked.withColumn("eligible", ok)


def fit_competitors(split: DataFrame, comps: list[str], categorical: list[str], numeric: list[str], spec, power: float = 2.0,
                    ridge: float = 0.0) -> dict[str, PriceModel]:
    """A GLM for each competitor on the train rows where it quoted, weighted by recency as of its last one; all in one batched fit."""
    date = F.col(spec.date_column)
    train = split.where(F.col("_split") == "train")
    quoted = {c: F.col(c) > 0 for c in comps}
    facts = train.agg(*[f(F.when(q, date)).alias(f"{n}_{i}") for i, q in enumerate(quoted.values()) for n, f in (("mx", F.max), ("mn", F.min), ("n", F.count))]).first()

    def weight(i: int) -> Column:
        if spec.recency_half_life_days is None:
            return F.lit(1.0)
        from quotelens.functions.nullsafe import elapsed_days
        from quotelens.operators.splits import ts_lit
        return F.pow(F.lit(0.5), F.greatest(elapsed_days(ts_lit(facts[f"mx_{i}"]), date), F.lit(0)) / F.lit(float(spec.recency_half_life_days)))

    design = batched_glm.learn_design(train, categorical, numeric)
    members = F.filter(F.array(*[F.when(quoted[c], batched_glm.member(F.lit(i), F.col(c), weight(i))) for i, c in enumerate(comps) if facts[f"n_{i}"]]),
                       lambda m: m.isNotNull())
    betas = batched_glm.fit_groups(train, design, members, [i for i in range(len(comps)) if facts[f"n_{i}"]], power, ridge)
    return {comps[i]: PriceModel("glm_gamma", [*categorical, *numeric], categorical, numeric, comps[i], training_cutoff=str(facts[f"mx_{i}"]),
                                 training_start=str(facts[f"mn_{i}"]), training_rows=facts[f"n_{i}"], design=design.__dict__, beta=[float(x) for x in beta])
            for i, beta in betas.items()}


def competitor_predictions(split: DataFrame, models: dict[str, PriceModel], kept: list[str]) -> DataFrame:
    """Long frame (kept columns, competitor, actual, prediction) of every row and competitor that quoted."""
    each = F.explode(F.filter(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("competitor"), F.col(c).cast("double").alias("actual"), mean_of(m).alias("prediction")))
                                        for c, m in models.items()]), lambda x: x.isNotNull()))
    return split.select(*kept, each.alias("e")).select(*kept, "e.*")


def mean_of(model: PriceModel) -> Column:
    """The mean by a batched GLM, in generated code."""
    design = batched_glm.Design(**model.design)
    return F.exp(batched_glm.linear(design, F.array(*[F.lit(float(b)) for b in model.beta])))


def competitor_models(split: DataFrame, comps: list[str], features, categorical, numeric, spec,
                      kind: str = "glm_gamma", params: dict | None = None, save_to: str | None = None) -> DataFrame:
    """One model per eligible competitor on the rows where it quoted; unweighted metrics per part.

    The gamma GLM fits all competitors at once; other kinds one after the other. ``save_to``: folder that gets each
    competitor's model and the predictions of all parts, by competitor."""
    from quotelens.operators.metrics import regression_metrics
    from quotelens.operators.splits import recency_weight
    date_column, key = spec.date_column, spec.id_columns[0]
    elig = [r.competitor for r in competitor_eligibility(split, comps, spec.competitor_skip_missing_threshold).where("eligible").collect()]
    if not elig:
        return split.sparkSession.createDataFrame([], "competitor string")
    kept, long = [key, date_column, "_split"], None
    if kind == "glm_gamma":
        models = fit_competitors(split, sorted(elig), categorical, numeric, spec, **(params or {}))
        long = competitor_predictions(split, models, kept)
    else:
        models = {}
        for c in sorted(elig):
            rows = split.where(F.col(c).isNotNull())
            train = rows.where(F.col("_split") == "train")
            cutoff = train.agg(F.max(date_column).alias("m")).first().m
            train_w = recency_weight(train, spec, as_of=cutoff)
            held_out = None
            if kind in STOPS_EARLY:
                held_out = "__held_out"
                watched = rows.where(F.col("_split") == "validation").withColumn("training_weight", F.lit(1.0))
                train_w = train_w.withColumn(held_out, F.lit(False)).unionByName(watched.withColumn(held_out, F.lit(True)))
            models[c] = fit_price_model(train_w, c, features, categorical, numeric, kind=kind, weight="training_weight",
                                        params=params, date_column=date_column, validation_indicator=held_out)
            own = predict(models[c], rows, "__pc").select(*kept, F.lit(c).alias("competitor"), F.col(c).cast("double").alias("actual"), F.col("__pc").alias("prediction"))
            long = own if long is None else long.unionByName(own)
    if save_to:
        for c, m in models.items():
            save_model(m, f"{save_to}/{c}/model")
        long.write.mode("overwrite").partitionBy("competitor").parquet(f"{save_to}/predictions")
        long = split.sparkSession.read.parquet(f"{save_to}/predictions")
    return regression_metrics(long, "actual", "prediction", by=["competitor", "_split"], tiebreak=key)


def production_window(df: DataFrame, target: str, date_column: str, lookback_months: int) -> DataFrame:
    """Rows of the latest look-back window (cutoff = max date over all rows) with a target."""
    from quotelens.functions.nullsafe import minus_months
    from quotelens.operators.splits import ts_lit
    cutoff = df.agg(F.max(date_column).alias("c")).first().c
    start = minus_months(ts_lit(cutoff), lookback_months)
    d = F.col(date_column)
    return df.where((d >= start) & (d <= ts_lit(cutoff)) & F.col(target).isNotNull())


def time_validated_search(train: DataFrame, validation: DataFrame, target: str, features, categorical, numeric,
                          kind: str, grid: list[dict], metric: str = "mape", weight: str | None = None,
                          date_column: str | None = None, key: str | None = None) -> DataFrame:
    """Fit each parameter set on train, score the time-ordered validation part: trial table
    (trial, params JSON, metric value); d2/gini are maximised, the others minimised."""
    import json
    from quotelens.operators.metrics import regression_metrics
    spark = train.sparkSession
    rows = []
    for i, params in enumerate(grid):
        m = fit_price_model(train, target, features, categorical, numeric, kind=kind, weight=weight,
                            params=params, date_column=date_column)
        met = regression_metrics(predict(m, validation, "__ps"), target, "__ps", tiebreak=key).first().asDict()
        rows.append((i, json.dumps(params, sort_keys=True), float(met[metric]) if met[metric] is not None else None))
    return spark.createDataFrame(rows, "trial int, params string, value double").withColumn(
        "metric", F.lit(metric)).withColumn("direction", F.lit("maximize" if metric in ("d2", "gini") else "minimize"))


def best_trial(trials: DataFrame) -> DataFrame:
    """Best trial by its direction (M10) and running best over trials."""
    from pyspark.sql import Window
    d = trials.first().direction if trials.limit(1).count() else "minimize"
    order = F.desc("value") if d == "maximize" else F.asc("value")
    w = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    running = (F.max("value") if d == "maximize" else F.min("value")).over(w)
    return trials.withColumn("running_best", running).withColumn(
        "is_best", F.row_number().over(Window.orderBy(order, "trial")) == 1)


def apply_params(kind: str, params: dict, base: dict | None = None) -> dict:
    """Tuned parameters written over the configured ones, on a copy."""
    out = dict(DEFAULT_PARAMS.get(kind, {}))
    out.update(base or {})
    out.update(params or {})
    return out
