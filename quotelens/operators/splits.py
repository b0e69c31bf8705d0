"""Time-aware splits, training look-back and training weights.

The fraction split never sorts the rows: the two cut dates are exact order
statistics of the date column (distributed selection, see
``functions.quantiles``), and each row is labelled by comparing its date with
them. Rows sharing a cut date all go to the earlier part.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import elapsed_days, minus_months, ntz_at, ntz_micros
from quotelens.functions.quantiles import order_statistics
from quotelens.spec import PanelSpec

SPLIT = "_split"
SPLITS = ("train", "validation", "test")


def ts_lit(value) -> Column:
    """Literal timestamp without time zone from a Python datetime/date/str."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def time_split(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Label usable rows (target and date not null) train / validation / test in ``_split``."""
    d = F.col(spec.date_column)
    working = df.where(F.col(spec.target_column).isNotNull() & d.isNotNull())
    if spec.train_end_date or spec.validation_end_date:
        if not (spec.train_end_date and spec.validation_end_date):
            raise ValueError("An explicit split needs train_end_date as well as validation_end_date")
        cut1, cut2 = ts_lit(spec.train_end_date), ts_lit(spec.validation_end_date)
        labelled = working.withColumn(
            SPLIT, F.when(d <= cut1, "train").when(d <= cut2, "validation").otherwise("test"))
        _check_parts(labelled)
        return labelled
    ends: dict = {}

    def ranks(n: int) -> list[int]:
        test_size = max(1, int(round(n * spec.test_fraction)))
        val_size = max(1, int(round(n * spec.validation_fraction)))
        ends.update(train=n - val_size - test_size, validation=n - test_size, test=n)
        return list(ends.values()) if n >= 10 and ends["train"] >= 1 else []
    stats, n = order_statistics(working, ntz_micros(d), ranks)  # counts the rows too
    if n < 10:
        raise ValueError(f"A time split needs 10 or more dated rows with a target, got {n}")
    if ends["train"] < 1:
        raise ValueError("The split fractions leave no training rows")
    cut1, cut2, last = (int(stats[ends[s]]) for s in SPLITS)
    t = d.cast("timestamp_ntz")
    labelled = working.withColumn(SPLIT, F.when(t <= ntz_at(cut1), "train").when(t <= ntz_at(cut2), "validation").otherwise("test"))
    if not cut1 < cut2 < last:  # a part without rows: cut dates are dates of rows
        _check_parts(labelled)
    return labelled


def _check_parts(labelled: DataFrame) -> None:
    counts = {r[SPLIT]: r["count"] for r in labelled.groupBy(SPLIT).count().collect()}
    if min(counts.get(s, 0) for s in SPLITS) == 0:
        raise ValueError(f"A part of the time split has no rows ({counts}); change the fractions or the cut-off dates")


def split_metadata(split: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows and first/last date (as DATE) per part."""
    d = F.col(spec.date_column)
    return split.groupBy(SPLIT).agg(
        F.count("*").alias("rows"), F.to_date(F.min(d)).alias("date_min"),
        F.to_date(F.max(d)).alias("date_max"))


def train_lookback(split: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keep train rows dated >= max(train date) - k months; other parts unchanged."""
    kept, meta = lookback_window(split, spec)
    if meta["rows"] < spec.min_train_rows:
        raise ValueError(f"The training look-back keeps {meta['rows']} rows; min_train_rows is {spec.min_train_rows}")
    return kept


def lookback_window(split: DataFrame, spec: PanelSpec) -> tuple[DataFrame, dict]:
    """Rows after the look-back, and its start, its end and the train rows before and after it."""
    d = F.col(spec.date_column)
    train = split.where(F.col(SPLIT) == "train")
    cutoff = train.agg(F.max(d).alias("c")).first().c
    start = minus_months(ts_lit(cutoff), spec.lookback_months)
    row = train.agg(F.count("*").alias("before"), F.count_if(d >= start).alias("after"), F.first(start).alias("start")).first()
    kept = split.where((F.col(SPLIT) != "train") | (d >= start))
    return kept, {"start": row.start, "end": cutoff, "rows_before": row.before, "rows": row.after}


def sample_weight(df: DataFrame, spec: PanelSpec, name: str = "sample_weight") -> DataFrame:
    """Portfolio weight: NULL -> 0; negative or no positive weight is an error."""
    w = spec.weight_column
    if not w or w not in df.columns:
        return df.withColumn(name, F.lit(1.0))
    col = F.coalesce(F.col(w).try_cast("double"), F.lit(0.0))
    chk = df.agg(F.count_if(col < 0).alias("neg"), F.count_if(col > 0).alias("pos")).first()
    if chk.neg or not chk.pos:
        raise ValueError(f"Weights in {w!r} must not be negative, and one must be positive")
    return df.withColumn(name, col)


def recency_weight(df: DataFrame, spec: PanelSpec, as_of=None, name: str = "training_weight") -> DataFrame:
    """base * 0.5 ** (max(age_days, 0) / half_life), normalised by the mean positive weight."""
    out = sample_weight(df, spec, "__base_w")
    raw = F.col("__base_w")
    if spec.recency_half_life_days is not None:
        d = F.col(spec.date_column)
        cutoff = ts_lit(as_of) if as_of is not None else None
        if cutoff is None:
            mx = df.agg(F.max(d).alias("m")).first().m
            cutoff = ts_lit(mx) if mx is not None else None
        if cutoff is not None:
            age = F.coalesce(F.greatest(elapsed_days(cutoff, d), F.lit(0)), F.lit(0))
            raw = raw * F.pow(F.lit(0.5), age / F.lit(float(spec.recency_half_life_days)))
    out = out.withColumn("__raw_w", raw)
    mean_pos = out.agg(F.avg(F.when(F.col("__raw_w") > 0, F.col("__raw_w"))).alias("m")).first().m
    if not mean_pos or mean_pos <= 0:
        raise ValueError("No training weight is above zero after recency weighting")
    return out.withColumn(name, F.col("__raw_w") / F.lit(mean_pos)).drop("__base_w", "__raw_w")


def market_data(split: DataFrame, spec: PanelSpec, meta) -> DataFrame:
    """Role, market-component and temporal columns of all parts, labelled by ``_split``."""
    roles = [*spec.id_columns, spec.date_column, *spec.categorical_columns, *spec.numeric_columns]
    roles += [c for c in (spec.own_premium_column, spec.conversion_column, spec.weight_column) if c]
    keep = list(dict.fromkeys(roles + list(meta.competitor_columns) + list(meta.market_component_columns)
                              + list(meta.temporal_columns)))
    return split.select(*[c for c in keep if c in split.columns], SPLIT)
