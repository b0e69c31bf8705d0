"""Registered queries (Spark) and their DuckDB oracles, keyed alike.

Every query reads the driver's parquet tables through the quote panel SQL,
runs over the whole tables, and returns a DataFrame normalised for the
cross-engine check (doubles rounded to 6 decimals, integers as BIGINT,
dates/timestamps as ISO text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelens.plans.fixtures import quote_panel
from quotelens.spec import PanelSpec, quote_panel_spec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Settings of the registered queries over the derived quote panel.
SPEC = quote_panel_spec(min_train_rows=200)


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            # round(v * 1e6) / 1e6 on the binary double, as DuckDB and Python round, so exact
            # decimal ties (means of cent values) land on the same side in both engines
            x = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            c = F.round(x * F.lit(1e6), 0) / F.lit(1e6)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_panel(spark, sf_dir)


_STAGES: dict = {}


def engineered(spark: SparkSession, sf_dir: str, spec: PanelSpec = SPEC):
    """The engineered market table, built once per session and data folder. Its row-wise
    stage is a parquet stage table (written inside ``engineer_market_features``); what sits
    on top is a projection and a size-checked broadcast join of segment means."""
    from quotelens.operators.components import engineer_market_features
    key = (spark.sparkContext.applicationId, sf_dir, spec)
    if key not in _STAGES:
        _STAGES[key] = engineer_market_features(panel(spark, sf_dir), spec)
    return _STAGES[key]


def clear_caches() -> None:
    """Forgets what the queries share, so that the next one pays for all it needs."""
    from quotelens.plans import queries_ml, queries_model
    for cache in (_STAGES, queries_model._EVAL_CACHE, queries_model._HIST_CACHE, queries_ml._ML):
        cache.clear()


def load_all() -> None:
    """Import the modules that register queries."""
    from quotelens.plans import queries_core  # noqa: F401
    from quotelens.plans import queries_model  # noqa: F401
    from quotelens.plans import queries_views  # noqa: F401
    from quotelens.plans import queries_ml  # noqa: F401
