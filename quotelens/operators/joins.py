"""Join helpers with checked broadcast sizes.

A side gets a broadcast hint only when the optimizer's size estimate of its
plan is under ``MAX_BROADCAST_BYTES`` (no job is run for the check). Any other
side is left to a shuffle join; AQE then re-checks the measured size of the
shuffled side at run time (``spark.sql.adaptive.autoBroadcastJoinThreshold``)
and converts to a broadcast join only when it is truly small, and splits hot
keys with its skew-join handling otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. remote session)
        return None


def maybe_broadcast(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is under the bound."""
    est = estimated_bytes(small)
    return F.broadcast(small) if est is not None and est <= max_bytes else small


def attach_group_values(df: DataFrame, groups: DataFrame, keys: list[str],
                        how: str = "left", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join per-group values back to rows on ``keys`` with NULL-safe equality."""
    renamed = groups
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__g_{k}")
    side = maybe_broadcast(renamed, max_bytes)
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(side[f"__g_{k}"]) for k in keys])
    out = df.join(side, cond, how)
    return out.drop(*[f"__g_{k}" for k in keys])
