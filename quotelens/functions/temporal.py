"""Calendar features of a quote date (ISO week, Monday=0 weekday)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import elapsed_days

TEMPORAL_COLUMNS = (
    "quote_year", "quote_month", "quote_quarter", "quote_weekofyear", "quote_dayofweek",
    "quote_time_days", "quote_month_sin", "quote_month_cos",
    "quote_dayofweek_sin", "quote_dayofweek_cos",
)


def temporal_columns(date: Column) -> dict[str, Column]:
    d = date.cast("timestamp_ntz")
    month = F.month(d)
    dow = F.weekday(d)  # Monday = 0
    two_pi = 2 * math.pi
    return {
        "quote_year": F.year(d),
        "quote_month": month,
        "quote_quarter": F.quarter(d),
        "quote_weekofyear": F.weekofyear(d),
        "quote_dayofweek": dow,
        "quote_time_days": elapsed_days(d, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")),
        "quote_month_sin": F.sin(two_pi * month / 12),
        "quote_month_cos": F.cos(two_pi * month / 12),
        "quote_dayofweek_sin": F.sin(two_pi * dow / 7),
        "quote_dayofweek_cos": F.cos(two_pi * dow / 7),
    }


def add_temporal_features(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumns(temporal_columns(F.col(date_column)))
