"""Quote panel derived from the driver's TPC-H-style tables (FIXTURES.md §3).

The same SQL text runs in Spark (tables bound as DataFrame parameters) and in
DuckDB (tables as views); prices are built from integer cents, so both engines
produce identical rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("lineitem", "orders", "customer", "nation", "region")

# Fixed text from FIXTURES.md §3; {name} marks a source table.
QUOTES_SQL_TEMPLATE = """
WITH rl AS (
  SELECT l_orderkey, COUNT(*) AS n_ret FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY l_orderkey
), b AS (
  SELECT o.o_orderkey AS k, o.o_orderdate AS quote_date, o.o_orderpriority AS channel,
         r.r_name AS region, c.c_mktsegment AS vehicle_segment,
         CASE WHEN o.o_orderkey % 5 = 0 THEN 'tpl' ELSE 'comprehensive' END AS coverage_type,
         CAST(18 + o.o_custkey % 60 AS DOUBLE) AS driver_age,
         CAST(o.o_orderkey % 21 AS DOUBLE) AS vehicle_age,
         CAST(COALESCE(rl.n_ret, 0) AS DOUBLE) AS claim_count_3y,
         CAST(FLOOR(o.o_totalprice / 10.0) AS BIGINT) AS si,
         (YEAR(o.o_orderdate) - 1995) * 12 + MONTH(o.o_orderdate) AS mi
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN rl ON rl.l_orderkey = o.o_orderkey
), p AS (
  SELECT *, 40000 + si + 200 * (k % 21) + 2500 * CAST(claim_count_3y AS BIGINT)
            - CASE WHEN coverage_type = 'tpl' THEN 15000 ELSE 0 END + 60 * mi AS base FROM b
), o AS (
  SELECT *, base + 1800 + ((k * 53) % 121 - 60) * 50 AS own_c FROM p
)
SELECT k AS quote_id, quote_date, channel, region, vehicle_segment, coverage_type,
  driver_age, vehicle_age, claim_count_3y, CAST(si AS DOUBLE) / 100 AS sum_insured,
  CASE WHEN (k * 7) % 20 < 3 THEN NULL ELSE CAST(base - 3200 + ((k * 31) % 97 - 48) * 50 AS DOUBLE) / 100 END AS comp_a_premium,
  CASE WHEN (k * 9 + 4) % 23 < 3 THEN NULL ELSE CAST(base - 1200 + ((k * 37) % 97 - 48) * 50 AS DOUBLE) / 100 END AS comp_b_premium,
  CASE WHEN (k * 11 + 8) % 19 < 3 THEN NULL ELSE CAST(base + 800 + ((k * 43) % 97 - 48) * 50 AS DOUBLE) / 100 END AS comp_c_premium,
  CASE WHEN (k * 13 + 2) % 17 < 3 THEN NULL ELSE CAST(base + 2800 + ((k * 47) % 97 - 48) * 50 AS DOUBLE) / 100 END AS comp_d_premium,
  CASE WHEN (k * 17 + 6) % 29 < 3 THEN NULL WHEN k % 211 = 0 THEN -1.0E0 ELSE CAST(base + 5200 + ((k * 53) % 97 - 48) * 50 AS DOUBLE) / 100 END AS comp_e_premium,
  CASE WHEN k % 101 = 0 THEN NULL ELSE CAST(own_c AS DOUBLE) / 100 END AS own_premium,
  CASE WHEN own_c < base + 800 + ((k * 17) % 41 - 20) * 100 THEN 1 ELSE 0 END AS converted
FROM o
"""


def quotes_sql_for_duckdb() -> str:
    return QUOTES_SQL_TEMPLATE.format(**{t: t for t in SOURCE_TABLES})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quote_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quote panel as a lazy DataFrame over the parquet tables."""
    frames = {t: read_table(spark, sf_dir, t) for t in SOURCE_TABLES}
    return spark.sql(QUOTES_SQL_TEMPLATE, **frames)
