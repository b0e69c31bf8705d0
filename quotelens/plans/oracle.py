"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code, in DuckDB's own list functions, over
the same quote panel text. ``wrap`` applies the output normalisation shared
with ``plans.registry.normalize``: doubles rounded to 6 decimals, integers as
BIGINT, dates as ISO text.
"""

from __future__ import annotations

from quotelens.plans.fixtures import quotes_sql_for_duckdb

COMPS = ["comp_a_premium", "comp_b_premium", "comp_c_premium", "comp_d_premium", "comp_e_premium"]


def _sum(exprs: list[str]) -> str:
    return "(" + " + ".join(exprs) + ")"


def quotes_cte() -> str:
    return f"quotes AS ({quotes_sql_for_duckdb()})"


def features_ctes(top_n: int = 3, policy: str = "available", aggregation: str = "avg_top_n",
                  temperature: float = 25.0) -> str:
    """CTEs quotes, m (masked), s (sorted list), feat (all components)."""
    masked = ", ".join(f"CASE WHEN {c} > 0 THEN {c} END AS {c}" for c in COMPS)
    lst = "[" + ", ".join(COMPS) + "]"
    complete = " AND ".join(f"{c} IS NOT NULL" for c in COMPS)
    structs = "[" + ", ".join(
        f"{{'p': {c}, 'pos': {i}, 'name': '{c}'}}" for i, c in enumerate(COMPS)) + "]"
    names = "[" + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '{c}' END" for c in COMPS) + "]"
    avg_cols = []
    for n in sorted({3, 5, top_n}):
        e = f"CASE WHEN len(s) >= {n} THEN {_sum([f's[{i}]' for i in range(1, n + 1)])} / {n} END"
        if policy == "complete":
            e = f"CASE WHEN {complete} THEN {e} END"
        avg_cols.append(f"{e} AS avg_top_{n}_competitor_premium")
    median = "CASE WHEN len(s) > 0 THEN (s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1]) / 2 END"
    softmin = (f"CASE WHEN len(s) > 0 THEN list_min(s) - {temperature} * ln(greatest("
               f"list_avg(list_transform(s, lambda x: exp(-(x - list_min(s)) / {temperature}))), 1e-12)) END")
    target = {
        "avg_top_n": f"CASE WHEN len(s) >= {top_n} THEN {_sum([f's[{i}]' for i in range(1, top_n + 1)])} / {top_n} END",
        "min": "list_min(s)",
        "median": median,
        "softmin": softmin,
    }[aggregation]
    if policy == "complete":
        target = f"CASE WHEN {complete} THEN {target} END"
    rank_terms = _sum([f"CASE WHEN {c} < own_premium THEN 1 ELSE 0 END" for c in COMPS])
    return f"""{quotes_cte()},
m AS (SELECT * REPLACE ({masked}) FROM quotes),
sl AS (SELECT *, list_sort(list_filter({lst}, lambda x: x IS NOT NULL)) AS s FROM m),
f0 AS (
  SELECT *,
    {", ".join(avg_cols)},
    {target} AS tgt,
    list_min(s) AS min_competitor_premium,
    list_max(s) AS max_competitor_premium,
    {median} AS median_competitor_premium,
    {softmin} AS softmin_competitor_premium,
    list_stddev_samp(s) AS competitor_premium_std,
    CAST(len(s) AS BIGINT) AS competitor_count,
    array_to_string(list_filter({names}, lambda x: x IS NOT NULL), '|') AS competitor_panel_signature,
    CASE WHEN len(s) >= {top_n} THEN array_to_string(list_sort(list_transform(list_slice(
      list_sort(list_filter({structs}, lambda x: x.p IS NOT NULL)), 1, {top_n}), lambda x: x.name)), '|')
    END AS top_n_competitor_signature,
    CASE WHEN own_premium IS NOT NULL THEN CAST(1 + {rank_terms} AS DOUBLE) END AS rank_own_premium,
    CASE WHEN {complete} THEN TRUE ELSE FALSE END AS complete_panel
  FROM sl
),
feat AS (
  SELECT *,
    tgt / (SELECT median(tgt) FROM f0) AS market_price_index,
    own_premium / NULLIF(tgt, 0) AS own_ratio,
    own_premium - tgt AS own_gap,
    own_premium / NULLIF(min_competitor_premium, 0) AS own_to_min_competitor_ratio,
    CASE WHEN rank_own_premium <= {top_n} THEN 1 ELSE 0 END AS top_indicator,
    coalesce(avg(tgt) OVER (PARTITION BY region, channel), avg(tgt) OVER ())
      / avg(tgt) OVER () AS segment_market_aggressiveness,
    date_trunc('month', quote_date) AS qmonth,
    year(quote_date) AS quote_year, month(quote_date) AS quote_month_num,
    quarter(quote_date) AS quote_quarter, weekofyear(quote_date) AS quote_weekofyear,
    isodow(quote_date) - 1 AS quote_dayofweek,
    CAST(floor((epoch_us(quote_date) - epoch_us(TIMESTAMP '2000-01-01')) / 86400000000.0) AS BIGINT)
      AS quote_time_days
  FROM f0
)"""


def wrap(body: str, cols: str, ctes: str | None = None) -> str:
    """Final SELECT with normalised output columns. ``cols``: 'name:kind, ...'
    with kind d (double), i (bigint), s (text), date, ts, b (boolean)."""
    exprs = []
    for item in cols.split(","):
        name, kind = [x.strip() for x in item.strip().split(":")]
        ref = f'r."{name}"'
        exprs.append({
            "d": f"round(CAST({ref} AS DOUBLE), 6)",
            "i": f"CAST({ref} AS BIGINT)",
            "s": f"CAST({ref} AS VARCHAR)",
            "date": f"strftime(CAST({ref} AS DATE), '%Y-%m-%d')",
            "ts": f"strftime(CAST({ref} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
            "b": f"CAST({ref} AS BOOLEAN)",
        }[kind] + f' AS "{name}"')
    inner = f"WITH {ctes}\n{body}" if ctes else body
    return f"SELECT {', '.join(exprs)}\nFROM (\n{inner}\n) r"


def split_ctes(train_end: str | None = None, validation_end: str | None = None,
               val_frac: float = 0.15, test_frac: float = 0.20) -> str:
    """CTEs after ``features_ctes``: usable rows, cut dates, labelled split."""
    if train_end:
        cuts = (f"cuts AS (SELECT TIMESTAMP '{train_end}' AS cut1, TIMESTAMP '{validation_end}' AS cut2)")
    else:
        cuts = f"""sizes AS (
  SELECT n, greatest(1, CAST(round_even(n * CAST({test_frac} AS DOUBLE), 0) AS BIGINT)) AS ts,
            greatest(1, CAST(round_even(n * CAST({val_frac} AS DOUBLE), 0) AS BIGINT)) AS vs
  FROM (SELECT count(*) AS n FROM usable)),
ranked AS (SELECT quote_date, row_number() OVER (ORDER BY quote_date) AS rn FROM usable),
cuts AS (
  SELECT (SELECT quote_date FROM ranked, sizes WHERE rn = n - vs - ts) AS cut1,
         (SELECT quote_date FROM ranked, sizes WHERE rn = n - ts) AS cut2)"""
    return f"""usable AS (SELECT * FROM feat WHERE tgt IS NOT NULL AND quote_date IS NOT NULL),
{cuts},
labelled AS (
  SELECT u.*, CASE WHEN quote_date <= cut1 THEN 'train' WHEN quote_date <= cut2 THEN 'validation'
                   ELSE 'test' END AS _split
  FROM usable u, cuts)"""


def eval_ctes(lookback_months: int = 4, half_life: float = 60.0,
              cells: tuple[str, ...] = ("vehicle_segment", "coverage_type")) -> str:
    """CTEs after ``split_ctes``: look-back, recency weights, segment-mean anchor, predictions."""
    keys = ", ".join(cells)
    on = " AND ".join(f"p.{c} IS NOT DISTINCT FROM c.{c}" for c in cells)
    return f"""tcut AS (SELECT max(quote_date) AS cutoff FROM labelled WHERE _split = 'train'),
lb AS (
  SELECT l.* FROM labelled l, tcut
  WHERE l._split <> 'train' OR l.quote_date >= tcut.cutoff - INTERVAL {lookback_months} MONTH),
trw AS (
  SELECT lb.*, pow(0.5, greatest(floor((epoch_us(tcut.cutoff) - epoch_us(quote_date)) / 86400000000.0), 0)
                 / {half_life}) AS raw_w
  FROM lb, tcut WHERE _split = 'train'),
trw_n AS (SELECT trw.*, raw_w / (SELECT avg(raw_w) FROM trw WHERE raw_w > 0) AS training_weight FROM trw),
cellm AS (SELECT {keys}, sum(training_weight * tgt) / sum(training_weight) AS cell_mean FROM trw_n GROUP BY {keys}),
gmean AS (SELECT sum(training_weight * tgt) / sum(training_weight) AS gm FROM trw_n),
pred AS (
  SELECT p.*, coalesce(c.cell_mean, (SELECT gm FROM gmean)) AS prediction
  FROM lb p LEFT JOIN cellm c ON {on})"""


def metrics_sql(src: str, by: list[str], actual: str = "tgt", pred: str = "prediction",
                tie: str = "quote_id") -> str:
    """Regression metrics + Gini per group over relation ``src`` (SQL text of a FROM item)."""
    g = ", ".join(by)
    gsel = (g + ", ") if by else ""
    part = f"PARTITION BY {g} " if by else ""
    grp = f"GROUP BY {g}" if by else ""
    return f"""(WITH base AS (SELECT * FROM {src} WHERE {actual} IS NOT NULL AND {pred} IS NOT NULL
                 AND isfinite({actual}) AND isfinite({pred})),
  mm AS (SELECT {gsel}avg({actual}) AS my FROM base {grp}),
  agg AS (
    SELECT {gsel}count(*) AS n,
      sqrt(avg(({pred} - {actual}) * ({pred} - {actual}))) AS rmse,
      avg(abs({pred} - {actual})) AS mae,
      avg(abs(({actual} - {pred}) / {actual})) FILTER (WHERE {actual} <> 0) * 100 AS mape,
      avg({pred} - {actual}) AS mean_bias,
      avg(({pred} - {actual}) / {actual}) FILTER (WHERE {actual} <> 0) * 100 AS mean_bias_pct,
      sqrt(avg(pow(ln(1 + greatest({pred}, 0)) - ln(1 + greatest({actual}, 0)), 2))) AS rmsle,
      sum(({pred} - {actual}) * ({pred} - {actual})) AS sse,
      count(*) FILTER (WHERE {actual} <= 0) AS nonpos,
      sum(2 * (ln(greatest({pred}, 1e-6) / {actual}) + {actual} / greatest({pred}, 1e-6) - 1))
        FILTER (WHERE {actual} > 0) AS dev
    FROM base {grp}),
  sst AS (SELECT {gsel}sum(pow({actual} - my, 2)) AS sst,
                 sum(2 * (ln(my / {actual}) + {actual} / my - 1)) FILTER (WHERE {actual} > 0) AS dev0
          FROM base {"NATURAL JOIN mm" if by else ", mm"} {grp}),
  cp AS (SELECT {gsel}{pred} AS sc, {actual} AS y,
           row_number() OVER ({part}ORDER BY {pred}, {tie}) AS rn,
           count(*) OVER ({part}) AS cnt,
           sum(1.0) OVER ({part}ORDER BY {pred}, {tie} ROWS UNBOUNDED PRECEDING) / count(*) OVER ({part}) AS cw,
           sum({actual}) OVER ({part}ORDER BY {pred}, {tie} ROWS UNBOUNDED PRECEDING)
             / sum({actual}) OVER ({part}) AS cl FROM base),
  ca AS (SELECT {gsel}{actual} AS sc, {actual} AS y,
           row_number() OVER ({part}ORDER BY {actual}, {tie}) AS rn,
           count(*) OVER ({part}) AS cnt,
           sum(1.0) OVER ({part}ORDER BY {actual}, {tie} ROWS UNBOUNDED PRECEDING) / count(*) OVER ({part}) AS cw,
           sum({actual}) OVER ({part}ORDER BY {actual}, {tie} ROWS UNBOUNDED PRECEDING)
             / sum({actual}) OVER ({part}) AS cl FROM base),
  ap AS (SELECT {gsel}1 - 2 * sum(area) AS conc FROM (
           SELECT {gsel}(cw - lag(cw) OVER ({part}ORDER BY rn)) * (cl + lag(cl) OVER ({part}ORDER BY rn)) / 2 AS area
           FROM cp) t {grp}),
  aa AS (SELECT {gsel}1 - 2 * sum(area) AS conc FROM (
           SELECT {gsel}(cw - lag(cw) OVER ({part}ORDER BY rn)) * (cl + lag(cl) OVER ({part}ORDER BY rn)) / 2 AS area
           FROM ca) t {grp}),
  sy AS (SELECT {gsel}sum({actual}) AS s FROM base {grp})
  SELECT {gsel}
    CASE WHEN agg.nonpos = 0 AND agg.n >= 2 AND sst.dev0 <> 0 THEN 1 - agg.dev / sst.dev0 END AS d2,
    CASE WHEN sst.sst > 0 THEN 1 - agg.sse / sst.sst WHEN agg.sse = 0 THEN 1.0 ELSE 0.0 END AS r2,
    agg.rmse, agg.rmsle, agg.mae, agg.mape, agg.mean_bias, agg.mean_bias_pct,
    CASE WHEN agg.n >= 2 AND sy.s <> 0 AND abs(aa.conc) > 1e-12 THEN round(ap.conc / aa.conc, 6) END AS gini,
    agg.n
  FROM agg {" ".join(f"JOIN {t} USING ({g})" for t in ("sst", "ap", "aa", "sy")) if by else ", sst, ap, aa, sy"})"""
