import datetime as dt

from pyspark.sql import functions as F

from quotelens.operators.splits import recency_weight, time_split
from quotelens.spec import PanelSpec, TargetSpec


def test_time_split_sizes_and_order(spark):
    rows = [(i, dt.datetime(2025, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, quote_date timestamp_ntz, y double")
    spec = PanelSpec(date_column="quote_date", validation_fraction=0.2, test_fraction=0.2,
                     target=TargetSpec(name="y"))
    s = time_split(df, spec)
    counts = {r._split: r["count"] for r in s.groupBy("_split").count().collect()}
    assert counts == {"train": 12, "validation": 4, "test": 4}
    b = {r._split: (r.lo, r.hi) for r in s.groupBy("_split").agg(F.min("quote_date").alias("lo"),
                                                                   F.max("quote_date").alias("hi")).collect()}
    assert b["train"][1] < b["validation"][0] and b["validation"][1] < b["test"][0]


def test_recency_weight_newer_weighs_more(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1),), (dt.datetime(2025, 3, 1),)], "quote_date timestamp_ntz")
    w = [r.training_weight for r in recency_weight(df, PanelSpec(date_column="quote_date")).orderBy("quote_date")
         .collect()]
    assert w[1] > w[0]


def test_rows_on_a_cut_date_go_to_the_earlier_part(spark):
    # 20 rows: dates 0..9 twice each; 20% test/validation cut at the 12th and 16th rows by date
    rows = [(i, dt.datetime(2025, 1, 1) + dt.timedelta(days=i // 2), float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, quote_date timestamp_ntz, y double")
    s = time_split(df, PanelSpec(date_column="quote_date", validation_fraction=0.2, test_fraction=0.2,
                                 target=TargetSpec(name="y")))
    parts = {r.id: r._split for r in s.collect()}
    # the 12th row (id 11) falls on day 5 together with id 10: both are train
    assert parts[10] == parts[11] == "train"
    by_day = {}
    for i, p in parts.items():
        by_day.setdefault(i // 2, set()).add(p)
    assert all(len(v) == 1 for v in by_day.values())


def test_wall_clock_micros_and_their_literals(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from quotelens.functions.nullsafe import ntz_at, ntz_micros
    times = ["2024-03-10 02:30:00.123456", "2024-11-03 01:59:59.5", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "0099-01-01 00:36:00.000001",
             "9999-12-31 23:59:59.999999", "1582-10-10 11:11:11.1"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(t,) for t in times], "s string").withColumn("t", F.col("s").cast("timestamp_ntz"))
        want = {t: (dt.datetime.fromisoformat(t) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for t in times}
        same = F.coalesce(*[F.when(F.col("s") == t, F.col("t") == ntz_at(m)) for t, m in want.items()])
        rows = df.select("s", ntz_micros("t").alias("m"), same.alias("same")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {r.s: r.m for r in rows} == want and all(r.same for r in rows)


def test_split_of_times_late_in_the_hour_counts_in_one_pass(spark):
    import pytest
    from pyspark.sql import functions as F

    from quotelens.operators import splits as S
    from quotelens.spec import quote_panel_spec
    spec = quote_panel_spec()
    rows = spark.range(40).select("id", (F.lit("2024-01-01 00:59:00").cast("timestamp_ntz") + F.expr("make_dt_interval(cast(id as int))")).alias(spec.date_column),
                                  F.lit(1.0).alias(spec.target_column))
    parts = {r[S.SPLIT]: r["count"] for r in S.time_split(rows, spec).groupBy(S.SPLIT).count().collect()}
    n_val, n_test = round(40 * spec.validation_fraction), round(40 * spec.test_fraction)
    assert parts == {"train": 40 - n_val - n_test, "validation": n_val, "test": n_test}
    with pytest.raises(ValueError, match="has no rows"):
        S.time_split(rows.withColumn(spec.date_column, F.lit("2024-01-01").cast("timestamp_ntz")), spec)
    with pytest.raises(ValueError, match="10 or more"):
        S.time_split(rows.where("id < 9"), spec)
    with pytest.raises(ValueError, match="10 or more"):
        S.time_split(rows.where("false"), spec)
