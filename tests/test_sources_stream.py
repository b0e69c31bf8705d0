import datetime as dt
import os

from pyspark.sql import functions as F

from quotelens.operators.models import fit_price_model
from quotelens.sources import io as IO
from quotelens.sources import manifest as G
from quotelens.spec import PanelSpec
from quotelens.streaming.score_stream import score_stream


def _quotes(spark):
    rows = [(i, dt.datetime(2025, 1, 1) + dt.timedelta(days=i), "ab"[i % 2], float(20 + i), 500.0 + i)
            for i in range(20)]
    return spark.createDataFrame(rows, "quote_id long, quote_date timestamp_ntz, region string, "
                                       "driver_age double, own_premium double")


def test_csv_and_parquet_round_trip(spark, tmp_path):
    q = _quotes(spark)
    IO.write_table(q, str(tmp_path / "q.csv"), fmt="csv")
    IO.write_table(q, str(tmp_path / "q.parquet"))
    a = IO.load_dataset(spark, str(tmp_path / "q.csv"), q.schema)
    b = IO.load_dataset(spark, str(tmp_path / "q.parquet"))
    assert sorted(a.collect()) == sorted(b.collect()) == sorted(q.collect())


def test_manifest_detects_changed_artifact(spark, tmp_path):
    q = _quotes(spark)
    path = str(tmp_path / "table")
    IO.write_table(q, path)
    listed = G.read_manifest(spark, G.write_manifest(G.artifact_manifest(spark, {"table": path}),
                                                     str(tmp_path / "manifest")))
    assert listed.count() == 1
    assert G.verify_manifest(spark, listed, {"table": path}).first().status == "verified"
    IO.write_table(q.where(F.col("quote_id") < 5), path)
    assert G.verify_manifest(spark, listed, {"table": path}).first().status == "mismatch"


def test_stream_scoring_scores_every_file_row(spark, tmp_path):
    q = _quotes(spark)
    model = fit_price_model(q.withColumn("y", F.col("own_premium") * 0.9), "y", ["region"], ["region"], [],
                            kind="segment_mean", cells=["region"], date_column="quote_date")
    src = str(tmp_path / "in")
    q.repartition(3).write.parquet(src)
    spec = PanelSpec(date_column="quote_date", id_columns=("quote_id",), own_premium_column="own_premium",
                     categorical_columns=("region",), numeric_columns=("driver_age",))
    out = str(tmp_path / "out")
    query = score_stream(spark, src, q.schema, spec, model, out, str(tmp_path / "ckpt"))
    query.awaitTermination()
    scored = spark.read.parquet(out)
    assert scored.count() == 20
    assert scored.where(F.col("market_anchor").isNull()).count() == 0
    assert os.path.isdir(str(tmp_path / "ckpt"))


def test_record_sink_writes_nan_as_null_and_iso_times(spark, tmp_path):
    import json
    df = spark.createDataFrame([(float("nan"), dt.datetime(2025, 3, 1, 12, 30), "a")],
                               "d2 double, at timestamp_ntz, name string")
    path = IO.write_records(df, str(tmp_path / "rec"))
    part = [f for f in os.listdir(path) if f.endswith(".json")][0]
    rec = json.loads(open(os.path.join(path, part)).readline())
    assert rec == {"d2": None, "at": "2025-03-01T12:30:00", "name": "a"}
