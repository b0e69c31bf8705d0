"""Incremental batch scoring of arriving quote files with a frozen anchor model.

The reference scores whole files; on Spark the same contract (C1-C2) runs
over a file stream: ``readStream`` of new parquet/CSV quote files, each
micro-batch scored by ``anchors.score_anchor`` inside ``foreachBatch`` and
written to ``<out>/batch_id=<id>`` with overwrite, so a replayed batch after an
executor or driver failure rewrites the same folder (idempotent, exactly-once
with the checkpoint). ``trigger(availableNow=True)`` processes what is there
and stops, which is how a scheduled scoring job runs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from quotelens.operators.anchors import score_anchor
from quotelens.operators.models import PriceModel
from quotelens.spec import PanelSpec


def score_stream(spark: SparkSession, source: str, schema, spec: PanelSpec, model: PriceModel, out: str,
                 checkpoint: str, fmt: str = "parquet", model_sha256: str | None = None,
                 max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scored = score_anchor(batch, spec, model, model_sha256)
        scored.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    return (stream.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
