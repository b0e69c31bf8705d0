"""Artifact manifest and verification.

A file's digest is a hash tree: sha-256 of its length and of the digests of its records of ``RECORD`` bytes, in
order. Files of at most ``WHOLE`` bytes come through the ``binaryFile`` source, many in parallel, and are cut into
records there. Larger ones, which that source refuses, are read by ranges: a task for some records of a
file, through the file system of its address (``pyarrow.fs``), so one file is hashed by many tasks. Both give the same
digest; only (path, sha256, bytes) rows come back.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a record, and of a file that is read whole.
RECORD, WHOLE = 16 * 1024 * 1024, 1024 * 1024 * 1024


def _record_hashes(record: int):
    """sha-256 of one record for each row (path, length, i)."""
    def hashes(batches):
        import pyarrow.fs
        for batch in batches:
            out = []
            for path, length, i in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "i"))):
                uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path
                system, inner = pyarrow.fs.FileSystem.from_uri(uri)
                with system.open_input_file(inner) as f:
                    f.seek(i * record)
                    out.append(hashlib.sha256(f.read(min(record, length - i * record))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), batch.column("i"), pa.array(out)], names=["path", "length", "i", "h"])
    return hashes


def file_hashes(spark: SparkSession, root: str, record: int = RECORD, whole: int = WHOLE) -> DataFrame:
    """(name, sha256, bytes) of every file at or below ``root`` that has content; name: the path after the root."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .where(~F.col("path").rlike(r"/(_SUCCESS|\.[^/]*\.crc)$")))
    last = root.rstrip("/").rsplit("/", 1)[-1]
    name = F.element_at(F.split("path", F.lit("/\\Q" + last + "\\E"), 2), -1)
    tree = lambda records: F.sha2(F.concat_ws(":", F.col("length").cast("string"), records), 256)
    starts = F.when(F.col("length") > 0, F.expr(f"sequence(0L, (length - 1) div {record})")).otherwise(F.array().cast("array<bigint>"))
    small = files.where(F.col("length") <= whole)
    parts = F.transform(starts, lambda i: F.sha2(F.substring(F.col("content"), (i * record + 1).cast("int"), F.lit(record)), 256))
    out = small.select("path", "length", tree(F.array_join(parts, ":")).alias("sha256"))
    large = files.where(F.col("length") > whole).select("path", "length")  # the content isn't read
    if not large.isEmpty():
        each = large.select("path", "length", F.explode(starts).alias("i"))
        tasks = int(each.count()) // 8 + 1
        hashed = each.repartition(tasks, "path", "i").mapInArrow(_record_hashes(record), "path string, length long, i long, h string")
        ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda r: r["h"]), ":")
        out = out.unionByName(hashed.groupBy("path", "length").agg(ordered.alias("records")).select("path", "length", tree(F.col("records")).alias("sha256")))
    return out.select(name.alias("name"), "sha256", F.col("length").alias("bytes"))


def folder_digest(spark: SparkSession, root: str) -> DataFrame:
    """One row (sha256, bytes): a digest of the digests of up to 256 groups of (name, content hash), so a
    renamed, swapped, changed or lost file shows, and no task holds the list of all files."""
    files = file_hashes(spark, root).withColumn("line", F.concat_ws(":", "name", "sha256"))
    groups = files.groupBy(F.substring(F.md5("name"), 1, 2).alias("g")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("line")), "\n"), 256).alias("h"), F.sum("bytes").alias("bytes"))
    return groups.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "g", "h"))), "\n"), 256).alias("sha256"),
                      F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"))


def _exists(spark: SparkSession, root: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def artifact_manifest(spark: SparkSession, artifacts: dict[str, str], config: dict | None = None) -> DataFrame:
    """One row per artifact: name, path, sha256 over its files' names and contents, bytes, config
    sha256. An artifact that is not there has NULL hash and bytes."""
    cfg = hashlib.sha256(json.dumps(config or {}, sort_keys=True, default=str).encode()).hexdigest()
    gone = spark.createDataFrame([(None, None)], "sha256 string, bytes long")
    parts = [(folder_digest(spark, root) if _exists(spark, root) else gone).withColumns({"artifact": F.lit(name), "path": F.lit(root)})
             for name, root in artifacts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("config_sha256", F.lit(cfg)).select("artifact", "path", "sha256", "bytes", "config_sha256")


def verify_manifest(spark: SparkSession, manifest: DataFrame, artifacts: dict[str, str]) -> DataFrame:
    """artifact, status: verified / mismatch / missing (listed hashes against the files as they are)."""
    current = artifact_manifest(spark, artifacts).select("artifact", F.col("sha256").alias("current_sha256"))
    j = manifest.select("artifact", "sha256").join(current, "artifact", "left")
    return j.withColumn("status", F.when(F.col("current_sha256").isNull(), "missing")
                        .when(F.col("current_sha256") == F.col("sha256"), "verified").otherwise("mismatch"))


def require_verified(spark: SparkSession, manifest: DataFrame, name: str, path: str) -> None:
    """Consuming path: hard error unless the artifact's current hash equals the listed one."""
    status = verify_manifest(spark, manifest.where(F.col("artifact") == name), {name: path}).first()
    if status is None or status.status != "verified":
        raise ValueError(f"{name} at {path} is {status.status if status else 'not listed'}: refused")


def write_manifest(manifest: DataFrame, path: str) -> str:
    """Freeze the listed hashes as a JSON record (a cached frame would be re-computed when an
    artifact path is overwritten, silently re-listing the new content)."""
    manifest.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("artifact string, path string, sha256 string, bytes long, config_sha256 string").json(path)
