"""Corpus pipeline: documents in, packed training sequences out.

Each stage works on all that the one before kept, and its result is written as Parquet and read
again. All but the last return the columns of ``documents``:

1. language ID: texts without a letter, and texts for which no language reaches half of the
   posterior, go;
2. MinHash near-dedup: one document of each group of near copies stays, the one of smallest id;
3. secret scans: credentials that at most two sources hold are replaced by ``[SECRET]`` (and
   ``n_chars`` set anew); widely copied examples and all other text stay;
4. source mixing: documents are repeated or drawn so that sources meet their budgets;
5. best-fit packing: token pieces with their places in sequences of 2,048.

Rows with nulls, empty texts and repeated rows are treated as the operators define (see their
docstrings); an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelens.llm import hyperminhash, langid, mixing, packing, secrets
from quotelens.llm.queries import tokenizer_file
from quotelens.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hyperminhash.keep_representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    clean = secrets.redact(docs, found)
    changed = F.col("text").contains("[SECRET]")
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw(docs, mixing.mix_sources(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_copies),
    ("secret scans", redact_secrets),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]
#: Trees, sketches, hashes and BPE have no SQL form; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
