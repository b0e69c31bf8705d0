"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every source gets a token budget (tokens are words): all sizes together are shared by weight, a
budget stops at ``max_epochs`` times its source's size, and what exceeds that is shared again
by weight until no budget is above. A source's budget is first spent on complete epochs; the rest
goes to its documents in ascending order of -ln(u) / quality, with u uniform from a hash of the
row, until the budget is spent. That is weighted sampling without replacement in favour of good
documents, and reruns agree.

The order within a source is never sorted in one task: keys fall into buckets by their
logarithm (so evenly for any quality), bucket sums give each bucket's start, and only a bucket is
sorted. Only ids, sizes and keys are shuffled. The number of resharing rounds is driven by two
sums over the table of sources.

Defined results: null and empty texts have size 0 and take nothing; a null source is a source of
its own, last in the order; sources without words get nothing; repeated rows are separate
documents, in any order among themselves; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelens.llm.ordering import with_rank
from quotelens.llm.words import unused
from quotelens.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Least quality of a document: even the worst can be drawn.
LEAST_QUALITY = 0.05
#: Rows that share a bucket of keys, about, at the densest keys.
BUCKET_ROWS = 20_000


def quality_of(text: Column) -> Column:
    """Share of a text's characters that are letters or white space."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\s]", ""))
    return F.greatest(F.coalesce(F.try_divide(plain, F.length(text)), F.lit(0.0)), F.lit(LEAST_QUALITY))


def budgets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Adds weight and target to (source, source_size)."""
    ranked = with_rank(sizes, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight), "sources")
    cap = F.col("source_size") * max_epochs
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, state, before = 0.0, None, ()
    while state != before:  # whole numbers, so the rounds end when no further source is above
        before, above = state, cap < F.col("weight") * F.lit(level)
        state = tuple(ranked.agg(F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first())
        level = max(level, (total - state[0]) / state[1]) if state[1] else level
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, quality: Column | None = None, seed: int = 42) -> DataFrame:
    """id, text_hash, size, source, source_size, target, epochs, extra, taken for every row.

    epochs: complete copies; extra: words of one more copy (the last document drawn may be cut);
    taken: all of its words in the mix."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), text), 11)
    u = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(u) / (quality if quality is not None else quality_of(text))).alias("key")), "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = budgets(per_source, weights, max_epochs)
    most = per_source.agg(F.max("rows")).first()[0] or 0
    steps = 16 + most // BUCKET_ROWS  # buckets for each doubling of the key; about a third of all keys lie in one
    sources = sources.select(
        F.col("source").alias("name"), "source_size", "target", F.floor("target").alias("budget"))
    sources = sources.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0))
    sources = sources.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    keyed = rows.withColumn("bucket", F.floor(F.log2("key") * steps))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
              .join(sources, F.col("source").eqNullSafe(F.col("name")))
              .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "start", "source_size", "target", "epochs", "rest"))
    joined = keyed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    upto = Window.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("start") + F.sum("size").over(upto) - F.col("size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    return (joined.withColumn("extra", extra)
            .select(F.col("id").alias(id_col), "text_hash", "size", "source", "source_size", "target", "epochs", "extra",
                    (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken")))


def draw(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as ``mix`` takes them: one row for each epoch, and one for a document drawn in part or whole.

    Documents are never cut here, so a source may exceed its budget by a part of one document.
    Rows that share id and text get the same number of copies."""
    key, digest, n, one = unused(docs, "_id", "_hash", "_copies", "_copy")
    copies = (mix.groupBy(F.col(id_col).alias(key), F.col("text_hash").alias(digest))
              .agg(F.max(F.col("epochs") + (F.col("extra") > 0).cast("int")).alias(n)).where(F.col(n) > 0))
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(digest))
    once = docs.join(copies.hint("merge"), same)  # copies grow with the documents: the same plan at every size
    return once.withColumn(one, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long")))).select(*docs.columns)
