"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's k-mers are runs of ``K`` pieces. Pieces end at a space or after another white-space
character, which stays (so line breaks count). In place of a piece of more than ``LONG`` bytes (a
line of a language without spaces, minified code, base64) stand its runs of ``CHARS`` characters,
one from each character. Each k-mer is numbered by its occurrence, and the pair is hashed. The hash's high bits deal the numbered k-mers to
``1 << BUCKET_BITS`` buckets; of each bucket the ``TUPLE`` least are selected, put back into text
order and hashed as a tuple. So a tuple survives only if the same k-mers are least and still come
in the same order: the likeness of two fingerprints (equal tuples among the buckets that either
uses) follows edit distance, not only shared words.

Positions take ``POSITION_BITS`` bits of a packed long; in texts of more pieces they wrap, alike for
equal texts. Defined results: null is the empty text, whose fingerprint is empty; two empty
fingerprints have likeness 1; equal texts have equal fingerprints; texts of fewer than K pieces
have one k-mer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelens.llm.ordering import ranged
from quotelens.session import materialize

K = 2
LONG = 32
CHARS = 8
TUPLE = 2
BUCKET_BITS = 5
POSITION_BITS = 24
LOW = (1 << POSITION_BITS) - 1
HIGH = 64 - BUCKET_BITS


def let(value: Column, body) -> Column:
    """body(value), with value computed once (the optimizer may not copy a lambda's argument)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash_of(x: Column) -> Column:
    return F.shiftright(x, POSITION_BITS)


def _bucket_of(x: Column) -> Column:
    return F.shiftrightunsigned(x, HIGH)


def _packed(hashed: Column, position: Column) -> Column:
    return F.shiftleft(hashed, POSITION_BITS).bitwiseOR(position.bitwiseAND(F.lit(LOW)))


def _pieces(text: Column) -> Column:
    long = lambda w: F.octet_length(w) > LONG
    runs = lambda chars: F.transform(chars, lambda c, i: F.concat_ws("", c, *(F.get(chars, i + j) for j in range(1, CHARS))))
    cut = lambda w: F.when(long(w), let(F.regexp_extract_all(w, F.lit("(?s)."), F.lit(0)), runs)).otherwise(F.array(w))
    return let(F.split(text, r" |(?<=[\t-\r])"), lambda words: F.when(F.exists(words, long), F.flatten(F.transform(words, cut))).otherwise(words))


def _kmers(words: Column) -> Column:
    """Sorted longs: k-mer hash above, position below."""
    return F.sort_array(F.transform(words, lambda w, i: _packed(F.xxhash64(w, *(F.get(words, i + j) for j in range(1, K))), i.cast("long"))))


def _numbered(kmers: Column) -> Column:
    """Longs of (k-mer, occurrence number): in a run of equal k-mers, the place in the run."""
    fresh = lambda x, i: _packed(F.xxhash64(_hash_of(x), i), x)
    n = F.size(kmers)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (_hash_of(F.get(kmers, i)) != _hash_of(F.get(kmers, i - 1))))

    def by_run(begin: Column) -> Column:
        run = lambda at, r: F.transform(F.slice(kmers, at + 1, F.coalesce(F.get(begin, r + 1), n) - at), fresh)
        single = F.transform(kmers, lambda x: _packed(F.xxhash64(_hash_of(x), F.lit(0)), x))
        return F.when(F.size(begin) == n, single).otherwise(F.flatten(F.transform(begin, run)))

    return F.sort_array(let(starts, by_run))


def _least(numbered: Column) -> Column:
    """The TUPLE least of each bucket; the array is sorted, so a bucket's members lie together."""
    return F.filter(numbered, lambda x, i: (i < TUPLE) | (_bucket_of(x) != _bucket_of(F.get(numbered, i - TUPLE))))


def _tuples(least: Column) -> Column:
    """For each bucket in use: bucket number above, 27 bits of the hash of its k-mers in text order below."""
    def of_bucket(x: Column, i: Column) -> Column:
        after = F.get(least, i + 1)
        pair = F.coalesce(_bucket_of(after) == _bucket_of(x), F.lit(False))
        forward = x.bitwiseAND(F.lit(LOW)) <= after.bitwiseAND(F.lit(LOW))
        value = (F.when(~pair, F.xxhash64(_hash_of(x))).when(forward, F.xxhash64(_hash_of(x), _hash_of(after)))
                 .otherwise(F.xxhash64(_hash_of(after), _hash_of(x))))
        first = (i == 0) | (_bucket_of(F.get(least, i - 1)) != _bucket_of(x))
        return F.when(first, F.shiftleft(_bucket_of(x), 27).bitwiseOR(F.shiftrightunsigned(value, 37)))
    return F.filter(F.transform(least, of_bucket), lambda t: t.isNotNull())


def fingerprint(text: Column) -> Column:
    """Array of longs below 2**32, one for each bucket in use; empty for a null or empty text."""
    none = F.expr("cast(array() as array<bigint>)")
    steps = let(_pieces(text), lambda words: let(_kmers(words), lambda k: let(_numbered(k), lambda n: let(_least(n), _tuples))))
    return F.when(F.coalesce(text, F.lit("")) == "", none).otherwise(steps)


def as_text(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Equal tuples as a share of the buckets that either fingerprint uses."""
    buckets = lambda x: F.transform(x, lambda t: F.shiftright(t, 27))
    used = F.size(F.array_union(buckets(a), buckets(b)))
    return F.when(used == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / used)


def next_rows(keys: DataFrame, order: list[Column]) -> DataFrame:
    """Adds next_k and next_h: the following row's keys in the order, the first row's after the last."""
    parts = ranged(keys, *order)
    inside = Window.partitionBy("part").orderBy(*order)
    local = parts.select("*", F.lead(F.struct("k", "h")).over(inside).alias("after"), F.row_number().over(inside).alias("place"))
    across = Window.orderBy("part")
    heads = local.where("place = 1").select("part", F.struct("k", "h").alias("head"))
    first = F.first("head").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = heads.select("part", F.coalesce(F.lead("head").over(across), first).alias("head"))
    found = F.when(F.col("after").isNotNull(), F.col("after")).otherwise(F.col("head"))
    return local.join(following, "part").withColumn("found", found).select(*keys.columns, F.col("found.k").alias("next_k"), F.col("found.h").alias("next_h"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 3) -> DataFrame:
    """id, text, edited, prints, edited_prints, next_prints of every row.

    The edited text has its last floor(n / share) code points replaced by as many first ones of
    the next row's text in descending order of ids (null ids last; after the last row, the first).
    Rows that share id and text follow one another. Rows are keyed by id and a text hash: texts
    are shuffled once by it, and the next row's prefix is sent to it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))  # null ids have a key of their own
    # both joins below read the same four columns, so that one exchange of texts serves them
    rows = docs.select(ident.alias("k"), F.xxhash64(text).alias("h"), text.alias("text"), fingerprint(text).alias("prints"))
    keys = (docs.select(F.col(id_col).alias("id"), ident.alias("k"), F.xxhash64(text).alias("h"), F.length(text).alias("n"))
            .groupBy("k", "h").agg(F.first("id").alias("id"), F.first("n").alias("n"), F.count("*").alias("copies")))
    wanted = materialize(next_rows(keys, [F.col("id").desc_nulls_last(), F.col("h")]), "next")
    asks = wanted.select("id", F.col("k").alias("by_k"), F.col("h").alias("by_h"), "copies", F.expr(f"cast(n div {share} as int)").alias("take"), "next_k", "next_h")
    heads = (rows.join(asks, (F.col("k") == F.col("next_k")) & (F.col("h") == F.col("next_h")))
             .select("id", "by_k", "by_h", "copies", "take", F.expr("left(text, take)").alias("head"), F.col("prints").alias("next_prints"))
             .dropDuplicates(["by_k", "by_h"]))
    joined = rows.join(heads, (F.col("k") == F.col("by_k")) & (F.col("h") == F.col("by_h")))
    copy = F.row_number().over(Window.partitionBy("k", "h").orderBy("h"))  # the join's own partitions: no exchange
    joined = joined.withColumn("again", F.when(F.col("copies") > 1, copy).otherwise(F.lit(1)) < F.col("copies"))
    edited = F.concat(F.expr("left(text, length(text) - take)"), F.when(F.col("again"), F.expr("left(text, take)")).otherwise(F.col("head")))
    after = F.when(F.col("again"), F.col("prints")).otherwise(F.col("next_prints"))
    out = joined.select("id", "text", edited.alias("edited"), "prints", after.alias("next_prints"))
    return out.select(F.col("id").alias(id_col), "text", "edited", "prints", fingerprint(F.col("edited")).alias("edited_prints"), "next_prints")
