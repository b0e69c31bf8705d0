"""Secret scan with corpus-wide ownership, in DataFrame functions only.

Candidates are found by patterns; their positions come from marking each match with a
private-use character and adding up the lengths between marks. Hashes of the candidates are then
counted over the whole corpus by distinct repositories and owners: what many owners hold is a
widely copied example, what at most ``max_owners`` hold is a live-looking credential of theirs.
Besides the base kinds the method adds spans of kind ``key``: long mixed-case tokens with digits,
without a keyword around them, provided that the corpus shows them to be owner-specific.

Hashes are counted for each owner and repository first, so a token in a third of all documents
costs one row for each of them. Only spans and ids are shuffled, texts never.

Defined results: null and empty texts have no spans; repeated rows are scanned alike; a row with
a null owner or repository counts to the owner or repository ``null``; marks that occur in a text
are read as another private-use character, which keeps every position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.llm.words import unused
from quotelens.session import materialize

KINDS = ("assign", "access", "hex", "key")
BASE_KINDS = 3
#: Around a match, between its two groups, and what they are read as where a text holds them.
MARK, SPLIT, OTHER = chr(0xE000), chr(0xE001), chr(0xE002)
#: In each pattern group 2 is the secret's value. Failing matches of ``assign`` use up their text, as
#: the whole pattern is matched before its value's length is tested; for the other kinds a
#: run that is too short holds no longer one, so the length can stand in the pattern.
PATTERNS = (
    r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""",
    r"()(AKIA[A-Z0-9]{16,})",
    r"()([0-9a-f]{24,})",
    r"()((?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,})",
)
SPAN = "struct<start:bigint,end:bigint,kind:int,value:string>"


def _is_secret(value: Column, kind: int) -> Column:
    if kind == 0:
        return F.length(value) >= 6
    if kind == 3:
        return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    return F.lit(True)


def spans_of(text: str, kind: int) -> Column:
    """Spans (start, end, kind, value) of one kind; ``text`` names a column free of marks."""
    marked = F.regexp_replace(F.col(text), F.lit(PATTERNS[kind]), F.lit(f"{MARK}$1{SPLIT}$2{MARK}"))

    def step(seen: Column, part: Column) -> Column:
        """Parts lie outside and inside marks in turn; inside, the split mark is no character of the text."""
        value, end = F.substring_index(part, SPLIT, -1), (seen["at"] + F.length(part) - 1)
        span = F.struct(seen["at"].alias("start"), end.alias("end"), F.lit(kind).alias("kind"), value.alias("value"))
        found = F.when(_is_secret(value, kind), F.array_append(seen["found"], span)).otherwise(seen["found"])
        return (F.when(seen["hit"], F.struct(end.alias("at"), F.lit(False).alias("hit"), found.alias("found")))
                .otherwise(F.struct((seen["at"] + F.length(part)).alias("at"), F.lit(True).alias("hit"), seen["found"].alias("found"))))

    start = F.expr(f"struct(0L as at, false as hit, cast(array() as array<{SPAN}>) as found)")
    return F.aggregate(F.split(marked, MARK), start, step, lambda seen: seen["found"])


def find_candidates(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """id, text_hash, repo, owner, spans and a row number of every row, written once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    free = F.when(text.rlike(f"[{MARK}{SPLIT}]"), F.translate(text, MARK + SPLIT, OTHER + OTHER)).otherwise(text)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), repo.cast("string").alias("repo"),
                       owner.cast("string").alias("owner"), free.alias("free"))
    found = F.concat(*(spans_of("free", kind) for kind in range(len(KINDS))))
    hashed = F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"], (s["end"] - F.length(s["value"])).alias("value_start"),
                                                   F.sha2(s["value"], 256).alias("value_hash")))
    return materialize(rows.select("id", "text_hash", "repo", "owner", hashed.alias("spans"), F.monotonically_increasing_id().alias("row")), "candidates")


def ownership(candidates: DataFrame) -> DataFrame:
    """value_hash, n_docs, n_repos, n_owners over the whole corpus."""
    each = candidates.select("row", F.coalesce("repo", F.lit("null")).alias("repo"), F.coalesce("owner", F.lit("null")).alias("owner"),
                             F.explode(F.array_distinct(F.col("spans.value_hash"))).alias("value_hash"))
    held = each.groupBy("value_hash", "repo", "owner").agg(F.count("*").alias("n"))
    return held.groupBy("value_hash").agg(F.sum("n").alias("n_docs"), F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners"))


def judged_spans(candidates: DataFrame, max_owners: int) -> DataFrame:
    """One row for each span: row, start, end, kind, value_start, value_hash, counts, verdict, reported.

    Spans of the added kind that overlap a base span are left out, and those of copied examples
    are not reported."""
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    apart = F.filter("spans", lambda s: (s["kind"] < BASE_KINDS) | ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    each = candidates.where(F.size("spans") > 0).select("row", F.explode(apart).alias("s")).select("row", "s.*")
    verdict = F.when(F.col("n_owners") <= max_owners, "owner_specific").otherwise("copied_example")
    return (each.join(ownership(candidates), "value_hash").withColumn("verdict", verdict)
            .withColumn("reported", (F.col("kind") < BASE_KINDS) | (F.col("verdict") == "owner_specific")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
                 owner: Column | None = None, max_owners: int = 2) -> DataFrame:
    """id, text_hash and reported spans (start, end, kind, value_start, value_hash, n_docs, n_repos,
    n_owners, verdict), in order, for every row. Offsets are code points, end exclusive."""
    owner = owner if owner is not None else F.col("source")
    candidates = find_candidates(docs, id_col, text_col, repo if repo is not None else owner, owner)
    judged = judged_spans(candidates, max_owners).where("reported")
    span = F.struct("start", "kind", "end", "value_start", "value_hash", "n_docs", "n_repos", "n_owners", "verdict")
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("found"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint,value_start:bigint,value_hash:string,"
                  "n_docs:bigint,n_repos:bigint,n_owners:bigint,verdict:string>>)")
    return (candidates.select("row", "id", "text_hash").join(per_row, "row", "left")
            .select(F.col("id").alias(id_col), "text_hash", F.coalesce("found", none).alias("spans")))


def digest(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", replacement: str = "[SECRET]") -> DataFrame:
    """``docs`` with the owner-specific values of ``found`` (of ``scan_secrets``) replaced; rows and columns stay."""
    live = F.filter("spans", lambda s: s["verdict"] == "owner_specific")
    key, digest, cut_list = unused(docs, "_id", "_hash", "_cuts")
    cuts = (found.select(F.col(id_col).alias(key), F.col("text_hash").alias(digest), F.transform(live, lambda s: F.struct(s["value_start"].alias("a"), s["end"].alias("b"))).alias(cut_list))
            .where(F.size(cut_list) > 0).dropDuplicates([key, digest])
            .withColumn(cut_list, F.sort_array(cut_list)))
    joined = docs.join(cuts.hint("merge"), F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(digest)), "left")
    text = F.col(text_col)

    def step(seen: Column, cut: Column) -> Column:
        """Copies up to a cut that begins past what was copied; an overlapping cut only moves the end on."""
        new = cut["a"] >= seen["at"]
        piece = F.concat(seen["out"], F.substr(text, (seen["at"] + 1).cast("int"), F.greatest(cut["a"] - seen["at"], F.lit(0)).cast("int")), F.lit(replacement))
        return F.struct(F.greatest(seen["at"], cut["b"]).alias("at"), F.when(new, piece).otherwise(seen["out"]).alias("out"))

    cleaned = F.aggregate(cut_list, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step,
                          lambda seen: F.concat(seen["out"], F.substr(text, (seen["at"] + 1).cast("int"))))
    return joined.select(*(F.when(F.col(cut_list).isNotNull(), cleaned).otherwise(text).alias(c) if c == text_col else F.col(c) for c in docs.columns))
