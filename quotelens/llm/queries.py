"""Registered queries of the pipeline operators: thin, whole-table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Words of whole texts, one row each; documents that have none are left to the outer joins.
WORDS_SQL = r"""WITH w AS (SELECT doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
pos AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
win AS (SELECT doc_id, p, word, string_agg(word, ' ') OVER around AS k, count(*) OVER around AS size FROM pos
        WINDOW around AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {last} FOLLOWING)),"""

SUBSTRING_SQL = WORDS_SQL.format(text="coalesce(text, '')", last=34) + """
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY k) AS n FROM win WHERE size = 35) WHERE n > 1),
cov AS (SELECT DISTINCT doc_id, p + o AS p FROM rep, (SELECT unnest(range(35)) AS o)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM pos ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

NEAR_SQL = WORDS_SQL.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')", last=4).replace("WITH w", "WITH RECURSIVE w") + """
sh AS (SELECT DISTINCT doc_id, k FROM win WHERE size = 5 OR (p = 1 AND size < 5)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON r = x),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)"""


@register("op1_substring_dedup", SUBSTRING_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.substring_dedup import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


@register("op3_near_dedup", NEAR_SQL)
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.hyperminhash import link_documents
    return link_documents(table(spark, sf_dir, "documents"))


@register("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.langid import identify
    return identify(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file (the operators take any path)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


@register("op4_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@register("op5_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.unigram import count_tokens, zipf_vocabulary
    return count_tokens(table(spark, sf_dir, "documents"), zipf_vocabulary(tokenizer_file("piece_bpe_32k.model")))


@register("op6_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op8_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the sources; a repository is a source's part in one language."""
    from quotelens.llm import secrets as S
    docs = table(spark, sf_dir, "documents")
    found = S.scan_secrets(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    base = F.filter("spans", lambda s: s["kind"] < S.BASE_KINDS)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    live = F.size(F.filter("spans", lambda s: s["verdict"] == "owner_specific")).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(S.digest(base), 256).alias("base_sha256"), S.digest(F.col("spans")).alias("spans"), live.alias("n_owner_specific"))


@register("op9_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm import orderminhash as O
    out = O.edited_pairs(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                      O.as_text(F.col("prints")).alias("fingerprint"), O.as_text(F.col("edited_prints")).alias("edited_fingerprint"),
                      O.likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
                      O.likeness(F.col("prints"), F.col("next_prints")).alias("near_next"))


@register("op7_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op10_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.boilerplate import main_texts
    out = main_texts(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op11_token_id_files")
def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.idfiles import read_token_files, write_token_files
    return read_token_files(spark, write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")))


MIDDLE_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(x, i, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT doc_id, t, n, h, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b FROM h),
f AS (SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                     WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f"""


@register("op12_fill_in_middle", MIDDLE_SQL)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm import fim
    return fim.digests(fim.fill_in_middle(fim.write_store(table(spark, sf_dir, "documents"))))


#: The checksum by its polynomial; near words by exact keys: a word less its i-th code point, for the same i or as a word.
VARIANTS_SQL = r"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
sums AS (SELECT d, run, count(*) AS n, hex(encode(d || ':' || run)) AS x FROM runs WHERE length(run) >= 7 GROUP BY d, run),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM sums, crc),
found AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM found WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.k = b.k AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.k = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.k = b.word),
best AS (SELECT word, near, m, count(*) OVER (PARTITION BY word) AS n_near FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, near) = 1),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN near END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, form FROM forms UNION ALL SELECT walk.word, walk.form, forms.form FROM walk JOIN forms ON walk.form = forms.word)
SELECT forms.word, forms.form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN walk ON walk.word = forms.word AND walk.form IS NULL"""


@register("op13_spelling_variants", VARIANTS_SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotelens.llm.spelling import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents"))
