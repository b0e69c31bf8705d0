from collections import Counter, defaultdict

import corpus_pipeline as C
from quotelens.llm.queries import QUERIES
from tests.llm.cases import documents, words
from tests.llm.test_near_dedup import brute_force


def plain(spark, rows, path):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "cast(length(text) as long) as n_chars").write.parquet(f"{path}/documents.parquet")


def test_stages_and_run(spark, tmp_path):
    rows = documents() + [(700, "mine: password=livevalue99 " + " ".join(f"u{i}" for i in range(30)), "en", "s1")]
    plain(spark, rows, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for i, (name, stage) in enumerate(C.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == columns, name
        seen.append([tuple(r) for r in docs.collect()])
    identified, distinct, redacted, mixed = seen
    assert {200, 201, 202, 203}.isdisjoint(r[0] for r in identified) and len(identified) >= len(rows) - 6
    classes = {d: c for d, (_, c) in brute_force([r[:2] for r in identified]).items()}
    assert sorted(r[0] for r in distinct if r[0] is not None) == sorted(set(classes.values()))
    before = {r[0]: r[1] for r in distinct}
    assert {r[0]: r[1] for r in redacted} == before | {700: before[700].replace("livevalue99", "[SECRET]")}
    assert all(r[4] == len(r[1]) for r in redacted)
    assert {r[0] for r in mixed} <= {r[0] for r in redacted} and max(Counter(r[0] for r in mixed).values()) <= 3
    sizes = defaultdict(int)
    for r in redacted:
        sizes[r[3]] += len(words(r[1]))
    for s, n in Counter({s: sum(len(words(r[1])) for r in mixed if r[3] == s) for s in sizes}).items():
        assert n <= 3 * sizes[s]
    packed = C.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in mixed)


def test_empty_documents(spark, tmp_path):
    plain(spark, [], tmp_path)
    assert C.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
