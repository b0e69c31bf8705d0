"""Stages keep extra columns whose names are those of their own helper columns."""

import corpus_pipeline as C
from tests.llm.cases import sentence


def test_stages_keep_clashing_columns(spark):
    import random
    rng = random.Random(1)
    rows = [(i, sentence(rng, 30) + (" password=livevalue99" if i == 3 else ""), "en", f"s{i % 2}", 0, *[7] * 6) for i in range(12)]
    rows += [rows[5], (20, rows[6][1], "en", "s0", 0, *[7] * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _id int, _HASH int, _cuts int, _copies int, _copy int, _n int").cache()
    for name, stage in C.STAGES[1:4]:
        out = stage(spark, docs, "").collect()
        assert out and [f for f in out[0].asDict()] == docs.columns, name
        assert {r._id for r in out} == {7}, name
    near = [r.doc_id for r in C.drop_near_copies(spark, docs, "").collect()]
    assert sorted(near) == list(range(12))
    assert sum("[SECRET]" in r.text for r in C.redact_secrets(spark, docs, "").collect()) == 1
