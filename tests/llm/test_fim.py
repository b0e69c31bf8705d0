import hashlib
import random

from pyspark.sql import functions as F

from quotelens.llm import fim
from tests.llm.cases import documents, frame


def cuts(doc_id, text):
    """(form, first cut, second cut) by the rule."""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", None, None
    return ("spm" if h4 % 100 < 20 else "psm"), a, b


def by_rule(doc_id, text):
    form, a, b = cuts(doc_id, text)
    if form == "plain":
        return form, None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return form, a, b - a, f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def cases():
    rng = random.Random(4)
    marked = [(300 + i, t, "en", "s") for i, t in enumerate(["<P>", "a <S> b", "x" * 99 + "<M>", "<P", "<<P", "<S", "M><", "<M" * 40, "<|P|>", "S><M><"[:3]])]
    tricky = [(400 + i, "".join(rng.choices(["<", "P", "S", "M", "a", "é", "😀"], k=rng.randint(0, 60))), "en", "s") for i in range(300)]
    return documents() + marked + tricky


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_outputs_and_texts_come_back(spark):
    rows = cases()
    want = {(d, t): by_rule(d, t or "") for d, t, *_ in rows}
    for units in (7, fim.UNITS):
        made = fim.fill_in_middle(fim.write_store(frame(spark, rows), units=units))
        got = fim.texts(made).collect()
        assert len(got) == len(rows)
        made_rows = [(r.doc_id, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got]
        assert sorted(map(str, made_rows)) == sorted(str((d, *want[d, t])) for d, t, *_ in rows)
        digests = fim.digests(made).collect()
        assert sorted((str(r.doc_id), r.output_sha256, r.restored_sha256) for r in digests) == sorted((str(d), sha(want[d, t][3]), sha(t or "")) for d, t, *_ in rows)
    assert {w[0] for w in want.values()} == {"plain", "psm", "spm"}


def test_only_cut_frames_are_opened():
    text = "".join(chr(97 + i % 26) for i in range(1000))
    ends, frames = fim.frames_of(text, 64)
    assert ends[-1] == 1000 and len(ends) == 16
    store = fim.Seekable(ends, frames)
    parts = [*store.pieces(0, 100), *store.pieces(100, 700), *store.pieces(700, 1000)]
    assert set(store.open) == {1, 10}
    assert sum(isinstance(p, bytes) for p in parts) == 14
    assert b"".join(fim.decompress(f) for f in fim.joined(parts)).decode() == text


def test_store_holds_counts_and_frames(spark):
    rows = cases()
    stored = fim.write_store(frame(spark, rows), units=10).collect()
    texts = {(d, t or "") for d, t, *_ in rows}
    for r in stored:
        pieces = [fim.decompress(f).decode() for f in r.frames]
        assert (r.doc_id, "".join(pieces)) in texts
        assert [sum(map(len, pieces[:i + 1])) for i in range(len(pieces))] == r.ends and r.n == sum(map(len, pieces))
        assert all(len(p) == 10 for p in pieces[:-1])


def test_empty_table_and_text_ids(spark):
    assert fim.digests(fim.fill_in_middle(fim.write_store(frame(spark, [])))).count() == 0
    ids = frame(spark, [(1, "some text of a row", "en", "s")]).withColumn("doc_id", F.lit("k-1"))
    r = fim.texts(fim.fill_in_middle(fim.write_store(ids))).first()
    assert (r.doc_id, r.form, r.prefix_chars, r.middle_chars, r.output) == ("k-1", *by_rule("k-1", "some text of a row"))
