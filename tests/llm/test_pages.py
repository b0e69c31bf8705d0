import random

from pyspark.sql import functions as F

from quotelens.llm import boilerplate as B
from quotelens.llm.html_blocks import blocks
from tests.llm.cases import sentence


def article(page):
    found = blocks(page)
    contained = any(i and not f for _, i, f in found)
    return " ".join(t for t, i, f in found if not f and (i or not contained))


def test_regions_of_a_page():
    page = """<!doctype html><html><head><title>T <b></title><style>p{}</style><script>if (a<b) x="</p></div>";</script></head><body class="home">
      <header class=site-header>Site <a href='/'>home</a></header><nav><ul><li>One<li>Two</ul></nav><div class="cookie-notice">Accept <p>all</div>
      <main><article id=post-1><header><h1>Big &amp; <em>bold</em></h1></header><!-- no --><p>First<b>word</b> a&nbsp;b &#x41;&eacute; &lt;tag&gt;<br>line
      <p class="ad">Buy <p>Second <span hidden>gone</span><i>kept</i><div class="share-buttons">Tweet</div><form><label>Mail</label><input value="x"></form>
      <table><tr><td>c1<td>c2<tr><td>d1</table><aside>Aside</aside><section class="comments"><p>Nice!</section><blockquote>quoted</blockquote></article>
      <div class="related">More</div></main><div id="sidebar">Side</div><footer>&copy; 2020</footer></body></html>"""
    assert article(page) == "Big & bold Firstword a b Aé <tag> line Second kept c1 c2 d1 quoted"


def test_pages_without_container_and_broken_markup():
    assert article("<p>one</p></div><nav>menu</nav><p>two < three & four") == "one two < three & four"
    assert article("just text") == "just text" and article("") == "" and article("<script>never closed") == ""
    assert article("<div class=post-content><p>in</div><p>out") == "in"
    assert article("<b>a</b><i>b</i> <p>c<!-- x") == "ab c"


def rows_of(n, seed, template):
    rng = random.Random(seed)
    return [(i, f"https://h{i % 2}.example.com/{i}", template(sentence(rng, 60), i)) for i in range(n)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "page_id long, url string, html string, host string, part int, id int").repartition(2)
    return {r.page_id: r.text for r in B.main_texts(df).collect()}


def test_repeated_furniture_goes_and_quotations_stay(spark):
    rng = random.Random(9)
    notice, quote, copy = sentence(rng, 30), sentence(rng, 30), sentence(rng, 80)
    page = lambda body: f"<div>{notice}</div><article><p>{body}</p></article>"
    rows = rows_of(8, 1, lambda t, i: page(t + " " + quote))
    rows += [(20 + i, f"http://h0.example.com/c{i}", page(copy)) for i in range(4)]  # copies of one article
    rows += [(30, "http://h0.example.com/n", f"<article><p>mine</p><p>{notice}</p></article>"), (31, None, None), (32, None, ""), (33, "::bad::", "<p>x"), (33, "::bad::", "<p>x")]
    got = run(spark, rows)
    for i, _, source in rows[:8]:
        assert got[i] == source.split("<p>")[1].split("</p>")[0]
    assert all(got[20 + i] == copy for i in range(4))
    assert got[30] == "mine"  # the notice is furniture elsewhere on this host
    assert got[31] == got[32] == "" and got[33] == "x"


def test_pages_without_containers_keep_unique_runs(spark):
    rng = random.Random(10)
    menu = sentence(rng, 25)
    rows = rows_of(10, 2, lambda t, i: f"<div>{menu}</div><div>{t}</div>")
    got = run(spark, rows)
    assert all(got[i] == source.split("<div>")[2].removesuffix("</div>") for i, _, source in rows)


def test_hot_host_is_dealt_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(B, "PART_CHARS", 3000)
    rows = rows_of(40, 4, lambda t, i: f"<nav>menu {i}</nav><article>{t}</article>")
    got = run(spark, rows)
    assert len(got) == 40 and all(got[i] == source.split("<article>")[1].removesuffix("</article>") for i, _, source in rows)
    assert run(spark, []) == {}
    assert spark.createDataFrame([(1,)], "x int").select(F.lit(1)).count() == 1


def test_suffix_ranks_group_equal_prefixes():
    import numpy as np
    rng = np.random.default_rng(0)
    token = rng.integers(0, 3, 400)
    left = np.repeat([200, 200], 200) - np.tile(np.arange(200), 2)
    rank = B.suffix_ranks(token, left, 8)
    text = [tuple(token[i:i + min(8, left[i])]) for i in range(400)]
    for i in range(400):
        for j in range(i):
            assert (rank[i] == rank[j]) == (text[i] == text[j])


def test_hot_host_repetition_is_host_wide(spark, monkeypatch):
    """Many parts of about ten pages: a notice that is furniture on three pages goes on every page, a passage of articles stays."""
    rng = random.Random(11)
    notice, quote = sentence(rng, 30), sentence(rng, 30)
    body = {i: sentence(rng, 60) for i in range(80)}
    rows = []
    for i in range(80):
        spot = f"<div>{notice}</div>" if i in (3, 40, 77) else ""
        inside = notice if i in (5, 60) else quote if i % 2 else ""
        rows.append((i, f"https://hot.example.com/{i}", f"{spot}<article><p>{body[i]}</p><p>{inside}</p></article>"))
    rows += [(100, "https://hot.example.com/x", f"<div>{notice}</div>"), (101, "https://hot.example.com/y", "<p>" + body[0][:20])]
    whole = run(spark, rows)
    monkeypatch.setattr(B, "PART_CHARS", 4000)
    got = run(spark, rows)
    assert got == whole and got[100] == ""
    assert all(got[i] == body[i] + (" " + quote if i % 2 and i != 5 else "") for i in range(80))


def test_copies_without_containers_keep_their_text(spark, monkeypatch):
    rng = random.Random(13)
    menu, article, near = sentence(rng, 25), sentence(rng, 120), sentence(rng, 120).split(" ")
    body = {i: sentence(rng, 60) for i in range(6)} | {10 + i: article for i in range(4)}
    body |= {20 + i: " ".join([*near[:30 * i], f"changed{i}", *near[30 * i + 1:]]) for i in range(4)}
    rows = [(i, f"https://copies.example.com/{i}", f"<div>{menu}</div><p>{t}</p>") for i, t in body.items()]
    rows += [(30 + i, f"https://alone.example.com/{i}", f"<p>{article}</p>") for i in range(3)]
    whole = run(spark, rows)
    assert {i: t for i, t in whole.items() if i < 30} == body
    assert all(whole[30 + i] == article for i in range(3))
    monkeypatch.setattr(B, "PART_CHARS", 1500)
    assert run(spark, rows) == whole


def test_texts_of_a_hot_host_are_exchanged_once(spark, monkeypatch):
    monkeypatch.setattr(B, "PART_CHARS", 3000)
    rows = rows_of(40, 21, lambda t, i: f"<nav>menu {i}</nav><article>{t}</article>")
    out = B.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert out.count() == len(out.collect()) == 40
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    dealt = [below for line, below in zip(plan, plan[1:]) if " Exchange hashpartitioning(host#" in line and ", part#" in line]
    assert sum("lines#" in below for below in dealt) == 1


def test_only_runs_of_hot_cells_are_sent_in_full():
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    rng = random.Random(22)
    notice, pair, copied = (sentence(rng, 40) for _ in range(3))  # on three pages, once as furniture; on two; in four articles
    held = {0: [], 1: [notice, pair], 2: [notice, pair], 5: [copied], 6: [copied], 7: [copied], 8: [copied]}
    texts = [f"<div>{notice if i == 0 else ''}</div><article>{' '.join([sentence(rng, 1500), *held.get(i, [])])}</article>" for i in range(10)]
    tables = []
    for part in range(2):
        ids = list(range(part, 10, 2))
        batch = pa.RecordBatch.from_pydict({"id": ids, "url": [str(i) for i in ids], "host": ["h"] * len(ids), "part": [part] * len(ids), "parts": [3] * len(ids),
                                            "page": ids, "html": [texts[i] for i in ids]})
        tables.append(pa.Table.from_batches(B.read_pages([batch])))
    pages: dict = {}
    beyond = set()
    for table in tables:
        s = B.streams(table)
        for at, key in zip(*s.runs()):
            run = int(key["a"]), int(key["b"])
            pages.setdefault(run, set()).add(s.pages[s.page[at]])
            beyond |= {run} if s.furniture[at] else set()
    repeated = {k for k, p in pages.items() if len(p) >= B.PAGES}
    assert len(repeated) == 50 and len(repeated & beyond) == 25
    cells = [B.sketch(t) for t in tables]
    assert sum(len(x) for c in cells for x in c.column("cells").to_pylist()) < 4 * len(pages)
    everything = pa.concat_tables(cells)
    hot = pa.concat_tables([B.hot_cells(everything.filter(pc.equal(everything.column("shard"), k))) for k in range(3)])
    sent = set()
    for part, table in enumerate(tables):
        for runs in B.send(table, hot.filter(pc.equal(hot.column("part"), part))).column("runs").to_pylist():
            sent |= {(int(k["a"]), int(k["b"])) for k in np.frombuffer(runs, B.KEY)}
    assert repeated & beyond <= sent and len(sent) < 40


def test_rows_of_one_page_in_many_parts_are_one_page(spark, monkeypatch):
    rng = random.Random(23)
    notice = {n: sentence(rng, 30) for n in (2, 3)}
    body = {i: sentence(rng, 60) for i in range(30)}
    url = {i: f"https://twice.example.com/{i if i > 11 else 0}" for i in body}  # rows 0 to 11 are one page
    rows = [(i, url[i], f"<div>{notice[2] if i == 20 else ''}</div><div>{notice[3] if i in (20, 25) else ''}</div><article><p>{body[i]}</p>"
                        + (f"<p>{notice[2]}</p><p>{notice[3]}</p>" if i < 12 else "") + "</article>") for i in body]
    whole = run(spark, rows)
    monkeypatch.setattr(B, "PART_CHARS", 2000)
    assert run(spark, rows) == whole == {i: body[i] + (" " + notice[2] if i < 12 else "") for i in body}
