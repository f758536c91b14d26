"""Neighbours, mixing, page texts and the pipeline against brute force."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sagaframe.llm import line_dedup, main_text, mixing, neighbours, quality, queries, simhash

FOLDER = "/root/testdata/sf0.001"


# 7


def test_cells_are_walked_in_order():
    draw = np.random.default_rng(1)
    d1, d2 = draw.random(6), draw.random(5)
    sizes = draw.integers(0, 4, 30)
    cells = neighbours.walk(d1, d2, sizes, 10**9)
    sums = [d1[c // 5] + d2[c % 5] for c in cells]
    assert sums == sorted(sums) and set(cells) == set(np.flatnonzero(sizes).tolist())


def test_neighbours_against_brute_force(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 16))
    x = (centres[draw.integers(0, 20, 3000)] + draw.normal(size=(3000, 16))).astype(np.float32)
    x[500:900] = x[500]  # a very common vector
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)]
    rows += [(5000, None, "a"), (5050, [0.0] * 16, "a"), (5100, [float("nan")] * 16, "a"), (5150, [1.0, None] * 8, "a"), (5200, [1.0], "a"), (None, [1.0] * 16, "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string")
    found = neighbours.nearest_neighbours(df, F.col("id") % 50 == 0, k=5, fewest=1500)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 50)) and all(len(v) == 5 for v in got.values())
    x = x.astype(np.float64)
    hits = 0
    for q, v in got.items():
        s = x @ x[q] / np.sqrt((x * x).sum(1)) / np.sqrt(x[q] @ x[q])
        s[q] = -2
        assert all(abs(s[i] - score) < 1e-12 for i, score in v)
        best = np.lexsort((np.arange(3000), -np.round(s, 12)))[:5]
        hits += len(set(best.tolist()) & {i for i, _ in v})
    assert hits >= 0.9 * 5 * len(got)
    assert [i for i, _ in got[500]] == [501, 502, 503, 504, 505]


def test_blocks_hold_every_cell():
    sizes = np.array([0, 5, 3000, 0, 2040, 9, 1, 10_000, 0, 7])
    first, parts = neighbours.layout(sizes)
    load = {}
    for c in np.flatnonzero(sizes):
        for b in range(first[c], first[c] + parts[c]):
            load[b] = load.get(b, 0) + sizes[c] / parts[c]
    assert max(load.values()) <= neighbours.BLOCK and sorted(load) == list(range(len(load)))


@pytest.mark.parametrize("most", [65_536, 7])
def test_recall_on_vectors_without_clusters(spark, monkeypatch, most):
    monkeypatch.setattr(neighbours, "QUERIES", most)
    x = np.random.default_rng(4).normal(size=(8000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest_neighbours(df, F.col("id") % 200 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    hits = sum(len(set(np.argsort(-(u @ u[q]))[1:6].tolist()) & v) for q, v in got.items())
    assert len(got) == 40 and hits >= 0.9 * 5 * 40


def test_rows_that_share_an_id_and_vectors_of_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.1]), (1, [1.0, 1.0]), (0, [1.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0])]
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0)
    got = sorted((r["rank"], r.vec_id, round(r.score, 3)) for r in found.collect())
    assert got == [(1, 0, 0.995), (1, 0, 0.995), (1, 7, 0.0), (2, 1, 0.707), (2, 1, 0.774)]


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], schema)
    assert [(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest_neighbours(few, F.col("id") == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert neighbours.nearest_neighbours(few.limit(0)).count() == 0
    assert neighbours.nearest_neighbours(spark.createDataFrame([(0, None)], schema)).count() == 0


# 8


def plain_targets(sizes, cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        left, w = total - sum(full.values()), sum(weight[s] for s in rest)
        out = full | {s: left * weight[s] / w for s in rest}
        above = [s for s in rest if out[s] > cap * sizes[s] + 1e-9]
        if not above:
            return out
        full |= {s: cap * sizes[s] for s in above}


def test_mix(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice(["b", "a", "é", None, "", "hot", "hot", "hot"]), " ".join(["w"] * draw.choice([0, 1, 5, 40, 40, 40, draw.randrange(300)]))) for i in range(3000)]
    rows += [(9000, "none", None), (9001, "none", " "), (9002, "tiny", "x y"), (9002, "tiny", "x y"), (None, "tiny", "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash")).repartition(3)
    out = mixing.copies(df).collect()
    assert len(out) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= max(3, 0.01 * want[s])
    key = lambda rs: sorted((str(r.id), r.source or "", r.size, r.copies) for r in rs)
    assert key(mixing.copies(df.repartition(5)).collect()) == key(out)
    assert mixing.copies(df.limit(0)).count() == 0


def test_balance_meets_every_margin(spark):
    schema = "source string, lang string, tokens long"
    cells = spark.createDataFrame([("a", "x", 1000), ("a", "y", 10), ("b", "x", 500), ("b", "y", 4000), (None, "y", 70), (None, "x", 7), ("z", "x", 9), ("e", "x", 0)], schema)
    sources = spark.createDataFrame([("a", 2000.0), ("b", 100.0), (None, 50.0), ("z", 0.0), ("e", 0.0)], "source string, target double")
    langs = spark.createDataFrame([("x", 1500.0), ("y", 650.0)], "lang string, target double")
    rows = mixing.balance(cells, {"source": sources, "lang": langs}).collect()
    assert len(rows) == 8
    for col, want in (("source", {"a": 2000, "b": 100, None: 50, "z": 0, "e": 0}), ("lang", {"x": 1500, "y": 650})):
        for k, t in want.items():
            assert sum(r.tokens * r.rate for r in rows if r[col] == k) == pytest.approx(t, rel=1e-9)
    rate = {(r.source, r.lang): r.rate for r in rows}  # tilts: a product of one factor a source and one a language
    assert rate["a", "x"] * rate["b", "y"] == pytest.approx(rate["a", "y"] * rate["b", "x"])
    with pytest.raises(ValueError):
        mixing.balance(cells, {"source": sources, "lang": spark.createDataFrame([("x", 1.0), ("y", 1.0)], "lang string, target double")})


@pytest.mark.parametrize("target", [1e-6, 5e5, 3e6])
def test_iterations_go_on_until_they_end(spark, target):
    one = spark.createDataFrame([("a", 1_000_000)], "source string, tokens long")
    r = mixing.balance(one, {"source": spark.createDataFrame([("a", target)], "source string, target double")}).first()
    assert 1e6 * r.rate == pytest.approx(target, rel=1e-9)


# 9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="x">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="page post-17"><article><h1>Title &amp; more</h1><p><b>First</b> part<br>of &lt;it&gt;<p>Second &copy;
 2020 <i>para</i>graph</p><div class="ad">Buy</div><form><label>Mail</label><input></form><!-- c --><ul><li>one<li>two</ul></article>
<aside>Aside</aside><section id="comments"><p>Nice post!</p></section></div><footer>Foot</footer>"""


def text_of(page, path=None):
    return main_text.extract(main_text.blocks_of(page), path)


def test_whole_articles_are_kept():
    words = "word " * 30
    assert text_of(f'<body><h1>Title</h1><div class="part-a"><p>{words}a</p></div><div class="part-b"><p>{words}b</p></div>') == f"Title\n{words}a\n{words}b"
    assert text_of(f'<body><div class="top"><h1>Site</h1></div><h1>Title</h1><div class="content"><p>{words}a</p></div><div class="x"><p>More</p></div>') == f"Title\n{words}a"
    inside = '<p class="tags">Tags</p><p><span class="search">found</span> <label>name</label></p><p hidden>kept</p><p><math><mi>x</mi></math> <svg><text>y</text></svg></p><p class="ad">Buy</p>'
    assert text_of(f"<body><article><p>{words}a</p>{inside}</article>") == f"{words}a\nTags\nfound name\nkept\nx y"


def test_article_without_the_rest():
    want = "Title & more\nFirst part of <it>\nSecond © 2020 paragraph\none\ntwo"
    assert text_of(PAGE) == want
    assert text_of(PAGE[: PAGE.index("<li>two")]) == want.removesuffix("\ntwo")
    assert text_of(None) == text_of("") == text_of("<html><body><nav>m</nav>") == ""
    assert text_of("plain &amp; simple") == "plain & simple"
    assert text_of("<body><div><p>a</p></div><a href='x") != ""
    assert text_of("<body><div class=content><p>" + "word " * 50000 + "</p></div>") == ("word " * 50000).strip()


def test_names_of_wrappers_and_comments():
    page = '<body class="menu-open"><div class="has-sidebar"><article class="post tag-menu"><p>Story</p></article><article class="comment-body"><p>Me too</p></article></div></body>'
    assert text_of(page) == "Story"


def test_hosts_vote(spark):
    usual = '<body><div class="col-1"><p>{}</p></div><div class="col-2"><p>{}</p></div>'
    html = [usual.replace("col-1", "main-1").format("text " * 30, "note") for _ in range(5)] + ['<body><div class="main-9"><p>short</p></div><div class="col-2"><p>a far longer note beside it</p></div>']
    rows = [(i, "https://www.a.org/x", h, "h") for i, h in enumerate(html)] + [(9, None, None, "h"), (10, "odd", PAGE, "h"), (11, "odd", PAGE, "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.id: r.text for r in main_text.main_texts(df).collect()}
    assert got[5] == "short" and got[9] == "" and got[10] == got[11] == text_of(PAGE) and len(got) == len(rows)
    assert main_text.main_texts(df.limit(0)).count() == 0


def test_every_path_of_a_host_votes(spark, monkeypatch):
    """Far more templates than any cap would keep; the table sent to workers and the join give the same."""
    draw = random.Random(5)
    name = lambda k: "t" + "".join(chr(97 + int(c)) for c in str(k))
    page = '<body><div class="{}"><p>{}</p></div><div class="{}x"><p>{}</p></div>'
    rows = []
    for k in range(60):
        rows += [(5 * k + i, draw.choice(["http://one.org/", None, "odd"]), page.format(name(k), "story " * 40, name(k), "note")) for i in range(4)]
        rows.append((5 * k + 4, "http://one.org/", page.format(name(k), "short", name(k), "a longer note beside the short text")))
    rows += [rows[0], (None, None, None), (7000, "http://one.org/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted(main_text.main_texts(df).collect(), key=str)
    for r in got:
        if r.id is not None and r.id < 300 and r.url == "http://one.org/" and any(x[0] // 5 == r.id // 5 and x[0] % 5 < 4 and x[1] == r.url for x in rows[:300]):
            assert r.text in ("short", ("story " * 40).strip())
    monkeypatch.setattr(main_text, "MOST_BYTES", 0)
    assert sorted(main_text.main_texts(df).collect(), key=str) == got and len(got) == len(rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pages_of_the_test_data(spark):
    import html
    import re

    from sagaframe.session import read_table

    pages = {r.page_id: r.html for r in read_table(spark, FOLDER, "pages").collect()}
    for r in queries.op9_main_text(spark, FOLDER).collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


# The pipeline


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from sagaframe.session import cut, read_table

    docs = read_table(spark, FOLDER, "documents")
    names = [n for n, _ in pipeline.STAGES]
    assert len(names) == 5
    stage = dict(pipeline.STAGES)
    good = cut(stage["quality rules"](spark, docs, FOLDER))
    field = quality.train(docs, read_table(spark, FOLDER, "labels"))
    assert {r.doc_id for r in good.collect()} == {r.id for r in quality.judge(docs, field).collect() if r.kept}
    labels = {r.doc_id: r.quality for r in read_table(spark, FOLDER, "labels").collect()}
    left = {r.doc_id for r in good.collect()}
    long_enough = {r.doc_id for r in docs.filter("n_chars > 300").collect()}
    wanted = [i for i, q in labels.items() if q == 1 and i in long_enough]
    assert sum(i in left for i in wanted) >= 0.97 * len(wanted) and sum(i in left for i, q in labels.items() if q == 0) <= 2
    lines = cut(stage["line dedup"](spark, good, FOLDER))
    whole = {r.doc_id: r.text for r in line_dedup.without_repeats(good).collect()}
    for r in lines.collect():
        assert r.n_chars == len(r.text) and r.text == whole[r.doc_id]
    first = cut(stage["near duplicates"](spark, lines, FOLDER))
    texts = [r.text for r in first.collect()]
    assert len(set(texts)) == len(texts) and first.columns == docs.columns
    whole = {r.doc_id: set(zip(*[(r.text or "").lower().split()[k:] for k in range(5)], strict=False)) or {(r.text or "").lower()} for r in lines.collect()}
    parent = {i: i for i in whole}
    for a in sorted(whole):
        for b in sorted(whole):
            if b < a and len(whole[a] & whole[b]) >= 0.8 * len(whole[a] | whole[b]):
                low, high = sorted((parent[a], parent[b]))
                parent = {i: low if p == high else p for i, p in parent.items()}
    assert {r.doc_id for r in first.collect()} == set(parent.values()) and len(set(parent.values())) < len(whole)
    mixed = cut(stage["mixing"](spark, first, FOLDER))
    times = {r.id: r.copies for r in mixing.copies(first).collect()}
    assert sum(times.values()) > 0
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in times.items() if n} and mixed.columns == docs.columns
    ids = stage["bpe"](spark, mixed, FOLDER)
    assert ids.count() == mixed.count()


def test_rows_without_an_id_of_their_own_stay(spark):
    import corpus_pipeline as pipeline

    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcde"]
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[4]), (9, texts[4]), (None, texts[0]), (8, texts[4]), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = pipeline.dedup_documents(spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([*rows[:5], (3, "")], key=str)


def test_near_duplicates_of_the_pipeline_are_linked_by_fingerprints(spark):
    """Texts that op 2 links go to one group though their sets of shingles are unlike; what it leaves apart is linked by the sets."""
    import random

    import corpus_pipeline as pipeline
    from sagaframe.llm import simhash

    draw = random.Random(6)
    words = [f"w{i}" for i in range(8)]
    near = None
    while near is None:
        a, b = (" ".join(draw.choices(words, k=5) + ["same"] * 400 + draw.choices(words, k=5)) for _ in range(2))
        sets = [set(zip(*[t.split()[k:] for k in range(5)], strict=False)) for t in (a, b)]
        if (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() <= 2 and len(sets[0] & sets[1]) < 0.5 * len(sets[0] | sets[1]):
            near = a, b
    long = [f"v{i}" for i in range(300)]
    alike = " ".join(long), " ".join(f"x{i}" if i % 60 == 30 else w for i, w in enumerate(long))
    assert (simhash.fingerprint(alike[0]) ^ simhash.fingerprint(alike[1])).bit_count() > 2
    docs = spark.createDataFrame([(4, near[1]), (2, near[0]), (3, alike[0]), (1, alike[1]), (None, near[0]), (9, "other words")], "doc_id long, text string")
    assert sorted(r.doc_id for r in pipeline.dedup_documents(spark, docs, "").collect()) == [1, 2, 9]


def test_stages_take_empty_and_odd_tables(spark, tmp_path):
    import corpus_pipeline as pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, removed int"
    rows = [(None, None, None, None, None, "x", 1), (1, "", "en", None, 0, "x", 1), (2, "a " * 40, "en", "s", 80, "x", 1), (2, "a " * 40, "en", "s", 80, "x", 1)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            out.collect()
        pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
