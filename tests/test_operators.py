"""Small cases: folds against plain Python, edges of windows, empty tables."""

import random
import time
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sagaframe.functions import text as X
from sagaframe.operators import canon, chunking, cleaning, evaluation, graph, merging, packing, providers, routing, sampling, scoping, segments, signals, similarity
from sagaframe.sources import files


def value(spark, c, *rows, schema="s string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(c).collect()]


def test_text_scalars(spark):
    assert value(spark, X.clean_text(F.col("s")), "　a ", None, " \n") == ["a", "", ""]
    assert value(spark, X.normalize_name(F.col("s")), "林 清　_A.é", "Straße 9") == ["林清aé", "straße9"]
    assert value(spark, X.slugify(F.col("s")), " Hello, World! ", "...") == ["hello-world", "item"]
    assert value(spark, X.char_grams(F.col("s")), "", "a", "abab") == [[], ["a"], ["ab", "ba"]]
    assert value(spark, X.casefold(F.col("s")), "STRAßE") == ["strasse"]
    assert value(spark, X.truncated(F.col("s"), 6), "abcdef", "abcdefg") == ["abcdef", "abc..."]


def test_numerals(spark):
    digits = dict(zip("零一二三四五六七八九", range(10), strict=True))
    c = X.numeral_value(F.col("s"), digits, {"十": 10, "百": 100, "千": 1000}, {"万": 10000})
    assert value(spark, c, "十二", "三百零五", "二万三千", "一百二十", "abc", "") == [12, 305, 23000, 120, None, None]


def scenes_plain(units, least, target, most):
    out, now, size = [], [], 0
    for u in units:
        if now and ((size >= least and size + len(u) > target) or size + len(u) > most):
            out.append(now)
            now, size = [], 0
        now.append(u)
        size += len(u)
    return out + [now] if now else out


def test_pack_against_plain_python(spark):
    random.seed(3)
    rows = [["x" * random.randint(1, 60) for _ in range(random.randint(0, 30))] for _ in range(50)]
    got = value(spark, chunking.pack(F.col("s"), 50, 90, 140), *rows, schema="s array<string>")
    assert got == [scenes_plain(r, 50, 90, 140) for r in rows]


def test_oversized_paragraphs(spark):
    got = value(spark, chunking.split_oversized(F.col("s"), 10), "Aa. Bb. Cc. Dd.", "x" * 23, "short", "Aa. " + "y" * 12 + ". Z.")
    assert got[0] == ["Aa.Bb.Cc.", "Dd."] and got[1] == ["x" * 10, "x" * 10, "xxx"] and got[2] == ["short"]
    assert all(len(p) <= 10 for p in got[3]) and "".join(got[3]).replace(" ", "") == "Aa." + "y" * 12 + ".Z."


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 24, 25, 29])
def test_windows(spark, n):
    df = spark.createDataFrame([(1, i) for i in range(n)], "g int, o int")
    full = {r.start: r.members for r in chunking.sliding_windows(df, "g", "o", 5, 3, False).collect()}
    assert full == {s: list(range(s, s + 5)) for s in range(0, max(n, 0), 3) if s + 5 <= n}
    tail, s = {}, 0
    while s < n:
        tail[s] = list(range(s, min(s + 24, n)))
        if s + 24 >= n:
            break
        s += 4
    assert {r.start: r.members for r in chunking.sliding_windows(df, "g", "o", 24, 4, True).collect()} == tail


def test_cleaning(spark):
    rules = cleaning.NoiseRules(combinations=(("buy", "now"),), fragments=(r"\[ad\]",), promo_words=("vote", "subscribe"), end_markers=("THE END",))
    got = value(spark, cleaning.strip_noise(F.col("s"), rules), "a [ad]b\nbuy it now\nc", None)
    assert tuple(got[0]) == ("a b\nc", 1, 1) and tuple(got[1]) == ("", 0, 0)
    assert value(spark, cleaning.sanitize(F.col("s"), rules), "one\n\ntwo\n\nplease vote and subscribe", "text THE END junk") == ["one\n\ntwo", "text"]
    nested = spark.createDataFrame([(1, {"k": ["x [ad]"]}, ("y [ad]",))], "id int, m map<string,array<string>>, s struct<t:string>")
    assert cleaning.clean_nested(nested, rules).first().asDict(True) == {"id": 1, "m": {"k": ["x"]}, "s": {"t": "y"}}


def test_graph(spark):
    entities = spark.createDataFrame([("e1", "Lin Qing", ["A Qing"]), ("e2", "Outer Sect", None), ("e0", "lin-qing", None)], "id string, name string, aliases array<string>")
    index = graph.alias_index(entities, "id", "name", "aliases")
    mentions = spark.createDataFrame([(1, "LIN QING"), (2, "a qing"), (3, ""), (4, "Nobody"), (5, None)], "k int, m string")
    got = {r.k: (r.resolution, r.node_id) for r in graph.resolve_endpoints(mentions, "m", index).collect()}
    assert got[1] == ("ambiguous", "e0") and got[2] == ("exact", "e1") and got[3] == ("missing", None) and got[5][0] == "missing"
    assert got[4][0] == "unresolved" and got[4][1].startswith("literal_endpoint_")


def test_entities_first_mention_wins(spark):
    rows = spark.createDataFrame([("c", "Lin Qing", 2, "s2"), ("c", "lin qing", 1, "s1"), ("p", "Lin Qing", 3, "s1")], "t string, n string, o int, s string")
    got = {r.entity_type: r for r in canon.resolve_entities(rows, "t", "n", "o", "s").collect()}
    assert got["c"].name == "lin qing" and got["c"].aliases == ["Lin Qing", "lin qing"] and got["c"].mentions == 2 and got["p"].n_scenes == 1


def test_even_places():
    assert sampling.even_places(10, 4) == [0, 3, 6, 9] and sampling.even_places(3, 5) == [0, 1, 2] and sampling.even_places(6, 3) == [0, 2, 5]


def test_empty_selection_is_no_filter(spark):
    df = spark.range(3).toDF("k")
    assert sampling.in_selection(df, spark.createDataFrame([], "k long"), "k").count() == 3


def test_even_sample_is_exact_over_many_partitions(spark):
    df = spark.range(0, 200_000, 1, 12).select((F.col("id") * 7919 % 200_003).alias("k"))
    keys = sorted(i * 7919 % 200_003 for i in range(200_000))
    assert sorted(r.k for r in sampling.even_sample(df, ["k"], 50).collect()) == [keys[i] for i in sampling.even_places(200_000, 50)]


def test_pressure_is_that_of_the_item():
    item = {"item": 1, "kind": "k", "chapter": "1", "tokens": 500, "confidence": 0.5, "evidence": 0.2, "axes": ["a"]}
    rules = packing.BatchRules(token_budget=1000, capacity=0.0)
    assert packing.marginal(item, set(), set(), 0, 0, rules) == packing.marginal(item, set(), set(), 400, 0, rules) == round(0.5 + 0.3 + 0.15 * 0.2 - 0.2 * 0.5 - 0.75 * 0.2 * 0.25, 4)


def test_signals_of_small_tables(spark):
    one = spark.createDataFrame([(1, 5), (2, 5), (3, None)], "item long, chapter long")
    assert [tuple(r) for r in signals.chapter_positions(one, "item", "chapter").orderBy("item").collect()] == [(1, 0.5), (2, 0.5)]
    few = spark.createDataFrame([("a",), ("b",)], "b string")
    assert [r.worker for r in signals.worker_shares(few, "b", 5).orderBy("b").collect()] == [0, 1]
    with pytest.raises(ValueError):
        signals.gold_cases(few, "b", "c")
    rows = spark.createDataFrame([("g", i, t) for i, t in enumerate([50, 60, 40, 5, 9])], "g string, k long, t long")
    assert [r.k for r in signals.within_budget(rows, "g", [F.col("k")], "t", "k", 100, 3).orderBy("place").collect()] == [0, 2, 3]
    assert signals.within_budget(rows.limit(0), "g", [F.col("k")], "t", "k", 100, 3).count() == 0


def test_alias_groups_are_not_components(spark):
    rows = spark.createDataFrame([("p", 1, ["a"], 1), ("p", 2, ["b"], 2), ("p", 3, ["a", "b"], 3), ("p", 4, ["b"], 4)], "path string, id int, aliases array<string>, o int")
    assert [r.group_no for r in merging.alias_groups(rows, "path", "id", "aliases", "o").orderBy("id").collect()] == [0, 1, 0, 1]


def test_packing_keeps_limits(spark):
    random.seed(5)
    rules = packing.BatchRules(token_budget=1000, item_cap=4, batches=20)
    items = [{"item": i, "kind": "k", "chapter": str(i % 5), "tokens": random.randint(50, 600), "confidence": random.random(), "evidence": 0.5, "axes": ["a"] if i % 2 else ["b", "c"]} for i in range(40)]
    plan = packing.plan_bucket(items, rules)
    batches = {}
    for b, _, x in plan:
        batches.setdefault(b, []).append(x)
    assert all(sum(x["tokens"] for x in b) <= 1000 and len(b) <= 4 for b in batches.values())
    assert len({x["item"] for _, _, x in plan}) == len(plan)
    robin = packing.plan_round_robin({"x": items[:20], "y": items[20:]}, rules, 6)
    assert len({(b, n) for b, n, _, _ in robin}) == 6


def test_plan_is_that_of_the_whole_bucket(spark):
    random.seed(6)
    rules = packing.BatchRules(token_budget=600, item_cap=4, batches=3)
    items = [{"bucket_id": "x", "item": i, "kind": random.choice("kl"), "chapter": random.choice("123"), "tokens": random.randint(20, 300), "confidence": round(random.uniform(0.2, 1), 2), "evidence": 0.5, "axes": random.choice([["a"], ["b", "c"]])} for i in range(6000)]
    rows = spark.createDataFrame([tuple(x.values()) for x in items], "bucket_id string, item long, kind string, chapter string, tokens long, confidence double, evidence double, axes array<string>").repartition(7)
    assert packing.may_be_chosen(rows, rules).count() < len(items) / 2
    want = [(b, i, x["item"]) for b, i, x in packing.plan_bucket(items, rules)]
    assert [(r.batch, r.place, r.item) for r in packing.plan_batches(rows, rules).orderBy("batch", "place").collect()] == want
    assert packing.plan_batches(rows.limit(0), rules).count() == 0


def test_queries_beyond_a_block_meet_all_items(spark, monkeypatch):
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 7)
    monkeypatch.setattr(similarity, "ITEM_BLOCK", 11)
    random.seed(7)
    rows = spark.createDataFrame([(i, [random.random() - 0.5 for _ in range(4)]) for i in range(60)], "vec_id long, embedding array<double>")
    blocked = similarity.cosine_topk(rows, rows, "vec_id", "embedding", 3)
    monkeypatch.undo()
    assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, similarity.cosine_topk(rows, rows, "vec_id", "embedding", 3).collect()))


def test_boundaries_follow_the_last_accepted_layer(spark):
    layers = ["a", "a", "b", "a", "b", "b", "b", "a", "a"]
    rows = spark.createDataFrame([("g", i * 4, x) for i, x in enumerate(layers)], "g string, start long, dominant string")
    got = [(r.start, r.to_layer) for r in segments.layer_boundaries(rows, "g", 8).orderBy("start").collect()]
    assert got == [(16, "b"), (28, "a")]


def test_similarity(spark):
    df = spark.createDataFrame([("abc", "xxabcxx"), ("abcd", "abxx"), ("", "a"), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(similarity.containment(F.col("a"), F.col("b"))).collect()] == [1.0, 0.3333, 0.0, 0.0]
    v = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [-1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in v.select(similarity.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0, 0.0]


def test_gate(spark):
    rows = spark.createDataFrame([(1, 20.0, 5.0), (2, 10.0, 3.0), (3, 5.0, 5.0)], "k int, a double, b double")
    assert evaluation.regression_gate(rows, F.lit(True)).first().status == "warn"
    assert evaluation.regression_gate(rows, F.col("b") > 4).first().status == "fail"
    assert [r[0] for r in spark.range(5).select(evaluation.budget_ratio(F.col("id"), 1, 3)).collect()] == [0.0, 1.0, 0.9, 0.8, 0.7]


def test_cache_is_asked_first(spark):
    rows = spark.createDataFrame([("alpha",), ("beta",), ("alpha",)], "text string").withColumn("key", providers.request_key(F.col("text")))
    first = providers.call(rows, "text", "key", providers.embed, providers.VECTOR)
    assert first.count() == 2
    known = spark.createDataFrame(first.collect(), first.schema)

    def never(_):
        raise AssertionError

    assert providers.call(rows, "text", "key", never, providers.VECTOR, known).count() == 2


def test_sources(spark, tmp_path):
    (tmp_path / "chapter_0001.txt").write_text("﻿\n Title one \nbody\nmore", encoding="utf-8")
    (tmp_path / "rows.jsonl").write_text('{"a": 1}\n\n[1]\n{"a": 2}\n', encoding="utf-8")
    c = files.chapters(files.read_texts(spark, str(tmp_path), "chapter_*.txt")).first()
    assert (c.chapter_id, c.chapter_title, c.body) == ("0001", "Title one", "body\nmore")
    schema = spark.createDataFrame([], "a int").schema
    assert sorted(r.a for r in files.read_jsonl(spark, str(tmp_path / "rows.jsonl"), schema).collect()) == [1, 2]
    assert files.optional_table(spark, str(tmp_path / "none.jsonl"), schema).count() == 0
    rules = files.load_rules("fragments = ['x']\ncombinations = [['a', 'b']]", cleaning.NoiseRules)
    assert rules.fragments == ("x",) and rules.combinations == (("a", "b"),)
    with pytest.raises(ValueError):
        files.load_rules("other = 1", cleaning.NoiseRules)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert chunking.scenes(docs, "doc_id", "text").count() == 0
    with pytest.raises(canon.EmptyScope):
        canon.require_rows(docs, "chapters")


def test_scopes_of_small_tables(spark):
    cases = spark.createDataFrame([("a", ["x"], [], ["r"]), ("b", ["y"], [], []), ("c", [], [], ["q"]), ("d", None, ["t"], None), ("e", ["z"], [], []), ("f", ["x"], ["t"], ["r"])], "case_id string, buckets array<string>, batches array<string>, expected array<string>")
    runs = spark.createDataFrame([("x", ["s"], ["r"], False), ("y", ["t"], None, True)], "bucket_id string, batch_ids array<string>, refs array<string>, sparse boolean")
    got = {r.case_id: r.reason for r in scoping.case_scopes(cases, runs, ["y"], []).collect()}
    assert got == {"a": "applicable", "b": "target_scope_failed", "c": "expected_refs_out_of_scope", "d": "target_scope_has_no_successful_local_reduce", "e": "target_scope_missing_from_run", "f": "target_scope_missing_from_run"}
    assert {r.reason for r in scoping.case_scopes(cases, runs.limit(0), [], []).filter("case_id = 'a'").collect()} == {"target_scope_missing_from_run"}
    entries = spark.createDataFrame([(1, "x", ["r", " "]), (2, "y", ["q"]), (3, "x", []), (4, "x", ["q", "r"])], "entry_id long, bucket_id string, refs array<string>")
    gone = scoping.retrieval_pool(entries, {"p": ["x"], "any": []}, entries.filter("entry_id = 9").select("entry_id"), spark.createDataFrame([("q",)], "ref string"))
    assert sorted((r.path, r.entry_id) for r in gone.collect()) == [("any", 1), ("any", 4), ("p", 1), ("p", 4)]
    one = spark.createDataFrame([(3,)], "chapter long")
    none = spark.createDataFrame([], "ord long, text string")
    assert scoping.scope_community(one, "chapter", {"plot spine": (none, 4, " ; ")}).first().summary == "chapter 3"
    assert scoping.scope_community(one.limit(0), "chapter", {"plot spine": (none, 4, " ; ")}).first().summary == ""


def test_routes_of_null_texts_and_repeated_ids(spark):
    rules = routing.RoutingRules((routing.Axis("a", ("x", "y"), "f"), routing.Axis("b", ("x", "y"), "f")), (routing.Bucket("n", ("a",), ("x",)), routing.Bucket("m", ("b",), ("x",))), features={"f": F.lit(0.0)})
    rows = spark.createDataFrame([(1, "X and y"), (1, "X and y"), (2, None), (3, "")], "i long, text string")
    axes = [(r.i, r.axis_id, r["rank"], r.role) for r in routing.select_axes(rows, "i", "text", rules).collect()]
    assert sorted(axes) == [(1, "a", 1, "primary"), (1, "a", 1, "primary"), (1, "b", 2, "primary"), (1, "b", 2, "primary")]
    got = sorted((r.i, r.bucket_id, r["rank"]) for r in routing.bucket_memberships(rows, "i", "text", rules).collect())
    assert got == [(1, "m", 1), (1, "m", 1), (1, "n", 2), (1, "n", 2), (2, routing.ORPHAN, 1), (3, routing.ORPHAN, 1)]
    assert routing.bucket_memberships(rows.limit(0), "i", "text", rules).count() == 0


def test_relationships_fall_back_to_ids(spark):
    edges = spark.createDataFrame([("e1", "a", "b", "knows"), ("e2", "b", "gone", None)], "edge_id string, source_id string, target_id string, relation_label string")
    nodes = spark.createDataFrame([("a", "Anna"), ("b", "Ben")], "node_id string, title string")
    got = {r.id: (r.source, r.target, r.weight) for r in graph.export_relationships(edges, nodes).collect()}
    assert got == {"e1": ("Anna", "Ben", 1.0), "e2": ("Ben", "gone", 1.0)}
    assert {r.target for r in graph.export_relationships(edges, nodes.limit(0)).collect()} == {"b", "gone"}


def test_edges_that_share_an_id_stay(spark):
    """Ids keep 40 bits: two edges of one id are still two, copies of an edge are one."""
    rows = [("edge_1", "t", "a", "b", "x"), ("edge_1", "t", "a", "c", "x"), ("edge_1", "t", "a", "b", "x"), ("edge_2", "t", "a", "b", "y" * 120 + "2"), ("edge_2", "t", "a", "b", "y" * 120 + "1"), ("edge_3", "t", "a", "b", None)]
    edges = spark.createDataFrame(rows, "edge_id string, edge_type string, source_id string, target_id string, support_text string")
    got = sorted((r.edge_id, r.target_id, (r.support_text or "")[-1:]) for r in graph.edges_first_wins(edges).collect())
    assert got == [("edge_1", "b", "x"), ("edge_1", "c", "x"), ("edge_2", "b", "1"), ("edge_3", "b", "")]
    assert {r.node_id: r.degree for r in graph.degrees(graph.edges_first_wins(edges)).collect()} == {"a": 4, "b": 3, "c": 1}


def test_cases_do_not_meet_reduces_one_by_one(spark):
    """40,000 cases of one bucket beside 40,000 reduces of it; nulls match nothing."""
    cases = spark.range(40_000).select(F.col("id").alias("case_id"), F.array(F.lit("x")).alias("buckets"), F.array().cast("array<string>").alias("batches"), F.array(F.concat(F.lit("r"), F.col("id").cast("string"))).alias("expected"))
    runs = spark.range(40_000).select(F.lit("x").alias("bucket_id"), F.array(F.col("id").cast("string")).alias("batch_ids"), F.array(F.concat(F.lit("r"), (2 * F.col("id")).cast("string"))).alias("refs"), (F.col("id") % 4 == 0).alias("sparse"))
    began = time.monotonic()
    got = {r.reason: r["count"] for r in scoping.case_scopes(cases, runs, [], []).groupBy("reason").count().collect()}
    assert got == {"applicable": 15_000, "expected_refs_out_of_scope": 25_000} and time.monotonic() - began < 60
    odd = spark.createDataFrame([("a", ["x"], [], [None]), ("b", [None], [], []), ("c", ["x", None], [None, "1"], ["r2", None])], "case_id string, buckets array<string>, batches array<string>, expected array<string>")
    runs = runs.unionByName(spark.createDataFrame([(None, [None, "1"], [None], False)], "bucket_id string, batch_ids array<string>, refs array<string>, sparse boolean"))
    assert {r.case_id: (r.reason, r.expected_refs) for r in scoping.case_scopes(odd, runs, [], []).collect()} == {"a": ("expected_refs_out_of_scope", 0), "b": ("target_scope_missing_from_run", 0), "c": ("applicable", 1)}


def test_containment_meets_all_candidates_without_exploding_pairs(spark, monkeypatch):
    """In several blocks of sources, with ties, one-character and repeated texts, null ids, and halves of a last digit."""
    monkeypatch.setattr(similarity, "SOURCE_BLOCK", 3)
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcÉ d", k=draw.randint(0, 40))) for _ in range(60)] + ["a", "a", "!", None, "abababa", "𝄞𝔞b𝔟c"]
    rows = [(None if i == 30 else i, x) for i, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "i long, text string").repartition(3)
    sources = docs.filter("i % 4 = 0 or i > 58")
    key = lambda x: "".join(c for c in x or "" if c.isalnum()).lower()
    grams = lambda x: {x[k : k + 2] for k in range(max(len(x) - 1, 1))} if x else set()
    want = []
    for i, x in rows:
        if key(x) and i is not None and (i % 4 == 0 or i > 58):
            scored = [((20_000 * len(grams(key(x)) & grams(key(y))) + len(grams(key(x)))) // (2 * len(grams(key(x)))) / 10_000, j) for j, y in rows if key(y)]
            best = sorted((-s, j is not None, j or 0, j) for s, j in scored if s >= 0.5)[:4]
            want += [(i, j, -s, r) for r, (s, _, _, j) in enumerate(best, 1)]
    found = similarity.containment_join(sources, docs, "i", "i", "text", 0.5, 4)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    monkeypatch.undo()
    plan = similarity.containment_join(sources, docs, "i", "i", "text", 0.5, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert similarity.containment_join(sources.limit(0), docs, "i", "i", "text", 0.5, 4).count() == 0


def test_nearest_are_those_of_the_cosine(spark, monkeypatch):
    """Against the Column form over all pairs: odd vectors, repeated ids, ties, halves of a last digit; pairs are no rows of the plan."""
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 9)
    monkeypatch.setattr(similarity, "ITEM_BLOCK", 13)
    draw = random.Random(8)
    rows = [(i, [draw.choice([-1.0, 0.0, 1.0, 2.0, 3.5]) for _ in range(3)]) for i in range(50)]
    rows += [(50, None), (51, []), (52, [0.0, 0.0, 0.0]), (53, [1.0, None, 2.0]), (54, [1.0, 2.0]), (54, [2.0, 1.0]), (55, [float("nan"), 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (56, [1e-200, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    pairs = vectors.select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q")).crossJoin(vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")))
    scored = pairs.select("q_id", "id", F.round(similarity.cosine(F.col("q"), F.col("v")), 4).alias("score"))
    plain = similarity.ranked(scored.filter("id <> q_id"), ["q_id"], [F.col("score").desc(), F.col("id")], 4)
    found = similarity.cosine_topk(vectors, vectors, "vec_id", "embedding", 4)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert similarity.cosine_topk(vectors, vectors.limit(0), "vec_id", "embedding", 4).count() == 0 == similarity.cosine_topk(vectors.limit(0), vectors, "vec_id", "embedding", 4).count()


def test_slots_take_the_best_rule_of_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 5)
    monkeypatch.setattr(similarity, "ITEM_BLOCK", 7)
    draw = random.Random(9)
    rows = spark.createDataFrame([(i, [draw.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(3)]) for i in range(60)] + [(60, None), (80, [0.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    slots, rules = rows.filter("vec_id % 20 = 0"), rows.filter("vec_id % 20 <> 0")
    pairs = slots.select(F.col("vec_id").alias("s"), F.col("embedding").alias("q")).crossJoin(rules.select(F.col("vec_id").alias("r"), F.col("embedding").alias("v"))).select("s", "r", F.round(similarity.cosine(F.col("q"), F.col("v")), 4).alias("x"))
    want = [(r.s, r.r, r.x, r.x >= 0.35) for r in similarity.ranked(pairs, ["s"], [F.col("x").desc(), F.col("r")], 1).collect()]
    found = merging.slot_coverage(slots, rules, "vec_id", "vec_id", "embedding", 0.35)
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) == 5
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_reasoning_counts_over_lists_of_refs(spark, monkeypatch):
    """Against plain counts, with rules whose refs go over many folds, repeated rows, null and empty refs, null rules and ties."""
    monkeypatch.setattr(scoping, "LISTS_HELD", 5)
    draw = random.Random(2)
    cites = [(draw.choice([None, *range(40)]), draw.choice(["", None, *(f"r{i}" for i in range(60))])) for _ in range(900)] + [(40, "alone")]
    holds = [(draw.randrange(3000) * 7, f"r{draw.randrange(60)}") for _ in range(2000)] + [(5, None), (5, " ")]
    sizes, of = Counter(e for e, r in set(holds) if r and r.strip()), defaultdict(set)
    for e, r in holds:
        of[r].add(e)
    want = []
    for rule in {c for c, _ in cites}:
        shared = Counter(e for r in {r for c, r in cites if c == rule and r} for e in of.get(r, ()))
        want += [(rule, *min(((e, n) for e, n in shared.items()), key=lambda x: (-x[1], -sizes[x[0]], x[0])))] if shared else []
    rules, entries = spark.createDataFrame(cites, "c long, r string").repartition(3), spark.createDataFrame(holds, "e long, r string")
    found = scoping.infer_reasoning(rules, entries, "c", "e", "r")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want)) and len(want) == 41
    assert scoping.infer_reasoning(rules.limit(0), entries, "c", "e", "r").count() == 0 == scoping.infer_reasoning(rules, entries.limit(0), "c", "e", "r").count()
    lists = [[0], [], [3, 200, 70_000, 1 << 31], list(range(300))]
    packed = next(scoping.packed_lists(iter([pa.RecordBatch.from_arrays([pa.array(list("abcd")), pa.array(lists, pa.list_(pa.int64()))], names=["ref", "ranks"])])))
    of, numbers = scoping.unpacked(packed.column(1).to_pylist())
    assert [numbers[of == i].tolist() for i in range(4)] == lists
