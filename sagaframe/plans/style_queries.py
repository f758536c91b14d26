"""Queries over sampling, routing, packing, merging, evaluation, segments, run logs and providers."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from sagaframe.functions import text as X
from sagaframe.operators import evaluation, merging, packing, providers, routing, sampling, segments
from sagaframe.session import read_table, shared_folder
from sagaframe.streaming import runlog

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@query("""WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents), p AS (SELECT DISTINCT round_even(i * (n - 1) / 49.0, 0)::BIGINT AS pos FROM (SELECT DISTINCT n FROM r), range(50) t(i))
SELECT doc_id, n_chars FROM r JOIN p USING (pos)""")
def even_sample(spark, d):
    return sampling.even_sample(read_table(spark, d, "documents").select("doc_id", "n_chars"), ["doc_id"], 50)


@query("""WITH r AS (SELECT doc_id, source, n_chars, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) > 2 THEN 1 ELSE 0 END AS overflow FROM documents)
SELECT doc_id, source, n_chars, overflow::INTEGER AS overflow FROM r ORDER BY overflow, n_chars DESC, doc_id LIMIT 45""")
def per_group_capped_topk(spark, d):
    return sampling.capped_groups(read_table(spark, d, "documents").select("doc_id", "source", "n_chars"), "source", [F.col("n_chars").desc(), F.col("doc_id")], 2, 45)


@query("""WITH p AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), t AS (SELECT user_id, sum(n)::BIGINT AS n FROM p GROUP BY 1 ORDER BY n DESC, user_id LIMIT 15), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS r FROM p)
SELECT t.user_id, t.n, (SELECT string_agg(event_type, ',' ORDER BY event_type) FROM r WHERE r.user_id = t.user_id AND r.r <= 4) AS refs FROM t""")
def top_items(spark, d):
    return sampling.top_items(read_table(spark, d, "events"), "user_id", "event_type", 15)


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def scope_semi_join(spark, d):
    return sampling.in_selection(read_table(spark, d, "documents").select("doc_id", "lang", "source"), read_table(spark, d, "labels").filter("quality = 1"), "doc_id")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def scope_anti_join(spark, d):
    return read_table(spark, d, "documents").select("doc_id", "lang", "source").join(read_table(spark, d, "labels"), "doc_id", "left_anti")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) OR source IN ('src1', 'src2')")
def scope_or_semi(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source")
    return sampling.in_either(docs, "doc_id", read_table(spark, d, "labels").filter("toxic = 1"), docs.filter("source in ('src1', 'src2')"), "source")


AXES = (
    routing.Axis("english", ("the ", "and ", "that ", "with ", "for "), "length"),
    routing.Axis("german", ("der ", "die ", "und ", "nicht ", "mit "), "lines"),
    routing.Axis("romance", ("que ", "para ", "les ", "des ", "une "), "length"),
    routing.Axis("license", ("licensed", "license", "rights", "released"), "lines", True),
)
BUCKETS = (
    routing.Bucket("north", ("english", "german"), ("the ", "der ", "and ")),
    routing.Bucket("south", ("romance",), ("que ", "les ", "para ")),
    routing.Bucket("legal", ("license",), ("license", "rights"), 0.05),
)
RULES = routing.RoutingRules(AXES, BUCKETS)


def _rules():
    """With the features, which are columns and so need a session."""
    return replace(RULES, features={"length": X.clip_ratio(F.col("n_chars"), 4000), "lines": X.clip_ratio(F.size(F.split("text", "\n")), 20)})


def _scores(spark, d):
    return routing.axis_scores(read_table(spark, d, "documents"), "doc_id", "text", _rules())


def _hits(words):
    return " + ".join(f"contains(lower(text), '{w}')::INT" for w in words)


def _clip(a, b):
    return f"round(greatest(0, least(({a}) / {float(b)}::DOUBLE, 1)) + 1e-9, 4)"


_FEATURE = {"length": _clip("n_chars", 4000), "lines": _clip("len(string_split(text, chr(10)))", 20)}


def _axis_sql(a):
    w = RULES.strict_weights if a.high_precision else RULES.weights
    lex = _clip(_hits(a.words), max(len(a.words) // 3, 2))
    score = f"round(least(1, {lex} * {w[0]}::DOUBLE + {_FEATURE[a.feature]} * {w[1]}::DOUBLE) + 1e-9, 4)"
    if a.high_precision:
        score = f"CASE WHEN ({_hits(a.words)}) >= 2 AND {_FEATURE[a.feature]} > 0 THEN {score} ELSE 0 END"
    return f"SELECT doc_id, '{a.axis_id}' AS axis_id, {lex}::DOUBLE AS lexical, ({score})::DOUBLE AS score FROM documents"


SQL_AXES = " UNION ALL ".join(map(_axis_sql, AXES))


@query(SQL_AXES)
def axis_scores(spark, d):
    return _scores(spark, d)


@query(f"""WITH s AS ({SQL_AXES}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, axis_id) AS rank, max(score) OVER (PARTITION BY doc_id) AS best FROM s)
SELECT doc_id, axis_id, score, rank::INTEGER AS rank, CASE WHEN score >= 0.22 OR (best < 0.22 AND rank = 1) THEN 'primary' ELSE 'secondary' END AS role FROM r
WHERE rank <= 4 AND (score >= 0.22 OR (best < 0.22 AND rank = 1 AND score >= 0.12) OR (rank > 1 AND score >= 0.18))""")
def axis_select(spark, d):
    return routing.select_axes(read_table(spark, d, "documents"), "doc_id", "text", _rules())


def _bucket_sql(b):
    align = "(" + " + ".join(f"{a}::DOUBLE" for a in b.axes) + f") / {len(b.axes)}"
    lex = _clip(_hits(b.words), max(len(b.words) // 3, 2))
    return f"SELECT doc_id, '{b.bucket_id}' AS bucket_id, CASE WHEN {align} >= {b.gate} THEN round(least(1, 0.6::DOUBLE * {align} + 0.3::DOUBLE * {lex}) + 1e-9, 4) ELSE 0 END::DOUBLE AS confidence FROM w"


SQL_BUCKETS = f"""WITH w AS (SELECT d.doc_id, text, n_chars, {', '.join(f"max(score) FILTER (axis_id = '{a.axis_id}') AS {a.axis_id}" for a in AXES)} FROM documents d JOIN ({SQL_AXES}) s ON s.doc_id = d.doc_id GROUP BY d.doc_id, text, n_chars),
s AS ({' UNION ALL '.join(map(_bucket_sql, BUCKETS))}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, bucket_id) AS rank, max(confidence) OVER (PARTITION BY doc_id) AS best FROM s)
SELECT doc_id, CASE WHEN best < 0.18 THEN 'unassigned' ELSE bucket_id END AS bucket_id, confidence, rank::INTEGER AS rank FROM r WHERE CASE WHEN best < 0.18 THEN rank = 1 ELSE confidence >= 0.18 AND rank <= 4 END"""


@query(SQL_BUCKETS)
def bucket_membership(spark, d):
    return routing.bucket_memberships(read_table(spark, d, "documents"), "doc_id", "text", _rules())


_STAGES = "count(*) AS items, count_if(value >= 10)::BIGINT AS routed, count_if(value >= 20)::BIGINT AS batched, count_if(value >= 30)::BIGINT AS reduced FROM (SELECT event_type, day(ts)::BIGINT AS day, value FROM events)"


def _events(spark, d):
    e = read_table(spark, d, "events").select("event_type", F.dayofmonth("ts").cast("long").alias("day"), "value")
    return e, {"routed": F.col("value") >= 10, "batched": F.col("value") >= 20, "reduced": F.col("value") >= 30}


@query(f"SELECT event_type, day, {_STAGES} GROUP BY CUBE (event_type, day)")
def coverage_report(spark, d):
    e, stages = _events(spark, d)
    return routing.coverage(e, ["event_type", "day"], stages)


@query(f"SELECT event_type, day, {_STAGES} GROUP BY ROLLUP (event_type, day)")
def coverage_rollup(spark, d):
    e, stages = _events(spark, d)
    return routing.coverage_rollup(e, ["event_type", "day"], stages)


def _plan(spark, d):
    docs = routing.routed(read_table(spark, d, "documents"), "text", _rules())
    best = F.col("buckets")[0]
    route = F.struct(best["bucket_id"].alias("bucket_id"), best["confidence"].alias("confidence"), F.array_sort(F.col("axes.axis_id")).alias("axes"))
    items = docs.select(F.col("doc_id").alias("item"), F.col("lang").alias("kind"), F.col("source").alias("chapter"), X.token_estimate(F.col("text")).alias("tokens"), X.clip_ratio(F.col("n_chars"), 5000).alias("evidence"), F.inline_outer(F.array(route)))
    return packing.plan_batches(items.filter(F.size("axes") > 0), packing.BatchRules())


@query()
def batch_plan(spark, d):
    return _plan(spark, d)


@query()
def batch_summary(spark, d):
    return packing.batch_summary(_plan(spark, d))


@query()
def unbatched_items(spark, d):
    return packing.unbatched(read_table(spark, d, "documents").select("doc_id", "source"), _plan(spark, d), "doc_id")


_KEY = "lower(regexp_replace(coalesce({0}, ''), '\\s+', '', 'g'))"


@query(f"""WITH p AS (SELECT p_brand, {_KEY.format('p_name')} AS key, p_name AS text, p_type AS ref, p_partkey AS ord FROM part), o AS (SELECT p_brand, key, ref, min(ord) AS ord, arg_min(text, ord) AS text, count(*) AS n FROM p GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, key ORDER BY ord, ref) AS r FROM o)
SELECT p_brand, key, arg_min(text, ord) AS text, sum(n)::BIGINT AS n, string_agg(ref, ',' ORDER BY ord, ref) FILTER (r <= 12) AS refs FROM r GROUP BY 1, 2""")
def bucket_merge(spark, d):
    return merging.merge_by_text(read_table(spark, d, "part"), "p_brand", "p_name", "p_type", "p_partkey")


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE (p_name, p_brand) NOT IN (SELECT (p_name, p_brand) FROM part GROUP BY p_name, p_brand HAVING count(DISTINCT p_type) > 1)")
def conflict_drop(spark, d):
    return merging.drop_conflicts(read_table(spark, d, "part"), ["p_name", "p_brand"], "p_type").select("p_partkey", "p_name", "p_brand", "p_size")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_retailprice DESC, p_partkey) AS r FROM part)
SELECT p_brand, p_name, max(p_partkey) FILTER (r = 1) AS kept, count(*) AS merged, min(p_partkey) AS first_id, max(p_partkey) AS last_id FROM r GROUP BY 1, 2""")
def rule_lineage(spark, d):
    return merging.lineage(read_table(spark, d, "part"), ["p_brand", "p_name"], "p_partkey", [F.col("p_retailprice").desc(), F.col("p_partkey")])


@query("""WITH f AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_size, p_partkey) AS k FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS rank FROM f WHERE k = 1)
SELECT p_brand, p_partkey, p_name, rank::INTEGER AS rank FROM r WHERE rank <= 5""")
def append_capped(spark, d):
    return merging.append_capped(read_table(spark, d, "part"), "p_brand", "p_name", [F.col("p_size"), F.col("p_partkey")], 5).select("p_brand", "p_partkey", "p_name", "rank")


@query("SELECT p_type, arg_max(p_partkey, (p_retailprice, -p_partkey)) AS p_partkey FROM part GROUP BY 1")
def scalar_pick(spark, d):
    return merging.scalar_pick(read_table(spark, d, "part"), "p_type", [F.col("p_retailprice").desc(), F.col("p_partkey")]).select("p_type", "p_partkey")


@query()
def alias_groups(spark, d):
    rules = read_table(spark, d, "part").select("p_brand", "p_partkey", F.array("p_name", F.concat("p_type", F.col("p_size").cast("string"))).alias("aliases"), "p_size")
    return merging.alias_groups(rules, "p_brand", "p_partkey", "aliases", "p_size").select("p_brand", "p_partkey", "group_no")


@query()
def evidence_trim(spark, d):
    return merging.select_evidence(read_table(spark, d, "part").select("p_name", "p_brand", "p_partkey"), "p_name", "p_brand", "p_partkey", ["Brand#1", "Brand#2", "Brand#3"])


@query("""SELECT s.vec_id AS slot_id, arg_max(r.vec_id, (r.score, -r.vec_id)) AS rule_id, max(r.score) AS score, max(r.score) >= 0.35 AS covered FROM (SELECT vec_id FROM embeddings WHERE vec_id % 20 = 0) s
JOIN (SELECT a.vec_id AS s_id, b.vec_id, round(greatest(0, least(1, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 4) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 AND b.vec_id % 20 <> 0) r ON r.s_id = s.vec_id GROUP BY 1""")
def slot_coverage(spark, d):
    e = read_table(spark, d, "embeddings")
    return merging.slot_coverage(e.filter("vec_id % 20 = 0"), e.filter("vec_id % 20 <> 0"), "vec_id", "vec_id", "embedding", 0.35)


@query()
def semantic_dedupe(spark, d):
    return merging.greedy_dedupe(read_table(spark, d, "embeddings").withColumn("prio", -F.col("vec_id")), "label", "vec_id", "embedding", "prio", 0.3, 20)


_TARGETS = "(SELECT DISTINCT source, 20::BIGINT AS target FROM documents)"


def _targets(spark, d):
    return read_table(spark, d, "documents").select("source").distinct().withColumn("target", F.lit(20).cast("long"))


def _good(spark, d):
    return read_table(spark, d, "documents").select("doc_id", "source").join(read_table(spark, d, "labels").filter("quality = 1"), "doc_id", "left_semi")


_GOOD = "(SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))"


@query(f"WITH c AS (SELECT source, count(*) AS n FROM {_GOOD} GROUP BY 1) SELECT t.source, target, coalesce(n, 0) AS n, target - coalesce(n, 0) AS deficit FROM {_TARGETS} t LEFT JOIN c USING (source) WHERE target > coalesce(n, 0)")
def section_gaps(spark, d):
    return merging.section_gaps(_targets(spark, d), _good(spark, d), "source")


@query(f"""WITH c AS (SELECT source, count(*) AS n FROM {_GOOD} GROUP BY 1), r AS (SELECT t.source, round(least(coalesce(n, 0) / target::DOUBLE, 1), 4) AS ratio FROM {_TARGETS} t LEFT JOIN c USING (source))
SELECT count(*) AS sections, count_if(ratio >= 1)::BIGINT AS complete, round(avg(ratio), 4) AS completeness, coalesce(string_agg(CASE WHEN ratio < 1 THEN source END, ',' ORDER BY source), '') AS underfilled FROM r""")
def section_completeness(spark, d):
    return evaluation.section_completeness(_targets(spark, d), _good(spark, d), "source")


@query(f"""WITH c AS (SELECT source, count(DISTINCT doc_id) AS candidates FROM documents GROUP BY 1), f AS (SELECT source, count(DISTINCT doc_id) AS final FROM {_GOOD} GROUP BY 1)
SELECT source, candidates, coalesce(final, 0) AS final, candidates - coalesce(final, 0) AS dropped, round((candidates - coalesce(final, 0)) / candidates, 4) AS loss FROM c LEFT JOIN f USING (source) ORDER BY loss DESC, source LIMIT 8""")
def assembly_loss(spark, d):
    return evaluation.assembly_loss(read_table(spark, d, "documents"), _good(spark, d), "source", "doc_id")


def _quality(spark, d):
    t = F.lower("text")
    c = lambda words: X.clip_ratio(X.keyword_hits(t, words), len(words))
    rows = read_table(spark, d, "documents").select(
        "doc_id",
        evaluation.specificity(c(("the ", "der ", "que ")), c(("and", "und")), X.clip_ratio(F.col("n_chars"), 2000)).alias("specificity"),
        evaluation.actionability(c(("ing", "ung", "tion")), c((".",))).alias("actionability"),
        evaluation.grounding(X.clip_ratio(F.size(F.split("text", "\n")), 10), c((",", "."))).alias("grounding"),
    )
    return evaluation.rule_quality(rows)


def _c(words):
    return _clip(_hits(words), len(words))


SQL_QUALITY = f"""WITH r AS (SELECT doc_id, round(0.5 * {_c(('the ', 'der ', 'que '))} + 0.3 * {_c(('and', 'und'))} + 0.2 * {_clip('n_chars', 2000)} + 1e-9, 4)::DOUBLE AS specificity,
round(0.7 * {_c(('ing', 'ung', 'tion'))} + 0.3 * {_c(('.',))} + 1e-9, 4)::DOUBLE AS actionability, round(0.55 * {_clip('len(string_split(text, chr(10)))', 10)} + 0.45 * {_c((',', '.'))} + 1e-9, 4)::DOUBLE AS grounding FROM documents),
o AS (SELECT *, round(0.34 * specificity + 0.33 * actionability + 0.33 * grounding + 1e-9, 4) AS overall_score FROM r)
SELECT *, CASE WHEN overall_score >= 0.72 THEN 'pass' WHEN overall_score >= 0.55 THEN 'warn' ELSE 'fail' END AS status FROM o"""


@query(SQL_QUALITY)
def rule_quality(spark, d):
    return _quality(spark, d)


@query(f"SELECT count(*) AS rules, count_if(status = 'pass')::BIGINT AS pass, count_if(status = 'warn')::BIGINT AS warn, count_if(status = 'fail')::BIGINT AS fail, round(avg(overall_score), 4) AS average FROM ({SQL_QUALITY})")
def rule_quality_summary(spark, d):
    return evaluation.quality_summary(_quality(spark, d))


def _judged(spark, d):
    j = read_table(spark, d, "labels").join(read_table(spark, d, "documents"), "doc_id")
    status = F.when(F.col("lang") == "fr", "not_applicable").when(F.col("quality") == 1, "pass").otherwise("fail")
    return j.select("doc_id", F.col("source").alias("dimension"), (F.col("quality") * 60 + F.col("n_chars") % 40).cast("double").alias("score"), status.alias("status"))


SQL_JUDGED = "(SELECT doc_id, source AS dimension, (quality * 60 + n_chars % 40)::DOUBLE AS score, CASE WHEN lang = 'fr' THEN 'not_applicable' WHEN quality = 1 THEN 'pass' ELSE 'fail' END AS status FROM labels JOIN documents USING (doc_id))"


@query(f"""WITH g AS (SELECT dimension, count(*) AS n_rows, count_if(status <> 'not_applicable')::BIGINT AS applicable, count_if(status = 'pass')::BIGINT AS passed, round(avg(score) FILTER (status <> 'not_applicable'), 4) AS mean FROM {SQL_JUDGED} GROUP BY 1)
SELECT *, CASE WHEN applicable > 0 THEN round(passed / applicable, 4) END AS pass_rate FROM g""")
def judge_summary(spark, d):
    return evaluation.judge_summary(_judged(spark, d), "doc_id", "dimension", "score", "status")


_DIMENSIONS = tuple(f"src{i}" for i in range(20))


@query(f"SELECT status, {', '.join(f'round(avg(score) FILTER (dimension = $${s}$$), 4) AS {s}' for s in _DIMENSIONS)} FROM {SQL_JUDGED} GROUP BY 1")
def judge_pivot(spark, d):
    return evaluation.judge_pivot(_judged(spark, d), "status", "dimension", "score", list(_DIMENSIONS))


def _compared(spark, d):
    r = _judged(spark, d)
    return evaluation.compare_rows(r.filter("doc_id % 5 <> 0"), r.withColumn("score", F.col("score") + F.col("doc_id") % 15 - 7).filter("doc_id % 7 <> 0"), "doc_id", "score", 2.0)


SQL_COMPARED = f"""(WITH r AS (SELECT * FROM {SQL_JUDGED}) SELECT doc_id, a, b, delta, CASE WHEN delta >= 2 THEN 'a' WHEN delta <= -2 THEN 'b' ELSE 'tie' END AS winner
FROM (SELECT doc_id, score AS a, score + doc_id % 15 - 7 AS b, round(score - (score + doc_id % 15 - 7), 2) AS delta FROM r WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0))"""


@query(f"SELECT * FROM {SQL_COMPARED}")
def compare_runs(spark, d):
    return _compared(spark, d)


@query(f"""WITH s AS (SELECT count(*) AS n_rows, count_if(winner = 'a')::BIGINT AS wins_a, count_if(winner = 'b')::BIGINT AS wins_b, round(avg(delta), 2) AS delta FROM {SQL_COMPARED})
SELECT *, round(wins_a / n_rows, 4) AS rate_a, round(wins_b / n_rows, 4) AS rate_b, CASE WHEN wins_a > wins_b THEN 'a' WHEN wins_b > wins_a THEN 'b' WHEN delta >= 2 THEN 'a' WHEN delta <= -2 THEN 'b' ELSE 'tie' END AS winner FROM s""")
def compare_summary(spark, d):
    return evaluation.compare_summary(_compared(spark, d), 2.0)


@query(f"""WITH s AS (SELECT count(*) AS cases, sum(CASE WHEN a - b > 12 THEN 1.0 WHEN a - b > 6 THEN 0.5 ELSE 0 END)::DOUBLE AS severity, bool_and(b > -100) AS gates_ok FROM {SQL_COMPARED})
SELECT *, CASE WHEN NOT gates_ok OR severity >= 3 THEN 'fail' WHEN severity >= 1 THEN 'warn' ELSE 'pass' END AS status FROM s""")
def regression_gate(spark, d):
    return evaluation.regression_gate(_compared(spark, d), F.col("b") > -100)


@query("""WITH a AS (SELECT user_id, count(*) AS total_items, count_if(event_type IN ('view', 'click'))::BIGINT AS success_count, count_if(event_type = 'error')::BIGINT AS failure_count, count_if(event_type = 'signup')::BIGINT AS skipped_count, max(ts) AS updated_at FROM events GROUP BY 1),
b AS (SELECT *, success_count + failure_count + skipped_count AS processed_items FROM a), c AS (SELECT *, total_items - processed_items AS pending_items, round(processed_items / total_items, 4) AS progress_ratio FROM b)
SELECT * REPLACE (strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at), CASE WHEN pending_items > 0 THEN 'running' WHEN failure_count > 0 THEN 'completed_with_failures' ELSE 'completed' END AS status FROM c""")
def run_status(spark, d):
    e = read_table(spark, d, "events")
    s = runlog.run_status(e, "user_id", "ts", F.col("event_type").isin("view", "click"), F.col("event_type") == "error", F.col("event_type") == "signup")
    return s.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) WHERE r = 1")
def run_latest(spark, d):
    return runlog.latest(read_table(spark, d, "events"), "user_id", "ts").select("user_id", "event_id", "event_type")


def _stream(spark, d):
    return runlog.stream(spark, d, read_table(spark, d, "events"), "events*.parquet")


def _drained(spark, df):
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    return runlog.drain(df, f"{folder}/out", f"{folder}/state")


_SLOTS = "time_bucket(INTERVAL '6 hours', ts)"


@query(f"""WITH m AS (SELECT max(ts) AS t FROM events) SELECT strftime({_SLOTS}, '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, m GROUP BY {_SLOTS}, event_type HAVING {_SLOTS} + INTERVAL '6 hours' <= any_value(t) - INTERVAL '1 hour'""")
def stream_runlog_windows(spark, d):
    out = _drained(spark, runlog.tumbling(_stream(spark, d), "ts", "event_type", "6 hours", "1 hour"))
    return out.withColumn("window_start", runlog.shown("window_start", "yyyy-MM-dd HH:mm"))


@query()
def stream_runlog_sessions(spark, d):
    out = _drained(spark, runlog.sessions(_stream(spark, d), "ts", "user_id", "2 hours", "1 hour"))
    return out.select("user_id", runlog.shown("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), runlog.shown("session_end", "yyyy-MM-dd HH:mm:ss").alias("session_end"), "n")


@query("SELECT DISTINCT event_id, event_type FROM events")
def stream_runlog_dedupe(spark, d):
    return _drained(spark, runlog.first_seen(_stream(spark, d), "ts", ["event_id"], "1 hour").select("event_id", "event_type"))


def _evidence(spark, d):
    e = read_table(spark, d, "events")
    return e.select((F.col("user_id") % 10).alias("book"), F.floor((F.unix_timestamp(runlog.utc(F.col("ts"))) - 1704067200) / 14400).cast("long").alias("chapter"), F.col("event_type").alias("layer"), F.col("value").alias("weight"))


SQL_EVIDENCE = "(SELECT user_id % 10 AS book, floor((epoch(date_trunc('second', ts)) - 1704067200) / 14400)::BIGINT AS chapter, event_type AS layer, value AS weight FROM events)"


@query(f"""WITH s AS (SELECT book, chapter, layer, round(sum(weight), 4) AS score FROM {SQL_EVIDENCE} GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY book, chapter ORDER BY score DESC, layer) AS r FROM s)
SELECT book, chapter, max(layer) FILTER (r = 1) AS primary_layer, max(score) FILTER (r = 1) AS primary_score, max(layer) FILTER (r = 2) AS secondary_layer FROM r WHERE r <= 2 GROUP BY book, chapter""")
def chapter_profiles(spark, d):
    return segments.layer_profiles(_evidence(spark, d), ["book", "chapter"], "layer", "weight")


SQL_WINDOWS = f"""WITH w AS (SELECT book, unnest(range((greatest(0, ceil((chapter - 23) / 4)))::BIGINT, chapter // 4 + 1)) * 4 AS start, layer, weight FROM {SQL_EVIDENCE}), s AS (SELECT book, start, layer, round(sum(weight), 4) AS score FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY book, start ORDER BY score DESC, layer) AS r FROM s) SELECT book, start, CASE WHEN score >= 18 THEN layer END AS dominant, score FROM r WHERE r = 1"""


@query(SQL_WINDOWS)
def window_profiles(spark, d):
    return segments.window_profiles(_evidence(spark, d), "book", "chapter", "layer", "weight", 24, 4, 18.0)


@query()
def layer_boundaries(spark, d):
    return segments.layer_boundaries(window_profiles(spark, d), "book", 16)


@query()
def story_segments(spark, d):
    chapters = _evidence(spark, d).select("book", "chapter").distinct()
    return segments.segment_spans(segments.segments(chapters, layer_boundaries(spark, d), "book", "chapter"), "book", "chapter")


@query()
def offline_extraction(spark, d):
    docs = read_table(spark, d, "documents").withColumn("key", providers.request_key(F.col("text")))
    facts = providers.call(docs, "text", "key", providers.extract_facts, providers.FACTS)
    return docs.select("doc_id", "key").join(facts, "key").select("doc_id", F.size("entities").cast("long").alias("n_entities"), "n_numbers")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'new' WHEN doc_id % 4 = 1 THEN 'reuse' WHEN doc_id % 4 = 2 THEN 'reuse' ELSE 'rerun' END AS action FROM documents")
def resume_plan(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("fp"))
    old = docs.filter("doc_id % 4 <> 0").withColumn("fp", F.when(F.col("doc_id") % 4 == 2, F.col("fp")).when(F.col("doc_id") % 4 == 3, "other"))
    return providers.resume(docs, old, "doc_id", "fp").select("doc_id", "action")


@query("SELECT count(*) AS jobs, count_if(quality = 0)::BIGINT AS failed, count_if(quality = 0 AND toxic = 1)::BIGINT AS critical_failed, count_if(quality = 0 AND toxic = 1) = 0 AND count_if(quality = 0) <= 100 AND count_if(quality = 0) <= 0.15 * count(*) AS ok FROM labels")
def guardrails(spark, d):
    return merging.guardrails(read_table(spark, d, "labels"), F.col("quality") == 0, F.col("toxic") == 1, 100, 0.15)
