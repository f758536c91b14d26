"""Queries over signals, budgets, worker shares and gates, and round trips through the sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sagaframe.functions import text as X
from sagaframe.operators import signals
from sagaframe.session import read_table, shared_folder
from sagaframe.sources import files

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@query("""WITH p AS (SELECT DISTINCT user_id, day(ts) AS c FROM events), c AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS r, count(*) OVER () AS n FROM (SELECT DISTINCT c FROM p))
SELECT user_id, CASE WHEN any_value(n) <= 1 THEN 0.5 ELSE round(avg(r) / (any_value(n) - 1), 4) END::DOUBLE AS chapter_position FROM p JOIN c USING (c) GROUP BY 1""")
def chapter_position(spark, d):
    events = read_table(spark, d, "events").select("user_id", F.dayofmonth("ts").alias("day"))
    return signals.chapter_positions(events, "user_id", "day")


_WORDS = {"institution": ("the", "der"), "resource": ("and", "que"), "body": ("tion", "ent"), "humor": ("!!", "re "), "sales": ("casino", "win", "|"), "contract": ("icens", "rights"), "conflict": ("***", "$$$"), "voice": ("han", "ing", "ung")}


def _heard(k):
    return f"least(({' + '.join(f'contains(text, {chr(39)}{w}{chr(39)})::INT' for w in _WORDS[k])}) / 4.0, 1)"


def _part(most, *ks):
    return f"least(({' + '.join(ks)}) / {most}.0, 1)"


@query(f"""WITH a AS (SELECT doc_id, coalesce(text, '') AS text, n_chars % 9 AS entities, n_chars % 5 AS relations, n_chars % 4 AS powers, doc_id % 6 AS styles, doc_id % 13 AS facts, doc_id % 11 AS events, n_chars % 7 AS questions, n_chars / 5000.0 AS pos FROM documents),
f AS (SELECT doc_id, {_part(8, 'entities')} AS entity_density, {_part(4, 'relations')} AS relationship_change_density, greatest({_heard('institution')}, {_part(10, 'powers', 'events')}) AS institution_density,
greatest({_heard('resource')}, {_part(18, 'facts', 'questions')}) AS resource_pressure_density, greatest({_heard('body')}, {_part(4, 'powers')}) AS body_modification_density, greatest({_heard('humor')}, {_part(5, 'styles')}) AS dark_humor_signal,
{_heard('sales')} AS sales_pitch_signal, {_heard('contract')} AS contract_signal, greatest({_heard('conflict')}, {_part(8, 'relations', 'questions')}) AS conflict_intensity, greatest(0, least(1, pos)) AS chapter_position,
{_part(20, 'facts', 'events', 'relations', 'powers', 'styles')} AS evidence_density, greatest({_heard('voice')}, {_part(10, 'styles', 'questions')}) AS voice_novelty FROM a)
SELECT doc_id, round(COLUMNS(* EXCLUDE doc_id)::DOUBLE, 4) FROM f""")
def scene_features(spark, d):
    docs = read_table(spark, d, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    n = {"entities": F.col("n_chars") % 9, "relations": F.col("n_chars") % 5, "powers": F.col("n_chars") % 4, "styles": F.col("doc_id") % 6, "facts": F.col("doc_id") % 13, "events": F.col("doc_id") % 11, "questions": F.col("n_chars") % 7}
    return docs.select("doc_id", *signals.scene_features(F.col("text"), n, F.col("n_chars") / 5000.0, _WORDS))


@query("""WITH a AS (SELECT conv_id, turn, string_split(coalesce(text, ''), '. ') AS xs FROM conversations), b AS (SELECT conv_id, turn, unnest(xs) AS text, generate_subscripts(xs, 1) - 1 AS place FROM a)
SELECT conv_id, turn, place::BIGINT AS place, md5(text) AS md5, 'fact_' || substr(sha1(conv_id || '|' || turn || '|' || place || '|' || text), 1, 10) AS id FROM b""")
def flattened_facts(spark, d):
    c = read_table(spark, d, "conversations")
    rows = signals.flattened(c, ["conv_id", "turn"], F.split(F.coalesce("text", F.lit("")), r"\. "), "fact")
    return rows.select("conv_id", "turn", "place", F.md5("text").alias("md5"), "id")


_KEYS = ("casino", "icensed under", "the", "$$$", "no such words")


@query(" UNION ALL ".join(f"SELECT '{k}' AS keyword, min(doc_id) FILTER (contains(text, '{k}')) AS first_ref, count(*) FILTER (contains(text, '{k}')) AS hits FROM documents" for k in _KEYS))
def keyword_first_hits(spark, d):
    return signals.first_hits(read_table(spark, d, "documents"), "doc_id", "text", _KEYS)


_AXES = {"trade": ("casino", "win"), "law": ("icens", "rights"), "noise": ("***", "!!"), "speech": ("the", "der", "que", "les")}


@query("WITH a AS (SELECT source, " + ", ".join(f"count(*) FILTER ({' OR '.join(f'contains(text, {chr(39)}{w}{chr(39)})' for w in ws)}) AS {a}" for a, ws in _AXES.items()) + " FROM documents GROUP BY 1), b AS (SELECT *, round((" + " + ".join(f"({a} > 0)::INT" for a in _AXES) + ") / 4.0, 4)::DOUBLE AS coverage FROM a) "
       + " UNION ALL ".join(f"SELECT source, coverage, '{a}' AS axis_id, {a} AS hits, {a} > 0 AS covered FROM b" for a in _AXES))
def axis_coverage(spark, d):
    return signals.axis_coverage(read_table(spark, d, "documents"), "source", "text", _AXES)


@query("""WITH RECURSIVE r AS (SELECT p_brand, p_partkey, p_size::BIGINT AS t, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM part),
f AS (SELECT p_brand, 0::BIGINT AS k, 0::BIGINT AS used, 0::BIGINT AS n, NULL::BIGINT AS p_partkey, NULL::BIGINT AS t FROM (SELECT DISTINCT p_brand FROM part)
UNION ALL SELECT r.p_brand, r.k, CASE WHEN ok THEN f.used + r.t ELSE f.used END, CASE WHEN ok THEN f.n + 1 ELSE f.n END, CASE WHEN ok THEN r.p_partkey END, r.t FROM f JOIN r ON r.p_brand = f.p_brand AND r.k = f.k + 1, LATERAL (SELECT f.n < 6 AND f.used + r.t <= 90 AS ok))
SELECT p_brand, (n - 1)::BIGINT AS place, p_partkey, t AS p_size FROM f WHERE p_partkey IS NOT NULL""")
def budgeted_examples(spark, d):
    return signals.within_budget(read_table(spark, d, "part"), "p_brand", [F.col("p_retailprice").desc(), F.col("p_partkey")], "p_size", "p_partkey", 90, 6)


@query("""WITH b AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT p_type FROM part)), c AS (SELECT *, n // 7 AS base, n % 7 AS more FROM b)
SELECT p_type, (CASE WHEN i < more * (base + 1) THEN i // (base + 1) ELSE more + (i - more * (base + 1)) // greatest(base, 1) END)::BIGINT AS worker FROM c""")
def worker_shares(spark, d):
    return signals.worker_shares(read_table(spark, d, "part").select("p_type").distinct(), "p_type", 7)


@query("""SELECT l_orderkey, count(*) AS batches, round(arg_min(l_quantity, l_linenumber), 4) AS first_batch, CASE WHEN count(*) > 1 THEN round((sum(l_quantity) - arg_min(l_quantity, l_linenumber)) / (count(*) - 1), 4) END AS mean_followups, round(avg(l_quantity), 4) AS mean_all
FROM (SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY ALL) GROUP BY 1""")
def first_and_followups(spark, d):
    lines = read_table(spark, d, "lineitem").filter("l_quantity is not null").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"))
    return signals.first_and_followups(lines, "l_orderkey", ["l_linenumber"], "l_quantity")


@query("""SELECT user_id, event_type, count(*) AS rows, count(value) AS candidates, count_if(value > 45)::BIGINT AS kept, CASE WHEN count(value) = 0 THEN 'skip' WHEN count_if(value > 45) = 0 THEN 'retry' ELSE 'use' END AS action FROM events GROUP BY 1, 2""")
def retry_decision(spark, d):
    return signals.retry_decision(read_table(spark, d, "events"), ["user_id", "event_type"], F.col("value") > 45)


_NORM = "lower(regexp_replace(coalesce({0}, ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"


@query(f"""WITH a AS (SELECT p_partkey, [{_NORM.format('p_name')}, {_NORM.format('p_type')}, {_NORM.format('p_brand')}, {_NORM.format('p_name')}] AS ks FROM part),
b AS (SELECT p_partkey, unnest(ks) AS merge_key, generate_subscripts(ks, 1) AS i FROM a), c AS (SELECT p_partkey, merge_key, min(i) AS i FROM b WHERE merge_key <> '' GROUP BY 1, 2)
SELECT p_partkey, merge_key, (row_number() OVER (PARTITION BY p_partkey ORDER BY i) - 1)::BIGINT AS place FROM c""")
def merge_keys(spark, d):
    return signals.merge_keys(read_table(spark, d, "part"), "p_partkey", [F.col(c) for c in ("p_name", "p_type", "p_brand", "p_name")])


@query("""WITH r AS (SELECT l_returnflag, l_linestatus, l_partkey, count(*) FILTER (NOT l_discount > 0.05) AS kept FROM lineitem GROUP BY 1, 2, 3)
SELECT l_returnflag, l_linestatus, count(*) AS refs, count(*) FILTER (kept = 0) AS lost, round(avg((kept > 0)::INT), 4) AS covered FROM r GROUP BY 1, 2""")
def dropped_refs(spark, d):
    return signals.dropped_refs(read_table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_partkey", F.col("l_discount") > 0.05)


@query("""WITH d AS (SELECT l_orderkey AS o_orderkey, count(DISTINCT l_linenumber) AS done FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), r AS (SELECT o_orderkey, 1 + o_custkey % 4 AS expected, coalesce(done, 0) AS done FROM orders LEFT JOIN d USING (o_orderkey))
SELECT o_orderkey, expected, done, greatest(expected - done, 0)::BIGINT AS pending, round(least(done / expected, 1), 4)::DOUBLE AS ratio, CASE WHEN done = 0 THEN 'waiting' WHEN done < expected THEN 'running' ELSE 'completed' END AS status FROM r""")
def artifact_progress(spark, d):
    expected = read_table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 4 + 1).alias("expected"))
    found = read_table(spark, d, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("artifact"))
    return signals.progress(expected, found, "o_orderkey")


@query("""WITH s AS (SELECT source, round(avg((text IS NOT NULL AND text <> '')::INT), 4) AS valid, round(avg(coalesce(n_chars >= 400, false)::INT), 4) AS complete, round(avg(coalesce(contains(text, 'the') OR contains(text, 'que') OR contains(text, 'der'), false)::INT), 4) AS grounded FROM documents GROUP BY 1)
SELECT *, CASE WHEN least(valid, complete, grounded) >= 0.72 THEN 'pass' WHEN least(valid, complete, grounded) >= 0.55 THEN 'warn' ELSE 'fail' END AS verdict FROM s""")
def three_check_gate(spark, d):
    heard = F.contains("text", F.lit("the")) | F.contains("text", F.lit("que")) | F.contains("text", F.lit("der"))
    return signals.gate(read_table(spark, d, "documents"), "source", {"valid": F.col("text") != "", "complete": F.col("n_chars") >= 400, "grounded": heard})


@query("""WITH s(lang) AS (VALUES ('de'), ('en'), ('fr'), ('xx')), c AS (SELECT lang, count(*) AS rows, count(DISTINCT source) AS keys FROM documents GROUP BY 1)
SELECT lang, coalesce(rows, 0) AS rows, coalesce(keys, 0) AS keys, rows IS NOT NULL AS present FROM s LEFT JOIN c USING (lang)""")
def contract_counts(spark, d):
    return signals.contract_counts(read_table(spark, d, "documents"), "lang", "source", ("de", "en", "fr", "xx"))


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = (SELECT min(p_brand) FROM part)")
def gold_cases(spark, d):
    part = read_table(spark, d, "part")
    return signals.gold_cases(part, "p_brand", part.agg(F.min("p_brand")).first()[0]).select("p_partkey", "p_name", "p_brand")


@query("""WITH k AS (SELECT event_id, lower(regexp_replace(event_type, '[^\\p{L}\\p{N}]+', '', 'g')) AS k FROM events)
SELECT event_id, CASE k WHEN 'open' THEN 'open' WHEN 'view' THEN 'open' WHEN 'trade' THEN 'trade' WHEN 'purchase' THEN 'trade' WHEN 'fault' THEN 'fault' ELSE CASE WHEN contains(k, 'open') THEN 'open' WHEN contains(k, 'view') THEN 'open' WHEN contains(k, 'trade') THEN 'trade' WHEN contains(k, 'purchase') THEN 'trade' WHEN contains(k, 'fault') THEN 'fault' WHEN contains(k, 'err') THEN 'fault' END END AS kind FROM k""")
def canonical_enum(spark, d):
    return read_table(spark, d, "events").select("event_id", signals.canonical(F.col("event_type"), {"open": ("View",), "trade": ("pur-chase",), "fault": ("err",)}).alias("kind"))


def _folder(spark):
    return f"{shared_folder(spark)}/round-trip-{uuid.uuid4().hex}"


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def jsonl_round_trip(spark, d):
    """Written as JSON lines by the job's commit, with a null field kept, and read by schema."""
    rows, folder = read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), _folder(spark)
    files.write_tables({"nation": rows}, folder)
    return files.read_jsonl(spark, f"{folder}/nation", rows.schema)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def partition_overwrite(spark, d):
    """A second write replaces the table; a filter on the folder's column reads only its folders."""
    rows, folder = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), _folder(spark)
    for _ in range(2):
        files.write_table(rows, folder, by=["c_mktsegment"])
    return spark.read.parquet(folder).filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))


@query("SELECT r_regionkey, r_name FROM region")
def optional_tables(spark, d):
    """A table that is there and one that is not."""
    rows, folder = read_table(spark, d, "region").select("r_regionkey", "r_name"), _folder(spark)
    files.write_tables({"region": rows}, folder)
    return files.optional_table(spark, f"{folder}/region", rows.schema).unionByName(files.optional_table(spark, f"{folder}/missing", rows.schema))


@query("""SELECT doc_id, CASE WHEN length(t) <= 60 THEN t ELSE rtrim(substr(t, 1, 57), ' ') || '...' END AS short, substr(t, 1, 20) AS head, CASE WHEN length(t) > 20 THEN right(t, 20) ELSE '' END AS tail
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[^a-z ]', '', 'g') AS t FROM documents)""")
def text_anchors(spark, d):
    t = F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-z ]", "")
    return read_table(spark, d, "documents").select("doc_id", X.truncated(t, 60).alias("short"), X.anchors(t, 20).alias("a")).select("doc_id", "short", "a.*")
