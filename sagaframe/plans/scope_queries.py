"""Queries over scopes of judged cases, reasoning for rules and slots, places, samples and finished batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from sagaframe.operators import scoping
from sagaframe.session import read_table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@query("""WITH r AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), e AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), z AS (SELECT l_suppkey, count(*) AS size FROM e GROUP BY 1),
o AS (SELECT l_orderkey, l_suppkey, count(*) AS overlap FROM r JOIN e USING (l_partkey) GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY overlap DESC, size DESC, l_suppkey) AS r FROM o JOIN z USING (l_suppkey))
SELECT l_orderkey, l_suppkey AS reasoning, overlap FROM k WHERE r = 1""")
def inferred_reasoning(spark, d):
    lines = read_table(spark, d, "lineitem")
    return scoping.infer_reasoning(lines, lines, "l_orderkey", "l_suppkey", "l_partkey")


_ALLOWED = {"voice": ("Brand#1", "Brand#2"), "pacing": ("Brand#3",), "nowhere": ("Brand#none",), "any": ()}


@query("""WITH p AS (SELECT unnest(['voice', 'voice', 'pacing', 'nowhere']) AS path, unnest(['Brand#1', 'Brand#2', 'Brand#3', 'Brand#none']) AS p_brand), w AS (SELECT unnest(['voice', 'pacing', 'nowhere', 'any']) AS path),
n AS (SELECT path, bool_or(p_brand IN (SELECT p_brand FROM part)) AS narrow FROM p GROUP BY 1), b AS (SELECT DISTINCT p_name AS ref FROM part WHERE p_size < 3 UNION SELECT DISTINCT p_type FROM part WHERE p_size < 2),
f AS (SELECT p_partkey, p_brand FROM part WHERE p_size <> 7 AND NOT (p_name IN (SELECT ref FROM b) AND p_type IN (SELECT ref FROM b)))
SELECT w.path, p_partkey AS entry_id, f.p_brand AS bucket_id FROM w LEFT JOIN n USING (path) CROSS JOIN f WHERE NOT coalesce(narrow, false) OR EXISTS (SELECT 1 FROM p WHERE p.path = w.path AND p.p_brand = f.p_brand)""")
def retrieval_pool(spark, d):
    part = read_table(spark, d, "part")
    entries = part.select(F.col("p_partkey").alias("entry_id"), F.col("p_brand").alias("bucket_id"), F.array("p_name", "p_type").alias("refs"))
    names, types = (part.filter(x).select(F.col(c).alias("ref")) for c, x in (("p_name", "p_size < 3"), ("p_type", "p_size < 2")))
    return scoping.retrieval_pool(entries, _ALLOWED, part.filter("p_size = 7").select(F.col("p_partkey").alias("entry_id")), names.unionByName(types))


@query("""WITH c AS (SELECT c_custkey AS case_id, CASE WHEN c_custkey % 3 = 0 THEN [] ELSE ['Brand#' || (c_custkey % 40)] END AS buckets, CASE WHEN c_custkey % 2 = 0 THEN [] ELSE ['size' || (c_custkey % 60)] END AS batches, CASE WHEN c_custkey % 5 = 0 THEN [] ELSE ['ref' || (c_custkey % 30)] END AS expected FROM customer),
r AS (SELECT p_brand AS bucket_id, 'size' || p_size AS batch, 'ref' || (p_partkey % 25) AS ref, p_size % 4 <> 0 AS live FROM part),
m AS (SELECT case_id, live, len(expected) > 0 AND expected[1] = ref AS hit FROM c JOIN r ON bucket_id = buckets[1] WHERE len(batches) = 0 OR batches[1] = batch UNION ALL SELECT case_id, live, len(expected) > 0 AND expected[1] = ref FROM c JOIN r ON batch = batches[1] WHERE len(buckets) = 0),
g AS (SELECT case_id, bool_or(live) AS live, bool_or(live AND hit)::BIGINT AS hits FROM m GROUP BY 1),
s AS (SELECT c.*, g.live, CASE WHEN len(buckets) + len(batches) = 0 THEN (len(expected) > 0 AND expected[1] IN (SELECT ref FROM r WHERE live))::BIGINT ELSE coalesce(hits, 0) END AS expected_refs FROM c LEFT JOIN g USING (case_id)),
q AS (SELECT case_id, expected_refs, CASE WHEN len(buckets) + len(batches) > 0 AND live IS NULL THEN 'target_scope_missing_from_run' WHEN len(buckets) + len(batches) > 0 AND NOT live THEN CASE WHEN buckets[1] IN ('Brand#1', 'Brand#4') THEN 'target_scope_skipped_sparse' WHEN buckets[1] = 'Brand#2' THEN 'target_scope_failed' ELSE 'target_scope_has_no_successful_local_reduce' END
WHEN len(expected) > 0 AND expected_refs = 0 THEN 'expected_refs_out_of_scope' ELSE 'applicable' END AS reason FROM s) SELECT *, reason = 'applicable' AS applicable FROM q""")
def case_scopes(spark, d):
    none = F.array().cast("array<string>")
    named = lambda most, prefix, over: F.when(F.col("c_custkey") % over == 0, none).otherwise(F.array(F.concat(F.lit(prefix), (F.col("c_custkey") % most).cast("string"))))
    cases = read_table(spark, d, "customer").select(F.col("c_custkey").alias("case_id"), named(40, "Brand#", 3).alias("buckets"), named(60, "size", 2).alias("batches"), named(30, "ref", 5).alias("expected"))
    one = lambda prefix, x: F.array(F.concat(F.lit(prefix), x.cast("string")))
    reduces = read_table(spark, d, "part").select(F.col("p_brand").alias("bucket_id"), one("size", F.col("p_size")).alias("batch_ids"), one("ref", F.col("p_partkey") % 25).alias("refs"), (F.col("p_size") % 4 == 0).alias("sparse"))
    return scoping.case_scopes(cases, reduces, ["Brand#2"], ["Brand#1", "Brand#4"])


@query("""WITH n AS (SELECT user_id AS conv_id, event_type AS place FROM events UNION ALL SELECT conv_id, unnest(regexp_extract_all(text, '([a-z]{3,6}(?:tion|ing))', 1)) FROM conversations), c AS (SELECT conv_id, place, count(*) AS n FROM n WHERE place NOT IN ('view', 'thing') GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, place)::INTEGER AS rank FROM c) WHERE rank <= 5""")
def place_counts(spark, d):
    named = read_table(spark, d, "events").select(F.col("user_id").alias("conv_id"), F.col("event_type").alias("place"))
    return scoping.place_counts(named, read_table(spark, d, "conversations"), "conv_id", "place", "text", "([a-z]{3,6}(?:tion|ing))", ("view", "thing"))


def _first(text, table, order, most, joiner):
    return f"(SELECT string_agg(t, '{joiner}' ORDER BY o, t) FROM (SELECT {text} AS t, min({order}) AS o FROM {table} GROUP BY 1 ORDER BY o, t LIMIT {most}))"


@query(f"""SELECT min(l_suppkey) AS first_chapter, max(l_suppkey) AS last_chapter, count(DISTINCT l_suppkey) AS chapters, 'chapters ' || min(l_suppkey) || '-' || max(l_suppkey) || ' | plot spine: ' || {_first('o_orderpriority', 'orders', 'o_orderkey', 4, ' ; ')}
|| ' | key entities: ' || {_first('p_name', 'part', 'p_partkey', 8, ', ')} || ' | relationship pressure: ' || {_first('c_mktsegment', 'customer', 'c_custkey', 6, ' ; ')} || ' | system rules: ' || {_first('p_type', 'part', 'p_partkey', 6, ' ; ')} || ' | open questions: ' || {_first('lang', 'documents', 'doc_id', 6, ' ; ')} AS summary FROM lineitem""")
def scope_community(spark, d):
    part = lambda table, order, text: read_table(spark, d, table).select(F.col(order).alias("ord"), F.col(text).alias("text"))
    sections = {
        "plot spine": (part("orders", "o_orderkey", "o_orderpriority"), 4, " ; "), "key entities": (part("part", "p_partkey", "p_name"), 8, ", "), "relationship pressure": (part("customer", "c_custkey", "c_mktsegment"), 6, " ; "),
        "system rules": (part("part", "p_partkey", "p_type"), 6, " ; "), "open questions": (part("documents", "doc_id", "lang"), 6, " ; "),
    }
    return scoping.scope_community(read_table(spark, d, "lineitem"), "l_suppkey", sections)


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 9 END, o_custkey, o_orderkey LIMIT 60")
def sampled_plots(spark, d):
    return scoping.sampled_plots(read_table(spark, d, "orders"), "o_orderstatus", ["o_custkey", "o_orderkey"], 60, ("f", "o")).select("o_orderkey", "o_orderstatus")


@query("""WITH o AS (SELECT *, CASE p_type WHEN 'PROMO' THEN 0 WHEN 'ECONOMY' THEN 1 ELSE 9 END AS k FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY k, p_size DESC, p_partkey) > 20 AS over FROM o)
SELECT p_partkey, p_type, p_size FROM r ORDER BY over, k, p_size DESC, p_partkey LIMIT 40""")
def sampled_entities(spark, d):
    return scoping.sampled_entities(read_table(spark, d, "part"), "p_type", "p_size", ["p_partkey"], 40, ("promo", "economy")).select("p_partkey", "p_type", "p_size")


@query("""WITH i AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_discount, l_returnflag, l_partkey FROM lineitem), a AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_suppkey) AS s, count(DISTINCT l_returnflag) AS x, count(DISTINCT l_partkey) AS e, avg(l_discount) AS m,
string_agg(l_linenumber, ',' ORDER BY l_discount DESC, l_suppkey, l_linenumber) AS items FROM i GROUP BY 1), c AS (SELECT l_orderkey, string_agg(l_suppkey, ',' ORDER BY l_suppkey) AS chapters FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM i) GROUP BY 1)
SELECT l_orderkey, items, chapters, round(least((x + e) / (n + 2), 1), 4)::DOUBLE AS novelty, round((n - s) / n, 4) AS redundancy, round(greatest(m - 0.2 * round((n - s) / n, 4), 0) + 1e-9, 4)::DOUBLE AS score FROM a JOIN c USING (l_orderkey)""")
def finished_batches(spark, d):
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_discount", "l_returnflag", "l_partkey").distinct()
    return scoping.finished_batches(lines.withColumn("parts", F.array("l_partkey")), ["l_orderkey"], "l_linenumber", "l_suppkey", "l_discount", "l_returnflag", "parts", 2)
