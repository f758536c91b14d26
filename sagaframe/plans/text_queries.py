"""Queries over texts: cleaning, chunking, quality scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from sagaframe.functions import text as X
from sagaframe.operators import chunking, cleaning, quality_scan
from sagaframe.session import read_table

RULES = cleaning.NoiseRules(combinations=(("Licensed", "under"), ("rights", "reserved")), line_patterns=("^Released under",), fragments=(r"[*#%&$]{3}", r"!!"))


def clean_text_noise(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", cleaning.strip_noise(F.col("text"), RULES).alias("c")).select("doc_id", F.md5("c.text").alias("text_md5"), F.char_length("c.text").cast("long").alias("n"), "c.lines_removed", "c.fragments_removed")


_NOISE = "((contains(x, 'Licensed') AND contains(x, 'under')) OR (contains(x, 'rights') AND contains(x, 'reserved')) OR regexp_matches(x, '^Released under'))"
SQL_CLEAN = f"""
WITH a AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
b AS (SELECT doc_id, len(ls) AS n0, list_filter(ls, lambda x: NOT {_NOISE}) AS kept FROM a),
c AS (SELECT doc_id, n0 - len(kept) AS lines_removed, array_to_string(kept, chr(10)) AS j FROM b),
e AS (SELECT doc_id, lines_removed, len(regexp_extract_all(j, '[*#%&$]{{3}}')) + len(regexp_extract_all(j, '!!')) AS fragments_removed,
 regexp_replace(regexp_replace(regexp_replace(regexp_replace(j, '[*#%&$]{{3}}', '', 'g'), '!!', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS t FROM c)
SELECT doc_id, md5(t) AS text_md5, length(t)::BIGINT AS n, lines_removed::BIGINT AS lines_removed, fragments_removed::BIGINT AS fragments_removed FROM e"""


def stable_ids(spark, d):
    c = read_table(spark, d, "customer")
    n = X.normalize_name(F.col("c_name"))
    return c.select("c_custkey", n.alias("norm"), X.stable_id("entity", n).alias("id"), X.slugify(F.col("c_name")).alias("slug"), X.text_key(F.col("c_mktsegment")).alias("segment_key"))


SQL_IDS = """SELECT c_custkey, lower(regexp_replace(c_name, '[^\\p{L}\\p{N}]+', '', 'g')) AS norm,
'entity_' || substr(sha1(lower(regexp_replace(c_name, '[^\\p{L}\\p{N}]+', '', 'g'))), 1, 10) AS id,
regexp_replace(regexp_replace(lower(trim(c_name)), '[^\\p{L}\\p{N}]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, lower(replace(c_mktsegment, ' ', '')) AS segment_key FROM customer"""


def paragraphs(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(chunking.paragraphs(F.col("text"))).alias("pos", "p")).select("doc_id", F.col("pos").cast("long").alias("pos"), F.md5("p").alias("md5"), F.char_length("p").cast("long").alias("n"))


SQL_PARAGRAPHS = """WITH a AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ps FROM documents),
b AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM a)
SELECT doc_id, (i - 1)::BIGINT AS pos, md5(p) AS md5, length(p)::BIGINT AS n FROM b"""


def scene_pack(spark, d):
    s = chunking.scenes(read_table(spark, d, "documents"), "doc_id", "text", resplit=False)
    return s.select("doc_id", "scene_index", "scene_id", "n_units", "char_count", F.md5("text").alias("md5"))


SQL_SCENES = """WITH RECURSIVE a AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ps FROM documents),
p AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM a),
f AS (SELECT doc_id, i, p, length(p) AS len, 1 AS scene FROM p WHERE i = 1
 UNION ALL SELECT p.doc_id, p.i, p.p,
  CASE WHEN (f.len >= 500 AND f.len + length(p.p) > 900) OR f.len + length(p.p) > 1400 THEN length(p.p) ELSE f.len + length(p.p) END,
  CASE WHEN (f.len >= 500 AND f.len + length(p.p) > 900) OR f.len + length(p.p) > 1400 THEN f.scene + 1 ELSE f.scene END
 FROM f JOIN p ON p.doc_id = f.doc_id AND p.i = f.i + 1),
g AS (SELECT doc_id, scene, string_agg(p, chr(10) || chr(10) ORDER BY i) AS t, count(*) AS n FROM f GROUP BY doc_id, scene)
SELECT doc_id, scene::BIGINT AS scene_index, doc_id || '_scene_' || lpad(scene::VARCHAR, 3, '0') AS scene_id, n AS n_units, length(t)::BIGINT AS char_count, md5(t) AS md5 FROM g"""


def scene_split(spark, d):
    s = chunking.scenes(read_table(spark, d, "documents"), "doc_id", "text")
    return s.select("doc_id", "scene_index", "scene_id", "n_units", "char_count", F.md5("text").alias("md5"))


def _window(size, stride, tail):
    def run(spark, d):
        w = chunking.sliding_windows(read_table(spark, d, "conversations"), "conv_id", "turn", size, stride, tail)
        return w.select("conv_id", "start", "n", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))

    return run


_RANKED = "WITH r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS at, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations), s AS (SELECT DISTINCT conv_id, total, unnest(range(0, total, {stride})) AS start FROM r)"
SQL_5X3 = _RANKED.format(stride=3) + " SELECT s.conv_id, s.start, count(*) AS n, string_agg(r.turn::VARCHAR, ',' ORDER BY r.turn) AS members FROM s JOIN r ON r.conv_id = s.conv_id AND r.at >= s.start AND r.at < s.start + 5 GROUP BY s.conv_id, s.start HAVING count(*) = 5"
SQL_24X4 = _RANKED.format(stride=4) + " SELECT s.conv_id, s.start, count(*) AS n, string_agg(r.turn::VARCHAR, ',' ORDER BY r.turn) AS members FROM s JOIN r ON r.conv_id = s.conv_id AND r.at >= s.start AND r.at < s.start + 24 WHERE s.start = 0 OR s.start + 20 < s.total GROUP BY s.conv_id, s.start"


def anomaly_records(spark, d):
    return quality_scan.anomaly_records(read_table(spark, d, "documents"), "doc_id", "text")


SQL_ANOMALY = """WITH a AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> '') AS ls FROM documents),
b AS (SELECT doc_id, coalesce(ls[1], '') AS title, len(ls)::BIGINT AS n_lines, regexp_replace(array_to_string(ls[2:], chr(10)), '[ \\t\\n\\r]+', '', 'g') AS body FROM a)
SELECT doc_id, title, n_lines, length(body)::BIGINT AS body_length, n_lines = 0 AS is_empty, n_lines > 0 AND body = '' AS title_only, body <> '' AND length(body) < 120 AS is_short,
nullif(regexp_extract(title, '([0-9]+)', 1), '')::BIGINT AS title_number, CASE WHEN body = '' THEN '' ELSE md5(body) END AS body_hash FROM b"""


def anomaly_summary(spark, d):
    return quality_scan.anomaly_summary(anomaly_records(spark, d))


SQL_SUMMARY = f"""SELECT count(*) AS chapters, count_if(is_empty)::BIGINT AS empty_chapters, count_if(title_only)::BIGINT AS title_only_chapters, count_if(is_short)::BIGINT AS short_chapters, count_if(title_number IS NOT NULL)::BIGINT AS numbered_chapters,
coalesce(sum(body_length), 0)::BIGINT AS total_length, coalesce(max(body_length), 0) AS longest, count(DISTINCT CASE WHEN body_hash <> '' THEN body_hash END) AS distinct_bodies FROM ({SQL_ANOMALY})"""


def duplicate_bodies(spark, d):
    return quality_scan.duplicate_groups(anomaly_records(spark, d), "body_hash", "doc_id")


def duplicate_titles(spark, d):
    return quality_scan.duplicate_groups(anomaly_records(spark, d), "title", "doc_id")


_DUP = "SELECT {k}, count(*) AS members, min(doc_id) AS first_member, max(doc_id) AS last_member FROM ({a}) WHERE {k} <> '' GROUP BY {k} HAVING count(*) > 1"


def sequence_check(spark, d):
    orders = read_table(spark, d, "orders").select("o_custkey", "o_orderkey", F.month("o_orderdate").cast("long").alias("number"))
    return quality_scan.sequence_check(orders, "o_custkey", "o_orderkey", "number")


SQL_SEQUENCE = """WITH a AS (SELECT o_custkey, o_orderkey, lag(month(o_orderdate)::BIGINT) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous, month(o_orderdate)::BIGINT AS current FROM orders),
b AS (SELECT *, CASE WHEN current = previous THEN 'duplicate' WHEN current < previous THEN 'regression' WHEN current > previous + 1 THEN 'gap' END AS kind FROM a WHERE previous IS NOT NULL)
SELECT o_custkey, o_orderkey, previous, current, kind, CASE WHEN kind = 'gap' THEN previous + 1 END AS missing_from, CASE WHEN kind = 'gap' THEN current - 1 END AS missing_to FROM b WHERE kind IS NOT NULL"""


def token_scan_topk(spark, d):
    return quality_scan.token_scan(read_table(spark, d, "documents"), "doc_id", "text", "[A-Z]{2,}", 20)


SQL_TOKENS = """WITH t AS (SELECT doc_id AS id, unnest(regexp_extract_all(text, '[A-Z]{2,}')) AS token FROM documents), p AS (SELECT token, id, count(*) AS n FROM t GROUP BY ALL),
top AS (SELECT token, sum(n)::BIGINT AS n, count(*) AS texts FROM p GROUP BY token ORDER BY n DESC, token LIMIT 20),
r AS (SELECT token, id, row_number() OVER (PARTITION BY token ORDER BY id) AS r FROM p)
SELECT top.token, top.n, top.texts, (SELECT string_agg(r.id::VARCHAR, ',' ORDER BY r.id) FROM r WHERE r.token = top.token AND r.r <= 5) AS samples FROM top"""

QUERIES = {
    "clean_text_noise": clean_text_noise, "stable_ids": stable_ids, "paragraphs": paragraphs, "scene_pack": scene_pack, "scene_split": scene_split,
    "window_5x3": _window(5, 3, False), "window_24x4": _window(24, 4, True), "anomaly_records": anomaly_records, "anomaly_summary": anomaly_summary,
    "duplicate_bodies": duplicate_bodies, "duplicate_titles": duplicate_titles, "sequence_check": sequence_check, "token_scan_topk": token_scan_topk,
}
ORACLE_SQL = {
    "clean_text_noise": SQL_CLEAN, "stable_ids": SQL_IDS, "paragraphs": SQL_PARAGRAPHS, "scene_pack": SQL_SCENES, "window_5x3": SQL_5X3, "window_24x4": SQL_24X4,
    "anomaly_records": SQL_ANOMALY, "anomaly_summary": SQL_SUMMARY, "duplicate_bodies": _DUP.format(k="body_hash", a=SQL_ANOMALY), "duplicate_titles": _DUP.format(k="title", a=SQL_ANOMALY),
    "sequence_check": SQL_SEQUENCE, "token_scan_topk": SQL_TOKENS,
}
