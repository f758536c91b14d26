"""The queries of this subpackage: each operator over its whole table, with the columns that its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sagaframe.llm import bpe, language_model, license_scan, line_dedup, main_text, mixing, neighbours, quality, simhash, token_counts
from sagaframe.session import read_table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    field = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.judge(docs, field).withColumnRenamed("id", "doc_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    model = language_model.train(docs.filter(~held_out))
    scored = language_model.score(docs, model, held_out)
    return scored.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), kind="digests").withColumnRenamed("id", "doc_id")


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    named = F.filter("blocks", lambda b: b["named"])
    joined = lambda *xs: F.array_join(F.array_sort(F.array_distinct(F.concat(*xs))), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        joined("places.label").alias("base_labels"), joined("places.label", named["label"]).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(named["containment"]), F.lit(0.0))).alias("score"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.without_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["lines"])
    return kept.select("doc_id", F.transform("removed", lambda x: F.concat_ws("+", x["line"], x["lines"])).alias("removed"), gone.alias("n_removed_lines"), F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.copies(read_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "rate", "copies")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(read_table(spark, sf_dir, "pages")).select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.histogram(read_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_lm": op3_lm,
    "op4_bpe": op4_bpe,
    "op5_license": op5_license,
    "op6_line_dedup": op6_line_dedup,
    "op7_neighbours": op7_neighbours,
    "op8_mixing": op8_mixing,
    "op9_main_text": op9_main_text,
    "op10_token_counts": op10_token_counts,
}

ORACLE_SQL: dict[str, str] = {}
