"""Anomaly records of chapters, their summary, duplicate groups, sequence checks and token scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHORT = 120


def anomaly_records(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per chapter: title (first non-empty line), body without white space, flags, number in the title, hash of the body."""
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: F.trim(x) != "")
    base = df.select(F.col(id_col), F.coalesce(F.get(lines, F.lit(0)), F.lit("")).alias("title"), F.regexp_replace(F.array_join(F.slice(lines, 2, 1 << 30), "\n"), r"[ \t\n\r]+", "").alias("body"), F.size(lines).cast("long").alias("n_lines"))
    number = F.regexp_extract("title", r"([0-9]+)", 1)
    return base.select(
        id_col, "title", "n_lines",
        F.char_length("body").cast("long").alias("body_length"),
        (F.col("n_lines") == 0).alias("is_empty"),
        ((F.col("n_lines") > 0) & (F.col("body") == "")).alias("title_only"),
        ((F.col("body") != "") & (F.char_length("body") < SHORT)).alias("is_short"),
        F.nullif(number, F.lit("")).cast("long").alias("title_number"),
        F.when(F.col("body") == "", "").otherwise(F.md5("body")).alias("body_hash"),
    )


def anomaly_summary(records: DataFrame) -> DataFrame:
    """One row of counters."""
    return records.agg(
        F.count(F.lit(1)).alias("chapters"), F.count_if("is_empty").alias("empty_chapters"), F.count_if("title_only").alias("title_only_chapters"),
        F.count_if("is_short").alias("short_chapters"), F.count_if(F.col("title_number").isNotNull()).alias("numbered_chapters"),
        F.coalesce(F.sum("body_length"), F.lit(0)).cast("long").alias("total_length"), F.coalesce(F.max("body_length"), F.lit(0)).cast("long").alias("longest"),
        F.count_distinct(F.when(F.col("body_hash") != "", F.col("body_hash"))).alias("distinct_bodies"),
    )


def duplicate_groups(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """Groups of more than one member, with the smallest member and their number. Empty keys make no group."""
    return df.filter(F.col(key) != "").groupBy(key).agg(F.count(F.lit(1)).alias("members"), F.min(id_col).alias("first_member"), F.max(id_col).alias("last_member")).filter("members > 1")


def sequence_check(df: DataFrame, group: str, order: str, number: str) -> DataFrame:
    """Neighbours whose numbers repeat, fall back or leave a gap, with the missing range."""
    w = Window.partitionBy(group).orderBy(order)
    pairs = df.filter(F.col(number).isNotNull()).select(group, order, F.lag(number).over(w).alias("previous"), F.col(number).alias("current")).filter("previous is not null")
    kind = F.when(F.col("current") == F.col("previous"), "duplicate").when(F.col("current") < F.col("previous"), "regression").when(F.col("current") > F.col("previous") + 1, "gap")
    gap = F.col("kind") == "gap"
    return pairs.withColumn("kind", kind).filter("kind is not null").select(group, order, "previous", "current", "kind", F.when(gap, F.col("previous") + 1).alias("missing_from"), F.when(gap, F.col("current") - 1).alias("missing_to"))


def token_scan(df: DataFrame, id_col: str, text_col: str, pattern: str, k: int, samples: int = 5) -> DataFrame:
    """The k most frequent matches with their number of texts and the first texts that hold them."""
    tokens = df.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))).alias("token"))
    per_text = tokens.groupBy("token", "id").agg(F.count(F.lit(1)).alias("n"))
    top = per_text.groupBy("token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).orderBy(F.col("n").desc(), "token").limit(k)
    rank = F.row_number().over(Window.partitionBy("token").orderBy("id"))
    first = per_text.join(F.broadcast(top.select("token")), "token").withColumn("r", rank).filter(F.col("r") <= samples).groupBy("token").agg(F.array_join(F.sort_array(F.collect_list("id")), ",").alias("samples"))
    return top.join(first, "token")
