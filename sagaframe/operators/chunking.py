"""Paragraphs, scenes and sliding windows.

Scenes are folded within a row, so a text of any table is cut where it stands. Windows give each row to the few windows it is in
and group by window: no group of all rows is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.functions.text import clean_text


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines; where there is at most one, the lines."""
    split = lambda p: F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), p), clean_text), lambda x: x != "")
    blocks = split(r"\n{2,}")
    return F.when(F.size(blocks) > 1, blocks).otherwise(split(r"\n"))


_SENTENCE = r"[^.!?。！？]*[.!?。！？]+[\"'”’」』]*|[^.!?。！？]+$"


def _hard(text: Column, most: int) -> Column:
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1)), F.lit(most)), lambda i: clean_text(F.substring(text, i, F.lit(most))))
    return F.filter(parts, lambda x: x != "")


def split_oversized(paragraph: Column, most: int, sentence: str = _SENTENCE) -> Column:
    """A paragraph over `most` characters in sentences packed greedily; a sentence over it in slices."""
    sentences = F.filter(F.transform(F.regexp_extract_all(paragraph, F.lit(sentence), F.lit(0)), clean_text), lambda x: x != "")
    none = F.array().cast("array<string>")
    flushed = lambda acc: F.when(acc["now"] != "", F.concat(acc["out"], F.array(acc["now"]))).otherwise(acc["out"])

    def step(acc: Column, s: Column) -> Column:
        fits = F.char_length(acc["now"]) + F.char_length(s) <= most
        return (
            F.when(F.char_length(s) > most, F.struct(F.concat(flushed(acc), _hard(s, most)).alias("out"), F.lit("").alias("now")))
            .when(fits, F.struct(acc["out"].alias("out"), F.concat(acc["now"], s).alias("now")))
            .otherwise(F.struct(flushed(acc).alias("out"), s.alias("now")))
        )

    packed = F.aggregate(sentences, F.struct(none.alias("out"), F.lit("").alias("now")), step, flushed)
    return F.when(F.char_length(paragraph) <= most, F.array(paragraph)).when(F.size(sentences) <= 1, _hard(paragraph, most)).otherwise(packed)


def pack(units: Column, least: int = 500, target: int = 900, most: int = 1400) -> Column:
    """Greedy scenes: array of arrays of units. A scene ends before a unit that would lift it over the target (once it has `least`) or over `most`."""
    none = F.array().cast("array<array<string>>")
    empty = F.array().cast("array<string>")

    def step(acc: Column, p: Column) -> Column:
        ahead = acc["len"] + F.char_length(p)
        flush = (F.size(acc["now"]) > 0) & (((acc["len"] >= least) & (ahead > target)) | (ahead > most))
        return F.struct(
            F.when(flush, F.concat(acc["out"], F.array(acc["now"]))).otherwise(acc["out"]).alias("out"),
            F.when(flush, F.array(p)).otherwise(F.concat(acc["now"], F.array(p))).alias("now"),
            F.when(flush, F.char_length(p)).otherwise(ahead).alias("len"),
        )

    last = lambda acc: F.when(F.size(acc["now"]) > 0, F.concat(acc["out"], F.array(acc["now"]))).otherwise(acc["out"])
    return F.aggregate(units, F.struct(none.alias("out"), empty.alias("now"), F.lit(0).alias("len")), step, last)


def scenes(chapters: DataFrame, id_col: str, text_col: str, least: int = 500, target: int = 900, most: int = 1400, resplit: bool = True) -> DataFrame:
    """A row per scene: chapter, scene_index from 1, scene_id, text, char_count."""
    units = paragraphs(F.col(text_col))
    if resplit:
        units = F.flatten(F.transform(units, lambda p: split_oversized(p, most)))
    cut = chapters.select(F.col(id_col), F.posexplode(pack(units, least, target, most)).alias("pos", "units"))
    text = clean_text(F.array_join("units", "\n\n"))
    return cut.select(
        F.col(id_col), (F.col("pos") + 1).cast("long").alias("scene_index"),
        F.concat(F.col(id_col).cast("string"), F.lit("_scene_"), F.lpad((F.col("pos") + 1).cast("string"), 3, "0")).alias("scene_id"),
        F.size("units").cast("long").alias("n_units"), text.alias("text"), F.char_length(text).cast("long").alias("char_count"),
    )


def sliding_windows(df: DataFrame, group: str, order: str, size: int, stride: int, keep_tail: bool) -> DataFrame:
    """group, start, n, members (ordered). Without the tail only full windows stay; with it the first window that reaches the end is the last."""
    by = Window.partitionBy(group)
    ranked = df.select(group, order).withColumn("at", (F.row_number().over(by.orderBy(order)) - 1).cast("long")).withColumn("total", F.count(F.lit(1)).over(by))
    first = F.greatest(F.lit(0), F.ceil((F.col("at") - (size - 1)) / stride)).cast("long")
    member = ranked.select(group, order, "at", "total", F.explode(F.sequence(first, F.floor(F.col("at") / stride), F.lit(1).cast("long"))).alias("k")).withColumn("start", F.col("k") * stride)
    # With the tail, a later window starts only if the one before it did not reach the end yet.
    wanted = (F.col("start") == 0) | (F.col("start") + size - stride < F.col("total")) if keep_tail else F.col("start") + size <= F.col("total")
    grouped = member.filter(wanted).groupBy(group, "start").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.col(order).cast("long"))).alias("members"))
    return grouped


def offset_limit(df: DataFrame, order: list[str], start: int = 0, limit: int | None = None) -> DataFrame:
    out = df.orderBy(*order).offset(start)
    return out if limit is None else out.limit(limit)
