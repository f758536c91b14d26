"""Story segments: profiles of chapters and windows, boundaries where the dominant layer or place changes, segments between them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.session import prepare


def layer_profiles(evidence: DataFrame, chapter: list[str], layer: str, weight: str) -> DataFrame:
    """The two strongest layers of a chapter by summed weight (ties by name)."""
    sums = evidence.groupBy(*chapter, layer).agg(F.round(F.sum(weight), 4).alias("score"))
    w = Window.partitionBy(*chapter).orderBy(F.col("score").desc(), layer)
    top = sums.withColumn("r", F.row_number().over(w)).filter("r <= 2")
    return top.groupBy(*chapter).agg(F.max(F.when(F.col("r") == 1, F.col(layer))).alias("primary_layer"), F.max(F.when(F.col("r") == 1, F.col("score"))).alias("primary_score"), F.max(F.when(F.col("r") == 2, F.col(layer))).alias("secondary_layer"))


def window_profiles(evidence: DataFrame, group: str, chapter: str, layer: str, weight: str, size: int, stride: int, least: float) -> DataFrame:
    """Per window of chapter numbers (from 0): the dominant layer, if its weight reaches `least`."""
    first = F.greatest(F.lit(0), F.ceil((F.col(chapter) - (size - 1)) / stride)).cast("long")
    member = evidence.withColumn("k", F.explode(F.sequence(first, F.floor(F.col(chapter) / stride), F.lit(1).cast("long"))))
    sums = member.groupBy(group, (F.col("k") * stride).alias("start"), layer).agg(F.round(F.sum(weight), 4).alias("score"))
    rank = F.row_number().over(Window.partitionBy(group, "start").orderBy(F.col("score").desc(), layer))
    top = sums.withColumn("r", rank).filter("r = 1")
    return top.select(group, "start", F.when(F.col("score") >= least, F.col(layer)).alias("dominant"), "score")


def layer_boundaries(windows: DataFrame, group: str, spacing: int) -> DataFrame:
    """Starts of windows whose dominant layer differs from that of the last accepted boundary, lasts for two windows, and keep the spacing.

    Acceptance depends on the boundaries accepted before, so each group's windows (one row per stride) are folded in order.
    """
    prepare(windows.sparkSession)
    ahead = windows.withColumn("next", F.lead("dominant").over(Window.partitionBy(group).orderBy("start")))
    kind = dict(windows.dtypes)[group]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start")
        layer, last, out = None, None, []
        for start, dominant, after in zip(pdf["start"], pdf["dominant"], pdf["next"], strict=True):
            if not isinstance(dominant, str):
                continue
            if layer is None:
                layer = dominant
            elif dominant != layer and dominant == after and (last is None or start - last >= spacing):
                out.append((pdf[group].iloc[0], int(start), layer, dominant))
                layer, last = dominant, start
        return pd.DataFrame(out, columns=[group, "start", "from_layer", "to_layer"])

    return ahead.groupBy(group).applyInPandas(fold, f"{group} {kind}, start long, from_layer string, to_layer string")


def place_boundaries(windows: DataFrame, group: str, order: str, places: str) -> DataFrame:
    """Windows that introduce places which also stand in the next window."""
    w = Window.partitionBy(group).orderBy(order)
    new = F.array_except(F.col(places), F.coalesce(F.lag(places).over(w), F.array().cast("array<string>")))
    lasting = F.array_intersect(new, F.coalesce(F.lead(places).over(w), F.array().cast("array<string>")))
    return windows.withColumn("lasting", lasting).withColumn("opening", F.lag(places).over(w).isNull()).filter("size(lasting) > 0 and not opening").drop("opening")


def segments(chapters: DataFrame, boundaries: DataFrame, group: str, chapter: str) -> DataFrame:
    """Range join of chapters with the stretches between boundaries: segment number of each chapter, by a running count instead of pairs."""
    marks = boundaries.select(group, F.col("start").alias(chapter), F.lit(1).alias("mark"))
    rows = chapters.select(group, chapter, F.lit(0).alias("mark")).unionByName(marks)
    w = Window.partitionBy(group).orderBy(F.col(chapter), F.col("mark").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("segment", F.sum("mark").over(w)).filter("mark = 0").drop("mark")


def segment_spans(placed: DataFrame, group: str, chapter: str) -> DataFrame:
    return placed.groupBy(group, "segment").agg(F.min(chapter).alias("first_chapter"), F.max(chapter).alias("last_chapter"), F.count(F.lit(1)).alias("chapters"))
