"""Canonical tables: entity resolution, chapter summaries, plot nodes, style index. All are groupings with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sagaframe.functions.text import natural_key, normalize_name, ordered_unique, stable_id


def in_scope(chapter: Column, first: int, last: int) -> Column:
    """A numbered chapter within a range."""
    number = natural_key(chapter)[1]
    return number.between(first, last)


def windows_in_scope(chapters: Column, first: int, last: int) -> Column:
    """All of a window's chapters within a range."""
    return F.forall(chapters, lambda c: F.coalesce(in_scope(c, first, last), F.lit(False)))


def first_in_order(value: Column | str, order: Column | str) -> Column:
    """The value of the row that comes first; `order` must be total."""
    return F.min_by(value, order)


def resolve_entities(mentions: DataFrame, kind: str, name: str, order: str, scene: str, prefix: str = "entity") -> DataFrame:
    """One entity for each kind and normalized name.

    The first mention gives the name, the id and where it was first seen; all surface names are sorted aliases; scenes stand in the
    order of their first mention. Names without letters or digits fall together within a kind.
    """
    rows = mentions.select(F.col(kind).alias("entity_type"), normalize_name(F.col(name)).alias("norm"), F.col(name).alias("name"), F.col(order).alias("ord"), F.col(scene).cast("string").alias("scene"))
    # Two steps: an entity mentioned in a third of all scenes gathers its distinct scenes and names, not its mentions.
    scenes = rows.groupBy("entity_type", "norm", "name", "scene").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n"))
    # One name may stand in many scenes: the first place of each scene is that over all names.
    return scenes.groupBy("entity_type", "norm").agg(
        first_in_order("name", "ord").alias("name"), F.min("ord").alias("first_seen"), F.sum("n").alias("mentions"),
        F.array_sort(F.collect_set("name")).alias("aliases"), F.count_distinct("scene").alias("n_scenes"),
    ).withColumn("entity_id", stable_id(prefix, F.concat(F.col("entity_type"), F.lit(":"), F.col("name"))))


def scenes_of(mentions: DataFrame, keys: list[str], scene: str, order: str, limit: int | None = None) -> DataFrame:
    """Scenes of each key in the order of their first mention."""
    first = mentions.groupBy(*keys, scene).agg(F.min(order).alias("ord"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("ord", scene))), lambda x: x[scene].cast("string"))
    return first.groupBy(*keys).agg(ordered_unique(listed, limit).alias("scenes"))


def chapter_summaries(scenes: DataFrame, chapter: str, order: str, summary: Column, question: Column) -> DataFrame:
    """Scenes of a chapter in order, their summaries joined, and the questions that they leave open."""
    rows = scenes.select(F.col(chapter), F.struct(F.col(order).alias("o"), summary.alias("s"), question.alias("q")).alias("x"))
    grouped = rows.groupBy(chapter).agg(F.count(F.lit(1)).alias("scene_count"), F.sort_array(F.collect_list("x")).alias("xs"))
    return grouped.select(chapter, "scene_count", F.transform("xs", lambda x: x["s"]).alias("summaries"), F.filter(F.transform("xs", lambda x: x["q"]), lambda q: q.isNotNull()).alias("questions"))


def relevance(events: Column, participants: Column, questions: Column) -> Column:
    """high, medium or low by points: two or more events 2, one 1; two or more participants 1; two or more questions 2, one 1."""
    at_most_two = lambda c: F.least(c, F.lit(2))
    points = at_most_two(events) + F.when(participants >= 2, 1).otherwise(0) + at_most_two(questions)
    return F.when(points >= 4, "high").when(points >= 2, "medium").otherwise("low")


def plot_nodes(chapters: DataFrame, events: DataFrame, chapter: str) -> DataFrame:
    """Chapter summaries with their events: names, participants and places as sorted sets. Chapters without events stay."""
    per = events.groupBy(chapter).agg(F.count(F.lit(1)).alias("n_events"), F.array_sort(F.collect_set("participant")).alias("participants"), F.array_sort(F.collect_set("place")).alias("places"))
    none = F.array().cast("array<string>")
    joined = chapters.join(per, chapter, "left").withColumns({"n_events": F.coalesce("n_events", F.lit(0)), "participants": F.coalesce("participants", none), "places": F.coalesce("places", none)})
    return joined.withColumn("relevance", relevance(F.col("n_events"), F.size("participants"), F.size("questions"))).withColumn("node_id", stable_id("plot", F.col(chapter).cast("string")))


def counters(df: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """kind, key, n for several keys of each row, in one pass."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in kinds.items()])
    return df.select(F.explode(pairs).alias("p")).filter(F.col("p.key").isNotNull()).groupBy("p.kind", "p.key").agg(F.count(F.lit(1)).alias("n")).select("kind", "key", "n")


class EmptyScope(ValueError):
    """A scope filter has left no row."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyScope(f"no {what} in scope")
    return df
