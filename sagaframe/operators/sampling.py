"""Deterministic sampling: evenly spaced rows, capped groups with refill, top items, scope joins. No random sampling anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.session import cut


def even_places(n: int, limit: int) -> list[int]:
    """Places 0.. of `limit` evenly spaced rows of n; halves round to even, and a place that was taken moves on by one."""
    if limit <= 0 or limit >= n:
        return list(range(n))
    if limit == 1:
        return [0]
    out: list[int] = []
    for i in range(limit):
        at = round(i * (n - 1) / (limit - 1))
        out.append(at if not out or at > out[-1] else out[-1] + 1)
    return out


def even_sample(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    """Rows at evenly spaced places of the whole order, numbered by blocks of a range partitioning instead of in one task."""
    n = df.count()
    if limit <= 0 or limit >= n:
        return df
    spark = df.sparkSession
    # Kept, for a range partitioning that is computed twice is not cut alike.
    parts = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = {r["_p"]: r["count"] for r in parts.groupBy("_p").count().collect()}  # one row a partition
    starts, at = {}, 0
    for p in sorted(sizes):
        starts[p] = at
        at += sizes[p]
    offsets = spark.createDataFrame(sorted(starts.items()), "_p int, _start long")
    wanted = spark.createDataFrame([(i,) for i in even_places(n, limit)], "_at long")
    local = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    placed = parts.withColumn("_i", local).join(F.broadcast(offsets), "_p").withColumn("_at", F.col("_start") + F.col("_i"))
    return placed.join(F.broadcast(wanted), "_at", "left_semi").drop("_p", "_i", "_start", "_at")


def capped_groups(df: DataFrame, group: str, order: list[Column], cap: int, limit: int) -> DataFrame:
    """At most `cap` rows a group (a null group is uncapped); rows over the cap refill only what is missing to the limit.

    Ranks are within groups; the global order is a top-k of at most `limit` rows.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    over = F.when(F.col(group).isNull(), 0).otherwise((rank > cap).cast("int"))
    return df.withColumn("overflow", over).orderBy("overflow", *order).limit(limit)


def top_items(df: DataFrame, value: str, ref: str, k: int, refs: int = 4) -> DataFrame:
    """The k most frequent values with their first distinct refs."""
    per = df.filter(F.col(value).isNotNull()).groupBy(value, ref).agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy(value).agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), value).limit(k)
    rank = F.row_number().over(Window.partitionBy(value).orderBy(ref))
    first = per.join(F.broadcast(top.select(value)), value).withColumn("r", rank).filter(F.col("r") <= refs)
    return top.join(first.groupBy(value).agg(F.array_join(F.sort_array(F.collect_list(ref)), ",").alias("refs")), value)


def in_selection(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is selected; an empty selection means no filter."""
    return df if keys.isEmpty() else df.join(keys.select(key).distinct(), key, "left_semi")


def in_either(df: DataFrame, row_id: str, ids: DataFrame, chapters: DataFrame, chapter: str) -> DataFrame:
    """Rows kept by id or by chapter."""
    by_id = df.join(ids.select(row_id).distinct(), row_id, "left_semi")
    by_chapter = df.join(chapters.select(chapter).distinct(), chapter, "left_semi")
    return by_id.unionByName(by_chapter).dropDuplicates([row_id])


def scene_rank(style: Column, power: Column, relations: Column, questions: Column) -> Column:
    return 4 * style + 3 * power + 2 * relations + questions


def atoms_in_scope(atoms: DataFrame, refs: str, scope: list[str], order: str, atom_id: str, limit: int = 18) -> DataFrame:
    """Atoms whose refs touch the scope, each id once, first ones first."""
    hit = atoms.filter(F.arrays_overlap(F.col(refs), F.array(*map(F.lit, scope))))
    first = F.row_number().over(Window.partitionBy(atom_id).orderBy(order))
    return hit.withColumn("_r", first).filter("_r = 1").drop("_r").orderBy(order).limit(limit)
