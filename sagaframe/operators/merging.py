"""Merging of rules: memo unions, alias groups, strategies, evidence selection, gaps, greedy semantic dedupe."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.functions.text import text_key
from sagaframe.operators.similarity import nearest
from sagaframe.session import prepare


def sanitize_memo(memos: DataFrame, group: str, text: str, refs: str, allowed: list[str]) -> DataFrame:
    """Refs that are allowed, empty candidates dropped, equal texts merged; per group also how many were dropped."""
    ok = F.array_intersect(F.col(refs), F.array(*map(F.lit, allowed)))
    return memos.withColumn("refs", ok).withColumn("key", text_key(F.col(text))).withColumn("dropped", (F.size("refs") == 0) | (F.col("key") == "")).groupBy(group, "key").agg(
        F.min(text).alias("text"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("refs")))).alias("refs"), F.count_if("dropped").alias("dropped")
    )


def merge_by_text(memos: DataFrame, group: str, text: str, ref: str, order: str, refs: int = 12) -> DataFrame:
    """Rows of a group with one text key: the first text, their number, the first refs. Distinct refs are found before they are gathered."""
    per = memos.select(group, text_key(F.col(text)).alias("key"), F.col(text).alias("text"), F.col(ref).alias("ref"), F.col(order).alias("ord")).filter("key <> ''")
    one = per.groupBy(group, "key", "ref").agg(F.min("ord").alias("ord"), F.min_by("text", "ord").alias("text"), F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(group, "key").orderBy("ord", "ref"))
    ranked = one.withColumn("r", rank)
    return ranked.groupBy(group, "key").agg(F.min_by("text", "ord").alias("text"), F.sum("n").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("r") <= refs, F.struct("ord", "ref")))), lambda x: x["ref"].cast("string")), ",").alias("refs"))


def shape_score(text: Column, trigger: Column, refs: Column, cues: Sequence[str], templates: Sequence[str] = ()) -> Column:
    """How well formed a rule is."""
    holds = lambda words, c: F.lit(False) if not words else F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))
    score = 0.5 + F.when(holds(cues, F.substring(text, 1, 10)), 0.15).otherwise(0.0) + F.when(F.coalesce(trigger, F.lit("")) != "", 0.1).otherwise(0.0) + F.when(refs > 0, 0.05).otherwise(0.0)
    return F.round(score - F.when(holds(templates, text), 0.3).otherwise(0.0), 4)


def scalar_pick(rules: DataFrame, path: str, priority: list[Column]) -> DataFrame:
    """The best rule of each path."""
    return rules.withColumn("_r", F.row_number().over(Window.partitionBy(path).orderBy(*priority))).filter("_r = 1").drop("_r")


def alias_groups(rules: DataFrame, path: str, rule_id: str, aliases: str, order: str) -> DataFrame:
    """Adds group_no: in order, a rule joins the group of the first of its aliases that one has; a later rule never joins two groups.

    The outcome depends on the order and is not that of connected components, so each path is folded in one task.
    """
    prepare(rules.sparkSession)
    schema = rules.select(path, rule_id, aliases, order).schema.add("group_no", "long")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order, rule_id], kind="stable")
        known: dict[str, int] = {}
        numbers, n = [], 0
        for names in pdf[aliases]:
            found = next((known[a] for a in names if a in known), None)
            if found is None:
                found, n = n, n + 1
            for a in names:
                known.setdefault(a, found)
            numbers.append(found)
        return pdf.assign(group_no=numbers)

    return rules.select(path, rule_id, aliases, order).groupBy(path).applyInPandas(fold, schema)


def drop_conflicts(rules: DataFrame, group: list[str], field: str) -> DataFrame:
    """Groups whose field has more than one distinct normalized value go as a whole."""
    values = rules.groupBy(*group).agg(F.count_distinct(F.nullif(text_key(F.col(field)), F.lit(""))).alias("_v")).filter("_v > 1").select(*group)
    return rules.join(values, group, "left_anti")


def append_capped(rules: DataFrame, path: str, key: str, priority: list[Column], cap: int) -> DataFrame:
    """One rule a key, the first `cap` of each path."""
    first = rules.withColumn("_k", F.row_number().over(Window.partitionBy(path, key).orderBy(*priority))).filter("_k = 1").drop("_k")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(path).orderBy(*priority))).filter(F.col("rank") <= cap)


def lineage(rules: DataFrame, group: list[str], rule_id: str, priority: list[Column]) -> DataFrame:
    """Per group the rule that stays, how many went into it, and the smallest and largest of their ids."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*priority))
    return rules.withColumn("_r", rank).groupBy(*group).agg(F.max(F.when(F.col("_r") == 1, F.col(rule_id))).alias("kept"), F.count(F.lit(1)).alias("merged"), F.min(rule_id).alias("first_id"), F.max(rule_id).alias("last_id"))


def select_evidence(evidence: DataFrame, ref: str, bucket: str, order: str, critical: list[str], soft: int = 18, hard: int = 20) -> DataFrame:
    """Each ref once; the first of each critical bucket, then in order up to the soft cap, then first rows of buckets not seen so far up to the hard cap.

    Only the first `hard` rows of each bucket can be chosen, so the last ranking sees buckets times `hard` rows.
    """
    once = evidence.withColumn("_r", F.row_number().over(Window.partitionBy(ref).orderBy(order, bucket))).filter("_r = 1").drop("_r")
    few = once.withColumn("in_bucket", F.row_number().over(Window.partitionBy(bucket).orderBy(order, ref))).filter(F.col("in_bucket") <= hard)
    first_pass = (F.col("in_bucket") == 1) & F.col(bucket).isin(critical)
    ranked = few.withColumn("pass", F.when(first_pass, 0).otherwise(1)).orderBy("pass", order, ref).limit(soft).withColumn("stage", F.lit(0))
    seen = ranked.select(bucket).distinct()
    fresh = few.filter("in_bucket = 1").join(F.broadcast(seen), bucket, "left_anti").orderBy(order, ref).limit(hard - soft).withColumn("pass", F.lit(2)).withColumn("stage", F.lit(1))
    return ranked.unionByName(fresh).select(ref, bucket, order, "pass")


def section_gaps(targets: DataFrame, rules: DataFrame, path: str) -> DataFrame:
    """Paths with fewer rules than their target, the largest deficit first."""
    counts = rules.groupBy(path).agg(F.count(F.lit(1)).alias("n"))
    joined = targets.join(counts, path, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.withColumn("deficit", F.col("target") - F.col("n")).filter("deficit > 0").select(path, "target", "n", "deficit")


def slot_coverage(slots: DataFrame, rules: DataFrame, slot: str, rule: str, vec: str, threshold: float) -> DataFrame:
    """The best rule of each slot and whether it covers it: all pairs in blocks, of whose best the best is an aggregate."""
    found = nearest(slots.select(F.col(slot).alias("q_id"), F.col(vec).alias("q_vec")), rules.select(F.col(rule).alias("id"), F.col(vec).alias("vec")), 1, False)
    best = found.groupBy(F.col("q_id").alias("slot_id")).agg(F.max(F.struct("score", (-F.col("id")).alias("neg"))).alias("b"))
    return best.select("slot_id", (-F.col("b.neg")).alias("rule_id"), F.col("b.score").alias("score"), (F.col("b.score") >= threshold).alias("covered"))


def greedy_dedupe(rows: DataFrame, group: str, row_id: str, vec: str, priority: str, threshold: float, cap: int) -> DataFrame:
    """In order of priority keep a row unless it is like a kept one of its group; at most `cap` a group. An ordered fold by definition."""
    import numpy as np

    prepare(rows.sparkSession)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([priority, row_id], ascending=[False, True], kind="stable")
        kept, out = [], []
        for i, v in zip(pdf[row_id], pdf[vec], strict=True):
            a = np.asarray(v, dtype=np.float64)
            norm = np.sqrt((a * a).sum())
            like = max([float((a * b).sum() / (norm * n)) for b, n in kept if norm * n > 0], default=0.0)
            if like < threshold and len(kept) < cap:
                kept.append((a, norm))
                out.append((pdf[group].iloc[0], i, len(kept)))
        return pd.DataFrame(out, columns=[group, row_id, "place"])

    kinds = dict(rows.dtypes)
    return rows.select(group, row_id, vec, priority).groupBy(group).applyInPandas(fold, f"{group} {kinds[group]}, {row_id} {kinds[row_id]}, place long")


def guardrails(jobs: DataFrame, failed: Column, critical: Column, most: int = 1, share: float = 0.15) -> DataFrame:
    """One row: totals, and whether failures are within the limits (none critical, at most `most` and `share`)."""
    agg = jobs.agg(F.count(F.lit(1)).alias("jobs"), F.count_if(failed).alias("failed"), F.count_if(failed & critical).alias("critical_failed"))
    return agg.withColumn("ok", (F.col("critical_failed") == 0) & (F.col("failed") <= most) & (F.col("failed") <= share * F.col("jobs")))
