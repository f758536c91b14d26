"""Scoring, judging, comparison and the regression gate: projections over joins, and one-row aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sagaframe.functions.text import clip_ratio, round4


def section_completeness(targets: DataFrame, rules: DataFrame, path: str) -> DataFrame:
    """One row: sections, complete ones, mean ratio of rules to target, underfilled sections."""
    counts = rules.groupBy(path).agg(F.count(F.lit(1)).alias("n"))
    ratio = clip_ratio(F.coalesce("n", F.lit(0)), F.col("target"))
    joined = targets.join(counts, path, "left").withColumn("ratio", ratio)
    return joined.agg(F.count(F.lit(1)).alias("sections"), F.count_if(F.col("ratio") >= 1).alias("complete"), F.round(F.avg("ratio"), 4).alias("completeness"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("ratio") < 1, F.col(path)))), ",").alias("underfilled"))


def assembly_loss(candidates: DataFrame, final: DataFrame, path: str, rule_id: str, k: int = 8) -> DataFrame:
    """Per path: candidates, final rules, dropped and the loss ratio; the k worst."""
    c = candidates.groupBy(path).agg(F.count_distinct(rule_id).alias("candidates"))
    f = final.groupBy(path).agg(F.count_distinct(rule_id).alias("final"))
    j = c.join(f, path, "left").withColumn("final", F.coalesce("final", F.lit(0))).withColumn("dropped", F.col("candidates") - F.col("final"))
    return j.withColumn("loss", clip_ratio(F.col("dropped"), F.col("candidates"))).orderBy(F.col("loss").desc(), path).limit(k)


def specificity(similarity: Column, anchored: Column, complete: Column) -> Column:
    return round4(0.5 * similarity + 0.3 * anchored + 0.2 * complete)


def actionability(contract: Column, cue: Column) -> Column:
    return round4(0.7 * contract + 0.3 * cue)


def grounding(refs: Column, context: Column) -> Column:
    return round4(0.55 * refs + 0.45 * context)


def rule_quality(rules: DataFrame, passed: float = 0.72, warned: float = 0.55) -> DataFrame:
    """Adds overall_score and status to rows with specificity, actionability and grounding."""
    overall = round4(0.34 * F.col("specificity") + 0.33 * F.col("actionability") + 0.33 * F.col("grounding"))
    return rules.withColumn("overall_score", overall).withColumn("status", F.when(F.col("overall_score") >= passed, "pass").when(F.col("overall_score") >= warned, "warn").otherwise("fail"))


def quality_summary(rules: DataFrame) -> DataFrame:
    return rules.agg(F.count(F.lit(1)).alias("rules"), *[F.count_if(F.col("status") == s).alias(s) for s in ("pass", "warn", "fail")], F.round(F.avg("overall_score"), 4).alias("average"))


def budget_ratio(n: Column, soft: int, hard: int, floor: float = 0.25) -> Column:
    """0 for none, 1 up to the soft limit, down to .8 at the hard one, .1 less for each more, never below the floor."""
    within = 1 - 0.2 * (n - soft) / max(hard - soft, 1)
    return F.when(n <= 0, 0.0).when(n <= soft, 1.0).when(n <= hard, F.round(within, 4)).otherwise(F.greatest(F.lit(floor), F.round(0.8 - 0.1 * (n - hard), 4)))


def judge_summary(rows: DataFrame, case: str, dimension: str, score: str, status: str) -> DataFrame:
    """Per dimension: applicable rows, mean, passes and pass rate; rows that don't apply leave the denominator."""
    ok = F.col(status) != "not_applicable"
    return rows.groupBy(dimension).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("applicable"), F.count_if(F.col(status) == "pass").alias("passed"), F.round(F.avg(F.when(ok, F.col(score))), 4).alias("mean")).withColumn("pass_rate", F.when(F.col("applicable") > 0, F.round(F.col("passed") / F.col("applicable"), 4)))


def judge_pivot(rows: DataFrame, case: str, dimension: str, score: str, dimensions: list[str]) -> DataFrame:
    """A row per case with a column per dimension."""
    return rows.groupBy(case).pivot(dimension, dimensions).agg(F.round(F.avg(score), 4))


def compare_rows(a: DataFrame, b: DataFrame, key: str, score: str, least: float) -> DataFrame:
    """Rows of both runs: delta and winner."""
    j = a.select(key, F.col(score).alias("a")).join(b.select(key, F.col(score).alias("b")), key)
    return j.withColumn("delta", F.round(F.col("a") - F.col("b"), 2)).withColumn("winner", F.when(F.col("delta") >= least, "a").when(F.col("delta") <= -least, "b").otherwise("tie"))


def compare_summary(compared: DataFrame, least: float) -> DataFrame:
    agg = compared.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col("winner") == w).alias(f"wins_{w}") for w in ("a", "b")], F.round(F.avg("delta"), 2).alias("delta"))
    rate = lambda c: F.round(F.col(c) / F.greatest("n_rows", F.lit(1)), 4)
    by_delta = F.when(F.col("delta") >= least, "a").when(F.col("delta") <= -least, "b").otherwise("tie")
    return agg.withColumns({"rate_a": rate("wins_a"), "rate_b": rate("wins_b"), "winner": F.when(F.col("wins_a") > F.col("wins_b"), "a").when(F.col("wins_b") > F.col("wins_a"), "b").otherwise(by_delta)})


def regression_gate(compared: DataFrame, gates: Column, warn: float = 6.0, fail: float = 12.0) -> DataFrame:
    """Candidate b against baseline a: severity by falls of a case (.5 over `warn`, 1 over `fail`); a failed hard gate fails regardless."""
    fall = F.col("a") - F.col("b")
    points = F.when(fall > fail, 1.0).when(fall > warn, 0.5).otherwise(0.0)
    agg = compared.agg(F.count(F.lit(1)).alias("cases"), F.sum(points).alias("severity"), F.coalesce(F.bool_and(gates), F.lit(True)).alias("gates_ok"))
    return agg.withColumn("status", F.when(~F.col("gates_ok") | (F.col("severity") >= 3), "fail").when(F.col("severity") >= 1, "warn").otherwise("pass"))
