"""Multi-label routing of items to axes and buckets. Lexicons, weights and gates are data; items are scored where they lie."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sagaframe.functions.text import clip_ratio, keyword_hits, round4

ORPHAN = "unassigned"


@dataclass(frozen=True)
class Axis:
    axis_id: str
    words: tuple[str, ...]
    feature: str
    high_precision: bool = False


@dataclass(frozen=True)
class Bucket:
    bucket_id: str
    axes: tuple[str, ...]
    words: tuple[str, ...]
    gate: float = 0.0


@dataclass(frozen=True)
class RoutingRules:
    axes: tuple[Axis, ...] = ()
    buckets: tuple[Bucket, ...] = ()
    select: float = 0.22
    fallback: float = 0.12
    secondary: float = 0.18
    cap: int = 4
    weights: tuple[float, float] = (0.65, 0.27)
    strict_weights: tuple[float, float] = (0.25, 0.55)
    bucket_weights: tuple[float, float, float] = (0.6, 0.3, 0.1)
    least: float = 0.18
    features: dict[str, Column] = field(default_factory=dict)


def hint_score(base: float, evidence: Column) -> Column:
    """A hint's score grows by .1 for up to three pieces of evidence."""
    return F.least(F.lit(1.0), F.lit(base) + 0.1 * F.least(evidence, F.lit(3)))


def _axis_rows(rules: RoutingRules, density: Column | None) -> Column:
    """Over what `_heard` adds: an array with each axis's id, lexical share and score."""
    extra = F.when(density >= 0.35, 0.04).otherwise(0.0) if density is not None else F.lit(0.0)
    rows = []
    for i, a in enumerate(rules.axes):
        hits = F.col(f"__axis{i}")
        lexical = clip_ratio(hits, float(max(len(a.words) // 3, 2)))
        w = rules.strict_weights if a.high_precision else rules.weights
        feature = F.col(f"__feature_{a.feature}")
        score = round4(F.least(F.lit(1.0), lexical * w[0] + feature * w[1] + extra))
        gated = F.when((hits >= 2) & (feature > 0), score).otherwise(0.0) if a.high_precision else score
        rows.append(F.struct(F.lit(a.axis_id).alias("axis_id"), lexical.alias("lexical"), gated.alias("score")))
    return F.array(*rows)


def _heard(items: DataFrame, text: str, rules: RoutingRules) -> DataFrame:
    """Adds the features and the hits of axes and buckets as plain columns.

    The text is lowered and searched in compiled projections, once; what works on arrays later is interpreted and sees numbers alone.
    """
    lower = items.withColumn("__lower", F.lower(F.coalesce(F.col(text), F.lit(""))))
    hits = {f"__{kind}{i}": keyword_hits(F.col("__lower"), x.words) for kind, xs in (("axis", rules.axes), ("bucket", rules.buckets)) for i, x in enumerate(xs)}
    return lower.withColumns({f"__feature_{k}": c for k, c in rules.features.items()} | hits).drop("__lower")


def _scored(items: DataFrame, text: str, rules: RoutingRules, density: Column | None = None) -> DataFrame:
    return _heard(items, text, rules).withColumn("__axes", _axis_rows(rules, density))


def _ranked(rows: Column, score: str, name: str) -> Column:
    """Structs (name, score, rank) of an item, the best first, ties by name."""
    best = F.array_sort(F.transform(rows, lambda x: F.struct((-x[score]).alias("s"), x[name].alias("n"))))
    return F.transform(best, lambda x, i: F.struct(x["n"].alias(name), (F.lit(0.0) - x["s"]).alias(score), (i + 1).alias("rank")))


def axis_scores(items: DataFrame, item: str, text: str, rules: RoutingRules, density: Column | None = None) -> DataFrame:
    """item, axis_id, lexical, score: words and a feature, more strictly weighed on axes that need both."""
    return _scored(items, text, rules, density).select(item, F.inline("__axes"))


def routed(items: DataFrame, text: str, rules: RoutingRules, density: Column | None = None, bonus: Column | None = None) -> DataFrame:
    """Adds `axes` and `buckets`, arrays of structs, best first: all of an item's routes in one pass over it, without a shuffle.

    axes (axis_id, score, rank, role): those at the first threshold, else the best at the fallback; others at the secondary one.
    buckets (bucket_id, confidence, rank): alignment with a bucket's axes, its words and a bonus, or the orphan bucket. At most `cap` of
    each. Every row is an item of its own, rows of one id too. A filter on these arrays would be pushed below and
    score again for each of its uses: take them out by an outer generator first, and filter what it gives.
    """
    first = lambda x: x["score"] >= rules.select
    fallback = lambda x: (F.col("__ranked")[0]["score"] < rules.select) & (x["rank"] == 1) & (x["score"] >= rules.fallback)
    other = lambda x: (x["rank"] > 1) & (x["score"] >= rules.secondary)
    chosen = F.filter("__ranked", lambda x: (first(x) | fallback(x) | other(x)) & (x["rank"] <= rules.cap))
    axes = F.transform(chosen, lambda x: F.struct(x["axis_id"].alias("axis_id"), x["score"].alias("score"), x["rank"].alias("rank"), F.when(first(x) | fallback(x), "primary").otherwise("secondary").alias("role")))
    place = {a.axis_id: i for i, a in enumerate(rules.axes)}
    wa, wl, wb = rules.bucket_weights
    rows = []
    for i, b in enumerate(rules.buckets):
        align = sum((F.col("__axes")[place[a]]["score"] if a in place else F.lit(0.0) for a in b.axes), F.lit(0.0)) / len(b.axes)
        lexical = clip_ratio(F.col(f"__bucket{i}"), float(max(len(b.words) // 3, 2)))
        score = round4(F.least(F.lit(1.0), wa * align + wl * lexical + wb * (bonus if bonus is not None else F.lit(0.0))))
        rows.append(F.struct(F.lit(b.bucket_id).alias("bucket_id"), F.when(align >= b.gate, score).otherwise(0.0).alias("confidence")))
    best = F.col("__buckets")[0]
    orphan = F.array(F.struct(F.lit(ORPHAN).alias("bucket_id"), best["confidence"].alias("confidence"), F.lit(1).alias("rank")))
    kept = F.when(best["confidence"] < rules.least, orphan).otherwise(F.filter("__buckets", lambda x: (x["confidence"] >= rules.least) & (x["rank"] <= rules.cap)))
    scored = _scored(items, text, rules, density).withColumn("__ranked", _ranked(F.col("__axes"), "score", "axis_id")).withColumn("__buckets", _ranked(F.array(*rows), "confidence", "bucket_id"))
    return scored.withColumn("axes", axes).withColumn("buckets", kept).select(*items.columns, "axes", "buckets")


def select_axes(items: DataFrame, item: str, text: str, rules: RoutingRules) -> DataFrame:
    """item, axis_id, score, rank, role of the axes that an item takes."""
    return routed(items, text, rules).select(item, F.inline_outer("axes")).filter("axis_id is not null")


def bucket_memberships(items: DataFrame, item: str, text: str, rules: RoutingRules, bonus: Column | None = None) -> DataFrame:
    """item, bucket_id, confidence, rank of an item's buckets."""
    return routed(items, text, rules, bonus=bonus).select(item, F.inline_outer("buckets")).filter("bucket_id is not null")


def explicit_scores(hints: DataFrame, item: str, axis: str, base: float, evidence: str) -> DataFrame:
    """The largest hint score of each item and axis."""
    return hints.groupBy(item, axis).agg(F.max(hint_score(base, F.col(evidence))).alias("score"))


def coverage(items: DataFrame, dims: list[str], stages: dict[str, Column]) -> DataFrame:
    """Items of each stage over all combinations of the dimensions (cube)."""
    return items.cube(*dims).agg(F.count(F.lit(1)).alias("items"), *[F.count_if(c).alias(k) for k, c in stages.items()])


def coverage_rollup(items: DataFrame, dims: list[str], stages: dict[str, Column]) -> DataFrame:
    return items.rollup(*dims).agg(F.count(F.lit(1)).alias("items"), *[F.count_if(c).alias(k) for k, c in stages.items()])
