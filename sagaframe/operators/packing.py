"""Batch planning: greedy packing of routed items under token, item and type limits.

Within a bucket each choice depends on the one before, so a bucket is packed by ordered Python in one grouped function. A plan takes
`batches * item_cap` items of a bucket at most; an item that so many others beat whatever was taken before can never be chosen, and goes
before anything is gathered, in each task and again where the tasks' rows meet. The plan is that of the whole bucket. The fair round robin over
all buckets shares the counts of items used, which makes it sequential by definition; it is offered for plans of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sagaframe.session import prepare


@dataclass(frozen=True)
class BatchRules:
    token_budget: int = 5200
    item_cap: int = 12
    per_type: tuple[tuple[str, int], ...] = ()
    batches: int = 6
    least_confidence: float = 0.18
    novelty: float = 0.3
    evidence: float = 0.15
    overlap: float = 0.2
    duplicate: float = 0.25
    repeat_chapter: float = 0.15
    capacity: float = 0.22
    pressure: float = 0.2


def marginal(item: dict, axes: set, chapters: set, tokens: int, used: int, rules: BatchRules) -> float:
    """Worth of one more item for a batch; the pressure is that of the item's own tokens."""
    own = set(item["axes"])
    score = item["confidence"] + rules.novelty * (len(own - axes) / len(own) if own else 0.0) + rules.evidence * item["evidence"]
    same = item["chapter"] in chapters
    score += rules.overlap * (1.0 if same else 0.0)
    score += rules.capacity * max(0.0, min(min(score * 1000 / max(item["tokens"], 1), 2.0) / 2.0, 1.0))
    p = min(1.0, item["tokens"] / rules.token_budget)
    score -= rules.duplicate * used + (rules.repeat_chapter if same else 0.0) + rules.pressure * p + 0.75 * rules.pressure * p * p
    return round(max(0.0, score), 4)


def fits(item: dict, batch: list[dict], tokens: int, rules: BatchRules) -> bool:
    limits = dict(rules.per_type)
    same = sum(x["kind"] == item["kind"] for x in batch)
    return tokens + item["tokens"] <= rules.token_budget and len(batch) < rules.item_cap and same < limits.get(item["kind"], rules.item_cap)


def build_batch(pool: list[dict], used: dict, rules: BatchRules) -> list[dict]:
    """Take the best item that fits, again and again, ranked anew after each."""
    batch, axes, chapters, tokens = [], set(), set(), 0
    rest = list(pool)
    while True:
        open_items = [x for x in rest if fits(x, batch, tokens, rules)]
        if not open_items:
            return batch
        best = min(open_items, key=lambda x: (-marginal(x, axes, chapters, tokens, used.get(x["item"], 0), rules), x["chapter"], x["item"]))
        batch.append(best | {"score": marginal(best, axes, chapters, tokens, used.get(best["item"], 0), rules)})
        rest.remove(best)
        axes |= set(best["axes"])
        chapters.add(best["chapter"])
        tokens += best["tokens"]


def plan_bucket(items: list[dict], rules: BatchRules) -> list[tuple[int, int, dict]]:
    """(batch, place, item) until nothing is left or the number of batches is reached."""
    pool, used, out = sorted(items, key=lambda x: (-x["confidence"], x["chapter"], x["item"])), {}, []
    for b in range(rules.batches):
        batch = build_batch(pool, used, rules)
        if not batch:
            break
        taken = {x["item"] for x in batch}
        pool = [x for x in pool if x["item"] not in taken]
        out += [(b, i, x) for i, x in enumerate(batch)]
    return out


def plan_round_robin(items: dict[str, list[dict]], rules: BatchRules, most: int) -> list[tuple[str, int, int, dict]]:
    """Batches one at a time for the hungriest bucket: few unique items used, many left, much confidence; items count as used for all buckets."""
    used: dict = {}
    done = {b: 0 for b in items}
    pools = {b: list(v) for b, v in items.items()}
    out = []
    while sum(done.values()) < most:
        def hunger(b: str) -> tuple:
            fresh = [x for x in pools[b] if not used.get(x["item"])]
            return done[b] >= rules.batches, -len(fresh), -sum(x["tokens"] for x in fresh) // max(1, rules.token_budget), -sum(x["confidence"] for x in fresh), b

        ready = [b for b in pools if pools[b]]
        if not ready:
            return out
        b = min(ready, key=hunger)
        batch = build_batch(pools[b], used, rules)
        if not batch:
            pools[b] = []
            continue
        taken = {x["item"] for x in batch}
        pools[b] = [x for x in pools[b] if x["item"] not in taken]
        for i, x in enumerate(batch):
            used[x["item"]] = used.get(x["item"], 0) + 1
            out.append((b, done[b], i, x))
        done[b] += 1
    return out


_SCHEMA = "bucket_id string, batch long, place long, item long, tokens long, score double"
#: Rows that are compared with one another at once.
COMPARED = 2048


def unbeaten(tokens: np.ndarray, worth: np.ndarray, item: np.ndarray, most: int) -> np.ndarray:
    """Which rows fewer than `most` others beat: no more tokens, no less worth, a smaller item (the order of ties)."""
    beats = (tokens[:, None] <= tokens) & (worth[:, None] >= worth) & (item[:, None] < item)
    return beats.sum(axis=0) < most


def _candidates(rules: BatchRules, fields: list[str]):
    """Rows sorted by what marks items of one sort (bucket, kind, chapter, axes): those that may be chosen, in bounded memory."""
    most = rules.batches * rules.item_cap

    def reduced(rows: pd.DataFrame) -> pd.DataFrame:
        worth = (rows["confidence"] + rules.evidence * rows["evidence"]).to_numpy()
        return rows[unbeaten(rows["tokens"].to_numpy(), worth, rows["item"].to_numpy(), most)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sort, held, fresh = None, None, 0
        for frame in frames:
            for key, rows in frame.groupby("__sort", sort=False):
                if key == sort:
                    held, fresh = pd.concat([held, rows]), fresh + len(rows)
                else:
                    if held is not None:
                        yield reduced(held)[fields]
                    sort, held, fresh = key, rows, len(rows)
                if fresh >= COMPARED:
                    held, fresh = reduced(held), 0
        if held is not None:
            yield reduced(held)[fields]

    return run


def may_be_chosen(candidates: DataFrame, rules: BatchRules) -> DataFrame:
    """The candidates without those that no plan can reach; the plan of a bucket is the same with them."""
    prepare(candidates.sparkSession)
    fields = candidates.columns
    sort = F.xxhash64("bucket_id", "kind", "chapter", F.array_sort("axes"))
    schema = StructType([*candidates.schema.fields, StructField("__sort", LongType())])
    once = _candidates(rules, [*fields, "__sort"])
    near = candidates.withColumn("__sort", sort).sortWithinPartitions("__sort").mapInPandas(once, schema)
    return near.repartition("__sort").sortWithinPartitions("__sort").mapInPandas(once, schema).drop("__sort")


def plan_batches(candidates: DataFrame, rules: BatchRules) -> DataFrame:
    """candidates: bucket_id, item, kind, chapter, tokens, confidence, evidence, axes. Buckets are planned on their own, each as a whole."""
    ready = may_be_chosen(candidates.filter(F.col("confidence") >= rules.least_confidence), rules)

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        items = [r | {"axes": list(r["axes"])} for r in pdf.to_dict("records")]
        rows = [(pdf["bucket_id"].iloc[0], b, i, x["item"], x["tokens"], x["score"]) for b, i, x in plan_bucket(items, rules)]
        return pd.DataFrame(rows, columns=["bucket_id", "batch", "place", "item", "tokens", "score"])

    return ready.groupBy("bucket_id").applyInPandas(plan, _SCHEMA)


def batch_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("bucket_id", "batch").agg(F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("tokens"), F.round(F.avg("score"), 4).alias("score"))


def unbatched(items: DataFrame, plan: DataFrame, item: str) -> DataFrame:
    return items.join(plan.select(F.col("item").alias(item)).distinct(), item, "left_anti")
