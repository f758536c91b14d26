"""Signals of scenes, chapters and rules: positions, densities, nested facts, first hits, budgets, worker shares, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.functions.text import clip_ratio, keyword_hits, normalize_name, stable_id


def chapter_positions(items: DataFrame, item: str, chapter: str) -> DataFrame:
    """Mean place of an item's distinct chapters among all chapters, from 0 to 1; 0.5 if there is one chapter in all.

    The window is over the distinct chapters, not the items.
    """
    pairs = items.select(item, chapter).filter(F.col(chapter).isNotNull()).distinct()
    ranks = pairs.select(chapter).distinct().select(chapter, (F.row_number().over(Window.orderBy(chapter)) - 1).alias("r"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    means = pairs.join(ranks, chapter).groupBy(item).agg(F.avg("r").alias("r"), F.first("n").alias("n"))
    return means.select(item, F.when(F.col("n") <= 1, 0.5).otherwise(F.round(F.col("r") / (F.col("n") - 1), 4)).alias("chapter_position"))


def scene_features(text: Column, n: dict[str, Column], position: Column, words: dict[str, Sequence[str]], per_word: float = 4.0) -> list[Column]:
    """The twelve features of a scene, each from 0 to 1, from counts of its parts and hits of keyword lists.

    n: entities, relations, powers, styles, facts, events, questions. words: institution, resource, body, humor, sales, contract,
    conflict, voice.
    """
    heard = lambda k: clip_ratio(keyword_hits(text, words[k]), per_word)
    part = lambda most, *ks: clip_ratio(sum((n[k] for k in ks[1:]), n[ks[0]]), most)
    rows = {
        "entity_density": part(8, "entities"),
        "relationship_change_density": part(4, "relations"),
        "institution_density": F.greatest(heard("institution"), part(10, "powers", "events")),
        "resource_pressure_density": F.greatest(heard("resource"), part(18, "facts", "questions")),
        "body_modification_density": F.greatest(heard("body"), part(4, "powers")),
        "dark_humor_signal": F.greatest(heard("humor"), part(5, "styles")),
        "sales_pitch_signal": heard("sales"),
        "contract_signal": heard("contract"),
        "conflict_intensity": F.greatest(heard("conflict"), part(8, "relations", "questions")),
        "chapter_position": F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), position)), 4),
        "evidence_density": part(20, "facts", "events", "relations", "powers", "styles"),
        "voice_novelty": F.greatest(heard("voice"), part(10, "styles", "questions")),
    }
    return [c.alias(k) for k, c in rows.items()]


def flattened(df: DataFrame, ids: list[str], values: Column, kind: str) -> DataFrame:
    """A row for each element of an array, with its place and a stable id over the row's ids, place and text. Repeated texts stay."""
    rows = df.select(*ids, F.posexplode(values).alias("place", "text"))
    return rows.select(*ids, F.col("place").cast("long").alias("place"), "text", stable_id(kind, F.concat_ws("|", *ids, "place", "text")).alias("id"))


def first_hits(texts: DataFrame, order: str, text: str, keywords: Sequence[str]) -> DataFrame:
    """For each keyword the first row that holds it and how many do; one aggregation over the texts, no join."""
    held = [F.col(text).contains(k) for k in keywords]
    one = texts.agg(*[x for i, h in enumerate(held) for x in (F.min(F.when(h, F.col(order))).alias(f"f{i}"), F.count_if(h).alias(f"n{i}"))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("keyword"), F.col(f"f{i}").alias("first_ref"), F.col(f"n{i}").alias("hits")) for i, k in enumerate(keywords)])))


def axis_coverage(texts: DataFrame, group: str, text: str, axes: dict[str, Sequence[str]]) -> DataFrame:
    """For each group and axis: texts that hold one of its keywords, and whether the axis is covered; with the group's ratio of covered axes."""
    hit = lambda ws: F.count_if(keyword_hits(F.col(text), ws) > 0)
    sums = texts.groupBy(group).agg(*[hit(ws).alias(a) for a, ws in axes.items()])
    covered = sum(((F.col(a) > 0).cast("int") for a in axes), F.lit(0))
    rows = F.inline(F.array(*[F.struct(F.lit(a).alias("axis_id"), F.col(a).alias("hits"), (F.col(a) > 0).alias("covered")) for a in axes]))
    return sums.withColumn("coverage", F.round(covered / F.lit(len(axes)), 4)).select(group, "coverage", rows)


def within_budget(examples: DataFrame, group: str, order: list[Column], tokens: str, key: str, budget: int, most: int) -> DataFrame:
    """Ranked examples of each group under a token budget: one that does not fit is passed over, the next ones are still tried.

    A fold in the order of rank, over a group's ranks, tokens and keys; texts are not gathered. A catalogue of examples is small; a group
    of many millions of keys would not fit a row.
    """
    ranked = examples.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    listed = ranked.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("__rank", F.col(tokens).cast("long").alias("t"), F.col(key).alias("k")))).alias("xs"))

    def take(acc: Column, x: Column) -> Column:
        fits = (F.size(acc["out"]) < most) & (acc["used"] + x["t"] <= budget)
        return F.when(fits, F.struct((acc["used"] + x["t"]).alias("used"), F.concat(acc["out"], F.array(x)).alias("out"))).otherwise(acc)

    kind = examples.schema[key].dataType.simpleString()
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast(f"array<struct<__rank:int,t:bigint,k:{kind}>>").alias("out"))
    done = listed.select(group, F.aggregate("xs", start, take).alias("a"))
    return done.select(group, F.posexplode("a.out").alias("place", "x")).select(group, F.col("place").cast("long").alias("place"), F.col("x.k").alias(key), F.col("x.t").alias(tokens))


def worker_shares(buckets: DataFrame, bucket: str, workers: int) -> DataFrame:
    """Buckets in order, dealt to workers in runs whose lengths differ by one at most. One row a bucket."""
    order = Window.orderBy(bucket)
    at, n = F.row_number().over(order) - 1, F.count(F.lit(1)).over(Window.partitionBy())
    base, more = F.floor(n / workers), n % workers
    long_runs = more * (base + 1)
    worker = F.when(at < long_runs, F.floor(at / (base + 1))).otherwise(more + F.floor((at - long_runs) / F.greatest(base, F.lit(1))))
    return buckets.select(bucket).distinct().select(bucket, worker.cast("long").alias("worker"))


def first_and_followups(batches: DataFrame, bucket: str, order: list[str], metric: str) -> DataFrame:
    """A metric of each bucket's first batch, the mean of its other batches, and the mean of all."""
    first = F.min_by(metric, F.struct(*order))
    sums = batches.filter(F.col(metric).isNotNull()).groupBy(bucket).agg(first.alias("first_batch"), F.sum(metric).alias("s"), F.count(F.lit(1)).alias("batches"), F.avg(metric).alias("mean_all"))
    follow = F.when(F.col("batches") > 1, (F.col("s") - F.col("first_batch")) / (F.col("batches") - 1))
    return sums.select(bucket, "batches", F.round("first_batch", 4).alias("first_batch"), F.round(follow, 4).alias("mean_followups"), F.round("mean_all", 4).alias("mean_all"))


def retry_decision(candidates: DataFrame, bucket: list[str], kept: Column) -> DataFrame:
    """Per bucket: candidates, those kept, and what to do: a bucket without candidates is skipped, one that lost all is tried again."""
    sums = candidates.groupBy(*bucket).agg(F.count(F.lit(1)).alias("rows"), F.count_if(kept.isNotNull()).alias("candidates"), F.count_if(kept).alias("kept"))
    return sums.withColumn("action", F.when(F.col("candidates") == 0, "skip").when(F.col("kept") == 0, "retry").otherwise("use"))


def merge_keys(rules: DataFrame, rule: str, parts: list[Column]) -> DataFrame:
    """The keys under which a rule may meet others: its non-empty normalized parts, each once, in their order."""
    keys = F.array_distinct(F.filter(F.array(*map(normalize_name, parts)), lambda k: k != ""))
    return rules.select(rule, F.posexplode(keys).alias("place", "merge_key")).withColumn("place", F.col("place").cast("long"))


def dropped_refs(rows: DataFrame, path: list[str], ref: str, dropped: Column) -> DataFrame:
    """Per path: distinct refs, those that no kept row holds, and the share that is covered."""
    refs = rows.groupBy(*path, ref).agg(F.count_if(~dropped).alias("kept"))
    return refs.groupBy(*path).agg(F.count(F.lit(1)).alias("refs"), F.count_if(F.col("kept") == 0).alias("lost"), F.round(F.avg((F.col("kept") > 0).cast("int")), 4).alias("covered"))


def progress(expected: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """What is expected of each run against the artifacts found: done, pending, ratio, status."""
    done = found.groupBy(on).agg(F.count_distinct("artifact").alias("done"))
    rows = expected.join(done, on, "left").withColumn("done", F.coalesce("done", F.lit(0)))
    status = F.when(F.col("done") == 0, "waiting").when(F.col("done") < F.col("expected"), "running").otherwise("completed")
    return rows.select(on, "expected", "done", F.greatest(F.col("expected") - F.col("done"), F.lit(0)).cast("long").alias("pending"), clip_ratio(F.col("done"), F.col("expected")).alias("ratio"), status.alias("status"))


def gate(rows: DataFrame, group: str, checks: dict[str, Column], passes: float = 0.72, warns: float = 0.55) -> DataFrame:
    """Share of rows that meet each check, and a verdict by the weakest one."""
    shares = rows.groupBy(group).agg(*[F.round(F.avg(F.coalesce(c, F.lit(False)).cast("int")), 4).alias(k) for k, c in checks.items()])
    low = F.least(*checks) if len(checks) > 1 else F.col(next(iter(checks)))
    return shares.withColumn("verdict", F.when(low >= passes, "pass").when(low >= warns, "warn").otherwise("fail"))


def contract_counts(rules: DataFrame, section: str, key: str, required: Sequence[str]) -> DataFrame:
    """Rows and distinct keys of every required section (those without rows too), and whether the contract holds it."""
    spark = rules.sparkSession
    counts = rules.groupBy(section).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"))
    wanted = spark.createDataFrame([(s,) for s in required], f"{section} string")
    both = wanted.join(counts, section, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select(section, zero("rows"), zero("keys"), F.col("rows").isNotNull().alias("present"))


def gold_cases(cases: DataFrame, node: str, value: str, least: int = 1) -> DataFrame:
    """The cases of one node; fewer than `least` are an error."""
    found = cases.filter(F.col(node) == value)
    if found.limit(least).count() < least:
        raise ValueError(f"fewer than {least} gold cases of {value}")
    return found


def canonical(value: Column, names: dict[str, Sequence[str]]) -> Column:
    """The canonical name of a free value: equal to a name or alias after normalizing, else the first that it holds; null if none."""
    key = normalize_name(value)
    known = [(c, a) for c, aliases in names.items() for a in (c, *aliases)]
    norm = lambda a: "".join(x for x in a.lower() if x.isalnum())
    exact, part = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c, a in reversed(known):
        exact = F.when(key == norm(a), c).otherwise(exact)
        part = F.when(F.contains(key, F.lit(norm(a))), c).otherwise(part)
    return F.coalesce(exact, part)
