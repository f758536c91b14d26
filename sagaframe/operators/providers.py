"""Extraction and embedding providers behind one Arrow function, with a cache table in front of them.

Calls are made once for each distinct request that the cache lacks; results are written before they are used, so a task that runs
again finds them. The default providers need no network and always give the same answer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sagaframe.session import prepare

FACTS = "entities array<string>, n_numbers long"
VECTOR = "embedding array<double>"


def extract_facts(text: str) -> dict:
    """Offline extraction: capitalized words in order of appearance, and how many numbers there are."""
    return {"entities": list(dict.fromkeys(re.findall(r"\b[A-Z][a-z]{3,}\b", text)))[:16], "n_numbers": len(re.findall(r"\d+", text))}


def embed(text: str, dim: int = 16) -> dict:
    """Offline embedding: hashed character pairs, scaled to length one."""
    v = [0.0] * dim
    for a, b in zip(text, text[1:], strict=False):
        h = hashlib.blake2b((a + b).encode("utf-8", "surrogatepass"), digest_size=8).digest()
        v[h[0] % dim] += 1.0 if h[1] & 1 else -1.0
    n = sum(x * x for x in v) ** 0.5
    return {"embedding": [x / n for x in v] if n else v}


def request_key(*parts: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def call(requests: DataFrame, text: str, key: str, provider: Callable[[str], dict], schema: str, cache: DataFrame | None = None) -> DataFrame:
    """key and the provider's columns for every distinct request."""
    prepare(requests.sparkSession)
    distinct = requests.select(key, text).dropDuplicates([key])
    todo = distinct if cache is None else distinct.join(cache.select(key), key, "left_anti")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [provider(t or "") for t in f[text]]
            yield pd.DataFrame({key: f[key], **{n: [r[n] for r in rows] for n in names}})

    fresh = todo.mapInPandas(run, f"{key} string, {schema}")
    return fresh if cache is None else fresh.unionByName(cache.select(key, *names).join(distinct.select(key), key, "left_semi"))


def two_pass(length: Column, request: Column, scene: int = 1200, most: int = 3800) -> Column:
    """Whether a request is split into two passes."""
    return (length >= scene) | (request >= most)


def resume(rows: DataFrame, manifest: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Adds action: reuse where the manifest has the same fingerprint (or none at all, from before there were any), else rerun or new."""
    m = manifest.select(key, F.col(fingerprint).alias("_old"), F.lit(True).alias("_known"))
    j = rows.join(m, key, "left")
    action = F.when(F.col("_known").isNull(), "new").when(F.col("_old").isNull() | (F.col("_old") == F.col(fingerprint)), "reuse").otherwise("rerun")
    return j.withColumn("action", action).drop("_old", "_known")
