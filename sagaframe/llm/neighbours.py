"""Approximate nearest neighbours (operator 7): an inverted multi-index.

Vectors are scaled to length one and cut into two halves, each quantised by its own k-means centroids (fitted on a bounded sample
of SAMPLE rows; every row is indexed). An entry's cell is its pair of centroids. A query walks the pairs by the sum of its squared
distances to both centroids, smallest first, with a heap, until the cells it has passed hold enough entries; those are reranked by
their cosine on the original vectors in double precision.

Cells are laid out in blocks of about BLOCK entries: neighbouring small cells share one, a larger cell is dealt over several by a hash, so the
cell of a very common vector is spread over tasks. A query goes to each block that holds cells on its walk, with the list of these cells, and
only their entries are reranked there; each block returns the query's nearest few, and these are ranked once more. Queries beyond QUERIES are
dealt into groups, each of which meets every block apart, so what a task holds is bounded. Centroids and cell sizes are at most KMAX * KMAX numbers.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, as query or entry; vectors of different
lengths have no cosine, so each length has an index of its own; ties go to the smaller id; rows with a null id take no part; a query's own
row alone is no candidate, so of rows with one id each is found by the others; repeated rows are entries and queries of their own; a table with
fewer entries than k gives all of them; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.session import cut, prepare, spread

SAMPLE = 20_000
KMAX = 256
BLOCK = 2048
#: Queries that may meet a block in one task.
QUERIES = 65_536
#: Entries that a query passes: REACH * n ** POWER of all n, but FEWEST at least. On vectors without any clusters (64 independent
#: components), the worst case for any index, this finds 0.92 and more of the true nearest 5; clustered vectors need far less.
REACH, POWER = 1.6, 0.85
FEWEST = 2000


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors in double precision)."""
    keep, out = [], []
    for i, v in enumerate(column.to_pylist()):
        if v is None or len(v) != dim or any(x is None for x in v):
            continue
        a = np.asarray(v, dtype=np.float64)
        if np.isfinite(a).all() and a.any():
            keep.append(i)
            out.append(a)
    return np.array(keep, dtype=np.int64), np.array(out, dtype=np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centroids; the same for the same rows in the same order."""
    draw = np.random.default_rng(seed)
    c = x[np.sort(draw.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * x @ c.T


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return distances(x, c).argmin(axis=1)


def walk(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Non-empty cells (i * len(d2) + j) by d1[i] + d2[j], until they hold enough entries."""
    a, b = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen, out, held = [(float(d1[a[0]] + d2[b[0]]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(d2) + int(b[j])
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
        for x in ((i + 1, j), (i, j + 1)):
            if x[0] < len(a) and x[1] < len(b) and x not in seen:
                seen.add(x)
                heapq.heappush(heap, (float(d1[a[x[0]]] + d2[b[x[1]]]), *x))
    return out


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector with rows, each by the same sums whatever stands beside it."""
    q = q / np.abs(q).max()
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (q * x).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


def top(q: np.ndarray, ids: np.ndarray, x: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows: rough scores choose with a margin, exact ones decide."""
    kth = np.partition(rough, -k)[-k] if len(rough) > k else -2.0
    at = np.flatnonzero(rough >= kth - 1e-9)
    exact = cosines(q, x[at])
    order = np.lexsort((ids[at], -exact))[:k]
    return ids[at][order], exact[order]


def layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of each cell."""
    first, parts = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    block, held = 0, 0
    for c in np.flatnonzero(sizes).tolist():
        size = int(sizes[c])
        if held and held + size > BLOCK:
            block, held = block + 1, 0
        first[c] = block
        if size > BLOCK:
            parts[c] = -(-size // BLOCK)
            block += int(parts[c])
        else:
            held += size
    return first, parts


def _assign(c1: np.ndarray, c2: np.ndarray, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = matrix(batch.column(1), dim)
            if not len(keep):
                continue
            u = unit(x)
            cell = nearest(u[:, : dim // 2], c1) * len(c2) + nearest(u[:, dim // 2 :], c2)
            vectors = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), vectors, pa.array(cell, pa.int64())], names=["id", "v", "cell"])

    return run


def _dealt(first: np.ndarray, parts: np.ndarray):
    """Rows (row, id, v, cell) with the block that each entry is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, rows = batch.column(3).to_numpy(), batch.column(0).to_numpy()
            mixed = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            block = first[cell] + (mixed % parts[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=["row", "id", "v", "cell", "block"])

    return run


def _visits(c1: np.ndarray, c2: np.ndarray, sizes: np.ndarray, first: np.ndarray, parts: np.ndarray, enough: int, dim: int):
    """Over rows (row, id, v): a row for each block that a query visits, with the cells on its walk there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.float64).reshape(-1, dim)
            u = unit(x) if len(x) else x
            d1, d2 = distances(u[:, : dim // 2], c1), distances(u[:, dim // 2 :], c2)
            for i in range(len(x)):
                cells = np.array(walk(d1[i], d2[i], sizes, enough), dtype=np.int64)
                blocks = np.concatenate([first[cells], *(np.arange(first[c] + 1, first[c] + parts[c]) for c in cells[parts[cells] > 1])])
                which = np.concatenate([cells, np.repeat(cells[parts[cells] > 1], parts[cells[parts[cells] > 1]] - 1)])
                order = np.argsort(blocks, kind="stable")
                blocks, which = blocks[order], which[order]
                starts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
                at = pa.array(np.full(len(starts), i))
                lists = pa.array([c.astype(np.int32).tobytes() for c in np.split(which, starts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(3)), pa.array(blocks[starts]), lists], names=["row", "id", "v", "block", "cells"])

    return run


def _rerank(dim: int, k: int):
    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        vectors = lambda t: np.frombuffer(b"".join(t["v"].to_pylist()), dtype=np.float64).reshape(-1, dim)
        out: list[tuple[int, int, int, float]] = []
        if entries.num_rows and queries.num_rows:
            rows, ids, cell, x = entries["row"].to_numpy(), entries["id"].to_numpy(), entries["cell"].to_numpy(), vectors(entries)
            u = unit(x)
            known, place = np.unique(cell, return_inverse=True)
            for row, own, v, cells in zip(*(queries[c].to_pylist() for c in ("row", "id", "v", "cells")), strict=True):
                passed = np.isin(known, np.frombuffer(cells, np.int32))[place] & (rows != row)
                at = np.flatnonzero(passed)
                if len(at):
                    q = np.frombuffer(v, dtype=np.float64)
                    a, s = top(q, ids[at], x[at], u[at] @ unit(q[None])[0], k)
                    out += zip([row] * len(a), [own] * len(a), a.tolist(), s.tolist(), strict=True)
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["row", "query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, queries=None, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, reach: float = REACH, fewest: int = FEWEST, centroids: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score. `queries`: a condition on the id column named id."""
    spark = vectors.sparkSession
    prepare(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    whole = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    lengths = {r.dim: r["count"] for r in whole.groupBy(F.size("v").alias("dim")).count().collect()}
    found = None
    for dim, n in sorted(lengths.items()):
        one = _of_length(whole.filter(F.size("v") == dim), dim, n, queries, k, reach, fewest, centroids)
        found = one if found is None else found.unionByName(one)
    return empty if found is None else found


def _of_length(rows: DataFrame, dim: int, n: int, queries, k: int, reach: float, fewest: int, centroids: int | None) -> DataFrame:
    """The neighbours among rows (id, v) whose vectors all have one length."""
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).select("v").collect()  # SAMPLE rows at most
    u = unit(np.array([r.v for r in sample], dtype=np.float64))
    cells = centroids or int(min(KMAX, max(2, n**0.5 / 2)))
    c1, c2 = kmeans(u[:, : dim // 2], cells, 1), kmeans(u[:, dim // 2 :], cells, 2)
    # Rows are numbered before they are kept in the shared folder, so the numbers stay.
    indexed = cut(spread(rows).mapInArrow(_assign(c1, c2, dim), "id long, v binary, cell long").select(F.monotonically_increasing_id().alias("row"), "id", "v", "cell"))
    sizes = np.zeros(len(c1) * len(c2), dtype=np.int64)
    for r in indexed.groupBy("cell").count().collect():  # one row a cell, KMAX * KMAX at most
        sizes[r["cell"]] = r["count"]
    first, parts = layout(sizes)
    asked = indexed if queries is None else indexed.filter(queries)
    groups = max(1, -(-asked.count() // QUERIES))
    visits = asked.select("row", "id", "v").mapInArrow(_visits(c1, c2, sizes, first, parts, int(max(fewest, reach * n**POWER)), dim), "row long, id long, v binary, block long, cells binary")
    visits = visits.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))
    entries = indexed.mapInArrow(_dealt(first, parts), "row long, id long, v binary, cell long, block long").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    found = entries.groupBy("block", "part").cogroup(visits.groupBy("block", "part")).applyInArrow(_rerank(dim, k), "row long, query_id long, vec_id long, score double")
    rank = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
