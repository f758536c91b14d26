"""SimHash near-duplicates (operator 2): fingerprints, BK-trees over shards, components.

A fingerprint has 64 bits, or a multiple; a bit is set if it is set in over half the XXH64 hashes (seed 42, 43 for the next 64
bits) of the text's word shingles. Two fingerprints link at `radius` or fewer differing bits.

Search. The bits are cut into blocks; two linked fingerprints agree on at least blocks - radius of them, so every choice of that
many blocks is one shard key and each linked pair meets in some shard. Each shard holds one BK-tree, whose children are keyed by
the integer Hamming distance to the parent; a probe follows only the edges within the radius. A tree thus goes to the tasks
whose probes can match it, and no copy of all trees is sent anywhere: their total size grows with the corpus, so it has no bound
that a broadcast could rely on. Shards above MAX_SHARD fingerprints are cut again by the bits on which their members may still
differ, so no group of near copies makes a large task. A shard joins its links with union-find and emits at most one edge a
member, never its pairs.

Defined results: null and empty texts, or texts without words, have fingerprint zero and link like any other; fewer words than a
shingle give one shingle of all words; repeated rows and ties share a component; an empty table gives no rows; extra columns are
ignored; rows with a null id are documents like any other, and null counts as larger than every other id.

Similarity. `similar_documents` takes a radius and links by fingerprints and BK-trees as above first; without one it uses no fingerprints. It links the texts whose sets of word shingles have a Jaccard similarity of
`similarity` or more, all of them and no others (shingles are told apart by 64-bit hashes). Shingles have one global order, those that
are frequent in some texts last and the others by hash; any order gives the same links, this one keeps shards small. Two such
sets share one of their first n - ceil(similarity * n) + 1 shingles, so each of these is a shard key (prefix filter). First shingles
are most of what is shuffled, so they travel packed, a row for each task and bucket of shards. Shards of up to MAX_PAIRED members give
all their pairs whose lengths and places in the order still allow the similarity. In larger ones the members are first paired with the
one before them, in an order by hash that is another one in every shard, which joins most of a large group of near copies; then all
pairs are compared that these links left in different components. Pairs that fingerprints have joined are not compared. Bitmaps come
before the sets: a set's bitmap says of each of PARITY parts of all hashes whether it holds an odd number of them, and two sets differ
in at least as many shingles as their bitmaps in bits, folded or not. What the first shingles leave possible is counted on the whole
sets before it links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaframe.session import cut, free, prepare, spread

SEED = 42
#: Stands for a null id; larger than every other.
NO_ID = (1 << 63) - 1
#: Largest number of fingerprints in one tree before its shard is cut again.
MAX_SHARD = 4096
_LANES = np.uint64(0x0101010101010101)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; byte lanes count 255 hashes at a time."""
    n, bits = len(hashes), 0
    starts = np.arange(0, n, 255)
    for k in range(8):
        lanes = (hashes >> np.uint64(k)) & _LANES
        sums = np.add.reduceat(lanes, starts) if n > 255 else lanes.sum(keepdims=True)
        counts = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for j in np.flatnonzero(2 * counts > n):
            bits |= 1 << (8 * int(j) + k)
    return bits


def fingerprint(text: str | None, shingle: int = 3, bits: int = 64) -> int:
    """The unsigned fingerprint of a whole text."""
    words = words_of(text)
    if not words:
        return 0
    parts = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))) if len(words) >= shingle else [b" ".join(words)]
    out = 0
    for k in range(bits // 64):
        out |= majority(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED + k)), np.uint64, len(parts))) << 64 * k
    return out


class BKTree:
    """Children are keyed by the integer Hamming distance to their parent."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.kids: list[dict[int, int]] = []

    def near_then_add(self, key: int, radius: int) -> list[int]:
        """Positions of keys within the radius, then the key's own insertion."""
        near, keys, kids = [], self.keys, self.kids
        stack = [0] if keys else []
        while stack:
            at = stack.pop()
            d = (keys[at] ^ key).bit_count()
            if d <= radius:
                near.append(at)
            for edge, child in kids[at].items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)
        at = 0
        while keys:
            d = (keys[at] ^ key).bit_count()
            if d not in kids[at]:
                kids[at][d] = len(keys)
                break
            at = kids[at][d]
        keys.append(key)
        kids.append({})
        return near


def shard_edges(keys: list[int], ids: list[int], radius: int) -> list[tuple[int, int]]:
    """(id, smallest id linked to it within this shard), for members that aren't the smallest."""
    if len(keys) == 2:
        return [(max(ids), min(ids))] if (keys[0] ^ keys[1]).bit_count() <= radius else []
    parent = list(range(len(keys)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree = BKTree()
    for i, key in enumerate(keys):
        for j in tree.near_then_add(key, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i, x in enumerate(ids):
        r = root(i)
        least[r] = min(least.get(r, x), x)
    return [(x, least[root(i)]) for i, x in enumerate(ids) if x != least[root(i)]]


def _longs(mask: int, bits: int) -> list[int]:
    """The 64-bit parts of a mask as Spark's signed longs, lowest first."""
    parts = [mask >> 64 * k & (1 << 64) - 1 for k in range(bits // 64)]
    return [p - (1 << 64) if p >> 63 else p for p in parts]


def _parts(places: list[int], n: int) -> list[int]:
    """n masks that cut the given bit places into runs of about equal length."""
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(places, dtype=object), n) if len(part)]


def exact_masks(radius: int, bits: int) -> list[int]:
    """Masks such that any two fingerprints within the radius agree under at least one."""
    return [sum(c) for c in combinations(_parts(list(range(bits)), radius + 2), 2)]


def finer_masks(mask: int, radius: int, bits: int) -> list[int]:
    """The same among the bits that a mask leaves."""
    return [mask | p for p in _parts([b for b in range(bits) if not mask >> b & 1], radius + 1)]


def _fingerprints(shingle: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = bits // 64
        for batch in batches:
            fps = [_longs(fingerprint(t, shingle, bits), bits) for t in batch.column(1).to_pylist()]
            cols = [pa.array([f[k] for f in fps], pa.int64()) for k in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["id", *(f"w{k}" for k in range(n))])

    return run


def _trees(radius: int, n: int):
    """Over rows (key, w..., id) sorted by shard key: one tree a shard; a shard may go over several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, keys, ids = None, [], []
        out: list[tuple[int, int]] = []

        def flush() -> pa.RecordBatch:
            a = np.array(out, dtype=np.int64).reshape(-1, 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            full = cols[1].view(np.uint64).tolist()
            for k in range(1, n):
                full = [a | b << 64 * k for a, b in zip(full, cols[1 + k].view(np.uint64).tolist(), strict=True)]
            shard = cols[0]
            starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])).tolist() if len(shard) else []
            all_ids = cols[-1].tolist()
            for at, end in zip(starts, [*starts[1:], len(full)], strict=True):
                if shard[at] != held_key:
                    if len(keys) > 1:
                        out += shard_edges(keys, ids, radius)
                    held_key, keys, ids = shard[at], [], []
                keys += full[at:end]
                ids += all_ids[at:end]
            if len(out) > 50_000:
                yield flush()
        if len(keys) > 1:
            out += shard_edges(keys, ids, radius)
        if out:
            yield flush()

    return run


def links(nodes: DataFrame, radius: int, bits: int, masks: list[int], exact: bool) -> DataFrame:
    """Edges (a, b) between node ids whose closure is that of all links; nodes: w0.., id, one row a fingerprint."""
    n = bits // 64
    words, shard = [f"w{k}" for k in range(n)], [f"s{k}" for k in range(n)]
    dealt = lambda df: df.select("mask", *[F.col(w).bitwiseAND(F.col("mask")[k]).alias(s) for k, (w, s) in enumerate(zip(words, shard, strict=True))], *words, "id")
    literal = lambda ms: F.array(*[F.array(*[F.lit(x) for x in _longs(m, bits)]) for m in ms])
    todo = dealt(nodes.withColumn("mask", F.explode(literal(masks))))
    ready = None
    for depth in range(3 if exact else 0):
        sizes = todo.groupBy("mask", *shard).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = todo.join(sizes, ["mask", *shard])
        small = sized if depth == 2 else sized.filter(F.col("n") <= MAX_SHARD)
        ready = small.drop("n") if ready is None else ready.unionByName(small.drop("n"))
        if depth < 2:
            finer = {m: finer_masks(m, radius, bits) for m in masks}
            table = F.create_map(*[x for m, subs in finer.items() for x in (F.array(*map(F.lit, _longs(m, bits))), literal(subs))])
            todo = dealt(sized.filter(F.col("n") > MAX_SHARD).withColumn("mask", F.explode(table[F.col("mask")])))
            masks = sorted({s for subs in finer.values() for s in subs})
    # One number stands for a shard; should two shards share it, their trees are one, and distances still decide.
    rows = (todo if ready is None else ready).select(F.xxhash64("mask", *shard).alias("key"), *words, "id")
    sorted_rows = rows.repartition("key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(_trees(radius, n), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root): the smallest member of each edge's component, by alternating large and small stars.

    Each round is a few joins and minima with partial aggregation; a star's hub never gathers its neighbours in one task.
    """
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # A star forest is the end: every node has one neighbour below it, and no node is both above and below another.
        stats = edges.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("d")).first()
        if stats.n == stats.d and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            return edges.select("a", F.col("b").alias("root"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = cut(small)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int, radius: int) -> DataFrame:
    prepare(docs.sparkSession)
    words = [f"w{k}" for k in range(bits // 64)]
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    fps = cut(spread(rows).mapInArrow(_fingerprints(shingle, bits), ", ".join(["id long", *(f"{w} long" for w in words)])))
    nodes = fps.groupBy(*words).agg(F.min("id").alias("id"))
    roots = components(links(nodes, radius, bits, exact_masks(radius, bits), True))
    named = nodes.join(roots.withColumnRenamed("a", "id"), "id", "left").select(*words, F.coalesce("root", "id").alias("component"))
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return fps.join(named, words).select(back("id"), *words, back("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """id, fp (64 bits as a signed long), component (smallest id reachable over links of at most `radius` bits; no link is missed)."""
    if not 0 <= radius <= 3:
        raise ValueError("shards of agreeing blocks are small for a radius of 3 at most; see similar_documents")
    return _grouped(docs, id_col, text_col, shingle, 64, radius).withColumnRenamed("w0", "fp")


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, ascending."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    parts = set(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))) if len(words) >= shingle else {b" ".join(words)}
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts)))


def _digest(hashes: np.ndarray) -> int:
    """Names a set; a signed long."""
    h = xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED)
    return h - (1 << 64) if h >> 63 else h


#: Bits of a set's bitmap.
PARITY = 1024


def parity(hashes: np.ndarray) -> bytes:
    """A bit for each part of all hashes: whether the set holds an odd number of them."""
    return np.packbits(np.bincount((hashes >> np.uint64(7)).astype(np.int64) % PARITY, minlength=PARITY).astype(np.uint8) & 1).tobytes()


def _all_shingles(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text, shingle).view(np.int64))], names=["h"])

    return run


def _heads(shingle: int, similarity: float, frequent: np.ndarray, rank: np.ndarray, marked: bool):
    """Rows (id, key, text) as (id, key, digest, size, bitmap, first shingles in the global order, fingerprint if `marked`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ds, ns, bits, heads, w0 = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, shingle)
                n = len(s)
                w0 += _longs(fingerprint(text), 64) if marked else [None]
                ds.append(_digest(s))
                ns.append(n)
                bits.append(parity(s))
                if n and len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    s = s[np.argsort(np.where(frequent[at] == s, rank[at], 0), kind="stable")]
                heads.append(s[: n - ceil(similarity * n - 1e-9) + 1].view(np.int64))
            cols = [pa.array(ds, pa.int64()), pa.array(ns, pa.int64()), pa.array(bits, pa.binary()), pa.array(heads, pa.list_(pa.int64())), pa.array(w0, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["id", "key", "d", "n", "bits", "heads", "w0"])

    return run


#: Bytes of a packed first shingle: key, set, low and high half of the set's size, place.
PACKED = 5 + 8 + 2 + 2 + 2
#: First shingles that a task packs at once, and about as many in a bucket at most.
PACK = 1 << 20


def _packed(buckets: int):
    """Rows (d, n, first shingles) as (bucket, packed): 40 bits of a shingle are its key in its bucket; places above 65,535 count as that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            d, n, h, p = (np.concatenate(x) for x in zip(*held, strict=True))
            bucket, key = h % np.uint64(buckets), h // np.uint64(buckets) & np.uint64((1 << 40) - 1)
            order = np.argsort(bucket, kind="stable")
            starts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) > 0]))
            names, out = bucket[order][starts].astype(np.int64), []
            for at, end in zip(starts, [*starts[1:], len(order)], strict=True):
                o = order[at:end]
                planes = (key[o].view(np.uint8).reshape(-1, 8)[:, :5].copy(), d[o], n[o].astype(np.uint16), (n[o] >> 16).astype(np.uint16), p[o])
                out.append(b"".join(x.tobytes() for x in planes))
            for at in range(0, len(out), 256):
                yield pa.RecordBatch.from_arrays([pa.array(names[at : at + 256]), pa.array(out[at : at + 256], pa.binary())], names=["bucket", "packed"])

        for batch in batches:
            d, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            h = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            held.append((np.repeat(d, sizes), np.repeat(n, sizes), h, np.minimum(places, 0xFFFF).astype(np.uint16)))
            size += len(h)
            if size >= PACK:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return run


def _unpacked(packed: bytes) -> tuple[np.ndarray, ...]:
    """key, d, n, p of a packed row."""
    m = len(packed) // PACKED
    key = np.zeros((m, 8), np.uint8)
    key[:, :5] = np.frombuffer(packed, np.uint8, 5 * m).reshape(m, 5)
    low, high, p = (np.frombuffer(packed, np.uint16, m, 13 * m + 2 * m * k).astype(np.int64) for k in range(3))
    return key.view(np.uint64).ravel(), np.frombuffer(packed, np.int64, m, 5 * m), low | high << 16, p


def _allowed(similarity: float, n: np.ndarray, rest: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sizes and what follows the first common shingle allow the similarity."""
    least = np.ceil(similarity / (1 + similarity) * (n[i] + n[j]) - 1e-9)
    return (np.minimum(rest[i], rest[j]) >= least) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)


def _shards(similarity: float, most: int, buckets: int):
    """Over rows (bucket, packed) sorted by bucket: (null, a, b, null) for pairs that may have the similarity, and (h, d, null, rest) for members of shards above `most`."""

    def resolve(bucket: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, d, n, p = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(key, kind="stable")
        again = key[order][1:] == key[order][:-1]
        order = order[np.concatenate([again, [False]]) | np.concatenate([[False], again])]
        # Copies of a text are one member; the smallest place allows most.
        order = order[np.lexsort((p[order], d[order], key[order]))]
        key, d, n, p = key[order], d[order], n[order], p[order]
        first = np.concatenate([[True], (key[1:] != key[:-1]) | (d[1:] != d[:-1])])[: len(key)]
        key, d, n, rest = key[first], d[first], n[first], (n - p)[first]
        if not len(key):
            return
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(key)]]))
        size = np.repeat(sizes, sizes)
        a, b = [], []
        # left[i]: members of i's shard from i on.
        left = np.repeat(starts + sizes, sizes) - np.arange(len(key))
        at = np.flatnonzero(size <= most)
        for k in range(1, most):
            at = at[left[at] > k]
            if not len(at):
                break
            i = at[_allowed(similarity, n, rest, at, at + k)]
            a.append(d[i])
            b.append(d[i + k])
        large = np.flatnonzero(size > most)
        if len(large):
            mixed = (d[large].view(np.uint64) ^ key[large] * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
            chain = large[np.lexsort((mixed ^ mixed >> np.uint64(29), key[large]))]
            i, j = chain[:-1], chain[1:]
            may = (key[i] == key[j]) & _allowed(similarity, n, rest, i, j)
            a.append(d[i[may]])
            b.append(d[j[may]])
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), none], names=["h", "a", "b", "rest"])
        if len(large):
            h = (key[large] * np.uint64(buckets) + np.uint64(bucket)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(d[large]), pa.nulls(len(large), pa.int64()), pa.array(rest[large])], names=["h", "a", "b", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != held:
                    if parts:
                        yield from resolve(held, parts)
                    held, parts = bucket, []
                parts.append(_unpacked(packed))
        if parts:
            yield from resolve(held, parts)

    return run


def folded(bits: bytes, n: int) -> bytes:
    """A bitmap cut in halves that are laid over each other while it has far more bits than a set of n may differ in."""
    width, x = PARITY, int.from_bytes(bits, "little")
    while width > 128 and n <= width * 0.6:
        width //= 2
        x = x >> width ^ x & (1 << width) - 1
    return x.to_bytes(width // 8, "little")


def _folded_rows(marks: np.ndarray):
    """Over rows (d, n, bits): the folded bitmaps of those marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(_marked(marks, batch.column(0)))
            bits = [folded(x, n) for x, n in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["d", "n", "bits"])

    return run


def bits_apart(x: bytes, y: bytes) -> int:
    """Bits in which two folded bitmaps differ, the longer one folded as far as the other."""
    if len(x) < len(y):
        x, y = y, x
    width, one = 8 * len(x), int.from_bytes(x, "little")
    while width > 8 * len(y):
        width //= 2
        one = one >> width ^ one & (1 << width) - 1
    return (one ^ int.from_bytes(y, "little")).bit_count()


def _close_bits(similarity: float):
    """Pairs (a, b) of rows (a, b, sizes of both added, bitmap of a, bitmap of b) whose bitmaps allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = (1 - similarity) / (1 + similarity)
        for batch in batches:
            n, x, y = (batch.column(i).to_pylist() for i in (2, 3, 4))
            yield batch.select([0, 1]).filter(pa.array([bits_apart(*v) <= most * m + 1e-9 for m, *v in zip(n, x, y, strict=True)], pa.bool_()))

    return run


def _marks(keys: DataFrame) -> np.ndarray:
    """Bits at the places (modulo MARKS) of the long column `key`: a set of bounded size that holds all keys, and others."""
    at = F.pmod("key", F.lit(MARKS))
    found = keys.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros((MARKS // 32768 + 2, 4096), np.uint8)
    for r in found:
        out[r.k] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _marked(marks: np.ndarray, keys: pa.Array) -> pa.Array:
    """Which keys may be among those marked."""
    at = keys.to_numpy(zero_copy_only=False) % MARKS
    # Spark's bucket 0 holds place 0 alone, bucket 1 the places from 1 on.
    bucket, bit = np.where(at > 0, 1 + (at - 1) // 32768, 0), np.where(at > 0, (at - 1) % 32768, 0)
    return pa.array((marks[bucket, bit // 8] >> (bit % 8).astype(np.uint8) & 1).astype(bool))


def _marked_rows(marks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(_marked(marks, batch.column(0)))

    return run


def _held_sets(marks: np.ndarray, shingle: int):
    """Over rows (key, text): the sets of those whose key is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in batch.column(1).filter(_marked(marks, batch.column(0))).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["d", "bytes"])

    return run


def _alike(similarity: float):
    """Pairs (a, b, set of a, set of b) that have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def _crossing(similarity: float):
    """Over rows (h, d, n, rest, r, bits) sorted by h: pairs of a shard's members of different components r that may have the similarity."""

    def pairs(parts: list[tuple[np.ndarray, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        d, n, rest, r = np.concatenate([x for x, _ in parts], axis=1)
        bits = np.frombuffer(b"".join(b for _, bs in parts for b in bs), np.uint64).reshape(len(d), -1)
        for i in range(len(d) - 1):
            at = i + 1 + np.flatnonzero(r[i] != r[i + 1 :])
            at = at[_allowed(similarity, n, rest, i, at)]
            if len(at):
                differ = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
                at = at[differ <= (1 - similarity) / (1 + similarity) * (n[i] + n[at]) + 1e-9]
            other = d[at]
            if len(other):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(d[i], other)), pa.array(np.maximum(d[i], other))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, parts = None, []
        for batch in batches:
            h, *rest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            bits = batch.column(5)
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])).tolist() if len(h) else []
            for at, end in zip(starts, [*starts[1:], len(h)], strict=True):
                if h[at] != held_key:
                    if parts:
                        yield from pairs(parts)
                    held_key, parts = h[at], []
                parts.append((np.stack([c[at:end] for c in rest]), bits[at:end].to_pylist()))
        if parts:
            yield from pairs(parts)

    return run


#: Texts (about; one in ORDER_SHARE of larger tables) and shingles that the global order looks at; they set the size of shards, not the links.
ORDER_TEXTS, ORDER_SHARE, ORDER_SHINGLES = 2000, 25, 300_000
#: Members of a shard that gives all its pairs at once.
MAX_PAIRED = 64
#: Places of a set of keys that is sent to all workers.
MARKS = 1 << 24


def _order(shingles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, ascending, and their ranks from 1 by frequency: at most ORDER_SHINGLES, of those in more than two texts."""
    counted = cut(shingles.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 2"))
    least, room = 3, ORDER_SHINGLES
    for r in counted.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).collect():
        room -= r.k
        if room < 0:
            least = r.n + 1
            break
    held = counted.filter(F.col("n") >= least).toArrow()
    h, n = (held.column(c).to_numpy().astype(np.int64) for c in ("h", "n"))
    by_hash = np.argsort(h.view(np.uint64))
    h, n = h.view(np.uint64)[by_hash], n[by_hash]
    rank = np.empty(len(h), np.int64)
    rank[np.lexsort((h, n))] = np.arange(1, len(h) + 1)
    return h, rank


def row_key(id_col, text_col):
    """Names a row by its id and text; rows equal in both share it."""
    return F.xxhash64(F.coalesce(id_col.cast("long"), F.lit(NO_ID)), text_col.cast("string"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int | None = None, most: int = MAX_PAIRED) -> DataFrame:
    """id, component, key, first: a row's id, the smallest id reachable over pairs of texts whose shingle sets have at least the given
    Jaccard similarity, the row's `row_key`, and that of the component's first row (smallest id, then key).

    With a radius the fingerprints of `near_duplicates` come first: texts that their BK-trees link at `radius` or fewer bits are linked,
    and the sets are compared where these links left texts in different components. Shards of up to `most` members give all their pairs at once."""
    if radius is not None and not 0 <= radius <= 3:
        raise ValueError("shards of agreeing blocks are small for a radius of 3 at most")
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    n_rows = docs.count()
    some = rows.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(max(1, min(ORDER_SHARE, n_rows // ORDER_TEXTS)))) == 0)
    frequent, rank = _order(some.mapInArrow(_all_shingles(shingle), "h long"))
    rows = rows.select("id", row_key(F.col("id"), F.col("text")).alias("key"), "text")
    found = cut(spread(rows).mapInArrow(_heads(shingle, similarity, frequent, rank, radius is not None), "id long, key long, d long, n long, bits binary, heads array<long>, w0 long"))
    named = cut(found.groupBy("d").agg(F.min(F.struct("id", "key")).alias("row")).select("d", "row.*"))
    n_firsts = found.agg(F.sum(F.size("heads")).alias("n")).first().n or 0
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_firsts // PACK + 1)
    by_bucket = lambda df: df.repartition("bucket").sortWithinPartitions("bucket")
    # No name holds the frames before a cut, else their shuffle files stay.
    shared = cut(by_bucket(found.select("d", "n", "heads").mapInArrow(_packed(buckets), "bucket long, packed binary")).mapInArrow(_shards(similarity, most, buckets), "h long, a long, b long, rest long"))
    free(docs.sparkSession)
    # What two sets must have in common, and what they can have: what their first shingles do, and either's rest.
    least = lambda n, m: F.ceil(similarity / (1 + similarity) * (n + m) - 1e-9)
    either = lambda df: df.select(F.col("a").alias("d")).unionByName(df.select(F.col("b").alias("d"))).distinct()

    def with_both(pairs: DataFrame, of: DataFrame) -> DataFrame:
        """Pairs with the columns of both members as structs x and y; each member is in `of` once."""
        side = lambda d, c: of.select(F.col("d").alias(d), F.struct(*[k for k in of.columns if k != "d"]).alias(c))
        return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that have the similarity: bitmaps first, then first shingles, then whole sets."""
        pairs = cut(pairs.distinct())
        marks = _marks(either(pairs).withColumnRenamed("d", "key"))
        bits = found.select("d", "n", "bits").mapInArrow(_folded_rows(marks), "d long, n long, bits binary").dropDuplicates(["d"])
        near = with_both(pairs, bits).select("a", "b", (F.col("x.n") + F.col("y.n")).alias("n"), F.col("x.bits").alias("x"), F.col("y.bits").alias("y"))
        pairs = cut(near.mapInArrow(_close_bits(similarity), "a long, b long"))
        marks = _marks(either(pairs).withColumnRenamed("d", "key"))
        firsts = cut(found.select("d", "n", "heads").mapInArrow(_marked_rows(marks), "d long, n long, heads array<long>").dropDuplicates(["d"]))
        rest = lambda c: F.col(f"{c}.n") - F.size(f"{c}.heads")
        can = F.size(F.array_intersect("x.heads", "y.heads")) + F.greatest(rest("x"), rest("y"))
        pairs = cut(with_both(pairs, firsts).filter(can >= least(F.col("x.n"), F.col("y.n"))).select("a", "b"))
        marks = _marks(named.join(either(pairs), "d", "left_semi").select("key"))
        sets = cut(rows.select("key", "text").mapInArrow(_held_sets(marks, shingle), "d long, bytes binary").dropDuplicates(["d"]))
        both = with_both(pairs, sets).select("a", "b", F.col("x.bytes").alias("x"), F.col("y.bytes").alias("y"))
        alike = cut(both.mapInArrow(_alike(similarity), "a long, b long"))
        free(docs.sparkSession)
        return alike

    pairs, near = shared.filter("h is null").select("a", "b").distinct(), None
    if radius is not None:
        # One row a fingerprint goes into the trees; what shares one is linked to its smallest digest. Equal sets may differ in fingerprints.
        marked = cut(found.select("w0", "d").distinct())
        nearest = marked.groupBy("w0").agg(F.min("d").alias("id"))
        alike = marked.join(nearest, "w0").select(F.greatest("d", "id").alias("a"), F.least("d", "id").alias("b")).filter("a <> b")
        near = components(alike.unionByName(links(nearest, radius, 64, exact_masks(radius, 64), True)))
        free(docs.sparkSession)
        x, y = (near.select(F.col("a").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
        pairs = pairs.join(x, "a", "left").join(y, "b", "left").filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    chains = verified(pairs)
    if near is not None:
        chains = chains.unionByName(near.select("a", F.col("root").alias("b")))
        del marked, nearest, alike, x, y
    del pairs
    joined = roots = components(chains).withColumnRenamed("a", "d")
    large = shared.filter("h is not null").select("h", F.col("a").alias("d"), "rest")
    if not large.isEmpty():
        placed = large.join(joined, "d", "left").select("h", "d", "rest", F.coalesce("root", "d").alias("r"))
        # Bitmaps travel with members of shards of two components or more alone.
        open_shards = placed.groupBy("h").agg(F.min("r").alias("x"), F.max("r").alias("y")).filter("x < y").select("h")
        bits = found.groupBy("d").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
        placed = placed.join(open_shards, "h", "left_semi").join(bits, "d").select("h", "d", "n", "rest", "r", "bits")
        crossing = placed.repartition("h").sortWithinPartitions("h").mapInArrow(_crossing(similarity), "a long, b long")
        more = verified(crossing)
        if not more.isEmpty():
            roots = components(joined.select(F.col("d").alias("a"), F.col("root").alias("b")).unionByName(more)).withColumnRenamed("a", "d")
        del placed, open_shards, bits, crossing
    free(docs.sparkSession)
    rooted = named.join(roots, "d", "left").select("d", "id", "key", F.coalesce("root", "d").alias("r"))
    first = rooted.groupBy("r").agg(F.min(F.struct("id", "key")).alias("f")).select("r", F.col("f.id").alias("component"), F.col("f.key").alias("first"))
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return found.select("id", "d", "key").join(rooted.select("d", "r").join(first, "r"), "d").select(back("id"), back("component"), "key", "first")


def hex_of(fp):
    """16 lowercase hex digits of a signed long column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
