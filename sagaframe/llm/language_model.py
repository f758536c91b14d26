"""LM scoring (operator 3): an interpolated modified Kneser-Ney model of word pairs, counted in Spark over the whole training set.

Counting. Workers hash words to 64 bits and count pairs in sorted arrays of up to FLUSH tokens before anything is shuffled; a blob a
shard goes out, with each context once and small counts in one byte. The number of shards follows the tokens, PER_SHARD each as a hash
sample estimates them, so that the merge of a shard takes some tens of MB however large the table is. Pairs are sharded by their first word, so the sums of a context meet in one place; contexts so frequent that their
pairs would fill a shard are sharded by both words instead, and their sums, few rows each, are added up afterwards. Which contexts
those are is estimated on a hash sample: it decides where a pair is counted, never what is counted. There are at most 2 S of them.

Storage. Each shard is written to the shared folder as sorted hash arrays: pairs and counts; contexts with their total and their
numbers of followers seen once, twice and more often; words and the numbers of their different predecessors.
Files appear whole by renaming, with the same content whichever attempt wrote them, so lost executors cost only their tasks.

Scoring. Workers map the arrays into memory, one shard at a time, and look up the sorted queries of some million tokens at once. Where
the shared folder is no mounted path, a shard is fetched to an unlinked temporary file for that time.

    P(w | h) = (c(h w) - D[c(h w)]) / c(h) + g(h) P(w),   P(w) = (n(. w) - D'[n(. w)]) / n(. .) + g' / (V + 1)

with the three discounts of each order from its counts of counts. The base score is add-one smoothing of single words.

Defined results: null and empty texts are one end token; a null id counts as the empty text for the split; an empty training set gives
zero counts, and every score is that of the uniform distribution over V + 1 = 1 words; very long texts are scored whole; repeated
rows are learnt from and scored each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaframe.session import cut, prepare, shared_folder, spread

#: Tokens that a worker holds at once, when it counts and when it scores.
FLUSH = 1_000_000
#: Tokens whose pairs a shard holds, about.
PER_SHARD = 2_000_000
#: One text of so many, by hash, estimates the number of tokens and the frequent contexts.
SAMPLED = 97
BEGIN, END = np.uint64(0xB16B00B5C0FFEE01), np.uint64(0xE0D0F7E87B16C0DE)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> U64(31))) * _A
    return x ^ (x >> U64(29))


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _B + mix(b))


def hashes(text: str | None) -> np.ndarray:
    """Hashes of the words, then the end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, dtype=U64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    out[-1] = END
    return out


def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, tokens, first token of each text)."""
    tokens = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    contexts = np.empty_like(tokens)
    contexts[1:] = tokens[:-1]
    contexts[starts] = BEGIN
    return contexts, tokens, starts


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, sums of their values, the place of one row of each)."""
    order = np.argsort(keys)
    s = keys[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, dtype=np.int64)
    return s[first], np.add.reduceat(values[order], first) if len(s) else values[:0], order[first]


def shard_of(contexts: np.ndarray, keys: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    by = mix(contexts)
    if len(hot):
        by = np.where(np.isin(contexts, hot), keys, by)
    return ((by >> U64(20)) % U64(shards)).astype(np.int64)


def word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(words) >> U64(20)) % U64(shards)).astype(np.int64)


def _split(shard: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(shard, kind="stable")
    s = shard[order]
    starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else []
    for a, b in zip(starts, [*starts[1:], len(s)], strict=True):
        yield int(s[a]), [x[order[a:b]] for x in arrays]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, n, _ = summed(c := np.concatenate([hashes(t) for t in batch.column(0).to_pylist()] or [np.zeros(0, U64)]), np.ones(len(c), dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["w", "n"])


def packed(n: np.ndarray) -> list[np.ndarray]:
    """Counts as one byte each; those of 255 and more stand apart, with their places."""
    large = np.flatnonzero(n >= 255)
    return [np.minimum(n, 255).astype(np.uint8), large.astype(np.int64), n[large].astype(np.int64)]


def unpacked(small: np.ndarray, large: np.ndarray, values: np.ndarray) -> np.ndarray:
    n = small.astype(np.int64)
    n[large] = values
    return n


def to_bytes(*arrays: np.ndarray) -> bytes:
    """Their lengths, then the arrays, each at a multiple of eight bytes."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], dtype=np.int64).tobytes()
    return b"".join([head, *(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays)])


def from_bytes(data, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, 1 + len(kinds))[1:]
    at, out = 8 * (1 + len(kinds)), []
    for kind, n in zip(kinds, sizes.tolist(), strict=True):
        out.append(np.frombuffer(data, kind, n, at))
        at += -(-n * np.dtype(kind).itemsize // 8) * 8
    return out


_PACKED = (np.uint8, np.int64, np.int64)
_BLOB = "shard long, data binary"


def blob(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs sorted by context: contexts and the numbers of their followers, followers, counts."""
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    followers = np.diff(np.concatenate([first, [len(a)]]))
    return to_bytes(a[first], followers.astype(np.uint32), b, *packed(n))


def pairs_of(data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, followers, b, *n = from_bytes(data, U64, np.uint32, U64, *_PACKED)
    return np.repeat(a, followers), b, unpacked(*n)


def _count(hot: np.ndarray, shards: int):
    """Pairs counted in memory; a blob of (context, token, count) for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def flush() -> pa.RecordBatch:
            a, b, _ = joined(parts)
            keys, n, at = summed(pair_key(a, b), np.ones(len(a), dtype=np.int64))
            a, b = a[at], b[at]
            shards_, blobs = [], []
            for shard, (x, y, m) in _split(shard_of(a, keys, hot, shards), a, b, n):
                order = np.argsort(x)
                shards_.append(shard)
                blobs.append(blob(x[order], y[order], m[order]))
            return pa.RecordBatch.from_arrays([pa.array(shards_, pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "data"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                parts.append(hashes(text))
                held += len(parts[-1])
                if held >= FLUSH:
                    yield flush()
                    parts, held = [], 0
                    pa.default_memory_pool().release_unused()
        if parts:
            yield flush()

    return run


def _local(folder: str) -> str | None:
    """The path of a shared folder that is mounted, else None."""
    return folder.removeprefix("file://").removeprefix("file:") if folder.startswith(("file:", "/")) else None


def _store(folder: str, name: str, *arrays: np.ndarray) -> None:
    """One file of arrays; it appears whole, by renaming."""
    data = to_bytes(*arrays)
    own = f".{name}.{uuid.uuid4().hex}"
    if path := _local(folder):
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{own}", "wb") as f:
            f.write(data)
        os.replace(f"{path}/{own}", f"{path}/{name}")
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    with store.open_output_stream(f"{path}/{own}") as f:
        f.write(data)
    store.move(f"{path}/{own}", f"{path}/{name}")


@contextmanager
def _mapped(folder: str, name: str, *kinds: type):
    """The arrays of a file, mapped into memory; nothing stays open or on disk afterwards."""
    if path := _local(folder):
        f = open(f"{path}/{name}", "rb")  # noqa: SIM115
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        f = tempfile.TemporaryFile()  # has no name: gone with this block
        with store.open_input_stream(f"{path}/{name}") as source:
            while piece := source.read(1 << 22):
                f.write(piece)
        f.flush()
    with f:
        m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    yield from_bytes(m, *kinds)


def _found(keys: np.ndarray, sorted_keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """The packed counts (three arrays each) of keys, 0 where they are missing."""
    if not len(sorted_keys):
        return [np.zeros(len(keys), dtype=np.int64) for _ in counts[::3]]
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    known, out = sorted_keys[at] == keys, []
    for small, large, values in zip(counts[::3], counts[1::3], counts[2::3], strict=True):
        n = small[at].astype(np.int64)
        if len(large):
            big = np.flatnonzero(n == 255)
            n[big] = values[np.searchsorted(large, at[big])]
        out.append(np.where(known, n, 0))
    return out


_OUT = "kind string, shard long, data binary, stats array<long>"


def _shards(folder: str, hot: np.ndarray, shards: int):
    """Merges the blobs of each shard, stores its arrays, and sends on what concerns other shards."""

    def finish(shard: int, parts: list[bytes]) -> list[tuple]:
        a, b, n = (np.concatenate(x) for x in zip(*map(pairs_of, parts), strict=True))
        parts.clear()
        keys, n, at = summed(pair_key(a, b), n)
        a, b = a[at], b[at]
        _store(folder, f"pairs-{shard}", keys, *packed(n))
        del keys, at
        rows = [("counts", shard, None, [int((n == k).sum()) for k in (1, 2, 3, 4)])]
        order = np.argsort(a, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], a[order][1:] != a[order][:-1]]))
        contexts = a[order][first]
        total, ones, twos, more = (np.add.reduceat(x[order], first) for x in (n, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n >= 3).astype(np.int64)))
        own = ~np.isin(contexts, hot)
        _store(folder, f"contexts-{shard}", contexts[own], *(x for v in (total, ones, twos, more) for x in packed(v[own])))
        known = own & (contexts != BEGIN)
        rows.append(("words", shard, None, [int(known.sum()), int(total[known].sum())]))
        for i in np.flatnonzero(~own):
            rows.append(("hot", int(contexts[i].view(np.int64)), None, [int(total[i]), int(ones[i]), int(twos[i]), int(more[i])]))
        words, before, _ = summed(b, np.ones(len(b), dtype=np.int64))
        for s, (w, m) in _split(word_shard(words, shards), words, before):
            rows.append(("before", s, to_bytes(w, *packed(m)), None))
        return rows

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["kind", "shard", "data", "stats"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in _by_shard(batches):
            yield batch_of(finish(shard, parts))
            pa.default_memory_pool().release_unused()

    return run


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The blobs of one shard after another, over rows (shard, data) sorted by shard."""
    at, parts = None, []
    for batch in batches:
        for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if shard != at:
                if parts:
                    yield at, parts
                at, parts = shard, []
            parts.append(data.as_py())
    if parts:
        yield at, parts


def _words(folder: str):
    """Merges the numbers of predecessors of each word shard and stores them."""

    def finish(shard: int, parts: list[bytes]) -> tuple:
        found = [from_bytes(p, U64, *_PACKED) for p in parts]
        words, n, _ = summed(np.concatenate([f[0] for f in found]), np.concatenate([unpacked(*f[1:]) for f in found]))
        _store(folder, f"words-{shard}", words, *packed(n))
        return shard, [*(int((n == k).sum()) for k in (1, 2, 3, 4)), int((n >= 3).sum()), int(n.sum()), len(n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in _by_shard(batches):
            one, stats = finish(shard, parts)
            yield pa.RecordBatch.from_arrays([pa.array([one], pa.int64()), pa.array([stats], pa.list_(pa.int64()))], names=["shard", "stats"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """D[0..3] of modified Kneser-Ney from the counts of counts; where those are too few to tell, 0.5, 1 and 1.5."""
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0.0, 0.01, 0.01, 0.01], [0.0, 0.99, 1.99, 2.99])


class Model:
    """What a worker needs besides the arrays: small numbers, and the sums of the most frequent contexts."""

    def __init__(self, folder: str, shards: int, pair_stored: list[int], word_stored: list[int], hot: dict[int, list[int]], tokens: int, types: int, texts: int, pair_counts: list[int], word_stats: list[int]) -> None:
        self.folder, self.shards, self.tokens, self.types, self.texts = folder, shards, tokens, types, texts
        self.pair_stored, self.word_stored = frozenset(pair_stored), frozenset(word_stored)
        self.hot = np.array(sorted(hot), dtype=U64)
        self.hot_sums = np.array([hot[k] for k in sorted(hot)], dtype=np.int64).reshape(-1, 4)
        self.d = discounts(*pair_counts)
        self.e = discounts(*word_stats[:4])
        self.bigrams = word_stats[5]
        held = self.e[1] * word_stats[0] + self.e[2] * word_stats[1] + self.e[3] * word_stats[4]
        self.rest = held / self.bigrams if self.bigrams else 1.0

    def contexts(self, words: np.ndarray) -> np.ndarray:
        """Rows (total, followers seen once, twice, more often) of distinct sorted words."""
        out = np.zeros((len(words), 4), dtype=np.int64)
        for shard, (at,) in _split(word_shard(words, self.shards), np.arange(len(words))):
            if shard in self.pair_stored:
                with _mapped(self.folder, f"contexts-{shard}", U64, *4 * _PACKED) as (keys, *counts):
                    for k, v in enumerate(_found(words[at], keys, *counts)):
                        out[at, k] = v
        if len(self.hot):
            at = np.flatnonzero(np.isin(words, self.hot))
            out[at] = self.hot_sums[np.searchsorted(self.hot, words[at])]
        return out

    def before(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.int64)
        for shard, (at,) in _split(word_shard(words, self.shards), np.arange(len(words))):
            if shard in self.word_stored:
                with _mapped(self.folder, f"words-{shard}", U64, *_PACKED) as (keys, *counts):
                    (out[at],) = _found(words[at], keys, *counts)
        return out

    def pairs(self, contexts: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        for shard, (at,) in _split(shard_of(contexts, keys, self.hot, self.shards), np.arange(len(keys))):
            if shard in self.pair_stored:
                with _mapped(self.folder, f"pairs-{shard}", U64, *_PACKED) as (known, *counts):
                    (out[at],) = _found(keys[at], known, *counts)
        return out

    def score(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """For each text: tokens, known tokens, base score, model score."""
        a, b, starts = joined(parts)
        keys, n, at = summed(pair_key(a, b), np.ones(len(a), dtype=np.int64))  # each distinct pair is scored once
        x, y = a[at], b[at]
        words, place = np.unique(np.concatenate([x, y]), return_inverse=True)
        px, py = place[: len(x)], place[len(x) :]
        sums, before = self.contexts(words), self.before(words)
        single = np.where(words == END, self.texts, np.where(words == BEGIN, 0, sums[:, 0]))
        base = np.log10((single + 1) / (self.tokens + self.types + 1))
        low = (before - self.e[np.minimum(before, 3)]) / max(1, self.bigrams) + self.rest / (self.types + 1)
        c, total = self.pairs(x, keys), sums[px, 0]
        seen = total > 0
        total = np.maximum(total, 1)
        gap = np.where(seen, (sums[px, 1:] @ self.d[1:]) / total, 1.0)
        p = np.where(seen, (c - self.d[np.minimum(c, 3)]) / total, 0.0) + gap * low[py]
        full = np.empty(len(a), dtype=np.int64)  # from each token to its distinct pair
        order = np.argsort(pair_key(a, b))
        full[order] = np.repeat(np.arange(len(keys)), n)
        tokens = np.diff(np.concatenate([starts, [len(a)]]))
        add = lambda v: np.add.reduceat(v[full], starts)
        return [tokens, add((single[py] > 0).astype(np.int64)), add(base[py]), add(np.log10(p))]


_SCORES = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, parts, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            n, known, base, score = model.score(parts)
            cols = [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
            return pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in _SCORES.split(", ")])

        for batch in batches:
            for i, out, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                ids.append(i)
                held.append(out)
                parts.append(hashes(text))
                size += len(parts[-1])
                if size >= FLUSH:
                    yield flush()
                    ids, held, parts, size = [], [], [], 0
                    pa.default_memory_pool().release_unused()
        if parts:
            yield flush()

    return run


def train(texts: DataFrame, text_col: str = "text") -> Model:
    """A model of all rows of a frame."""
    spark = texts.sparkSession
    prepare(spark)
    rows = spread(texts.select(F.col(text_col).cast("string").alias("text")))
    folder = f"{shared_folder(spark)}/language-model-{uuid.uuid4().hex}"
    sampled = rows.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).mapInArrow(_frequent, "w long, n long")
    counted = cut(sampled.groupBy("w").agg(F.sum("n").alias("n")))
    most = counted.agg(F.sum("n").alias("n")).first().n or 0
    shards = max(8, -(-most * SAMPLED // PER_SHARD))
    hot = np.array([r.w for r in counted.filter(F.col("n") * 2 * shards > most).select("w").collect()], dtype=np.int64).view(U64)  # 2 * shards at most
    hot = np.union1d(hot[hot != END], np.array([BEGIN], dtype=U64))
    blobs = rows.mapInArrow(_count(hot, shards), _BLOB).repartition(shards, "shard").sortWithinPartitions("shard")
    merged = cut(blobs.mapInArrow(_shards(folder, hot, shards), _OUT))
    words = merged.filter("kind = 'before'").select("shard", "data").repartition(shards, "shard").sortWithinPartitions("shard")
    word_rows = cut(words.mapInArrow(_words(folder), "shard long, stats array<long>"))
    total = lambda df, k: [int(x or 0) for x in df.agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(k)]).first()]
    types, tokens = total(merged.filter("kind = 'words'"), 2)
    sums: dict[int, list[int]] = {}
    hot_rows = merged.filter("kind = 'hot'").groupBy("shard").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(4)]).collect()  # one a hot context
    for r in hot_rows:
        sums[int(np.int64(r.shard).view(U64))] = [int(x) for x in r[1:]]
    n_texts = sums.get(int(BEGIN), [0])[0]
    for word, s in sums.items():
        if word != int(BEGIN):
            types, tokens = types + 1, tokens + s[0]
    stored = lambda df: [r.shard for r in df.select("shard").distinct().collect()]
    return Model(
        folder, shards, stored(merged.filter("kind = 'counts'")), stored(word_rows), sums, tokens + n_texts, types + (n_texts > 0), n_texts,
        total(merged.filter("kind = 'counts'"), 4), total(word_rows, 7),
    )


def score(docs: DataFrame, model: Model, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, base_score, score: log10 probabilities of whole texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return spread(rows).mapInArrow(_score(model), _SCORES)
