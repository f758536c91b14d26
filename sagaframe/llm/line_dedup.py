"""Line dedup (operator 6): content-defined chunks of lines that repeat anywhere in the table.

Lines have hashes; a rolling hash over the hashes of the last ROLL lines ends a chunk where it falls on a fixed residue, so
boundaries move along with inserted or removed lines and the same passage is cut alike in every text. A line of LONG words or more
always is a chunk of its own. A chunk may be removed if it has MIN_LINES lines or LONG words, and any words at all.

Chunks end where the lines around a passage say, so short passages may share none. Windows find these: from every line with words
on, and up to every such line, the fewest lines that hold LONG words. They depend on no line outside, and a repeated passage of LONG
words or more is the union of those within it, so all of its lines go.

Only chunks and windows whose hash occurs twice or more are looked at again. The SHA-256 of their bytes is compared: rows are grouped
by hash and digest with partial aggregation, so a passage in a third of all texts is one row a task. The first document (smallest id)
keeps its first copy; all other copies go, there and elsewhere. Of a window that overlaps its first copy the lines after that go.

Defined results: null texts stay null and empty ones empty; a text all of whose chunks are copies becomes empty; rows with the same
id are taken as one document, each row keeping the first copies; null ids are one document that comes last; very long texts are
cut like others, and so are long runs without a boundary, as equal lines may make: one chunk; an empty table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sagaframe.session import cut, prepare, spread

ROLL = 2
RESIDUE = 3
MIN_LINES = 2
LONG = 50
NO_ID = (1 << 63) - 1
_ID, _PLAN = "__chunk_id", "__chunk_plan"
_PRIME = 0x9E3779B97F4A7C15
_FULL = (1 << 64) - 1


def chunks(text: str | None) -> list[tuple[int, int, bytes]]:
    """(first line, end line, bytes) of the chunks that may be removed."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    hashes = list(map(xxhash.xxh3_64_intdigest, lines))
    counts = [len(line.split()) for line in lines]
    out, start, words = [], 0, 0

    def close(end: int) -> None:
        if end > start and words and (end - start >= MIN_LINES or words >= LONG):
            out.append((start, end, b"\n".join(lines[start:end])))

    for i, n in enumerate(counts):
        if n >= LONG:
            close(i)
            start, words = i, n
            close(i + 1)
            start, words = i + 1, 0
            continue
        words += n
        if i + 1 - start < MIN_LINES:
            continue
        rolled = 0
        for h in hashes[i + 1 - ROLL : i + 1]:
            rolled = (rolled * _PRIME + h) & _FULL
        if (rolled >> 17) % RESIDUE == 0:
            close(i + 1)
            start, words = i + 1, 0
    close(len(lines))
    return out


def _hash(chunk: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(chunk, 6)
    return h - (1 << 64) if h >> 63 else h


def windows(counts: list[int]) -> list[tuple[int, int]]:
    """(first line, end line) of the shortest runs of two lines or more that start or end at a line with words and hold LONG words."""
    at = [i for i, n in enumerate(counts) if n]
    out, end, words = set(), 0, 0
    for k, i in enumerate(at):  # the fewest lines from i on
        while end < len(at) and words < LONG:
            words += counts[at[end]]
            end += 1
        if words < LONG:
            break
        if end > k + 1:
            out.add((i, at[end - 1] + 1))
        words -= counts[i]
    start, words = 0, 0
    for k, j in enumerate(at):  # the fewest lines up to j
        words += counts[j]
        while words - counts[at[start]] >= LONG:
            words -= counts[at[start]]
            start += 1
        if words >= LONG and start < k:
            out.add((at[start], j + 1))
    return sorted(out)


def pieces(text: str | None) -> tuple[list[bytes], list[tuple[int, int, int, bool]]]:
    """The lines, and (first line, end line, hash, whether a chunk) of chunks and windows."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines)).tobytes()
    found = [(a, b, _hash(c), True) for a, b, c in chunks(text)]
    return lines, found + [(a, b, _hash(hashes[8 * a : 8 * b]), False) for a, b in windows([len(line.split()) for line in lines])]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hs, ns = [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found: dict[int, int] = {}
            for _, _, h, _ in pieces(text)[1]:
                found[h] = found.get(h, 0) + 1
            ids += [i] * len(found)
            hs += found
            ns += found.values()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hs, pa.int64()), pa.array(ns, pa.int64())], names=["id", "h", "n"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of the chunks and windows that a row's plan names."""
    for batch in batches:
        rows: list[tuple[int, int, bytes]] = []
        for i, text, plan in zip(*(batch.column(k) for k in range(3)), strict=True):
            i, wanted = i.as_py(), set(plan.as_py())
            lines, found = pieces(text.as_py())
            rows += [(h, i, hashlib.sha256(b"\n".join(lines[a:b])).digest()) for a, b, h, _ in found if h in wanted]
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["h", "id", "digest"])


def without(text: str, own: int, plan: dict[int, list[tuple[bytes, int]]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the copies its plan names (hash: digest and keeper), and the spans of lines that went: chunks, then single lines."""
    spans, gone, first = [], set(), {}
    raw, found = pieces(text)
    for start, end, h, chunk in found:
        for digest, keeper in plan.get(h, ()):
            if hashlib.sha256(b"\n".join(raw[start:end])).digest() == digest:
                # The end of the first copy here; copies that stay elsewhere protect no line.
                kept = first.setdefault((h, digest), end) if keeper == own else 0
                if chunk and kept != end:
                    spans.append((start, end))
                gone.update(range(max(start, kept), end))
    if not gone:
        return text, []
    whole = {i for start, end in spans for i in range(start, end)}
    lines = text.split("\n")
    return "\n".join(line for i, line in enumerate(lines) if i not in gone), sorted(spans + [(i, i + 1) for i in gone - whole])


_SPANS = pa.list_(pa.struct([("line", pa.int64()), ("lines", pa.int64())]))


def _apply(text_at: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            # Plans become Python's row by row: those of a batch of long texts are large.
            for text, own, plan in zip(batch.column(text_at), batch.column(width), batch.column(width + 1), strict=True):
                text, gone = text.as_py(), []
                if text is not None and plan.is_valid and len(plan):
                    known: dict[int, list[tuple[bytes, int]]] = {}
                    for h, digest, keeper in zip(*(plan.values.field(k).to_pylist() for k in ("h", "digest", "keeper")), strict=True):
                        known.setdefault(h, []).append((bytes(digest), keeper))
                    text, gone = without(text, own.as_py(), known)
                texts.append(text)
                spans.append([{"line": a, "lines": b - a} for a, b in gone])
            cols = [pa.array(texts, pa.string()) if k == text_at else batch.column(k) for k in range(width)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(spans, _SPANS)], names=[*batch.schema.names[:width], "removed"])

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "removed") -> DataFrame:
    """All columns with the text rewritten, and last `removed_col`: array of (line, lines) in the old text."""
    prepare(docs.sparkSession)
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = spread(docs.select(own.alias("id"), F.col(text_col).alias("text")))
    occurring = cut(rows.mapInArrow(_hashes, "id long, h long, n long"))
    repeated = occurring.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    wanted = occurring.join(repeated, "h").groupBy("id").agg(F.collect_set("h").alias("plan"))
    held = rows.join(wanted, "id").mapInArrow(_digests, "h long, id long, digest binary")
    same = held.groupBy("h", "digest").agg(F.min("id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    decided = cut(same.select("h", "digest", "keeper"))
    plans = occurring.select("id", "h").join(decided, "h").groupBy("id").agg(F.collect_list(F.struct("h", "digest", "keeper")).alias(_PLAN)).withColumnRenamed("id", _ID)
    width, at = len(docs.columns), docs.columns.index(text_col)
    # Column names may repeat or clash: they are numbered while Python has them.
    plain = docs.toDF(*[f"c{k}" for k in range(width)]).withColumn(_ID, F.coalesce(F.col(f"c{docs.columns.index(id_col)}").cast("long"), F.lit(NO_ID)))
    joined = plain.join(plans, _ID, "left").select(*[f"c{k}" for k in range(width)], _ID, _PLAN)
    span = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("lines", T.LongType())]))
    out = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema)] + [T.StructField("removed", span)])
    return joined.mapInArrow(_apply(at, width), out).toDF(*docs.columns, removed_col)
