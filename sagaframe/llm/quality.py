"""Quality rules (operator 1): a linear-chain conditional random field labels each line content or boilerplate.

The base counts come first: a text of under MIN_WORDS words, or one in which over MAX_REPEAT % of the words stand in repeated
8-word windows, has failed. For the others the best label sequence (Viterbi) over the lines decides: a document is kept if lines
labelled content hold at least the field's share of its words.

Training. Labels name documents, not lines, so the labels of lines are found by hard EM: lines start with the label of their document
and a field without moves is fitted; then every line gets its best label under the field, corrected where a document would contradict its
own label (a bad one keeps its least likely lines as boilerplate until content holds less than MIN_SHARE of its words, a good one the
reverse), and the field is fitted again, with moves, ROUNDS times. Bad documents thus hold lines of both kinds, and moves between kinds
are learnt. The share that decides is the one which parts the labelled documents best (balanced; MIN_SHARE where all do alike).

The field is fitted on the driver by gradient ascent on the exact likelihood (forward-backward), over the TRAIN_DOCS labelled documents
that come first by a hash of their id, half of each label, with all their lines (long texts as runs of SEGMENT lines); nothing else is
sampled. Of rows with one id the first by a hash of the text is taken. Without labels of both kinds a fixed prior that distrusts marks,
capitals, repeats and columns stands in.

Defined results: null and empty texts have no words and fail the base rules; lines without words have no label and no weight; very
long texts and lines are read whole; repeated rows give equal rows; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaframe.session import prepare, spread

MIN_WORDS = 20
MAX_REPEAT = 30
WINDOW = 8
MIN_SHARE = 0.5
TRAIN_DOCS = 1200
#: Lines of a training sequence; a longer text is several.
SEGMENT = 100
ROUNDS = 3
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGIT = bytes(range(0x30, 0x3A))
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1) for k in range(WINDOW)]
FEATURES = ("one", "symbols", "upper", "digits", "marks", "pipes", "repeats", "same_word", "short", "long_words", "seen", "stops")


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a WINDOW-word window found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))  # a word's id is its first place
    if len(first) == len(words):
        return 0
    u = ids.astype(np.uint64)
    h = u[:n] * _MIX[0]
    for k in range(1, WINDOW):
        h += (u[k : k + n] + np.uint64(k)) * _MIX[k]
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    a, b = order[:-1][same], order[1:][same]
    if any((ids[a + k] != ids[b + k]).any() for k in range(WINDOW)):  # two windows share a hash: count the windows themselves
        windows = Counter(zip(*(words[k : k + n] for k in range(WINDOW)), strict=True))
        starts = np.array([i for i, w in enumerate(zip(*(words[k : k + n] for k in range(WINDOW)), strict=True)) if windows[w] > 1], dtype=np.int64)
    else:
        starts = np.unique(np.concatenate([a, b]))
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    steps[starts] += 1
    np.subtract.at(steps, starts + WINDOW, 1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes], lines: list[bytes], length: int) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen = Counter(lines)
    dup = sum(n - 1 for line, n in seen.items() if n > 1 and line.split())
    word_chars = length - (len(text) - len(text.translate(None, SPACES)))
    return len(words), word_chars, len(text) - len(text.translate(None, SYMBOLS)), dup, repeated_words(words)


def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the lines that have words."""
    rows, weights, seen = [], [], set()
    for line in lines:
        words = line.split()
        n = len(words)
        if not n:
            continue
        size = len(line)
        upper = size - len(line.translate(None, _UPPER))
        lower = size - len(line.translate(None, _LOWER))
        rows.append((
            1.0,
            min(1.0, (size - len(line.translate(None, SYMBOLS))) / n),
            upper / (upper + lower + 1),
            min(1.0, 4 * (size - len(line.translate(None, _DIGIT))) / size),
            min(1.0, line.count(b"!") / n),
            min(1.0, 2 * words.count(b"|") / n),
            1 - len(set(words)) / n,
            float(n > 3 and any(a == b == c for a, b, c in zip(words, words[1:], words[2:], strict=False))),
            float(n < 4),
            min(1.0, size / n / 40),
            float(line in seen),
            float(line.rstrip()[-1:] in b".!?;:" if line.strip() else 0),
        ))
        weights.append(n)
        seen.add(line)
    return np.array(rows, dtype=np.float64).reshape(-1, len(FEATURES)), np.array(weights, dtype=np.int64)


class Field:
    """Two labels, 0 boilerplate and 1 content: weights by feature and label, and by pair of neighbouring labels."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, share: float = MIN_SHARE) -> None:
        self.weights, self.moves, self.share = weights, moves, share

    @classmethod
    def prior(cls) -> Field:
        # Label 1 less label 0, in the order of FEATURES.
        gain = np.array([3.0, -6.0, -5.0, -2.0, -6.0, -8.0, -4.0, -6.0, 0.0, -2.0, -0.5, 0.5])
        return cls(np.stack([-gain / 2, gain / 2], axis=1), np.array([[0.5, -0.5], [-0.5, 0.5]]))

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The best label of each line."""
        if not len(x):
            return np.zeros(0, dtype=np.int64)
        (m00, m01), (m10, m11) = self.moves.tolist()
        scores = (x @ self.weights).tolist()
        a, b = scores[0]
        back = []
        for s0, s1 in scores[1:]:
            from0, from1 = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = (a + m00 if from0 else b + m10) + s0, (a + m01 if from1 else b + m11) + s1
        label = 1 if b >= a else 0
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return np.array(out[::-1], dtype=np.int64)

    def content_share(self, x: np.ndarray, words: np.ndarray) -> float:
        """Share of the words that stand on content lines; 0 without words."""
        return float(words[self.viterbi(x) == 1].sum() / words.sum()) if len(x) else 0.0

    def consistent(self, x: np.ndarray, words: np.ndarray, good: int) -> np.ndarray:
        """Best labels of a document's lines that do not contradict its own label."""
        y = self.viterbi(x)
        gain = (x @ (self.weights[:, 1] - self.weights[:, 0])) * (1 if good else -1)
        right, need = int(words[y == good].sum()), MIN_SHARE * words.sum()
        for i in np.argsort(-gain, kind="stable"):
            if right > need:
                break
            if y[i] != good:
                y[i], right = good, right + int(words[i])
        return y

    @classmethod
    def from_documents(cls, docs: list[tuple[np.ndarray, np.ndarray, int]]) -> Field:
        """A field from (features, words, label) of documents; see Training."""
        docs = [d for d in docs if len(d[0])]
        if len({y for *_, y in docs}) < 2:
            return cls.prior()
        cuts = lambda x: [x[i : i + SEGMENT] for i in range(0, len(x), SEGMENT)]
        size = [max(1, sum(y == k for *_, y in docs)) for k in (0, 1)]
        share = [1 / size[y] / len(x) for x, _, y in docs for _ in cuts(x)]
        segments = [part for x, _, _ in docs for part in cuts(x)]
        fit = lambda labels, **how: cls.fit(list(zip(segments, [part for y in labels for part in cuts(y)], strict=True)), share, **how)
        field = fit([np.full(len(x), y) for x, _, y in docs], chained=False)
        for _ in range(ROUNDS):
            field = fit([field.consistent(x, words, y) for x, words, y in docs], start=field, rounds=40)
        shares, y = np.array([field.content_share(x, words) for x, words, _ in docs]), np.array([y for *_, y in docs])
        at = np.arange(1, 20) / 20
        right = np.array([(shares[y == 1] >= t).mean() + (shares[y == 0] < t).mean() for t in at])
        best = at[right >= right.max() - 1e-12]
        return cls(field.weights, field.moves, float(best[np.abs(best - MIN_SHARE).argmin()]))

    @classmethod
    def fit(cls, sequences: list[tuple[np.ndarray, np.ndarray]], share: list[float] | None = None, start: Field | None = None, chained: bool = True, rounds: int = 80, decay: float = 1e-3) -> Field:
        """Gradient ascent (Adam) on the mean log likelihood of labelled sequences; `share`: weight of a line of each. The same for the same rows."""
        n, t, d = len(sequences), max(len(x) for x, _ in sequences), len(FEATURES)
        x, mask, gold = np.zeros((n, t, d)), np.zeros((n, t)), np.zeros((n, t, 2))
        for i, (rows, y) in enumerate(sequences):
            x[i, : len(rows)], mask[i, : len(rows)], gold[i, : len(rows)] = rows, 1, np.eye(2)[y]
        weight = np.full(n, 1 / mask.sum()) if share is None else np.array(share) / 2
        theta, m, v = np.zeros(2 * d + 4), np.zeros(2 * d + 4), np.zeros(2 * d + 4)
        if start is not None:
            theta = np.concatenate([start.weights.ravel(), start.moves.ravel()])
        for step in range(1, rounds + 1):
            w, moves = theta[: 2 * d].reshape(d, 2), theta[2 * d :].reshape(2, 2)
            s = x @ w
            forward, backward = np.zeros((n, t, 2)), np.zeros((n, t, 2))
            forward[:, 0] = s[:, 0]
            for k in range(1, t):
                new = np.logaddexp(forward[:, k - 1, 0, None] + moves[0], forward[:, k - 1, 1, None] + moves[1]) + s[:, k]
                forward[:, k] = np.where(mask[:, k, None] > 0, new, forward[:, k - 1])
            for k in range(t - 2, -1, -1):
                ahead = backward[:, k + 1] + s[:, k + 1]
                new = np.logaddexp(moves[:, 0] + ahead[:, 0, None], moves[:, 1] + ahead[:, 1, None])
                backward[:, k] = np.where(mask[:, k + 1, None] > 0, new, 0)
            z = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
            node = np.exp(forward + backward - z[:, None, None]) * mask[:, :, None]
            push = (gold - node) * weight[:, None, None]
            grad_w = np.einsum("ntd,ntl->dl", x, push)
            pair = np.exp(forward[:, :-1, :, None] + moves + (backward + s)[:, 1:, None, :] - z[:, None, None, None])
            here = mask[:, 1:, None, None] * weight[:, None, None, None]
            grad_m = chained * (gold[:, :-1, :, None] * gold[:, 1:, None, :] * here - pair * here).sum(axis=(0, 1))
            grad = np.concatenate([grad_w.ravel(), grad_m.ravel()]) - decay * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            theta = theta + 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls(theta[: 2 * d].reshape(d, 2), theta[2 * d :].reshape(2, 2))


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
        rows = [line_features(t.split(b"\n")) for t in texts]
        cols = [pa.array([x.tobytes() for x, _ in rows], pa.binary()), pa.array([w.tobytes() for _, w in rows], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *cols], names=["id", "h", "x", "words"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", good: str = "quality") -> Field:
    """A field fitted on a bounded sample of labelled documents."""
    prepare(docs.sparkSession)
    known = labels.filter(F.col(label_id).isNotNull() & F.col(good).isNotNull()).select(F.col(label_id).cast("long").alias("id"), (F.col(good) > 0).cast("int").alias("y"))
    # As many bad documents as there are, up to half of the sample.
    half = lambda y: [r.id for r in known.filter(F.col("y") == y).distinct().orderBy(F.xxhash64("id"), "id").limit(TRAIN_DOCS // 2).collect()]
    chosen = {i: y for y in (1, 0) for i in half(y)}
    if len(set(chosen.values())) < 2:
        return Field.prior()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.col("id").isin(list(chosen)))
    found = rows.withColumn("h", F.xxhash64("text")).mapInArrow(_training, "id long, h long, x binary, words binary")
    one = found.groupBy("id").agg(F.min_by(F.struct("x", "words"), F.struct("h")).alias("row")).select("id", "row.*").collect()  # one row a chosen document
    array = lambda r: (np.frombuffer(r.x, np.float64).reshape(-1, len(FEATURES)), np.frombuffer(r.words, np.int64))
    return Field.from_documents([(*array(r), chosen[r.id]) for r in sorted(one, key=lambda r: r.id)])


_SCHEMA = "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def _judge(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                raw = (text or "").encode("utf-8", "surrogatepass")
                words, lines = raw.split(), raw.split(b"\n")
                base = base_counts(raw, words, lines, len(text or ""))
                failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT * base[0]
                x, weight = line_features(lines)
                share = field.content_share(x, weight)
                rows.append((*base, failed, not failed and share >= field.share, share))
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[f.split()[0] for f in _SCHEMA.split(", ")])

    return run


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document with its counts, the share of its words on content lines, and whether it is kept."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return spread(rows).mapInArrow(_judge(field), _SCHEMA)


def keep(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns; each is judged where it stands, so nothing is shuffled."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = docs_columns.index(text_col)
        for batch in batches:
            good = []
            for text in batch.column(at).to_pylist():
                raw = (text or "").encode("utf-8", "surrogatepass")
                words, lines = raw.split(), raw.split(b"\n")
                ok = len(words) >= MIN_WORDS and 100 * repeated_words(words) <= MAX_REPEAT * len(words)
                good.append(ok and field.content_share(*line_features(lines)) >= field.share)
            yield batch.filter(pa.array(good, pa.bool_()))

    docs_columns = docs.columns
    return docs.mapInArrow(run, docs.schema)
