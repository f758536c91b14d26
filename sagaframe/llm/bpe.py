"""BPE encoding and decoding (operator 4) by dynamic programming over prefixes.

For every prefix of a word its BPE encoding ends with one token that is unique. Candidates are the vocabulary entries that are
suffixes of the prefix: an Aho-Corasick automaton, the suffix automaton of the vocabulary, gives them in one pass over the word. A candidate is the last
token exactly if it may stand after the last token of the prefix that remains without it; that is a test of one pair. The stored
last tokens are the back-pointers: following them from the end gives the ids. Nothing is merged step by step, and the time is
linear in the word for a bounded token length.

Pair test. Two tokens stand side by side in an encoding exactly if no merge crosses their boundary before both are complete: walk
up the right spine of the first token's merge tree and the left spine of the second one's in the order of the merges; the pair of
symbols at the boundary must never have a merge that comes before the next one on the spines (leftmost first on equal ranks).

The tokenizer's file is read where it is named: from the path given, or the installed public tokenizers, on each worker, or from
its text which `Encoder.from_json` takes. It is never copied.

Defined results: null and empty texts have no ids and decode to the empty text; very long texts and words run whole; strings of
special tokens in a text become those tokens, as the library does by default; repeated rows give equal rows; an empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaframe.session import prepare, spread

#: Words and pairs kept by a worker, in two generations. They only save time: what is not kept is computed again.
KEPT = 150_000
_END = "\n"
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SUFFIX = "</w>"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Kept(dict):
    """A dict that computes what it lacks; when full, its entries age and those unused for a whole generation go."""

    def __init__(self, make, most: int = KEPT) -> None:
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes like the library does with the same file: NFC, white space runs to one space, lower case, split, byte letters, BPE."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != _SUFFIX:
            raise ValueError("a BPE model with the word end " + _SUFFIX + " is needed")
        vocab: dict[str, int] = model["vocab"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.piece = regex.compile(split)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.letters = byte_letters()
        n = max(vocab.values()) + 1
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        born: list[tuple[int, int, int] | None] = [None] * n
        for r, (a, b) in enumerate(merges):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            self.rank.setdefault(pair, r)
            if born[made] is None:
                born[made] = (r, *pair)
        self.born = born
        self.right: dict[int, list[tuple[int, float]]] = {}
        self.left: dict[int, list[tuple[int, float]]] = {}
        self.automaton = ahocorasick.Automaton()
        self.length = [0] * n
        for text, i in vocab.items():
            key = text[: -len(_SUFFIX)] + _END if text.endswith(_SUFFIX) else text
            self.automaton.add_word(key, i)
            self.length[i] = len(key)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.whole = [self._whole(i) for i in range(n)]
        self.pieces = Kept(self._piece)
        self.words = Kept(self._word)

    @classmethod
    def from_json(cls, text: str) -> Encoder:
        return cls(json.loads(text))

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """From the outermost base symbol up to the token: (symbol, rank of the merge that ends it)."""
        out, ends = [], float("inf")
        while True:
            out.append((token, ends))
            if self.born[token] is None:
                return out[::-1]
            ends, *both = self.born[token]
            token = both[side]

    def _fits(self, a: int, b: int) -> bool:
        first = self.right.get(a)
        if first is None:
            first = self.right[a] = self._spine(a, 1)
        second = self.left.get(b)
        if second is None:
            second = self.left[b] = self._spine(b, 0)
        i = j = 0
        rank = self.rank.get
        while True:
            (x, x_ends), (y, y_ends) = first[i], second[j]
            r = rank((x, y))
            if r is not None and r < x_ends and r <= y_ends:
                return False
            if x_ends <= y_ends:
                if x_ends == float("inf"):
                    return True
                i += 1
            else:
                j += 1

    def encode_piece(self, letters: str) -> list[int]:
        """Ids of one piece in byte letters, its word end included."""
        n = len(letters) + 1
        last = [-1] * (n + 1)
        length, whole, pairs = self.length, self.whole, self.pairs
        for end, token in self.automaton.iter(letters + _END):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length[token]
            if start == 0:
                if whole[token]:
                    last[end] = token
            elif (before := last[start]) >= 0:
                key = before << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= 2 * KEPT:
                        pairs.clear()
                    fits = pairs[key] = self._fits(before, token)
                if fits:
                    last[end] = token
        out, at = [], n
        while at > 0:
            token = last[at]
            if token < 0:
                raise ValueError("the vocabulary does not cover this text")
            out.append(token)
            at -= length[token]
        return out[::-1]

    def _whole(self, token: int) -> bool:
        """Is the token what BPE makes of its own text? True if its two halves would stand side by side but for its own merge."""
        made = self.born[token]
        if made is None:
            return True
        r, a, b = made
        first, second = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = first[i], second[j]
            rank = self.rank.get((x, y))
            if rank is not None and rank < x_ends and rank <= y_ends:
                return i == len(first) - 1 and j == len(second) - 1 and rank == r
            if x_ends <= y_ends:
                if x_ends == float("inf"):
                    return False
                i += 1
            else:
                j += 1

    def _piece(self, piece: str) -> tuple[str, str, int]:
        """Ids, tokens and their number."""
        letters = self.letters
        ids = self.encode_piece(piece if piece.isascii() and piece.isprintable() else "".join([letters[b] for b in piece.encode("utf-8", "surrogatepass")]))
        return " ".join(map(str, ids)), " ".join([self.token[i] for i in ids]), len(ids)

    def _word(self, word: str) -> tuple[str, str, int]:
        """The same for a run of text between white space; a word of letters, with or without one ASCII mark after it, needs no pattern."""
        if "\u03a3" in word:  # a sigma's lower case is that of the single character here, never the final one
            word = "".join([c.lower() for c in word])
        else:
            word = word.lower()
        if word.isalpha() and word.isascii():
            return self.pieces[word]
        found = (word[:-1], word[-1]) if word[-1] in ".,;:!?" and word[:-1].isalpha() and word.isascii() else self.piece.findall(word)
        parts = [self.pieces[p] for p in found]
        return " ".join([p[0] for p in parts]), " ".join([p[1] for p in parts]), sum([p[2] for p in parts])

    def _runs(self, text: str) -> Iterator[list[str] | str]:
        """Lists of words, and special tokens. No piece goes over white space, whatever its kind, so its runs need no replacing."""
        special = self.special
        for part in self.special_split.split(text) if self.special_split and any(s in text for s in special) else (text,):
            if part in special:
                yield part
                continue
            part = unicodedata.normalize("NFC", part)
            # str.split takes U+001C to U+001F for white space, the pattern does not
            yield self.piece.findall(part) if _ODD_SPACE.search(part) else part.split()

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, ids joined by spaces, decoded text."""
        n, ids, tokens, kept = 0, [], [], self.words
        for run in self._runs(text or ""):
            if isinstance(run, str):
                n += 1
                ids.append(str(self.special[run]))
                tokens.append(run)
            elif run:
                a, b, c = zip(*[kept[w] for w in run], strict=True)
                n += sum(c)
                ids += a
                tokens += b
        return n, " ".join(ids), " ".join(tokens)

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for i in self.digest(text)[1].split()]

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file the library joins the tokens with spaces."""
        return " ".join([self.token[i] for i in ids])

    def count(self, text: str | None) -> int:
        n, kept = 0, self.words
        for run in self._runs(text or ""):
            n += 1 if isinstance(run, str) else sum([kept[w][2] for w in run])
        return n


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one a worker."""
    if path not in _encoders:
        import public_tokenizers

        with open(path if "/" in path else public_tokenizers.path(path), encoding="utf-8") as f:
            _encoders[path] = Encoder.from_json(f.read())
    return _encoders[path]


def _each(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if kind == "digests":
                rows = [(n, hashlib.sha256(i.encode()).hexdigest(), hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest()) for n, i, d in map(enc.digest, texts)]
                cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            elif kind == "counts":
                cols, names = [pa.array(map(enc.count, texts), pa.int64(), size=len(texts))], ["id", "n_tokens"]
            else:
                ids = [enc.encode(t) for t in texts]
                cols, names = [pa.array(ids, pa.list_(pa.int32())), pa.array([enc.decode(i) for i in ids], pa.string())], ["id", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=names)

    return run


_SCHEMAS = {"digests": "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "counts": "id long, n_tokens long", "ids": "id long, ids array<int>, decoded string"}


def encode(docs: DataFrame, path: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text", kind: str = "ids") -> DataFrame:
    """kind "ids": id, ids, decoded; "digests": their number and SHA-256; "counts": the number alone."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return spread(rows).mapInArrow(_each(path, kind), _SCHEMAS[kind])
