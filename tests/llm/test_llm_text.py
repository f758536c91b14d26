"""Operators on texts against brute force: quality, SimHash, language model, BPE, licenses, line dedup, lengths."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sagaframe.llm import bpe, language_model, license_scan, line_dedup, quality, simhash, token_counts

WORDS = "the of and river stone Aß é walks, home. THE 12 x".split()


def some_texts(n=60, seed=1):
    draw = random.Random(seed)
    out = [None, "", " \t\n", "one", "two words", "\x1c odd \x85 space", "a\n\n\nb", "x " * 3000]
    while len(out) < n:
        out.append("\n".join(" ".join(draw.choices(WORDS, k=draw.randint(0, 30))) for _ in range(draw.randint(1, 8))))
    return out + out[10:14]


def frame(spark, texts):
    """An extra column has an operator's own name."""
    return spark.createDataFrame([(i, t, f"s{i % 3}") for i, t in enumerate(texts)], "doc_id long, text string, id string")


# 1


def test_base_counts_and_repeats():
    for text in some_texts(120):
        raw = (text or "").encode()
        words = raw.split()
        n = max(0, len(words) - 7)
        windows = Counter(tuple(words[i : i + 8]) for i in range(n))
        covered = {j for i in range(n) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = (text or "").split("\n")
        dup = sum(1 for i, x in enumerate(lines) if x.encode().split() and x in lines[:i])
        chars = sum(len(w.decode()) for w in words)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        assert quality.base_counts(raw, words, raw.split(b"\n"), len(text or "")) == (len(words), chars, symbols, dup, len(covered))


def test_a_word_three_times_running_is_seen_anywhere():
    words = [f"w{i}".encode() for i in range(200)]
    at = quality.FEATURES.index("same_word")
    for i in range(198):
        x, _ = quality.line_features([b" ".join(words[:i] + [words[i]] * 3 + words[i + 3 :])])
        assert x[0, at] == 1
    assert quality.line_features([b" ".join(words)])[0][0, at] == 0


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(2)
    field = quality.Field(draw.normal(size=(len(quality.FEATURES), 2)), draw.normal(size=(2, 2)))
    x = draw.normal(size=(7, len(quality.FEATURES)))
    s = x @ field.weights

    def score(path):
        return sum(s[i, y] for i, y in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:], strict=False))

    paths = [[k >> i & 1 for i in range(7)] for k in range(128)]
    assert score(field.viterbi(x).tolist()) == pytest.approx(max(map(score, paths)))


def test_field_learns_held_out_lines():
    good = [[b"He walked along the old river and thought of home.", b"It was late, and nobody spoke for a while."] for _ in range(40)]
    bad = [[b"BUY!! NOW!! CHEAP!! PRICES!! HERE!!", b"a | b | c | d | e | f"] for _ in range(40)]
    field = quality.Field.from_documents([(*quality.line_features(x), 1) for x in good] + [(*quality.line_features(x), 0) for x in bad])
    assert field.viterbi(quality.line_features([b"She opened the door and saw the garden."])[0]).tolist() == [1]
    assert field.viterbi(quality.line_features([b"WIN!! BIG!! TODAY!! ONLY!!", b"x | y | z | w | v"])[0]).tolist() == [0, 0]


def test_lines_get_labels_of_their_own():
    """Labels are those of documents, but bad documents hold good lines, too: the field must tell the lines apart."""
    draw = random.Random(9)
    content = lambda: (" ".join(draw.choices("he walked along an old river and thought of home late at night".split(), k=12)) + ".").encode()
    junk = lambda: draw.choice([" ".join(f"w{draw.randrange(99)}{draw.choice(['***', '$$$', '&&&'])}" for _ in range(9)), " | ".join(f"w{draw.randrange(99)}" for _ in range(9))]).encode()
    docs = [([content() for _ in range(draw.randint(2, 300 if k == 0 else 9))], 1) for k in range(60)]
    docs += [([content() for _ in range(draw.randint(0, 2))] + [junk() for _ in range(draw.randint(3, 7))] + [content() for _ in range(draw.randint(0, 1))], 0) for _ in range(60)]
    field = quality.Field.from_documents([(*quality.line_features(lines), y) for lines, y in docs])
    right, shares = [], set()
    for _ in range(50):
        kinds = [1] * draw.randint(1, 4) + [0] * draw.randint(1, 4) + [1] * draw.randint(1, 4)
        x, words = quality.line_features([content() if k else junk() for k in kinds])
        right += (field.viterbi(x) == np.array(kinds)).tolist()
        shares.add(round(field.content_share(x, words), 3))
    assert np.mean(right) > 0.95 and len([s for s in shares if 0 < s < 1]) > 10
    assert all((field.content_share(*quality.line_features(lines)) >= field.share) == y for lines, y in docs)


def test_training_reads_whole_texts(spark):
    good = "\n".join(f"He walked along the old river number {i}, and thought." for i in range(150))
    late = "\n".join([f"He walked along the old river number {i}, and thought." for i in range(120)] + [f"a{i}*** b$$$ c&&& d%%%" for i in range(400)])
    docs = spark.createDataFrame([(i, good, "x") for i in range(5)] + [(i, late, "x") for i in range(5, 10)] + [(9, "other", "x"), (None, late, "x")], "doc_id long, text string, y string")
    field = quality.train(docs, spark.createDataFrame([(i, int(i < 5)) for i in range(10)] + [(3, 1), (None, 1)], "doc_id long, quality int"))
    rows = {(r.id, r.n_words > 1): r for r in quality.judge(docs, field).collect()}
    assert 0 < rows[6, True].content_share < field.share <= rows[1, True].content_share


def test_quality_over_a_frame(spark):
    docs = frame(spark, some_texts())
    field = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = quality.judge(docs, field).collect()
    assert len(rows) == docs.count() and all(not (r.base_failed and r.kept) for r in rows)
    kept = quality.keep(docs, field)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.id for r in rows if r.kept)
    assert quality.judge(docs.limit(0), field).count() == 0


# 2


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(p, seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints():
    for text in some_texts(40):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_components(keys, radius):
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if (keys[i] ^ keys[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(keys))]


@pytest.mark.parametrize("most", [4096, 8])
def test_all_links_are_found(spark, monkeypatch, most):
    """Chains and dense groups of fingerprints, with shards that are cut again."""
    monkeypatch.setattr(simhash, "MAX_SHARD", most)
    draw = random.Random(7)
    keys = [0, (1 << 64) - 1]
    for _ in range(25):
        x = draw.getrandbits(64)
        for _ in range(draw.choice([1, 2, 30])):
            keys.append(x)
            for _ in range(draw.randint(0, 3)):
                x ^= 1 << draw.randrange(64)
    keys = list(dict.fromkeys(keys))
    nodes = spark.createDataFrame([(k - (1 << 64) if k >> 63 else k, i) for i, k in enumerate(keys)], "w0 long, id long")
    simhash.prepare(spark)
    found = simhash.components(simhash.links(nodes, 2, 64, simhash.exact_masks(2, 64), True))
    got = {r.a: r.root for r in found.collect()}
    assert [got.get(i, i) for i in range(len(keys))] == plain_components(keys, 2)


def test_near_duplicates_over_a_frame(spark):
    texts = some_texts()
    docs = frame(spark, texts).unionByName(frame(spark, ["one"]).withColumn("doc_id", F.lit(None).cast("long")))
    rows = simhash.near_duplicates(docs).collect()
    got = {r.id: r.component for r in rows}
    want = plain_components([plain_fingerprint(t) for t in texts], 2)
    assert all(got[i] == c for i, c in enumerate(want)) and got[None] == got[3] and len(rows) == len(texts) + 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_similar_documents_finds_near_copies(spark):
    draw = random.Random(4)
    texts, pairs = [], []
    for _ in range(40):
        words = [f"w{draw.randrange(5000)}" for _ in range(300)]
        near = list(words)
        for at in draw.sample(range(300), 3):
            near[at] = "changed"
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(words), " ".join(near)]
    got = {r.id: r.component for r in simhash.similar_documents(frame(spark, texts)).collect()}
    assert sum(got[a] == got[b] for a, b in pairs) >= 38
    assert len(set(got.values())) >= 40


def test_bitmaps_bound_the_difference():
    draw = np.random.default_rng(1)
    for _ in range(200):
        pool = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
        a, b = (np.unique(draw.choice(pool, draw.integers(0, 2500))) for _ in range(2))
        x, y = (np.frombuffer(simhash.parity(s), np.uint64) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_similar_documents_are_those_of_brute_force(spark):
    draw = random.Random(5)
    texts = ["", None, "a b", "A  b"]
    for _ in range(40):
        words = [f"w{draw.randrange(5000)}" for _ in range(200)]
        texts.append(" ".join(words))
        for changes in (3, 4, 5, 6, 8, 9):  # similarities around 0.8
            near = list(words)
            for at in draw.sample(range(200), changes):
                near[at] = f"changed{draw.randrange(9)}"
            texts.append(" ".join(near))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in ((t or "").lower().split() for t in texts)]
    parent = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((parent[a], parent[b]))
                parent = [low if p == high else p for p in parent]
    got = {r.id: r.component for r in simhash.similar_documents(frame(spark, texts)).collect()}
    assert got == dict(enumerate(parent)) and 60 < len(set(parent)) < 280


def test_large_shards_link_what_small_ones_do(spark):
    """Shards of any size give the links of brute force, over exact copies, a large group of near copies and a passage that many unlike texts share."""
    draw = random.Random(8)
    base, passage = [f"b{i}" for i in range(120)], [f"p{i}" for i in range(30)]
    texts = []
    for k in range(25):
        texts.append(" ".join(f"c{draw.randrange(4)}" if i == 7 * k % 120 else w for i, w in enumerate(base)))
        texts.append(" ".join([*(f"w{draw.randrange(5000)}" for _ in range(draw.choice((20, 60)))), *passage]))
    texts += texts[:6] * 3
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    want = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((want[a], want[b]))
                want = [low if p == high else p for p in want]
    for most in (1, 4, 64):
        assert {r.id: r.component for r in simhash.similar_documents(frame(spark, texts), most=most).collect()} == dict(enumerate(want))
    assert 10 < len(set(want)) < 40


def test_first_shingles_travel_packed(spark, tmp_path):
    """Texts that share passages write less shuffle than twice their own size: no row a shingle, no bitmap a member of a shard."""
    draw = random.Random(9)
    passages = [" ".join(f"p{k}_{i}" for i in range(40)) for k in range(60)]
    texts = [" ".join([*(f"w{draw.randrange(9000)}" for _ in range(60)), *draw.sample(passages, 3)]) for _ in range(600)]
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm
    gateway = spark.sparkContext._gateway

    def written() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    docs = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    size = written()
    groups = simhash.similar_documents(docs, radius=2)
    assert len({r.component for r in groups.collect()}) > 500
    assert written() - size < 2 * sum(map(len, texts))


def test_folded_bitmaps_bound_the_difference():
    draw = np.random.default_rng(2)
    for _ in range(200):
        pool = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
        n = int(draw.integers(1, 2500))
        a, b = (np.unique(draw.choice(pool, size)) for size in (n, int(n * draw.uniform(0.8, 1.25))))
        x, y = (simhash.folded(simhash.parity(s), len(s)) for s in (a, b))
        assert simhash.bits_apart(x, y) == simhash.bits_apart(y, x) <= len(np.setxor1d(a, b))
        assert simhash.bits_apart(x, x) == 0

# 3


def test_packed_counts():
    for n in ([], [1, 254, 255, 256, 1 << 40, 0], [255] * 5):
        n = np.array(n, dtype=np.int64)
        keys = np.arange(len(n), dtype=np.uint64) * 3
        assert language_model.unpacked(*language_model.packed(n)).tolist() == n.tolist()
        data = language_model.to_bytes(keys, *language_model.packed(n))
        back = language_model.from_bytes(data, np.uint64, np.uint8, np.int64, np.int64)
        (got,) = language_model._found(np.concatenate([keys, keys + 1]).astype(np.uint64), *back)
        assert got.tolist() == n.tolist() + [0] * len(n)


def test_arrays_in_a_store_that_is_not_mounted(monkeypatch, tmp_path):
    monkeypatch.setattr(language_model, "_local", lambda folder: None)
    keys, n = np.arange(9, dtype=np.uint64), np.array([3] * 8 + [999])
    for _ in range(2):  # a second attempt replaces the file
        language_model._store(f"file://{tmp_path}/store", "pairs-1", keys, *language_model.packed(n))
    with language_model._mapped(f"file://{tmp_path}/store", "pairs-1", np.uint64, np.uint8, np.int64, np.int64) as (a, *counts):
        assert a.tolist() == list(range(9)) and language_model.unpacked(*counts).tolist() == n.tolist()
    assert [p.name for p in (tmp_path / "store").iterdir()] == ["pairs-1"]


@pytest.mark.parametrize("kind", ["plain", "small"])
def test_scores_of_the_language_model(spark, monkeypatch, kind):
    """Also with many shards, frequent contexts, and counts above one byte."""
    if kind == "small":
        monkeypatch.setattr(language_model, "PER_SHARD", 300)
        monkeypatch.setattr(language_model, "SAMPLED", 1)
        monkeypatch.setattr(language_model, "FLUSH", 500)
    texts = some_texts(80)
    docs = frame(spark, texts)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    model = language_model.train(docs.filter(~held))
    got = {r.id: r for r in language_model.score(docs, model, held).collect()}
    tokens = {i: [*(t or "").encode().lower().split(), "end"] for i, t in enumerate(texts)}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    single, pairs = Counter(), Counter()
    for i, w in tokens.items():
        if not out[i]:
            single.update(w)
            pairs.update(zip(["begin", *w], w, strict=False))
    n, v = sum(single.values()), len(single)
    sums, before = defaultdict(lambda: [0] * 4), Counter()
    for (a, b), c in pairs.items():
        sums[a][0] += c
        sums[a][min(c, 3)] += 1
        before[b] += 1
    d, e = (language_model.discounts(*[sum(c == k for c in cs) for k in (1, 2, 3, 4)]) for cs in (pairs.values(), before.values()))
    rest = sum(e[min(c, 3)] for c in before.values()) / len(pairs)

    def low(w):
        return (before[w] - e[min(before[w], 3)]) / len(pairs) + rest / (v + 1)

    def p(a, w):
        if a not in sums:
            return low(w)
        s, c = sums[a], pairs[a, w]
        return (c - d[min(c, 3)]) / s[0] + sum(d[k] * s[k] for k in (1, 2, 3)) / s[0] * low(w)

    assert model.tokens == n and model.types == v and (kind != "small" or len(model.hot) > 3 and model.shards > 8)
    assert sum(p("the", w) for w in single) + p("the", "never") == pytest.approx(1)
    for i, w in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known) == (out[i], len(w), sum(single[x] > 0 for x in w))
        assert r.base_score == pytest.approx(sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w))
        assert r.score == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["begin", *w], w, strict=False)))


def test_model_of_nothing(spark):
    docs = frame(spark, ["a b", None])
    model = language_model.train(docs.limit(0))
    rows = language_model.score(docs, model, F.lit(False)).collect()
    assert [r.n_known for r in rows] == [0, 0] and all(math.isfinite(r.score) for r in rows)


# 4 and 10


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    vocabularies = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(vocabularies.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_are_those_of_the_library(library):
    enc = bpe.encoder("word_bpe_49k.json")
    draw = random.Random(6)
    texts = [t or "" for t in some_texts()] + ["it's we'LL <|endoftext|> x<|startoftext|>y", "a\x1cb \x1d c\x85d　e​", "ΣΑΣ İstanbul ſ ẞ 한국어 日本 é", "aaaa" * 9 + " ½ ②!!! '''s", "\x00\x01 😀😀"]
    texts += ["".join(draw.choice("abeinthraos '’!.9é Éß日\n\t") for _ in range(draw.randint(0, 50))) for _ in range(1500)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False)
        n, ids, decoded = enc.digest(text)
        assert ids == " ".join(map(str, want.ids)) and n == len(want.ids) == enc.count(text)
        assert decoded == library.decode(want.ids, skip_special_tokens=False) == enc.decode(enc.encode(text))


def test_bounded_caches_change_nothing(library, monkeypatch):
    enc = bpe.Encoder.from_json(library.to_str())
    enc.words.most = enc.pieces.most = 3
    for text in some_texts(30):
        assert enc.encode(text) == library.encode(text or "", add_special_tokens=False).ids


def test_encode_and_count_over_a_frame(spark, library):
    texts = some_texts()
    docs = frame(spark, texts)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = {r.id: r for r in bpe.encode(docs, kind="digests").collect()}
    assert all(got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, w)).encode()).hexdigest() for i, w in enumerate(want))
    assert {r.id: r.ids for r in bpe.encode(docs).collect()} == dict(enumerate(want))
    lengths = sorted(map(len, want))
    sums = token_counts.suffix_sums(token_counts.histogram(docs))
    for r in sums.collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.all_docs, r.all_tokens) == (lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n), len(lengths), sum(lengths))
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
    for r in token_counts.at_limits(sums, [0, 1, 17, 10**6]).collect():
        assert (r.docs_over, r.truncated_tokens) == (sum(x > r.context_limit for x in lengths), sum(min(x, r.context_limit) for x in lengths))
    assert token_counts.quantile(sums, 0.5).first().n_tokens == lengths[(len(lengths) + 1) // 2 - 1]
    assert token_counts.suffix_sums(token_counts.histogram(docs.limit(0))).count() == 0


# 5


def test_every_block_that_meets_a_template():
    draw = random.Random(8)
    frequency = {w: draw.randrange(100) for w in license_scan.Templates().universe}
    t = license_scan.Templates(frequency=frequency)
    pool = sorted(t.universe) + [b"other", b"words"]
    for _ in range(3000):
        base = list(draw.choice(t.sets)[1])
        line = draw.sample(base, draw.randint(0, len(base))) + draw.choices(pool, k=draw.randint(0, 6))
        want = sorted((i, len(set(line) & set(words)) / len(words)) for i, (_, words, _) in enumerate(t.sets) if len(set(line) & set(words)) / len(words) >= license_scan.THRESHOLD - 1e-9)
        assert sorted(t.met(line)) == want


def test_license_scan_over_a_frame(spark):
    texts = ["Licensed under CC BY 4.0.", "cc by cc by", "GENERAL\nPublic, License", "x all rights reserved", "Released under the MIT License.", None, "", "accby cc byx", "the of and"]
    got = {r.id: r for r in license_scan.scan(frame(spark, texts)).collect()}
    places = [[(p.label, p.word) for p in got[i].places] for i in range(len(texts))]
    assert places == [[("cc-by", 2)], [("cc-by", 0), ("cc-by", 2)], [("gpl", 0)], [("reserved", 1)], [], [], [], [], []]
    assert "mit" in {b.label for b in got[4].blocks} and "cc-by-4.0" in {b.label for b in got[0].blocks} and not got[8].blocks
    assert [got[i].n_words for i in range(9)] == [6, 4, 3, 4, 5, 0, 0, 3, 3]


def test_notices_name_one_license():
    t = license_scan.Templates()
    label = lambda text: sorted({b["label"] for b in t.blocks([x.split() for x in license_scan.normal(text).split(b"\n")]) if b["named"]})
    assert label("This work is licensed under the GNU General Public License, version 2") == ["gpl-2.0"]
    assert label("Licensed under the Apache License, Version 2.0 (the License);\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n") == ["apache-2.0"]
    assert label("Licensed under the GNU Lesser General Public License") == ["lgpl"] and label("Licensed under CC BY-SA 4.0") == ["cc-by-sa-4.0"]
    assert label("Licensed under the Foo License") == [] == label("the rights were all reserved")
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
    of this software and associated documentation files (the "Software"), to deal
    in the Software without restriction, including without limitation the rights
    to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
    copies of the Software, and to permit persons to whom the Software is
    furnished to do so, subject to the following conditions:"""
    bsd = """Redistribution and use in source and binary forms, with or without
    modification, are permitted provided that the following conditions are met:"""
    gpl = """This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or"""
    assert label(mit) == ["mit"] and label(bsd) == ["bsd"] and label(gpl) == ["gpl"]
    assert label(f"x\n{mit}\n\n\n{bsd}") == ["bsd", "mit"]


def test_notices_over_line_ends(spark):
    texts = [
        "x\n# You may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\ny",
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
        "Redistribution and use in source\n" + "far away " * 9 + "\nbinary forms, with or without modification, are permitted",
    ]
    got = {r.id: {b.label: (b.line, b.containment) for b in r.blocks if b.named} for r in license_scan.scan(frame(spark, texts)).collect()}
    assert got == {0: {"apache-2.0": (1, 1.0)}, 1: {"mit": (0, 1.0)}, 2: {"bsd": (0, 1.0)}, 3: {}}
    draw, t = random.Random(6), license_scan.Templates()
    for _ in range(300):
        words = [w.encode() for x in draw.choices(license_scan.TEMPLATES, k=3) for w in license_scan.normal(x[2]).decode().split() if draw.random() < 0.9]
        words = [x for w in words for x in ([w, b"other"] if draw.random() < 0.1 else [w])]
        cuts = sorted(draw.sample(range(len(words)), min(len(words), 6)))
        lines = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True)]
        where = [i for i, line in enumerate(lines) for _ in line]
        best = {}
        for k, (_, template, need) in enumerate(t.sets):
            for at in range(len(words)):
                hits = [j for j in range(at, min(len(words), at + t.lengths[k])) if words[j] in template]
                n = len({words[j] for j in hits})
                if n >= need and where[hits[0]] != where[hits[-1]]:
                    best[k] = max(best.get(k, 0), n / len(template))
        found = {}
        for _, k, c, _ in t.wrapped(lines):
            found[k] = max(found.get(k, 0), c)
        assert found == best


# 6


def test_chunks_are_shift_resistant():
    draw = random.Random(3)
    line = lambda: " ".join(draw.choices(WORDS, k=8))
    passage = [line() + f" {i}" for i in range(30)]
    a = {c for _, _, c in line_dedup.chunks("\n".join(passage))}
    b = {c for _, _, c in line_dedup.chunks("\n".join([line() + " z" for _ in range(3)] + passage))}
    assert len(a & b) >= len(a) - 2


def test_boundaries_never_come_from_positions():
    same = ["equal line here"] * 500
    draw = random.Random(2)
    line = lambda: " ".join(draw.choices(WORDS, k=8))
    tails = [line() + f" {i}" for i in range(40)]
    a = {c for _, _, c in line_dedup.chunks("\n".join(same + tails))}
    b = {c for _, _, c in line_dedup.chunks("\n".join(same[:471] + tails))}
    assert len(a & b) >= len(a) - 2


def test_repeats_go_and_first_copies_stay(spark):
    draw = random.Random(5)
    line = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    long_line, shared = line(60), "\n".join(line(9) for _ in range(25))
    texts = [f"{line(9)}\n{shared}\n{line(9)}", f"{line(5)}\n{line(6)}\n{shared}", f"{line(9)}\n{long_line}", f"{long_line}\n{line(4)}", f"{long_line}\n{long_line}", None, "", "\n\n", line(9) + "\n" + line(9)]
    docs = frame(spark, texts)
    out = line_dedup.without_repeats(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == [*docs.columns, "removed"]
    assert got[0].text == texts[0] and got[2].text == texts[2] and got[8].text == texts[8]
    left = [i for i, x in enumerate(shared.split("\n")) if x in got[1].text]
    assert all(i < 8 or i >= 17 for i in left)  # only towards the ends of the passage, outside its common chunks
    assert long_line not in got[3].text and got[4].text == "" and got[5].text is None and got[6].text == "" and got[7].text == "\n\n"
    owners = defaultdict(set)
    for i, t in enumerate(texts):
        for _, _, c in line_dedup.chunks(t):
            owners[c].add(i)
    for i, t in enumerate(texts):
        gone = {(s.line, s.lines) for s in got[i].removed}
        seen = set()
        for s, e, c in line_dedup.chunks(t):
            assert ((s, e - s) in gone) == (min(owners[c]) != i or c in seen)
            seen.add(c)
    assert line_dedup.without_repeats(docs.limit(0)).count() == 0


def test_every_repeated_passage_of_fifty_words_goes(spark):
    draw = random.Random(8)
    line = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    texts, passages = [], []
    for lengths in [(26, 26), (30, 25), (18, 17, 17), (20, 0, 31), (13, 13, 13, 13), (9, 9, 9, 9, 9, 9), (45, 8, 40), (4, 60, 3)] * 5:
        passage = [line(n) for n in lengths]
        passages.append(passage)
        for _ in range(2):
            texts.append("\n".join([*(line(7) for _ in range(draw.randint(1, 4))), *passage, *(line(7) for _ in range(draw.randint(1, 4)))]))
    same = line(10)
    texts += ["\n".join([same] * 40), "\n".join([line(10), *[same] * 9])]
    got = [r.text for r in line_dedup.without_repeats(frame(spark, texts)).orderBy("doc_id").collect()]
    for k, passage in enumerate(passages):
        assert got[2 * k] == texts[2 * k]
        own = [x for x in texts[2 * k + 1].split("\n") if x not in passage]
        assert got[2 * k + 1].split("\n") == own
    assert 1 <= got[-2].split("\n").count(same) <= 5 and got[-1] == texts[-1].split("\n")[0]
