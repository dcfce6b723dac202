"""Operators for training data: brute force, other libraries and round trips on edge cases and small tables."""

from __future__ import annotations

import hashlib
import re
import sys
import tracemalloc
import unicodedata
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from skygalley.llm import (  # noqa: E402
    bpe,
    components,
    dedup,
    jaccard,
    language,
    licenses,
    neighbours,
    packing,
    sharding,
    substring,
    tokenfiles,
    tokens,
    words,
)

TABLES = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, chunk int, row long, kept boolean"

PASSAGE = " ".join(f"word{i}" for i in range(30))
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(9_000))
EDGE = [
    (1, None, "en", None),
    (2, "", "en", "a"),
    (3, " \t\r\n\x0b\x0c ", None, "a"),
    (4, "Hello World", "en", None),
    (5, "hello world", "de", "a"),
    (6, "HELLO wORLD", "en", "a"),
    (7, PASSAGE, "en", "a"),
    (8, "start " + PASSAGE + " end ÉtÉ İ K", "en", "a"),
    (9, PASSAGE + " " + PASSAGE, "en", "a"),
    (10, LONG, "en", "a"),
    (11, LONG + " tail", "en", "a"),
    (12, "naïve café — 漢字かな 😀👩‍👩‍👧 don't we'll x  y  \n\n z ", None, "b"),
    (13, "a" * 5000, "fr", "b"),
    (14, "123 456 ... !!! \U0001f600", "fr", "b"),
    (15, "Licensed under CC BY-NC 4.0. All rights reserved. cc, by", "en", "b"),
    (16, "one two three four five six seven eight nine ten eleven twelve", "en", None),
    (17, "One two three four five six seven eight nine ten eleven twelve", "en", None),
    (18, "this work is licensed under the gnué general public license version", "en", "b"),
    (19, "퟿  ﻿ é 가", "en", "b"),
    (20, "x", "en", "b"),
]


def rows_of(pairs):
    return [(i, t, lang, src, None, 7, 8, True) for i, t, lang, src in pairs]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(rows_of(EDGE), COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def repeated(spark):
    return spark.createDataFrame(rows_of([*EDGE[:8], *EDGE[3:9], (None, "Hello World", None, None)]), COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


# ---- words


def test_words_match_regex():
    parts = [t or "" for _, t, _, _ in EDGE]
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(p.encode()) for p in parts])))
    w = words.words_of(data, offsets)
    got = [bytes(data[a:b]).decode() for a, b in zip(w.start, w.end)]
    want = [x for p in parts for x in words_in(p)]
    assert got == want
    assert np.diff(w.first).tolist() == [len(words_in(p)) for p in parts]
    by_hash = defaultdict(set)
    for word, h in zip(got, w.hash.tolist()):
        by_hash[h].add(word)
    assert all(len(v) == 1 for v in by_hash.values()) and len(by_hash) == len(set(got))
    three = w.sequences(3)[w.fits(3)]
    grams = [tuple(x[i : i + 3]) for x in map(words_in, parts) for i in range(len(x) - 2)]
    assert len(three) == len(grams) and len(set(three.tolist())) == len(set(grams))


# ---- 1 language


def test_language_held_out_accuracy(real):
    model = language.learn(real)
    found = language.identify(real, model, carry=["lang"])
    held = found.where(language.held_out(F.col("doc_id"))).collect()
    assert len(held) > 20
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_edges(spark, edge, empty, real):
    model = language.learn(real)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(edge, model).collect()}
    assert len(got) == len(EDGE)
    for i in (1, 2, 3, 14):
        assert got[i] == ("und", 0.0)
    assert got[4][0] in model.languages and got[13][0] in model.languages
    assert language.identify(empty, model).count() == 0
    nothing = language.learn(empty)
    assert {r["lang_pred"] for r in language.identify(edge, nothing).collect()} == {"und"}
    changed = edge.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 100)
    again = {r["doc_id"] - 100: (r["lang_pred"], r["score"]) for r in language.identify(changed, model).collect()}
    assert again == got


def test_language_filters_match_brute_force(real):
    model = language.learn(real)
    text = real.where("doc_id = 3").first()["text"]
    letters = [c.isalpha() for c in text.lower()]
    padded = [" ", *[c if a else " " for c, a in zip(text.lower(), letters)], " "]
    grams = [tuple(map(ord, padded[i : i + 3])) for i in range(len(letters)) if letters[i]]
    codes = np.array([(a << 42) | (b << 21) | c for a, b, c in grams], np.uint64)
    masks = [0xFFFFFFFFFFFFFFFF] * len(grams)
    for slot in model._slots(codes):
        masks = [m & int(model.table[s, 0]) for m, s in zip(masks, slot.tolist())]
    false = model.false_positives()
    share = [
        (sum(m >> i & 1 for m in masks) - len(masks) * false[i]) / (1 - false[i]) / len(masks)
        for i in range(len(model.languages))
    ]
    name, score = model.predict([text])
    assert name == [model.languages[int(np.argmax(share))]]
    assert abs(score[0] - max(share)) < 1e-9


def test_language_many_labels():
    model = language.LanguageModel([f"l{i:03}" for i in range(130)], np.zeros((1 << 12, 3), np.uint64), 0)
    for i, word in ((0, "aaa"), (64, "bbb"), (129, "ccc")):
        model.add(language._grams([word])[0], i)
    assert model.predict(["aaa", "bbb", "ccc", "1", None])[0] == ["l000", "l064", "l129", "und", "und"]


# ---- 2 similar sets


def brute_classes(pairs, width, similarity):
    sets = []
    for _, text in pairs:
        w = words_in(lower(text))
        s = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
        sets.append(s)
    group = list(range(len(pairs)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= similarity * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    smallest = {}
    for g, (i, _) in zip(group, pairs):
        if i is not None:
            smallest[g] = min(smallest.get(g, i), i)
    return sorted(((i, len(s), smallest.get(g)) for (i, _), s, g in zip(pairs, sets, group)), key=repr)


def got_classes(df, width, similarity):
    rows = jaccard.similar_classes(df, width=width, similarity=similarity).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=repr)


@pytest.mark.parametrize("width,similarity", [(3, Fraction(9, 10)), (5, Fraction(8, 10)), (2, Fraction(1, 3))])
def test_similar_classes(edge, repeated, real, width, similarity):
    for df in (edge, repeated, real):
        pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        assert got_classes(df, width, similarity) == brute_classes(pairs, width, similarity)


def test_similar_classes_empty(empty):
    assert jaccard.similar_classes(empty).count() == 0


def test_similar_classes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    base = [f"t{i}" for i in range(60)]
    pairs = []
    for k in range(40):
        w = list(base)
        w[(7 * k) % 60] = f"own{k}"
        if k % 3:
            w[(11 * k + 5) % 60] = f"more{k}"
        pairs.append((k, " ".join(w), "en", "a"))
    df = spark.createDataFrame(rows_of(pairs), COLUMNS)
    plain = [(i, t) for i, t, _, _ in pairs]
    for similarity in (Fraction(8, 10), Fraction(9, 10), Fraction(85, 100)):
        assert got_classes(df, 3, similarity) == brute_classes(plain, 3, similarity)


def test_similar_classes_beyond_what_members_bring(edge, real, monkeypatch):
    monkeypatch.setattr(jaccard, "EARLIER", 1)
    for df in (edge, real):
        pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        assert got_classes(df, 2, Fraction(1, 2)) == brute_classes(pairs, 2, Fraction(1, 2))


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (103, 102), (103, 103), (102, 100)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 104)}}
    assert components.components(df.limit(0), "a", "b").count() == 0


# ---- 3 neighbours


def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q and len(y) == len(x))
            out[q] = near[:k]
    return out


def found_nearest(df, k):
    index = neighbours.build_index(df, k)
    out = defaultdict(list)
    for r in sorted(neighbours.nearest(index, df.where("vec_id % 100 = 0"), k).collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return dict(out)


def test_nearest_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_VECTORS", 400)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=32))]) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = found_nearest(df, 10), brute_nearest(rows, 10)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit / (10 * len(want)) >= 0.9
    for q in want:
        exact = {i: s for s, i in brute_nearest([*rows], 1500)[q]}
        assert all(abs(s - exact[i]) < 1e-12 for s, i in got[q])
        assert got[q] == sorted(got[q])


@pytest.mark.parametrize("size", [1e25, 1e-30, 1e150, 1e-300])
def test_nearest_of_very_large_and_small_numbers(spark, size):
    rng = np.random.default_rng(9)
    plain = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(150)]
    rows = [(i, [x * size for x in v]) for i, v in plain]
    got = found_nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 10)
    want = brute_nearest(plain, 10)
    assert {q: [i for _, i in near] for q, near in got.items()} == {q: [i for _, i in near] for q, near in want.items()}
    assert all(abs(s / size - w) < 1e-9 for q in want for (s, _), (w, _) in zip(got[q], want[q]))


def test_nearest_of_an_id_with_two_vectors(spark):
    rows = [(100, [0.5, 1.0]), (100, [9.0, 1.0]), (1, [0.0, 1.0]), (2, [10.0, 1.0]), (2, [10.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(neighbours.build_index(df, 2), df.where("vec_id = 100"), 2).collect()
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found)
    assert got == [(1, 1, 0.5), (1, 2, 1.0), (2, 1, 9.0), (2, 2, 9.5)]


def test_nearest_edges(spark):
    rows = [(100, [1.0, 0.0]), (101, [1.0, -0.0]), (102, [1.0, 0.0]), (103, [0.0, 0.0]), (104, None), (105, [float("nan"), 1.0])]
    rows += [(106, [None, 1.0]), (107, [float("inf"), 1.0]), (108, [3.0, 0.0]), (200, [0.0, 2.0]), (109, [1.0, 0.0, 0.0]), (300, [])]
    rows += [(i, [1.0, 0.0]) for i in range(1, 30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    for k in (3, 10):
        assert found_nearest(df, k) == brute_nearest(rows, k)
    assert found_nearest(df.limit(0), 3) == {}
    assert found_nearest(df.where("vec_id = 100"), 3) == {}
    # repeated rows are one query and one candidate
    assert found_nearest(df.union(df), 3) == brute_nearest(rows, 3)
    few = df.where("vec_id in (100, 108)")
    assert found_nearest(few, 10) == {100: [(2.0, 108)]}


# ---- 4 shards


@pytest.mark.parametrize("n", [1, 2, 3, 39, 40, 41, 1000, 4097])
def test_permutation(n):
    p = sharding.Permutation(n, 5)
    place = p.place_of(np.arange(n))
    assert sorted(place.tolist()) == list(range(n))
    assert (p.row_at(place) == np.arange(n)).all()


def test_shards(edge, repeated, empty, real):
    for df in (edge, repeated, real):
        rows = sharding.shard_documents(df, shards=7, seed=1).collect()
        want = Counter(
            (r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
            for r in df.select("doc_id", "text").collect()
        )
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots[i]) for i in range(7)]
        assert max(counts) - min(counts) <= 1
        permutation = sharding.Permutation(len(rows), 1)
        place = permutation.place_of(np.array([r["row_number"] for r in rows]))
        assert [(p % 7, p // 7) for p in place.tolist()] == [(r["shard"], r["slot"]) for r in rows]
    first = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_documents(edge).collect()}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_documents(edge.repartition(5)).collect()}
    assert first == again
    assert sharding.shard_documents(empty).count() == 0


# ---- 5 byte-level BPE


@pytest.fixture(scope="module")
def reference_bpe():
    ranks = {t: i for i, t in enumerate(tokens.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_byte_bpe(edge, repeated, empty, real, reference_bpe):
    for df in (edge, repeated, real):
        rows = bpe.encode(df, RANKS, public_tokenizers.PATTERN, offsets=True, decoded=True).collect()
        want = Counter((r["doc_id"], packed(reference_bpe.encode_ordinary(r["text"] or ""))) for r in df.select("doc_id", "text").collect())
        assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == want
        assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in rows)
    by_id = texts(edge)
    rows = bpe.encode(edge, RANKS, public_tokenizers.PATTERN, offsets=True, decoded=True).collect()
    vocabulary = tokens.read_ranks(RANKS)
    for r in rows:
        text = by_id[r["doc_id"]] or ""
        assert bytes(r["decoded"]).decode() == text
        for i, a, b in zip(np.frombuffer(r["ids"], "<u4"), r["starts"], r["ends"]):
            assert vocabulary[i] in text[a:b].encode() and 0 <= a < b <= len(text)
    encoded = bpe.encode(edge, RANKS, public_tokenizers.PATTERN)
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(encoded, RANKS).collect()}
    assert back == {i: t or "" for i, t in by_id.items()}
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_every_character(reference_bpe):
    encoder = tokens.UnitEncoder(tokens.tokenizer_of_ranks(tokens.read_ranks(RANKS), public_tokenizers.PATTERN), tokens.SPACE_KEPT)
    known = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    sample = [f"a{chr(c)}b1{chr(c)}{chr(c)} {chr(c)} x" for c in known if c < 0x3400 or c % 97 == 0]
    got = encoder.encode(sample)
    assert [t for t, g in zip(sample, got) if g != packed(reference_bpe.encode_ordinary(t))] == []


def test_byte_bpe_random(reference_bpe):
    encoder = tokens.UnitEncoder(tokens.tokenizer_of_ranks(tokens.read_ranks(RANKS), public_tokenizers.PATTERN), tokens.SPACE_KEPT)
    rng = np.random.default_rng(1)
    letters = np.array(list("aaabetionsr 's't'll \t\n\r  　\x1c\x1d\x85éßñ漢0123456789.,!?-_'😀"))
    sample = ["".join(rng.choice(letters, rng.integers(1, 80))) for _ in range(3000)]
    assert encoder.encode(sample) == [packed(reference_bpe.encode_ordinary(t)) for t in sample]
    spelled = ["<|endoftext|>", "a <|endoftext|> b"]
    assert encoder.encode(spelled) == [packed(reference_bpe.encode_ordinary(t)) for t in spelled]


# ---- 6 token files


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("path,units", [(WORD_JSON, tokens.SPACE_DROPPED), (BYTE_JSON, tokens.SPACE_KEPT)])
def test_units_are_encoded_as_whole_texts(real, path, units):
    encoder, whole = tokens.UnitEncoder(tokens.read_json(path), units), library(path)
    rng = np.random.default_rng(2)
    letters = np.array(list("aAbETionsr 's't \t\n\r  \x1c\x85éßñΣÉİ漢012.,!-_'😀́가 "))
    sample = ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(3000)]
    sample += [t or "" for t in texts(real).values()] + [t or "" for _, t, _, _ in EDGE]
    sample += [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}c" for c in range(0x20, 0x3100)]
    want = [packed(e.ids) for e in whole.encode_batch(sample, add_special_tokens=False)]
    assert [t for t, g, w in zip(sample, encoder.encode(sample), want) if g != w] == []


def test_pieces_after_single_spaces(real, monkeypatch):
    """Equal to the library on whole texts, also where white space stands together, and with little memory."""
    whole = library(BYTE_JSON)
    rng = np.random.default_rng(8)
    parts = ["a", "Straße", "don't", "x,y", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "é" * 70, "12", "日本", "<|endoftext|>", "ﬁ", "ß"]
    mixed = ["".join(rng.choice(parts, 30)) for _ in range(300)] + [" ".join(rng.choice(parts, 30)) for _ in range(300)]
    some = [t for _, t, _, _ in EDGE] + mixed + list(texts(real).values())
    want = [packed(whole.encode(t or "", add_special_tokens=False).ids) for t in some]
    enc = tokens.SpacedEncoder(tokens.read_json(BYTE_JSON))
    assert enc.direct and enc.encode(some) == want
    monkeypatch.setattr(tokens, "MEMORY_PIECES", 50)
    monkeypatch.setattr(tokens, "MEMORY_UNITS", 50)
    enc.direct = False
    assert enc.encode(some) == want and enc.encode(some) == want


@pytest.mark.parametrize("kind,path", [(tokens.WordEncoder, WORD_JSON), (tokens.SpacedEncoder, BYTE_JSON)])
def test_memory_of_a_worker_stays_small(kind, path, monkeypatch):
    """Words met once are not kept; of others no more than two generations, whatever has been encoded."""
    monkeypatch.setattr(tokens, "MEMORY_UNITS", 100)
    monkeypatch.setattr(tokens, "MEMORY_PIECES", 100)
    enc, whole = kind(tokens.read_json(path)), library(path)
    once = [" ".join(f"q{i}w{j}x" for j in range(50)) for i in range(200)]
    twice = [" ".join(f"a {chr(97 + i % 26)}z{j}" for j in range(50)) for i in range(200)]
    want = [packed(whole.encode(t, add_special_tokens=False).ids) for t in once + twice]
    assert enc.encode(once) + enc.encode(twice) == want
    # a batch of 64 texts may come on top of a full generation
    assert len(enc.memory.young) + len(enc.memory.old) < 6000 and "a" in enc.memory.young
    assert sum(p in enc.memory.young or p in enc.memory.old for t in once for p in t.split()) < 500


def test_words_sent_to_the_model_alone(monkeypatch):
    """Every letter, mixed pieces, odd white space and long pieces, with a memory that overflows, as the library has them."""
    monkeypatch.setattr(tokens, "MEMORY_UNITS", 300)
    monkeypatch.setattr(tokens, "MEMORY_PIECES", 200)
    library = Tokenizer.from_file(WORD_JSON)
    library.encode_special_tokens = True
    texts = [t for _, t, *_ in EDGE] + [f"x{chr(c)}y {chr(c)}{chr(c)}Z,{chr(c)}! {chr(c)}" for c in range(1, 0x500)]
    texts += ["a\x1cb c\x1f\x1ed", "a\u2003b\u3000c\u0085d\u00a0e\u200bf", "don't DON'T we'll", "x" * 70 + ", " + "y" * 65]
    texts += [" ".join(chr(97 + (i * j) % 26) * (1 + i % 5) for i in range(200)) for j in range(1, 100)]
    encode = tokens.WordEncoder(tokens.read_json(WORD_JSON))
    assert encode.direct
    wanted = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encode.encode(texts) == wanted and encode.encode(texts[::-1]) == wanted[::-1]


def test_token_files(spark, edge, repeated, empty, real, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SHARD_BYTES", 200_000)
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 2_000)
    whole = library(WORD_JSON)
    for k, df in enumerate((edge, real, repeated, empty)):
        path = str(tmp_path / f"ids{k}")
        tokenfiles.write_ids(df, path, WORD_JSON, 2)
        rows = [r.asDict() for r in tokenfiles.read_ids(spark, path).collect()]
        order = [r for r in df.select("doc_id", "text").collect()]
        want = Counter((r["doc_id"], packed(whole.encode(r["text"] or "", add_special_tokens=False).ids + [2])) for r in order)
        assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == want
        rows.sort(key=lambda r: r["start"])
        at = 0
        for r in rows:
            assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
            at += r["n_tokens"]
        ids = [r["doc_id"] for r in rows]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
    path = str(tmp_path / "ids1")
    keys = spark.createDataFrame([(5,), (5,), (77,), (-4,), (10**12,), (None,)], "doc_id long")
    got = {r["doc_id"]: r for r in tokenfiles.read_keys(spark, path, keys).collect()}
    every = {r["doc_id"]: r for r in tokenfiles.read_ids(spark, path).collect()}
    assert got == {i: every[i] for i in (5, 77)}


def test_key_index():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 62, 20_000).astype(np.uint64))
    n = np.ones(len(keys), np.int64)
    index = tokenfiles.KeyIndex.from_bytes(tokenfiles.KeyIndex.build(keys, n).to_bytes())
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    first, rows = index.find(keys)
    assert (first == np.arange(len(keys))).all() and (rows == 1).all()
    assert index.find(keys + np.uint64(1 << 63))[1].sum() <= 2


# ---- 7 exact dedup


def test_exact_copies(edge, repeated, empty, real):
    for df in (edge, repeated, real):
        pairs = [(r["doc_id"], lower(r["text"])) for r in df.select("doc_id", "text").collect()]
        groups = defaultdict(list)
        for i, t in pairs:
            groups[t].append(i)
        keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
        rows = dedup.exact_copies(df).collect()
        want = Counter((i, keep[t], len(groups[t]), hashlib.sha256(t.encode()).digest()) for i, t in pairs)
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], bytes(r["digest"])) for r in rows) == want
        stay = Counter(bytes(r["digest"]) for r in rows if r["kept"])
        assert set(stay.values()) == {1} and len(stay) == len(groups)
        assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    assert dedup.exact_copies(empty).count() == 0


def test_exact_copies_small_buckets(repeated, monkeypatch):
    want = Counter(dedup.exact_copies(repeated).drop("kept").collect())
    monkeypatch.setattr(dedup, "BUCKET_ROWS", 2)
    monkeypatch.setattr(dedup, "TASK_DIGESTS", 2)
    assert Counter(dedup.exact_copies(repeated).drop("kept").collect()) == want


def test_cuckoo_index():
    rng = np.random.default_rng(5)
    index, live = dedup.CuckooIndex(8), {}
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for step in range(20_000):
        d = digests[int(rng.integers(0, 3000))]
        if rng.random() < 0.6:
            index.insert(d, (step,))
            live[d] = (step,)
        else:
            assert index.delete(d) == (live.pop(d, None) is not None)
    assert index.stored == live and index.resizes > 3
    assert all(index.maybe(d) for d in live)
    assert all((index.get(d) is not None) == (d in live) for d in digests)
    assert sum(map(len, index.table)) == len(live)


# ---- 8 packing


def check_packing(rows, docs, size):
    whole = library(BYTE_JSON)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids), size), len(ids)] if len(ids) > first else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r["doc_id"], k, a, b - a, zlib.crc32(packed(ids[a:b])))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def best_fit_decreasing(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        best = min((g for g in gaps if g >= n), default=None)
        if best is None:
            gaps.append(size - n)
        else:
            gaps[gaps.index(best)] -= n
    return len(gaps)


@pytest.mark.parametrize("size", [1024, 64])
def test_packing(edge, repeated, real, size):
    for df in (edge, repeated, real):
        rows = packing.pack_documents(df, BYTE_JSON, 2, size=size).collect()
        n = check_packing(rows, df, size)
        lengths = [r["length"] for r in rows]
        assert n >= -(-sum(lengths) // size)
        assert n <= best_fit_decreasing(lengths, size) + 1


def test_packing_empty(empty):
    assert packing.pack_documents(empty, BYTE_JSON, 2).count() == 0


def test_packing_plan_uses_every_piece():
    rng = np.random.default_rng(6)
    for size, most in ((10, 10), (64, 64), (1024, 1024), (1024, 300), (1024, 700)):
        for _ in range(5):
            counts = Counter(rng.integers(1, most + 1, rng.integers(1, 400)).tolist())
            shapes = packing.plan(dict(counts), size)
            used = Counter()
            for shape, n in shapes:
                assert n > 0 and sum(shape) <= size
                for x in shape:
                    used[x] += n
            assert used == counts
            assert sum(n for _, n in shapes) <= best_fit_decreasing(list(counts.elements()), size) * 1.02 + 1
    assert packing.plan({600: 10**9, 424: 10**9}, 1024) == [((600, 424), 10**9)]
    assert packing.plan({500: 6, 24: 1, 262: 8}, 1024)[0] == ((500, 500, 24), 1)


# ---- 9 substring dedup


def brute_repeats(pairs, width):
    split = [(i if i is not None else -(1 << 70), words_in(t)) for i, t in pairs]
    first = {}
    for i, w in split:
        for p in range(len(w) - width + 1):
            s = tuple(w[p : p + width])
            first[s] = min(first.get(s, (i, p)), (i, p))
    out = []
    for (i, _), (key, w) in zip(pairs, split):
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p : p + width])] != (key, p):
                gone.update(range(p, p + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [20, 4, 8])
def test_remove_repeats(edge, repeated, real, width):
    for df in (edge, repeated, real):
        pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        got = [tuple(r) for r in substring.remove_repeats(df, width=width).collect()]
        assert sorted(got, key=repr) == brute_repeats(pairs, width)


def test_remove_repeats_many_chunks(real, monkeypatch):
    from skygalley.llm import exchange

    monkeypatch.setattr(exchange, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 50_000)
    pairs = [(r["doc_id"], r["text"]) for r in real.select("doc_id", "text").collect()]
    got = [tuple(r) for r in substring.remove_repeats(real, width=6).collect()]
    assert sorted(got, key=repr) == brute_repeats(pairs, 6)
    assert got_classes(real, 2, Fraction(2, 5)) == brute_classes(pairs, 2, Fraction(2, 5))


def test_remove_repeats_carries(edge, empty):
    rows = substring.remove_repeats(edge, carry=["text", "n_chars", "row"]).collect()
    assert {(r["doc_id"], r["text"], r["row"]) for r in rows} == {(i, t, 8) for i, t, _, _ in EDGE}
    assert substring.remove_repeats(empty).count() == 0


# ---- 10 licenses


def brute_scan(pairs):
    out = []
    for i, text in pairs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places = {k: [p for p in range(len(w)) if tuple(w[p : p + len(v)]) == v] for k, v in licenses.PHRASES.items()}
        every = sorted(p for v in places.values() for p in v)
        base = sorted(k for k, v in places.items() if v)
        best, added = 0.0, set()
        for label, template in licenses.TEMPLATES.items():
            t = set(template.split())
            size, step = licenses.window(template)
            for start in range(0, len(w), step):
                share = len(t & set(w[start : start + size])) / len(t)
                if share >= licenses.CONTAINMENT - 1e-9:
                    best = max(best, share)
                    added.add(label)
        score = 1.0 if base else best
        first, last = (every[0], every[-1]) if every else (None, None)
        out.append((i, len(w), len(every), first, last, ",".join(base), ",".join(sorted(added | set(base))), score))
    return sorted(out, key=repr)


def test_license_scan(spark, edge, repeated, empty, real):
    more = [
        (50, "x " * 100 + licenses.TEMPLATES["mit-text"].upper() + " y" * 70, "en", "a"),
        (51, "cc by cc by all rights reserved general public license", "en", "a"),
        (52, "cc", "en", "a"),
        (53, "by", "en", "a"),
        (54, "redistribution use source binary forms modification permitted provided following conditions met and", "en", "a"),
        (55, "worK this is licensed under the gnu general public version", "en", "a"),
    ]
    notices = spark.createDataFrame(rows_of(more), COLUMNS)
    for df in (edge, repeated, real, notices):
        pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        assert sorted((tuple(r) for r in licenses.scan(df).collect()), key=repr) == brute_scan(pairs)
    assert licenses.scan(empty).count() == 0
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan(notices).collect()}
    assert labels[50] == "mit-text" and "bsd" not in labels[51]


def test_license_scan_of_nulls_without_ansi(spark, edge):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        found = licenses.scan(edge).where("doc_id <= 3").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [(r["n_words"], r["labels"], r["score"]) for r in found] == [(0, "", 0.0)] * 3


def test_license_scan_is_native(edge):
    plan = licenses.scan(edge)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan)


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software. "
)
MIT_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY."
)
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
)


def test_license_parts_of_texts(spark):
    pad = "x " * 45
    rows = [(1, MIT), (2, pad + MIT_END), (3, pad + BSD_END), (4, pad + GPL)]
    df = spark.createDataFrame(rows_of([(i, t, "en", "a") for i, t in rows]), COLUMNS)
    assert sorted((tuple(r) for r in licenses.scan(df).collect()), key=repr) == brute_scan(rows)
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan(df).collect()}
    assert labels == {
        1: "mit-notice,mit-rights,mit-text",
        2: "as-is-warranty,mit-liability",
        3: "as-is-warranty,bsd-liability",
        4: "gnu-gpl,gnu-notice,gnu-warranty,gpl",
    }


def test_license_templates_of_any_length(spark):
    long = " ".join(f"t{i}" for i in range(90))
    middle = " ".join(f"m{i}" for i in range(50))
    rows = [(i, "x " * i + f"{long} " + "y " * 33 + middle) for i in (0, 17, 31, 50, 89, 120)]
    df = spark.createDataFrame(rows_of([(i, t, "en", "a") for i, t in rows]), COLUMNS)
    found = licenses.scan(df, templates={"long": long, "middle": middle, "short": "t1 t2"}).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in found} == {i: ("long,middle,short", 1.0) for i, _ in rows}
    for wrong in ("", "Upper case", "full stop."):
        with pytest.raises(ValueError):
            licenses.scan(df, templates={"wrong": wrong})


def test_license_names_of_others(spark):
    lines = {
        "licensed under cc by 4.0": "cc-by",
        "released under the bsd license": "",
        "licensed under the Mozilla Public License, version 2.0": "mpl",
        "this work is licensed under the Eclipse Public License version 2.0": "",
        "released under the MIT license": "mit",
        "licensed under MIT license": "mit",
        "Licensed under the Apache License, Version 2.0": "apache-2.0",
        "licensed under cc by-nc 4.0": "cc-by,cc-by-nc",
        "this work is licensed under the gnu general public license version 3": "gnu-gpl,gpl",
        "She studied at MIT under a professor who lost her driving license": "",
        "please cc everyone by noon the NC office is closed": "",
        "the apache helicopter needs a license version 2 and 0 defects": "",
        "mozilla is a public company and needs a license": "",
    }
    df = spark.createDataFrame(rows_of([(i, t, "en", "a") for i, t in enumerate(lines)]), COLUMNS)
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(df).collect()} == dict(enumerate(lines.values()))


def test_passages_are_offered_in_little_memory():
    """Arrays over the bytes of a chunk are made slice by slice: a task needs far less than they would take for the whole."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 1 << 30, 2_000)) for _ in range(200)]
    chunk = pa.table({"doc_id": list(range(len(texts))), "text": texts})
    substring._offer(0, chunk.slice(0, 100), 10, 1)  # grows the tables of powers
    tracemalloc.start()
    try:
        substring._offer(0, chunk, 10, 1)
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("kind,path", [(tokens.WordEncoder, WORD_JSON), (tokens.SpacedEncoder, BYTE_JSON)])
def test_marks_after_a_word_are_learned_once(kind, path, monkeypatch):
    """Words that marks end are not cut by the pattern: each word and each run of marks is learned by itself."""
    whole = library(path)
    words = ["then", "Straße", "QUELLE", "é", "x" * 70]
    marks = [".", ",", "&&&", ".%%%", "!!", "'", "'s", "''", "-", "_", ")", ".5", "\x1f.", "…"]
    some = [f"{w}{m} a {w}{m} ({w}{m}\n{w}{m}" for w in words for m in marks] + [".", " . ", "a.", ""]
    enc = kind(tokens.read_json(path))
    want = [packed(whole.encode(t, add_special_tokens=False).ids) for t in some]
    assert enc.encode(some) == want and enc.encode(some[::-1]) == want[::-1]
    cut = []
    find = enc.units.find
    monkeypatch.setattr(enc.units, "find", lambda text: cut.append(text) or find(text))
    enc.encode([f"a {w}&&&" for w in ("one", "two", "three")] * 50)
    assert set(cut) <= {"a", "&&&"}
