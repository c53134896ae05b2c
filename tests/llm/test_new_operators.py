"""Collocations, hard negatives and byte-level BPE on odd rows, against brute
force and the libraries, and on empty tables."""

from __future__ import annotations

import hashlib
import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from chronoframe.llm import byte_bpe, collocations, hard_negatives
from chronoframe.llm.queries import MULTI_BPE

VECTORS = "vec_id long, embedding array<float>, label int, score long, row long, c string"


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=brute.key)


def expected(found):
    return sorted(found, key=brute.key)


# -- collocations ------------------------------------------------------------------


def phrases(seed, n):
    """Words of a few letters, set phrases, marks that end pieces, odd space."""
    rng = random.Random(seed)
    fixed = ["new york", "New York City", "in the middle of", "au fur et à mesure", "x x x x", "so so"]
    out = []
    for _ in range(n):
        out.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice("abcdeé") + rng.choice("fgh"))
        out.append(rng.choice([" "] * 12 + ["\t", "  ", ". ", ", ", "\n", "\r\n", "\x0b", "!", " ;", "\xa0", "\x00"]))
    return "".join(out)


@pytest.fixture(scope="module")
def phrase_docs():
    langs = ["en", "fr", None, "en", "", "t\tab"]
    docs = [(i, phrases(i, 60 + 40 * (i % 5)), langs[i % 6]) for i in range(120)]
    return [*docs, (None, phrases(7, 200), "en"), (900, None, "en"), (901, "", "xx"), (902, " . \n", "xx"), (903, "late " * 40, "xx"),
            (904, phrases(5, 20_000), "fr"), *docs[:3], docs[0]]


def test_collocations(spark, phrase_docs):
    df = spark.createDataFrame([(i, t, g, 7, "k", 1) for i, t, g in phrase_docs], "doc_id long, text string, lang string, n long, key string, start int")
    want = brute.collocations(phrase_docs)
    assert len({w[0] for w in want}) > 3 and any(len(w[2].split()) == 4 for w in want) and any(w[0] == "und" for w in want)
    for shards in (1, 4):
        assert collected(collocations.collocations(df.repartition(3), shards=shards)) == expected(want)
    assert collected(collocations.collocations(df, threshold=50, limit=3)) == expected(brute.collocations(phrase_docs, 50, 3))


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")).collect() == []


def test_phrases_that_pass_the_table_by_chance_change_nothing(spark, phrase_docs):
    """A table of 64 places is soon full: more is counted, with equal results."""
    df = spark.createDataFrame([(t, g) for _, t, g in phrase_docs], "text string, lang string")
    assert collected(collocations.collocations(df, slots=64)) == expected(brute.collocations(phrase_docs))


def test_longer_phrases_wait_for_their_parts():
    coded, joined = collocations._words(pa.array(["a b c d. a b"]))
    words, code = coded.dictionary, coded.indices.to_numpy()
    table = np.full(1 << 10, 255, np.uint8)

    def counted(step):
        found = list(collocations._count(words, code, joined, "en", table, step, 4))
        return sorted((p, int(n)) for phrases, _, ns in found if phrases is not None for p, n in zip(phrases.to_pylist(), ns, strict=True))

    def latest(step):
        return next(int(start[0]) for phrases, start, _ in collocations._count(words, code, joined, "en", table, step, 4) if phrases is None)

    every = [("", 6), ("a", 2), ("b", 2), ("c", 1), ("d", 1)]
    assert counted(0) == counted(1) == every and latest(1) == 0
    for place in collocations._places(collocations._hashes(["a", "b", "c"], "en"), len(table)):
        table[place] = 1  # three words reached in step 1: their pairs are counted for one cycle from step 2
    assert counted(1) == every and counted(2) == sorted([*every, ("a b", 2), ("b c", 1)])
    assert counted(5) == [("a b", 2), ("b c", 1)] and counted(6) == [] and latest(1) == latest(6) == 2
    for pair, step in ((("a", "b"), 3), (("b", "c"), 1)):
        for place in collocations._places(collocations._longer(*(collocations._hashes([w], "en") for w in pair)), len(table)):
            table[place] = step
    # "b c" passes before it is counted itself, as by chance: no sooner than after its first step
    assert latest(3) == 4 and counted(4) == [("a b", 2), ("a b c", 1), ("b c", 1)]
    assert counted(7) == [("a b c", 1)] and counted(8) == []


# -- hard negatives ----------------------------------------------------------------


def odd_vectors(scale=1.0):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.12 * scale, (400, 8)).astype(np.float32).astype(float)
    rows = [(i, [float(x) for x in v], int(i % 4) if i % 3 else 9) for i, v in enumerate(base)]
    same = rows[100][1]
    rows += [(1000 + i, same, i % 2) for i in range(60)]  # one very common vector
    rows += [(5, None, 1), (6, [1.0, None] + [0.0] * 6, 1), (8, [float("nan")] * 8, 2), (9, [float("inf")] * 8, 2), (11, same, None)]
    rows += [(None, same, 1), (None, rows[3][1], 2), (200, rows[1][1], 3), (200, rows[2][1], 1), (-100, same, 1), (2100, [0.5, -0.5], 2),
             (2200, [], 3), (2300, [0.0] * 8, 77), rows[100], rows[200]]
    return rows


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e9])
def test_hard_negatives(spark, scale, monkeypatch):
    """Doubles, 64-bit integers and integers of any size give the exact scores."""
    rows = odd_vectors(scale) if scale < 1e9 else [(i, [float(np.float32(x * 3e7)) for x in (v or [])[:3]] if v else v, y) for i, v, y in odd_vectors()[:120]]
    monkeypatch.setattr(hard_negatives, "BATCH_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "STRIDE", 3)
    df = spark.createDataFrame([(i, v, y, 3, 4, "x") for i, v, y in rows], VECTORS).repartition(3)
    got = collected(hard_negatives.hard_negatives(df).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    assert got == expected(brute.hard_negatives(rows)) and len(got) > 5


def test_anchor_blocks_give_the_same(spark, monkeypatch):
    rows = odd_vectors()
    df = spark.createDataFrame([(i, v, y, 3, 4, "x") for i, v, y in rows], VECTORS)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 1500)
    assert collected(hard_negatives.hard_negatives(df)) == expected(brute.hard_negatives(rows))


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    assert hard_negatives.hard_negatives(spark.createDataFrame([(100, [1.0], 1, 0, 0, "")], VECTORS)).collect() == []


def test_bounds_shrink_the_bitmap():
    """A row that no window can take is out before its last column is read."""
    rng = np.random.default_rng(1)
    columns = np.floor(256 * rng.normal(0, 1, (64, 2000)) / np.arange(1, 65)[:, None])
    anchor = (0, 0, 1, list(1 / np.arange(1, 65) ** 2), [(-(1 << 127), 1 << 127)])
    search = hard_negatives.Search(hard_negatives.Anchors([anchor], 64, 5, True))
    ids = np.arange(1, 2001)
    search.add(ids, ids, np.ones(2000, np.int64), columns)
    left, _ = search._scan(0, columns, np.ones(2000, bool), search.anchors.vectors[0], columns.min(1), columns.max(1))
    assert 5 <= len(left) < 50


# -- byte-level BPE ----------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(MULTI_BPE), special_tokens={})


def test_byte_bpe(odd, odd_docs, empty, library):
    got = collected(byte_bpe.digests(odd, MULTI_BPE, public_tokenizers.PATTERN))
    want = []
    for doc_id, text in odd_docs:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == expected(want)
    assert byte_bpe.digests(empty, MULTI_BPE, public_tokenizers.PATTERN).collect() == []


def test_ids_decode_on_their_own(spark, odd, odd_docs):
    encoded = byte_bpe.encode(odd, MULTI_BPE, public_tokenizers.PATTERN)
    got = collected(byte_bpe.decode(encoded.withColumn("bytes", F.lit(1)), MULTI_BPE))
    assert [(i, bytes(b)) for i, b in got] == expected((i, (t or "").encode()) for i, t in odd_docs)
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {bytes(r.bytes) for r in byte_bpe.decode(nothing, MULTI_BPE).collect()} == {b""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [50_256])], "doc_id long, ids array<int>"), MULTI_BPE).collect()


@pytest.mark.parametrize("text", [
    "a" * 5000, "ab" * 3000, "th" * 4000, " " * 5000, "=-" * 3000, "日本語" * 500, "abba" * 20 + "baab" * 30,
    "".join(random.Random(1).choice("etaoinsh") for _ in range(9000)), "".join(random.Random(2).choice("ab") for _ in range(5000)),
    "".join(random.Random(3).choice("0123456789") for _ in range(9000)), "".join(random.Random(4).choice("abcdefghij'") for _ in range(9000)),
])
def test_long_words(library, text):
    bpe = byte_bpe.ByteBpe(MULTI_BPE, public_tokenizers.PATTERN)
    ids, counts = bpe.encode(["", text, "x"])
    assert ids.tolist() == [*library.encode_ordinary(text), *library.encode_ordinary("x")] and counts[0] == 0
    assert bpe.decode(ids, counts) == [b"", text.encode(), b"x"]
    assert not bpe.young or max(map(len, bpe.young)) <= byte_bpe.CACHE_WORD


def test_the_cache_is_bounded_in_bytes(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 20_000)
    bpe = byte_bpe.ByteBpe(MULTI_BPE, public_tokenizers.PATTERN)
    for i in range(30):
        text = " ".join(f"w{i}x{j}" for j in range(40))
        assert bpe.encode([text])[0].tolist() == library.encode_ordinary(text)
        assert bpe.held < 20_000
        assert len(bpe.young) + len(bpe.old) < 120
