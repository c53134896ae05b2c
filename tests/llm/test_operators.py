"""Every operator on odd rows, against brute force, and on empty tables."""

from __future__ import annotations

import hashlib
import math
import os
import subprocess
import sys
from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import SCHEMA, prose, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronoframe.llm import (
    decontaminate,
    fingerprints,
    grammar_tokens,
    jaccard_join,
    licenses,
    line_dedup,
    lm_scoring,
    packing,
    quality,
    token_counts,
)
from chronoframe.llm.queries import BYTE_BPE, WORD_BPE
from chronoframe.session import scratch_path


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=brute.key)


def expected(found):
    return sorted(found, key=brute.key)


def test_line_dedup(odd, odd_docs, empty):
    out = line_dedup.dedup_lines(odd, min_words=50)
    assert out.columns == [*odd.columns, "deleted_lines"]
    gone = brute.line_dedup(odd_docs, 50)
    got = collected(out.select("doc_id", "text", F.array_join(F.col("deleted_lines").cast("array<string>"), ",")))
    want = []
    for doc_id, text in odd_docs:
        dead = gone.get((doc_id, text or ""), set())
        kept = None if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if p not in dead)
        want.append((doc_id, kept, ",".join(map(str, sorted(dead))) if dead else None))
    assert got == expected(want)
    assert any(x[2] for x in got)
    assert line_dedup.dedup_lines(empty).count() == 0
    kept = line_dedup.without_copies(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 10 not in ids and 12 in ids and 2 in ids and 1 in ids


def test_line_runs_of_several_lines(spark):
    lines = [prose(50 + i, 12).replace("\n", " ") for i in range(9)]
    docs = [(1, "\n".join(lines)), (2, "new start\n" + "\n".join(lines[2:8]) + "\nnew end"), (3, "\n".join(lines[3:6])), (4, "\n".join([lines[0]] * 9))]
    df = spark.createDataFrame(rows(docs), SCHEMA)
    got = {r.doc_id: set(r.deleted_lines) for r in line_dedup.dedup_lines(df, 50).collect() if r.deleted_lines}
    assert got == {k[0]: v for k, v in brute.line_dedup(docs, 50).items()}
    assert got[2] == set(range(1, 7)) and 3 not in got


def test_a_document_of_very_many_lines_that_is_a_copy(spark):
    """Deleting its lines takes time in proportion to them."""
    import time

    lines = [f"line {i} of a very long text that comes twice" for i in range(40_000)]
    docs = [(1, "\n".join(lines)), (2, "own start\n\n" + "\n".join(lines) + "\nown end")]
    df = spark.createDataFrame(rows(docs), SCHEMA)
    found = line_dedup.written(line_dedup.copies(df).toDF("d", "h", "p"), "copies")
    began = time.time()
    gone = found.select(line_dedup._flags("p").alias("f")).first().f
    assert gone == [False, False] + [True] * 40_000 and time.time() - began < 20


def test_flags_of_positions(spark):
    df = spark.createDataFrame([([0],), ([2, 3, 7],), ([0, 1, 2],)], "p array<int>")
    got = [r.f for r in df.select(line_dedup._flags("p").alias("f")).collect()]
    assert got == [[True], [False, False, True, True, False, False, False, True], [True] * 3]


def test_grammar_tokens_round_trip(spark, odd, odd_docs, empty):
    ids = brute.encoded(odd_docs, Tokenizer.from_file(WORD_BPE))
    path = scratch_path(spark, "tokens")
    grammar_tokens.write_tokens(odd, WORD_BPE, path)
    got = grammar_tokens.decoded(spark, path).collect()
    values = [np.frombuffer(r.ids, "<u4").tolist() for r in got]
    assert expected((r.doc_id, r.n_tokens, tuple(v)) for r, v in zip(got, values, strict=True)) == expected(
        (d, len(x), tuple(x)) for (d, _), x in zip(odd_docs, ids, strict=True)
    )
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))
    # one document at a time, and the stored expansion lengths
    by_doc = defaultdict(list)
    for (d, _), x in zip(odd_docs, ids, strict=True):
        by_doc[d].append(x)
    for shard in (r.asDict() for r in spark.read.schema(grammar_tokens.SHARD_SCHEMA).parquet(path).collect()):
        docs = np.frombuffer(shard["doc_ids"], np.int64)
        null = np.unpackbits(np.frombuffer(shard["doc_null"], np.uint8), count=docs.size)
        for i, d in enumerate(docs.tolist()):
            assert grammar_tokens.decode_document(shard, i).tolist() in by_doc[None if null[i] else d]
        lengths = np.frombuffer(shard["expansion"], np.uint32)
        symbols = np.frombuffer(shard["symbols"], np.uint16).astype(int)
        total = np.concatenate([np.ones(shard["first_symbol"], int), lengths])[symbols].sum()
        assert total == shard["n_tokens"]
    nothing = scratch_path(spark, "tokens")
    grammar_tokens.write_tokens(empty, WORD_BPE, nothing)
    assert grammar_tokens.decoded(spark, nothing).count() == 0


def test_grammar_reduces_repeats():
    ids = np.tile(np.arange(40, dtype=np.uint16), 200)
    seq, rules, symbols = grammar_tokens.repair(ids, np.array([ids.size]), 49408)
    assert seq.size < 0.6 * ids.size and len(rules) and symbols.tolist() == [seq.size]


def test_grammar_goes_on_until_no_pair_is_frequent(monkeypatch):
    """A passage in many copies becomes a few symbols, with clashing slots too,
    and a part of a document is read by the stored lengths."""
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 40_000, 1000)
    docs = [np.concatenate([rng.integers(0, 40_000, 5), passage, [1]]) for _ in range(40)]
    lengths, ids = np.array([d.size for d in docs]), np.concatenate(docs).astype(np.uint16)
    for bits in (grammar_tokens._HASH_BITS, 3):
        monkeypatch.setattr(grammar_tokens, "_HASH_BITS", bits)
        seq, rules, symbols = grammar_tokens.repair(ids, lengths, 49408)
        assert seq.size < 40 * 12 and symbols.sum() == seq.size
        assert np.array_equal(grammar_tokens._expand(seq, rules, 49408), ids)
        row = {
            "first_symbol": 49408, "rules": rules.tobytes(), "symbols": seq.tobytes(), "doc_symbols": symbols.astype(np.uint32).tobytes(),
            "expansion": grammar_tokens.expansion_lengths(rules, 49408).tobytes(), "doc_tokens": lengths.astype(np.uint32).tobytes(),
        }
        for i, start, stop in ((0, 0, 3), (7, 4, 900), (39, 1000, 1006), (39, 500, 501), (3, 9, 9), (5, 0, 1006)):
            assert grammar_tokens.decode_range(row, i, start, stop).tolist() == docs[i][start:stop].tolist()
        assert grammar_tokens.decode_document(row, 12).tolist() == docs[12].tolist()


def test_fingerprints(odd_docs, spark, empty):
    docs = list({d: (d, t) for d, t in odd_docs if d is not None}.values())
    df = spark.createDataFrame(rows(docs), SCHEMA)
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(df).collect()}
    ordered = sorted((d, t or "") for d, t in docs)

    def sets(text):
        ws = text.split()
        return {tuple(ws[i: i + 5]) for i in range(max(1, len(ws) - 4))}

    for i, (d, t) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        k = len(t) // 4
        edited = t[: len(t) - k] + following[:k]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        if not set(t) & set("\x1c　"):
            a, b, c = sets(t), sets(edited), sets(following)
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 0.15
            assert abs(r.near_next - len(a & c) / len(a | c)) < 0.15
    assert got[0].fingerprint == got[10].fingerprint and got[1].fingerprint == got[2].fingerprint
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_fingerprints_of_repeated_rows_and_null_ids(odd, odd_docs):
    got = fingerprints.fingerprint_documents(odd).select("doc_id", "fingerprint", "near_edited").collect()
    assert len(got) == len(odd_docs)
    assert len({(r.fingerprint, r.near_edited) for r in got if r.doc_id == 0}) == 1
    assert sum(r.doc_id is None for r in got) == 2


def test_decontaminate(odd, odd_docs, spark, empty):
    schema = "item_id long, text string, h long"
    items = [(0, prose(1, 40)), (1, None), (2, ""), (3, "one two"), (4, prose(3, 25)), (None, "ONE"), (5, prose(1, 40)), (6, "not in any document at all really")]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], schema)
    found = decontaminate.decontaminate(odd, benchmark)
    got = found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.array_join("items", ","), 256), "contaminated"
    )
    want = brute.contamination(odd_docs, items)
    assert collected(got) == expected(want) and any(x[5] for x in want)
    clean = decontaminate.uncontaminated(odd, benchmark)
    assert clean.columns == odd.columns and clean.count() == sum(not x[5] for x in want)
    assert decontaminate.decontaminate(empty, benchmark).count() == 0
    none = decontaminate.decontaminate(odd, benchmark.limit(0)).collect()
    assert len(none) == len(odd_docs) and not any(r.contaminated for r in none)


def test_decontaminate_in_blocks(odd, odd_docs, spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 5)
    items = [(0, prose(1, 40)), (4, prose(3, 25))]
    found = decontaminate.decontaminate(odd, spark.createDataFrame(items, "item_id long, text string"))
    assert collected(found.select("doc_id", "n_hit")) == expected((x[0], x[2]) for x in brute.contamination(odd_docs, items))


@pytest.mark.parametrize(("dense", "pivots"), [(64, 8), (2, 1)])
def test_jaccard_components(odd, odd_docs, spark, monkeypatch, dense, pivots):
    """A group of chained near copies, and dense columns when the limit is low."""
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    ws = prose(5, 200).split()
    chain = []
    for i in range(14):
        ws = list(ws)
        ws[(i * 13) % 190] = f"new{i}"
        chain.append((100 + i, " ".join(ws)))
    docs = [*odd_docs, *chain]
    df = odd.unionByName(spark.createDataFrame(rows(chain), SCHEMA))
    got = jaccard_join.jaccard_components(df).select("doc_id", "n_shingles", "component_id")
    assert collected(got) == expected(brute.jaccard(docs))


def test_most_frequent_grams(spark, monkeypatch):
    """As many as there is room for, however low their counts are."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 10)
    counts = spark.createDataFrame([(-i, 1 + i * i) for i in range(20)], "id long, n long")
    grams, times = jaccard_join.most_frequent(counts, 5000)
    assert grams.tolist() == sorted(grams.tolist()) and 7 <= len(grams) <= 10
    assert sorted(times.tolist()) == [1 + i * i for i in range(20)][-len(grams):]
    assert len(jaccard_join.most_frequent(counts.filter("n < 3"), 5000)[0]) == 1  # 2, but not 1
    assert not len(jaccard_join.most_frequent(counts.limit(0), 0)[0])


def test_rare_grams_leave_dense_columns(spark, monkeypatch):
    """Phrases that many texts share, none frequent enough to be told apart
    beforehand, are not left to rounds of pivots."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 20)
    shared = [prose(900 + i, 4) for i in range(24)]
    docs = [(i, " ".join(f"{prose(1000 + 30 * i + k, 12)} d{i}x{k} {p}" for k, p in enumerate(shared))) for i in range(30)]
    docs += [(100 + i, f"{docs[i][1]} more{i}") for i in range(3)]
    left = []

    def counted(dense, labels, pivots, of=jaccard_join._dense_round):
        left.append(dense.count())
        return of(dense, labels, pivots)

    monkeypatch.setattr(jaccard_join, "_dense_round", counted)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows(docs), SCHEMA)).select("doc_id", "n_shingles", "component_id")
    assert collected(got) == expected(brute.jaccard(docs))
    assert sum(left) < 60


def test_components_make_few_files(spark, monkeypatch):
    """Few links make few files and few tasks, whatever the number of shuffle partitions."""
    files = []

    def recorded(df, name, of=jaccard_join.written):
        out = of(df, name)
        files.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(jaccard_join, "written", recorded)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 40)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = spark.createDataFrame([(i, i + 1) for i in range(60) if i % 10 != 9], "a long, b long")
        got = {r.c: r.top for r in jaccard_join.components(edges).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 10 for i in range(60)}
    assert files and {n for _, n in files} == {1}


def test_one_of_each_group_stays(odd, odd_docs, empty):
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted(((r.doc_id is not None, r.doc_id or 0) for r in kept.select("doc_id").collect()))
    want = {}
    for i, (d, n, c) in enumerate(brute.jaccard(odd_docs)):
        want.setdefault((i,) if not n else ("group", c), d)
    assert ids == sorted((d is not None, d or 0) for d in want.values())
    assert jaccard_join.one_of_each(empty).count() == 0


def test_quality(spark, odd, odd_docs, empty):
    good = [(i, prose(200 + i, 80)) for i in range(300)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(600 + i, 80).split())) for i in range(300)]
    labels = [(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad] + [(None, 1, 0), (5000, None, 0), (3, 1, 0), (3, 0, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(rows([*good, *bad]), SCHEMA).unionByName(odd)
    got = quality.classify(df, table).collect()
    assert len(got) == 600 + len(odd_docs)
    held = [r for r in got if r.held_out and r.doc_id is not None and (r.doc_id < 300 or 1000 <= r.doc_id < 1300) and r.doc_id > 20]
    assert len(held) > 60 and all(r.predicted == (r.doc_id < 1000) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (brute.crc(r.doc_id, 5) == 0) for r in got)
    kept = quality.accepted(df, table)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got)
    unlabelled = quality.classify(odd, table.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert quality.classify(empty, table).count() == 0


def test_quality_training_against_plain_ftrl():
    rng = np.random.default_rng(3)
    rows_, labels = [], []
    for i in range(40):
        at = np.sort(rng.choice(300, 12, replace=False)).astype(np.int32)
        x = rng.random(12).astype(np.float32)
        rows_.append((np.append(at, np.int32(1 << quality.BITS)), np.append(x, np.float32(1))))
        labels.append(int(x[at < 100].sum() > 2))
    got = quality.train(rows_, np.array(labels))
    passes = max(quality.EPOCHS, -(-quality.UPDATES // len(rows_)))
    plain = [dict(zip(at.tolist(), x.tolist(), strict=True)) for at, x in rows_]
    want = brute.ftrl(plain, labels, passes, quality.ALPHA, quality.BETA, quality.L1, quality.L2)
    assert np.flatnonzero(got).tolist() == sorted(i for i, w in want.items() if w)
    assert all(abs(got[i] - w) < 1e-6 for i, w in want.items()) and 0 < len(want) <= 301


def test_quality_features_and_scores_against_plain_counts(spark, odd, odd_docs):
    """Equal n-grams share a place; a text's score is the mean weight of its
    n-grams, very long texts and words included."""
    import pyarrow as pa

    docs = [t or "" for _, t in odd_docs] + ["x" * 5000 + "1 " + "x" * 5000 + "2", "Word-Form-Longer-Than-12a Word-Form-Longer-Than-12!"]
    places, sizes = quality.Features()(pa.array(docs))
    found: dict = {}
    for text, own in zip(docs, np.split(places, np.cumsum(sizes)[:-1]), strict=True):
        grams = brute.quality_grams(text)
        assert len(grams) == len(own)
        for gram, place in zip(grams, own.tolist(), strict=True):
            assert found.setdefault(gram, place) == place
    assert len(set(found.values())) > 0.9 * len(found)  # few share a place by chance
    model = np.random.default_rng(0).normal(0, 1, (1 << quality.BITS) + 1).astype(np.float32)
    got = {(r.doc_id, r.text): r.s for r in quality.score(odd, model, "s").collect()}
    for (doc_id, text), own in zip(odd_docs, np.split(places, np.cumsum(sizes)[:-1]), strict=False):
        mean = model[own].astype(float).mean() if own.size else 0.0
        assert abs(got[doc_id, text] - 1 / (1 + math.exp(-mean - model[-1]))) < 1e-9


def test_quality_cache_is_bounded_in_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(quality, "CACHE_BYTES", 50_000)
    features = quality.Features()
    for i in range(30):
        features(pa.array([" ".join(f"{i}w{j}" for j in range(100)), "y" * 20_000 + str(i)]))
        assert features.held < 100_000 and max(map(len, features.forms)) <= 256


def test_scoring_leaves_no_forms_in_idle_workers(spark):
    import pyarrow as pa

    docs = spark.createDataFrame(rows([(i, prose(i, 60)) for i in range(200)]), SCHEMA).repartition(4)
    quality.score(docs, np.zeros((1 << quality.BITS) + 1, np.float32)).agg(F.sum("score")).collect()

    def kept(batches):
        from chronoframe.llm import encoding

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(len(getattr(x, "forms", ())) for x in encoding._HELD.values())], pa.int64())})

    assert not any(r.n for r in spark.range(64, numPartitions=32).mapInArrow(kept, "n long").collect())


def test_a_task_gives_its_memory_back():
    # on its own, so that no other test's allocations are counted
    code = """
import re
import numpy as np
import pyarrow as pa
from chronoframe.llm import encoding
def held():
    return int(re.search(r"Anonymous: +([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
def run(batches):
    for batch in batches:
        some = [np.ones(6_000) for _ in range(2_000)]
        pinned.append(np.ones(6_000))
        yield batch
pinned, before = [], held()
assert list(encoding.released(run)([1, 2])) == [1, 2]
assert held() - before < 30, held() - before
"""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=60)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_token_counts(odd, odd_docs, empty, path):
    library = Tokenizer.from_file(path)
    more = [(i, t or "") for i, t in odd_docs]
    counts = [len(x.ids) for x in library.encode_batch([t for _, t in more], add_special_tokens=False)]
    got = collected(token_counts.token_counts(odd, path))
    assert got == expected((d, len(t.encode()), n, n > 512) for (d, t), n in zip(more, counts, strict=True))
    assert token_counts.token_counts(empty, path).count() == 0


def test_token_counts_of_sentencepiece(odd, odd_docs):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    got = collected(token_counts.token_counts(odd, path).select("doc_id", "n_tokens"))
    assert got == expected((d, len(library.encode(t or ""))) for d, t in odd_docs)


def test_token_counter_forgets_and_learns_again(odd_docs, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_counts, "CACHE_BYTES", 5_000)
    texts = pa.array([t or "" for _, t in odd_docs])
    library = Tokenizer.from_file(BYTE_BPE)
    counter = token_counts.TokenCounter(BYTE_BPE)
    want = [len(x.ids) for x in library.encode_batch(texts.to_pylist(), add_special_tokens=False)]
    assert counter.count(texts).tolist() == want and counter.count(texts).tolist() == want


def test_caches_are_bounded_in_bytes(monkeypatch):
    """Texts without spaces are counted and encoded, and not kept."""
    import pyarrow as pa

    from chronoframe.llm import encoding

    monkeypatch.setattr(token_counts, "CACHE_BYTES", 30_000)
    monkeypatch.setattr(encoding, "CACHE_BYTES", 30_000)
    counter, encoder = token_counts.TokenCounter(BYTE_BPE), encoding.WordEncoder(WORD_BPE)
    bytewise, wordwise = Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)
    for i in range(25):
        texts = [f"{'ab1' * 7000}{i} end", "".join(f"w{i}x{j}! " for j in range(60)) + "?" * 900, ("x" * 400 + ". ") * 3]
        block = pa.array(texts)
        assert counter.count(block).tolist() == [len(x.ids) for x in bytewise.encode_batch(texts, add_special_tokens=False)]
        ids, lengths = encoder.encode(block)
        want = [x.ids for x in wordwise.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [t for x in want for t in x] and lengths.tolist() == list(map(len, want))
        assert max(map(len, counter.known)) <= 256 and max(map(len, encoder.known)) <= 256
        assert counter.held < 60_000 and encoder.held < 60_000 and len(encoder.used) == len(encoder.known)


def test_license_scan(spark, odd, odd_docs, empty):
    grant, condition = licenses.SENTENCES["mit-grant"], licenses.SENTENCES["mit-condition"]
    docs = [
        (1, "Title.\n" + grant + "\n" + condition), (2, condition + " " + grant), (3, grant + "\nNot a rule.\nNor this.\n" + condition),
        (4, grant.upper() + "\n\nOne between.\n" + condition.replace(" ", "  ")), (5, "Released under the MIT License!"),
        (9, "SPDX-License-Identifier: 0BSD"), (6, "Licensed under CC BY-NC 4.0. Text goes on. Licensed under the Apache License, Version 2.0."), (7, None), (8, ""),
    ]
    got = {r.doc_id: (r.n_known, r.identifiers, r.licences) for r in licenses.scan(spark.createDataFrame(rows(docs), SCHEMA)).collect()}
    assert got[1] == (2, "mit-grant,mit-condition", "MIT") and got[2][2] == "" and got[2][0] == 2
    assert got[3][2] == "" and got[4][2] == "MIT" and got[5][2] == "MIT"
    assert got[6] == (2, "cc-by-nc-4.0-notice,apache-2.0-notice", "Apache-2.0,CC-BY-NC-4.0")
    assert got[7] == got[8] == (0, "", "") and got[9][2] == "0BSD"
    assert licenses.scan(odd).count() == len(odd_docs) and licenses.scan(empty).count() == 0


def licences_of(spark, texts):
    found = licenses.scan(spark.createDataFrame(rows(list(enumerate(texts))), SCHEMA)).collect()
    return [(r.n_known, r.identifiers, r.licences) for r in sorted(found, key=lambda r: r.doc_id)]


def test_license_scan_of_wrapped_texts(spark):
    """Licence texts as they are given: wrapped, below headings, in comments."""
    import textwrap

    said = {
        i: "\n".join(textwrap.wrap(s, 20 if len(s) < 80 else 76, break_on_hyphens=False)) for i, s in licenses.SENTENCES.items()
    }
    assert all("\n" in s for s in said.values())
    one = [i for i in said if not i.startswith("gpl-grant") and not i.startswith("gpl-warranty")]
    assert [x[1] for x in licences_of(spark, [said[i] for i in one])] == one
    assert [x[1] for x in licences_of(spark, ["Title\r\n" + said[i].replace("\n", "\r\n") + "\r\nend" for i in one])] == one
    mit, bsd = said["mit-grant"] + "\n\n" + said["mit-condition"], said["bsd-grant"] + "\n\n1. " + said["bsd-source"]
    comment = "\n".join(" * " + x for x in ("MIT\nCopyright (c) 2020 A B\n\n" + mit).split("\n"))
    cyrillic = said["mit-grant"] + "\n\n\u041e\u0434\u0438\u043d.\n\u0414\u0432\u0430.\n\n" + said["mit-condition"]
    got = licences_of(spark, [
        "MIT License\n\nCopyright (c) 2020 A B\n" + mit, bsd, said["isc-grant"], "/*\n" + comment + "\n */", cyrillic,
        said["mit-grant"] + "\nA sentence that is\nwrapped twice\nbetween.\n" + said["mit-condition"],
        "Not " + said["mit-notice"], said["mit-notice"][:-1] + "\n(or not)", said["isc-grant"].replace("\n", "\n\n", 1),
        "Licensed under the Apache License,\nVersion 2.0 (the \"License\");\nyou may not use this file except\nin compliance with the License.",
    ])
    assert [x[2] for x in got] == ["MIT", "BSD", "ISC", "MIT", "", "MIT", "", "MIT", "", "Apache-2.0"]
    assert got[9][1] == "apache-2.0-header,apache-2.0-compliance"


def test_every_license_rule_matches_its_own_text(spark):
    cases = [(name, rule) for name, rules in licenses.RULES.items() for rule in rules]
    for gap in ("\n", "\n\n"):
        got = licences_of(spark, ["Title.\n" + gap.join(licenses.SENTENCES[i] for i in rule) + "\nend" for _, rule in cases])
        for (name, rule), (n, ids, found) in zip(cases, got, strict=True):
            assert (n, ids) == (len(rule), ",".join(rule)) and name in found.split(",")
    header = (
        "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public "
        "License as published by\n    the Free Software Foundation, either version 3 of the License, or\n    (at your option) any later "
        "version.\n\n    This program is distributed in the hope that it will be useful,\n    but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of\n    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n    GNU General Public License for more details.\n"
    )
    assert licences_of(spark, [header, header.replace("free software: you", "free software. No: you")]) == [
        (2, "gpl-grant,gpl-warranty", "GPL-3.0"), (1, "gpl-warranty", "")
    ]


def test_license_scan_knows_the_common_licences(spark):
    """Every further sentence, wrapped, and every name in a notice and an SPDX line."""
    import textwrap

    said = [(x, i) for x, rules in licenses.MORE_RULES.items() for (i,) in rules]
    texts = ["Title\n" + "\n".join(textwrap.wrap(licenses.MORE_SENTENCES[i], 60, break_on_hyphens=False)) + "\nend" for _, i in said]
    assert sorted(i for _, i in said) == sorted(licenses.MORE_SENTENCES)
    for x, names in licenses.NAMES.items():
        for n in names:
            said.append((x, f"{x.lower()}-notice"))
            texts.append(f"Intro.\nThis project is licensed under the terms of\nthe {n}.")
        for n in (x, *licenses.SPDX.get(x, [])):
            said.append((x, f"{x.lower()}-spdx"))
            texts.append(f"# SPDX-License-Identifier: {n}\nimport os")
    assert licences_of(spark, texts) == [(1, i, x) for x, i in said]
    assert licences_of(spark, ["Released under MIT", "He was released under the bridge.", "Available under the CC BY-SA 4.0 licence.\n"]) == [
        (1, "mit-notice", "MIT"), (0, "", ""), (1, "cc-by-sa-4.0-notice", "CC-BY-SA-4.0")
    ]


def test_license_stems_cover_the_sentences():
    assert all(any(x in w for x in licenses.STEMS for w in licenses.normalise(s).split()) for s in (licenses.SENTENCES | licenses.MORE_SENTENCES).values())


def test_packing(odd, odd_docs, empty):
    ids = brute.encoded(odd_docs, Tokenizer.from_file(WORD_BPE))
    got = packing.pack(odd, WORD_BPE, capacity=512).collect()
    want = []
    for (d, _), x in zip(odd_docs, ids, strict=True):
        want += [(d, k, a, len(x[a: a + 512]), brute.id_crc(x[a: a + 512])) for k, a in enumerate(range(0, len(x), 512))]
    assert expected(tuple(r)[:5] for r in got) == expected(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 512
    assert len(bins) <= -(-sum(map(len, ids)) // 512) + 2
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_fullest_combination_is_the_best_sum():
    import itertools
    import random

    rng = random.Random(4)
    for _ in range(60):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(5)}
        items = [k for k, n in counts.items() for _ in range(n)]
        room = rng.randrange(1, 90)
        best = max((sum(c) for r in range(len(items) + 1) for c in itertools.combinations(items, r) if sum(c) <= room), default=0)
        used = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert sum(k * n for k, n in used.items()) == best
        assert all(n <= counts[k] for k, n in used.items())


@pytest.mark.parametrize("size", [lm_scoring.BLOCK_CHARS, 5_000])
def test_language_model(odd, odd_docs, spark, monkeypatch, size):
    monkeypatch.setattr(lm_scoring, "BLOCK_CHARS", size)
    more = [(100 + i, prose(300 + i % 7, 60)) for i in range(40)]
    docs = [*odd_docs, *more]
    df = odd.unionByName(spark.createDataFrame(rows(more), SCHEMA)).coalesce(2)
    got = collected(lm_scoring.score_documents(df))
    want = expected(brute.language_model(docs, lm_scoring.MU))
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for a, b in zip(got, want, strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        # codes are half a step off at most
        assert abs(a[6] - b[6]) <= 0.0201 * a[2] + 1e-9


def test_language_model_without_rows(empty):
    assert lm_scoring.score_documents(empty).count() == 0
