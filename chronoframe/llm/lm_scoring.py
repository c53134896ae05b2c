"""LM scoring with a sharded Elias-Fano n-gram trie.

Model: P(w | h) = (c(hw) + MU * P(w)) / (c(h) + MU), with the additively
smoothed P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)), from the documents with
crc32(id) mod 10 <> 0. Tokens are the lower-cased (A-Z) words and one end; the
first is conditioned on the document's start. The observed part
c(hw) / (c(h) + MU) is stored, quantised, in a trie (``elias_fano``).

Nothing that grows with the corpus is gathered in one place. The texts of a
task are taken in blocks; a block asks the shards for what it needs, once per
distinct word and per distinct pair, and gets the answers back:

1. Words go to shards by their hash; a shard adds up the training counts and
   answers each block in its own order. Words with at least a 2^-14 share of
   all tokens (2^14 at most) are shared with all tasks.
2. Pairs go to shards by their context's hash, those of the shared words by
   both, so that no context is too large for a shard. A shard adds up the
   training counts, builds its trie and answers by looking every pair up.
3. A block's texts and its answers meet by the block's number and are scored.

Cases: a null or empty text is one end token; a null id trains like any other
(its crc32 is that of 'null'); equal rows count as often as they stand;
without training rows all counts are 0; no rows give no rows; other columns
are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.common import texts, written
from chronoframe.llm.elias_fano import DECODED, Trie

MU = 2000.0
#: Characters of a block.
BLOCK_CHARS = 12 << 20
#: Share of all tokens from which a word is shared with all tasks.
SHARED = 1 << 14
#: Bits of a word's hash in the trie.
ID_BITS = 48
#: Hashes that stand for a document's start and end (no word has them).
_START, _END = np.uint64((1 << ID_BITS) - 1), np.uint64((1 << ID_BITS) - 2)


def _squeeze(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _spread(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def held_out(doc: pa.Array) -> np.ndarray:
    ids = ("null" if i is None else str(i) for i in doc.to_pylist())
    return np.fromiter((zlib.crc32(i.encode()) % 10 == 0 for i in ids), bool, len(doc))


class Block:
    """Tokens of a run of texts as numbers of their distinct words; the end
    token is the number after the last word."""

    def __init__(self, number: int, doc: pa.Array, text: pa.Array):
        cut = pc.ascii_split_whitespace(pc.ascii_lower(text))
        coded = cut.flatten().dictionary_encode()
        self.number, self.doc, self.held = number, doc, held_out(doc)
        self.words = coded.dictionary.to_pylist()
        rows, sizes = coded.indices.to_numpy().astype(np.int64), cut.value_lengths().to_numpy().astype(np.int64)
        real = np.fromiter(map(bool, self.words), bool, len(self.words))[rows] if rows.size else np.empty(0, bool)
        owner = np.repeat(np.arange(sizes.size), sizes)[real]
        sizes, end = np.bincount(owner, minlength=sizes.size), len(self.words)
        self.tokens = np.insert(rows[real], np.cumsum(sizes), end)
        self.sizes = sizes + 1
        self.first = np.cumsum(self.sizes) - self.sizes
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, end) >> np.uint64(64 - ID_BITS)
        # the two largest are taken; a word that has one gets the next
        self.ids = np.append(np.where(hashes >= _END, hashes - np.uint64(2), hashes), [_END, _START])
        self.trains = np.repeat(~self.held, self.sizes)

    def word_requests(self, shards: int):
        """(shard, words, training counts) for every shard with a word here."""
        counts = np.bincount(self.tokens[self.trains], minlength=len(self.words) + 1)
        for shard, rows in self.word_parts(shards):
            yield shard, "\n".join(self.words[i] if i < len(self.words) else "" for i in rows), counts[rows]

    def word_parts(self, shards: int):
        """Distinct words (the end as '') of every shard, in a fixed order."""
        present = np.flatnonzero(np.append(np.fromiter(map(bool, self.words), bool, len(self.words)), True))
        return _by_shard(present, (_mix(self.ids[present]) % np.uint64(shards)).astype(np.int64))

    def pairs(self):
        """Distinct (context, word) numbers of the block in id order, the
        place of each token's pair among them, and training counts."""
        context = np.concatenate([[0], self.tokens[:-1]])
        context[self.first] = len(self.words) + 1
        rank = np.empty(self.ids.size, np.int64)
        rank[np.argsort(self.ids, kind="stable")] = np.arange(self.ids.size)
        keys = rank[context] * self.ids.size + rank[self.tokens]
        keys, at = np.unique(keys, return_inverse=True)
        number = np.argsort(rank)
        context, word = number[keys // self.ids.size], number[keys % self.ids.size]
        return context, word, at, np.bincount(at[self.trains], minlength=keys.size)

    def pair_parts(self, context, word, shared: np.ndarray, shards: int):
        """Places of the pairs that go to each shard, ascending."""
        h, w = self.ids[context], self.ids[word]
        key = np.where(np.isin(h, shared), _mix(h * np.uint64(0x9E3779B97F4A7C15) + w), _mix(h))
        return _by_shard(np.arange(h.size), (key % np.uint64(shards)).astype(np.int64))


def _by_shard(rows: np.ndarray, shard: np.ndarray):
    order = np.argsort(shard, kind="stable")
    shard, rows = shard[order], rows[order]
    starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if shard.size else np.empty(0, np.int64)
    return [(int(shard[a]), rows[a:b]) for a, b in zip(starts, np.append(starts[1:], shard.size), strict=True)]


def task_blocks(batches):
    """The blocks of a task; their numbers and contents are the same whenever
    the same partition is read."""
    part, number = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > BLOCK_CHARS:
                held.append(batch.slice(at, i - at))
                yield _joined((part << 32) + number, held)
                held, size, number, at = [], 0, number + 1, i
            size += n
        held.append(batch.slice(at))
    if sum(len(b) for b in held):
        yield _joined((part << 32) + number, held)


def _joined(number: int, held: list[pa.RecordBatch]) -> Block:
    whole = pa.Table.from_batches(held).combine_chunks()
    columns = [whole.column(c).combine_chunks() for c in ("doc_id", "text")]
    return Block(number, *(c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns))


_REQUEST = "block long, shard int, head binary, body binary, counts binary"


def _rows(found: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], names)


def _requests(make):
    """A mapInArrow function that sends what ``make(block)`` gives."""
    names, kinds = ["block", "shard", "head", "body", "counts"], [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches):
        for block in task_blocks(batches):
            yield _rows([(block.number, *r) for r in make(block)], names, kinds)

    return run


def count_words(rows: DataFrame, shards: int) -> DataFrame:
    """Answers (block, shard, counts) to the blocks' words, and rows of block
    -1: a shard's training tokens, distinct words and frequent words."""

    def ask(block):
        for shard, words, counts in block.word_requests(shards):
            yield shard, None, zstandard.ZstdCompressor(level=1).compress(words.encode()), _squeeze(counts.astype(np.uint32))

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        index: dict[str, int] = {}
        total, places = np.zeros(1 << 16, np.int64), []
        for body, counts in zip(pdf["body"], pdf["counts"], strict=True):
            words = unpack.decompress(body).decode().split("\n")
            at = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
            if len(index) > total.size:
                total = np.concatenate([total, np.zeros(max(total.size, len(index) - total.size), np.int64)])
            total[at] += _spread(counts, np.uint32)
            places.append(at)
        out = [(b, "", 0, 0, _squeeze(total[at])) for b, at in zip(pdf["block"], places, strict=True)]
        seen, everything = int((total > 0).sum()), int(total.sum())
        out.append((-1, "", everything, seen, b""))
        words = list(index)
        often = np.flatnonzero(total[: len(words)] >= max(2, -(-everything // SHARED)))
        out += [(-2, words[i], int(total[i]), 0, b"") for i in often]
        return pd.DataFrame(out, columns=["block", "word", "n", "seen", "counts"]).assign(shard=pdf["shard"].iloc[0])

    asked = rows.mapInArrow(_requests(ask), _REQUEST)
    return asked.groupBy("shard").applyInPandas(answer, "block long, word string, n long, seen long, counts binary, shard int")


def count_pairs(rows: DataFrame, shards: int, shared: dict[int, int], documents: int) -> DataFrame:
    """Answers (block, shard, codes) to the blocks' pairs from the tries."""
    known = np.sort(np.array([*shared, int(_START)], np.uint64))
    totals = np.array([shared.get(int(h), documents) for h in known], np.int64)

    def ask(block):
        context, word, _, counts = block.pairs()
        for shard, at in block.pair_parts(context, word, known, shards):
            h, w = block.ids[context[at]], block.ids[word[at]]
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            head = np.concatenate([h[starts], np.diff(np.append(starts, h.size)).astype(np.uint64)])
            low = w.view(np.uint8).reshape(-1, 8)[:, : ID_BITS // 8]
            yield shard, _squeeze(head), np.ascontiguousarray(low).tobytes(), _squeeze(counts[at].astype(np.uint32))

    def read(head: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        values = _spread(head, np.uint64).reshape(2, -1)
        word = np.zeros((len(body) * 8 // ID_BITS, 8), np.uint8)
        word[:, : ID_BITS // 8] = np.frombuffer(body, np.uint8).reshape(-1, ID_BITS // 8)
        return np.repeat(values[0], values[1].astype(np.int64)), word.view(np.uint64).reshape(-1)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        context, word, count = [], [], []
        for head, body, counts in zip(pdf["head"], pdf["body"], pdf["counts"], strict=True):
            (h, w), n = read(head, body), _spread(counts, np.uint32)
            context.append(h[n > 0])
            word.append(w[n > 0])
            count.append(n[n > 0])
        trie = _trie(np.concatenate(context), np.concatenate(word), np.concatenate(count).astype(np.int64), known, totals)
        found = [_squeeze(trie.lookup(*read(head, body))) for head, body in zip(pdf["head"], pdf["body"], strict=True)]
        return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "counts": found})

    asked = rows.mapInArrow(_requests(ask), _REQUEST)
    return asked.groupBy("shard").applyInPandas(answer, "block long, shard int, counts binary")


def _trie(context, word, count, known, totals) -> Trie:
    """A shard's trie; its levels are read back from their flat buffers."""
    order = np.lexsort((word, context))
    context, word, count = context[order], word[order], count[order]
    new = np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]) if context.size else np.empty(0, bool)
    at = np.flatnonzero(new)
    count = np.add.reduceat(count, at) if at.size else count
    context, word = context[at], word[at]
    # a shared word's pairs lie in many shards, its total is known; any other
    # context lies here whole
    contexts, row = np.unique(context, return_inverse=True)
    total = np.bincount(row, count, contexts.size)
    place = np.minimum(np.searchsorted(known, contexts), known.size - 1)
    total = np.where(known[place] == contexts, totals[place], total)
    p = count / (total[row] + MU) if count.size else np.empty(0)
    return Trie.from_buffers(Trie.build(context, word, p, 1 << ID_BITS).to_bytes())


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document (see ``_SCORES``)."""
    rows, spark = texts(docs), docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = written(count_words(rows, shards), "word-counts")
    sums = counted.filter("block = -1").agg(F.sum("n").alias("n"), F.sum("seen").alias("v")).first()
    n, v = sums.n or 0, sums.v or 0
    # at most SHARED words reach the share
    often = counted.filter((F.col("block") == -2) & (F.col("n") >= max(2, -(-n // SHARED)))).select("word", "n").collect()
    ends = counted.filter("block = -2 and word = ''").agg(F.sum("n")).first()[0] or 0
    shared = {xxhash.xxh3_64_intdigest(r.word) >> (64 - ID_BITS): r.n for r in often if r.word}
    paired = written(count_pairs(rows, shards, shared, ends), "pair-codes")
    hot = np.sort(np.array([*shared, int(_START)], np.uint64))

    def blocks_out(batches):
        for block in task_blocks(batches):
            tokens = _squeeze(block.tokens.astype(np.uint32))
            yield _rows(
                [(block.number, tokens, _squeeze(block.sizes), _squeeze(block.ids),
                  block.doc.fill_null(0).to_numpy().tobytes(), block.doc.is_null().to_numpy(zero_copy_only=False).tobytes(),
                  block.held.tobytes(), zstandard.ZstdCompressor(level=1).compress("\n".join(block.words).encode()))],
                ["block", "tokens", "sizes", "ids", "doc", "nulls", "held", "words"], [pa.int64(), *[pa.binary()] * 7],
            )

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [_score_block(row, right, shards, hot, n, v, ends) for row in left.to_dict("records")]
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _SCORES.split(", ")])

    left = rows.mapInArrow(blocks_out, "block long, tokens binary, sizes binary, ids binary, doc binary, nulls binary, held binary, words binary")
    answers = counted.filter("block >= 0").select("block", "shard", F.lit(False).alias("pair"), "counts").unionByName(
        paired.select("block", "shard", F.lit(True).alias("pair"), "counts")
    )
    return left.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, _SCORES)


def _score_block(row: dict, answers: pd.DataFrame, shards: int, hot: np.ndarray, n: int, v: int, ends: int) -> pd.DataFrame:
    block = Block.__new__(Block)
    words = zstandard.ZstdDecompressor().decompress(row["words"]).decode()
    block.words, block.tokens = words.split("\n"), _spread(row["tokens"], np.uint32).astype(np.int64)
    block.sizes, block.ids = _spread(row["sizes"], np.int64), _spread(row["ids"], np.uint64)
    if block.ids.size == 2:
        block.words = []
    block.first = np.cumsum(block.sizes) - block.sizes
    block.held = np.frombuffer(row["held"], bool)
    block.trains = np.repeat(~block.held, block.sizes)
    got = {(bool(p), int(s)): c for p, s, c in zip(answers["pair"], answers["shard"], answers["counts"], strict=True)}

    def fill(parts, size: int, pair: bool, kind) -> np.ndarray:
        values = np.zeros(size, kind)
        for shard, at in parts:
            values[at] = _spread(got[pair, shard], kind)
        return values

    counts = fill(block.word_parts(shards), len(block.words) + 1, False, np.int64)
    context, word, at, _ = block.pairs()
    codes = fill(block.pair_parts(context, word, hot, shards), context.size, True, np.uint8)
    base = (counts + 0.1) / (n + 0.1 * (v + 1))
    # of a context, all training occurrences are followed by a token
    before = np.append(counts.astype(float), ends)[context]
    p = DECODED[codes] + MU / (before + MU) * base[word]
    known = np.add.reduceat((counts > 0)[block.tokens].astype(np.int64), block.first)
    nulls = np.frombuffer(row["nulls"], bool)
    return pd.DataFrame({
        "doc_id": pd.Series(np.frombuffer(row["doc"], np.int64), dtype="Int64").mask(nulls),
        "held_out": block.held, "n_tokens": block.sizes, "n_known": known, "train_tokens": n,
        "base_score": np.add.reduceat(np.log10(base)[block.tokens], block.first),
        "score": np.add.reduceat(np.log10(np.minimum(p, 1.0))[at], block.first),
    })
