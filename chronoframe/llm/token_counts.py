"""Token counts by a map-side two-tier lookup, without shuffling pre-tokens.

Tier one: token counts of the frequent chunks, broadcast. Each partition names
its own frequent chunks (at most ``FREQUENT_SHARE`` of them by the pigeonhole
principle), and the ``TABLE_CHUNKS`` most frequent of those make the table.
Tier two: a worker encodes what the table misses once and keeps the count. The
table changes speed alone, never a count.

A chunk is a space with the non-spaces after it, or a text's start. Counting
by chunk is exact unless a chunk begins with white space, is empty, or holds a
special token; such a text is counted whole by the library.

Cases: a null text counts as empty (0 bytes, 0 tokens); a null id stays null;
equal rows give equal rows; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.common import texts
from chronoframe.llm.encoding import blocks, held

FREQUENT_SHARE, TABLE_CHUNKS = 16_384, 32_768
#: Bytes of misses that a worker keeps before it starts afresh, and the longest chunk it keeps.
CACHE_BYTES, CACHE_CHUNK = 96 << 20, 256
#: Letters, then marks without an apostrophe: always two pre-tokens.
_WORD_AND_MARKS = re.compile(r"([A-Za-zß-öø-ÿÀ-ÖØ-Þ]+)([.,!?;:|#*%&$]*)")
#: The count of a chunk that needs its whole text.
_WHOLE = -1


def _cut(block: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Chunks per text, the number of each text's chunks in the list of
    distinct chunks, and that list."""
    cut = pc.split_pattern(block, " ")
    coded = cut.flatten().dictionary_encode()
    return cut.value_lengths().to_numpy(), coded.indices.to_numpy(), coded.dictionary.to_pylist()


class TokenCounter:
    """A worker's counter. ``known`` holds the broadcast table (tier one) and
    what the worker has counted itself (tier two); keys have no leading space."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            library = SentencePieceProcessor(model_file=path)
            self.chunked = False
            self.library = lambda whole: [len(x) for x in library.encode(whole, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            # chunks are safe for the byte-level pre-tokenizer alone
            self.chunked = '"pre_tokenizer":{"type":"ByteLevel","add_prefix_space":false' in library.to_str()
            self.special = [t.content for t in library.get_added_tokens_decoder().values()]
            self.library = lambda whole: [len(x) for x in library.encode_batch_fast(whole, add_special_tokens=False)]
        self.table: dict[str, int] = {}
        self.known: dict[str, int] = {}
        self.marks: dict[str, int] = {}
        self.held = 0

    def use(self, table: dict[str, int]) -> None:
        if table is not self.table:
            self.table, self.known, self.held = table, dict(table), 0

    def _whole(self, chunk: str) -> bool:
        return not chunk or chunk[0].isspace() or any(s in chunk for s in self.special)

    def _learn(self, chunks: list[str]) -> None:
        """Count new chunks, none of them long."""
        if self.held > CACHE_BYTES:
            self.known, self.held = dict(self.table), 0
        if len(self.marks) > 10_000:
            self.marks = {}
        known, marks, cut = self.known, self.marks, {}
        self.held += sum(map(len, chunks)) + 150 * len(chunks)
        for chunk in chunks:
            if (m := _WORD_AND_MARKS.fullmatch(chunk)) and m[2]:
                cut[chunk] = m[1], m[2]
        words = dict.fromkeys(w for w, _ in cut.values() if w not in known)
        words.update(dict.fromkeys(c for c in chunks if c not in cut))
        new = [" " + w for w in words]
        for i in range(0, len(new), 20_000):
            known.update(zip((w[1:] for w in new[i: i + 20_000]), self.library(new[i: i + 20_000]), strict=True))
        ends = [e for e in {e for _, e in cut.values()} if e not in marks]
        marks.update(zip(ends, self.library(ends), strict=True))
        for chunk, (word, end) in cut.items():
            known[chunk] = known[word] + marks[end]
        for chunk in chunks:
            if chunk not in cut and self._whole(chunk):
                known[chunk] = _WHOLE

    def chunk_counts(self, chunks: list[str]) -> np.ndarray:
        """Tokens of a space and the chunk for each chunk, or _WHOLE."""
        new = [c for c in chunks if c not in self.known]
        long = [c for c in new if len(c) > CACHE_CHUNK]
        once = dict(zip(long, self.library([" " + c for c in long]), strict=True)) if long else {}
        once.update((c, _WHOLE) for c in long if self._whole(c))
        if len(new) > len(long):
            self._learn([c for c in new if c not in once])
            again = [c for c in chunks if c not in self.known and c not in once]
            if again:  # the cache was emptied between
                self._learn(again)
        known = self.known
        return np.fromiter((once[c] if c in once else known[c] for c in chunks) if once else map(known.__getitem__, chunks), np.int64, len(chunks))

    def count(self, block: pa.Array) -> np.ndarray:
        if not self.chunked:
            return np.array(self.library(block.to_pylist()), np.int64).reshape(-1)
        sizes, rows, distinct = _cut(block)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        each = self.chunk_counts(distinct)[rows]
        # a text's first chunk has no space before it
        heads, back = np.unique(rows[starts], return_inverse=True)
        at_head = [distinct[i] for i in heads]
        first = np.array(self.library(at_head), np.int64).reshape(-1)
        first[[self._whole(c) and c != "" for c in at_head]] = _WHOLE
        each[starts] = first[back]
        whole = np.minimum.reduceat(each, starts) < 0
        total = np.add.reduceat(each, starts)
        again = np.flatnonzero(whole)
        if again.size:
            total[again] = self.library(block.take(pa.array(again)).to_pylist())
        return total


def frequent_chunks(docs: DataFrame) -> list[str]:
    """The most frequent chunks over all texts, a bounded number of them."""

    def local(batches):
        seen: Counter = Counter()
        for batch in batches:
            for _, block in blocks(batch.column("text")):
                _, rows, distinct = _cut(block)
                counts = np.bincount(rows, minlength=len(distinct))
                often = np.flatnonzero(counts >= max(2, rows.size // FREQUENT_SHARE))
                seen.update({distinct[i]: int(counts[i]) for i in often})
                if len(seen) > 4 * FREQUENT_SHARE:
                    seen = Counter(dict(seen.most_common(FREQUENT_SHARE)))
        top = seen.most_common(FREQUENT_SHARE)
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["chunk", "n"]
        )

    found = docs.select("text").mapInArrow(local, "chunk string, n long")
    top = found.groupBy("chunk").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "chunk").limit(TABLE_CHUNKS)
    return [r.chunk for r in top.select("chunk").collect()]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text."""
    rows, spark = texts(docs), docs.sparkSession
    if not Path(tokenizer).is_file():
        raise FileNotFoundError(f"tokenizer file {tokenizer}")
    counter = TokenCounter(tokenizer)
    table: dict[str, int] = {}
    if counter.chunked:
        chunks = frequent_chunks(rows)
        table = dict(zip(chunks, counter.chunk_counts(chunks).tolist(), strict=True))
    shared = spark.sparkContext.broadcast(table)

    def run(batches):
        mine = held(("counts", tokenizer), lambda: TokenCounter(tokenizer))
        mine.use(shared.value)
        for batch in batches:
            text = batch.column("text")
            counts = [np.empty(0, np.int64), *(mine.count(block) for _, block in blocks(text))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(pc.binary_length(text), pa.int64()), pa.array(np.concatenate(counts), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
