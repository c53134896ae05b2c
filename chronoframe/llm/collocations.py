"""Phrase collocations by dynamic itemset counting over cyclic shard scans.

The texts are cut into words once and dealt, in blocks of one language, into
``SHARDS`` shards; every step of the loop scans one shard, in turn. Words are counted from the first step. A longer phrase is
activated once its first words and its last words (all but one) have both
reached the threshold, whatever their length, so words, pairs, triples and
fours are counted side by side in one scan. A phrase is counted for exactly one
full cycle from the step after its activation, and the loop ends when no phrase
is left to count.

Tasks must know which phrases have reached the threshold, and when. That set
grows with the data, so they get a table of fixed size instead: ``SLOTS`` bytes
with two places a phrase, each holding the step at which it was first taken.
Only ever too many phrases pass it (never too few), and they too are counted for
one full cycle, so every count is exact; what stays below the threshold goes.

Cases: a null text counts as empty; a null lang counts as ``und``; the id is not
read, so repeated rows and ids count as often as they occur; no rows, or none
with a frequent phrase, give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.llm.common import ship, written
from chronoframe.llm.encoding import blocks

#: Shards of a cycle; bytes of the table of reached phrases; words of a phrase.
SHARDS, SLOTS, LONGEST = 3, 1 << 24, 4
_NEVER = 255
#: Bytes of words, of white space, and of what ends a piece.
_BLANK, _END = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANK)], _KIND[list(_END)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_COUNTED = "key string, start int, n long"
#: A block: its distinct words, joined by spaces; each word's number; whether
#: the next word is in the same piece.
_BLOCKS = "lang string, shard int, words string, code binary, joined binary"


def _words(text: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts in order, and whether each is followed by another
    word of its piece."""
    text = text.cast(pa.large_string())
    places = np.frombuffer(text.buffers()[1], np.int64)[text.offset: text.offset + len(text) + 1]
    if places[-1] == places[0]:
        return pa.array([], pa.string()).dictionary_encode(), np.empty(0, bool)
    raw = np.frombuffer(text.buffers()[2], np.uint8)[places[0]: places[-1]]
    places = places - places[0]
    kind = _KIND[raw]
    inside = kind == 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = places[:-1][places[:-1] < len(raw)]
    starts[heads] = inside[heads]
    at = np.flatnonzero(starts)
    upto = np.cumsum(inside, dtype=np.int32)
    offsets = np.append(upto[at] - 1, upto[-1:]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[inside]]))
    # pieces and texts before each word: equal for words of one piece alone
    before = np.cumsum(kind == 2, dtype=np.int32)[at]
    doc = np.searchsorted(places, at, "right")
    joined = np.append((before[1:] == before[:-1]) & (doc[1:] == doc[:-1]), False)[: len(at)]
    return words.dictionary_encode(), joined


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _hashes(words: list[str], lang: str) -> np.ndarray:
    salt = xxhash.xxh64_intdigest(lang)
    return np.array([xxhash.xxh64_intdigest(w, salt) for w in words], np.uint64)


def _longer(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its first words and of its last word."""
    return _mix(first * np.uint64(0x9E3779B97F4A7C15) + last)


def _places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _reached(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The step at which each phrase reached the threshold."""
    a, b = _places(hashes, len(table))
    return np.maximum(table[a], table[b])


def _tally(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct combination of word numbers, and its count."""
    key = columns[0].astype(np.int64)
    for column in columns[1:-1]:
        key = np.unique(key * size + column, return_inverse=True)[1]
    _, row, n = np.unique(key * size + columns[-1] if len(columns) > 1 else key, return_index=True, return_counts=True)
    return row, n


def _cut(batches, shards: int):
    """Blocks of words, in turn for each shard."""
    number = TaskContext.get().partitionId()
    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            for _, block in blocks(batch.column("text").filter(pc.equal(langs, lang))):
                coded, joined = _words(block)
                if len(coded):
                    words = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")
                    values = [[lang], [number % shards], words, [coded.indices.to_numpy().tobytes()], [np.packbits(joined).tobytes()]]
                    types = (pa.string(), pa.int32(), pa.string(), pa.binary(), pa.binary())
                    arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "shard", "words", "code", "joined"])
                    number += 1


def _count(words: pa.Array, code: np.ndarray, joined: np.ndarray, lang: str, table: np.ndarray, step: int, shards: int):
    """``phrases, start, n`` that this step counts in a block. The empty phrase
    counts all words; None has the last step that a phrase here is known to
    start with."""
    size = len(words)
    if step < shards:
        yield words, np.zeros(size, np.int32), np.bincount(code, minlength=size)
        yield pa.array([""]), np.zeros(1, np.int32), np.array([len(code)])
    if not step:
        return
    hashes = _hashes(words.to_pylist(), lang)
    one = hashes[code]
    reached = _reached(table, hashes).astype(np.int16)[code]
    at, run, latest = np.flatnonzero(joined), one, 0
    for length in range(2, LONGEST + 1):
        # ``reached`` has the step at which the phrase of one word less, from each place, did so
        start = np.maximum(reached[at], reached[at + 1]) + np.int16(1)
        at, start = at[start <= _NEVER], start[start <= _NEVER]
        latest = max(latest, int(start.max(initial=0)))
        now = (start <= step) & (start > step - shards)
        places = at[now]
        if places.size:
            row, n = _tally([code[places + i] for i in range(length)], size)
            parts = [words.take(pa.array(code[places[row] + i])) for i in range(length)]
            yield pc.binary_join_element_wise(*parts, " "), start[now][row].astype(np.int32), n
        if length < LONGEST and at.size:
            hashes = _longer(run[at], one[at + length - 1])
            run, reached = np.zeros(len(code), np.uint64), np.full(len(code), _NEVER, np.int16)
            # at the end of the first step that counts it at the earliest
            found = _reached(table, hashes).astype(np.int16)
            run[at], reached[at] = hashes, np.where(found < _NEVER, np.maximum(found, start), _NEVER)
            at = at[joined[at + length - 1]]
        elif not at.size:
            break
    yield None, np.array([latest], np.int32), np.zeros(1, np.int64)


def _scan(shard: DataFrame, shared: Broadcast, step: int, shards: int) -> DataFrame:
    """Partial counts of one step; ``key`` is the phrase, a tab, and the lang."""

    def run(batches):
        table = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for batch in batches:
            for i in range(batch.num_rows):
                lang, words, code, joined = (batch.column(c)[i] for c in ("lang", "words", "code", "joined"))
                code = np.frombuffer(code.as_buffer(), np.int32)
                joined = np.unpackbits(np.frombuffer(joined.as_buffer(), np.uint8), count=len(code)).astype(bool)
                words = pc.split_pattern(pa.array([words.as_py()]), " ").flatten()
                for phrases, start, n in _count(words, code, joined, lang.as_py(), table, step, shards):
                    keys = pa.array([""]) if phrases is None else pc.binary_join_element_wise(phrases.cast(pa.string()), lang.as_py(), "\t")
                    columns = [keys, pa.array(start, pa.int32()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "start", "n"])

    return shard.mapInArrow(run, _COUNTED)


def _take_places(table: np.ndarray, phrases: DataFrame, step: int) -> bool:
    """Mark the places of phrases that reached the threshold in this step; what
    comes to the driver is a bitmap of the table at most."""
    size = len(table)

    def run(batches):
        for batch in batches:
            hashes = []
            for key in batch.column("key").to_pylist():
                phrase, lang = key.split("\t", 1)
                parts = _hashes(phrase.split(" "), lang)
                whole = parts[:1]
                for i in range(1, len(parts)):
                    whole = _longer(whole, parts[i: i + 1])
                hashes.append(whole)
            if hashes:
                places = np.unique(np.concatenate(_places(np.concatenate(hashes), size)))
                yield pa.RecordBatch.from_arrays([pa.array(places)], ["place"])

    places = phrases.select("key").mapInArrow(run, "place long").withColumn("place", F.col("place") + 1)
    bits = places.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    taken = False
    for row in bits.collect():
        found = np.flatnonzero(np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")) + (row.part - 1) * 32768
        new = found[table[found] == _NEVER]
        table[new] = step
        taken |= bool(new.size)
    return taken


def frequent_phrases(docs: DataFrame, threshold: int = 30, shards: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, n`` of all phrases of up to four words that occur
    ``threshold`` times or more, and ``lang, n`` with all word occurrences.
    ``slots`` is the table's size, a power of two."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    rows = written(rows.mapInArrow(lambda b: _cut(b, shards), _BLOCKS), "shards", partition_by=["shard"])
    table = np.full(slots, _NEVER, np.uint8)
    open_counts = spark.createDataFrame([], _COUNTED)
    counted, changed, latest, step = [], 0, 0, 0
    # a phrase is done a cycle after its first step; a cycle after the last change all first steps are known
    while step < shards or step <= max(changed + shards, latest + shards - 1):
        shared = spark.sparkContext.broadcast(zlib.compress(table, 1))
        found = _scan(rows.filter(F.col("shard") == step % shards).drop("shard"), shared, step, shards)
        both = found.withColumn("before", F.lit(0)).unionByName(open_counts.withColumn("before", F.col("n")))
        total = both.groupBy("key", "start").agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
        # counted for a full cycle and still rare: it stays rare
        no_phrase = F.col("key").startswith("\t") | (F.col("key") == "")
        kept = total.filter((F.col("n") >= threshold) | (F.col("start") > step - shards + 1) | no_phrase)
        done = written(kept, f"step-{step}")
        shared.destroy()
        size = F.size(F.split(F.split_part("key", F.lit("\t"), F.lit(1)), " "))
        reached = done.filter((F.col("n") >= threshold) & (F.col("before") < threshold) & ~no_phrase & (size < LONGEST))
        if _take_places(table, reached, step):
            changed = step
        latest = max(latest, done.filter("key = ''").agg(F.max("start")).first()[0] or 0)
        done = done.filter("key <> ''").select("key", "start", "n")
        open_counts = done.filter(F.col("start") > step - shards + 1)
        counted.append(done.filter(F.col("start") <= step - shards + 1))
        step += 1
    every = counted[0]
    for more in counted[1:]:
        every = every.unionByName(more)
    phrase = F.split_part("key", F.lit("\t"), F.lit(1))
    every = every.select(
        F.expr("substring(key, length(split_part(key, '\t', 1)) + 2)").alias("lang"), phrase.alias("phrase"),
        F.size(F.split(phrase, " ")).alias("size"), "n",
    )
    return every.filter((F.col("phrase") != "") & (F.col("n") >= threshold)), every.filter("phrase = ''").select("lang", "n")


def collocations(docs: DataFrame, threshold: int = 30, limit: int = 2000, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``limit`` best
    phrases of two to four words by their lowest-scoring cut, without those that
    nearly always stand inside a longer one."""
    frequent, totals = frequent_phrases(docs, threshold, shards, slots)
    frequent = written(frequent, "frequent")
    words = F.split("phrase", " ")
    candidates = frequent.filter("size > 1")

    def part(start, length):
        return F.array_join(F.slice(words, start, length), " ")

    cuts = candidates.select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size"
    ).select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    counts = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("count"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("part").alias(side), F.col("count").alias(name)), ["lang", side]).drop(side)
    # decimals hold the products beyond 64 bits
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = candidates.filter("size > 2").select(
        "lang", "n", "phrase", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    ).select(
        "lang", "n", "phrase", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start")
    ).select("lang", part(F.col("start"), F.col("length")).alias("phrase"), "n")
    longer = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    held = F.expr("cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * 80")
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | ~held)
    best = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, so that no task sorts all of one
    some = F.row_number().over(Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(64))).orderBy(*order))
    best = best.withColumn("rank", some).filter(F.col("rank") <= limit)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= limit)
    return best.join(totals.groupBy("lang").agg(F.sum("n").alias("n")), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def oracle_sql() -> str:
    """The registered query in DuckDB SQL."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
word_lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM word_lists GROUP BY lang),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM word_lists, (SELECT unnest([1, 2, 3, 4]) AS size) AS sizes WHERE len(w) >= size),
f AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS lhs,
    array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS rhs
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1) AS x),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, ((2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lhs JOIN f r ON r.lang = c.lang AND r.phrase = c.rhs),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, a, array_to_string(string_split(phrase, ' ')[s:s + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM f WHERE size > 2) AS y) AS z),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND longer.phrase = lowest.phrase
  WHERE longer IS NULL OR NOT 100::HUGEINT * longer >= 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang AS lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""
