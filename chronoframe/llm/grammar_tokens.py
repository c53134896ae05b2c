"""Token ids in a Re-Pair grammar file format.

``write_tokens`` encodes whole texts in ascending ``doc_id`` order and writes
Parquet rows, each a shard of consecutive documents with a grammar of its own:
frequent id pairs are replaced by nonterminals round after round until no pair
is frequent or all symbols are used, no pair reaching over a document's end. A shard stores its rules, the expansion length
of every rule, and where each document starts in the reduced sequence, so that
one document, or a part of it, is decoded without the others and with its own
rules alone (``decode_document``, ``decode_range``).

Cases: a null or empty text holds the end id alone; null ids come first; rows
of equal id stand next to each other in any order; an empty table gives no
shard; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoframe.llm.common import partitions, texts
from chronoframe.llm.encoding import blocks, word_encoder

SHARD_SCHEMA = (
    "part int, shard int, first_token long, n_tokens long, first_symbol int, "
    "doc_ids binary, doc_null binary, doc_tokens binary, doc_symbols binary, rules binary, expansion binary, symbols binary"
)
_ARROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int64()), ("first_symbol", pa.int32())]
    + [(n, pa.binary()) for n in ("doc_ids", "doc_null", "doc_tokens", "doc_symbols", "rules", "expansion", "symbols")]
)
#: Rules a round at most, and the least count of a pair (a rule takes 12 bytes,
#: a replaced pair of 16-bit symbols gives back 2).
RULES, LEAST = 4096, 8
#: A round takes the pairs at least 1 / NEAR as frequent as the first, so that
#: symbols go to the pairs of later rounds where those are more frequent.
NEAR = 128
_HASH_BITS = 18


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Both symbols in one number; symbols of 16 bits make one of 32."""
    wide = np.uint32 if left.dtype == np.uint16 else np.uint64
    return (left.astype(wide) << wide(8 * left.itemsize)) | right


def _slot(keys: np.ndarray) -> np.ndarray:
    bits = 8 * keys.itemsize
    return (keys * keys.dtype.type(0x9E3779B97F4A7C15 >> (64 - bits) | 1)) >> keys.dtype.type(bits - _HASH_BITS)


def _frequent(keys: np.ndarray, most: int) -> np.ndarray:
    """The pairs seen at least LEAST times and 1 / NEAR as often as the first,
    most frequent first; equals in the order of their hash, so that a run of
    equally frequent pairs is cut at many places."""
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(starts, append=ordered.size)
    often = np.flatnonzero(counts >= max(LEAST, counts.max(initial=0) // NEAR))
    often = often[np.lexsort((ordered[starts[often]], _slot(ordered[starts[often]]), -counts[often]))][:most]
    return ordered[starts[often]]


def repair(ids: np.ndarray, lengths: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Reduced sequence, rules (left, right) and symbols of each document.

    Every round replaces, at each place, the pair that is more frequent than
    both pairs overlapping it; the leftmost of equals. Rules are those with a
    place.
    """
    seq = ids.astype(np.uint16 if first_symbol < 1 << 16 else np.uint32)
    half = 8 * seq.itemsize
    last = np.zeros(seq.size, bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    rules: list[np.ndarray] = []
    known = 0
    while True:
        room = min(RULES, (1 << 16) - first_symbol - known if first_symbol < 1 << 16 else RULES)
        if seq.size < 2 or room <= 0:
            break
        keys = _pairs(seq[:-1], seq[1:])
        chosen = _frequent(keys[~last[:-1]], room)
        if not chosen.size:
            break
        rank_at = np.full(1 << _HASH_BITS, chosen.size, np.int32)
        rank_at[_slot(chosen)[::-1]] = np.arange(chosen.size, dtype=np.int32)[::-1]
        # places that may start a chosen pair: few in later rounds
        places = np.flatnonzero((rank_at < chosen.size)[_slot(keys)] & ~last[:-1])
        keys = keys[places]
        rank = rank_at[_slot(keys)]
        other = chosen[rank] != keys
        # pairs whose slot a more frequent one has
        lost = np.flatnonzero(rank_at[_slot(chosen)] != np.arange(chosen.size))
        clash = np.flatnonzero(other) if lost.size else lost
        rank[other] = chosen.size
        if clash.size:
            lost = lost[np.argsort(chosen[lost])]
            place = np.minimum(np.searchsorted(chosen[lost], keys[clash]), lost.size - 1)
            rank[clash] = np.where(chosen[lost[place]] == keys[clash], lost[place], chosen.size)
        places, rank = places[rank < chosen.size], rank[rank < chosen.size]
        next_to = places[1:] == places[:-1] + 1
        best = np.ones(places.size, bool)
        best[1:] = ~next_to | (rank[1:] < rank[:-1])
        best[:-1] &= ~next_to | (rank[:-1] <= rank[1:])
        at, rank = places[best], rank[best]
        used = np.bincount(rank, minlength=chosen.size) > 0
        number = np.cumsum(used) - 1
        seq[at] = (first_symbol + known + number[rank]).astype(seq.dtype)
        chosen = chosen[used]
        low = chosen.dtype.type((1 << half) - 1)
        rules.append(np.stack([chosen >> chosen.dtype.type(half), chosen & low], 1).astype(np.uint32))
        last[at] = last[at + 1]
        keep = np.ones(seq.size, bool)
        keep[at + 1] = False
        seq, last, known = seq[keep], last[keep], known + chosen.size
    ends = np.flatnonzero(last) + 1
    symbols = np.zeros(lengths.size, np.int64)
    symbols[lengths > 0] = np.diff(ends, prepend=0)
    return seq, np.concatenate(rules) if rules else np.empty((0, 2), np.uint32), symbols


def expansion_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """Number of ids that every rule stands for."""
    sizes: list[int] = []
    for a, b in rules.tolist():
        sizes.append(sum(sizes[x - first_symbol] if x >= first_symbol else 1 for x in (a, b)))
    return np.array(sizes, np.uint32)


def expansions(rules: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and flat ids of what every symbol below ``first_symbol`` (itself)
    and every rule stands for; a rule only uses symbols made before it."""
    parts: list[bytes] = []

    def ids(symbol: int) -> bytes:
        return parts[symbol - first_symbol] if symbol >= first_symbol else symbol.to_bytes(4, "little")

    for a, b in rules.tolist():
        parts.append(ids(a) + ids(b))
    sizes = np.concatenate([np.ones(first_symbol, np.int64), np.fromiter(map(len, parts), np.int64, len(parts)) // 4])
    flat = np.concatenate([np.arange(first_symbol, dtype=np.uint32), np.frombuffer(b"".join(parts), np.uint32)])
    return np.concatenate([[0], np.cumsum(sizes)]), flat


def _expand(symbols: np.ndarray, rules: np.ndarray, first_symbol: int) -> np.ndarray:
    starts, flat = expansions(rules, first_symbol)
    lists = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(flat))
    return lists.take(pa.array(symbols.astype(np.int64))).flatten().to_numpy()


def _symbols(row: dict) -> np.ndarray:
    return np.frombuffer(row["symbols"], np.uint16 if row["first_symbol"] < 1 << 16 else np.uint32)


def _rules(row: dict) -> np.ndarray:
    return np.frombuffer(row["rules"], np.uint32).reshape(-1, 2)


def decode_shard(row: dict) -> np.ndarray:
    """All ids of a shard row."""
    return _expand(_symbols(row), _rules(row), row["first_symbol"])


def decode_range(row: dict, i: int, start: int, stop: int) -> np.ndarray:
    """The ids from ``start`` to ``stop`` of the shard's i-th document: the
    stored lengths say which symbols hold them, and only those are expanded."""
    first, rules = row["first_symbol"], _rules(row)
    lengths = np.frombuffer(row["expansion"], np.uint32)
    ends = np.cumsum(np.frombuffer(row["doc_symbols"], np.uint32).astype(np.int64))
    seq = _symbols(row)[(ends[i - 1] if i else 0): ends[i]].astype(np.int64)
    place = np.int64(0)
    while True:
        sizes = np.ones(seq.size, np.int64)
        made = seq >= first
        sizes[made] = lengths[seq[made] - first]
        after = place + np.cumsum(sizes)
        inside = (after > start) & (after - sizes < stop)
        if not inside.any():
            return np.empty(0, np.uint32)
        place, seq, made = (after - sizes)[inside][0], seq[inside], made[inside]
        if not made.any():
            return seq.astype(np.uint32)
        at = np.cumsum(1 + made) - 1 - made
        wider = np.empty(seq.size + int(made.sum()), np.int64)
        wider[at] = seq
        wider[at[made]], wider[at[made] + 1] = rules[seq[made] - first].T
        seq = wider


def decode_document(row: dict, i: int) -> np.ndarray:
    """The ids of the shard's i-th document, by its own symbols and rules."""
    return decode_range(row, i, 0, int(np.frombuffer(row["doc_tokens"], np.uint32)[i]))


def _shards(path: str, end_id: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder, part, shard, token = word_encoder(path), TaskContext.get().partitionId(), 0, 0
    first_symbol = encoder.tokenizer.get_vocab_size()
    for batch in batches:
        for at, block in blocks(batch.column("text")):
            ids, lengths = encoder.encode(block, end=end_id)
            doc = batch.column("doc_id").slice(at, len(block))
            seq, rules, symbols = repair(ids, lengths, first_symbol)
            row = {
                "part": part, "shard": shard, "first_token": token, "n_tokens": ids.size, "first_symbol": first_symbol,
                "doc_ids": doc.fill_null(0).to_numpy().tobytes(),
                "doc_null": np.packbits(doc.is_null().to_numpy(zero_copy_only=False)).tobytes(),
                "doc_tokens": lengths.astype(np.uint32).tobytes(), "doc_symbols": symbols.astype(np.uint32).tobytes(),
                "rules": rules.tobytes(), "expansion": expansion_lengths(rules, first_symbol).tobytes(),
                "symbols": seq.tobytes(),
            }
            yield pa.RecordBatch.from_pylist([row], _ARROW)
            shard, token = shard + 1, token + int(ids.size)


def write_tokens(docs: DataFrame, tokenizer: str, out: str, end_id: int | None = 1) -> None:
    """Write the ids of every document to ``out`` in ascending id order."""
    rows = texts(docs)
    ordered = rows.repartitionByRange(partitions(rows), "doc_id").sortWithinPartitions("doc_id")
    shards = ordered.mapInArrow(lambda it: _shards(tokenizer, end_id, it), SHARD_SCHEMA)
    shards.write.option("compression", "zstd").parquet(out)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Shard rows with ``start``: the number of ids in all earlier parts."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # one row a part here: small enough for one window and for a broadcast
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "start", F.sum("n").over(Window.orderBy("part")) - F.col("n")
    )
    return shards.join(F.broadcast(parts.select("part", "start")), "part")


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the file: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["doc_tokens"], np.uint32).astype(np.int64)
                null = np.unpackbits(np.frombuffer(row["doc_null"], np.uint8), count=lengths.size).astype(bool)
                raw, ends = decode_shard(row).tobytes(), np.cumsum(lengths)
                ids = pa.BinaryArray.from_buffers(
                    pa.binary(), lengths.size, [None, pa.py_buffer(np.append(0, ends * 4).astype(np.int32)), pa.py_buffer(raw)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=null),
                        pa.array(row["start"] + row["first_token"] + ends - lengths), pa.array(lengths), ids,
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return read_tokens(spark, path).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
