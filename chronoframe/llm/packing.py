"""Best-fit packing by minimum bin slack over the histogram of piece lengths.

Documents are cut into pieces of at most ``capacity`` ids. The histogram of
lengths has at most ``capacity`` entries at any input size; from it the plan is
made: every bin takes the longest length left, then the fullest feasible
combination of the others, found by a bitset subset-sum programme over the
lengths still available. A combination is used as often as the counts allow.
Pieces are numbered within their length by (partition, place) and look up their
bin in the plan, so no task and not the driver holds the pieces.

Cases: a null or empty text is the end id alone; null ids and equal rows are
packed like any other row; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.llm.common import texts, written
from chronoframe.llm.encoding import blocks, released, word_encoder

#: Bytes of text encoded at a time.
BLOCK_BYTES = 2 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece, with its task and its place among that task's pieces
    of its length."""

    def run(batches):
        encoder, part, seen = word_encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for at, block in blocks(batch.column("text"), BLOCK_BYTES):
                ids, lengths = encoder.encode(block, end=end_id)
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths)
                doc, piece, start, length, crc, place = [], [], [], [], [], []
                for i, (end, n) in enumerate(zip(ends.tolist(), lengths.tolist(), strict=True)):
                    first = end - n
                    for k, a in enumerate(range(0, n, capacity)):
                        size = min(capacity, n - a)
                        doc.append(at + i)
                        piece.append(k)
                        start.append(a)
                        length.append(size)
                        crc.append(zlib.crc32(raw[4 * (first + a): 4 * (first + a + size)]))
                        place.append(seen[size])
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(doc), pa.int32()), pa.array(place, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"],
                )

    return texts(docs).mapInArrow(released(run), PIECES)


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> Counter:
    """The combination of ``lengths`` (descending), each at most its count
    times, with the largest sum up to ``room``; a bit stands for a sum."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            grown = (reach | (reach << (length * take))) & mask
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return used


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first number, times, copies, first sequence, offset): the
    pieces of a length numbered from ``first`` on fill ``times`` bins with
    ``copies`` each."""
    counts, rows, sequence = {k: v for k, v in histogram.items() if v > 0}, [], 0
    given: Counter = Counter()
    available = sorted(counts, reverse=True)
    while available:
        longest = available[0]
        counts[longest] -= 1
        used = fullest(counts, available, capacity - longest)
        counts[longest] += 1
        used[longest] += 1
        times = min(counts[k] // n for k, n in used.items())
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            rows.append((length, given[length], times, n, sequence, offset))
            given[length] += times * n
            counts[length] -= times * n
            offset += n * length
        sequence += times
        if any(not counts[k] for k in used):
            available = [k for k in available if counts[k]]
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    # a length's window holds one row per partition, not its pieces
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    numbered = cut.join(by_part.withColumn("before", before).drop("n"), ["part", "length"])
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity))

    def place(batches):
        rows = shared.value
        # (length, number) as one ascending key
        width = int((rows[:, 1] + rows[:, 2] * rows[:, 3]).max()) + 1 if len(rows) else 1
        keys = rows[:, 0] * width + rows[:, 1]
        for batch in batches:
            number = batch.column("before").to_numpy() + batch.column("place").to_numpy()
            length = batch.column("length").to_numpy()
            mine = rows[np.searchsorted(keys, length * width + number, "right") - 1]
            turn, copy = np.divmod(number - mine[:, 1], mine[:, 3])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(mine[:, 4] + turn), pa.array(mine[:, 5] + copy * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
