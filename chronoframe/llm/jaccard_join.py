"""N-gram Jaccard join as a blocked sparse product, with its components.

A document is the set of its distinct word 4-grams; two documents link when
100 * |A and B| >= 85 * |A or B|. Equal sets are one class and are joined once.
The class by n-gram incidence matrix is multiplied with its transpose in two
blocks of columns:

1. Every class orders its n-grams by (corpus frequency, hash) and puts the
   first few, as many as its size requires, into the first block: a pair that
   links shares one of them. Columns with one class give no product and leave.
   The product adds up the shared n-grams of a pair; pairs are dropped by size,
   by the position of what they share, and by what is left of the overlap that
   the two sizes ask for after the n-grams known not to be shared.
2. Over the remaining block the overlap of the pairs left is added up exactly,
   from both sets, and compared with the bound.

A linked pair that the first block does not give shares a column of over
``DENSE`` classes there. The classes in such columns get a first block anew, in
an order that has those columns' n-grams at its end, as long as this at least
halves their number: n-grams too rare to be counted beforehand leave that way.

A column that is still dense is never squared: some of its rows (pivots)
are compared with all rows of other components, what links is merged, pivots
leave, and so on until one component is left in the column. Each round takes
more pivots: from all components while none has half of the column, then
from the largest, and from the others at the end; every pair of two components is compared before the
column is done, so no link between components is lost.

Cases: documents without words (null, empty) have an empty set and are their
own component; fewer words than an n-gram are one shingle; equal rows link
like any others; a null id never becomes a component's id unless all are null;
no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.common import LOWER, UPPER, discard, texts, written
from chronoframe.llm.encoding import blocks, held, release, released

#: Words of an n-gram.
SIZE = 4
#: Classes of a column that are still paired directly.
DENSE = 24
#: Pivots of a dense column in the first round, and how many times as many the next has.
PIVOTS, GROWTH = 8, 4
#: Bytes of n-gram sets on either side of a group of pairs, and of text whose sets are made at a time.
GROUP_BYTES, BLOCK_BYTES = 12 << 20, 2 << 20
#: Stored sets whose first blocks are made at a time.
STORED = 512
#: Parts of the hashes in which a set's n-grams are numbered.
MARKS = 128
#: Ids, or rows of ids, that may be broadcast (a few MB), so that sets are not shuffled to be picked.
SMALL_IDS = 250_000
#: Bits of the field that picks documents (16 MB at any size), and of a chunk.
MEMBER_BITS, CHUNK_BITS = 1 << 27, 1 << 15
#: Only the most frequent n-grams, no more than this many, are told apart by frequency.
FREQUENT = 1 << 20
#: N-grams looked at together when local frequencies are taken.
CHUNK = 1 << 21
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrap-around arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(block: pa.Array) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every text."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(block))
    coded = cut.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    rows, sizes = coded.indices.to_numpy(), cut.value_lengths().to_numpy().astype(np.int64)
    # white space at either end leaves an empty word
    real = np.fromiter(map(bool, distinct), bool, len(distinct))[rows]
    doc = np.repeat(np.arange(sizes.size), sizes)[real]
    words, sizes = hashed[rows][real], np.bincount(doc, minlength=sizes.size)
    rolled, ends, found = np.zeros(words.size, np.uint64), np.cumsum(sizes), []
    for i in range(SIZE):
        rolled[: max(words.size - i, 0)] += words[i:] * _P[i]
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if b - a >= SIZE:
            found.append(np.unique(_mix(rolled[a: b - SIZE + 1])))
        elif b > a:
            h = np.full(1, b - a, np.uint64)
            for x in words[a:b]:
                h = _mix(h * _P[0] + x)
            found.append(h)
        else:
            found.append(np.empty(0, np.uint64))
    return found


def _class(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes(), seed=grams.size) - (1 << 63)


def _sets(batches):
    """Rows of the input with their n-gram sets, a block at a time."""
    held("sets", dict)  # nothing is kept here; another operator's cache goes
    for batch in batches:
        for at, block in blocks(batch.column("text"), BLOCK_BYTES):
            yield batch.slice(at, len(block)), shingle_sets(block)


def _classes_and_frequent(batches):
    """Rows (kind, doc_id, h, id, n): a document's class and size, or an n-gram
    that is frequent in a chunk with its count there."""
    kept, held = [], 0

    def frequent():
        grams, counts = np.unique(np.concatenate(kept), return_counts=True)
        often = counts >= max(2, -(-held // FREQUENT))
        none = pa.nulls(int(often.sum()), pa.int64())
        return _batch(1, none, none, grams[often].view(np.int64), counts[often])

    for rows, found in _sets(batches):
        yield _batch(0, rows.column("doc_id"), rows.column("h"), [_class(x) for x in found], [x.size for x in found])
        for x in found:
            kept.append(x)
            held += x.size
            if held >= CHUNK:
                yield frequent()
                kept, held = [], 0
    if held:
        yield frequent()


def _batch(kind, doc, h, ids, n):
    columns = [pa.array([kind] * len(doc), pa.int32()), doc, h, pa.array(ids, pa.int64()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["kind", "doc_id", "h", "id", "n"])


def _stored(batches):
    """As :func:`_sets`, from n-gram sets that were written."""
    for batch in batches:
        column = batch.column("grams")
        at, grams = column.offsets.to_numpy().tolist(), column.values.to_numpy().view(np.uint64)
        for i in range(0, len(batch), STORED):
            rows = batch.slice(i, STORED)
            yield rows, [grams[a:b] for a, b in zip(at[i: i + len(rows)], at[i + 1: i + len(rows) + 1], strict=True)]


def most_frequent(counts: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted n-grams ``id`` of the highest counts ``n``, no more than
    ``FREQUENT``, and their counts. All with over that share of ``total``
    occurrences are among them."""
    step = F.floor(F.log2("n") * 8)
    low, size = float("inf"), 0
    for r in counts.filter("n > 1").groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        size += r["count"]
        if size > FREQUENT:
            break
        low = r["step"]
    kept = counts.filter((F.col("n") > 1) & ((step >= F.lit(low)) | (F.col("n") >= -(-total // FREQUENT)))).toArrow()
    grams, often = kept.column("id").to_numpy().view(np.uint64), kept.column("n").to_numpy()
    order = np.argsort(grams)
    return grams[order], often[order]


def _first_block(shared, sets=_sets):
    """Rows (gram, c, n, pos, often): the n-grams of a class that a partner must
    share, ``often`` being their corpus frequency (0: not frequent). The last of
    a class comes once more, at position -1."""

    def run(batches):
        frequent, counts = shared.value
        for _, found in sets(batches):
            out = []
            for x in (x for x in found if x.size):
                order = np.zeros(x.size, np.int64)
                if frequent.size:
                    at = np.minimum(np.searchsorted(frequent, x), frequent.size - 1)
                    order = np.where(frequent[at] == x, counts[at], 0)
                first = np.lexsort((x, order))[: x.size - -(-85 * x.size // 100) + 1]
                first = np.append(first, first[-1])
                pos = np.arange(first.size, dtype=np.int32)
                pos[-1] = -1
                out.append((x[first], np.full(first.size, _class(x)), np.full(first.size, x.size, np.int32), pos, order[first]))
            if out:
                gram, *others = (np.concatenate(z) for z in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (gram.view(np.int64), *others)], ["gram", "c", "n", "pos", "often"])

    return run


def _needed(n, m):
    """The overlap that links sets of these sizes (rounded up)."""
    return -(-85 * (n + m) // 185)


def _multiply(batches):
    """Products of the columns, read in order of (gram, c) with ``np`` holding
    size and position: rows (a, b, hits, fits) of class pairs, and (gram, a,
    hits, fits) of rows in dense columns, with size and position as the latter.

    ``hits`` counts shared n-grams; ``fits`` says whether one of them stands
    early enough to be the first that a linked pair shares.
    """

    def pairs(gram, c, place):
        n, pos, found = place >> 32, place & 0xFFFFFFFF, []
        for step in range(1, DENSE):
            i = np.flatnonzero(gram[:-step] == gram[step:])
            if not i.size:
                break
            j = i + step
            keep = 85 * np.maximum(n[i], n[j]) <= 100 * np.minimum(n[i], n[j])
            i, j = i[keep], j[keep]
            small = np.minimum(n[i], n[j])
            # the smaller set's n-gram lies in its prefix for larger partners
            own = np.where(n[i] == n[j], np.minimum(pos[i], pos[j]), np.where(n[i] < n[j], pos[i], pos[j]))
            left = np.minimum(n[i] - pos[i], n[j] - pos[j])
            fits = (own <= small - -(-170 * small // 185)) & (left >= _needed(n[i], n[j]))
            found.append(np.stack([c[i], c[j], fits], 1))
        if not found:
            return None
        rows, hits = np.unique(np.concatenate(found), axis=0, return_counts=True)
        size = len(rows)
        return _product(pa.nulls(size, pa.int64()), rows[:, 0], pa.array(rows[:, 1]), hits, rows[:, 2])

    def dense(gram, c, place):
        return _product(pa.array(gram), c, pa.nulls(gram.size, pa.int64()), place >> 32, place & 0xFFFFFFFF)

    held, full = [np.empty(0, np.int64)] * 3, None
    for batch in batches:
        rows = [np.concatenate([h, batch.column(k).to_numpy()]) for h, k in zip(held, ("gram", "c", "np"), strict=True)]
        if not rows[0].size:
            continue
        new = np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])
        gram, c, place = (r[new] for r in rows)
        starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        size = np.diff(starts, append=gram.size)
        many = size > DENSE
        many[0] |= full is not None and gram[0] == full
        # the last column may go on: keep it back unless it is dense already
        hold = 0 if many[-1] else int(size[-1])
        full = gram[-1] if many[-1] else None
        wide = np.repeat(many, size)
        cut = gram.size - hold
        if (out := np.flatnonzero(wide[:cut])).size:
            yield dense(gram[out], c[out], place[out])
        thin = np.flatnonzero(~wide[:cut] & np.repeat(size > 1, size)[:cut])
        if thin.size and (done := pairs(gram[thin], c[thin], place[thin])) is not None:
            yield done
        held = [gram[cut:], c[cut:], place[cut:]]
    if held[0].size > 1 and (done := pairs(*held)) is not None:
        yield done


def _product(gram, a, b, hits, fits):
    columns = [gram, pa.array(a), b, pa.array(hits.astype(np.int32)), pa.array(fits.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["gram", "a", "b", "hits", "fits"])


def candidates(products: DataFrame, meta: DataFrame, dense: DataFrame) -> DataFrame:
    """Pairs (a, b) whose overlap may still reach the bound: of the class whose
    first block ends first, every n-gram there that is not shared is lost."""
    added = products.filter("b is not null").groupBy("a", "b").agg(F.sum("hits").alias("hits"), F.max("fits").alias("fits"))
    # n-grams in dense columns are not counted among the hits
    more = dense.groupBy("c").agg(F.count("*").alias("unseen"))
    ends = meta.join(more, "c", "left").select("c", "n", "last", F.coalesce("unseen", F.lit(0)).alias("unseen"))
    both = (
        added.filter("fits > 0").join(ends.toDF("a", "na", "la", "ua"), "a").join(ends.toDF("b", "nb", "lb", "ub"), "b")
        .withColumn("own", F.when(F.col("la") <= F.col("lb"), F.col("na")).otherwise(F.col("nb")))
    )
    block = F.col("own") - F.ceil(F.col("own") * 85 / 100) + 1
    lost = F.greatest(F.lit(0), block - F.col("hits") - F.least("ua", "ub"))
    return both.filter(F.col("own") - lost >= F.ceil((F.col("na") + F.col("nb")) * 85 / 185)).select("a", "b", "hits")


def _may_start(n: str, pos: str, m: str, at: str) -> Column:
    """Whether an n-gram at these positions of two sets of these sizes can be
    the first that they share if they link (as ``fits`` in the product): any
    other column may leave the pair to the one where it is."""
    n, pos, m, at = F.col(n), F.col(pos), F.col(m), F.col(at)
    small = F.least(n, m)
    own = F.when(n == m, F.least(pos, at)).when(n < m, pos).otherwise(at)
    return (
        (F.greatest(n, m) * 85 <= small * 100) & (own <= small - F.ceil(small * 170 / 185))
        & (F.least(n - pos, m - at) >= F.ceil((n + m) * 85 / 185))
    )


def _in_groups(pairs: DataFrame, values: DataFrame, size: Column, keep) -> DataFrame:
    """The pairs that ``keep(value of a, value of b)`` holds for; ``values`` has
    a value ``v`` of about ``size`` bytes for each class ``c``.

    Left classes are dealt into buckets of ``GROUP_BYTES`` of values, a right
    class goes once to every bucket that holds a partner of it, and the rows of
    a bucket are dealt into as many parts as their bytes need: a value is sent
    once a bucket, not once a pair, and nothing goes through the driver.
    """
    left = _only(values, pairs, "a")
    rows, total = left.agg(F.count("*"), F.sum(size)).first()
    buckets = 1 + int(total or 0) // GROUP_BYTES
    bucket = F.pmod(F.xxhash64("a"), F.lit(buckets)).cast("int").alias("bucket")
    partners = pairs.groupBy("b", bucket).agg(F.collect_list("a").alias("partners"))
    met = partners.count()
    # values that meet are of like sizes, and a bucket's rows are dealt by hash
    parts = 1 + met * int(total or 0) // (max(rows, 1) * buckets * GROUP_BYTES)
    right = _only(values, pairs, "b").select(F.col("c").alias("b"), F.col("v").alias("other"))
    right = right.join(F.broadcast(partners) if met <= SMALL_IDS else partners, "b")
    right = right.withColumn("part", F.pmod(F.xxhash64("b", F.lit(11)), F.lit(parts)).cast("int"))
    left = left.select(
        F.pmod(F.xxhash64("c"), F.lit(buckets)).cast("int").alias("bucket"), F.col("c").alias("a"), F.col("v").alias("own"),
        F.explode(F.sequence(F.lit(0), F.lit(int(parts) - 1))).alias("part"),
    )

    def compared(own: pa.Table, others: pa.Table) -> pa.Table:
        found = own.column("own").combine_chunks()
        place = {c: i for i, c in enumerate(own.column("a").to_pylist())}
        a, b = [], []
        names, partners_of, theirs = (others.column(c).combine_chunks() for c in ("b", "partners", "other"))
        for i, name in enumerate(names.to_pylist()):
            for other in partners_of[i].as_py():
                if keep(found[place[other]], theirs[i]):
                    a.append(other)
                    b.append(name)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.groupBy("bucket", "part").cogroup(right.groupBy("bucket", "part")).applyInArrow(compared, "a long, b long")


def marks(x: np.ndarray) -> bytes:
    """A set's size and its n-grams' number in each of ``MARKS`` parts of the
    hashes; two sets share no more than the sum of the smaller numbers."""
    counts = np.bincount((x >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64), minlength=MARKS)
    return np.append(counts, x.size).astype(np.uint32 if x.size > 65_535 else np.uint16).tobytes()


def _may_link(a, b) -> bool:
    x, y = (np.frombuffer(v.as_buffer(), np.uint16 if len(v.as_buffer()) == 2 * MARKS + 2 else np.uint32) for v in (a, b))
    return 185 * int(np.minimum(x[:-1], y[:-1]).sum()) >= 85 * (int(x[-1]) + int(y[-1]))


def _link(a, b) -> bool:
    # both are distinct and in unsigned order
    x, y = (v.values.to_numpy().view(np.uint64) for v in (a, b))
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 185 * both >= 85 * (len(x) + len(y))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose exact overlap reaches the bound. Marks, a tenth of a set's
    size, first drop those that cannot."""
    few = sets.select("c", F.col("marks").alias("v"))
    left = written(_in_groups(pairs, few, F.length("v"), _may_link), "may-link")
    if not left.limit(1).count():
        return left
    whole = sets.select("c", F.col("grams").alias("v"))
    return _in_groups(left, whole, 8 * F.size("v"), _link)


def _only(sets: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """The sets of the classes on one side; few enough ids are broadcast, so
    that the sets are not shuffled to be picked."""
    ids = pairs.select(F.col(side).alias("c")).distinct()
    return sets.join(F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, "c", "left_semi")


def member_bits(ids: DataFrame) -> np.ndarray:
    """A bit field of fixed size with the bit of every ``bit`` number set."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = np.zeros(CHUNK_BITS, np.uint8)
        chunk[pdf["bit"].to_numpy() % CHUNK_BITS] = 1
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "bits": [np.packbits(chunk, bitorder="little").tobytes()]})

    rows = ids.distinct().withColumn("chunk", F.shiftright("bit", CHUNK_BITS.bit_length() - 1))
    field = np.zeros(MEMBER_BITS // 8, np.uint8)
    for r in rows.groupBy("chunk").applyInPandas(pack, "chunk long, bits binary").collect():
        field[r.chunk * CHUNK_BITS // 8: (r.chunk + 1) * CHUNK_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return field


def _parts(rows: int) -> int:
    """Partitions for so many short rows: few rows make few files, not one a
    shuffle partition, and many rows make as many as they need."""
    return 1 + rows // SMALL_IDS


def components(edges: DataFrame) -> DataFrame:
    """``c, top``: the smallest node reachable from each node of the edges."""
    edges = edges.select("a", "b").filter("a != b")
    parts = _parts(2 * edges.count())
    ways = written(edges.union(edges.select("b", "a")).toDF("c", "to").distinct().coalesce(parts), "ways")
    now = written(ways.groupBy("c").agg(F.min("to").alias("to")).select("c", F.least("c", "to").alias("top")).coalesce(parts), "tops")
    before = now
    while True:
        seen = ways.join(now.select(F.col("c").alias("to"), "top"), "to").coalesce(parts).groupBy("c").agg(F.min("top").alias("near"))
        best = now.join(seen, "c").select("c", F.col("top").alias("old"), F.least("top", "near").alias("top"))
        # a label's own label: paths halve every round
        label = now.select(F.col("c").alias("top"), F.col("top").alias("up"))
        best = best.join(label, "top", "left").select("c", "old", F.least("top", F.coalesce("up", "top")).alias("top"))
        after = written(best.coalesce(parts), "tops")
        discard(before)
        changed, now, before = after.filter("old != top").limit(1).count(), after.select("c", "top"), after
        if not changed:
            discard(ways)
            return now


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after new links: links are contracted to components first."""
    if not links.limit(1).count():
        return labels
    a = links.join(labels.toDF("a", "ta"), "a")
    edges = a.join(labels.toDF("b", "tb"), "b").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct()
    tops = components(written(edges.coalesce(_parts(links.count())), "edges")).toDF("top", "up")
    merged = labels.join(tops, "top", "left").select("c", F.coalesce("up", "top").alias("top"))
    return written(merged.coalesce(_parts(labels.count())), "labels")


def _compared(labels: DataFrame, pairs: DataFrame, first: DataFrame, sets: DataFrame) -> DataFrame:
    """Labels after the pairs. A few of them (``first``) are compared before the
    others, so that of the many pairs within a group of near copies only those
    are left whose classes these have not brought together."""
    labels = _merge(labels, written(linked(first.select("a", "b"), sets), "links"))
    apart = pairs.select("a", "b").join(labels.toDF("a", "ta"), "a").join(labels.toDF("b", "tb"), "b").filter("ta != tb")
    apart = written(apart.select("a", "b").coalesce(_parts(pairs.count())), "apart")
    if not apart.limit(1).count():
        return labels
    return _merge(labels, written(linked(apart, sets), "links"))


def _dense_round(rows: DataFrame, labels: DataFrame, pivots: int) -> tuple[DataFrame, DataFrame]:
    """Pairs to compare now, and the dense rows that stay after them."""
    parts = _parts(rows.count())
    own = rows.join(labels, "c").coalesce(parts)
    by_top = own.groupBy("gram", "top").agg(F.count("*").alias("n_top")).coalesce(parts)
    grams = by_top.groupBy("gram").agg(
        F.max(F.struct("n_top", "top")).alias("x"), F.sum("n_top").alias("total"), F.count("*").alias("tops")
    ).filter("tops > 1")
    few = (F.col("total") - F.col("x.n_top") <= pivots).alias("few")
    split = (F.col("x.n_top") * 2 < F.col("total")).alias("split")
    open_rows = written(own.join(grams.select("gram", F.col("x.top").alias("main"), few, split), "gram").coalesce(parts), "open")
    outside = F.col("top") != F.col("main")
    last = open_rows.filter(F.col("few") & outside).select("gram", "c", "n", "pos", "top")
    # one pivot a bucket: the bucket's first in a fixed random order
    chosen = (
        open_rows.filter(~F.col("few") & (F.col("split") | ~outside))
        .groupBy("gram", F.pmod(F.xxhash64("c"), F.lit(pivots)).alias("bucket"))
        .agg(F.min_by(F.struct("c", "n", "pos", "top"), F.xxhash64("c", F.lit(7))).alias("p")).select("gram", "p.*")
    )
    picked = written(last.unionByName(chosen).coalesce(parts), "pivots")
    p = picked.select(F.col("gram").alias("pg"), F.col("c").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("top").alias("ta"))
    pairs = open_rows.join(p, F.col("gram") == F.col("pg")).filter((F.col("top") != F.col("ta")) & _may_start("n", "pos", "na", "pa"))
    pairs = written(pairs.select("a", F.col("c").alias("b")).distinct().coalesce(parts), "dense-pairs")
    stay = open_rows.select("gram", "c", "n", "pos").join(picked.select("gram", "c"), ["gram", "c"], "left_anti")
    stay = written(stay.coalesce(parts), "dense")
    discard(open_rows)
    discard(picked)
    return pairs, stay


def _columns(block: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (a, b, hits) and dense rows (gram, c, n, pos) of a first block,
    which is deleted."""
    whole = block
    # (frequency, unsigned hash) as an ordered value
    last = F.struct("often", F.col("gram").bitwiseXOR(F.lit(-(1 << 63)))).alias("last")
    meta = block.filter("pos = -1").select("c", F.col("n").cast("long").alias("n"), last).dropDuplicates(["c"])
    block = block.filter("pos >= 0")
    # a column that only the frequent n-grams could make very long stays out of
    # the sorted pass; it is dense as it stands
    crowded = block.filter("often > 0").groupBy("gram").agg(F.count("*").alias("m")).filter(F.col("m") > DENSE).select("gram")
    crowded = written(crowded, "crowded")
    rest = block.filter("often = 0").unionByName(block.filter("often > 0").join(crowded, "gram", "left_anti"))
    place = (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("np")
    ordered = rest.select("gram", "c", place).repartition("gram").sortWithinPartitions("gram", "c")
    products = written(ordered.mapInArrow(released(_multiply), "gram long, a long, b long, hits int, fits int"), "products")
    dense = products.filter("b is null").select("gram", F.col("a").alias("c"), F.col("hits").alias("n"), F.col("fits").alias("pos")).unionByName(
        block.filter("often > 0").join(crowded, "gram").select("gram", "c", "n", "pos")
    )
    dense = written(dense.dropDuplicates(["gram", "c"]), "dense")
    pairs = written(candidates(products, meta, dense), "pairs")
    discard(whole)
    discard(products)
    return pairs, dense


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, h`` (the text's hash), ``n_shingles, component_id`` and
    ``top``, the component's class, for every row."""
    rows, spark = texts(docs), docs.sparkSession
    hashed = rows.withColumn("h", F.xxhash64("text"))
    first = written(hashed.mapInArrow(released(_classes_and_frequent), "kind int, doc_id long, h long, id long, n long"), "classes")
    classes = first.filter("kind = 0").select("doc_id", "h", F.col("id").alias("c"), "n")
    total = classes.agg(F.sum("n")).first()[0] or 0
    counts = written(first.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")), "counts")
    often = most_frequent(counts, total)
    discard(counts)
    shared = spark.sparkContext.broadcast(often)
    columns = "gram long, c long, n int, pos int, often long"
    pairs, dense = _columns(written(rows.mapInArrow(released(_first_block(shared)), columns), "block"))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).union(dense.select("c")).distinct()
    # the n-grams of the wanted classes, each from one of its documents: a bit
    # field picks the documents in the scan, so no text is shuffled; what it lets
    # through besides is not asked for below
    one = written(classes.groupBy("c").agg(F.min("doc_id").alias("doc_id")).join(wanted, "c"), "wanted")
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(MEMBER_BITS)).alias("bit")
    shared.destroy()  # the block is written
    members = spark.sparkContext.broadcast(member_bits(one.select(bit)))

    def grams_of(batches):
        field = members.value
        for batch in batches:
            at = batch.column("bit").to_numpy()
            mine = batch.filter(pa.array((field[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for _, found in _sets([mine] if len(mine) else []):
                ends = np.cumsum([0, *(x.size for x in found)], dtype=np.int32)
                grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))
                few = pa.array([marks(x) for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([_class(x) for x in found], pa.int64()), grams, few], ["c", "grams", "marks"])

    sets = written(rows.withColumn("bit", bit).mapInArrow(released(grams_of), "c long, grams array<long>, marks binary"), "sets")

    members.destroy()
    classes_left = dense.select("c").distinct().count()
    while classes_left:
        # dense columns' n-grams go to the end of the order
        late = most_frequent(dense.groupBy(F.col("gram").alias("id")).agg(F.count("*").alias("n")), dense.count())
        grams, at = np.unique(np.concatenate([often[0], late[0]]), return_index=True)
        often = grams, np.concatenate([often[1], late[1]])[at]
        shared = spark.sparkContext.broadcast(often)
        again = _only(sets.select("c", "grams"), dense, "c").select("grams").mapInArrow(released(_first_block(shared, _stored)), columns)
        more, dense = _columns(written(again, "block"))
        shared.destroy()
        pairs = pairs.unionByName(more)
        before, classes_left = classes_left, dense.select("c").distinct().count()
        if 2 * classes_left > before:
            break
    pairs = written(pairs.groupBy("a", "b").agg(F.max("hits").alias("hits")), "all-pairs")
    del often
    labels = one.select("c", F.col("c").alias("top"))
    # each class with the one that it shares most with
    nearest = pairs.groupBy("a").agg(F.max_by("b", F.struct("hits", "b")).alias("b")).unionByName(
        pairs.groupBy("b").agg(F.max_by("a", F.struct("hits", "a")).alias("a"))
    ).distinct()
    labels = _compared(written(labels, "labels"), pairs, nearest, sets)
    pivots = PIVOTS
    every, sets = sets, written(_only(sets, dense, "c"), "dense-sets")
    discard(every)
    while dense.limit(1).count():
        pairs, dense = _dense_round(dense, labels, pivots)
        if not pairs.limit(1).count():
            pivots *= GROWTH
            continue
        # each row with one pivot, the same for most rows of a column
        nearest = pairs.groupBy("b").agg(F.min_by("a", F.xxhash64("a", F.lit(7))).alias("a"))
        labels = _compared(labels, pairs, nearest, sets)
        pivots *= GROWTH

    joined = classes.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("low")).join(labels, "c", "left")
    joined = joined.select("c", "low", F.coalesce("top", "c").alias("top"))
    lowest = joined.groupBy("top").agg(F.min("low").alias("component_id"))
    own = joined.join(lowest, "top").select("c", "top", "component_id")
    return classes.join(own, "c", "left").select(
        "doc_id", "h", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "top",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, whole rows, with one of each component: the one with the
    smallest id (null last), then hash. All documents with empty sets stay."""
    found = written(jaccard_components(docs).filter("n_shingles > 0"), "components")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    kept = found.groupBy("top").agg(F.min(place).alias("x")).select("top", "x.*")
    other = found.join(kept.select("top", F.col("doc_id").alias("id"), F.col("h").alias("kept_h")), "top").filter(
        ~F.col("doc_id").eqNullSafe(F.col("id")) | (F.col("h") != F.col("kept_h"))
    )
    gone = other.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h")).distinct()
    ours = docs.withColumn("__text_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    left = ours.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_h") == F.col("__h")), "left_anti")
    if found.groupBy("doc_id", "h").count().filter("count > 1").limit(1).count():
        # rows equal in id and text: one of them stays, but all of those without words
        worded = F.col("text").isNotNull() & F.col("text").rlike("[^\\x20\\x09-\\x0D]")
        left = left.filter(worded).dropDuplicates(["doc_id", "__text_h"]).unionByName(left.filter(~worded | F.col("text").isNull()))
    return left.drop("__text_h")


def oracle_sql() -> str:
    """The same in DuckDB, from all pairs that share an n-gram."""
    words = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x20\\x09-\\x0D]+')".format(UPPER, LOWER)
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, {words} AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {SIZE} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {SIZE} + 2), lambda i: array_to_string(ws[i:i + {SIZE} - 1], ' '))) END AS grams
  FROM docs),
flat AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS n
  FROM flat x JOIN flat y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 100 * n >= 85 * (na + nb - n)),
reach AS (SELECT doc_id, doc_id AS top FROM docs UNION SELECT l.b, r.top FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, min(r.top) AS component_id
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.grams
"""
