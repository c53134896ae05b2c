"""Quality classifier: hashed word n-gram logistic regression.

Features are word 1- and 2-grams, and 1- to 3-grams of word forms (capitals,
digits and marks, and whether the word came up just before), all hashed to
``2 ** BITS`` places; a feature's value is its share of the text's n-grams.
Training is follow-the-regularised-leader (FTRL-proximal), one pass of updates
after another, on at most about ``TRAIN_ROWS`` labelled documents picked by a
hash of their id; tasks of about ``SHARD_ROWS`` rows train on their own part and
the weights are averaged. The model has a fixed size. Scoring is a sparse dot product per text.

Only the text is an input of a score. Documents with crc32(id) mod 5 = 0 are
held out. Cases: null and empty texts score the bias alone; rows without or
with a null label do not train; an id labelled twice counts by its mean; a null
id is scored and never trains; without any label every score is 0.5; equal
texts have equal scores; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.common import crc_mod, ship, texts
from chronoframe.llm.encoding import blocks, held, release, released

BITS = 18
#: Rows a shard aims at, and updates that each shard's model gets at least.
TRAIN_ROWS, SHARD_ROWS, EPOCHS, UPDATES = 20_000, 1_500, 3, 5_000
#: Bytes of text whose n-grams are held at a time, and of word forms that a task keeps.
BLOCK_BYTES, CACHE_BYTES = 1 << 19, 32 << 20
ALPHA, BETA, L1, L2 = 8.0, 1.0, 1e-4, 1e-4
THRESHOLD = 0.3
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_RUNS = [(re.compile(p), c) for p, c in ((r"[A-ZÀ-ÖØ-Þ]+", "A"), (r"[a-zß-öø-ÿ]+", "a"), (r"[0-9]+", "0"))]


def _form(word: str) -> str:
    for pattern, sign in _RUNS:
        word = pattern.sub(sign, word)
    return word


def _place(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C[0]
    return ((x ^ (x >> np.uint64(29))) * _C[1]) >> np.uint64(64 - BITS)


class Features:
    """Feature places of whole texts, with a cache of word forms."""

    def __init__(self):
        self.forms: dict[str, tuple[int, int]] = {}
        self.held = 0

    def __call__(self, block: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of all n-grams, text after text, and each text's number."""
        cut = pc.ascii_split_whitespace(block)
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if self.held > CACHE_BYTES:
            self.forms, self.held = {}, 0
        known, long = self.forms, {}
        for w in distinct:
            if w not in known:
                both = xxhash.xxh3_64_intdigest(w.lower()), xxhash.xxh3_64_intdigest(_form(w), seed=1)
                if len(w) > 256:  # not worth its place
                    long[w] = both
                    continue
                known[w] = both
                self.held += 250 + 2 * len(w)
        if long:
            known = {w: long.get(w) or known[w] for w in distinct}
        table = np.array([known[w] for w in distinct], np.uint64).reshape(-1, 2)[coded.indices.to_numpy()]
        sizes = cut.value_lengths().to_numpy().astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        word, form = table[:, 0], table[:, 1].copy()
        since = np.arange(word.size) - np.repeat(starts, sizes)
        for back in (1, 2, 3, 4):
            same = np.zeros(word.size, bool)
            same[back:] = (word[back:] == word[:-back]) & (since[back:] >= back)
            form[same] += _C[2] * np.uint64(back)
        grams = [word, form]
        for base, length in ((word, 2), (form, 2), (form, 3)):
            gram = np.full(word.size, length, np.uint64) * _C[2] + base
            for i in range(1, length):
                # what would reach over the text's beginning is shorter
                gram[i:] += np.where(since[i:] >= i, base[:-i], np.uint64(0)) * _C[1] ** np.uint64(i)
            grams.append(gram)
        places = np.stack([_place(g + np.uint64(k)) for k, g in enumerate(grams)], 1)
        return places.reshape(-1).astype(np.int64), sizes * len(grams)


def reduced(places: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct places in order, with the share of its n-grams
    there; the bias comes last."""
    out = []
    for p in np.split(places.astype(np.int32), np.cumsum(sizes)[:-1]):
        at, counts = np.unique(p, return_counts=True)
        shares = (counts / max(p.size, 1)).astype(np.float32)
        out.append((np.append(at, np.int32(1 << BITS)), np.append(shares, np.float32(1))))
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights of sparse rows (the last one is the bias)."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(max(EPOCHS, -(-UPDATES // max(len(rows), 1)))):
        for (at, x), y in zip(rows, labels, strict=True):
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[at], n[at] = zs + g - sigma * w, ns + g * g
    return weights(z, n)


def _models(batches):
    """A model of every shard, whose rows come one after another; a text is let
    go as soon as its places are known."""
    held("quality", dict)  # nothing is kept here; another operator's cache goes
    features, shard, rows, labels = Features(), None, [], []

    def model():
        w = train(rows, np.array(labels)).astype(np.float32).tobytes()
        return pa.RecordBatch.from_pydict({"rows": pa.array([len(rows)], pa.int64()), "w": pa.array([w], pa.binary())})

    for batch in batches:
        for at, block in blocks(batch.column("text"), BLOCK_BYTES):
            numbers, ys = (batch.column(c).slice(at, len(block)).to_pylist() for c in ("shard", "y"))
            for number, y, row in zip(numbers, ys, reduced(*features(block)), strict=True):
                if number != shard and rows:
                    yield model()
                    rows, labels = [], []
                shard = number
                rows.append(row)
                labels.append(y)
    if rows:
        yield model()


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Mean weights of the shards' models; zeros without a label."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).dropna()
    usable = usable.filter(crc_mod(F.col("doc_id"), 5) != 0).groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    number = usable.count()
    shards = max(1, min(number, TRAIN_ROWS) // SHARD_ROWS)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = usable.filter(place < int((1 << 30) * min(1.0, TRAIN_ROWS / max(number, 1))))
    # about TRAIN_ROWS rows of two numbers at any size of the table
    rows = texts(docs).join(F.broadcast(picked), "doc_id").withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(shards)))

    # in a fixed random order, so that neither id nor length says when a row trains
    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("doc_id", F.lit(5)), "doc_id", "text")
    models = dealt.select("shard", "y", "text").mapInArrow(released(_models), "rows long, w binary").collect()
    total = np.zeros((1 << BITS) + 1)
    for m in models:
        total += m.rows * np.frombuffer(m.w, np.float32).astype(float)
    return (total / max(1, sum(m.rows for m in models))).astype(np.float32)


def score(docs: DataFrame, model: np.ndarray, into: str = "score") -> DataFrame:
    """The documents' own columns and the score (0 to 1) as column ``into``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def values(texts_: pa.Array, features: Features) -> pa.Array:
        w, out = shared.value, []
        for _, block in blocks(texts_.cast(pa.string()).fill_null(""), BLOCK_BYTES):
            places, sizes = features(block)
            total, some = np.zeros(sizes.size), sizes > 0
            if places.size:
                total[some] = np.add.reduceat(w[places].astype(np.float64), (np.cumsum(sizes) - sizes)[some])
            out.append(total / np.maximum(sizes, 1) + w[-1])
        return pa.array(1 / (1 + np.exp(-np.concatenate(out))) if out else np.empty(0))

    # forms are a task's own and go with it: workers idle through the stages that follow
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held("quality", dict)  # nothing is kept here; another operator's cache goes
        features = Features()
        try:
            for text in batches:
                yield values(text, features)
        finally:
            del features
            release()

    return docs.withColumn(into, run("text"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score(texts(docs), fit(docs, labels))
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, whole rows, that the classifier does not reject."""
    return score(docs, fit(docs, labels), "__score").filter(F.col("__score") >= THRESHOLD).drop("__score")
