"""Hard negatives by a vertical scan of the vectors' dimensions (BOND).

A task turns each batch of rows into columns, one per dimension, with the least
and greatest value of each. An anchor reads the columns in descending order of
its own components' magnitude and adds up partial scores. What the columns not
yet read can still contribute lies between sums of those least and greatest
values, so every row's score has a lower and an upper bound, which close in with
every column. A row leaves the anchor's bitmap once it can no longer be among
the first rows of any of the anchor's windows; the rows left at the end have
exact scores. Each task keeps the first rows of every window over its batches,
and their worst scores raise the bounds for the batches after.

Two searches use it: the first ``positives`` rows of the same label, then, per
positive, the first ``negatives`` rows of another label whose score lies in a
window below the positive's. Anchors go to all tasks in blocks of ``BLOCK_BYTES``
at most, each block against all rows.

Cases: rows with a null label or vector, or a null or non-finite component take
no part; shorter vectors count as if filled up with zeros; equal rows (id, label
and vector) count once; rows of equal id and other content are rows of their
own, and their ties fall by label and vector; a null id is no anchor and comes
last among ties; an anchor without another row of its label, and a positive
whose window holds no row, give no rows; no rows give no rows; other columns are
not read. Scores are exact at every size of the components; one beyond 64 bits
is an error, as the result cannot hold it.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.llm.common import partitions, ship, written

#: Rows searched at a time, bytes of an anchor block, and columns read between two looks at the bounds.
BATCH_ROWS, BLOCK_BYTES, STRIDE = 8192, 8 << 20, 8
#: Stands for a null id: after all others.
_LAST = (1 << 63) - 1
_FOUND = "anchor long, window int, score long, row long, id long"


def vectors(embeddings: DataFrame, relabel: bool = True) -> DataFrame:
    """``id, label, vector`` of the rows that take part; with ``relabel`` the
    label of every id divisible by seven moves on by one."""
    ship(embeddings.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col("label").cast("long")
    if relabel:
        label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_LAST)).alias("id"), label.alias("label"), vector.alias("vector")).distinct()


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """floor(256 x) of every component, a column per row."""
    counts = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = np.floor(256 * vectors.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((size, len(counts)))
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    out[np.arange(len(values)) - starts, np.repeat(np.arange(len(counts)), counts)] = values
    return out


def _exact(columns: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every sum of products is exact so, else as integers
    of 64 bits, else of any size."""
    top = [int(np.abs(x).max()) if x.size else 0 for x in (columns, anchors)]
    bound = top[0] * top[1] * max(1, len(columns))
    if bound < 1 << 52:
        return columns, anchors
    if bound < 1 << 62:
        return columns.astype(np.int64), anchors.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(columns), whole(anchors)


def _first(score: np.ndarray, row: np.ndarray, number: int) -> np.ndarray:
    if score.dtype == object:
        return np.array(sorted(range(len(score)), key=lambda k: (-score[k], row[k]))[:number], np.int64)
    return np.lexsort((row, -score))[:number]


class Anchors:
    """A block of anchors: rows of id, row number, label, vector and windows,
    each window the least and the greatest score it takes."""

    def __init__(self, rows: list, size: int, number: int, same_label: bool):
        self.rows, self.labels = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
        self.vectors = _matrix(pa.array([r[3] for r in rows], pa.list_(pa.float64())), size).T
        self.windows = [r[4] for r in rows]
        self.size, self.number, self.same = size, number, same_label


class Search:
    """One task's search of its rows for a block of anchors."""

    def __init__(self, anchors: Anchors):
        self.anchors = anchors
        #: The first rows of every window so far: scores and rows.
        self.best = [[(np.empty(0, np.int64),) * 3 for _ in w] for w in anchors.windows]

    def add(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, columns: np.ndarray) -> None:
        order = np.argsort(labels, kind="stable")
        ids, rows, labels = ids[order], rows[order], labels[order]
        columns, vectors = _exact(np.ascontiguousarray(columns[:, order]), self.anchors.vectors)
        least, most = columns.min(axis=1), columns.max(axis=1)
        for i in range(len(vectors)):
            if not self.anchors.windows[i]:
                continue
            start, end = (int(np.searchsorted(labels, self.anchors.labels[i], side)) for side in ("left", "right"))
            if self.anchors.same:
                found, score = self._scan(i, columns[:, start:end], rows[start:end] != self.anchors.rows[i], vectors[i], least, most)
                found = found + start
            else:
                candidates = np.ones(len(rows), bool)
                candidates[start:end] = False
                found, score = self._scan(i, columns, candidates, vectors[i], least, most)
            self._keep(i, score, rows[found], ids[found])

    def _bounds(self, i: int) -> list[tuple[int, int]]:
        """Each window, its low end raised to the worst of its first rows."""
        full = [len(b[0]) == self.anchors.number for b in self.best[i]]
        return [(max(w[0], int(b[0][-1])) if f else w[0], w[1]) for w, b, f in zip(self.anchors.windows[i], self.best[i], full, strict=True)]

    def _scan(self, i: int, columns: np.ndarray, candidates: np.ndarray, vector: np.ndarray, least: np.ndarray, most: np.ndarray):
        """The candidates that may belong to a window, and their exact scores."""
        windows = self._bounds(i)
        bottom, top = min(w[0] for w in windows), max(w[1] for w in windows)
        order = np.argsort(-np.abs(vector), kind="stable")
        ends = vector[order] * least[order], vector[order] * most[order]
        # what the columns from each place on can add
        less, more = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (np.minimum(*ends), np.maximum(*ends)))
        score, rows = np.zeros(len(candidates), columns.dtype), None
        for at in range(0, len(order), STRIDE):
            part = order[at: at + STRIDE]
            score = score + vector[part] @ (columns[part] if rows is None else columns[part[:, None], rows])
            upto = at + len(part)
            reach = (score + more[upto] >= bottom) & (score + less[upto] <= top)
            if rows is None:
                candidates = candidates & reach
                if 4 * np.count_nonzero(candidates) < len(candidates):
                    rows = np.flatnonzero(candidates)
                    score = score[rows]
            else:
                rows, score = rows[reach], score[reach]
            if rows is not None and not len(rows):
                break
        return (np.flatnonzero(candidates), score[candidates]) if rows is None else (rows, score)

    def _keep(self, i: int, score: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        if not len(score):
            return
        exact = score if score.dtype == object else score.astype(np.int64)
        for j, (low, high) in enumerate(self._bounds(i)):
            mine = np.flatnonzero((exact >= low) & (exact <= high))
            if mine.size:
                s, r, d = (np.concatenate(x) for x in zip(self.best[i][j], (exact[mine], rows[mine], ids[mine]), strict=True))
                first = _first(s, r, self.anchors.number)
                self.best[i][j] = s[first], r[first], d[first]

    def found(self) -> pa.RecordBatch:
        flat = [(a, j, *b) for a, own in zip(self.anchors.rows.tolist(), self.best, strict=True) for j, b in enumerate(own)]
        counts = [len(x[2]) for x in flat]
        columns = [np.repeat([x[0] for x in flat], counts), np.repeat([x[1] for x in flat], counts)]
        lists = [list(chain.from_iterable(x[k].tolist() for x in flat)) for k in (2, 3, 4)]
        arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(x, pa.int64()) for x in lists)]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "window", "score", "row", "id"])


def _search(rows: DataFrame, anchors: Anchors, name: str) -> DataFrame:
    """``anchor, window, rank, score, row, id``: the first rows of every window."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches):
        search = Search(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                ids, places, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "row", "label"))
                search.add(ids, places, labels, _matrix(part.column("vector"), shared.value.size))
        yield search.found()

    found = rows.mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "row")
    out = written(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= anchors.number), name)
    shared.unpersist()
    return out


def hard_negatives(
    embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10,
    low_percent: int = 30, high_percent: int = 90, relabel: bool = True,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the anchors whose id is divisible by ``every``."""
    # numbered in order of id, so that a row's number breaks ties as its id does
    order = ["id", "label", "vector"]
    ordered = vectors(embeddings, relabel).repartitionByRange(partitions(embeddings, 8 << 20), *order).sortWithinPartitions(*order)
    rows = written(ordered.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    anchors = written(rows.filter((F.col("id") % every == 0) & (F.col("id") != _LAST)), "anchors")
    number = max(1, -(-anchors.count() * 40 * (size + 1) // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("row"), F.lit(number))
    results = []
    for i in range(number):
        own = [(r.id, r.row, r.label, r.vector) for r in anchors.filter(block == i).collect()]
        any_score = [(-(1 << 127), 1 << 127)]
        found = _search(rows, Anchors([(*a, any_score) for a in own], size, positives, True), "positives")
        scores: dict[int, list[int]] = {}
        for r in found.orderBy("anchor", "rank").collect():
            scores.setdefault(r.anchor, []).append(r.score)
        windows = [[(-(-low_percent * s // 100), high_percent * s // 100) for s in scores.get(a[1], [])] for a in own]
        picked = _search(rows, Anchors([(*a, w) for a, w in zip(own, windows, strict=True)], size, negatives, False), "negatives")
        pairs = found.select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        results.append(picked.join(pairs, ["anchor", "window"]))
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    result = reduce(DataFrame.unionByName, results).join(names, "anchor")

    def known(name):
        return F.when(F.col(name) != _LAST, F.col(name))

    return result.select(
        "anchor_id", known("positive_id").alias("positive_id"), "rank", known("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def oracle_sql() -> str:
    """The registered query in DuckDB SQL, for finite vectors of one length."""
    return """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM v a, v r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.anchor_id AS anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id
  WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
