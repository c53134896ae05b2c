"""Benchmark decontamination by a prefix-filtered set join of word windows.

A window is ``width`` consecutive words of an item, or the whole of a shorter
one. Containment of a window asks for all of its words, so one word is the
necessary prefix: the rarest, by its count over all documents. Windows with a
word that no document holds are dropped at once. A document word equal to a
window's rarest word gives one candidate place; the positional bound (the
window starts inside the text) and the length bound (it ends inside) come
next, and the words of the place are compared in full.

The join goes to the documents, never to the benchmark: the rare words are
sent to the executors in blocks of at most ``BLOCK`` rows, each block meeting
all documents.

Cases: null and empty texts have no words; items without words and null
item_ids count for nothing in the item list; rows equal in id and text are one
document and all get its result; null ids are kept; an empty benchmark hits
nothing; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.common import LOWER, UPPER, ascii_lower, texts, written

#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of one broadcast block; a row is a word, two numbers and an id.
BLOCK = 100_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


def windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``window, words, items``: the distinct windows and their item ids."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.coalesce("text", F.lit(""))).alias("ws"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - width, F.lit(0)))
    each = items.filter(F.size("ws") > 0).select(
        "item", F.explode(F.transform(starts, lambda i: F.slice("ws", i + 1, width))).alias("words")
    )
    found = each.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return found.withColumn("window", F.monotonically_increasing_id())


def _blocks(small: DataFrame, key: str) -> list[DataFrame]:
    """Broadcast blocks of about ``BLOCK`` rows; rows of a key stay together."""
    n = -(-max(small.count(), 1) // BLOCK)
    return [F.broadcast(small.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i)) for i in range(n)]


def rarest(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """``window, words, size, word, at``: the windows whose words all occur in
    the documents, with their rarest word and its place."""
    own = wins.select("window", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    vocabulary = written(own.select("word").distinct(), "vocabulary")
    seen = docs.select(F.explode(words(F.col("text"))).alias("word"))
    counts = reduce(
        DataFrame.unionByName, [seen.join(b, "word").groupBy("word").agg(F.count("*").alias("n")) for b in _blocks(vocabulary, "word")]
    )
    first = F.min(F.struct("n", "word", "at")).alias("x")
    ranked = own.join(counts, "word", "left").groupBy("window", "size").agg(first, F.bool_and(F.col("n").isNotNull()).alias("all"))
    kept = ranked.filter("all").select("window", "size", "x.word", "x.at")
    return kept.join(wins.select("window", "words"), "window")


def hits(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """Per document: ``doc_id, h, n_words, n_hit`` and ``found``, the verified
    windows (``start, size, window``) in order of their start."""
    rows = texts(docs).withColumn("h", F.xxhash64("text"))
    anchors = written(rarest(rows, wins), "anchors")
    placed = rows.select("doc_id", "h", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    start = (F.col("pos") - F.col("at")).alias("start")
    candidates = reduce(
        DataFrame.unionByName,
        [placed.join(b, "word").select("doc_id", "h", start, "size", "window", "words") for b in _blocks(anchors, "word")],
    ).filter("start >= 0")
    per_doc = candidates.groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_set(F.struct("start", "size", "window", "words"))).alias("places")
    ).toDF("d", "dh", "places")
    joined = rows.join(per_doc, rows.doc_id.eqNullSafe(F.col("d")) & (rows.h == F.col("dh")), "left").select(
        "doc_id", "h", words(F.col("text")).alias("ws"), "places"
    )
    exact = F.filter(
        "places",
        lambda c: (c.start + c["size"] <= F.size("ws")) & (F.slice(F.col("ws"), c.start + 1, c["size"]) == c.words),
    )
    verified = joined.select(
        "doc_id", "h", F.size("ws").cast("long").alias("n_words"),
        F.transform(F.coalesce(exact, F.array()), lambda c: F.struct(c.start, c["size"], c.window)).alias("found"),
    )
    # starts ascend, so the words not yet covered by earlier windows add up
    covered = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, c: F.struct(
            (acc.n + F.greatest(F.lit(0), c.start + c["size"] - F.greatest(c.start, acc.end))).alias("n"),
            F.greatest(acc.end, c.start + c["size"]).alias("end"),
        ),
        lambda acc: acc.n.cast("long"),
    )
    return verified.withColumn("n_hit", covered)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``doc_id, h, n_words, n_hit, items, contaminated`` per document; ``items``
    holds the ids of the items with occurring windows, sorted as strings."""
    wins = written(windows(benchmark, width), "windows")
    per_doc = written(hits(docs, wins), "hits")
    occurring = per_doc.select("doc_id", "h", F.explode(F.array_distinct(F.transform("found", lambda x: x.window))).alias("window"))
    items = (
        occurring.join(wins, "window").select(F.col("doc_id").alias("d"), F.col("h").alias("dh"), F.explode("items").alias("item"))
        .groupBy("d", "dh").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    found = per_doc.join(items, per_doc.doc_id.eqNullSafe(items.d) & (per_doc.h == items.dh), "left")
    return found.select(
        "doc_id", "h", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents, whole rows, without an occurrence of a window."""
    # written before it is filtered: a pushed filter would work the words of a
    # text out anew for every candidate
    found = written(hits(docs, written(windows(benchmark, width), "windows")).select("doc_id", "h", "n_hit"), "hits").filter("n_hit > 0")
    gone = found.select("doc_id", "h").distinct().toDF("__id", "__h")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__h"))
    return docs.join(gone, same, "left_anti")


def oracle_sql(width: int = 10) -> str:
    """The same in DuckDB, from every window of the documents."""
    words = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(UPPER, LOWER)
    return f"""
WITH items AS (SELECT item_id, {words} AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, ws[i:i + {width} - 1] AS win
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - {width} + 1, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(win) AS size FROM wins),
docs AS (SELECT doc_id, {words} AS ws FROM documents),
places AS (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM docs CROSS JOIN sizes WHERE len(ws) >= size),
found AS (SELECT p.doc_id, p.i, p.size, w.item_id FROM places p JOIN wins w ON w.win = p.ws[p.i:p.i + p.size - 1]),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM found) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN item t ON d.doc_id = t.doc_id
"""
