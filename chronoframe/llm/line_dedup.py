"""Line dedup: later copies of repeated line runs are deleted.

Rule. The lines of a text (cut at line feeds) that hold a word form its
sequence. A run of consecutive lines of at least ``min_words`` words whose
lines also occur, as a run, earlier in the corpus (order: ``doc_id``, then the
text's hash, then the line) is a copy; every line of a copy is deleted. Blank
lines stay.

Method. Suffixes of the line sequences are ranked by prefix doubling: the rank
at level k+1 is the place of (rank at p, rank at p + 2^k) among the sorted
repeated pairs. Equal ranks are an interval of the suffix array whose longest
common prefix is at least 2^k lines; unrepeated suffixes leave at once. A run
[p, p+m) is named by its length and the ranks, at the level of the largest
power of two in m, of its head and of its tail, so that equal names are equal
runs. It is enough to look at the shortest runs from each line on and up to
each line: they cover every maximal repeated run.

Cases: null and empty texts have no lines and stay; rows equal in id and text
are one document and all keep the same lines; rows equal in id alone are
documents of their own; a null id comes first; no rows give no rows; other
columns pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.llm.common import texts, written

KEY = ("doc_id", "h")


def _same(left: DataFrame, right: DataFrame) -> Column:
    """Rows of one document (ids may be null)."""
    return left.doc_id.eqNullSafe(right.doc_id) & (left.h == right.h)


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, h, seq, pos, words, a, b``: one row per line with a word;
    (a, b) is the line's 96-bit hash, ``seq`` its number in the sequence."""
    rows = texts(docs).withColumn("h", F.xxhash64("text"))
    cut = F.filter(
        F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("pos"), line.alias("line"))),
        lambda x: x.line.rlike(r"\S"),
    )
    return (
        rows.select(*KEY, F.posexplode(cut).alias("seq", "x"))
        .select(
            *KEY, "seq", "x.pos", F.regexp_count("x.line", F.lit(r"\S+")).cast("long").alias("words"),
            F.xxhash64("x.line").alias("a"), F.hash("x.line").alias("b"),
        )
        .dropDuplicates([*KEY, "seq"])
    )


def _ranks(pairs: DataFrame, names: list[str], level: int) -> DataFrame:
    """Order-preserving ranks of the values that occur more than once."""
    repeated = pairs.groupBy(*names).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    # ids grow with the partition and the place in it: the sorted order
    ordered = repeated.repartitionByRange(*names).sortWithinPartitions(*names)
    return written(ordered.withColumn("rank", F.monotonically_increasing_id()), f"ranks{level}")


def suffix_ranks(seqs: DataFrame, longest: int) -> dict[int, DataFrame]:
    """Level k → ``doc_id, h, seq, rank`` of the suffixes whose first 2^k lines
    occur more than once, for 2^k up to ``longest``."""
    ranks = _ranks(seqs, ["a", "b"], 0)
    levels = {0: written(seqs.join(ranks, ["a", "b"]).select(*KEY, "seq", "rank"), "level0")}
    k = 0
    while 2 << k <= longest:
        head = levels[k].select(*KEY, "seq", F.col("rank").alias("r1"))
        tail = levels[k].select(*KEY, (F.col("seq") - (1 << k)).alias("seq"), F.col("rank").alias("r2"))
        pairs = head.join(tail, _same(head, tail) & (head.seq == tail.seq)).select(
            head.doc_id, head.h, head.seq, "r1", "r2"
        )
        ranks = _ranks(pairs, ["r1", "r2"], k + 1)
        k += 1
        levels[k] = written(pairs.join(ranks, ["r1", "r2"]).select(*KEY, "seq", "rank"), f"level{k}")
    return levels


def shortest_runs(seqs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, h, seq, m``: the shortest runs of ``min_words`` words from each
    line on and up to each line."""
    doc = Window.partitionBy(*KEY)
    upto = F.sum("words").over(doc.orderBy("seq"))
    counted = seqs.select(*KEY, "seq", "words", upto.alias("upto")).withColumn("before", F.col("upto") - F.col("words"))
    onward = doc.orderBy("before").rangeBetween(0, min_words - 1)
    back = doc.orderBy("upto").rangeBetween(1 - min_words, 0)
    found = counted.select(
        *KEY,
        F.array(
            F.struct(F.col("seq").alias("seq"), F.max("seq").over(onward).alias("end"), (F.max("upto").over(onward) - F.col("before")).alias("w")),
            F.struct(F.min("seq").over(back).alias("seq"), F.col("seq").alias("end"), (F.col("upto") - F.min("before").over(back)).alias("w")),
        ).alias("runs"),
    )
    return (
        found.select(*KEY, F.inline("runs")).filter(F.col("w") >= min_words)
        .select(*KEY, "seq", (F.col("end") - F.col("seq") + 1).alias("m")).distinct()
    )


def copies(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``doc_id, h, positions``: the line numbers to delete in each document
    that holds a later copy."""
    seqs = written(lines(docs), "lines")
    runs = written(shortest_runs(seqs, min_words), "runs")
    longest = runs.agg(F.max("m")).first()[0] or 1
    levels = suffix_ranks(seqs, longest)
    named = []
    for k, level in levels.items():
        mine = runs.filter((F.col("m") >= 1 << k) & (F.col("m") < 2 << k))
        head = level.select("doc_id", "h", "seq", F.col("rank").alias("r1"))
        tail = level.select("doc_id", "h", F.col("seq").alias("tail_seq"), F.col("rank").alias("r2"))
        at = mine.join(head, _same(mine, head) & (mine.seq == head.seq)).select(
            mine.doc_id, mine.h, mine.seq, "m", "r1", (mine.seq + F.col("m") - (1 << k)).alias("tail_at")
        )
        named.append(
            at.join(tail, _same(at, tail) & (at.tail_at == tail.tail_seq)).select(at.doc_id, at.h, at.seq, "m", "r1", "r2")
        )
    named = written(reduce(DataFrame.unionByName, named).distinct(), "named")
    name = ["m", "r1", "r2"]
    first = named.groupBy(*name).agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "seq")).alias("first")).filter("n > 1")
    # written, so that the join can split a run that stands in very many places
    later = named.join(written(first, "first"), name).filter(
        ~F.struct(*KEY, "seq").eqNullSafe(F.struct("first.doc_id", "first.h", "first.seq"))
    )
    gone = later.select(*KEY, F.explode(F.sequence("seq", F.col("seq") + F.col("m") - 1)).alias("seq")).distinct()
    at = gone.join(seqs, _same(gone, seqs) & (gone.seq == seqs.seq)).select(gone.doc_id, gone.h, "pos")
    return at.groupBy(*KEY).agg(F.array_sort(F.collect_set("pos")).alias("positions"))


def _flags(positions: str) -> Column:
    """True at every position of an ascending array, false between them."""
    place = F.col(positions)

    def upto(j: Column) -> Column:
        gap = F.get(place, j) - F.coalesce(F.get(place, j - 1), F.lit(-1)) - 1
        return F.concat(F.array_repeat(F.lit(False), gap.cast("int")), F.array(F.lit(True)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(place) - 1), upto))


def dedup_lines(docs: DataFrame, min_words: int = 50, into: str = "deleted_lines") -> DataFrame:
    """The documents without the copies: ``text`` cleaned, all other columns
    as they were, and ``into`` (sorted line numbers, null if none)."""
    found = copies(docs, min_words).toDF("__doc_id", "__h", "__positions")
    # a flag a line up to the last that goes: looked up at once, however many they are
    found = found.withColumn("__gone", _flags("__positions"))
    ours = docs.withColumn("__text_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = F.array_join(
        F.filter(F.split("text", "\n"), lambda line, i: ~F.coalesce(F.get("__gone", i), F.lit(False))), "\n"
    )
    joined = ours.join(
        found, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc_id")) & (F.col("__text_h") == F.col("__h")), "left"
    )
    cleaned = F.when(F.col("__positions").isNull(), F.col("text")).otherwise(kept).alias("text")
    return joined.select(
        *[cleaned if c == "text" else F.col(f"`{c}`") for c in docs.columns], F.col("__positions").alias(into)
    )


def without_copies(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """The cleaned documents, whole rows; one that was nothing but copies goes."""
    cleaned = dedup_lines(docs, min_words, "__deleted")
    return cleaned.filter(F.col("__deleted").isNull() | F.col("text").rlike(r"\S")).drop("__deleted")


def oracle_sql(min_words: int = 50) -> str:
    """The rule in DuckDB, from every run of lines."""
    return f"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM docs),
every_line AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS pos FROM cut),
wordy AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq,
    len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) AS words
  FROM every_line WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')),
per_doc AS (SELECT doc_id, list(line ORDER BY seq) AS lines, list(pos ORDER BY seq) AS places, list(words ORDER BY seq) AS words FROM wordy GROUP BY doc_id),
starts AS (SELECT *, unnest(range(1, len(lines) + 1)) AS a FROM per_doc),
runs AS (
  SELECT doc_id, a, b, md5(array_to_string(lines[a:b], chr(10))) AS content, places[a:b] AS places
  FROM (SELECT *, unnest(range(a, len(lines) + 1)) AS b FROM starts) WHERE list_sum(words[a:b]) >= {min_words}),
copies AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, a) AS nth FROM runs) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(places) AS pos FROM copies),
kept AS (
  SELECT e.doc_id, count(g.pos) AS n_deleted, count(*) - count(g.pos) AS n_left,
    coalesce(string_agg(g.pos::VARCHAR, ',' ORDER BY g.pos), '') AS deleted_lines,
    coalesce(string_agg(CASE WHEN g.pos IS NULL THEN e.line END, chr(10) ORDER BY e.pos), '') AS cleaned
  FROM every_line e LEFT JOIN gone g USING (doc_id, pos) GROUP BY e.doc_id)
SELECT d.doc_id, greatest(n_left, 1)::INTEGER AS n_kept, n_deleted::INTEGER AS n_deleted, deleted_lines, sha256(cleaned) AS text_sha256
FROM documents d JOIN kept USING (doc_id)
"""
