"""Document fingerprints: one-permutation MinHash with b-bit packing.

A text's words (cut at white space) give its shingles of ``SHINGLE`` words; a
shorter text is one shingle, and a text without words has an empty one. Each
shingle is hashed once: the top bits choose the bin, the smallest hash of a
bin stands for it. Empty bins copy a filled one by optimal densification: bin
j asks bins in a pseudo-random order that only depends on j, so equal sets
stay equal and every empty bin asks on its own. The ``BITS`` low bits of each
bin are stored. Likeness corrects the share m of equal bins for chance:
(m - 2^-b) / (1 - 2^-b), not under 0.

Cases: null and empty texts have the same fingerprint and are alike; rows of
equal id stand in order of their text's hash; a null id comes first; one row
is its own next document; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.llm.common import partitions, texts, written

SHINGLE, BINS, BITS = 5, 256, 8
#: Bins asked one by one before all are looked through.
PROBES = 12
_BIN_BITS = BINS.bit_length() - 1
#: Bins are kept as signed bytes.
_SIGN = 1 << (BITS - 1)


#: All low bits of a bin: the mark of a bin without a hash.
_EMPTY = (1 << (64 - _BIN_BITS)) - 1


def shingle_hashes(words: Column) -> Column:
    """A 64-bit hash of every shingle of a word array."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, SHINGLE)))


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - _BIN_BITS)


def _probe(place: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(place, F.lit(turn)), F.lit(BINS)).cast("int")


def _marks() -> Column:
    """For every bin the largest hash it can hold."""
    values = [((i << (64 - _BIN_BITS)) | _EMPTY) for i in range(BINS)]
    return F.array(*[F.lit(v - (1 << 64) if v >> 63 else v).cast("long") for v in values])


def fingerprints(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds to ``df``, for each text column named by a key, the array of its
    bins' low bits (less ``_SIGN``, a byte each) under the value's name. Every step is a projection."""
    names, out = list(columns), df
    # steps are kept apart, so that no array is worked out once per use
    out = out.withColumns({f"__{c}": F.filter(F.split(c, r"\s+"), lambda w: w != "") for c in names})
    out = out.withColumns({f"__{c}": F.transform(f"__{c}", lambda w: F.xxhash64(w)) for c in names})
    out = out.withColumns({f"__{c}": F.sort_array(F.concat(shingle_hashes(F.col(f"__{c}")), _marks())) for c in names})

    def smallest(c: str) -> Column:
        return F.filter(c, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(F.col(c), i - 1))))

    out = out.withColumns({f"__{c}": smallest(f"__{c}") for c in names})
    out = out.withColumns(
        {f"__{c}": F.transform(f"__{c}", lambda x: F.when(x.bitwiseAND(F.lit(_EMPTY)) != _EMPTY, x)) for c in names}
    )
    out = out.withColumns(
        {
            f"__{c}_full": F.filter(F.transform(f"__{c}", lambda x, j: F.struct(j.alias("j"), x.alias("x"))), lambda p: p.x.isNotNull())
            for c in names
        }
    )

    def densified(c: str) -> Column:
        def nearest(i: Column) -> Column:
            ranked = F.transform(c + "_full", lambda p: F.struct(F.xxhash64(i, p.j).alias("k"), p.x.alias("x")))
            return F.array_min(ranked).x

        def fill(x: Column, i: Column) -> Column:
            return F.coalesce(x, *[F.get(F.col(c), _probe(i, t)) for t in range(PROBES)], nearest(i))

        return F.transform(c, lambda x, i: (fill(x, i).bitwiseAND(F.lit((1 << BITS) - 1)) - _SIGN).cast("byte"))

    out = out.withColumns({name: densified(f"__{c}") for c, name in columns.items()})
    return out.drop(*[f"__{c}" for c in names], *[f"__{c}_full" for c in names])


def packed(bins: Column) -> Column:
    """The bins' bits as lower-case hexadecimal digits, a byte each."""
    digits = F.array(*[F.lit(f"{v:02x}") for v in range(1 << BITS)])
    return F.array_join(F.transform(bins, lambda v: F.get(digits, v.cast("int") + _SIGN)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets, chance corrected."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (equal / BINS - chance) / (1 - chance))


def numbered(rows: DataFrame) -> DataFrame:
    """``doc_id, a, b, n_chars, g``: each document's number in ascending order."""
    meta = rows.groupBy("doc_id", "a", "b").agg(F.max(F.length("text")).alias("n_chars"))
    ordered = meta.repartitionByRange("doc_id", "a", "b").sortWithinPartitions("doc_id", "a", "b")
    placed = written(ordered.withColumn("id", F.monotonically_increasing_id()), "order")
    part, place = F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    # one row a partition in this window
    counts = placed.groupBy(part).agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("part")) - F.col("n")
    )
    return placed.withColumn("part", part).join(counts, "part").select(
        "doc_id", "a", "b", "n_chars", (F.col("before") + place).alias("g")
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` per document. The edited text has its last quarter
    replaced by as much of the next document's beginning."""
    rows = texts(docs)
    rows = rows.withColumns({"a": F.xxhash64("doc_id", "text"), "b": F.xxhash64("text", "doc_id", F.lit(1))})
    index = written(numbered(rows), "numbers")
    total = F.lit(index.count())
    before = index.select(
        F.col("doc_id").alias("to_id"), F.col("a").alias("to_a"), F.col("b").alias("to_b"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("k"), F.pmod(F.col("g") + 1, total).alias("g"),
    )
    # the texts are dealt out once: both joins below read the same columns and
    # so share the exchange (ids travel with the index). A document sends the
    # one before it its beginning and its fingerprint
    dealt = rows.select("a", "b", "text").repartition(partitions(rows), "a", "b")
    sent = dealt.join(index.join(before, "g").select("a", "b", "to_id", "to_a", "to_b", "k"), ["a", "b"])
    sent = fingerprints(sent, {"text": "following"}).select(
        F.col("to_id").alias("doc_id"), F.col("to_a").alias("a"), F.col("to_b").alias("b"), F.substring("text", F.lit(1), F.col("k")).alias("head"), "following"
    )
    # equal rows send the same; one is enough
    heads = sent.groupBy("a", "b").agg(F.max("doc_id").alias("doc_id"), F.max("head").alias("head"), F.max("following").alias("following"))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("head"))
    both = dealt.join(heads, ["a", "b"]).select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "following")
    own, changed = F.col("own"), F.col("changed")
    return fingerprints(both, {"text": "own", "edited": "changed"}).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), packed(own).alias("fingerprint"),
        packed(changed).alias("edited_fingerprint"), likeness(own, changed).alias("near_edited"),
        likeness(own, F.col("following")).alias("near_next"),
    )
