"""Byte-level BPE by recursive DuckDB queries inside each partition.

A task cuts its texts into pre-tokens with the vocabulary's pattern, and hands
the distinct ones that it has not met yet to its own in-memory DuckDB: one row
per (word, position, token), joined to the merge table. Every round of the
recursion contracts, in each word, the pair of lowest rank from the left, until
no word holds a pair of the merge table. Decoding joins token rows to the
vocabulary and concatenates their bytes in order of position.

The merge table holds every way to cut a token into two tokens, since a pair
merges wherever its bytes together are a token. A pre-token that is a token
itself is that token.

A word of more than ``SEGMENT`` bytes is first cut between bytes that no token
found in it spans; no merge crosses such a place. What is longer even so runs the
rounds one statement after another, each replacing the table, and contracts all
places of the lowest pair at once as far as one at a time would give the same:
memory stays a few rows a byte, and long runs take few rounds.

Cases: a null text counts as empty and gives no ids; a null id stays null; equal
rows give equal rows; no rows give no rows; other columns are not read. Strings
of special tokens are ordinary text. Characters that Unicode assigned after the
tables of the installed tiktoken may be cut otherwise than there.
"""

from __future__ import annotations

import base64
from itertools import chain
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.common import ship, texts
from chronoframe.llm.encoding import blocks, held

#: Words of more bytes are cut where no token spans, and rounds over segments of more replace a table.
SEGMENT = 64
#: Bytes of new words in one recursive query, and ids in one decoding query.
QUERY_BYTES, QUERY_IDS = 1 << 18, 1 << 20
#: Bytes that a worker's cache of words holds at most (two generations), and the longest word it keeps.
CACHE_BYTES, CACHE_WORD = 160 << 20, 256

#: ``words`` has a row per token with its word ``w``, place ``p``, id ``t``, the
#: next token's place ``q`` and id ``u``, and the round ``i``. A word's last
#: round has its ids.
_ENCODE = """
 WITH RECURSIVE words(w, p, t, q, u, i) AS (
  SELECT w, p, t, q, u, 0 FROM seed
  UNION ALL (
   WITH lowest AS (SELECT w, min((rank::BIGINT << 32) | p) AS k FROM words JOIN merges ON t = a AND u = b GROUP BY w),
    hit AS (
     SELECT x.w, x.p, x.q AS gone, (k >> 32)::INT AS rank, y.q, y.u FROM lowest l
     JOIN words x ON x.w = l.w AND x.p = (k & 4294967295) JOIN words y ON y.w = l.w AND y.p = x.q)
   SELECT s.w, s.p, CASE WHEN s.p = h.p THEN h.rank ELSE s.t END, CASE WHEN s.p = h.p THEN h.q ELSE s.q END,
    CASE WHEN s.p = h.p THEN h.u WHEN s.q = h.p THEN h.rank ELSE s.u END, s.i + 1
   FROM words s JOIN hit h ON h.w = s.w WHERE s.p <> h.gone)),
  ended AS (SELECT w, max(i) AS i FROM words GROUP BY w)
 SELECT w, t FROM words JOIN ended USING (w, i) ORDER BY w, p
"""
#: One round over long words: the places of each word's lowest pair, every second
#: one where they overlap, from the left up to the first whose new token makes a
#: pair of lower rank with a neighbour.
_ROUND = """
 CREATE OR REPLACE TABLE after AS
 WITH pairs AS (SELECT w, p, q, rank FROM words JOIN merges ON t = a AND u = b),
  lowest AS (SELECT w, min(rank) AS rank FROM pairs GROUP BY w),
  places AS (
   SELECT w, p, q, rank, row_number() OVER o AS n, lag(q, 1, -1) OVER o <> p AS head
   FROM pairs JOIN lowest USING (w, rank) WINDOW o AS (PARTITION BY w ORDER BY p)),
  runs AS (SELECT *, n - max(CASE WHEN head THEN n END) OVER (PARTITION BY w ORDER BY p) AS k FROM places),
  apart AS (
   SELECT r.w, r.p, r.q AS gone, r.rank, x.q, x.u, CASE WHEN lag(x.q) OVER o = r.p THEN r.rank ELSE b.t END AS v
   FROM runs r JOIN words x ON x.w = r.w AND x.p = r.q LEFT JOIN words b ON b.w = r.w AND b.q = r.p
   WHERE k % 2 = 0 WINDOW o AS (PARTITION BY r.w ORDER BY r.p)),
  checked AS (
   SELECT h.*, coalesce(sum(CASE WHEN l.rank < h.rank OR m.rank < h.rank THEN 1 ELSE 0 END)
    OVER (PARTITION BY h.w ORDER BY h.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
   FROM apart h LEFT JOIN merges l ON l.a = h.v AND l.b = h.rank LEFT JOIN merges m ON m.a = h.rank AND m.b = h.u),
  hit AS (SELECT * FROM checked WHERE before = 0),
  kept AS (
   SELECT s.w, s.p, coalesce(h.rank, s.t) AS t, coalesce(h.q, s.q) AS q, coalesce(h.u, s.u) AS u
   FROM words s JOIN lowest l ON l.w = s.w LEFT JOIN hit h ON h.w = s.w AND h.p = s.p
   WHERE NOT EXISTS (FROM hit g WHERE g.w = s.w AND g.gone = s.p))
 SELECT k.w, k.p, k.t, k.q, coalesce(n.rank, k.u) AS u FROM kept k LEFT JOIN hit n ON n.w = k.w AND n.p = k.q
"""
_DECODE = """
 SELECT d, unhex(string_agg(hex, '' ORDER BY p)) AS bytes, count(hex) AS n FROM ids LEFT JOIN tokens USING (id) GROUP BY d
"""


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class ByteBpe:
    """A worker's vocabulary, DuckDB connection and cache of words."""

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks_of(path)
        self.longest = max(map(len, self.ranks))
        found = regex.compile(pattern)
        self.find = found.findall if not found.groups else lambda text: [m[0] for m in found.finditer(text)]
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        cuts = ((self.ranks.get(t[:i]), self.ranks.get(t[i:]), r) for t, r in self.ranks.items() for i in range(1, len(t)))
        a, b, rank = np.array([c for c in cuts if c[0] is not None and c[1] is not None], np.int32).reshape(-1, 3).T
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "768MB"})
        self._table("merges", a=a, b=b, rank=rank)
        self._table("tokens", id=np.array(list(self.ranks.values()), np.int32), hex=[t.hex() for t in self.ranks])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _table(self, name: str, **columns) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS FROM given")
        self.con.unregister("given")

    # -- words -----------------------------------------------------------------

    def _segments(self, word: bytes) -> list[bytes]:
        """The word, cut between bytes that no token in it spans."""
        if len(word) <= SEGMENT:
            return [word]
        out, start, reach = [], 0, 1
        for i in range(len(word)):
            if i >= reach:
                out.append(word[start:i])
                start, reach = i, i + 1
            for end in range(min(len(word), i + self.longest), reach, -1):
                if word[i:end] in self.ranks:
                    reach = end
                    break
        return [*out, word[start:]]

    def _seed(self, segments: list[bytes]) -> tuple[np.ndarray, ...]:
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        ends = np.cumsum(sizes)
        w = np.repeat(np.arange(len(segments), dtype=np.int32), sizes)
        p = (np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int32)
        t = self.byte_ids[np.frombuffer(b"".join(segments), np.uint8)]
        u = np.append(t[1:], np.int32(-1))
        u[ends - 1] = -1
        return w, p, t, p + 1, u

    def _contract(self, segments: list[bytes]) -> list[np.ndarray]:
        """The ids of every segment."""
        w, p, t, q, u = self._seed(segments)
        if len(segments[0]) <= SEGMENT:
            self._table("seed", w=w, p=p, t=t, q=q, u=u)
            found = self.con.sql(_ENCODE).to_arrow_table()
        else:
            self._table("words", w=w, p=p, t=t, q=q, u=u)
            self.con.execute("CREATE OR REPLACE TABLE done AS FROM words LIMIT 0")
            while self.con.execute("SELECT count(*) FROM words").fetchall()[0][0]:
                self.con.execute(_ROUND)
                self.con.execute("INSERT INTO done FROM words ANTI JOIN after USING (w)")
                self.con.execute("CREATE OR REPLACE TABLE words AS FROM after")
            found = self.con.sql("SELECT w, t FROM done ORDER BY w, p").to_arrow_table()
        sizes = np.bincount(found["w"].to_numpy(), minlength=len(segments))
        return np.split(found["t"].to_numpy(), np.cumsum(sizes)[:-1])

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words, as bytes of 32-bit integers."""
        learned: dict[str, bytes] = {}
        cut: dict[str, list[bytes]] = {}
        for word in words:
            whole = word.encode()
            if (rank := self.ranks.get(whole)) is not None:
                learned[word] = np.int32(rank).tobytes()
            else:
                cut[word] = self._segments(whole)
        todo = list(dict.fromkeys(chain.from_iterable(cut.values())))
        ids: dict[bytes, bytes] = {}
        for group in ([s for s in todo if len(s) <= SEGMENT], [s for s in todo if len(s) > SEGMENT]):
            sizes = np.cumsum([len(s) for s in group])
            at = 0
            while at < len(group):
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + QUERY_BYTES, "right")))
                found = self._contract(group[at:upto])
                ids.update(zip(group[at:upto], (x.astype(np.int32).tobytes() for x in found), strict=True))
                at = upto
        learned.update((word, b"".join(map(ids.__getitem__, parts))) for word, parts in cut.items())
        return learned

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, from the cache where it has them."""
        found = [self.young.get(x) or self.old.get(x) for x in words]
        learned = self._learn([w for w, x in zip(words, found, strict=True) if x is None])
        found = [learned[w] if x is None else x for w, x in zip(words, found, strict=True)]
        for word, x in zip(words, found, strict=True):
            if len(x) <= 4 * CACHE_WORD and len(word) <= CACHE_WORD and word not in self.young:
                if self.held > CACHE_BYTES // 2:
                    self.old, self.young, self.held = self.young, {}, 0
                self.young[word] = x
                self.held += 200 + 4 * len(word) + len(x)
        return found

    # -- texts -----------------------------------------------------------------

    def encode(self, block: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and each text's number of ids."""
        words = [self.find(text) for text in block]
        coded = pa.array(list(chain.from_iterable(words)), pa.string()).dictionary_encode()
        values = self._ids(coded.dictionary.to_pylist())
        starts = np.concatenate([[0], np.cumsum([len(v) // 4 for v in values])]).astype(np.int64)
        flat = pa.array(np.frombuffer(b"".join(values), np.int32))
        taken = pa.LargeListArray.from_arrays(pa.array(starts), flat).take(coded.indices)
        upto = np.concatenate([[0], np.cumsum(taken.value_lengths().to_numpy())]).astype(np.int64)
        ends = upto[np.cumsum([len(x) for x in words], dtype=np.int64)]
        return taken.flatten().to_numpy(), np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of every text, from all ids and each text's number of them."""
        out = [[] for _ in counts]
        text = np.repeat(np.arange(len(counts)), counts)
        for at in range(0, len(ids), QUERY_IDS):
            part = ids[at: at + QUERY_IDS]
            self.con.register("ids", pa.table({"d": text[at: at + QUERY_IDS], "p": np.arange(len(part)), "id": part}))
            found = self.con.sql(_DECODE).to_arrow_table()
            if sum(found["n"].to_pylist()) != len(part):
                raise ValueError("an id is not in the vocabulary")
            for d, x in zip(found["d"].to_pylist(), found["bytes"].to_pylist(), strict=True):
                out[d].append(x)
            self.con.unregister("ids")
        return list(map(b"".join, out))


def _worker(path: str, pattern: str) -> ByteBpe:
    return held(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))


def _checked(path: str) -> str:
    if not Path(path).is_file():
        raise FileNotFoundError(f"vocabulary file {path}")
    return path


def encode(docs: DataFrame, vocabulary: str, pattern: str, with_bytes: bool = False) -> DataFrame:
    """``doc_id, ids`` of every whole text; ``with_bytes`` decodes them again in
    the same pass (column ``bytes``)."""
    path = _checked(vocabulary)

    def run(batches):
        bpe = _worker(path, pattern)
        for batch in batches:
            for at, block in blocks(batch.column("text")):
                ids, counts = bpe.encode(block.to_pylist())
                columns = {"doc_id": batch.column("doc_id").slice(at, len(block)), "ids": _lists(ids, counts)}
                if with_bytes:
                    columns["bytes"] = pa.array(bpe.decode(ids, counts), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>" + ", bytes binary" * with_bytes)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, bytes`` of every list of ids (null: empty)."""
    path = _checked(vocabulary)
    ship(encoded.sparkSession)

    def run(batches):
        bpe = _worker(path, "")
        for batch in batches:
            lists = batch.column("ids")
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            found = bpe.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "bytes": pa.array(found, pa.binary())})

    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>")).alias("ids")
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), ids).mapInArrow(run, "doc_id long, bytes binary")


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text."""
    return encode(docs, vocabulary, pattern, with_bytes=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
