"""Whole-text encoding through a per-worker cache of words.

The tokenizer drops white space and never joins characters across it, so the
ids of a text are the ids of its chunks in order. A batch is cut into chunks
and deduplicated by Arrow; each worker encodes a distinct word once.
"""

from __future__ import annotations

import ctypes
import gc
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Bytes of words and ids that a worker keeps before it drops the rarer half, and the longest word it keeps.
CACHE_BYTES, CACHE_WORD = 88 << 20, 256
#: Text characters flattened at a time.
BLOCK_CHARS = 6 << 20
#: A word of letters that lower-case alike everywhere, then common marks: the
#: tokenizer always cuts between the two, so that one word serves every ending.
_LETTERS = "".join(chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7))
_MARKS = ".,!?;:|#*%&$"
_WORD_AND_MARKS = f"^[{_LETTERS}]+[{_MARKS}]*$"


def _take(starts: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given rows of a list of lists: flat values, and starts."""
    taken = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(flat)).take(pa.array(rows))
    return taken.flatten().to_numpy(), np.concatenate([[0], np.cumsum(taken.value_lengths().to_numpy())]).astype(np.int64)


class WordEncoder:
    """Ids of whole texts, as ``encode(text, add_special_tokens=False)`` gives."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        kind = np.uint32 if self.tokenizer.get_vocab_size() > 1 << 16 else np.uint16
        #: Row of each kept word; rows beyond those are a call's long words.
        self.known: dict[str, int] = {}
        self.held = 0
        self.flat, self.starts, self.used = np.empty(0, kind), np.zeros(1, np.int64), np.empty(0, np.int64)

    def _bytes(self, words: list[str], ids: int) -> int:
        return 180 * len(words) + sum(map(len, words)) + ids * self.flat.itemsize

    def _keep_frequent(self) -> None:
        """Keep the half of the cache that was looked up most."""
        kept = np.sort(np.argsort(-self.used, kind="stable")[: len(self.known) // 2])
        self.flat, self.starts = _take(self.starts, self.flat, kept)
        words = list(self.known)
        self.known = {words[i]: n for n, i in enumerate(kept.tolist())}
        self.used = self.used[kept] // 2
        self.held = self._bytes(list(self.known), len(self.flat))

    def _rows(self, words: pa.Array) -> np.ndarray:
        """The cache's row of every word of an array, learning new ones; long
        ones come last and are not kept."""
        coded = words.dictionary_encode()
        distinct, indices = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        rows = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        if (missing := np.flatnonzero(rows < 0)).size:
            long = np.fromiter((len(distinct[i]) > CACHE_WORD for i in missing.tolist()), bool, missing.size)
            missing = np.concatenate([missing[~long], missing[long]])
            new = [distinct[i] for i in missing.tolist()]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            rows[missing] = np.arange(len(self.known), len(self.known) + len(new))
            kept = len(new) - int(long.sum())
            self.known.update(zip(new[:kept], rows[missing[:kept]].tolist(), strict=True))
            self.held += self._bytes(new[:kept], int(sizes[:kept].sum()))
            ids = np.fromiter(chain.from_iterable(found), self.flat.dtype, int(sizes.sum()))
            self.flat, self.starts = np.concatenate([self.flat, ids]), np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
        self.used[rows] += np.bincount(indices, minlength=len(distinct))
        return rows[indices]

    def encode(self, texts: list[str] | pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids (16 bits wide where the vocabulary allows), one text after the
        other, and each text's number of ids; ``end`` is appended to every text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return np.empty(0, self.flat.dtype), np.empty(0, np.int64)
        if self.held > CACHE_BYTES:
            self._keep_frequent()
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        chunks = coded.dictionary
        plain = pc.and_(pc.match_substring_regex(chunks, _WORD_AND_MARKS), pc.less_equal(pc.binary_length(chunks), CACHE_WORD))
        word = pc.if_else(plain, pc.utf8_lower(pc.utf8_rtrim(chunks, _MARKS)), chunks)
        mark = pc.if_else(plain, pc.utf8_ltrim(chunks, _LETTERS), "")
        marks = self._rows(mark)  # never long
        both = np.stack([self._rows(word), marks], 1).reshape(-1)
        ids, ends = _take(self.starts, self.flat, both)
        if len(self.used) > (n := len(self.known)):
            self.flat, self.starts, self.used = self.flat[: self.starts[n]].copy(), self.starts[: n + 1].copy(), self.used[:n].copy()
        ids, ends = _take(ends[::2], ids, coded.indices.to_numpy())
        upto = ends[np.cumsum(cut.value_lengths().to_numpy())]
        lengths = np.diff(upto, prepend=0)
        if end is not None:
            ids, lengths = np.insert(ids, upto, end), lengths + 1
        return ids, lengths


def blocks(texts: pa.Array, size: int = BLOCK_CHARS):
    """Slices of a text column of about ``size`` bytes each (a longer text is
    a slice of its own), with the row each starts at."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(sizes, before + size, "right")))
        yield at, texts.slice(at, upto - at)
        at = upto


def release() -> None:
    """Give freed memory back to the system: a worker idles beside the
    executor's other stages, and its allocators would keep what a task took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def released(run):
    """``run`` (batches to batches) with its memory given back when it ends."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


_HELD: dict = {}


def held(key, make):
    """The one cache that this worker keeps: a worker is used by operator after
    operator, and what the one before held is let go."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            gc.collect()
            release()
        _HELD[key] = make()
    return _HELD[key]


def word_encoder(path: str) -> WordEncoder:
    """This worker's encoder for a vocabulary file."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"tokenizer file {path}")
    return held(("words", path), lambda: WordEncoder(path))
