"""Elias-Fano sequences and the two-level n-gram trie built on them.

Every part is a flat little-endian buffer, so a level is read in place from a
file mapping or from an Arrow buffer.
"""

from __future__ import annotations

import numpy as np

#: Step of the quantised log10 probabilities; code 0 is kept for 'not there'.
STEP = 0.04


class EliasFano:
    """A non-decreasing sequence below ``universe``: low bits packed, high
    parts as a unary bit vector."""

    def __init__(self, n: int, shift: int, low: np.ndarray, high: np.ndarray):
        self.n, self.shift, self.low, self.high = n, shift, low, high
        bits = np.unpackbits(high, bitorder="little")
        self.ones, self.zeros = np.flatnonzero(bits)[:n], np.flatnonzero(bits == 0)

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = values.size
        shift = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        upper = (values >> np.uint64(shift)).astype(np.int64)
        size = n + (max(universe, 1) >> shift) + 2
        bits = np.zeros(-(-size // 8) * 8, np.uint8)
        bits[upper + np.arange(n)] = 1
        return cls(n, shift, _pack(values & np.uint64((1 << shift) - 1), shift), np.packbits(bits, bitorder="little"))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.shift, self.low.size, self.high.size], np.int64)
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_buffer(cls, raw: bytes | memoryview) -> EliasFano:
        n, shift, low, high = np.frombuffer(raw, np.int64, 4).tolist()
        return cls(n, shift, np.frombuffer(raw, np.uint64, low, 32), np.frombuffer(raw, np.uint8, high, 32 + 8 * low))

    def get(self, i: np.ndarray) -> np.ndarray:
        upper = (self.ones[i] - i).astype(np.uint64)
        return (upper << np.uint64(self.shift)) | _unpack(self.low, self.shift, i)

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each value among the places [first, end), or -1: the first
        place not less than it, sought inside the bucket of its high part."""
        values = values.astype(np.uint64)
        bucket = np.minimum((values >> np.uint64(self.shift)).astype(np.int64), self.zeros.size - 1)
        begin = np.where(bucket > 0, self.zeros[np.maximum(bucket - 1, 0)] - np.maximum(bucket - 1, 0), 0)
        lo = np.maximum(begin, first)
        hi = np.minimum(self.zeros[bucket] - bucket, self.n if end is None else end)
        stop = hi.copy()
        while (busy := np.flatnonzero(lo < hi)).size:
            mid = (lo[busy] + hi[busy]) // 2
            less = self.get(mid) < values[busy]
            lo[busy] = np.where(less, mid + 1, lo[busy])
            hi[busy] = np.where(less, hi[busy], mid)
        found = np.full(values.size, -1, np.int64)
        inside = np.flatnonzero(lo < stop)
        inside = inside[self.get(lo[inside]) == values[inside]]
        found[inside] = lo[inside]
        return found


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits, end to end in 64-bit words."""
    out = np.zeros(values.size * width // 64 + 2, np.uint64)
    if width:
        at = np.arange(values.size, dtype=np.int64) * width
        word, bit = at // 64, (at % 64).astype(np.uint64)
        np.bitwise_or.at(out, word, values << bit)
        over = np.flatnonzero(bit.astype(np.int64) + width > 64)
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - bit[over]))
    return out


def _unpack(words: np.ndarray, width: int, i: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(i.size, np.uint64)
    at = i * width
    word, bit = at // 64, (at % 64).astype(np.uint64)
    rest = np.where(bit > 0, words[word + 1] << (np.uint64(64) - np.maximum(bit, np.uint64(1))), np.uint64(0))
    return ((words[word] >> bit) | rest) & np.uint64((1 << width) - 1)


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes 1 to 255 of probabilities; 0 for none."""
    with np.errstate(divide="ignore"):
        code = 255 + np.rint(np.log10(p) / STEP)
    return np.where(p > 0, np.clip(code, 1, 255), 0).astype(np.uint8)


#: The probability that a code stands for.
DECODED = np.append(0.0, 10.0 ** ((np.arange(1, 256) - 255) * STEP))


class Trie:
    """Contexts, monotone pointers to their successors, the successors as
    ranks made monotone by their context's number, and a code for each."""

    _LEVELS = ("contexts", "words", "pointers", "successors")

    def __init__(self, levels: dict[str, EliasFano], codes: np.ndarray):
        self.levels, self.codes = levels, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, p: np.ndarray, universe: int) -> Trie:
        """From pairs sorted by (context, word), without repeats."""
        contexts, first = np.unique(context, return_index=True)
        words, rank = np.unique(word, return_inverse=True)
        number = np.repeat(np.arange(contexts.size), np.diff(np.append(first, context.size)))
        levels = {
            "contexts": EliasFano.build(contexts, universe), "words": EliasFano.build(words, universe),
            "pointers": EliasFano.build(np.append(first, context.size), context.size + 1),
            "successors": EliasFano.build(number * max(words.size, 1) + rank, max(contexts.size * words.size, 1)),
        }
        return cls(levels, quantise(p))

    def to_bytes(self) -> dict[str, bytes]:
        return {k: v.to_bytes() for k, v in self.levels.items()} | {"codes": self.codes.tobytes()}

    @classmethod
    def from_buffers(cls, raw: dict[str, bytes]) -> Trie:
        return cls({k: EliasFano.from_buffer(raw[k]) for k in cls._LEVELS}, np.frombuffer(raw["codes"], np.uint8))

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of every (context, word); 0 if the trie lacks it."""
        level, codes = self.levels, np.zeros(context.size, np.uint8)
        row, rank = level["contexts"].find(context), level["words"].find(word)
        there = np.flatnonzero((row >= 0) & (rank >= 0))
        row, rank = row[there], rank[there]
        first, end = level["pointers"].get(row).astype(np.int64), level["pointers"].get(row + 1).astype(np.int64)
        at = level["successors"].find(row * level["words"].n + rank, first, end)
        codes[there[at >= 0]] = self.codes[at[at >= 0]]
        return codes
