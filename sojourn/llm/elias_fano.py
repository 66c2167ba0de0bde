"""Elias-Fano coded sequences and a two-level n-gram trie in one memory-mapped block."""

from __future__ import annotations

import json
import mmap
import tempfile

import numpy as np

_ONE = np.uint64(1)


def _count_ones(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).astype(np.int64)


class Sequence:
    """Rising numbers below 2**63 in about 2 + log2(universe / n) bits each.

    The low bits of each number are packed; the high parts stand in unary in a bit vector whose
    ones are counted per word, so that select and search need no other index.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, before: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.before = n, low_bits, low, high, before
        self.zeros_before = 64 * np.arange(len(before), dtype=np.int64) - before

    @staticmethod
    def encode(values: np.ndarray) -> dict[str, np.ndarray]:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        # two spare zeros so that the end of every bucket can be selected
        words = np.zeros((int(high[-1]) + 2) // 64 + 1 if n else 1, np.uint64)
        np.bitwise_or.at(words, high >> 6, _ONE << (high & 63).astype(np.uint64))
        before = np.concatenate([[0], np.cumsum(_count_ones(words))])
        packed = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if low_bits:
            low = values & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.int64) * low_bits
            shift = (at & 63).astype(np.uint64)
            np.bitwise_or.at(packed, at >> 6, low << shift)
            over = (at & 63) + low_bits > 64
            np.bitwise_or.at(packed, (at[over] >> 6) + 1, low[over] >> (np.uint64(64) - shift[over]))
        return {"shape": np.array([n, low_bits], np.int64), "low": packed, "high": words, "before": before.astype(np.int64)}

    @classmethod
    def of(cls, parts: dict[str, np.ndarray]) -> Sequence:
        n, low_bits = (int(x) for x in parts["shape"])
        return cls(n, low_bits, parts["low"], parts["high"], parts["before"])

    def low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = (at & 63) + self.low_bits > 64
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def _within(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the one with this rank in each word."""
        place = np.zeros(len(words), np.int64)
        rank = rank.copy()
        for step in (32, 16, 8, 4, 2, 1):
            part = (words >> place.astype(np.uint64)) & np.uint64((1 << step) - 1)
            ones = _count_ones(part)
            skip = rank >= ones
            rank[skip] -= ones[skip]
            place[skip] += step
        return place

    def select1(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, k, "right") - 1
        return 64 * word + self._within(self.high[word], k - self.before[word])

    def select0(self, k: np.ndarray) -> np.ndarray:
        word = np.minimum(np.searchsorted(self.zeros_before, k, "right") - 1, len(self.high) - 1)
        return 64 * word + self._within(~self.high[word], k - self.zeros_before[word])

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.select1(i) - i).astype(np.uint64) << np.uint64(self.low_bits)) | self.low_at(i)

    def successor(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of each range [first, last), the place of its least number not below the value, or last."""
        values = np.asarray(values, np.uint64)
        part = (values >> np.uint64(self.low_bits)).astype(np.int64)
        known = part <= len(self.high) * 64 - self.n - 2  # higher parts lie beyond all numbers
        part = np.where(known, part, 0)
        begin = np.where(part > 0, self.select0(np.maximum(part - 1, 0)) - part + 1, 0)
        end = self.select0(part) - part
        begin, end = np.where(known, begin, self.n), np.where(known, end, self.n)
        lo, hi = np.clip(begin, first, last), np.clip(end, first, last)
        target = values & np.uint64((1 << self.low_bits) - 1)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            middle = (lo[open_] + hi[open_]) >> 1
            less = self.low_at(middle) < target[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]

    def find(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The place of each value in its range, -1 if it is not there."""
        at = self.successor(values, first, last)
        inside = at < last
        hit = np.zeros(len(at), bool)
        hit[inside] = self.get(at[inside]) == np.asarray(values, np.uint64)[inside]
        return np.where(hit, at, -1)


def quantise(values: np.ndarray, bits: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Codes, and the mean of the values under each code; codes part the sorted values evenly."""
    if not len(values):
        return np.zeros(0, np.uint16), np.zeros(1)
    edges = np.unique(np.quantile(values, np.linspace(0, 1, (1 << bits) + 1)[1:-1], method="nearest"))
    codes = np.searchsorted(edges, values, "left")
    sums, counts = np.bincount(codes, values, len(edges) + 1), np.bincount(codes, minlength=len(edges) + 1)
    return codes.astype(np.uint16), sums / np.maximum(counts, 1)


class Trie:
    """Tokens, the contexts met before each, and a quantised value for each of these bigrams.

    Level one holds the tokens' 63-bit keys and running counts; a rising pointer sequence gives each
    token's range in level two, which holds context numbers, each raised by its range so that the
    whole level rises. Context numbers are places in the shard's own sequence of context keys.
    """

    LEVELS = ("tokens", "counts", "pointers", "keys", "contexts")

    @classmethod
    def build(cls, token: np.ndarray, context: np.ndarray, value: np.ndarray, counts: np.ndarray) -> bytes:
        """token, context: 63-bit keys of bigrams sorted by both, without repeats; counts: of each distinct token."""
        tokens, first = np.unique(token, return_index=True)
        keys, number = np.unique(context, return_inverse=True)
        pointers = np.concatenate([first, [len(token)]])
        range_ = np.repeat(np.arange(len(tokens)), np.diff(pointers))
        codes, book = quantise(value)
        levels = {
            "tokens": Sequence.encode(tokens),
            "counts": Sequence.encode(np.concatenate([[0], np.cumsum(counts)])),
            "pointers": Sequence.encode(pointers),
            "keys": Sequence.encode(keys),
            "contexts": Sequence.encode(number + range_ * len(keys)),
        }
        arrays = {f"{k}.{part}": v for k, parts in levels.items() for part, v in parts.items()} | {"codes": codes, "book": book}
        head, body, at = {}, [], 0
        for name, array in arrays.items():
            raw = array.tobytes() + bytes(-array.nbytes % 8)
            head[name] = (array.dtype.str, len(array), at)
            body.append(raw)
            at += len(raw)
        top = json.dumps(head).encode()
        top += b" " * (-len(top) % 8)
        return len(top).to_bytes(8, "little") + top + b"".join(body)

    def __init__(self, raw: bytes) -> None:
        """Maps the block from an unnamed file of the task's own temporary folder."""
        with tempfile.TemporaryFile() as file:
            file.write(raw)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(self.map[:8], "little")
        head = json.loads(self.map[8 : 8 + size])
        arrays = {name: np.frombuffer(self.map, kind, n, 8 + size + at) for name, (kind, n, at) in head.items()}
        level = lambda k: Sequence.of({p: arrays[f"{k}.{p}"] for p in ("shape", "low", "high", "before")})
        self.tokens, self.counts, self.pointers, self.keys, self.contexts = (level(k) for k in self.LEVELS)
        self.codes, self.book = arrays["codes"], arrays["book"]

    def token_places(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token, -1 if unknown, and its count."""
        zero = np.zeros(len(token), np.int64)
        at = self.tokens.find(token, zero, zero + self.tokens.n)
        safe = np.maximum(at, 0)
        if not self.tokens.n:
            return at, zero
        count = (self.counts.get(safe + 1) - self.counts.get(safe)).astype(np.int64)
        return at, np.where(at >= 0, count, 0)

    def values(self, place: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Value of each bigram of a token by place and a context by key, 0 where there is none."""
        out = np.zeros(len(place))
        zero = np.zeros(len(context), np.int64)
        number = self.keys.find(context, zero, zero + self.keys.n)
        both = np.flatnonzero((place >= 0) & (number >= 0))
        if len(both):
            p = place[both]
            first, last = self.pointers.get(p).astype(np.int64), self.pointers.get(p + 1).astype(np.int64)
            at = self.contexts.find((number[both] + p * self.keys.n).astype(np.uint64), first, last)
            hit = at >= 0
            out[both[hit]] = self.book[self.codes[at[hit]]]
        return out
