"""Operator 2: packing documents into windows by non-negative least squares on a length histogram.

Documents are tokenised once and cut where they stand: whole windows first, then one piece of a
multiple of UNIT tokens, then a tail below UNIT. The histogram of the middle pieces, at most
WINDOW / UNIT numbers, is tiled by length combinations of few parts that fill a window exactly:
non-negative least squares finds how often to repeat each, the counts are rounded down to what is
there, middle pieces left over are laid end to end and cut at window borders, and tails are packed
greedily from their histogram, largest first, into what is left of the last window and new ones.

Only histograms reach the driver. A piece finds its window from its rank among the pieces of its
length, which are counted in hashed buckets, so a length that a third of all rows share is split.
Checksums of the pieces come from the one pass that tokenises; those of a piece cut later are
joined from checksums of its units.

Cases: a null or empty text is the end token alone; texts of any length are read whole; rows alike
in every column are documents of their own; other columns are not read; no rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 4096
UNIT = 128
END = 2
PARTS = 8
#: A Python worker keeps the ids of up to 2**SLOT_BITS words, of at most WIDTH ids each.
SLOT_BITS, WIDTH = 21, 8


class WordIds:
    """Token ids of texts, word by word: the tokenizer never joins what white space parts.

    Words met lately are kept in a table of fixed size, one a slot, the newer in place of the older;
    words of more than WIDTH ids are coded anew each time.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.sizes = np.zeros(1 << SLOT_BITS, np.uint8)
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.kept = np.zeros(WIDTH << SLOT_BITS, np.uint16 if small else np.uint32)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and the rows' offsets among them."""
        start, end, hashes, rows = common.words(data, offsets)
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        hit = self.keys[slot] == hashes
        sizes, from_ = self.sizes[slot].astype(np.int64), slot * WIDTH
        own = np.zeros(0, np.uint32)
        if not hit.all():
            miss = np.flatnonzero(~hit)
            _, first, which = np.unique(hashes[miss], return_index=True, return_inverse=True)
            raw = data.tobytes()
            coded = [e.ids for e in self.tokenizer.encode_batch_fast([raw[start[j] : end[j]].decode("utf-8", "replace") for j in miss[first]], add_special_tokens=False)]
            own_sizes = np.array([len(c) for c in coded], np.int64)
            own = np.fromiter(chain.from_iterable(coded), np.uint32, int(own_sizes.sum()))
            own_from = np.cumsum(own_sizes) - own_sizes
            sizes[miss], from_[miss] = own_sizes[which], own_from[which]
            short = np.flatnonzero(own_sizes <= WIDTH)
            to, one = np.unique(slot[miss[first[short]]], return_index=True)
            new = short[one]
            self.keys[to], self.sizes[to] = hashes[miss[first[new]]], own_sizes[new]
            at = np.repeat(to * WIDTH, own_sizes[new]) + _steps(own_sizes[new])
            self.kept[at] = own[np.repeat(own_from[new], own_sizes[new]) + _steps(own_sizes[new])]
        index, found = np.repeat(from_, sizes) + _steps(sizes), np.repeat(hit, sizes)
        ids = np.empty(len(index), np.uint32)
        ids[~found] = own[index[~found]]
        # a slot hit above may have been given to a newer word since: those hits are read from the old owner's words below
        lost = hit & (self.keys[slot] != hashes)
        if lost.any():
            gone = np.flatnonzero(lost)
            _, first, which = np.unique(hashes[gone], return_index=True, return_inverse=True)
            raw = data.tobytes()
            coded = [e.ids for e in self.tokenizer.encode_batch_fast([raw[start[j] : end[j]].decode("utf-8", "replace") for j in gone[first]], add_special_tokens=False)]
            flat = np.array([i for w in which for i in coded[w]], np.uint32)
            again = np.repeat(lost, sizes)
            ids[again] = flat
            found &= ~again
        ids[found] = self.kept[index[found]]
        return ids, np.concatenate([[0], np.cumsum(sizes)])[rows]


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - sizes, sizes)


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# -- cutting ---------------------------------------------------------------------------------

PIECE = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("_x_units", T.BinaryType()),
    T.StructField("_x_ids", T.BinaryType()),
]


def cut(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents before they are packed."""
    path = tokenizer or default_tokenizer()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        for batch in batches:
            for first, _, data, offsets in common.slices(batch.column(1)):
                ids, at = coder.ids(data, offsets)
                row, out = [], [[], [], [], [], [], []]
                for i in range(len(at) - 1):
                    doc = np.append(ids[at[i] : at[i + 1]], np.uint32(END)).astype("<u4")
                    raw, n = doc.tobytes(), len(doc)
                    windows, rest = divmod(n, WINDOW)
                    middle = rest // UNIT * UNIT
                    for begin, length in [*((w * WINDOW, WINDOW) for w in range(windows)), (windows * WINDOW, middle), (windows * WINDOW + middle, rest - middle)]:
                        if not length:
                            continue
                        part = raw[4 * begin : 4 * (begin + length)]
                        units = b""
                        if UNIT <= length < WINDOW:
                            units = np.array([zlib.crc32(part[j : j + 4 * UNIT]) for j in range(0, len(part), 4 * UNIT)], "<u4").tobytes()
                        row.append(first + i)
                        for values, value in zip(out, (begin, length, zlib.crc32(part), n, units, part if with_ids else b""), strict=True):
                            values.append(value)
                if row:
                    kinds = [pa.int64()] * 4 + [pa.binary()] * 2
                    columns = [batch.column(0).take(pa.array(row))] + [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id"] + [f.name for f in PIECE])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *PIECE])
    return docs.select("doc_id", common.text_or_empty().alias("text")).mapInArrow(pieces, schema)


# -- planning --------------------------------------------------------------------------------


def combinations(total: int, parts: int) -> list[tuple[int, ...]]:
    """All ways to write total as a sum of 2 to parts positive numbers, in falling order."""
    found: list[tuple[int, ...]] = []

    def extend(left: int, most: int, so_far: tuple[int, ...]) -> None:
        if left == 0:
            found.append(so_far)
        elif len(so_far) < parts:
            for part in range(min(left, most), 0, -1):
                if part * (parts - len(so_far)) >= left:
                    extend(left - part, part, (*so_far, part))

    extend(total, total - 1, ())
    return found


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, most: int = 1000) -> np.ndarray:
    """x >= 0 that makes |a x - b| least, by active sets (Lawson and Hanson 1974)."""
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    limit = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(most):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= limit:
            break
        passive[best] = True
        while True:
            trial = np.zeros_like(x)
            trial[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            low = passive & (trial <= 1e-12)
            if not low.any():
                x = trial
                break
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + step * (trial - x)
            passive &= x > 1e-12
            x[~passive] = 0
            if not passive.any():
                break
    return x


def plan(histogram: dict[int, int], window: int = WINDOW, unit: int = UNIT, parts: int = PARTS) -> tuple[dict[int, np.ndarray], dict[int, tuple[int, int]], int]:
    """Where the pieces of each length go.

    Returns, for each length, rows (first rank, slots a window, windows, offset of the first slot,
    first window); for each length laid end to end, its first rank and place in the run; and the
    window where that run begins. Its size depends on the number of lengths, not of pieces.
    """
    left = {k: v for k, v in histogram.items() if v > 0}
    rows: dict[int, list[tuple[int, int, int, int, int]]] = {k: [] for k in left}
    ranks = dict.fromkeys(left, 0)
    windows = 0

    def repeat(pattern: list[tuple[int, int]], times: int, begin: int = 0) -> None:
        nonlocal windows
        at = begin
        for length, slots in pattern:
            rows[length].append((ranks[length], slots, times, at, windows))
            ranks[length] += slots * times
            left[length] -= slots * times
            at += slots * length
        windows += times

    if left.get(window):
        repeat([(window, 1)], left[window])
    middle = sorted((k for k in left if unit <= k < window), reverse=True)
    if middle:
        shapes = [s for s in combinations(window // unit, parts) if all(p * unit in left for p in s)]
        if shapes:
            a = np.zeros((len(middle), len(shapes)))
            place = {k: i for i, k in enumerate(middle)}
            for j, shape in enumerate(shapes):
                for p in shape:
                    a[place[p * unit], j] += 1
            counts = np.array([left[k] for k in middle], float)
            scale = 1 / np.sqrt(np.maximum(counts, 1))
            x = non_negative_least_squares(a * scale[:, None], counts * scale)
            for j in np.argsort(-x, kind="stable"):
                pattern = [(middle[i], int(a[i, j])) for i in np.flatnonzero(a[:, j])]
                times = min([int(x[j] + 1e-6), *(left[k] // n for k, n in pattern)])
                if times > 0:
                    repeat(pattern, times)
    run, at, run_window = {}, 0, windows
    for k in middle:
        if left[k]:
            run[k] = (ranks[k], at)
            at += left[k] * k
            left[k] = 0
    windows += -(-at // window)
    tails = sorted((k for k in left if k < unit), reverse=True)
    space, begin = (-at) % window, at % window
    if begin:
        windows -= 1
    else:
        space = window
    while any(left[k] for k in tails):
        pattern, room = [], space
        for k in tails:
            n = min(left[k], room // k)
            if n:
                pattern.append((k, n))
                room -= n * k
        if not pattern:  # the last window of the run has no room for any
            windows, space, begin = windows + 1, window, 0
            continue
        repeat(pattern, 1 if begin else min(left[k] // n for k, n in pattern), begin)
        space, begin = window, 0
    return {k: np.array(v, np.int64).reshape(-1, 5) for k, v in rows.items()}, run, run_window


# -- packing ---------------------------------------------------------------------------------


def _shift(crc: int, n_bytes: int) -> int:
    """The checksum of crc's text followed by n_bytes zeros, without the final inversions."""
    for _ in range(8 * n_bytes):
        crc = (crc >> 1) ^ (0xEDB88320 if crc & 1 else 0)
    return crc


@lru_cache(maxsize=2)
def _shift_tables(n_bytes: int) -> np.ndarray:
    bits = [_shift(1 << i, n_bytes) for i in range(32)]
    tables = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1:
                    tables[byte, value] ^= np.uint32(bits[8 * byte + bit])
    return tables


def join_crcs(units: np.ndarray, n_bytes: int = 4 * UNIT) -> int:
    """crc32 of texts of n_bytes each, one after the other, from their crc32 values."""
    tables, crc = _shift_tables(n_bytes), int(units[0])
    for unit in units[1:]:
        crc = int(tables[0, crc & 255] ^ tables[1, crc >> 8 & 255] ^ tables[2, crc >> 16 & 255] ^ tables[3, crc >> 24]) ^ int(unit)
    return crc


def pack(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ids as little-endian bytes if wanted."""
    pieces = common.stage(cut(docs, tokenizer, with_ids), "pieces")
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most WINDOW / UNIT + UNIT rows
    rows, run, run_window = plan({r["length"]: r["n"] for r in counted})
    order = ["doc_id", "start", "ids_crc32"]
    placed = common.ranked(pieces, "length", order, "_x_rank", per_bucket=100_000)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            start, length, crc, tokens, rank = (get(c) for c in ("start", "length", "ids_crc32", "doc_tokens", "_x_rank"))
            n = len(length)
            sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
            source, size, begin, crcs = np.arange(n), length.copy(), start.copy(), crc.copy()
            more: list[tuple[int, int, int, int, int, int]] = []
            for k in np.unique(length):
                here = np.flatnonzero(length == k)
                r, table = rank[here], rows[int(k)]
                if len(table):
                    which = np.searchsorted(table[:, 0], r, "right") - 1
                    first, slots, _, at, window = table[which].T
                    instance, slot = np.divmod(r - first, slots)
                    sequence[here], offset[here] = window + instance, at + slot * k
                if int(k) in run:
                    first, at = run[int(k)]
                    loose = here[r >= first]
                    to = at + (rank[loose] - first) * k
                    sequence[loose], offset[loose] = run_window + to // WINDOW, to % WINDOW
                    for i in loose[offset[loose] + k > WINDOW]:
                        units = np.frombuffer(batch.column("_x_units")[int(i)].as_py(), "<u4")
                        kept = int(WINDOW - offset[i])
                        size[i], crcs[i] = kept, join_crcs(units[: kept // UNIT])
                        more.append((i, start[i] + kept, k - kept, join_crcs(units[kept // UNIT :]), sequence[i] + 1, 0))
            if more:
                extra = np.array(more, np.int64)
                source, begin, size, crcs, sequence, offset = (np.concatenate([a, b]) for a, b in zip((source, begin, size, crcs, sequence, offset), extra.T, strict=True))
            columns = [batch.column("doc_id").take(pa.array(source))] + [pa.array(c) for c in (begin, size, crcs, tokens[source], sequence, offset)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                whole = batch.column("_x_ids")
                ids = [whole[int(s)].as_py()[4 * (b - start[s]) : 4 * (b - start[s] + z)] for s, b, z in zip(source, begin, size, strict=True)]
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [pieces.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    return placed.mapInArrow(place, T.StructType(fields))


def op2_nnls_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
