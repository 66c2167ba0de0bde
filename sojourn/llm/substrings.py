"""Operator 9: substring deduplication by prefix-partitioned suffix trees over words.

A window of WINDOW words that also starts elsewhere is removed wherever it stands. Every window has
an anchor: the least hashed gram of ANCHOR words in it, so equal windows have equal anchors at equal
offsets. The suffixes that begin at anchors are split into groups by their first ANCHOR words, and
suffixes whose prefix nobody else has are dropped. Groups are gathered into bins of bounded size;
in each bin the suffixes are sorted and their common prefixes give the nodes of the suffix trees.
For every offset an anchor may have in a window, suffixes under one node of depth WINDOW - offset
that also agree on the offset words before them are occurrences of one repeat.

A prefix with more than HEAVY suffixes does not go to a bin: its prefix is lengthened to the whole
window, whose occurrences are counted map-side first, so no task holds a large group.

Equal texts are one text with a count; if it is two or more, all its windows are repeats.

Cases: a null text is empty; texts below WINDOW words lose nothing; rows alike in every column are
documents of their own; overlapping repeats within one text count; other columns are kept by
dedup_substrings, which sets text (and n_chars where there is one) of changed rows only; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 35
ANCHOR = 12
OFFSETS = WINDOW - ANCHOR + 1
#: Suffixes of one prefix that a bin takes, some twenty MB.
HEAVY = 50_000
PER_BIN = 20_000


def anchored(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and row offsets; grams; and of each anchor its place, its first and its last window."""
    _, _, hashes, rows = common.words(data, offsets)
    grams = common.grams(hashes, ANCHOR)
    sizes = np.maximum(np.diff(rows) - WINDOW + 1, 0)
    if not sizes.sum():
        none = np.zeros(0, np.int64)
        return hashes, rows, grams, none, none, none
    starts = np.repeat(rows[:-1] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    least = np.lib.stride_tricks.sliding_window_view(grams, OFFSETS).argmin(1)
    place = starts + least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return hashes, rows, grams, place[first], starts[first], starts[last]


def _distinct(docs: DataFrame) -> DataFrame:
    """key, n, text: each text once, in a table bucketed by key, so that later joins on key leave it where it is."""
    spark = docs.sparkSession
    text = common.text_or_empty()
    keyed = docs.select(F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))
    once = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"sojourn_texts_{uuid.uuid4().hex}"
    once.write.bucketBy(buckets, "key").option("path", common.stage_path(spark, "texts")).saveAsTable(name)
    common.forget_later(spark, name)
    return spark.table(name)


def _anchors(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in common.slices(batch.column(1)):
                _, rows, grams, place, _, _ = anchored(data, offsets)
                row = np.searchsorted(rows, place, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[place].view(np.int64)), batch.column(0).take(pa.array(first + row)), pa.array((place - rows[row]).astype(np.int32))],
                    names=["prefix", "key", "place"],
                )

    return texts.select("key", "text").mapInArrow(run, "prefix long, key binary, place int")


def _suffixes(texts: DataFrame, wanted: DataFrame, heavy: bool) -> DataFrame:
    """The suffixes at the wanted anchors with the words of their windows; or, if heavy, one row per window."""
    places = wanted.groupBy("key").agg(F.collect_list("place").alias("places")).toDF("text_key", "places")  # at most a text's anchors
    found = texts.join(places, F.col("key") == F.col("text_key")).select("key", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for first, last, data, offsets in common.slices(batch.column(1)):
                hashes, rows, grams, place, begin, end = anchored(data, offsets)
                part = lists.slice(first, last - first)
                listed = part.flatten().to_numpy(zero_copy_only=False) + np.repeat(rows[:-1], part.value_lengths().to_numpy(zero_copy_only=False))
                use = np.isin(place, listed)
                place, begin, end = place[use], begin[use], end[use]
                row = np.searchsorted(rows, place, "right") - 1
                if heavy:
                    sizes = end - begin + 1
                    start = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                    row = np.repeat(row, sizes)
                    columns = [pa.array(common.grams(hashes, WINDOW)[start].view(np.int64)), batch.column(0).take(pa.array(first + row)), pa.array((start - rows[row]).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["window", "key", "place"])
                    continue
                sizes = end + WINDOW - begin
                ends = np.cumsum(sizes)
                index = np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
                code = hashes[index]
                words = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], 8 * ends]).astype(np.int32).tobytes()), pa.py_buffer(code.tobytes())])
                columns = [pa.array(grams[place].view(np.int64)), batch.column(0).take(pa.array(first + row))]
                columns += [pa.array(x.astype(np.int32)) for x in (place - rows[row], place - end, place - begin)]
                yield pa.RecordBatch.from_arrays([*columns, words], names=["prefix", "key", "place", "least", "most", "words"])

    return found.mapInArrow(run, "window long, key binary, place int" if heavy else "prefix long, key binary, place int, least int, most int, words binary")


def repeated(least: np.ndarray, most: np.ndarray, words: list[bytes]) -> np.ndarray:
    """For each suffix and offset whether that window occurs at another suffix, too.

    words: the words of a suffix's windows, from most words before the suffix on.
    """
    n = len(least)
    sizes = np.array([len(w) // 8 for w in words], np.int64)
    flat = np.frombuffer(b"".join(words), np.uint64)
    begin = np.cumsum(sizes) - sizes
    after = np.zeros((n, WINDOW), np.uint64)
    for j in range(WINDOW):
        have = most + j < sizes
        after[have, j] = flat[(begin + most + j)[have]]
    order = np.argsort(np.ascontiguousarray(after.byteswap()).view(f"V{8 * WINDOW}").ravel(), kind="stable")
    ranked = after[order]
    alike = ranked[1:] == ranked[:-1]
    common_prefix = np.where(alike.all(1), WINDOW, alike.argmin(1))  # of neighbours: the depth of the node above both
    out = np.zeros((n, OFFSETS), bool)
    before = np.zeros(n, np.uint64)
    for offset in range(OFFSETS):
        if offset:
            have = most >= offset
            word = np.zeros(n, np.uint64)
            word[have] = flat[(begin + most - offset)[have]]
            before = common.mix(before * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(1))
        node = np.concatenate([[0], np.cumsum(common_prefix < WINDOW - offset)])
        has = (least[order] <= offset) & (offset <= most[order])
        who = order[has]
        if len(who) < 2:
            continue
        group = common.mix(node[has].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) ^ before[who])
        _, which, count = np.unique(group, return_inverse=True, return_counts=True)
        out[who, offset] = count[which] > 1
    return out


def _bin_repeats(table: pa.Table) -> pa.Table:
    """Runs of repeated windows in one bin: key, first and last window."""
    table = table.combine_chunks()
    place, least, most = (table[c].to_numpy() for c in ("place", "least", "most"))
    found = repeated(least, most, table["words"].to_pylist())
    # offset grows as the window's start falls
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1
    return pa.table({"key": table["key"].take(pa.array(row)), "first": pa.array((place[row] - high).astype(np.int32)), "last": pa.array((place[row] - low).astype(np.int32))})


def repeats(texts: DataFrame) -> DataFrame:
    """key, first, last: runs of windows of distinct texts that occur elsewhere in them, too."""
    spark = texts.sparkSession
    anchors = common.stage(_anchors(texts), "anchors")
    counts = anchors.groupBy(F.col("prefix").alias("shared")).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    counts = common.stage(counts, "shared-prefixes")  # written, so that a join splits a prefix that a third of all anchors have
    shared = common.stage(anchors.join(counts, F.col("prefix") == F.col("shared")).select("key", "place", (F.col("times") > HEAVY).alias("heavy")), "shared")
    common.discard(anchors, counts)
    total = shared.where("not heavy").count()
    light = _suffixes(texts, shared.where("not heavy"), False)
    bins = common.task_count(spark, total, PER_BIN)
    light = light.withColumn("bin", F.pmod(F.xxhash64("prefix"), F.lit(bins)).cast("int")).drop("prefix")
    runs = light.groupBy("bin").applyInArrow(_bin_repeats, "key binary, first int, last int")
    windows = common.stage(_suffixes(texts, shared.where("heavy"), True), "heavy-windows")
    twice = windows.groupBy(F.col("window").alias("twice")).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    twice = common.stage(twice, "repeated-windows")
    whole = windows.join(twice, F.col("window") == F.col("twice"), "left_semi").select("key", F.col("place").alias("first"), F.col("place").alias("last"))
    return runs.unionByName(whole)


def kept_words(text: bytes, first: np.ndarray, last: np.ndarray, everywhere: bool) -> tuple[list[bytes], int]:
    """Words that no repeated window covers, and the number of all words."""
    words = text.split()
    n = len(words)
    if everywhere and n >= WINDOW:
        return [], n
    if not len(first):
        return words, n
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, np.minimum(last + WINDOW, n), -1)
    keep = np.cumsum(cover[:n]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k], n


def _cleaned(docs: DataFrame, with_text: bool) -> DataFrame:
    """text_key, n_words, n_removed, kept_sha256 and, if wanted, the kept words as text, for each distinct text."""
    texts = _distinct(docs)
    spans = repeats(texts).groupBy(F.col("key").alias("span_key")).agg(F.collect_list(F.struct("first", "last")).alias("spans"))  # at most a text's windows
    joined = texts.join(spans, F.col("key") == F.col("span_key"), "left").select("key", "n", "text", F.col("spans.first").alias("first"), F.col("spans.last").alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            size, removed, digest, kept_text = [], [], [], []
            for i in range(batch.num_rows):
                first, last = batch.column(3)[i].values, batch.column(4)[i].values
                first, last = (none, none) if first is None else (first.to_numpy(), last.to_numpy())
                kept, n = kept_words(batch.column(2)[i].as_buffer().to_pybytes(), first, last, batch.column(1)[i].as_py() > 1)
                body = b" ".join(kept)
                size.append(n)
                removed.append(n - len(kept))
                digest.append(hashlib.sha256(body).hexdigest())
                kept_text.append(body if with_text and n > len(kept) else None)
            columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            names = ["text_key", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept_text, pa.binary()).cast(pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField("text_key", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    return joined.mapInArrow(run, T.StructType(fields + [T.StructField("kept_text", T.StringType())] * with_text))


def _key():
    return F.unhex(F.md5(common.text_or_empty().cast("binary")))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """docs with repeats taken out of their texts; texts that lose nothing stay as they are."""
    cleaned = _cleaned(docs, True).where("n_removed > 0").select(F.col("text_key").alias("_x_key"), F.col("kept_text").alias("_x_text"))
    joined = docs.withColumn("_x_own", _key()).join(cleaned, F.col("_x_own") == F.col("_x_key"), "left")
    changed = F.col("_x_key").isNotNull()
    new = {"text": F.when(changed, F.col("_x_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("_x_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return joined.withColumns(new).select(*docs.columns)


def op9_suffix_trees(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    lean = docs.select("doc_id", _key().alias("key"))
    cleaned = _cleaned(docs, False)
    return lean.join(cleaned, F.col("key") == F.col("text_key")).select("doc_id", "n_words", "n_removed", "kept_sha256")
