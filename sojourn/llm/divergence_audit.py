"""Operator 12: audit of how far the sources of a language diverge in the terms they use.

Every (lang, source) group gives each term that its language keeps a smoothed share in billionths, in
whole numbers. Two groups differ by the sum over kept terms of floor((p - q)**2 / (p + q)). The
sum is accumulated row by row, as Gustavson multiplies sparse matrices: terms are dealt to blocks, a
block's counts are put in term-major order, and each group scatters only its own terms through that
index into one dense accumulator over its peers. A term that one or both groups lack has
its share all the same: the accumulator starts from the baseline of two zero counts, is corrected by
each side's counts against the other's zero share (a count and its number of terms at a time), and the
scatter corrects the terms that both have. So no pair of postings is ever emitted; a block
returns one number for each pair of groups.

Counting: texts are cut and counted in Arrow batches, so that a batch sends one row for each term of a
group. Blocks are filled by counted rows, so a language with most of the rows gets more blocks; where
a language has many sources, their rows of the result are dealt to slices of bounded size.

Cases: null text, lang or source count as empty texts; an empty text makes its group occur; a language
that keeps no term has pairs of value 0 and no terms; a single source has no pairs; rows alike are
counted each; long texts are read whole; an empty table gives an empty table; other columns are not read.
Counts may reach 2**53 and languages 2**31 terms before a number leaves 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common

MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
#: Counts in a block, or as many as a language has pairs of sources, if that is more; and numbers that a task returns, about.
BLOCK, ANSWER = 50_000, 1_000_000

_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True

COUNTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("lang", "source", "term")] + [T.StructField(n, T.LongType()) for n in ("count", "docs")]
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: group, term, its occurrences and documents; and a row with a null term for each group."""
    for batch in batches:
        if not batch.num_rows:
            continue
        langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
        key = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) << 32 | sources.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        groups, group = np.unique(key, return_inverse=True)
        found: list[tuple[np.ndarray, ...]] = []
        names: list[pa.Array] = []
        for first, last, data, offsets in common.slices(batch.column(2)):
            start, end, hashes, rows = common.runs(data, offsets, _TERM, lower=True)
            if not len(start):
                continue
            doc = np.repeat(np.arange(last - first), np.diff(rows))
            own = group[first:last][doc]
            key = common.mix(hashes + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(key, kind="stable")  # documents of a key stay in order
            key, doc = key[order], doc[order]
            new = np.ones(len(order), bool)
            new[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(new)
            new_doc = new.copy()
            new_doc[1:] |= doc[1:] != doc[:-1]
            counts = np.diff(np.append(at, len(order)))
            found.append((own[order[at]], key[at], counts, np.add.reduceat(new_doc.astype(np.int64), at)))
            names.append(_strings(common.lowered(data), start[order[at]], end[order[at]]))
        none = np.zeros(len(groups), np.int64)
        yield _rows(langs, sources, groups, pa.nulls(len(groups), pa.string()), none, none)
        if not found:
            continue
        own, key, counts, docs = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(key)
        key = key[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts, docs = np.add.reduceat(counts[order], at), np.add.reduceat(docs[order], at)
        terms = pa.concat_arrays(names).take(pa.array(order[at]))
        yield _rows(langs, sources, groups[own[order[at]]], terms, counts, docs)


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes from each start to its end as texts."""
    sizes = end - start
    to = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(to[-1]) + np.repeat(start - to[:-1], sizes)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(to.astype(np.int32).tobytes()), pa.py_buffer(data[index].tobytes()))


def _rows(langs: pa.DictionaryArray, sources: pa.DictionaryArray, key: np.ndarray, terms: pa.Array, counts: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    columns = [langs.dictionary.take(pa.array(key >> 32)), sources.dictionary.take(pa.array(key & 0xFFFFFFFF)), terms, pa.array(counts), pa.array(docs)]
    return pa.RecordBatch.from_arrays(columns, names=COUNTS.names)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs; one row with a null term for every group that occurs."""
    lean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    sums = [F.sum(c).alias(c) for c in ("count", "docs")]
    return lean.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(*sums)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), three digits at a time so that no product leaves 64 bits."""
    over = total + 2 * terms
    left, value = count + 2, F.lit(0).cast("long")
    for _ in range(3):
        value = value * 1000 + _div(left * 1000, over)
        left = (left * 1000) % over
    return value + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def distance(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _between(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


PARTIAL = T.StructType([T.StructField(n, T.StringType()) for n in ("lang", "source", "item")] + [T.StructField("value", T.LongType())])


def _accumulate(key: tuple, index: pa.Table, groups: pa.Table) -> pa.Table:
    """One block of a language's terms: for each group of the slice, its distance to every peer over the block's terms.

    index: source, term, p of every count in the block; groups: source, zero (its share of a term it lacks), own (whether in this slice).
    """
    order = pc.sort_indices(groups, [("source", "ascending")])
    groups = groups.take(order)
    names = groups["source"].combine_chunks()
    zero = groups["zero"].to_numpy()
    own = np.flatnonzero(groups["own"].to_numpy(zero_copy_only=False))
    peers = len(names)
    who = pc.index_in(index["source"], value_set=names).to_numpy().astype(np.int64)
    terms = pc.dictionary_encode(index["term"].combine_chunks())
    p, kept = index["p"].to_numpy(), len(terms.dictionary)
    term = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    # term-major: the postings of term t are at[t] to at[t + 1]
    by_term = np.argsort(term, kind="stable")
    at = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=kept))])
    peer, share_of = who[by_term], p[by_term]
    # group-major: the terms of group g are to[g] to to[g + 1]
    by_group = np.argsort(who, kind="stable")
    to = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=peers))])
    # each group's different shares, and how many of its terms have them
    pair = np.lexsort((p, who))
    new = np.ones(len(pair), bool)
    new[1:] = (who[pair][1:] != who[pair][:-1]) | (p[pair][1:] != p[pair][:-1])
    first = np.flatnonzero(new)
    level_of, level, times = who[pair][first], p[pair][first], np.diff(np.append(first, len(pair)))

    out = np.zeros((len(own), peers), np.int64)
    for row, g in zip(out, own, strict=True):
        none = _between(zero[g], zero)
        row += kept * none
        np.add.at(row, level_of, times * (_between(zero[g], level) - none[level_of]))
        mine = level_of == g
        for a, n in zip(level[mine], times[mine], strict=True):
            row += n * (_between(a, zero) - none)
        entries = by_group[to[g] : to[g + 1]]
        sizes = at[term[entries] + 1] - at[term[entries]]
        ends = np.cumsum(sizes)
        spot = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[term[entries]] - (ends - sizes), sizes)
        a, h, b = np.repeat(p[entries], sizes), peer[spot], share_of[spot]
        np.add.at(row, h, _between(a, b) - _between(zero[g], b) - _between(a, zero[h]) + none[h])
    to_other = np.ones(out.shape, bool)
    to_other[np.arange(len(own)), own] = False
    sources = names.take(pa.array(np.repeat(own, peers)[to_other.ravel()]))
    items = names.take(pa.array(np.tile(np.arange(peers), len(own))[to_other.ravel()]))
    lang = pa.array([key[0].as_py()]).take(pa.array(np.zeros(len(items), np.int64)))
    return pa.table([lang, sources, items, pa.array(out[to_other])], names=PARTIAL.names)


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, answer: int = ANSWER) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a language, and each group's top terms above its language's share."""
    counts = common.stage(term_counts(docs), "term-counts")
    named = counts.where("term IS NOT NULL")
    kept = named.groupBy("lang", "term").agg(F.sum("docs").alias("_x_docs"), F.sum("count").alias("_x_all")).where(F.col("_x_docs") >= min_docs).drop("_x_docs")
    index = common.stage(named.join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "_x_all"), "term-index")

    in_group = index.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("rows"))
    groups = counts.where("term IS NULL").select("lang", "source").join(in_group, ["lang", "source"], "left").na.fill(0, ["n", "rows"])
    in_lang = index.select("lang", "term", "_x_all").distinct().groupBy("lang").agg(F.sum("_x_all").alias("all"), F.count(F.lit(1)).alias("terms"))
    shape = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("peers"), F.sum("rows").alias("rows")).join(in_lang, "lang", "left").na.fill(0, ["all", "terms"])
    # blocks: as many as the counts need, but no more numbers returned than counts read; slices: so many that rows of groups times peers stay in bounds
    pairs = F.col("peers").cast("double") * F.col("peers")
    shape = shape.select(
        "lang", "all", "terms", F.greatest(F.lit(1), F.ceil(F.col("rows") / F.greatest(F.lit(float(block)), pairs))).alias("blocks"),
        F.greatest(F.lit(1), F.ceil(pairs / answer)).alias("slices"),
    )
    groups = common.stage(groups.drop("rows").join(shape, "lang"), "audit-groups")

    own = groups.select("lang", "source", "n", "all", "terms", "blocks", "slices")
    shares = index.join(own, ["lang", "source"]).withColumns({"p": share(F.col("count"), F.col("n"), F.col("terms")), "q": share(F.col("_x_all"), F.col("all"), F.col("terms"))})

    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    left = shares.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), spread)
    zero = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("n"), F.greatest("terms", F.lit(1)))).otherwise(F.lit(1))
    right = groups.select("lang", "source", zero.alias("zero"), "blocks", spread, F.pmod(F.xxhash64("source"), F.col("slices")).alias("mine"))
    right = right.select("lang", "source", "zero", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "slice", (F.col("mine") == F.col("slice")).alias("own"))
    dealt = ["lang", "block", "slice"]
    partial = left.groupBy(*dealt).cogroup(right.groupBy(*dealt)).applyInArrow(_accumulate, PARTIAL)
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    best = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(best)


def op12_gustavson_audit(spark, sf_dir: str) -> DataFrame:
    return divergence_audit(common.table(spark, sf_dir, "documents"))


def oracle(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """The same rows in SQL, by plain sums over all pairs of sources and all kept terms."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), tokens AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), counts AS (SELECT lang, source, term, count(*) AS c FROM tokens GROUP BY ALL
), kept AS (SELECT lang, term, count(*) AS c FROM tokens GROUP BY lang, term HAVING count(DISTINCT d) >= {min_docs}
), in_lang AS (SELECT lang, sum(c) AS n, count(*) AS v FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM docs
), every AS (
  SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c, k.c AS all_c FROM groups g JOIN kept k USING (lang)
  LEFT JOIN counts x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
), totals AS (SELECT lang, source, sum(c) AS n FROM every GROUP BY lang, source
), shares AS (
  SELECT e.lang, e.source, e.term, e.c, 1 + ({SCALE}::HUGEINT * (e.c + 2)) // (t.n + 2 * l.v) AS p,
    1 + ({SCALE}::HUGEINT * (e.all_c + 2)) // (l.n + 2 * l.v) AS q
  FROM every e JOIN totals t USING (lang, source) JOIN in_lang l USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE c > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
