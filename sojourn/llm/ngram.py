"""Operator 1: scoring texts with a bigram model held in Elias-Fano tries.

A token after a context has the probability (c(context, token) + MU * p(token)) / (c(context) + MU),
p(token) being (c(token) - DISCOUNT) / N, or DISCOUNT * V / N for all unknown tokens together; so
the probabilities after any context sum to one (MacKay and Peto 1995). In logarithms that is a
sum: of the token's own part, of its part as the next token's context, and, for bigrams that
were counted, of log10(1 + c(context, token) / (MU * p(token))). All three are known where all counts
of the token are, so tokens are dealt to shards by their hash and a document's parts are added up.

A shard builds a trie of its bigrams, maps it into memory and answers for its tokens in all
documents. Words are counted over all training documents first, folded map-side. A word with more
than HEAVY tokens is dealt over several shards by its context, and its count goes along; so do
the counts of bigrams above HEAVY, which need no trie and are dealt by document. There are at
most N / HEAVY of either, 8 bytes for every HEAVY tokens, while a shard holds PER_SHARD tokens.

Cases: a null or empty text is one end token; words may have any length; rows alike in id and text
get the same answer each; no training rows leave no known tokens, all probability being with the
unknown one; a null id counts as the empty text when rows are held out; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .elias_fano import Trie

MODULUS, HELD = 7, 2
MU = 300.0
DISCOUNT = 0.75
PER_SHARD = 2_000_000
HEAVY = 300_000
#: Tokens that a task gathers before it sends them off.
CHUNK = 1_250_000

_MASK = np.uint64((1 << 63) - 1)
#: Contexts go by 48 bits: they only have to differ among those of one token.
_NARROW = np.uint64((1 << 48) - 1)
END, BEGIN = np.uint64(1), np.uint64(2)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """63-bit keys of the tokens of all rows, each row's end among them, their contexts, and row offsets."""
    _, _, hashes, rows = common.words(data, offsets, lower=True)
    n = len(rows) - 1
    at = rows + np.arange(n + 1)
    out = np.empty(len(hashes) + n, np.uint64)
    out[at[1:] - 1] = END
    word = np.ones(len(out), bool)
    word[at[1:] - 1] = False
    out[word] = np.maximum(hashes & _MASK, np.uint64(3))
    context = np.empty_like(out)
    context[1:] = np.maximum(out[:-1] & _NARROW, np.uint64(3))
    context[at[:-1]] = BEGIN
    return out, context, at


def pair_key(token: np.ndarray, context: np.ndarray) -> np.ndarray:
    return common.mix(token * np.uint64(0x9E3779B97F4A7C15) + context) & _MASK


def _word_counts(docs: DataFrame) -> DataFrame:
    """word, n, n_train: tokens by key over all rows and over training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_words: list[np.ndarray] = []
        train_words: list[np.ndarray] = []
        size = 0

        def fold() -> pa.RecordBatch:
            everything = np.concatenate([np.zeros(0, np.uint64), *train_words, *held_words])
            train = np.concatenate([np.zeros(0, np.uint64), *train_words])
            word, n = np.unique(everything, return_counts=True)
            seen, times = np.unique(train, return_counts=True)
            n_train = np.zeros(len(word), np.int64)
            n_train[np.searchsorted(word, seen)] = times
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n), pa.array(n_train)], names=["word", "n", "n_train"])

        for batch in batches:
            held = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in common.slices(batch.column(1)):
                token, _, at = tokens(data, offsets)
                out = np.repeat(held[first:last], np.diff(at))
                held_words.append(token[out])
                train_words.append(token[~out])
                size += len(token)
                if size >= CHUNK:
                    yield fold()
                    held_words, train_words, size = [], [], 0
        yield fold()

    counted = docs.select("held_out", "text").mapInArrow(run, "word long, n long, n_train long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


def _heavy_pairs(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """pair, n, n_train of bigrams of heavy words; no other bigram can be heavy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in common.slices(batch.column(1)):
                token, context, at = tokens(data, offsets)
                use = np.isin(token, heavy) & (np.isin(context, heavy & _NARROW) | (context == BEGIN))
                out = np.repeat(held[first:last], np.diff(at))[use]
                pair, which = np.unique(pair_key(token[use], context[use]), return_inverse=True)
                n = np.bincount(which, minlength=len(pair))
                n_train = np.bincount(which, ~out, len(pair)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(n), pa.array(n_train)], names=["pair", "n", "n_train"])

    return docs.select("held_out", "text").mapInArrow(run, "pair long, n long, n_train long").groupBy("pair").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


REQUEST = "shard int, chunk long, docs binary, counts binary, held binary, token_keys binary, tokens binary, contexts binary, keys binary, sizes binary"


def _dealt(docs: DataFrame, shards: int, words: np.ndarray, parts: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """Every token with its context and document, dealt to shards, coded against small dictionaries of its own."""

    def deal(token: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
        to = token
        if len(words):
            at = np.minimum(np.searchsorted(words, token), len(words) - 1)
            is_heavy = words[at] == token
            part = common.mix(context, 3) % parts[at].astype(np.uint64)
            to = np.where(is_heavy, token + (part + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F), token)
            if len(pairs):
                pair = pair_key(token, context)
                at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                to = np.where(is_heavy & (pairs[at] == pair), common.mix(doc + pair), to)
        return (common.mix(to, 5) % np.uint64(shards)).astype(np.int32)

    def requests(token: np.ndarray, context: np.ndarray, row: np.ndarray, keys: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
        shard = deal(token, context, keys[row].view(np.uint64))
        # documents of a chunk follow each other, so order within a shard keeps them together
        order = np.argsort(shard, kind="stable").astype(np.int32)
        edge = np.flatnonzero(np.diff(shard[order], prepend=-1))
        numbered = keys.view(np.uint64) + np.arange(len(keys), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        chunk = int(common.mix(numbered).sum() >> np.uint64(1))  # alike only for chunks of the same documents
        sizes = np.bincount(row, minlength=len(keys)).astype(np.uint32)
        out: list[list] = [[] for _ in range(10)]
        for lo, hi in zip(edge, [*edge[1:], len(shard)], strict=True):
            here = order[lo:hi]
            in_docs, counts = np.unique(row[here], return_counts=True)
            token_keys, t = np.unique(token[here], return_inverse=True)
            narrow = context[here].view(np.uint8).reshape(-1, 8)[:, :6]
            fields = [int(shard[here[0]]), chunk, in_docs.astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(), np.packbits(held[in_docs]).tobytes()]
            fields += [token_keys.tobytes(), t.astype(np.uint16 if len(token_keys) <= 1 << 16 else np.uint32).tobytes(), narrow.tobytes()]
            # one of the chunk's requests carries its documents' keys and sizes
            for values, value in zip(out, [*fields, *((None, None) if lo else (keys.tobytes(), sizes.tobytes()))], strict=True):
                values.append(value)
        kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 8
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=[f.split()[0] for f in REQUEST.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_parts: list[tuple] = []
        size = base = 0

        def flush() -> pa.RecordBatch:
            joined = [np.concatenate(x) for x in zip(*held_parts, strict=True)]
            held_parts.clear()
            return requests(*joined)

        for batch in batches:
            keys, held = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in common.slices(batch.column(2)):
                token, context, at = tokens(data, offsets)
                row = np.repeat(np.arange(base, base + last - first, dtype=np.int32), np.diff(at))
                held_parts.append((token, context, row, keys[first:last], held[first:last]))
                size += len(token)
                base += last - first
                if size >= CHUNK:
                    yield flush()
                    size = base = 0
        if held_parts:
            yield flush()
        pa.default_memory_pool().release_unused()

    return docs.select("row_key", "held_out", "text").mapInArrow(run, REQUEST)


ANSWER = "chunk long, docs binary, known binary, base binary, parts binary, keys binary, sizes binary"


def _read(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Token keys in order; token, context and entry of each occurrence; held_out of the entries, one for each document of each request."""
    column = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in table[name]]
    dictionaries = column("token_keys", np.uint64)
    keys = np.unique(np.concatenate(dictionaries))
    token = np.concatenate([np.searchsorted(keys, d).astype(np.int32)[np.frombuffer(x.as_buffer(), np.uint16 if len(d) <= 1 << 16 else np.uint32)] for d, x in zip(dictionaries, table["tokens"], strict=True)])
    raw = np.concatenate(column("contexts", np.uint8)).reshape(-1, 6)
    context = np.zeros((len(raw), 8), np.uint8)
    context[:, :6] = raw
    counts = column("counts", np.uint32)
    held = np.concatenate([np.unpackbits(h, count=len(n)) for h, n in zip(column("held", np.uint8), counts, strict=True)]).astype(bool)
    counts = np.concatenate(counts)
    entry = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    return keys, token, context.view(np.uint64).ravel(), entry, held


def build_trie(token: np.ndarray, context: np.ndarray, times: np.ndarray, words: np.ndarray, word_counts: np.ndarray, total: int, mu: float, discount: float) -> bytes:
    """Trie of bigrams, sorted and distinct, counted times; words with their counts where these are not all here."""
    distinct, of_token = np.unique(token, return_inverse=True)
    counts = np.bincount(of_token, times, len(distinct)).astype(np.int64)
    if len(words) and len(distinct):
        at = np.minimum(np.searchsorted(words, distinct), len(words) - 1)
        known = words[at] == distinct
        counts[known] = word_counts[at[known]]
    p = (counts - discount) / max(total, 1)
    return Trie.build(token, context, np.log10(1 + times / (mu * p[of_token])), counts)


def _answer(table: pa.Table, words: np.ndarray, word_counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, total: int, mu: float, discount: float) -> pa.Table:
    token_keys, token, context, doc, held = _read(table)
    order = np.lexsort((context, token))
    new = np.ones(len(order), bool)
    new[1:] = (token[order[1:]] != token[order[:-1]]) | (context[order[1:]] != context[order[:-1]])
    of = np.empty(len(order), np.int32)
    of[order] = np.cumsum(new) - 1
    place_of, c = token[order[new]], context[order[new]]
    t = token_keys[place_of]
    del order, new, context
    times = np.bincount(of[~held[doc]], minlength=len(t))
    heavy = np.zeros(len(t), np.int64)
    if len(pairs):
        pair = pair_key(t, c)
        at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        heavy = np.where(pairs[at] == pair, pair_counts[at], 0)
        times[pairs[at] == pair] = 0
    seen = np.flatnonzero(times)
    trie = Trie(build_trie(t[seen], c[seen], times[seen], words, word_counts, total, mu, discount))
    place, count = trie.token_places(token_keys)
    if len(words):
        at = np.minimum(np.searchsorted(words, token_keys), len(words) - 1)
        count = np.where(words[at] == token_keys, word_counts[at], count)
    known = count > 0
    p = np.where(known, (count - discount) / max(total, 1), 1.0)
    own = np.log10(p) + np.where(token_keys == END, 0.0, np.log10(mu / (count + mu)))  # as a token, and as the next one's context
    value = trie.values(place[place_of], c)
    value = np.where(heavy > 0, np.log10(1 + heavy / (mu * p[place_of])), value)
    sums = lambda x: np.bincount(doc, x, len(held))
    edge = np.concatenate([[0], np.cumsum([len(x.as_buffer()) // 4 for x in table["counts"]])])
    cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(edge, edge[1:], strict=False)], pa.binary())
    columns = {"known": cut(sums(known[token]).astype(np.uint32)), "base": cut(sums(np.log10(count + 1.0)[token])), "parts": cut(sums(own[token] + value[of]))}
    return pa.table({"chunk": table["chunk"], "docs": table["docs"], **columns, "keys": table["keys"], "sizes": table["sizes"]})


def _summed(table: pa.Table) -> pa.Table:
    """The sums of one chunk's documents over all shards. Rows of one number are equal chunks, whose sums are alike."""
    column = lambda name, kind: [None if x.as_py() is None else np.frombuffer(x.as_buffer(), kind) for x in table[name]]
    keys = [k for k in column("keys", np.int64) if k is not None]
    sizes = next(s for s in column("sizes", np.uint32) if s is not None)
    known, base, part = np.zeros(len(sizes), np.int64), np.zeros(len(sizes)), np.zeros(len(sizes))
    for docs, k, b, p in zip(*(column(c, d) for c, d in (("docs", np.uint32), ("known", np.uint32), ("base", float), ("parts", float))), strict=True):
        known[docs] += k
        base[docs] += b
        part[docs] += p
    same = len(keys)
    row = {"row_key": keys[0], "n_tokens": sizes.astype(np.int64), "n_known": known // same, "base_part": base / same, "part": part / same}
    return pa.concat_tables([pa.table(row)] * same)


def score_texts(docs: DataFrame, mu: float = MU, discount: float = DISCOUNT, modulus: int = MODULUS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    text = common.text_or_empty()
    named = docs.select("doc_id", (common.id_remainder(modulus) == held).alias("held_out"), text.alias("text"))
    named = named.withColumn("row_key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), "text"))
    counts = common.stage(_word_counts(named), "words")
    whole = counts.agg(F.sum("n"), F.sum("n_train"), F.sum((F.col("n_train") > 0).cast("long"))).first()
    all_tokens, total, distinct = (int(x or 0) for x in whole)
    # at most all tokens / HEAVY rows of either kind
    rows = counts.where(F.col("n") > HEAVY).collect()
    rows.sort(key=lambda r: r["word"])
    words, word_counts = np.array([r["word"] for r in rows], np.uint64), np.array([r["n_train"] for r in rows], np.int64)
    parts = np.array([-(-r["n"] // HEAVY) for r in rows], np.int64)
    pairs, pair_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words):
        rows = sorted(_heavy_pairs(named, words).where(F.col("n") > HEAVY).collect(), key=lambda r: r["pair"])
        pairs, pair_counts = np.array([r["pair"] for r in rows], np.uint64), np.array([r["n_train"] for r in rows], np.int64)
    shards = common.task_count(spark, all_tokens, PER_SHARD)
    dealt = _dealt(named, shards, words, parts, pairs)

    def answer(table: pa.Table) -> pa.Table:
        return _answer(table, words, word_counts, pairs, pair_counts, total, mu, discount)

    answers = dealt.groupBy("shard").applyInArrow(answer, ANSWER)
    sums = answers.groupBy("chunk").applyInArrow(_summed, "row_key long, n_tokens long, n_known long, base_part double, part double").groupBy("row_key").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_part", "part")])
    # rows alike in id and text have put their tokens under one key
    alike = named.select("row_key", "doc_id", "held_out").groupBy("row_key").agg(F.count(F.lit(1)).alias("alike")).toDF("alike_key", "alike")
    sums = sums.join(alike, F.col("row_key") == F.col("alike_key")).toDF("sum_key", "n_tokens", "n_known", "base_part", "part", "alike_key", "alike")
    each = lambda c: F.col(c) / F.col("alike")
    n_tokens, n_known = each("n_tokens").cast("long"), each("n_known").cast("long")
    unknown = float(np.log10(discount * distinct / total)) if total else 0.0
    documents = named.where(~F.col("held_out")).count()
    begin = float(np.log10(mu / (documents + mu)))
    base = each("base_part") - n_tokens * float(np.log10(total + distinct + 1))
    score = each("part") + (n_tokens - n_known) * unknown + begin
    out = named.select("doc_id", "held_out", "row_key").join(sums, F.col("row_key") == F.col("sum_key"))
    return out.select("doc_id", "held_out", n_tokens.alias("n_tokens"), n_known.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))


def op1_elias_fano_bigrams(spark, sf_dir: str) -> DataFrame:
    return score_texts(common.table(spark, sf_dir, "documents"))
