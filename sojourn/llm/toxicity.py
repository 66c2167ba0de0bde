"""Operator 8: toxicity by averaged subword embeddings and a linear softmax.

A text is the bag of its words and of their character n-grams with word borders (Joulin et al.
2016), hashed to buckets. Embeddings and softmax are trained jointly in numpy, so a misspelling
never seen shares the vectors of the n-grams it keeps. The sample is bounded by per_class; scoring
reads every text whole, with one number a bucket: after training, softmax and average commute.

Cases: a null or empty text is an empty bag and scores the bias; a score hangs on its text alone, to the last bit; without
labels of both classes the score is the share of label 1 among labelled rows; a text of any length is
one average; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from . import common, labelled

BUCKET_BITS = 18
SIZES = (3, 4, 5, 6)
PER_CLASS = 1500
#: Subwords in fewer texts of the sample are left out.
MIN_TEXTS = 3
#: Subwords without weight added to every bag, so that a text of a word or two leans on no chance likeness.
PRIOR = 200
#: A toxic word is worth about a hundredth of its text.
SCALE = 100
MODULUS, HELD = 5, 0
_CODES = np.random.Generator(np.random.PCG64(8)).integers(1, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)[np.where(np.arange(256) == 0, 32, common._LOWER)]
_CODES[[9, 10, 11, 12, 13]] = _CODES[32]


def bags(data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n-gram size and for whole words: buckets and the positions they begin at, in the bytes
    with a space before each text and at the end; and where each text begins there."""
    docs, n = len(offsets) - 1, len(data)
    spaced = np.full(n + docs + 1, 32, np.uint8)
    spaced[np.arange(n) + np.repeat(np.arange(docs), np.diff(offsets)) + 1] = data
    begins = offsets + np.arange(docs + 1)
    inside = common._WORD[spaced]
    gaps = np.concatenate([[0], np.cumsum(~inside)])
    codes = _CODES[spaced]
    total, factor = codes.copy(), np.uint32(1)
    found = []
    for k in range(2, max(SIZES) + 1):
        if len(total) < 2:
            break
        factor = np.uint32(int(factor) * 0x9E3779B1 & 0xFFFFFFFF)
        total = total[:-1] + codes[k - 1 :] * factor
        if k in SIZES:
            size = len(total)
            at = np.flatnonzero(gaps[k - 1 : k - 1 + size] == gaps[1 : 1 + size])
            mixed = total[at]
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * k)
            found.append((mixed >> np.uint32(32 - BUCKET_BITS), at))
    start, _, hashes, _ = common.words(spaced, np.array([0, len(spaced)]), lower=True)
    found.append(((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32), start))
    return found, begins


@dataclass
class SubwordModel:
    """weight: what a bucket adds to the log odds; constant stands alone where there was nothing to learn from."""

    weight: np.ndarray
    bias: float
    constant: float | None = None

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        docs = len(offsets) - 1
        if self.constant is not None:
            return np.full(docs, self.constant)
        found, begins = bags(data, offsets)
        total, count = np.zeros(docs), np.zeros(docs)
        for bucket, at in found:
            edge = np.searchsorted(at, begins)
            full = np.flatnonzero(np.diff(edge))
            if len(full):  # each text is added up by itself
                total[full] += np.add.reduceat(self.weight[bucket].astype(np.float64), edge[:-1][full])
            count += np.diff(edge)
        return labelled.sigmoid(total / (count + PRIOR) + self.bias)


def train(texts, y: np.ndarray, odds: float, dim: int = 4, epochs: int = 100, rate: float = 1.0, seed: int = 8) -> SubwordModel:
    """Joint training of bucket vectors and softmax by gradient steps with momentum, so that rare buckets move little.

    odds: label 1 to label 0 among all labelled rows; the bias is shifted half the way from equal classes.
    """
    if len(set(y.tolist())) < 2:
        return SubwordModel(np.zeros(1), 0.0, odds / (1 + odds))
    docs, buckets, values, first = [], [], [], 0
    texts_with = np.zeros(1 << BUCKET_BITS, np.int32)
    for _, _, data, offsets in common.slices(texts, 1 << 18):
        found, begins = bags(data, offsets)
        key = np.concatenate([(np.searchsorted(begins, at, "right") - 1 << BUCKET_BITS) + b for b, at in found])
        key, count = np.unique(key, return_counts=True)
        doc, bucket = key >> BUCKET_BITS, (key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
        sizes = np.bincount(doc, count, len(offsets) - 1) + PRIOR
        texts_with += np.bincount(bucket, minlength=1 << BUCKET_BITS).astype(np.int32)
        docs.append((doc + first).astype(np.int32))
        buckets.append(bucket)
        values.append((count / sizes[doc] * SCALE).astype(np.float32))
        first += len(offsets) - 1
    used = np.flatnonzero(texts_with >= MIN_TEXTS)
    number = np.full(1 << BUCKET_BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    often = [number[b] >= 0 for b in buckets]
    doc = np.concatenate([d[o] for d, o in zip(docs, often, strict=True)])
    bucket = np.concatenate([number[b[o]] for b, o in zip(buckets, often, strict=True)])
    value = np.concatenate([v[o] for v, o in zip(values, often, strict=True)])
    del docs, buckets, values, often
    parts = [slice(i, i + (1 << 20)) for i in range(0, len(doc), 1 << 20)]

    def fold(to: np.ndarray, size: int, weight) -> np.ndarray:
        """Sums of weight by to, a part at a time."""
        return sum((np.bincount(to[p], weight(p), size) for p in parts), np.zeros(size))

    random = np.random.Generator(np.random.PCG64(seed))
    vectors, softmax, bias = random.normal(0, 0.02, (dim, len(used))), random.normal(0, 0.5, (dim, 2)), np.zeros(2)
    softmax[:, 0] = -softmax[:, 1]
    speed = np.zeros_like(vectors)
    target = np.stack([1 - y, y], 1)
    weigh = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))[:, None] / len(y)
    steps = labelled.Adam([softmax, bias], 0.01)
    for _ in range(epochs):
        mean = np.stack([fold(doc, len(y), lambda p, v=v: v[bucket[p]] * value[p]) for v in vectors], 1)
        logits = mean @ softmax + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        g = (p / p.sum(1, keepdims=True) - target) * weigh
        back = g @ softmax.T
        for d in range(dim):
            own = np.ascontiguousarray(back[:, d])
            grad = fold(bucket, len(used), lambda p, own=own: own[doc[p]] * value[p])
            speed[d] = 0.9 * speed[d] - rate * (grad + 1e-5 * vectors[d])
        vectors += speed
        steps.step([mean.T @ g + 1e-4 * softmax, g.sum(0)])
    weight = np.zeros(1 << BUCKET_BITS, np.float32)
    weight[used] = (softmax[:, 1] - softmax[:, 0]) @ vectors * SCALE
    return SubwordModel(weight, float(bias[1] - bias[0]) + float(np.log(odds)) / 2)


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, modulus: int = MODULUS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; the model, 2**BUCKET_BITS numbers, goes out with the tasks."""
    texts, y, odds = labelled.sample(docs, labels, "toxic", modulus, held, per_class)
    model = train(texts, y, odds)
    return labelled.scored(docs, modulus, held, model.score)


def op8_subword_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
