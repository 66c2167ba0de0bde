"""Operator 5: quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, gated attention (Ilse et al. 2018) weighs
the encodings, and the weighted sum is scored. Encoder, attention and score are trained jointly, in
numpy, from labels of documents alone. The sample is bounded by per_class; scoring reads every
text whole.

Cases: a null or empty text is a bag of one empty passage and gets a score like any other; a
very long text has as many passages as it needs; a score hangs on its text alone, to the last bit; without labels of both
classes the score is the share of label 1 among labelled rows; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from . import common, labelled

#: Bytes of a passage, which ends with the word that reaches them.
PASSAGE = 512
BINS = 128
PER_CLASS = 1500
MODULUS, HELD = 3, 1

_CLASS = np.full(256, 7, np.int64)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[32, 9, 11, 12, 13]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 5
_CLASS[[ord(c) for c in "!\"'()+,-./:;=?@[\\]^_`{}~"]] = 6
_CODES = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 32, (3, 256), dtype=np.uint64).astype(np.uint32)
FEATURES = 8 + BINS + 2
#: Words at which a passage's features count half; shorter ones are drawn to the mean.
HALF = 20


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row of features per passage, its weight by length, and the documents' offsets among the passages (never an empty range)."""
    docs, n = len(offsets) - 1, len(data)
    start, _, hashes, rows = common.words(data, offsets)
    per_doc = np.diff(rows)
    doc = np.repeat(np.arange(docs), per_doc)
    part = (start - offsets[doc]) // PASSAGE
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
    counts = np.bincount(doc[new], minlength=docs)
    sizes = np.maximum(counts, 1)
    at = np.concatenate([[0], np.cumsum(sizes)])
    within = np.cumsum(new) - 1
    first_of_doc = np.cumsum(counts) - counts
    of_word = at[doc] + within - first_of_doc[doc]
    m = int(at[-1])
    # a byte belongs to the passage of the word that began last; bytes before the first word to the first passage
    of_byte = np.repeat(at[:-1], np.diff(offsets))
    if len(start):
        last = np.zeros(n, np.int64)
        last[start] = of_word
        of_byte = np.maximum(of_byte, np.maximum.accumulate(last))
    classes = np.bincount(of_byte * 8 + _CLASS[data], minlength=8 * m).reshape(m, 8).astype(float)
    total = np.maximum(classes.sum(1, keepdims=True), 1)
    grams = np.zeros((m, BINS))
    if n >= 3:
        mixed = (_CODES[0][data[:-2]] + _CODES[1][data[1:-1]] + _CODES[2][data[2:]]) * np.uint32(0x9E3779B1) >> np.uint32(25)
        own = np.repeat(np.arange(docs), np.diff(offsets))
        inside = own[:-2] == own[2:]  # no gram reaches into the next text
        grams = np.bincount((of_byte[:-2] * BINS + mixed.astype(np.int64))[inside], minlength=BINS * m).reshape(m, BINS).astype(float)
    words = np.maximum(np.bincount(of_word, minlength=m), 1).astype(float)
    extra = np.zeros((m, 2))
    if len(start):
        _, first = np.unique(common.mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        extra[:, 0] = np.bincount(of_word[first], minlength=m) / words
        # the two words after it, none past the end of the text
        one, two = (np.where(np.append(doc[k:] == doc[:-k], [False] * min(k, len(doc)))[: len(doc)], np.roll(hashes, -k), np.uint64(0)) for k in (1, 2))
        gram = common.mix(hashes + one * np.uint64(3) + two * np.uint64(7) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first = np.unique(gram, return_index=True)
        extra[:, 1] = np.bincount(of_word[first], minlength=m) / words
    return np.hstack([classes / total, np.sqrt(grams / total), extra]), words / (words + HALF), at


@dataclass
class AttentionModel:
    """Weights of encoder, gate and score; constant stands alone where there was nothing to learn from."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    constant: float | None = None
    shift: float = 0.0

    def normal(self, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale * weight[:, None]

    def parts(self, x: np.ndarray, at: np.ndarray, times=np.matmul) -> tuple[np.ndarray, ...]:
        """x: normal features of passages; times: the matrix product."""
        w, b, v, u, a, c, d = self.weights
        h = np.tanh(times(x, w) + b)
        tv, su = np.tanh(times(h, v)), labelled.sigmoid(times(h, u))
        e = times(tv * su, a[:, None])[:, 0]
        sizes = np.diff(at)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at[:-1]), sizes))
        alpha = e / np.repeat(np.add.reduceat(e, at[:-1]), sizes)
        z = np.add.reduceat(alpha[:, None] * h, at[:-1], axis=0)
        return h, tv, su, alpha, z, times(z, c[:, None])[:, 0] + d[0]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        x, weight, at = passages(data, offsets)
        return labelled.sigmoid(self.parts(self.normal(x, weight), at, by_columns)[-1] + self.shift)


def by_columns(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w, added up column by column, so that a row's result never hangs on how many rows stand beside it."""
    out = np.zeros((len(x), w.shape[1]))
    for column, row in zip(x.T, w, strict=True):
        out += column[:, None] * row
    return out


def train(texts, y: np.ndarray, odds: float, width: int = 32, gate: int = 16, epochs: int = 100, batch: int = 64, seed: int = 5) -> AttentionModel:
    """odds: label 1 to label 0 among all labelled rows, to which scores are shifted from the sample's."""
    nothing = AttentionModel(np.zeros(1), np.ones(1), [], odds / (1 + odds))
    if len(set(y.tolist())) < 2:
        return nothing
    found, by_length, sizes = [], [], []
    for _, _, data, offsets in common.slices(texts):
        x, weight, at = passages(data, offsets)
        found.append(x)
        by_length.append(weight)
        sizes.append(np.diff(at))
    x, weight, sizes = np.vstack(found), np.concatenate(by_length), np.concatenate(sizes)
    at = np.concatenate([[0], np.cumsum(sizes)])
    random = np.random.Generator(np.random.PCG64(seed))
    init = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape)
    weights = [init(FEATURES, width), np.zeros(width), init(width, gate), init(width, gate), init(gate), init(width), np.zeros(1)]
    model = AttentionModel(x.mean(0), x.std(0) + 1e-3, weights, None, float(np.log(odds) - np.log(y.mean() / (1 - y.mean()))))
    x = model.normal(x, weight)
    steps = labelled.Adam(weights, 2e-3)
    for _ in range(epochs):
        for chosen in np.array_split(random.permutation(len(y)), max(1, len(y) // batch)):
            own = sizes[chosen]
            to = np.concatenate([[0], np.cumsum(own)])
            rows = np.repeat(at[chosen] - to[:-1], own) + np.arange(to[-1])
            xs, ys = x[rows], y[chosen]
            w, b, v, u, a, c, d = weights
            h, tv, su, alpha, z, logit = model.parts(xs, to)
            g = (labelled.sigmoid(logit) - ys) / len(ys)
            gz = np.repeat(g[:, None] * c, own, axis=0)
            ga = (gz * h).sum(1)
            ge = alpha * (ga - np.repeat(np.add.reduceat(alpha * ga, to[:-1]), own))
            gt, gs = ge[:, None] * a * su * (1 - tv * tv), ge[:, None] * a * tv * su * (1 - su)
            gh = (alpha[:, None] * gz + gt @ v.T + gs @ u.T) * (1 - h * h)
            decay = 1e-4
            steps.step([xs.T @ gh + decay * w, gh.sum(0), h.T @ gt + decay * v, h.T @ gs + decay * u, (tv * su).T @ ge, z.T @ g + decay * c, np.array([g.sum()])])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, modulus: int = MODULUS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; the model goes out with the tasks and is of fixed size."""
    texts, y, odds = labelled.sample(docs, labels, "quality", modulus, held, per_class)
    model = train(texts, y, odds)
    return labelled.scored(docs, modulus, held, model.score)


def op5_attention_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
