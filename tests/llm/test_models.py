"""Language model, packing, search and classifiers against plain statements of what they do."""

from __future__ import annotations

import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from plainly import lower, prose, words_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sojourn.llm import common, elias_fano, labelled, ngram, packing, quality_model, toxicity, vantage


@pytest.mark.parametrize(("n", "top"), [(1, 1), (1, 2**62), (64, 64), (1000, 1500), (3000, 2**63 - 1)])
def test_sequences_answer_as_sorted_arrays_do(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    sequence = elias_fano.Sequence.of(elias_fano.Sequence.encode(values))
    assert (sequence.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, top, 200, dtype=np.uint64), np.array([0, 2**63 - 1], np.uint64)])
    low = rng.integers(0, n, len(asked))
    high = np.minimum(n, low + rng.integers(0, 60, len(asked)))
    assert (sequence.successor(asked, low, high) == np.clip(np.searchsorted(values, asked), low, high)).all()


def test_trie_is_compact_and_exact_but_for_quantised_values():
    rng = np.random.default_rng(1)
    pairs = np.unique(np.stack([rng.integers(3, 2000, 30_000), rng.integers(3, 500, 30_000)]).astype(np.uint64) * np.uint64(0x1F3D5B79A1), axis=1)
    value, counts = rng.random(pairs.shape[1]) * 5, rng.integers(1, 99, len(np.unique(pairs[0])))
    raw = elias_fano.Trie.build(pairs[0], pairs[1], value, counts)
    assert len(raw) < 8 * pairs.shape[1]
    trie = elias_fano.Trie(raw)
    place, count = trie.token_places(pairs[0])
    assert (place >= 0).all() and (count == counts[place]).all()
    assert np.abs(trie.values(place, pairs[1]) - value).max() < 0.01
    assert (trie.values(place, pairs[1] + np.uint64(1)) == 0).all()
    assert trie.token_places(np.array([1], np.uint64))[0].tolist() == [-1]


def expected_scores(rows, mu=300.0, discount=0.75):
    texts = [[*words_of(lower(t)), None] for _, t in rows]
    train = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for d, _ in rows]
    one, two = Counter(), Counter()
    for w, use in zip(texts, train, strict=True):
        if use:
            one.update(w)
            two.update(zip(["<s>", *w[:-1]], w, strict=True))
    n, v = sum(one.values()), len(one)
    p = lambda t: (one[t] - discount) / n if one[t] else discount * v / n
    of = lambda c: sum(train) if c == "<s>" else one[c]
    for (d, _), w, use in zip(rows, texts, train, strict=True):
        base = sum(math.log10((one[t] + 1) / (n + v + 1)) for t in w)
        score = sum(math.log10((two[c, t] + mu * p(t)) / (of(c) + mu)) for c, t in zip(["<s>", *w[:-1]], w, strict=True))
        yield (d, not use, len(w), sum(one[t] > 0 for t in w), n), base, score
    total = sum((two["the", t] + mu * p(t)) / (one["the"] + mu) for t in one) + mu * (discount * v / n) / (one["the"] + mu)
    assert total == pytest.approx(1)


@pytest.mark.parametrize("heavy", [500_000, 60])
def test_scores_are_those_of_the_model(awkward, monkeypatch, heavy):
    monkeypatch.setattr(ngram, "HEAVY", heavy)
    monkeypatch.setattr(ngram, "CHUNK", 9000)
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    order = lambda x: (str(x[0]), x[1])
    want = sorted(expected_scores(rows), key=order)
    fields = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    got = sorted(((tuple(r[f] for f in fields), r["base_score"], r["score"]) for r in ngram.score_texts(awkward).collect()), key=order)
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[1] == pytest.approx(w[1]) and g[2] == pytest.approx(w[2], abs=0.02 * g[0][2])


def test_model_without_rows_or_training_rows(spark, empty):
    assert ngram.score_texts(empty).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = ngram.score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def test_packing_is_lossless_gapless_and_full(awkward, empty):
    coder = Tokenizer.from_file(packing.default_tokenizer())
    pieces = packing.pack(awkward, with_ids=True).collect()
    windows = {}
    for r in pieces:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert sorted(windows) == list(range(len(windows)))
    for slots in windows.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    total = sum(r["length"] for r in pieces)
    assert len(windows) <= -(-total // packing.WINDOW) + 2
    whole = Counter()
    for r in awkward.collect():
        ids = np.array([*coder.encode(r["text"] or "", add_special_tokens=False).ids, packing.END], "<u4")
        whole[r["doc_id"], len(ids)] += 1
        mine = [p for p in pieces if p["doc_id"] == r["doc_id"]]
        for p in mine:
            assert p["ids"] == ids[p["start"] : p["start"] + p["length"]].tobytes()
    starts = Counter((r["doc_id"], r["doc_tokens"]) for r in pieces for _ in range(r["length"]))
    assert starts == Counter({k: k[1] * n for k, n in whole.items()})
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.choice([4096, 128, 256, 1280, 2944, 3968, 1, 5, 56, 127], 8)
    histogram = {int(k): int(rng.integers(1, 3000)) for k in lengths}
    rows, run, run_window = packing.plan(histogram)
    used = {}
    for k, n in histogram.items():
        for rank in range(n):
            table = rows[k]
            if k in run and rank >= run[k][0]:
                at = run[k][1] + (rank - run[k][0]) * k + run_window * packing.WINDOW
                window, offset = divmod(at, packing.WINDOW)
            else:
                first, slots, _, begin, base = table[np.searchsorted(table[:, 0], rank, "right") - 1]
                window, slot = base + (rank - first) // slots, (rank - first) % slots
                offset = begin + slot * k
            left = k
            while left:
                part = min(left, packing.WINDOW - offset)
                used.setdefault(int(window), []).append((int(offset), int(part)))
                window, offset, left = window + 1, 0, left - part
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
    assert len(used) <= -(-sum(k * n for k, n in histogram.items()) // packing.WINDOW) + 2


def test_least_squares_is_least():
    rng = np.random.default_rng(2)
    a, b = rng.random((12, 40)), rng.random(12) * 10
    x = packing.non_negative_least_squares(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and abs(gradient[x > 1e-9]).max(initial=0) < 1e-6


def test_joined_checksums():
    raw = np.random.default_rng(0).bytes(4 * packing.UNIT * 5)
    units = np.array([zlib.crc32(raw[i : i + 4 * packing.UNIT]) for i in range(0, len(raw), 4 * packing.UNIT)], np.uint32)
    assert packing.join_crcs(units) == zlib.crc32(raw)


def brute_nearest(rows, k, every):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 4:
            usable[i] = min(usable.get(i, tuple(v)), tuple(v))
    ids = sorted(usable)
    for q in ids:
        if q % every == 0:
            near = sorted((-float(np.sum(np.array(usable[c]) * np.array(usable[q]))), c) for c in ids if c != q)[:k]
            yield from ((q, r + 1, c, -s) for r, (s, c) in enumerate(near))


@pytest.mark.parametrize("per_shard", [7, 4096])
def test_search_with_factor_one_is_exact(spark, per_shard):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(120)]
    rows += [(200 + i, [2.0, 1.0, 0.0, 1.0]) for i in range(90)]  # one vector, many rows
    rows += [(400, None), (420, [0.0] * 4), (440, [1.0, None, 0.0, 0.0]), (460, [float("nan"), 1.0, 1.0, 1.0]), (480, [float("inf"), 1.0, 1.0, 1.0]), (500, [1.0]), (None, [1.0] * 4), rows[20]]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, vantage.nearest(frame, 10, 20, 1.0, per_shard=per_shard).collect()))
    assert got == sorted(brute_nearest(rows, 10, 20))
    assert vantage.nearest(frame.where("vec_id = 400")).count() == 0
    assert vantage.nearest(frame.where("false")).count() == 0
    assert sorted(r["rank"] for r in vantage.nearest(frame.where("vec_id < 3"), every=20).collect()) == sorted(range(1, len([1 for i, v in rows[:3] if any(v)]))) * bool(any(rows[0][1]))


def test_relaxed_search_recalls(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = vantage.nearest(frame, per_shard=300).collect()
    x = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits / (20 * 150) >= 0.9


@pytest.mark.parametrize("scale", ["one long row", "half of the rows long", "norms over many halvings"])
def test_recall_does_not_hang_on_norms(spark, scale):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 2000)] + 0.4 * rng.normal(size=(2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scale == "one long row":
        x[7] *= 50
    elif scale == "half of the rows long":
        x[::2] *= 12
    else:
        x *= 2.0 ** rng.integers(-6, 6, (2000, 1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hits = Counter()
    for r in vantage.nearest(frame, per_shard=300).collect():
        s = x @ x[r["query_id"]]
        s[r["query_id"]] = -np.inf
        hits[r["query_id"]] += s[r["vec_id"]] >= np.sort(s)[-20]
    assert sum(hits.values()) / (20 * 100) >= 0.9


@pytest.mark.parametrize(("per_shard", "levels"), [(4096, 2), (150, 2), (300, 3)])
def test_ties_go_to_the_smaller_ids(spark, per_shard, levels):
    rng = np.random.default_rng(11)
    x = rng.integers(0, levels, (2000, 12)) * 2.0 - levels + 1
    x = x[np.abs(x).sum(1) > 0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in vantage.nearest(frame, 10, 20, 1.0, per_shard=per_shard).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -s))[:10]
        assert [got[q][j + 1] for j in range(10)] == [(int(i), float(s[i])) for i in want]


@pytest.fixture(scope="module")
def labelled_documents(spark):
    rng, rows = random.Random(5), []
    for i in range(900):
        words = prose(rng, rng.randint(40, 200))
        toxic, junk = i % 4 == 0, i % 5 == 0
        if toxic:
            for _ in range(len(words) // 12 + 1):
                words[rng.randrange(len(words))] = rng.choice(["stupid", "moronic", "worthless", "disgusting"])
        if junk:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), int(not junk), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int").repartition(4).cache()


@pytest.mark.parametrize(("score", "label", "modulus", "held"), [(quality_model.score_quality, "quality", 3, 1), (toxicity.score_toxicity, "toxic", 5, 0)])
def test_held_out_accuracy(labelled_documents, score, label, modulus, held):
    docs = labelled_documents
    out = score(docs.select("doc_id", "text"), docs.select("doc_id", "quality", "toxic"))
    rows = out.toDF("id", "held_out", "score", "predicted").join(docs, F.col("id") == F.col("doc_id")).collect()
    assert len(rows) == 900
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r[label] for r in tested) / len(tested) > 0.93
    # held-out labels are not used
    other = docs.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held, 1 - F.col(label)).otherwise(F.col(label)))
    assert sorted(map(tuple, score(docs, other).collect())) == sorted(map(tuple, out.collect()))


def test_misspellings_share_subwords(labelled_documents):
    texts = [r["text"] for r in labelled_documents.where("quality = 1").orderBy("doc_id").collect()]
    y = np.array([r["toxic"] for r in labelled_documents.where("quality = 1").orderBy("doc_id").collect()], float)
    import pyarrow as pa

    model = toxicity.train(pa.array(texts), y, 0.3)
    rng = random.Random(6)
    clean = " ".join(prose(rng, 60))
    bad = clean + " stupiid wortthless disgustingg moronicc stuupid" * 2
    ask = lambda t: float(model.score(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0])
    assert ask(clean) < 0.5 < ask(bad)


@pytest.mark.parametrize("score", [quality_model.score_quality, toxicity.score_toxicity])
def test_classifiers_on_awkward_rows(spark, awkward, empty, score):
    labels = awkward.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    out = score(awkward, labels)
    assert out.count() == awkward.count() and out.where("score is null or isnan(score)").count() == 0
    nobody = labels.where("false")
    assert {r["score"] for r in score(awkward, nobody).collect()} == {0.5}
    assert score(empty, labels).count() == 0


def bytes_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def awkward_texts(awkward):
    return [r["text"] or "" for r in awkward.orderBy("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def models(labelled_documents):
    import pyarrow as pa

    rows = labelled_documents.orderBy("doc_id").limit(500).collect()
    texts = pa.array([r["text"] for r in rows])
    return [model.train(texts, np.array([r[label] for r in rows], float), 0.5) for model, label in ((quality_model, "quality"), (toxicity, "toxic"))]


@pytest.mark.parametrize("which", [0, 1])
def test_a_score_hangs_on_its_text_alone(models, awkward, which):
    texts = awkward_texts(awkward)
    alone = [float(models[which].score(*bytes_of([t]))[0]) for t in texts]
    rng = random.Random(3)
    for size in (2, 7, len(texts)):
        order = list(range(len(texts)))
        rng.shuffle(order)
        for first in range(0, len(order), size):
            part = order[first : first + size]
            assert models[which].score(*bytes_of([texts[i] for i in part])).tolist() == [alone[i] for i in part]


@pytest.mark.parametrize(("score", "label"), [(quality_model.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_scores_stand_still_under_partitioning(labelled_documents, score, label):
    docs, labels = labelled_documents.select("doc_id", "text"), labelled_documents.select("doc_id", label)
    first, *others = [sorted(map(tuple, score(d, labels).collect())) for d in (docs.coalesce(1), docs.orderBy(F.desc("doc_id")).coalesce(1), docs.repartition(3), docs.repartition(7, "text"))]
    assert all(o == first for o in others)


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_passages(text):
    """Features and weight of each passage, byte by byte and word by word."""
    raw = text.encode()
    starts = [i for i in range(len(raw)) if raw[i] not in b" \t\n\x0b\x0c\r" and (i == 0 or raw[i - 1] in b" \t\n\x0b\x0c\r")]
    words = raw.split()
    parts = sorted({s // quality_model.PASSAGE for s in starts}) or [0]
    number = {p: i for i, p in enumerate(parts)}
    of_word = [number[s // quality_model.PASSAGE] for s in starts]
    of_byte, now, at = [], 0, dict(zip(starts, of_word, strict=True))
    for i in range(len(raw)):
        now = at.get(i, now)
        of_byte.append(now)
    codes = quality_model._CODES.tolist()
    out = []
    for p in range(len(parts)):
        own = [i for i in range(len(raw)) if of_byte[i] == p]
        total = max(len(own), 1)
        classes, grams = [0.0] * 8, [0.0] * quality_model.BINS
        for i in own:
            classes[quality_model._CLASS[raw[i]]] += 1 / total
            if i + 2 < len(raw):
                mixed = (codes[0][raw[i]] + codes[1][raw[i + 1]] + codes[2][raw[i + 2]]) % 2**32 * 0x9E3779B1 % 2**32 >> 25
                grams[mixed] += 1
        mine = [j for j in range(len(words)) if of_word[j] == p]
        n = max(len(mine), 1)
        new = sum(words[j] not in words[:j] for j in mine)
        triples = [tuple(words[j : j + 3]) for j in range(len(words))]
        new_triples = sum(triples[j] not in triples[:j] for j in mine)
        extra = [new / n, new_triples / n] if words else [0.0, 0.0]
        out.append((classes + [math.sqrt(g / total) for g in grams] + extra, n / (n + quality_model.HALF)))
    return out


def plain_quality(model, text):
    w, b, v, u, a, c, d = model.weights
    encoded, energy = [], []
    for features, weight in plain_passages(text):
        x = (np.array(features) - model.mean) / model.scale * weight
        h = np.tanh(x @ w + b)
        encoded.append(h)
        energy.append(float((np.tanh(h @ v) * np.array([sigmoid(g) for g in h @ u])) @ a))
    alpha = np.exp(np.array(energy) - max(energy))
    return sigmoid(float((alpha / alpha.sum()) @ np.array(encoded) @ c) + d[0] + model.shift)


def plain_toxicity(model, text):
    raw = [32, *(c + 32 if 65 <= c < 91 else c for c in text.encode()), 32]
    white = [c in (32, 9, 10, 11, 12, 13) for c in raw]
    codes, total, count = toxicity._CODES.tolist(), 0.0, 0
    for k in toxicity.SIZES:
        for i in range(len(raw) - k + 1):
            if any(white[i + 1 : i + k - 1]):
                continue
            value = sum(codes[c] * pow(0x9E3779B1, j, 2**32) for j, c in enumerate(raw[i : i + k])) % 2**32
            value = (value ^ value >> 15) * (0x85EBCA6B + 2 * k) % 2**32
            total, count = total + float(model.weight[value >> 32 - toxicity.BUCKET_BITS]), count + 1
    for word in bytes(raw).split():
        (one,) = common.words(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[2].tolist()
        total, count = total + float(model.weight[one >> 64 - toxicity.BUCKET_BITS]), count + 1
    return sigmoid(total / (count + toxicity.PRIOR) + model.bias)


@pytest.mark.parametrize(("which", "plain"), [(0, plain_quality), (1, plain_toxicity)])
def test_scores_are_those_of_a_plain_forward_pass(models, awkward, which, plain):
    texts = [t for t in awkward_texts(awkward) if len(t) < 8000]
    got = models[which].score(*bytes_of(texts))
    for text, score in zip(texts, got, strict=True):
        assert score == pytest.approx(plain(models[which], text), rel=1e-9)


def test_a_document_of_many_rows_teaches_once(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (3, "x" * 300_000), (4, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (4, 1), (4, 0), (9, 1)], "doc_id long, quality int")
    texts, y, _ = labelled.sample(docs, labels, "quality", 1, 5, 10)
    assert len(texts) == 3 and sorted(y.tolist()) == [0, 0, 1]


def test_quality_model_attends(spark):
    """A text is judged by the passage that matters, wherever it stands."""
    weights = quality_model.train.__defaults__
    assert json.dumps(weights)  # parameters are plain numbers
    x, weight, at = quality_model.passages(np.frombuffer(b"a b " * 400, np.uint8), np.array([0, 0, 800, 1600]))
    assert at.tolist() == [0, 1, 3, 5] and x.shape == (5, quality_model.FEATURES) and len(weight) == 5
