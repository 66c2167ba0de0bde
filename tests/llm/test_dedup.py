"""Near-duplicates and repeated substrings against brute force."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from plainly import lower, prose, words_of
from pyspark.sql import functions as F

from sojourn.llm import common, near_dedup, substrings


def shingle_set(text):
    w = words_of(lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected_components(rows):
    """Component of each row, by comparing all pairs of distinct sets."""
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[shingle_set(text)].append(doc_id)
    sets = [s for s in ids if s]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, s in enumerate(sets):
        least[find(i)] += [d for d in ids[s] if d is not None]
    name = {s: min(least[find(i)], default=None) for i, s in enumerate(sets)}
    return Counter((d, len(shingle_set(t)), name[shingle_set(t)] if shingle_set(t) else d) for d, t in rows)


def check_near(docs):
    got = near_dedup.near_duplicates(docs.select("doc_id", "text")).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected_components(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def families(seed, n=12, copies=14):
    """Documents in families whose members differ by 0 to 8 words, so that many pairs lie about the limit."""
    rng, rows = random.Random(seed), []
    for f in range(n):
        base = prose(rng, rng.choice([25, 60, 150, 400]))
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, 8)):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009 + f * 2000, " ".join(text)))
    return rows


def test_awkward_documents(awkward):
    check_near(awkward)


@pytest.mark.parametrize(("region", "block"), [(1000, 512), (5, 3)])
def test_families_about_the_limit(spark, monkeypatch, region, block):
    monkeypatch.setattr(near_dedup, "REGION", region)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    check_near(spark.createDataFrame(families(1), "doc_id long, text string"))


def test_one_large_family_is_one_component(spark):
    rng = random.Random(4)
    base, rows = prose(rng, 300), []
    for i in range(1500):
        text = list(base)
        text[i % 300] = f"own{i}"
        rows.append((i, " ".join(text)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.select("component_id").distinct().collect() == [(0,)]


def test_deduplicate_keeps_one_row_and_all_columns(awkward, empty):
    kept = near_dedup.deduplicate(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    assert ids.count(7) == 1 and 8 not in ids and 9 not in ids and ids.count(1000) == 1 and 1001 not in ids
    assert near_dedup.deduplicate(empty).count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0


def test_deduplicate_keeps_one_of_null_and_of_equal_ids(spark):
    rng, rows = random.Random(6), []
    for ids in ([None, None], [None, None, None], [7, 7], [None, 9, 9]):
        base = prose(rng, 200)
        rows += [(d, " ".join([*base, f"end{i}"])) for i, d in enumerate(ids)]
    rows += [(None, ""), (None, ""), (11, " "), (11, "")]
    kept = [(r["doc_id"], r["text"]) for r in near_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(kept) == len(set(kept)) and Counter(d for d, t in kept if t.strip()) == Counter({None: 2, 7: 1, 9: 1})
    assert Counter((d, t) for d, t in kept if not t.strip()) == Counter([(None, ""), (11, " "), (11, "")])


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    random.Random(1).shuffle(chain)
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(chain, "a long, b long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_kept(rows, window=substrings.WINDOW):
    """Rows of doc_id, n_words, n_removed, digest and the kept words."""
    split = [(d, words_of(t)) for d, t in rows]
    times = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for d, w in split:
        cover = [False] * len(w)
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                cover[i : i + window] = [True] * window
        kept = [x for x, c in zip(w, cover, strict=True) if not c]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept)))
    return out


@pytest.mark.parametrize("heavy", [50_000, 2])
def test_substrings_match_brute_force(awkward, monkeypatch, heavy):
    monkeypatch.setattr(substrings, "HEAVY", heavy)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    cleaned = substrings._cleaned(awkward, False)
    got = awkward.select("doc_id", substrings._key().alias("own")).join(cleaned, F.col("own") == F.col("text_key"))
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect())
    assert got == Counter(r[:4] for r in expected_kept(rows))


def test_repeats_within_one_text_and_at_its_ends(spark):
    rng = random.Random(9)
    passage = prose(rng, 35)
    rows = [(1, " ".join(passage + ["between"] + passage)), (2, " ".join(prose(rng, 34))), (3, " ".join(passage[1:] + prose(rng, 3))), (4, " ".join(["w"] * 36))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substrings.dedup_substrings(docs).collect()}
    assert got == {1: "between", 2: rows[1][1], 3: rows[2][1], 4: ""}


def test_dedup_substrings_keeps_rows_and_columns(awkward, empty):
    got = substrings.dedup_substrings(awkward)
    assert got.columns == awkward.columns and dict(got.dtypes) == dict(awkward.dtypes)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    want = Counter((d, kept if removed else t) for (d, t), (_, _, removed, _, kept) in zip(rows, expected_kept(rows), strict=True))
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == want
    assert substrings.dedup_substrings(empty).count() == 0


def test_words_and_grams_tell_texts_apart():
    data = "ab a b  ab\tB ab".encode()
    start, end, hashes, rows = common.words(np.frombuffer(data, np.uint8), np.array([0, 2, 2, len(data)]), lower=True)
    assert [data[s:e] for s, e in zip(start, end, strict=True)] == [b"ab", b"a", b"b", b"ab", b"B", b"ab"]
    assert rows.tolist() == [0, 1, 1, 6]
    assert hashes[0] == hashes[3] == hashes[5] and hashes[2] == hashes[4] and len(set(hashes.tolist())) == 3
    assert len(set(common.grams(hashes, 2).tolist())) == 4  # B ab is b ab


def hashes_of(words, lower=False):
    data = " ".join(words).encode()
    return common.words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower)[2]


def test_no_pattern_of_letters_collides():
    thue, other = "a", "b"
    for _ in range(12):
        thue, other = thue + other, other + thue
    words = [thue, other] + ["ab" * n for n in range(1, 400)] + ["a" * n for n in range(1, 700)] + ["a" * n + "\x00" * m for n in range(8) for m in range(1, 9)]
    words = list(dict.fromkeys(words))
    assert len(set(hashes_of(words).tolist())) == len(words)
    assert hashes_of(["ABC" * 300], True) == hashes_of(["abc" * 300])


@pytest.mark.parametrize("heavy", [50_000, 2])
def test_words_alike_in_half_their_hash_are_told_apart(spark, monkeypatch, heavy):
    monkeypatch.setattr(substrings, "HEAVY", heavy)
    names = [f"id{i}" for i in range(400_000)]
    hashes = hashes_of(names)
    for half in (hashes >> np.uint64(32), hashes & np.uint64(0xFFFFFFFF)):
        order = np.argsort(half)
        at = np.flatnonzero(half[order][1:] == half[order][:-1])
        assert len(at)
        one, two = names[order[at[0]]], names[order[at[0] + 1]]
        rng, rows = random.Random(5), []
        for place in range(35):
            body = prose(rng, 35)
            for word in (one, two):
                rows.append((len(rows), " ".join([*body[:place], word, *body[place + 1 :]])))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted(map(tuple, substrings.dedup_substrings(docs).collect())) == rows


def test_anchors_take_no_room_beside_what_follows(spark, monkeypatch):
    """All anchors and their counts are gone once the shared ones are written, before suffixes are made."""
    staged, seen = {}, {}
    stage, suffixes = common.stage, substrings._suffixes

    def noted(df, name):
        staged[name] = stage(df, name)
        seen[name] = [p.removeprefix("file:").rsplit("/", 1)[0] for p in staged[name].inputFiles()][0]
        return staged[name]

    def looked(texts, wanted, heavy):
        assert not any(os.path.exists(seen[name]) for name in ("anchors", "shared-prefixes")) and os.path.exists(seen["shared"])
        return suffixes(texts, wanted, heavy)

    monkeypatch.setattr(common, "stage", noted)
    monkeypatch.setattr(substrings, "_suffixes", looked)
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a {words} b"), (2, f"c {words} d")], "doc_id long, text string")
    assert sorted(r["text"] for r in substrings.dedup_substrings(docs).collect()) == ["a b", "c d"]
