"""Quality rules, sharding and mixing: SQL, brute force and the law of each."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import pytest
from plainly import prose, words_of
from pyspark.sql import functions as F

from sojourn.llm import mixing, quality_rules, sharding


def python_free(df):
    plan = df._jdf.queryExecution().toString()
    return not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_base_counts_by_hand(awkward, empty):
    counted = quality_rules.base_counts(awkward)
    assert python_free(counted)
    for r in counted.collect():
        text, w = r["text"] or "", words_of(r["text"])
        lines = [x for x in text.split("\n") if words_of(x)]
        times = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        assert r["_x_n_words"] == len(w)
        assert r["_x_word_chars"] == sum(map(len, w))
        assert r["_x_n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["_x_n_dup_lines"] == len(lines) - len(set(lines))
        assert r["_x_n_repeat_words"] == len(covered)
        assert sum(r["_x_chars"]) == len(text)
    assert quality_rules.apply_quality_rules(empty).count() == 0


def test_distance_is_that_of_the_definition(spark):
    p, q = [3, 1, 0], [1, 1, 2]
    a, b = [x / 4 for x in p], [x / 4 for x in q]
    want = math.sqrt(sum((x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0) for x, y in zip(a, b, strict=True)) / 2)
    row = spark.createDataFrame([(p, q)], "p array<long>, q array<long>").select(quality_rules.js_distance(F.col("p"), F.col("q")).alias("d"), quality_rules.js_distance(F.col("p"), F.array(*[F.lit(0)] * 3)).alias("none")).first()
    assert row["d"] == pytest.approx(want) and row["none"] is None


def test_rules_keep_prose_and_drop_junk(spark, awkward):
    junk = "\n".join("JUNK!!*** %d" % (i * 7919 % 1000) for i in range(400))
    more = spark.createDataFrame([(5000, junk, "en")], "doc_id long, text string, lang string")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    kept = quality_rules.apply_quality_rules(docs)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns
    assert {7, 8, 9, 30, 40, 1000, 1059} <= ids and not ids & {0, 1, 2, 3, 12, 13, 5000}


def test_filter_judges_words_of_short_texts(spark):
    rng = random.Random(3)
    junk_of = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows = [(i, " ".join(prose(rng, 80 + i % 200)), "en") for i in range(300)] + [(1000 + n, junk_of(n), "en") for n in range(60, 180, 10)]
    kept = quality_rules.apply_quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r["doc_id"] for r in kept.collect()} == set(range(300))


@pytest.mark.parametrize(("n", "bits"), [(2, 1), (2, 4), (3, 2), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, n, bits):
    names = [f"c{i}" for i in range(n)]
    cells = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=n)), ", ".join(f"{c} int" for c in names))
    path = cells.withColumn("i", sharding.curve_index([F.col(c) for c in names], bits)).orderBy("i").collect()
    assert [r["i"] for r in path] == list(range(1 << bits * n))
    assert all(sum(abs(a[c] - b[c]) for c in names) == 1 for a, b in itertools.pairwise(path))


def test_shards_hold_runs_of_even_counts(spark, awkward, empty):
    sized = awkward.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    out = sharding.hilbert_shards(sized)
    assert python_free(out)
    rows = out.collect()
    assert len(rows) == awkward.count() and set(out.columns) == set(sized.columns) | {"slot"}
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(counts[shard]))
    few = sharding.hilbert_shards(sized.where("doc_id < 3")).collect()
    assert sorted(r["shard"] for r in few) == [0, 1, 2]
    assert sharding.hilbert_shards(empty.withColumn("size", F.lit(1))).count() == 0


def test_runs_span_few_levels(spark):
    grid = spark.range(4096).select("id", (F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"))
    spans = sharding.hilbert_shards(grid, ("x", "y")).groupBy("shard").agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"))
    assert all(r["w"] <= 16 and r["h"] <= 16 for r in spans.collect())


def test_texts_with_a_long_common_start_get_levels(spark):
    prefix = "https://a.very.long.name/"
    docs = spark.range(4000).select("id", F.concat(F.lit(prefix), F.lpad((F.col("id") * 37 % 40).cast("string"), 2, "0")).alias("source"), (F.col("id") % 100).alias("size"))
    out = sharding.hilbert_shards(docs, ("source", "size"))
    assert python_free(out)
    spans = out.groupBy("shard").agg(F.count_distinct("source").alias("sources"), (F.max("size") - F.min("size")).alias("sizes")).collect()
    assert len(spans) == 16 and all(r["sources"] <= 11 and r["sizes"] <= 40 for r in spans)
    cuts = [i / 16 for i in range(1, 16)]
    limits = sharding.text_limits(docs, "source", cuts)
    names = sorted(r["source"] for r in docs.collect())
    assert limits == [names[math.ceil(c * 4000) - 1] for c in cuts]
    assert sharding.text_limits(docs.where("false"), "source", cuts) == []
    hot = docs.withColumn("source", F.when(F.col("id") < 3000, "hot").otherwise(F.col("source")))
    assert set(sharding.text_limits(hot, "source", cuts)) >= {"hot"}


def test_rates_meet_target_weights(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 15_000, "large").when(F.col("id") < 19_000, "small").otherwise(None).alias("source"), F.lit("t").alias("text"))
    mixed = mixing.poisson_mix(docs, {"large": 1, "small": 1, None: 2})
    assert python_free(mixed)
    rows = mixed.collect()
    counts = Counter(r["source"] for r in rows)
    for source, share in (("large", 0.25), ("small", 0.25), (None, 0.5)):
        assert counts[source] == pytest.approx(share * 20_000, rel=0.06)
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    copies = Counter(r["doc_id"] for r in rows)
    assert all(copies[r["doc_id"]] == r["n_copies"] and 1 <= r["copy"] <= r["n_copies"] for r in rows)
    drawn = Counter(copies.get(i, 0) for i in range(19_000, 20_000))  # rate 10
    mean = sum(k * n for k, n in drawn.items()) / 1000
    assert sum(n * (k - mean) ** 2 for k, n in drawn.items()) / 1000 == pytest.approx(mean, rel=0.2)


def test_mixing_of_awkward_rows(awkward, empty):
    mixed = mixing.poisson_mix(awkward)
    assert set(mixed.columns) == set(awkward.columns) | {"copy", "n_copies"}
    rows = mixed.collect()
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.poisson_mix(awkward.repartition(3)).collect()))
    assert mixing.poisson_mix(empty).count() == 0
    assert mixing.poisson_mix(awkward, {"hot": 1}).select("source").distinct().collect() == [("hot",)]


def test_large_rates_do_not_underflow(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    n = mixing.poisson_mix(docs, total=50 * 2000).count()
    assert n == pytest.approx(100_000, rel=0.02)
