"""Every stage of the pipeline against brute force, and queries against their SQL."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from compare import difference
from plainly import words_of
from test_dedup import expected_components, expected_kept

from sojourn.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_there_is_a_query_for_every_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_matches_statement(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    assert difference(queries.QUERIES[name](spark, SF_DIR), con, queries.statements()[name]) is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_answers_for_whole_tables(spark, name):
    out = queries.QUERIES[name](spark, SF_DIR)
    assert len(out.columns) == len(set(out.columns))
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    if name.startswith(("op2_", "op4_", "op7_", "op12_", "op13_")):
        assert out.count() > 0
    else:
        assert out.count() == documents


@pytest.mark.parametrize("table", ["awkward", "empty"])
def test_stages_follow_each_other(spark, request, table):
    docs = first = request.getfixturevalue(table)
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = rows(docs)
        docs = corpus_pipeline.common.stage(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != "packing":
            assert dict(docs.dtypes) == dict(first.dtypes) and docs.columns == first.columns
        if name == "quality_rules":
            assert not Counter(rows(docs)) - Counter(before) and all(len(words_of(t)) >= 50 for _, t in rows(docs))
        if name == "near_dedup":
            kept = {component for _, _, component in expected_components(before)}
            assert sorted(d for d, _ in rows(docs)) == sorted(kept)
        if name == "substring_dedup":
            assert Counter(rows(docs)) == Counter((d, t if not gone else kept) for (d, t), (_, _, gone, _, kept) in zip(before, expected_kept(before), strict=True))
        if name == "mixing":
            assert set(rows(docs)) <= set(before)
        if name == "packing":
            assert sum(r["length"] for r in docs.collect()) == sum(r["doc_tokens"] for r in docs.where("start = 0").collect())
    if table == "empty":
        assert docs.count() == 0


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
