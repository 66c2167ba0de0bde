"""Operator 12 against plain sums over all pairs and terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
from plainly import SCHEMA

from sojourn.llm import divergence_audit as audit


def plain(rows, min_docs=10, top=10):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang = lang or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        counts[lang, source or ""].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)

        def shares(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}

        groups = {s: shares(c) for (own, s), c in counts.items() if own == lang}
        whole = shares(sum((c for (own, _), c in counts.items() if own == lang), Counter()))
        far = lambda p, q: (p - q) ** 2 // (p + q)
        for source, p in groups.items():
            pairs = [(sum(far(p[t], q[t]) for t in kept), other) for other, q in groups.items() if other != source]
            terms = [(far(p[t], whole[t]), t) for t in kept if counts[lang, source][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in audit.divergence_audit(df, **options).collect())


def texts(df):
    return [(r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_awkward_rows(awkward):
    got = found(awkward)
    assert got == plain(texts(awkward)) and {r[2] for r in got} == {"pair", "term"}


def test_blocks_and_slices_do_not_change_a_value(awkward):
    expected = plain(texts(awkward), min_docs=2, top=3)
    assert found(awkward, min_docs=2, top=3) == expected
    assert found(awkward, min_docs=2, top=3, block=25, answer=4) == expected


def test_many_sources_with_shared_and_own_terms(spark):
    rng = random.Random(12)
    vocabulary = [f"wörd{c}" for c in "abcdefghijklmnopqrstuvwxyz"] + ["ÀB", "Zz", "z-z", "数"]
    rows = [(" ".join(rng.choice(vocabulary[: 3 + i % 27]) for _ in range(rng.randint(0, 60))), "l" + str(i % 2), f"s{i % 13}") for i in range(400)]
    rows += [("", "lonely", "one"), (None, None, None), ("few words", None, "b"), ("9 9", "zero", "a"), ("", "zero", "b")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = found(df, block=200, answer=50)
    assert got == plain(rows)
    assert [r for r in got if r[0] == "zero"] == [("zero", "a", "pair", "b", 0, 1), ("zero", "b", "pair", "a", 0, 1)]


def test_sql_states_the_same(spark, awkward, tmp_path):
    path = str(tmp_path / "documents.parquet")
    awkward.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    got = audit.op12_gustavson_audit(spark, str(tmp_path))
    columns = got.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({audit.oracle()})").fetchall())


def test_no_rows(spark, empty):
    assert empty.schema == SCHEMA and found(empty) == []
