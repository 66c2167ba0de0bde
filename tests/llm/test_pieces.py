"""Operator 11 against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from plainly import SCHEMA

from sojourn.llm import pieces


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def coder():
    return pieces.Coder(pieces.default_model())


ALPHABET = [
    "a", "the", "in", " ", "  ", "   ", "\n", "\t", "▁", "é", "你", "好", "\U0001f600", "ﬁ", "1", "23", "'s", "#", "\x00", "\x7f", "​",
    "ß", "<s>", "<unk>", "<0x41>", "</s>", " the", " and", "tion", "\r\n", "    ", " " * 16, " " * 33,
]


def test_texts_of_every_kind_as_the_library(coder, library):
    rng = random.Random(11)
    for _ in range(60):
        texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 25))) for _ in range(100)]
        ids, decoded = coder.code(texts)
        expected = library.encode(texts)
        assert [np.frombuffer(i, np.int32).tolist() for i in ids] == expected
        assert decoded == [library.decode(e) for e in expected] == [coder.vocabulary.decode(e) for e in expected]


def test_any_ids_decode_as_in_the_library(coder, library):
    rng = random.Random(12)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 31999), rng.randint(3, 258), 259, 28705, 0, 1, 2]) for _ in range(rng.randint(0, 10))]
        assert coder.vocabulary.decode(ids) == library.decode(ids)


def test_heap_and_common_steps_agree(coder):
    rng = random.Random(13)
    parts = ["▁" * rng.randint(0, 3) + "".join(rng.choice("aehinorst.éß你") for _ in range(rng.randint(1, 29))) for _ in range(3000)]
    assert coder.vocabulary.agendas(parts) == [coder.vocabulary.agenda(p) for p in parts]


def test_long_parts_and_a_full_store(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 50)
    own = pieces.Coder(pieces.default_model())
    texts = ["x" * 30_000, " " * 5000, "ab" * 2000 + " " + "你" * 500] + [f"word{i} other{i * 7}" for i in range(300)]
    for i in range(0, len(texts), 20):
        ids, _ = own.code(texts[i : i + 20])
        assert [np.frombuffer(x, np.int32).tolist() for x in ids] == library.encode(texts[i : i + 20])
        assert len(own.ids) <= 50 + 60


def test_a_difference_from_the_library_fails(coder):
    with pytest.raises(ValueError, match="otherwise"):
        coder.vocabulary.check(["▁the"], [[1, 2, 3]])


def test_query_over_awkward_rows(spark, awkward, library, tmp_path):
    awkward.write.parquet(str(tmp_path / "documents.parquet"))
    got = pieces.op11_piece_agenda(spark, str(tmp_path)).collect()

    def plain(text):
        ids = library.encode(text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))

    expected = sorted(((r["doc_id"], *plain(r["text"])) for r in awkward.collect()), key=str)
    assert sorted((tuple(r) for r in got), key=str) == expected
    assert got[0].__fields__ == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_decode_and_whole_comparison(spark, awkward):
    coded = pieces.encode(awkward)
    again = pieces.decode(coded.drop("decoded")).join(coded.select("doc_id", "decoded"), ["doc_id", "decoded"], "left_anti")
    assert again.where("doc_id IS NOT NULL").count() == 0
    assert pieces.compare_with_library(awkward).where("NOT same_ids OR NOT same_decoded").count() == 0


def test_no_rows(spark, empty):
    assert pieces.encode(empty).count() == 0
    assert empty.schema == SCHEMA
