"""Rows with every awkward case, and helpers that state results plainly."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for results of their own
        T.StructField("score", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("node", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("position", T.LongType()),
    ]
)
COMMON = "the of and to in a is that it for was on are as with".split()


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def prose(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(COMMON) if rng.random() < 0.4 else "".join(rng.choice("abdeilmnorst") for _ in range(rng.randint(3, 8))) for _ in range(n)]


def awkward_rows() -> list[tuple]:
    rng = random.Random(3)
    base, passage = prose(rng, 400), prose(rng, 60)
    near = list(base)
    near[7] = "changed"
    texts: list[str | None] = [
        None, "", " \t\n ", "one", "One TWO\x0bthree four", "Über 你好 \U0001f600 naïve", "a b c d e",
        " ".join(base), " ".join(base), " ".join(near), " ".join(prose(rng, 30) + passage + prose(rng, 30)), " ".join(prose(rng, 30) + passage + prose(rng, 10)),
        "same " * 500, "\n".join(["a line of five words", "", "a line of five words"] * 30), " ".join(prose(rng, 20_000)), "x" * 50_000, "A B C D E", "<|endoftext|> 's don't 123",
    ]
    texts += [" ".join(prose(rng, rng.randint(60, 300))) for _ in range(40)]
    rows = [(i, t, "en" if i % 3 else ("de" if i % 2 else None), f"src{i % 4}" if i % 5 else None, len(t or ""), "s", 1, i, "k", 5) for i, t in enumerate(texts)]
    hot = " ".join(prose(rng, 120))
    rows += [(1000 + i, hot, "en", "hot", len(hot), None, None, None, None, None) for i in range(60)]
    rows += [rows[7], rows[20], (None, "a text without id " * 3, None, None, None, None, None, None, None, None)]
    return rows
