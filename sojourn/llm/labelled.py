"""What the two classifiers share: the bounded labelled sample, and scoring of whole texts in slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common


#: Bytes up to which a text may teach; longer ones are scored only. So the sample is at most 2 * per_class * LONGEST bytes.
LONGEST = 1 << 18


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, per_class: int) -> tuple[pa.Array, np.ndarray, float]:
    """Texts and labels of at most per_class documents of each class, and the class odds among all labelled rows.

    Only rows whose id's remainder is not held take part. Rows that disagree about a document count
    by majority, an even split as 1; a null label is no label. The sample is the least of each class
    in a hashed order, so it is the same on every run. A document of several rows teaches by one text, the
    one of least md5; texts of more than LONGEST bytes do not teach. Ids and texts of the sample,
    2 * per_class at most, are what reaches the driver.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("_x_y"))
    marked = marked.where(common.id_remainder(modulus) != held).select("doc_id", (F.col("_x_y") >= 0.5).cast("int").alias("_x_y"))
    counts = {r["_x_y"]: r["n"] for r in marked.groupBy("_x_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted: dict = {}
    for y in sorted(counts):
        rows = marked.where(F.col("_x_y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
        wanted |= {r["doc_id"]: y for r in rows}
    odds = (counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)
    if not wanted:
        return pa.array([], pa.string()), np.zeros(0), odds
    found = docs.where(F.col("doc_id").isin(list(wanted))).select("doc_id", common.text_or_empty().alias("text")).where(F.octet_length("text") <= LONGEST)
    found = found.groupBy("doc_id").agg(F.min(F.struct(F.md5(F.col("text").cast("binary")), "text"))["text"].alias("text"))
    rows = found.orderBy("doc_id", "text").collect()
    return pa.array([r["text"] for r in rows], pa.string()), np.array([wanted[r["doc_id"]] for r in rows], float), odds


def scored(docs: DataFrame, modulus: int, held: int, score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; score takes the bytes and offsets of a slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for first, last, data, offsets in common.slices(batch.column(2)):
                found[first:last] = np.clip(score(data, offsets), 0.0, 1.0)
            columns = [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    lean = docs.select("doc_id", (common.id_remainder(modulus) == held).alias("held_out"), common.text_or_empty().alias("text"))
    return lean.mapInArrow(run, schema)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


class Adam:
    """Adaptive steps for a list of arrays (Kingma and Ba 2015)."""

    def __init__(self, values: list[np.ndarray], rate: float) -> None:
        self.values, self.rate, self.t = values, rate, 0
        self.first, self.second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        for v, g, m, s in zip(self.values, gradients, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(s / (1 - 0.999**self.t)) + 1e-8)
