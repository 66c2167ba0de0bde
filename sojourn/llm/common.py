"""What the operators of this package share: the shared folder, staged tables, ranks, components.

Working columns carry the prefix ``_x_`` so that they never clash with columns of the caller.
"""

from __future__ import annotations

import atexit
import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: ASCII white space; every other code point belongs to a word.
WHITE = " \t\n\x0b\f\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="sojourn-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, so that they take no room beside those that follow."""
    for df in staged:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget_later(spark: SparkSession, name: str) -> None:
    """Drop the named table from the catalog when this process ends; its files go with the session's other stages."""

    def drop() -> None:
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    atexit.register(drop)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once a context, wherever they were started."""
    context = spark.sparkContext
    if getattr(context, "_sojourn_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="sojourn-"), "sojourn.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(root, "sojourn")):
            for name in names:
                if name.endswith(".py"):
                    archive.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    context.addPyFile(path)
    context._sojourn_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_remainder(modulus: int, name: str = "doc_id") -> Column:
    """crc32(doc_id as text) modulo modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


def task_count(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for rows so that one holds about per_task of them; at least the session's parallelism."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_task))


def ranked(df: DataFrame, group: str, order: list[str], name: str, per_bucket: int = 50_000) -> DataFrame:
    """Adds column name: gapless rank from 0 within each group, in a hashed order of the order columns.

    group must not be null. Rows of a group are dealt to buckets by hash, buckets are counted,
    offsets are running sums of the counts, and rows are numbered within their bucket. So no task
    holds a group: a bucket holds about per_bucket rows however large its group is. Equal rows take
    ranks in any order. df is read twice, so it should be a staged or plainly stored table.
    """
    sizes = df.groupBy(F.col(group).alias("_x_group")).agg(F.ceil(F.count(F.lit(1)) / per_bucket).alias("_x_buckets"))
    dealt = df.join(sizes, F.col(group) == F.col("_x_group")).withColumn("_x_key", F.xxhash64(*order, F.lit(7919)))
    dealt = dealt.withColumn("_x_bucket", F.pmod(F.shiftright("_x_key", 8), F.col("_x_buckets"))).drop("_x_buckets", "_x_group")
    counts = dealt.groupBy(group, "_x_bucket").agg(F.count(F.lit(1)).alias("_x_c"))
    before = Window.partitionBy(group).orderBy("_x_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("_x_group"), F.col("_x_bucket").alias("_x_b"), F.coalesce(F.sum("_x_c").over(before), F.lit(0)).alias("_x_offset"))
    within = Window.partitionBy(group, "_x_bucket").orderBy("_x_key", *order)
    numbered = dealt.withColumn("_x_r", F.row_number().over(within).cast("long") - 1)
    out = numbered.join(offsets, (F.col(group) == F.col("_x_group")) & (F.col("_x_bucket") == F.col("_x_b")))
    return out.withColumn(name, F.col("_x_r") + F.col("_x_offset")).drop("_x_r", "_x_b", "_x_offset", "_x_bucket", "_x_key", "_x_group")


# -- connected components -------------------------------------------------------------------


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task, folded to one edge per node, towards the smallest node joined here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = [n for n in parent if root(n) != n]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())], names=["a", "b"])


#: Edges that one task may fold by itself.
FEW_EDGES = 1_000_000

EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def components(edges: DataFrame) -> DataFrame:
    """Columns a, b (long): undirected edges. Returns node, root: the smallest node reachable, for every node with an edge.

    Edges are folded per task, then large-star and small-star steps alternate until nothing
    changes (Kiveris et al. 2014). A step moves each edge once; the fold of the neighbourhood
    is a minimum, so a hub's edges are not gathered. As soon as no more than FEW_EDGES are left,
    some 16 MB, one task folds them instead, to the same answer.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    state = stage(edges.mapInArrow(_local_stars, EDGE), "edges")
    mark = None
    while True:
        if state.count() <= FEW_EDGES:
            state = stage(state.coalesce(1).mapInArrow(_local_stars, EDGE), "edges")
            break
        both = state.unionAll(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = down.join(low, F.col("a") == F.col("n")).select("n", "b", "m")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(small.select(F.col("n").alias("a"), F.col("m").alias("b")))
        state = stage(small.where("a <> b").distinct(), "edges")
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    return state.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionAll(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


# -- texts as arrays of bytes ---------------------------------------------------------------


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about most bytes: first row, last row + 1, bytes, and row offsets within them.

    Nulls are empty. A text longer than most is a run of its own, whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last, everything[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


_POWERS: dict[int, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int, base: int) -> np.ndarray:
    """base ** i modulo 2 ** 64, at least n of them."""
    base %= 1 << 64
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have


_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes from which on a word is hashed by itself, not block by block beside others.
_LONG = 512


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ np.uint64(seed)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A to Z as a to z."""
    return _LOWER[data]


def _block_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes from each start to its end: blocks of eight bytes go one after the other through a finaliser."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    sizes = end - start
    hashes = sizes.astype(np.uint64) * np.uint64(_BASE)
    which = np.flatnonzero(sizes < _LONG)
    at, left = start[which], sizes[which]
    while len(which):
        block = blocks[at]
        short = left < 8
        block[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        hashes[which] = mix(hashes[which] * np.uint64(_BASE) ^ block, 0x5851F42D4C957F2D)
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes >= _LONG):
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        hashes[i] = np.frombuffer(digest, "<u8")[0]
    return hashes


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Longest runs of member bytes within the rows of data: first byte, last byte + 1, 64-bit hash, and the rows' offsets among the runs."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = member[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][(offsets[:-1] < n)]
    begins[edge] = inside[edge]
    edge = offsets[1:][offsets[1:] > 0] - 1
    ends[edge] = inside[edge]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, _block_hashes(lowered(data) if lower else data, start, end), np.searchsorted(start, offsets)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the rows in data: first byte, last byte + 1, 64-bit hash, and the rows' offsets among the words."""
    return runs(data, offsets, _WORD, lower)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k items from each position on; len(hashes) - k + 1 values, rows not regarded."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(n, _BASE)[:n], out=total[1:])
    at = np.arange(n - k + 1)
    return mix((total[at + k] - total[at]) * _powers(n, _INVERSE)[at], k)
