"""Operator 7: approximate nearest neighbours by vantage-point trees per shard.

The largest inner product is the nearest point once every vector is given one more coordinate that
brings it to the greatest norm, and queries a zero there (Bachrach et al. 2014); so the triangle
inequality holds. One long vector would make all such distances nearly equal, and ``factor`` would cut
what is nearest; so vectors are parted in bands of norms within a half of the band's greatest. Each
band is divided by its greatest norm and lifted to 1, and queries, whose length orders nothing, are
brought to 1. Bounds go from band to band as inner products with the query of length 1.

Vectors go to the shard of their band and the pivot nearest by direction, shards above a size are split
by hash, and each gets a tree. A query first searches its own shards, which bounds its k-th inner
product, then those other shards, and within them those subtrees, whose least possible distance
times ``factor`` is within that bound. Factor 1 is exact; a larger one prunes more.

Pivots are a bounded sample (MOST_PIVOTS); every vector is indexed. Queries meet a tree in blocks.
Equal vectors of a shard are one point of its tree with its least k + 1 ids, which is all that any
query can return, so a vector that a third of all rows share costs no more than another.

Cases: vectors null, zero, or with null or non-finite components take no part, nor rows without
vec_id, nor vectors of another length than most; rows of one vec_id collapse to its least vector;
ties go to the smaller vec_id; fewer candidates than k give fewer rows; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common

PER_SHARD = 4096
MOST_PIVOTS = 1024
LEAF = 512
BLOCK = 1024
#: Queries that are held against the cells of all pivots at a time.
VISITORS = 512
#: Points kept beyond k while a tree is searched, so that rounding decides no tie.
SLACK = 4
#: Inner products of unit vectors that differ by less may be ties; then every point of the shard at that place is looked at.
TIE = 1e-9
FACTOR = 1.15


# -- a tree ----------------------------------------------------------------------------------


def lift(x: np.ndarray, norm: float) -> np.ndarray:
    """Vectors divided by norm, which none exceeds, with the coordinate that brings their norm to 1."""
    x = x / norm
    return np.hstack([x, np.sqrt(np.maximum(1.0 - (x * x).sum(1, keepdims=True), 0.0))])


def directions(x: np.ndarray) -> np.ndarray:
    """Vectors brought to norm 1, with the coordinate 0 that queries and pivots have in a lifted space."""
    x = x / np.abs(x).max(1, keepdims=True)
    return np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True)), np.zeros((len(x), 1))])


def farthest(bound: np.ndarray, norm: np.ndarray | float) -> np.ndarray:
    """The distance in the space lifted from norm that stands for inner product bound with a query of norm 1."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (bound / norm), 0.0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes of a tree over points: vantage point, limits of the inner and the outer distances, children; or a range of order."""
    n = len(points)
    order = np.arange(n)
    vantage, limits, child, span = [], [], [], []
    todo = [(0, n, -1, 0)]
    while todo:
        first, last, parent, side = todo.pop()
        me = len(vantage)
        if parent >= 0:
            child[parent][side] = me
        vantage.append(-1)
        limits.append([0.0, 0.0, 0.0, 0.0])
        child.append([-1, -1])
        span.append((first, last))
        if last - first <= LEAF:
            continue
        own = order[first:last]
        centre = points[own].mean(0, keepdims=True)
        far = int(np.argmax(distances(points[own], centre)[:, 0]))  # a corner of the set parts it best
        own[[0, far]] = own[[far, 0]]
        d = distances(points[own[1:]], points[own[:1]])[:, 0]
        by = np.argsort(d, kind="stable")
        own[1:], d = own[1:][by], d[by]
        half = len(d) // 2
        vantage[me] = own[0]
        limits[me] = [d[0], d[half - 1], d[half], d[-1]]
        todo += [(first + 1, first + 1 + half, me, 0), (first + 1 + half, last, me, 1)]
    return {"order": order, "vantage": np.array(vantage), "limits": np.array(limits), "child": np.array(child), "span": np.array(span)}


def search(points: np.ndarray, tree: dict[str, np.ndarray], queries: np.ndarray, keep: int, bound: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """The keep nearest points of every query no farther than its bound: distances and places in points, -1 for none.

    Queries go down together; at each node those nearer to a child visit it before the others.
    """
    m = len(queries)
    best, place = np.full((m, keep), np.inf), np.full((m, keep), -1, np.int64)
    reach = bound.copy()

    def offer(who: np.ndarray, what: np.ndarray, d: np.ndarray) -> None:
        new = np.hstack([best[who], d])
        names = np.hstack([place[who], np.broadcast_to(what, (len(who), len(what)))])
        top = np.argpartition(new, keep - 1, axis=1)[:, :keep]
        best[who], place[who] = np.take_along_axis(new, top, 1), np.take_along_axis(names, top, 1)
        reach[who] = np.minimum(bound[who], best[who].max(1))

    todo: list[tuple[int, np.ndarray, np.ndarray]] = [(0, np.arange(m), np.zeros(m))]
    while todo:
        node, who, least = todo.pop()
        alive = least * factor <= reach[who] + 1e-7
        who = who[alive]
        if not len(who):
            continue
        first, last = tree["span"][node]
        if tree["vantage"][node] < 0:
            what = tree["order"][first:last]
            offer(who, what, distances(queries[who], points[what]))
            continue
        point = tree["vantage"][node : node + 1]
        d = distances(queries[who], points[point])
        offer(who, point, d)
        d = d[:, 0]
        low, inner, outer, high = tree["limits"][node]
        inside = np.maximum(0.0, np.maximum(low - d, d - inner))
        outside = np.maximum(0.0, np.maximum(outer - d, d - high))
        near = inside <= outside
        a, b = tree["child"][node]
        # last in, first out: nearer children come off the stack before farther ones
        todo += [(a, who[~near], inside[~near]), (b, who[near], outside[near]), (b, who[~near], outside[~near]), (a, who[near], inside[near])]
    return best, place


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as found:
        return dict(found)


def index_shard(ids: np.ndarray, x: np.ndarray, norm: float, k: int) -> bytes:
    """The shard's distinct vectors, their least k + 1 ids, and the tree over them."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.ascontiguousarray(x[order])
    _, first, which = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    by = np.argsort(which, kind="stable")
    rank = np.arange(len(by)) - np.searchsorted(which[by], which[by])
    held = by[rank <= k]
    starts = np.searchsorted(which[held], np.arange(len(first) + 1))
    points = x[first]
    return _pack({"ids": ids[held], "starts": starts, "points": points, "norm": np.float64(norm), **build(lift(points, norm))})


def search_shard(raw: bytes, query_ids: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query, vec_id and inner product of each query's best k in the shard, and each query's k-th inner product there at norm 1.

    bound: the inner product, at norm 1, that is to be reached.
    """
    tree = _unpack(raw)
    ids, starts, points, norm = tree["ids"], tree["starts"], tree["points"], tree["norm"]
    unit = directions(queries)
    _, place = search(lift(points, norm), tree, unit, k + 1 + SLACK, farthest(bound, norm), factor)
    out_q, out_v, out_s = [], [], []
    last = np.full(len(queries), -np.inf)
    for i, row in enumerate(place):
        row = row[row >= 0]
        score = (points[row] * queries[i]).sum(1)
        if len(row) == k + 1 + SLACK:
            # the last place of the answer is at best that of the k-th point; where those kept beyond it are as near, more may be
            edge = np.sort(score)[-k - 1]
            slip = TIE * norm * np.linalg.norm(queries[i])
            if score.min() >= edge - slip:
                row = np.flatnonzero(points @ queries[i] >= edge - 2 * slip)
                score = (points[row] * queries[i]).sum(1)
        sizes = starts[row + 1] - starts[row]
        at = np.repeat(starts[row], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        vec, s, own = ids[at], np.repeat(score, sizes), np.repeat(row, sizes)
        other = vec != query_ids[i]
        vec, s, own = vec[other], s[other], own[other]
        top = np.lexsort((vec, -s))[:k]
        out_q.append(np.full(len(top), query_ids[i]))
        out_v.append(vec[top])
        out_s.append(s[top])
        if len(top) == k:
            last[i] = points[own[top[-1]]] @ unit[i, :-1]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_q]), np.concatenate([empty, *out_v]), np.concatenate([np.zeros(0), *out_s]), last


# -- Spark -----------------------------------------------------------------------------------


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def usable(vectors: DataFrame, id_name: str, vector_name: str) -> DataFrame:
    """vec_id, _x_v (array<double>) and _x_norm of the rows that take part, one a vec_id."""
    v = F.col(vector_name)
    rows = vectors.select(F.col(id_name).cast("long").alias("vec_id"), v.cast("array<double>").alias("_x_v")).where(F.col("vec_id").isNotNull())
    bad = F.exists("_x_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("_x_v").isNotNull() & ~bad & F.exists("_x_v", lambda x: x != 0))
    size = rows.agg(F.mode(F.size("_x_v"))).first()[0] or 0
    rows = rows.where(F.size("_x_v") == size).groupBy("vec_id").agg(F.min("_x_v").alias("_x_v"))
    most = F.array_max(F.transform("_x_v", F.abs))  # taken out, so that no square over- or underflows
    return rows.withColumn("_x_norm", most * F.sqrt(F.aggregate("_x_v", F.lit(0.0), lambda a, x: a + (x / most) * (x / most))))


FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("bound", T.DoubleType())])


def _searched(queries: DataFrame, shards: DataFrame, size: int, k: int, factor: float) -> DataFrame:
    """queries: shard, query_id, _x_b, bound. A query's row without vec_id carries its k-th inner product, at norm 1, in the shard."""
    queries = common.stage(queries, "asked")
    blocks = common.stage(queries.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n")), "blocks")
    dealt = queries.join(blocks, "shard").select("shard", F.pmod(F.xxhash64("query_id"), F.col("n")).cast("int").alias("block"), "query_id", "_x_b", "bound")
    dealt = dealt.toDF("shard", "block", "query_id", "_x_b", "bound")
    blocks = blocks.toDF("asked", "n")
    trees = shards.join(blocks, F.col("shard") == F.col("asked")).select(F.col("asked").alias("tree_shard"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("tree_block"), "tree")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({f.name: pa.array([], pa.float64() if f.name in ("score", "bound") else pa.int64()) for f in FOUND})
        ids = left["query_id"].to_numpy()
        q, v, s, last = search_shard(right["tree"][0].as_py(), ids, _matrix(left["_x_b"], size), left["bound"].to_numpy(), k, factor)
        ends = len(ids)
        return pa.table(
            {
                "query_id": np.concatenate([q, ids]),
                "vec_id": pa.concat_arrays([pa.array(v, pa.int64()), pa.nulls(ends, pa.int64())]),
                "score": pa.concat_arrays([pa.array(s, pa.float64()), pa.nulls(ends, pa.float64())]),
                "bound": pa.concat_arrays([pa.nulls(len(q), pa.float64()), pa.array(last)]),
            }
        )

    return dealt.groupBy("shard", "block").cogroup(trees.groupBy("tree_shard", "tree_block")).applyInArrow(run, FOUND)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, factor: float = FACTOR, id_name: str = "vec_id", vector_name: str = "embedding", per_shard: int = PER_SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each vec_id divisible by every, the k vectors of largest inner product found."""
    rows = common.stage(usable(vectors, id_name, vector_name), "vectors")
    total, most, size = rows.agg(F.count(F.lit(1)), F.max("_x_norm"), F.max(F.size("_x_v"))).first()
    if not total:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).where(F.lit(False))
    rows = rows.withColumn("_x_band", F.floor(F.log2(F.lit(most)) - F.log2("_x_norm")).cast("int"))
    bands = rows.groupBy("_x_band").agg(F.max("_x_norm").alias("norm")).orderBy("_x_band").collect()  # one row for each halving of the norm
    numbers, norms = np.array([r["_x_band"] for r in bands]), np.array([r["norm"] for r in bands]) * (1 + 1e-12)
    wanted = int(min(MOST_PIVOTS, max(1, total // per_shard)))
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()  # at most MOST_PIVOTS vectors
    pivots = directions(np.array([r["_x_v"] for r in chosen]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                band = np.searchsorted(numbers, batch.column(2).to_numpy())
                d = distances(lift(flat, norms[band][:, None]), pivots)
                near = d.argmin(1)
                raw = pa.array([r.tobytes() for r in flat], pa.binary())
                home = pa.array((band * len(pivots) + near).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), home, pa.array(d[np.arange(len(d)), near]), raw], names=["vec_id", "home", "d", "_x_b"])

    schema = "vec_id long, home int, d double, _x_b binary"
    homed = common.stage(rows.select("vec_id", "_x_v", "_x_band").mapInArrow(assign, schema), "homed")
    counts = {r["home"]: r["n"] for r in homed.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MOST_PIVOTS rows a band
    codes, parts = [0] * (len(bands) * len(pivots)), 0
    for h in sorted(counts):
        n = -(-counts[h] // (2 * per_shard))
        codes[h] = parts * (1 << 32) + n
        parts += n
    code = F.get(F.split(F.lit(",".join(map(str, codes))), ",").cast("array<long>"), F.col("home"))
    shard = (F.shiftright(code, 32) + F.pmod(F.xxhash64("vec_id"), code % (1 << 32))).cast("int")

    def index(group: pa.Table) -> pa.Table:
        d = group["d"].to_numpy()
        tree = index_shard(group["vec_id"].to_numpy(), _matrix(group["_x_b"], size), norms[group["home"][0].as_py() // len(pivots)], k)
        return pa.table({"shard": group["shard"][:1], "home": group["home"][:1], "least": pa.array([d.min()]), "most": pa.array([d.max()]), "tree": pa.array([tree], pa.binary())})

    shards = homed.withColumn("shard", shard).groupBy("shard").applyInArrow(index, "shard int, home int, least double, most double, tree binary")
    shards = common.stage(shards, "trees")
    limits = homed.groupBy("home").agg(F.min("d").alias("least"), F.max("d").alias("most")).orderBy("home").collect()  # at most MOST_PIVOTS rows a band
    homes = np.array([r["home"] for r in limits], np.int64)
    least, high = np.array([r["least"] for r in limits]), np.array([r["most"] for r in limits])

    asking = homed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "home", "_x_b")
    own = asking.join(shards.select("shard", "home"), "home").select("shard", "query_id", "_x_b", F.lit(float("-inf")).alias("bound"))
    near = common.stage(_searched(own, shards, size, k, factor), "near")
    bounds = near.where("vec_id IS NULL").groupBy(F.col("query_id").alias("q")).agg(F.max("bound").alias("bound"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other cells that may hold something within a query's bound, some queries at a time."""
        for batch in batches:
            for first in range(0, batch.num_rows, VISITORS):
                part = batch.slice(first, VISITORS)
                d = distances(directions(_matrix(part.column(2), size)), pivots)[:, homes % len(pivots)]
                reach = farthest(part.column(3).to_numpy()[:, None], norms[homes // len(pivots)][None, :])
                low = np.maximum(0.0, np.maximum(least[None, :] - d, d - high[None, :]))
                who, what = np.nonzero((low * factor <= reach + 1e-7) & (homes[None, :] != part.column(1).to_numpy()[:, None]))
                take = pa.array(who)
                yield pa.RecordBatch.from_arrays([pa.array(homes[what].astype(np.int32)), *(part.column(c).take(take) for c in (0, 2, 3))], names=["home", "query_id", "_x_b", "bound"])

    bounded = asking.join(bounds, F.col("query_id") == F.col("q")).select("query_id", "home", "_x_b", "bound")
    cells = bounded.mapInArrow(visit, "home int, query_id long, _x_b binary, bound double")
    far = _searched(cells.join(shards.select("shard", "home"), "home").select("shard", "query_id", "_x_b", "bound"), shards, size, k, factor)
    found = near.unionByName(far).where("vec_id IS NOT NULL").select("query_id", "vec_id", "score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_vantage_trees(spark, sf_dir: str) -> DataFrame:
    return nearest(common.table(spark, sf_dir, "embeddings"))
