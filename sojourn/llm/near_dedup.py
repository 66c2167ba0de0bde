"""Operator 10: near-duplicates by an LSH forest of MinHash signatures, confirmed on whole shingle sets.

Documents with equal sets are one node. A node's signature is put in order TREES times, each time
rotated further; nodes that share DEPTH values in an order share a region. A region with more than
REGION nodes is parted by a longer prefix, as deep as it takes. In each region, nodes are sorted by
the rest of the signature and neighbours, whose common prefix is longest, are candidates; the heads
of a parted region are candidates with its least node. Candidates whose signatures agree enough are
confirmed on their sets.

That leaves links between nodes that share a prefix of DEPTH values but were not neighbours. Where
such a bucket still holds several components, nodes outside its largest one meet all others of the
bucket, block by block, on their sets, and what links two components is kept. So no link is
lost within a bucket, no task holds a group, and a group emits no more links than it has nodes. Two
sets of similarity 0.85 share no bucket with a chance of 8e-6.

Cases: a null text is empty; texts without words have empty sets, link with nothing and are their
own component; below SHINGLE words the whole sequence is the one shingle; a null doc_id takes
part, but its component's id is the least that is not null, null if there is none, and kept says whether
a row's id is that one, so rows alike in id are one answer each; deduplicate takes one row a component and
keeps other columns; an empty table gives an empty table. Nodes are told apart by 64-bit sums over sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common

SHINGLE = 5
TREES = 16
DEPTH = 4
HASHES = TREES * DEPTH
PERCENT = 85
#: Equal values of HASHES from which a pair is confirmed on sets; 0.85 * 64 less five standard deviations.
AGREE = 40
REGION = 1000
BLOCK = 512

_RANDOM = np.random.Generator(np.random.PCG64(10))
_FACTORS = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within each, and the rows' offsets among them."""
    _, _, hashes, rows = common.words(data, offsets, lower=True)
    sizes = np.diff(rows)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, 0)
    at = np.repeat(rows[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    found = common.grams(hashes, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sizes)), counts)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        one = np.array([common.grams(hashes[rows[i] : rows[i + 1]], int(sizes[i]))[0] for i in short], np.uint64)
        found, row = np.concatenate([found, one]), np.concatenate([row, short])
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    found, row = found[new], row[new]
    return found, np.searchsorted(row, np.arange(len(sizes) + 1))


def signatures(found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row with shingles, its 64-bit set key and HASHES minima as big-endian 32-bit numbers."""
    starts = at[:-1][np.diff(at) > 0]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros((0, HASHES), ">u4")
    keys = np.add.reduceat(common.mix(found, 77), starts)
    out = np.empty((len(starts), HASHES), ">u4")
    for j in range(HASHES):
        out[:, j] = np.minimum.reduceat((found * _FACTORS[j] + _SHIFTS[j]) >> np.uint64(32), starts)
    return common.mix(keys), out


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, node, sig of every row; node and sig null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes, node, sig = np.zeros(n, np.int64), np.zeros(n, np.int64), [None] * n
            for first, _, data, offsets in common.slices(batch.column(2), 1 << 19):
                found, at = shingles(data, offsets)
                keys, minima = signatures(found, at)
                sizes[first : first + len(at) - 1] = np.diff(at)
                full = first + np.flatnonzero(np.diff(at))
                node[full] = keys.view(np.int64)
                for i, values in zip(full.tolist(), minima, strict=True):
                    sig[i] = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes), pa.array(node, mask=sizes == 0), pa.array(sig, pa.binary())], names=["doc_id", "key", "n_shingles", "node", "sig"]
            )

    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, k) for n, k in (("key", T.BinaryType()), ("n_shingles", T.LongType()), ("node", T.LongType()), ("sig", T.BinaryType())))])
    text = common.text_or_empty()
    return docs.select("doc_id", F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text")).mapInArrow(run, schema)


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, items: the whole shingle sets of the nodes, from the text of one document each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in common.slices(batch.column(1)):
                found, at = shingles(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(found.view(np.int64)))], names=["node", "items"])

    text = common.text_or_empty()
    bodies = docs.select(F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))
    found = bodies.join(nodes.select("node", F.col("key").alias("node_key")), F.col("key") == F.col("node_key"))
    return common.stage(found.select("node", "text").dropDuplicates(["node"]).mapInArrow(run, "node long, items array<long>"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b that are links on their whole sets."""
    with_a = pairs.select("a", "b").join(sets.toDF("a_node", "a_items"), F.col("a") == F.col("a_node")).select("a", "b", "a_items")
    with_b = with_a.join(sets.toDF("b_node", "b_items"), F.col("b") == F.col("b_node"))
    both = F.size(F.array_intersect("a_items", "b_items"))
    return with_b.where(100 * both >= PERCENT * (F.size("a_items") + F.size("b_items") - both)).select("a", "b")


def _likely(pairs: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in AGREE values or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("a_sig", "b_sig"))
            yield batch.select(["a", "b", "tree"]).filter(pa.array((a == b).sum(1) >= AGREE))

    return pairs.select("a", "b", "tree", "a_sig", "b_sig").mapInArrow(run, "a long, b long, tree int")


def _prefix(depth: int):
    """Hash of the first depth values of the order."""
    twice = F.concat("sig", "sig")
    return F.xxhash64("tree", F.substring(twice, F.col("tree") * 4 * DEPTH + 1, F.lit(4 * depth)))


def _neighbours(members: DataFrame) -> DataFrame:
    """a, b, tree: candidates of every region, likely on signatures. members: bucket, size, node, tree, sig."""
    rest = F.substring(F.concat("sig", "sig"), F.col("tree") * 4 * DEPTH + 1 + 4 * DEPTH, F.lit(4 * (HASHES - DEPTH)))
    members = members.withColumn("rest", rest)
    regions = members.where(F.col("size") <= REGION).withColumn("region", F.col("bucket"))
    # a larger bucket is parted by a longer prefix, and what is alike to that depth by hash
    heavy = members.where(F.col("size") > REGION)
    deep = F.when(F.col("size") > REGION * REGION, _prefix(HASHES)).when(F.col("size") > 8 * REGION, _prefix(4 * DEPTH)).otherwise(_prefix(2 * DEPTH))
    heavy = heavy.withColumn("deep", deep)
    alike = common.stage(heavy.groupBy(F.col("deep").alias("of_deep")).agg(F.ceil(F.count(F.lit(1)) / REGION).alias("parts")), "deep")
    heavy = heavy.join(alike, F.col("deep") == F.col("of_deep")).withColumn("region", F.xxhash64("deep", F.pmod(F.xxhash64("node"), "parts")))
    regions = regions.unionByName(heavy.drop("deep", "of_deep", "parts"))
    order = Window.partitionBy("region", "tree", "bucket").orderBy("rest", "node")
    sorted_ = regions.withColumns({"b": F.lag("node").over(order), "b_sig": F.lag("sig").over(order)})
    near = sorted_.where("b IS NOT NULL").select(F.col("node").alias("a"), "b", "tree", F.col("sig").alias("a_sig"), "b_sig")
    heads = sorted_.where((F.col("size") > REGION) & F.col("b").isNull()).select("bucket", "node", "tree", "sig")
    least = heads.groupBy(F.col("bucket").alias("least_of")).agg(F.min_by(F.struct("node", "sig"), "node").alias("least"))
    first = heads.join(least, F.col("bucket") == F.col("least_of")).where(F.col("node") != F.col("least.node"))
    first = first.select(F.col("node").alias("a"), F.col("least.node").alias("b"), "tree", F.col("sig").alias("a_sig"), F.col("least.sig").alias("b_sig"))
    found = _likely(near.unionByName(first))
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("tree").alias("tree"))


def _between(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links between different components of one bucket, enough of them to join what is linked there.

    Per block, an index from items to rows counts the items that a node shares with every row at
    once; a component joined to the node's is not compared again. Items are whole, so that a link
    that joins components here is one.
    """
    spark = members.sparkSession
    member = members.join(roots.toDF("root_node", "root"), F.col("node") == F.col("root_node"), "left").select("bucket", "node", F.coalesce("root", "node").alias("comp"))
    member = common.stage(member, "members")
    per = member.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = per.groupBy(F.col("bucket").alias("mixed")).agg(F.sum("c").alias("total"), F.max(F.struct("c", "comp")).alias("major"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    mixed = mixed.select("mixed", F.col("major.comp").alias("major"), F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("total") - F.col("major.c")) / BLOCK).cast("int").alias("chunks"))
    rows = member.join(mixed, F.col("bucket") == F.col("mixed")).drop("mixed")
    minor = rows.where("comp <> major").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), "chunks").cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), "blocks").cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    columns = ["bucket", "chunk", "block", "node", "comp"]
    dealt = minor.select(*columns, F.lit(True).alias("minor")).unionByName(every.select(*columns, F.lit(False).alias("minor")))
    bins = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.withColumn("bin", F.when((F.col("chunk") == 0) & (F.col("block") == 0), F.pmod(F.xxhash64("bucket"), F.lit(16 * bins))).otherwise(F.xxhash64("bucket", "chunk", "block")))
    dealt = dealt.join(sets.select(F.col("node").alias("set_node"), "items"), F.col("node") == F.col("set_node")).drop("set_node")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = [table[c].to_numpy() for c in ("bucket", "chunk", "block", "node", "comp")]
        node, comp = ids[3], ids[4]
        minor, items = table["minor"].to_numpy(zero_copy_only=False), table["items"].combine_chunks()
        starts, flat = items.offsets.to_numpy(), items.values.to_numpy()
        sizes = np.diff(starts)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                x = up
            return x

        order = np.lexsort((ids[2], ids[1], ids[0]))
        edge = np.flatnonzero(np.any([np.diff(x[order], prepend=x[order][:1] - 1) != 0 for x in ids[:3]], axis=0))
        out: list[tuple[int, int]] = []
        for lo, hi in zip(edge, [*edge[1:], len(order)], strict=True):
            here = order[lo:hi]
            left, right = here[minor[here]], here[~minor[here]]
            if not len(left) or not len(right):
                continue
            row = np.repeat(np.arange(len(right)), sizes[right])
            item = np.concatenate([flat[starts[r] : starts[r + 1]] for r in right])
            by = np.argsort(item, kind="stable")
            item, row = item[by], row[by]
            for i in left.tolist():
                own = flat[starts[i] : starts[i + 1]]
                first, last = np.searchsorted(item, own, "left"), np.searchsorted(item, own, "right")
                spans = last - first
                at = np.repeat(last - np.cumsum(spans), spans) + np.arange(spans.sum())
                both = np.bincount(row[at], minlength=len(right))
                linked = right[(100 * both >= PERCENT * (sizes[i] + sizes[right] - both)) & (comp[right] != comp[i])]
                for j in linked.tolist():
                    a, b = root(int(comp[i])), root(int(comp[j]))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    found = dealt.groupBy("bin").applyInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; key (md5 of the text) to find its text by, root (null without words) to tell components without ids apart."""
    signed = common.stage(_signed(docs), "signed")
    least = F.min(F.struct("key", "sig", "n_shingles"))
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), least.alias("l"))
    nodes = common.stage(nodes.select("node", "rep", "l.key", "l.sig", "l.n_shingles"), "nodes")
    in_trees = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select("node", "tree", _prefix(DEPTH).alias("bucket"))
    shared = in_trees.groupBy(F.col("bucket").alias("of")).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = common.stage(shared, "buckets")  # written, so that a join splits a bucket of very many nodes
    members = in_trees.join(shared, F.col("bucket") == F.col("of")).select("node", "tree", "bucket", "size")
    members = common.stage(members.join(nodes.select(F.col("node").alias("own"), "sig"), F.col("node") == F.col("own")).drop("own"), "members")

    pairs = common.stage(_neighbours(members), "pairs")
    # only nodes that share a bucket can link
    sets = _sets(docs, nodes.join(members.select(F.col("node").alias("wanted")), F.col("node") == F.col("wanted"), "left_semi"))
    links = common.stage(_confirmed(pairs, sets), "links")
    roots = common.stage(common.components(links), "roots")
    more = _confirmed(common.stage(_between(members, roots, sets), "between"), sets)
    roots = common.stage(common.components(links.unionAll(more)), "roots")

    rooted = nodes.select("node", "rep").join(roots.toDF("root_node", "root"), F.col("node") == F.col("root_node"), "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    ids = rooted.groupBy(F.col("root").alias("of_root")).agg(F.min("rep").alias("component"))
    named = rooted.join(ids, F.col("root") == F.col("of_root")).select(F.col("node").alias("named"), "component", "root")
    out = signed.join(named, F.col("node") == F.col("named"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "key", "root")


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs without near-duplicates: of each component one row, of the least id and then md5 of its text; all columns as they were.

    Null ids come last; a component of null ids keeps a row, too. Texts without words fold only where id and text are equal. A row is known by its id and its text's md5. Texts move once, to the decisions about them.
    """
    rows = near_duplicates(docs)
    alone = [F.when(F.col("root").isNull(), F.col(c)).alias(f"_x_{c}_alone") for c in ("doc_id", "key")]
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("_x_least")
    kept = rows.groupBy("root", *alone).agg(least).select(F.col("_x_least.doc_id").alias("_x_id"), F.col("_x_least.key").alias("_x_key"))
    named = docs.withColumn("_x_own", F.unhex(F.md5(common.text_or_empty().cast("binary"))))
    found = named.join(kept, (F.col("_x_own") == F.col("_x_key")) & F.col("doc_id").eqNullSafe(F.col("_x_id")), "left_semi")
    return found.dropDuplicates(["doc_id", "_x_own"]).select(*docs.columns)


def op10_lsh_forest(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("key", "root")
