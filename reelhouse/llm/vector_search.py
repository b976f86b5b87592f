"""Nearest neighbours by inner product, through a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from reelhouse.llm.common import ship, stored

# The tree is fitted on about so many vectors and bytes, chosen by a hash; its leaves hold about LEAF_ROWS of
# all rows each, but LEAST_SAMPLED sampled ones at least.
SAMPLE, SAMPLE_BYTES = 100_000, 64 << 20
BRANCHES, LEAF_ROWS, LEAST_SAMPLED, ROUNDS = 8, 250, 12, 8
# Leaf visits are widened until so many calibration queries find this share of their exact neighbours.
CALIBRATION, RECALL = 200, 0.95
CHUNK = 4096


class Tree(NamedTuple):
    centres: np.ndarray  # of all nodes; node 0 is the root
    children: list[list[int]]
    leaf: np.ndarray  # number of a leaf node, -1 for others
    leaves: int


def usable(column: str) -> Column:
    """Vectors that take part: not null, no null or non-finite component, not zero."""
    x = F.col(column).cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.col(column).isNotNull() & (F.size(x) > 0) & F.coalesce(good, F.lit(False)) & F.exists(x, lambda v: v != 0)


def fit_tree(x: np.ndarray, most: int) -> Tree:
    """Split the sample into BRANCHES clusters again and again until a cluster has at most ``most`` vectors."""
    rng = np.random.default_rng(0)
    centres, children, leaf = [x.mean(0)], [[]], [-1]
    todo, leaves = [(0, np.arange(len(x)))], 0
    while todo:
        node, rows = todo.pop()
        own = x[rows]
        found = _k_means(own, rng) if len(rows) > most else None
        if found is None:
            leaf[node], leaves = leaves, leaves + 1
            continue
        means, label = found
        for k in range(len(means)):
            centres.append(means[k])
            children.append([])
            leaf.append(-1)
            children[node].append(len(centres) - 1)
            todo.append((len(centres) - 1, rows[label == k]))
    return Tree(np.array(centres, np.float32), children, np.array(leaf), leaves)


def _k_means(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Means and labels of at least two clusters, none empty; None if the vectors are all equal."""
    means = np.unique(x[rng.choice(len(x), min(BRANCHES, len(x)), replace=False)], axis=0)
    if len(means) == 1:
        other = x[(x != means[0]).any(1)]
        if not len(other):
            return None
        means = np.vstack([means, other[:1]])
    for _ in range(ROUNDS):
        label = _nearest(x, means)
        used = np.unique(label)
        means = np.array([x[label == k].mean(0) for k in used])
    label = _nearest(x, means)
    used, label = np.unique(label, return_inverse=True)
    return (means[used], label) if len(used) > 1 else None


def _nearest(x: np.ndarray, means: np.ndarray) -> np.ndarray:
    return (x @ means.T - (means**2).sum(1) / 2).argmax(1)


def leaf_of(x: np.ndarray, tree: Tree) -> np.ndarray:
    """The leaf each vector falls into, by the nearest centre at every level."""
    node, found = np.zeros(len(x), np.int64), np.empty(len(x), np.int64)
    for at in range(len(tree.children)):  # children come after their parents
        rows = np.flatnonzero(node == at)
        if len(rows) and tree.children[at]:
            kids = np.array(tree.children[at])
            node[rows] = kids[_nearest(x[rows], tree.centres[kids])]
        elif len(rows):
            found[rows] = tree.leaf[at]
    return found


def best_bins(query: np.ndarray, tree: Tree, visits: int) -> list[int]:
    """The first ``visits`` leaves met when the node of the largest product of centre and query goes first."""
    found, queue = [], [(0.0, 0)]
    while queue and len(found) < visits:
        _, node = heapq.heappop(queue)
        if not tree.children[node]:
            found.append(int(tree.leaf[node]))
            continue
        kids = tree.children[node]
        for kid, score in zip(kids, (tree.centres[kids] @ query).tolist(), strict=True):
            heapq.heappush(queue, (-score, kid))
    return found


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def distinct_vectors(vectors: DataFrame, most: int) -> DataFrame:
    """(rep, ids, vector): each different vector once, with its smallest id and its ``most`` smallest ids.

    Of equal vectors no search can return more than its k smallest ids and the query's own. Ids are
    limited where they are read, so a vector held by a third of all rows stays small.
    """
    ranked = vectors.withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("n") <= most)
    return ranked.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _bytes(frame: DataFrame, width: int) -> DataFrame:
    """The vectors as doubles in bytes, which Python reads without conversion."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("vector")
            x = np.asarray(batch.column(at).flatten(), dtype="<f8").reshape(-1, width)
            yield batch.set_column(at, "vector", pa.array([row.tobytes() for row in x], pa.binary()))

    schema = ", ".join(f"{n} {'binary' if n == 'vector' else t}" for n, t in frame.dtypes)
    return frame.mapInArrow(pack, schema)


def _top(scores: np.ndarray, ids: np.ndarray, keep: int) -> list[list[tuple[float, int]]]:
    """For each row of scores the ``keep`` best (-score, id), ties to the smaller id."""
    found = []
    if scores.shape[1] > keep:
        near = np.argpartition(-scores, keep, axis=1)[:, :keep]
        least = np.take_along_axis(scores, near, 1).min(1)
        tied = (scores >= least[:, None]).sum(1) > keep
    else:
        near, tied = np.broadcast_to(np.arange(scores.shape[1]), scores.shape), np.zeros(len(scores), bool)
    for row, columns in enumerate(near):
        if tied[row]:
            columns = np.flatnonzero(scores[row] >= least[row])
        found.append(sorted(zip((-scores[row, columns]).tolist(), ids[columns].tolist(), strict=True))[:keep])
    return found


def _compared(left: pd.DataFrame, right: pd.DataFrame, width: int, keep: int) -> Iterator[tuple[int, list]]:
    """Products of the queries with all vectors of one block: (query, its best ids)."""
    x = np.frombuffer(b"".join(right["vector"]), "<f8").reshape(-1, width)
    copies = np.array([len(i) for i in right["ids"]])
    ids, x = np.concatenate(list(right["ids"])), np.repeat(x, copies, axis=0)
    for start in range(0, len(left), 256):
        part = left.iloc[start:start + 256]
        scores = np.frombuffer(b"".join(part["vector"]), "<f8").reshape(-1, width) @ x.T
        yield from zip(part["query"], _top(scores, ids, keep), strict=True)


def search(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each query among all other rows, by inner product.

    Rows without a usable vector, or whose vector is not as long as most, take no part, and neither do
    rows without an id. Equal vectors are searched once and share their result, each query leaving
    itself out. Every row is in the tree's leaves; how many leaves a query visits is calibrated
    against exact results over all rows. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(ArrayType(vectors.schema[vector].dataType.elementType)).alias("vector"), is_query.alias("is_query"))
    width = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").head()
    result = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return spark.createDataFrame([], result)
    width = width.width
    rows = rows.where(F.size("vector") == width)
    different = stored(_bytes(distinct_vectors(rows.select("vec_id", "vector"), k + 1), width), "vectors")
    total = different.count()
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    size = min(SAMPLE, SAMPLE_BYTES // (width * 8))
    sampled = different.where(place < size / total).orderBy("rep").toPandas()
    sampled = sampled if len(sampled) else different.limit(1).toPandas()
    x = np.frombuffer(b"".join(sampled["vector"]), "<f8").reshape(-1, width)[:2 * size]
    tree = fit_tree(x.astype(np.float32), max(LEAST_SAMPLED, int(LEAF_ROWS * len(x) / total)))
    shared = spark.sparkContext.broadcast(tuple(tree))

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree(*shared.value)
        for batch in batches:
            leaf = leaf_of(_matrix(batch.column(2), "<f8", width).astype(np.float32), own) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["rep", "ids", "vector", "leaf"])

    index = stored(different.select("rep", "ids", "vector").mapInArrow(place_rows, "rep long, ids array<long>, vector binary, leaf long"), "leaves")
    queries = rows.where("is_query").select("vec_id", "vector").join(
        rows.groupBy("vector").agg(F.min("vec_id").alias("rep")), "vector").select("vec_id", "rep")
    queries = stored(queries.select(F.col("vec_id").alias("query_id"), "rep"), "vector-queries")
    wanted = index.join(queries.select("rep").distinct(), "rep", "left_semi").select(F.col("rep").alias("query"), "vector")
    visits = _calibrate(index, wanted, tree, shared, width, k, recall)
    best = _search_leaves(index, wanted, shared, tree.leaves, width, visits, k + 1)
    found = queries.join(best, queries["rep"] == best["query"]).select("query_id", F.posexplode(F.filter("best", lambda b: b["id"] != F.col("query_id"))).alias("pos", "b"))
    return found.where(F.col("pos") < k).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.cost")).alias("score"))


def _calibrate(index: DataFrame, wanted: DataFrame, tree: Tree, shared, width: int, k: int, recall: float) -> int:
    """Leaf visits that find ``recall`` of the exact neighbours of CALIBRATION queries, sought among all rows block by block."""
    some = wanted.orderBy(F.xxhash64("query"), "query").limit(CALIBRATION).toPandas()
    if not len(some):
        return 1
    q = np.frombuffer(b"".join(some["vector"]), "<f8").reshape(-1, width)
    asked = index.sparkSession.sparkContext.broadcast(q)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in range(len(asked.value))]
        for batch in batches:
            if batch.num_rows:
                scores = asked.value @ _matrix(batch.column(2), "<f8", width).T
                leaf, sizes = batch.column(3).to_numpy(), np.diff(np.asarray(batch.column(1).offsets))
                for i, own in enumerate(scores):
                    near = np.argsort(-own, kind="stable")[:k + 1]
                    best[i] = sorted(best[i] + [(float(own[j]), int(leaf[j]), int(sizes[j])) for j in near], reverse=True)[:k + 1]
        flat = [(i, *b) for i, own in enumerate(best) for b in own]
        yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in flat], t) for c, t in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.int64()))], ["query", "score", "leaf", "size"])

    near = index.mapInArrow(exact, "query long, score double, leaf long, size long")
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "leaf"))).where(F.col("n") <= k + 1)
    order = [{leaf: n for n, leaf in enumerate(best_bins(v.astype(np.float32), tree, tree.leaves))} for v in q]
    needed = np.sort([order[r.query][r.leaf] + 1 for r in ranked.select("query", "leaf").collect()])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])


def _search_leaves(index: DataFrame, wanted: DataFrame, shared, leaves: int, width: int, visits: int, keep: int) -> DataFrame:
    """(query, best): the best ids of each query over the leaves it visits.

    Neighbouring leaves make a block of about CHUNK rows, a larger leaf several blocks; a query meets the whole of each
    block in which it visits a leaf. The queries of a block are dealt out in chunks of about CHUNK too.
    """
    spark = index.sparkSession
    rows = {r.leaf: r["count"] for r in index.groupBy("leaf").count().collect()}  # one row per leaf of the tree
    first, parts, block, held = np.zeros(leaves, np.int64), np.ones(leaves, np.int64), 0, 0
    for leaf in range(leaves):
        n = rows.get(leaf, 0)
        if held and held + n > CHUNK:
            block, held = block + 1, 0
        first[leaf], parts[leaf] = block, max(1, -(-n // CHUNK))
        held += n
        if parts[leaf] > 1:
            block, held = block + int(parts[leaf]), 0
    places = spark.sparkContext.broadcast((first, parts))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (first, parts) = Tree(*shared.value), places.value
        for batch in batches:
            if batch.num_rows:
                blocks = []
                for v in _matrix(batch.column(1), "<f8", width).astype(np.float32):
                    bins = best_bins(v, own, visits)
                    blocks.append(sorted({int(first[b]) + i for b in bins for i in range(int(parts[b]))}))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.list_(pa.int64()))], ["query", "vector", "blocks"])

    asked = stored(wanted.mapInArrow(visit, "query long, vector binary, blocks array<long>"), "visits")
    each = asked.select("query", "vector", F.explode("blocks").alias("block"))
    cut = each.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("pieces"))
    leaf_blocks = F.broadcast(spark.createDataFrame([(leaf, int(first[leaf]), int(parts[leaf])) for leaf in range(leaves)], "leaf long, first long, parts long"))
    left = each.join(cut, "block").withColumn("j", F.pmod(F.xxhash64("query"), F.col("pieces")).cast("int"))
    placed = index.join(leaf_blocks, "leaf").withColumn("block", F.col("first") + F.pmod(F.xxhash64("rep"), F.col("parts")))
    right = placed.join(cut, "block").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = list(_compared(left, right, width, keep)) if len(left) and len(right) else []
        return pd.DataFrame({"query": [q for q, _ in found], "best": [[{"cost": c, "id": i} for c, i in b] for _, b in found]})

    on = ["block", "j"]
    blocks = left.select(*on, "query", "vector").groupBy(*on).cogroup(right.select(*on, "ids", "vector").groupBy(*on)) \
        .applyInPandas(meet, "query long, best array<struct<cost:double,id:long>>")
    return blocks.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, keep).alias("best"))
