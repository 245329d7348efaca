"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.staging import Staging

BRANCHES = 16
LEAF_ROWS = 256
ROUNDS = 8
#: Bounds of the sample of different vectors: rows, and numbers in them. One half of it builds the tree, the
#: other, which the tree doesn't know, tells how many leaves a search must visit.
SAMPLE_ROWS = 100_000
SAMPLE_NUMBERS = 4_000_000
#: Sample vectors whose neighbours are searched for that, and the recall to be reached on them.
CALIBRATION_ROWS = 512
CALIBRATION_RECALL = 0.93
#: Vectors of a leaf that one task compares at a time.
GROUP_ROWS = 4_000
#: Queries that visit a leaf and are compared with a part of it in one task.
QUERY_ROWS = 20_000
_QUERIES_AT_ONCE = 64


@dataclass
class Node:
    centers: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """In double precision; the same two vectors give the same number wherever they stand."""
    return (one[None, :] * many).sum(axis=1) / (np.sqrt((one * one).sum()) * np.sqrt((many * many).sum(axis=1)))


class Tree:
    """K-means in each node over the vectors that reached it, down to leaves of LEAF_ROWS sample vectors."""

    def __init__(self, sample: np.ndarray):
        self.leaves, self.random = 0, np.random.default_rng(0)
        self.root = self._grow(unit(sample))

    def _grow(self, vectors: np.ndarray) -> Node:
        if len(vectors) > LEAF_ROWS:
            centers = vectors[self.random.choice(len(vectors), min(BRANCHES, len(vectors)), replace=False)]
            for _ in range(ROUNDS):
                near = self._nearest(vectors, centers)
                used = np.unique(near)
                centers = np.stack([vectors[near == k].mean(axis=0) for k in used])
            near = self._nearest(vectors, centers)
            if len(np.unique(near)) > 1:
                used = np.unique(near)
                return Node(centers[used], [self._grow(vectors[near == k]) for k in used])
        self.leaves += 1
        return Node(leaf=self.leaves - 1)

    @staticmethod
    def _nearest(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
        return ((centers * centers).sum(axis=1)[None, :] - 2 * vectors @ centers.T).argmin(axis=1)

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector, down the nearest centers."""
        out = np.zeros(len(vectors), np.int64)
        stack = [(self.root, np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            if node.leaf >= 0:
                out[rows] = node.leaf
            elif len(rows):
                near = self._nearest(vectors[rows], node.centers)
                stack += [(child, rows[near == k]) for k, child in enumerate(node.children)]
        return out

    def search(self, vector: np.ndarray) -> Iterator[int]:
        """Leaves in the order of best bin first: the open node with the nearest center goes on."""
        queue, count = [(0.0, 0, self.root)], 1
        while queue:
            _, _, node = heapq.heappop(queue)
            if node.leaf >= 0:
                yield node.leaf
                continue
            gap = node.centers - vector
            for distance, child in zip((gap * gap).sum(axis=1).tolist(), node.children, strict=True):
                heapq.heappush(queue, (distance, count, child))
                count += 1


def visits(tree: Tree, sample: np.ndarray, neighbours: int) -> int:
    """The least number of leaves at which searches reach CALIBRATION_RECALL on ``sample``.

    The neighbours of some of its vectors among all of it are found by brute force; the visits widen leaf
    by leaf until enough of them lie in the visited leaves. The sample must not have built the tree. In
    the whole table neighbours are closer than in a sample of it.
    """
    vectors = unit(sample) if len(sample) else sample
    place, needed = tree.assign(vectors), []
    for row in range(min(CALIBRATION_ROWS, len(vectors))):
        nearness = vectors @ vectors[row]
        nearness[row] = -2
        best = np.argsort(-nearness)[:neighbours]
        wanted, order = set(place[best].tolist()), {}
        for turn, leaf in enumerate(tree.search(vectors[row])):
            if leaf in wanted:
                order[leaf] = turn + 1
                if len(order) == len(wanted):
                    break
        needed += [order[x] for x in place[best].tolist()]
    if not needed:
        return 1
    return int(np.sort(needed)[int(np.ceil(CALIBRATION_RECALL * len(needed))) - 1])


def usable(vector: Column, size: int | None = None) -> Column:
    """Not null, no null or non-finite component, not zero; and of that size."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = vector.isNotNull() & F.forall(vector, fine) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good if size is None else good & (F.size(vector) == size), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(float).reshape(len(column), -1)


def _nearest_in_leaf(key: tuple, members: pa.Table, queries: pa.Table, keep: int) -> pa.Table:
    """The ``keep`` nearest members of one part of a leaf for each query that visits it."""
    out: list[tuple] = []
    if members.num_rows and queries.num_rows:
        vectors, ids = _matrix(members.column("vector")), members.column("ids").to_pylist()
        lowest = np.array([x[0] for x in ids])
        searched, names = _matrix(queries.column("vector")), queries.column("query").to_pylist()
        units = unit(vectors)
        for row, (name, one) in enumerate(zip(names, searched, strict=True)):
            if row % _QUERIES_AT_ONCE == 0:
                block = units @ unit(searched[row : row + _QUERIES_AT_ONCE]).T
            rough = block[:, row % _QUERIES_AT_ONCE]
            least = np.partition(rough, -keep)[-keep] if len(rough) > keep else -2.0
            near = np.flatnonzero(rough >= least - 1e-9)
            exact = cosine(one, vectors[near])
            for k in np.lexsort((lowest[near], -exact))[:keep].tolist():
                out.append((name, float(exact[k]), ids[near[k]]))
    columns = list(zip(*out, strict=True)) or [[]] * 3
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.float64(), pa.list_(pa.int64())), strict=True)], ["query", "score", "ids"]
    )


def nearest(embeddings: DataFrame, is_query: Column, staging: Staging, neighbours: int = 5) -> DataFrame:
    """The ``neighbours`` nearest rows of each query row but itself: query_id, rank, vec_id, score.

    Vectors are compared with those of their own size, for each of which there is an index. Equal vectors are
    one entry of it with its ``neighbours`` + 1 least ids, which is all that any result can need of them; equal
    queries are searched once. Every entry lies in one leaf of a tree that is built from a bounded sample; a
    search visits as many leaves as the calibration asks for. Leaves are compared in parts, and their queries
    in blocks, of bounded size. Scores are computed from the original vectors; ties go to the smaller vec_id.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a null id.
    Repeated ids are rows of their own as candidates and one as a query. Long vectors make the sample smaller.
    Other columns are not read; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("is_query")
    )
    sizes = [r["size"] for r in rows.select(F.size("vector").alias("size")).distinct().orderBy("size").collect()]
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for size in sizes:
        result = result.unionAll(_nearest_of_size(rows.where(F.size("vector") == size), size, staging, neighbours))
    return result


def _nearest_of_size(rows: DataFrame, size: int, staging: Staging, neighbours: int) -> DataFrame:
    """``nearest`` for vectors that are all of one size."""
    spark, keep = rows.sparkSession, neighbours + 1
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The least ids of each vector, taken in two steps, so that a vector that fills the table is shared out.
    least = lambda ids: F.slice(F.array_sort(ids), 1, keep)
    some = rows.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part")).agg(
        least(F.collect_list("vec_id")).alias("ids"), F.max("is_query").alias("searched")
    )
    entries = some.groupBy("vector").agg(least(F.flatten(F.collect_list("ids"))).alias("ids"), F.max("searched").alias("searched"))
    entries = staging.table(entries.withColumn("entry", F.monotonically_increasing_id()), f"entries_{size}")
    bound = max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // size))
    sample = _matrix(entries.select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(bound).toArrow().column("vector"))
    tree = Tree(sample[::2])
    leaves_visited = visits(tree, sample[1::2], neighbours)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(unit(_matrix(batch.column(0)))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = unit(_matrix(batch.column(1))) if batch.num_rows else np.zeros((0, 1))
            for k, vector in enumerate(vectors):
                found = [leaf for leaf, _ in zip(tree.search(vector), range(leaves_visited), strict=False)]
                again = pa.array(np.full(len(found), k))
                columns = [batch.column(0).take(again), batch.column(1).take(again), pa.array(found, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["query", "vector", "leaf"])

    indexed = entries.select("vector", "ids", "entry").mapInArrow(assign, "vector array<double>, ids array<long>, entry long, leaf long")
    indexed = staging.table(indexed, f"indexed_{size}")
    split = indexed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("long").alias("parts"))
    searches = entries.where("searched").select(F.col("entry").alias("query"), "vector")
    searches = staging.table(searches.mapInArrow(visit, "query long, vector array<double>, leaf long"), f"searches_{size}")
    asked = searches.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("long").alias("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    split = staging.table(split.join(asked, "leaf"), f"split_{size}")
    members = indexed.join(split, "leaf").withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts"))).withColumn("block", each("blocks"))
    searches = searches.join(split, "leaf").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks"))).withColumn("part", each("parts"))
    found = (
        members.select("leaf", "part", "block", "vector", "ids")
        .groupBy("leaf", "part", "block")
        .cogroup(searches.select(*[F.col(c).alias(c) for c in ("leaf", "part", "block")], "query", "vector").groupBy("leaf", "part", "block"))
        .applyInArrow(lambda k, one, two: _nearest_in_leaf(k, one, two, keep), "query long, score double, ids array<long>")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    single = best.select("query", F.explode("ids").alias("vec_id"), "score")
    lists = single.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("near"))
    lists = lists.join(entries.select(F.col("entry").alias("query"), "vector"), "query")
    mine = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector").distinct().join(lists, "vector")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, neighbours)
    ranked = mine.select("query_id", F.posexplode(others).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))
