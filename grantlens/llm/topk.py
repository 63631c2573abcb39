"""Exact nearest vectors by inner product with a KD-tree per shard.

Vectors are turned into integers, equal vectors become one point that keeps as many of its smallest
ids as can ever be returned, and the points are dealt to shards of bounded size. Each shard is a
KD-tree: median splits on the widest side, every node with the tight box around its points. A query
visits nodes in the order of the largest inner product its box allows and stops at its kth score so
far. That score is passed on: a first look at one shard gives each query a kth score that no
later shard has to fall below.

Queries travel in blocks of bounded size; each block meets each shard once, as arrays. Null
vectors, vectors holding null or non-finite components, and rows without id take no part. Vectors
of different lengths have no product and are searched apart. Equal scores go to the smaller id.
Repeated ids are separate rows with the same id, and a query leaves out all rows of its own id.
An empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.common import stored

SCALE = 1024
K = 10
LEAF = 64
SHARD_POINTS = 8192
QUERY_BLOCK = 1024


class Tree:
    """Points in leaf order, and for each node its box, its children or its range of points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.members: list[np.ndarray | None] = []
        waiting = [(np.arange(len(points)), None, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            node = len(self.low)
            own = points[rows]
            low, high = own.min(axis=0), own.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            if parent is not None:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            widest = int(np.argmax(high - low))
            if len(rows) <= leaf or low[widest] == high[widest]:
                self.children.append(None)
                self.members.append(rows)
                continue
            self.children.append((0, 0))
            self.members.append(None)
            order = rows[np.argsort(own[:, widest], kind="stable")]
            waiting += [(order[len(rows) // 2:], node, 1), (order[:len(rows) // 2], node, 0)]
        self.boxes = np.array(self.low), np.array(self.high)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The largest product of each node's box with the query."""
        low, high = self.boxes
        return np.maximum(low * query, high * query).sum(axis=1)

    def search(self, query: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Points and scores not below the kth best score or ``least``, whichever is higher."""
        bounds = self.bounds(query)
        queue = [(-bounds[0], 0)]
        best: list[int] = []  # a heap of the k highest scores
        rows, scores = [], []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least:
                break
            pair = self.children[node]
            if pair:
                for child in pair:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            found = self.points[self.members[node]] @ query
            good = found >= least
            rows.append(self.members[node][good])
            scores.append(found[good])
            for score in np.sort(found[good])[::-1][:k].tolist():
                if len(best) < k:
                    heapq.heappush(best, score)
                elif score > best[0]:
                    heapq.heapreplace(best, score)
                else:
                    break
            if len(best) == k:
                least = max(least, best[0])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, scores = np.concatenate(rows), np.concatenate(scores)
        keep = scores >= least
        return rows[keep], scores[keep]


def integer_vectors(table: DataFrame, id_column: str = "vec_id", column: str = "embedding",
                    scale: int = SCALE) -> DataFrame:
    """vec_id and the vector's components as floor(scale * x), bad vectors left out."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return table.where(F.col(id_column).isNotNull() & F.col(column).isNotNull()).where(good).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("vector"),
    )


def _packed(rows: pd.Series) -> bytes:
    return np.array(rows.tolist(), dtype="<i8").tobytes()


def shards_of(vectors: DataFrame, k: int, size: int) -> DataFrame:
    """dims, shard, points (bytes), ids: lists of the k + 1 smallest ids of each point."""
    points = (
        vectors.groupBy("vector", "vec_id").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("turn", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id")))
        .where(F.col("turn") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list(F.struct("vec_id", F.least("n", F.lit(k + 1)).alias("n")))).alias("ids"))
        .select(F.size("vector").alias("dims"), "vector", F.transform("ids", lambda x: x["vec_id"]).alias("ids"),
                F.transform("ids", lambda x: x["n"]).alias("copies"))
    )
    points = stored(points, "points")
    parts = max(1, -(-points.count() // size))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dims": group["dims"].iloc[:1], "shard": group["shard"].iloc[:1],
                             "points": [_packed(group["vector"])],
                             "ids": [_ragged(group["ids"])], "copies": [_ragged(group["copies"])]})

    return points.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(parts))).groupBy("dims", "shard").applyInPandas(
        join, "dims int, shard long, points binary, ids array<array<long>>, copies array<array<long>>"
    )


def _ragged(lists: pd.Series) -> list[list[int]]:
    return [np.asarray(x).tolist() for x in lists]


def blocks_of(vectors: DataFrame, size: int) -> DataFrame:
    """dims, block, queries (bytes), query_ids: the queries in blocks of about ``size``."""
    queries = stored(vectors.select(F.size("vector").alias("dims"), "vec_id", "vector"), "queries")
    parts = max(1, -(-queries.count() // size))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dims": group["dims"].iloc[:1], "block": group["block"].iloc[:1],
                             "queries": [_packed(group["vector"])], "query_ids": [group["vec_id"].tolist()]})

    return queries.dropDuplicates(["vec_id", "vector"]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts))
    ).groupBy("dims", "block").applyInPandas(join, "dims int, block long, queries binary, query_ids array<long>")


def _search(k: int):
    """Rows of a shard with a block of queries and the scores these have to reach, to their best matches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, tree = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if known != (row.dims, row.shard):
                    tree = Tree(np.frombuffer(row.points, "<i8").reshape(-1, row.dims))
                    known = (row.dims, row.shard)
                out: list[tuple] = []
                queries = np.frombuffer(row.queries, "<i8").reshape(-1, row.dims)
                for number, (query, own, least) in enumerate(zip(queries, row.query_ids, row.least, strict=True)):
                    # one point more than k: a point may hold the query's own row and no other
                    points, scores = tree.search(query, k + 1, least)
                    hits = [(-s, i) for p, s in zip(points.tolist(), scores.tolist(), strict=True)
                            for i, n in zip(row.ids[p], row.copies[p], strict=True) if i != own for _ in range(n)]
                    out.extend((row.dims, row.block, number, own, i, -s) for s, i in heapq.nsmallest(k, hits))
                yield pd.DataFrame(out, columns=["dims", "block", "number", "query_id", "vec_id", "score"])

    return run


_FOUND = "dims int, block long, number int, query_id long, vec_id long, score long"
_NO_SCORE = float(-(1 << 62))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard_points: int = SHARD_POINTS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs as ``integer_vectors`` gives them."""
    shards = stored(shards_of(vectors, k, shard_points), "shards")
    blocks = stored(blocks_of(queries, query_block), "query-blocks")
    # one row for each length of vectors
    numbers = shards.groupBy("dims").agg(F.collect_set("shard").alias("shards"))
    nothing = F.transform("query_ids", lambda x: F.lit(_NO_SCORE))
    first = (
        blocks.join(numbers, "dims").withColumn("shard", F.array_min("shards")).drop("shards")
        .withColumn("least", nothing)
        .join(shards, ["dims", "shard"]).mapInPandas(_search(k), _FOUND)
    )
    # the kth score of the first shard, for the queries that have k matches there
    bars = (
        first.groupBy("dims", "block", "number").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        .where(F.col("n") == k)
        .groupBy("dims", "block").agg(F.map_from_entries(F.collect_list(F.struct("number", "least"))).alias("bars"))
    )
    at = F.sequence(F.lit(0), F.size("query_ids") - 1)
    barred = blocks.join(bars, ["dims", "block"], "left").withColumn(
        "least", F.transform(at, lambda i: F.coalesce(F.element_at("bars", i).cast("double"), F.lit(_NO_SCORE)))
    ).drop("bars")
    # every block meets every shard, dealt by shard
    pairs = stored(barred, "barred").join(numbers, "dims").withColumn("shard", F.explode("shards")).drop("shards")
    found = pairs.join(shards, ["dims", "shard"]).mapInPandas(_search(k), _FOUND)
    best = Window.partitionBy("dims", "block", "number").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
