"""Exact top-k inner-product search with cover trees over queries and data.

Vectors are dealt into blocks; each block becomes a cover tree, whose nodes hold a centre, the covering
radius and their points. For a pair of nodes with centres q and p and radii r and s, no inner product between
their points exceeds <q, p> + |q| s + |p| r + r s, so the pair is dropped when that bound is below the worst
k-th score among the queries of the node. Blocks of queries meet blocks of data by a join on a group number,
and the groups' best rows are merged.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.rows import small_batches
from lonja.session import materialized

TOP = 5
DATA_BLOCK = 4096
QUERY_BLOCK = 1024
#: Data blocks that one task searches one after the other for a block of queries.
GROUP_BLOCKS = 4
#: Points of a node that is not divided, and most children of one that is. In many dimensions all distances are
#: alike, and halving the radius would make every point a child of its own.
LEAF = 256
CHILDREN = 32
#: Stands for a null id, which comes after every other in a tie.
LAST = 2**63 - 1


@dataclass
class Tree:
    """Points in tree order; node arrays in preorder. ``child`` of node i: nodes ``first[i]`` to ``stop[i]``."""

    ids: np.ndarray
    uids: np.ndarray
    points: np.ndarray
    centre: np.ndarray  # row of each node's centre in ``points``
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[list[int]]
    norms: np.ndarray


def build(ids: np.ndarray, uids: np.ndarray, points: np.ndarray) -> Tree:
    """Cover tree: the children of a node are centres far apart whose covering radii take in all its points.

    Centres are added farthest first until each point is within half the node's radius of one, or there are
    ``CHILDREN`` of them.
    """
    order, centre, radius, low, high, children = [], [], [], [], [], []

    def grow(members: np.ndarray, middle: int) -> int:
        node = len(centre)
        gap = np.sqrt(((points[members] - points[middle]) ** 2).sum(axis=1))
        reach = float(gap.max())
        centre.append(middle)
        radius.append(reach)
        low.append(len(order))
        high.append(0)
        children.append([])
        if len(members) <= LEAF or reach == 0:
            order.extend(members.tolist())
        else:
            owner, near, heads = np.zeros(len(members), np.int64), gap.copy(), [middle]
            while near.max() > reach / 2 and len(heads) < CHILDREN:
                far = int(near.argmax())
                away = np.sqrt(((points[members] - points[members[far]]) ** 2).sum(axis=1))
                closer = away < near
                owner[closer], near[closer] = len(heads), away[closer]
                heads.append(int(members[far]))
            for turn, head in enumerate(heads):
                own = members[owner == turn]
                if len(own):
                    children[node].append(grow(own, head))
        high[node] = len(order)
        return node

    grow(np.arange(len(ids)), 0)
    order = np.array(order)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    points = points[order]
    return Tree(ids[order], uids[order], points, place[centre], np.array(radius), np.array(low), np.array(high), children,
                np.sqrt((points**2).sum(axis=1)))


class Search:
    """Best rows so far of one tree of queries."""

    def __init__(self, queries: Tree, top: int):
        self.queries, self.top = queries, top
        n = len(queries.ids)
        self.score = np.full((n, top), -np.inf)
        self.id = np.full((n, top), LAST)
        self.uid = np.full((n, top), -1, np.int64)
        # Above 2^53 sums of products in doubles are not exact; integers of any size then take their place.
        self.largest = float(np.abs(queries.points).max()) if queries.points.size else 0.0

    def add(self, data: Tree) -> None:
        width = data.points.shape[1]
        largest = float(np.abs(data.points).max()) if data.points.size else 0.0
        self.exact = self.largest * largest * max(1, width) < 2**53
        self.data = data
        self._pair(0, 0)

    def _bound(self, q: int, p: int) -> float:
        a, b = self.queries, self.data
        i, j = a.centre[q], b.centre[p]
        value = a.points[i] @ b.points[j] + a.norms[i] * b.radius[p] + b.norms[j] * a.radius[q] + a.radius[q] * b.radius[p]
        return value + 1e-9 * (1 + abs(value))

    def _pair(self, q: int, p: int) -> None:
        a, b = self.queries, self.data
        worst = self.score[a.low[q] : a.high[q], -1].min()
        if self._bound(q, p) < worst:
            return
        kids_q, kids_p = a.children[q], b.children[p]
        if not kids_q and not kids_p:
            self._leaf(q, p)
        elif kids_p and (not kids_q or b.radius[p] >= a.radius[q]):
            heads = b.points[b.centre[kids_p]] @ a.points[a.centre[q]] + a.norms[a.centre[q]] * b.radius[kids_p]
            for turn in np.argsort(-heads, kind="stable"):
                self._pair(q, kids_p[turn])
        else:
            for kid in kids_q:
                self._pair(kid, p)

    def _leaf(self, q: int, p: int) -> None:
        a, b = self.queries, self.data
        rows, cols = slice(a.low[q], a.high[q]), slice(b.low[p], b.high[p])
        if self.exact:
            values = a.points[rows] @ b.points[cols].T
        else:
            values = np.array([[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b.points[cols]] for u in a.points[rows]], object)
        own = a.uids[rows][:, None] == b.uids[cols][None, :]
        for i in np.flatnonzero(((values >= self.score[rows, -1:]) & ~own).any(axis=1)):
            row = a.low[q] + i
            pick = np.flatnonzero((values[i] >= self.score[row, -1]) & ~own[i])
            if self.exact and len(pick) > self.top:
                fifth = np.partition(values[i][pick], -self.top)[-self.top]
                pick = pick[values[i][pick] >= fifth]
            score = np.concatenate([self.score[row], values[i][pick]])
            ids = np.concatenate([self.id[row], b.ids[cols][pick]])
            uids = np.concatenate([self.uid[row], b.uids[cols][pick]])
            best = sorted(range(len(score)), key=lambda x: (-score[x], ids[x], uids[x] < 0, uids[x]))[: self.top]
            if not self.exact and self.score.dtype != object:
                self.score = self.score.astype(object)
            self.score[row], self.id[row], self.uid[row] = score[best], ids[best], uids[best]


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``block, tree``: the cover trees of up to ``size`` vectors of one length each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple]] = {}

        def row(entries: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            tree = build(np.array([x[0] for x in entries]), np.array([x[1] for x in entries]), np.stack([x[2] for x in entries]))
            made += 1
            data = zstandard.ZstdCompressor(level=1).compress(pickle.dumps(tree.__dict__))
            return pa.RecordBatch.from_arrays(
                [pa.array([part * (1 << 32) + made], pa.int64()), pa.array([len(entries[0][2])], pa.int64()), pa.array([data], pa.binary())],
                ["block", "width", "tree"])

        for batch in batches:
            ids = batch.column(1).fill_null(LAST).to_numpy()
            uids = batch.column(0).to_numpy()
            lists = batch.column(2)
            flat = np.floor(256 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for i in range(batch.num_rows):
                vector = flat[at[i] : at[i + 1]]
                entries = held.setdefault(len(vector), [])
                entries.append((ids[i], uids[i], vector))
                if len(entries) == size:
                    yield row(held.pop(len(vector)))
        for entries in held.values():
            yield row(entries)

    return rows.select("uid", "id", "vector").mapInArrow(run, "block long, width long, tree binary")


def _search(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def load(frame: bytes) -> Tree:
            return Tree(**pickle.loads(zstandard.ZstdDecompressor().decompress(frame)))

        def result(found: Search) -> pa.RecordBatch:
            n, k = found.uid.shape
            some = found.uid.reshape(-1) >= 0
            scores = [max(-LAST - 1, min(LAST, int(x))) for x in found.score.reshape(-1)[some]]
            return pa.RecordBatch.from_arrays([
                pa.array(np.repeat(found.queries.uids, k)[some], pa.int64()), pa.array(np.repeat(found.queries.ids, k)[some], pa.int64()),
                pa.array(found.id.reshape(-1)[some], pa.int64()), pa.array(found.uid.reshape(-1)[some], pa.int64()),
                pa.array(scores, pa.int64())], ["query_uid", "query_id", "vec_id", "uid", "score"])

        at, found = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                key = (batch.column(0)[row].as_py(), batch.column(1)[row].as_py())
                if key != at:
                    if found is not None:
                        yield result(found)
                    at, found = key, Search(load(batch.column(2)[row].as_py()), top)
                found.add(load(batch.column(3)[row].as_py()))
        if found is not None:
            yield result(found)

    return run


def top_inner_products(vectors: DataFrame, is_query: Column, top: int = TOP, vec_id: str = "vec_id",
                       vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``top`` other rows with the largest integer inner product.

    Components are floor(256 * x). Vectors that are null, or hold a null, NaN or infinity, take no part; vectors
    of different lengths are not compared. Ties go to the smaller id, null ids last; repeated rows are separate
    rows. A score beyond 64 bits is shown as the nearest long. An empty table gives an empty result; other
    columns are not read.
    """
    small_batches(vectors.sparkSession)
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.where(F.col(vector).isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("uid"), F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = materialized(rows, "vectors")
    data = materialized(_blocks(rows, DATA_BLOCK), "data-trees")
    groups = max(1, -(-data.count() // GROUP_BLOCKS))
    questions = rows.where("asks")
    parts = max(1, -(-questions.count() // QUERY_BLOCK))
    asked = materialized(_blocks(questions.repartition(parts), QUERY_BLOCK), "query-trees")
    data = data.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    asked = asked.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    pairs = asked.select("group", "width", F.col("block").alias("query_block"), F.col("tree").alias("query_tree")).join(
        data.select("group", "width", "tree", "block"), ["group", "width"])
    dealt = pairs.repartition("group", "query_block").sortWithinPartitions("group", "query_block", "block")
    found = dealt.select("group", "query_block", "query_tree", "tree").mapInArrow(
        _search(top), "query_uid long, query_id long, vec_id long, uid long, score long")
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "query_id", "rank", F.when(F.col("vec_id") != LAST, F.col("vec_id")).alias("vec_id"), "score")
