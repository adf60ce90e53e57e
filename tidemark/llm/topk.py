"""Exact top-k inner-product search with ball trees.

Candidate rows are dealt to shards of bounded size; each shard builds its ball
tree once, and the queries, a distributed side of their own, pass it as a stream
of chunks. A query visits nodes in the order of the largest inner product that
their ball allows, <q, centre> + |q| * radius, and leaves out those below its kth
score so far. That score is shared: the first shard is searched before the others
(by blocks of queries, since one task must not meet them all) and gives every
other shard's search its starting kth scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

LEAF = 64
CHUNK = 1024
EXACT = 2.0 ** 53
LOWEST = -(1 << 62)


class BallTree:
    """Balls over integer rows, halved along their widest dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.nodes: list[tuple[np.ndarray, float, int, int, np.ndarray | None]] = []
        self.root = self.grow(np.argsort(ids, kind="stable"))

    def grow(self, members: np.ndarray) -> int:
        points = self.rows[members].astype(np.float64)
        centre = points.mean(axis=0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(axis=1).max()))
        own = len(self.nodes)
        self.nodes.append((centre, radius, -1, -1, members))
        if len(members) > LEAF and radius > 0:
            wide = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
            split = np.argsort(points[:, wide], kind="stable")
            half = len(split) // 2
            left, right = self.grow(np.sort(members[split[:half]])), self.grow(np.sort(members[split[half:]]))
            self.nodes[own] = (centre, radius, left, right, None)
        return own

    def search(self, queries: np.ndarray, own_ids: np.ndarray, best: Best) -> None:
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        stack = [(self.root, np.arange(len(queries)), np.full(len(queries), np.inf))]
        while stack:
            node, active, bound = stack.pop()
            going = bound >= best.kth[active]
            active, bound = active[going], bound[going]
            if not active.size:
                continue
            _, _, left, right, members = self.nodes[node]
            if members is not None:
                best.offer(active, own_ids[active], self.ids[members], products(queries[active], self.rows[members]))
                continue
            bounds = []
            for child in (left, right):
                centre, radius = self.nodes[child][:2]
                reach = queries[active] @ centre + norms[active] * radius
                bounds.append(np.floor(reach + 1e-6 * (np.abs(reach) + 1)))
            first_left = bounds[0] >= bounds[1]
            # The last pushed is visited first: each query meets its better child before the other.
            for near, far, chosen in ((0, 1, first_left), (1, 0, ~first_left)):
                if chosen.any():
                    children = (left, right)
                    stack.append((children[far], active[chosen], bounds[far][chosen]))
                    stack.append((children[near], active[chosen], bounds[near][chosen]))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries.astype(object) @ rows.astype(object).T


class Best:
    """The k best (score, id) of each query, by score and then the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(queries)]
        self.kth = np.full(queries, LOWEST, dtype=np.float64) if floor is None else floor.copy()

    def offer(self, active: np.ndarray, own: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= self.kth[active][:, None]) & (ids[None, :] != own[:, None])
        for i in np.flatnonzero(good.any(axis=1)):
            q = int(active[i])
            at = np.flatnonzero(good[i])
            merged = self.found[q] + [(-int(s), int(d)) for s, d in zip(scores[i, at], ids[at])]
            merged.sort()
            self.found[q] = merged[:self.k]
            if len(self.found[q]) == self.k:
                self.kth[q] = max(self.kth[q], -self.found[q][-1][0])


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null for a vector with a null or non-finite component."""
    clean = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(clean, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
          scale: int = 256, shard_rows: int = 4096, block_rows: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest integer inner products of each query.

    Candidates are all rows of ``vectors`` but those with the query's own id. A task
    holds one shard of about ``shard_rows`` rows and one chunk of queries; the first
    shard meets the queries in blocks of about ``block_rows``.

    Defined cases: vectors (or ids) that are null, empty or hold a null or non-finite
    component take no part; only vectors of the query's length are its
    candidates; a repeated row is a candidate as often as it stands, and a repeated
    query gives its rows each time; ties go to the smaller id; fewer candidates
    than ``k`` give fewer rows; an empty table gives no rows.
    """
    def prepared(df: DataFrame) -> DataFrame:
        whole = df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
        whole = cut(whole.filter("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").withColumn("dim", F.size("v")))
        return whole.withColumn("row", F.monotonically_increasing_id())

    def spread(over: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(over)).cast("int")

    def every(numbers: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(numbers - 1)))

    # Rows are dealt by their number, so that many copies of one row spread like any others.
    rows, wanted = prepared(vectors), prepared(queries)
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-wanted.count() // block_rows))
    rows = rows.withColumn("shard", spread(shards))
    unknown = wanted.withColumn("floor", F.lit(None).cast("long")).withColumn("cell", spread(blocks))
    first = cut(searched(rows.filter("shard = 0").withColumn("cell", every(blocks)), unknown, k, blocks))
    results = first
    if shards > 1:
        kth = first.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") >= k)
        known = wanted.join(kth.select("row", "floor"), "row", "left")
        rest = F.explode(F.sequence(F.lit(1), F.lit(shards - 1)))
        results = first.unionAll(searched(rows.filter("shard > 0").withColumn("cell", F.col("shard")),
                                          known.withColumn("cell", rest), k, shards))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = results.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def searched(held: DataFrame, asked: DataFrame, k: int, cells: int) -> DataFrame:
    """row, query_id, vec_id, score: each query's k best in its cell, none below its floor (the shared kth score)."""
    names = ("cell", "dim", "part", "row", "id", "v", "floor")
    nothing = F.lit(None).cast("long")
    both = held.withColumns({"part": F.lit(0), "row": nothing, "floor": nothing}).select(*names).unionAll(
        asked.withColumn("part", F.lit(1)).select(*names))
    placed = both.repartition(cells, "cell").sortWithinPartitions("cell", "dim", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, tree = None, [], [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in names[:3]], axis=1)
            starts = np.flatnonzero(np.append(True, (marks[1:] != marks[:-1]).any(axis=1)))
            for low, high in zip(starts, np.append(starts[1:], len(marks))):
                if tuple(marks[low, :2]) != key:
                    key, ids, vectors, tree = tuple(marks[low, :2]), [], [], None
                piece = batch.slice(low, high - low)
                own = piece.column("id").to_numpy()
                v = piece.column("v").flatten().to_numpy().reshape(len(piece), -1)
                if marks[low, 2] == 0:
                    ids.append(own)
                    vectors.append(v)
                    continue
                if not ids:
                    continue  # no candidate of this length in the cell
                tree = tree or BallTree(np.concatenate(ids), np.concatenate(vectors))
                for at in range(0, len(piece), CHUNK):
                    part = piece.slice(at, CHUNK)
                    floor = np.array([LOWEST if f is None else f for f in part.column("floor").to_pylist()], dtype=np.float64)
                    best = Best(len(part), k, floor)
                    tree.search(v[at:at + CHUNK], own[at:at + CHUNK], best)
                    found = [len(f) for f in best.found]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(part.column("row").to_numpy(), found)),
                        pa.array(np.repeat(own[at:at + CHUNK], found)),
                        pa.array([i for f in best.found for _, i in f], pa.int64()),
                        pa.array([-s for f in best.found for s, _ in f], pa.int64())],
                        ["row", "query_id", "vec_id", "score"])

    return placed.mapInArrow(search, "row long, query_id long, vec_id long, score long")
