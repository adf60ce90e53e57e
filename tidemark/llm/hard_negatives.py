"""Hard negatives by a secondary-sort shuffle.

The anchors meet all rows in blocks: rows are dealt to shards of a bounded size,
every shard's task reads the anchors as a stream of chunks, and only what a shard
may contribute leaves it. Two shuffles follow that plan: the first settles each
anchor's positives; the second packs (anchor, descending score, id) into one byte
key, sorts by it within partitions (``repartitionAndSortWithinPartitions``), and a
streaming iterator opens a window at each positive and emits the negatives that
fall into it, holding the open windows only.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.topk import products, quantised

SHARD_ROWS = 8192
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
KEY = struct.Struct(">QQBQ")
POSITIVE, NEGATIVE = 0, 1


def packed(anchor: int, score: int, kind: int, row: int) -> bytes:
    """A key whose byte order is: anchor, descending score, positives first, smaller id first."""
    return KEY.pack(anchor, HIGHEST - score, kind, row - LOWEST)


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, row = KEY.unpack(key)
    return anchor, HIGHEST - score, kind, row + LOWEST


def dealt_by_anchor(key: bytes) -> int:
    """Spreads the anchors' numbers, which share their low bits, over the partitions."""
    return (KEY.unpack(key)[0] * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 32


def windows(records: Iterator[tuple[bytes, int]], per_positive: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive id, rank, negative id, positive score, negative score) from sorted records.

    A negative belongs to the window of a positive p if low * p <= 100 * n <= high * p.
    With high <= 100 no negative precedes its positive in the order of ``packed``.
    A window closes when it is full or the scores have fallen below it.
    """
    current, opened = None, []
    for key, anchor_id in records:
        anchor, score, kind, row = unpacked(key)
        if anchor != current:
            current, opened = anchor, []
        if kind == POSITIVE:
            opened.append([row, score, 0])
            continue
        for window in opened:
            if low * window[1] <= 100 * score <= high * window[1]:
                window[2] += 1
                yield anchor_id, window[0], window[2], row, window[1], score
        opened = [w for w in opened if w[2] < per_positive and low * w[1] <= 100 * score]


def in_shards(rows: DataFrame, anchors: DataFrame, search: Callable, schema: str, shards: int) -> DataFrame:
    """``search(shard, chunk)`` for every shard of rows and every chunk of anchors.

    Anchors are sent to every shard; in a task a shard's rows come first and stay,
    the anchors follow in Arrow batches and go.
    """
    held = rows.select("shard", F.lit(0).alias("part"), F.lit(None).cast("long").alias("aid"), "id", "label", "v",
                       F.lit(None).cast("array<struct<id:long,score:long>>").alias("positives"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("part"),
                           "aid", "id", "label", "v", "positives")
    both = held.unionByName(asked).withColumn("dim", F.size("v"))
    placed = both.repartition(shards, "shard").sortWithinPartitions("shard", "dim", "part", "id")
    return placed.select("shard", "dim", "part", "aid", "id", "label", "v", "positives").mapInArrow(over_shards(search), schema)


def over_shards(search: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, labels, vectors, shard = None, [], [], [], None
        for batch in batches:
            keys = np.stack([batch.column("shard").to_numpy(), batch.column("dim").to_numpy(),
                             batch.column("part").to_numpy()], axis=1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            for low, high in zip(starts, np.append(starts[1:], len(keys))):
                piece = batch.slice(low, high - low)
                if tuple(keys[low, :2]) != key:
                    key, ids, labels, vectors, shard = tuple(keys[low, :2]), [], [], [], None
                own = [piece.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label")]
                v = piece.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(piece), -1)
                if keys[low, 2] == 0:
                    ids.append(own[0])
                    labels.append(own[1])
                    vectors.append(v)
                    continue
                if not ids:
                    continue  # no row of this length in the shard
                if shard is None:
                    shard = (np.concatenate(ids), np.concatenate(labels), np.concatenate(vectors))
                for k in range(0, len(piece), 256):
                    part = piece.slice(k, 256)
                    yield from search(shard, part, own[0][k:k + 256], own[1][k:k + 256], v[k:k + 256])
    return run


def best_positives(n: int) -> Callable:
    """Each anchor's first ``n`` rows of its own label in a shard."""
    def search(shard, part, ids, labels, v):
        scores = products(v, shard[2])
        out = []
        for i, aid in enumerate(part.column("aid").to_pylist()):
            at = np.flatnonzero((shard[1] == labels[i]) & (shard[0] != ids[i]))
            # A shard's rows are in the order of their ids, which the stable sort keeps for equal scores.
            for j in at[np.argsort(-scores[i, at], kind="stable")[:n]]:
                out.append((aid, int(shard[0][j]), int(scores[i, j])))
        yield pa.RecordBatch.from_pydict({c: pa.array([r[k] for r in out], pa.int64()) for k, c in enumerate(("aid", "id", "score"))})
    return search


def best_negatives(n: int, low: int, high: int) -> Callable:
    """The rows of other labels that are among the first ``n`` of a positive's window in a shard."""
    def search(shard, part, ids, labels, v):
        scores = products(v, shard[2])
        out = []
        for i, (aid, positives) in enumerate(zip(part.column("aid").to_pylist(), part.column("positives").to_pylist())):
            at = np.flatnonzero((shard[1] != labels[i]) & (shard[0] != ids[i]))
            at = at[np.argsort(-scores[i, at], kind="stable")]
            falling = -100 * scores[i, at]
            chosen = set()
            for p in positives:
                start = int(np.searchsorted(falling, -high * p["score"], side="left"))
                end = int(np.searchsorted(falling, -low * p["score"], side="right"))
                chosen.update(at[start:min(end, start + n)].tolist())
            out += [(aid, int(ids[i]), int(shard[0][j]), int(scores[i, j])) for j in sorted(chosen)]
        yield pa.RecordBatch.from_pydict({c: pa.array([r[k] for r in out], pa.int64())
                                          for k, c in enumerate(("aid", "anchor_id", "id", "score"))})
    return search


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = 5, per_positive: int = 10, low: int = 30,
                   high: int = 90, scale: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale * x); higher scores come first,
    ties by the smaller id. An anchor's positives are its first ``positives`` rows of
    the same label; each takes the first ``per_positive`` rows of other labels whose
    score n meets low * p <= 100 * n <= high * p (percent of its own score p, so
    ``high`` may be 100 at most).

    Defined cases: rows with a null id, label or vector, an empty vector, or a null
    or non-finite component take no part; only vectors of the anchor's length
    compare; rows with the anchor's own id are not its candidates; a repeated row is
    a candidate as often as it stands, and a repeated anchor gives its rows each
    time; a window that holds fewer rows gives fewer; an empty table gives no rows.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("0 <= low <= high <= 100")
    spark = vectors.sparkSession
    whole = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           quantised(F.col(vector_col), scale).alias("v"), is_anchor.alias("is_anchor"))
    whole = cut(whole.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0"))
    shards = max(1, -(-whole.count() // shard_rows))
    rows = whole.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    nothing = F.lit(None).cast("array<struct<id:long,score:long>>")
    anchors = cut(whole.filter("is_anchor").select(F.monotonically_increasing_id().alias("aid"), "id", "label", "v",
                                                   nothing.alias("positives")))
    near = in_shards(rows, anchors, best_positives(positives), "aid long, id long, score long", shards)
    order = Window.partitionBy("aid").orderBy(F.col("score").desc(), "id")
    near = near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives)
    # At most ``positives`` of them an anchor.
    near = near.groupBy("aid").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("found"))
    near = near.select("aid", F.transform("found", lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias("positives"))
    anchors = cut(anchors.drop("positives").join(near, "aid"))
    others = cut(in_shards(rows, anchors, best_negatives(per_positive, low, high),
                           "aid long, anchor_id long, id long, score long", shards))
    marks = anchors.select("aid", F.col("id").alias("anchor_id"), F.explode("positives").alias("p"))
    records = marks.select("aid", "anchor_id", F.lit(POSITIVE).alias("kind"), F.col("p.id").alias("id"), F.col("p.score").alias("score"))
    records = records.unionByName(others.select("aid", "anchor_id", F.lit(NEGATIVE).alias("kind"), "id", "score"))
    parts = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    pairs = records.rdd.map(lambda r: (packed(r["aid"], r["score"], r["kind"], r["id"]), r["anchor_id"]))
    ordered = pairs.repartitionAndSortWithinPartitions(parts, dealt_by_anchor)
    mined = ordered.mapPartitions(lambda records: windows(records, per_positive, low, high))
    return spark.createDataFrame(mined, "anchor_id long, positive_id long, rank int, negative_id long, "
                                        "positive_score long, negative_score long")
