"""Exact duplicates by a distributed sort of the texts themselves.

Rows are dealt to sorted ranges by sampled splitters (``repartitionByRange``) and
sorted within them by Spark's external sort, so equal texts end up next to each
other. A splitter holds the first bytes of the normalised text, its digest, the
identifier and a row number, so it stays small whatever the texts' lengths, and a
text that fills a third of the table is spread over as many ranges as it needs.
One pass over each range compares every text with its neighbour in full. Only the
texts at the two ends of a range can go on in another range; their parts (at most
two a range) are put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored

WHITE = r"[\x20\x09-\x0D]+"
SPLITTER_BYTES = 64


def normalised(text: Column) -> Column:
    """White space runs become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " ")


class Run:
    """Rows of one text so far: the text, the identifiers in order and their number."""

    def __init__(self, text: bytes):
        self.text, self.ids, self.size = text, [], 0


def runs_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal neighbours in one sorted range.

    Rows of a text whose digest is the range's first or last one carry the range
    and run they belong to, and the first of them the text, since more of that
    text may stand in another range. Memory: one batch and the identifiers of the
    current text.
    """
    pid = TaskContext.get().partitionId()
    block: list[Run] = []  # the texts of the current digest: more than one only if digests collide
    block_sha, number, first_block = None, 0, True

    def closed(ids: pa.Array, shas: pa.Array, starts_run: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(starts_run)
        sizes = np.diff(np.append(at, len(starts_run)))
        none = len(starts_run)
        return pa.RecordBatch.from_arrays(
            [ids, ids.take(pa.array(np.repeat(at, sizes))), pa.array(np.repeat(sizes, sizes), pa.int64()),
             pa.array(starts_run), shas, pa.nulls(none, pa.int32()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())],
            names=NAMES)

    def finished(is_open: bool) -> Iterator[pa.RecordBatch]:
        nonlocal number
        for run in block:
            smallest, first = run.ids[0].slice(0, 1), True
            for ids in run.ids:
                n = len(ids)
                head = np.zeros(n, dtype=bool)
                head[:1] = first
                texts = [run.text if first and is_open else None] + [None] * (n - 1)
                yield pa.RecordBatch.from_arrays(
                    [ids, smallest.take(pa.array(np.zeros(n, dtype=np.int64))), pa.array(np.full(n, run.size), pa.int64()),
                     pa.array(head), pa.array([block_sha] * n, pa.string()),
                     pa.array([pid if is_open else None] * n, pa.int32()),
                     pa.array([number if is_open else None] * n, pa.int32()), pa.array(texts, pa.binary())], names=NAMES)
                first = False
            number += 1

    for batch in batches:
        ids, texts, shas = batch.column("id"), batch.column("norm"), batch.column("sha")
        n = batch.num_rows
        if not n:
            continue
        new_sha = np.ones(n, dtype=bool)
        new_sha[1:] = pc.not_equal(shas.slice(1), shas.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new_sha[0] = block_sha is None or shas[0].as_py() != block_sha
        new_run = np.ones(n, dtype=bool)
        # The full comparison of neighbours.
        new_run[1:] = pc.not_equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new_run[0] = not block or texts[0].as_py() != block[-1].text
        new_run |= new_sha
        blocks = np.append(np.flatnonzero(new_sha), n)

        def extend(low: int, high: int) -> None:
            at = np.flatnonzero(new_run[low:high]) + low
            for start, end in zip(np.unique(np.append(low, at)), np.append(at[at > low], high)):
                if new_run[start]:
                    block.append(Run(texts[int(start)].as_py()))
                block[-1].ids.append(ids.slice(int(start), int(end - start)))
                block[-1].size += int(end - start)

        if blocks[0] > 0:
            extend(0, int(blocks[0]))
        if len(blocks) == 1:
            continue
        if block:
            yield from finished(first_block)
            first_block, block = False, []
        inner = 0
        if first_block and len(blocks) > 2:
            block_sha = shas[0].as_py()
            extend(0, int(blocks[1]))
            yield from finished(True)
            first_block, block, inner = False, [], 1
        low, high = int(blocks[inner]), int(blocks[-2])
        if high > low:
            yield closed(ids.slice(low, high - low), shas.slice(low, high - low), new_run[low:high])
        block_sha = shas[high].as_py()
        extend(high, n)
    if block:
        yield from finished(True)


NAMES = ["id", "keep_id", "group_size", "kept", "text_sha256", "range", "run", "text"]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when they are identical after ``normalised``. Of equal texts the
    row with the smallest id stays; ``text_sha256`` is the digest of the normalised
    text in UTF-8.

    Defined cases: a null text is the empty text; null ids come after all others, so
    ``keep_id`` is null only if the group has no other id; of rows repeated with the
    same id and equal text exactly one stays; an empty table gives no rows. Only the
    id and the text are read, so further columns of any name do not matter.
    """
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.select("id", F.col("norm").cast("binary").alias("norm"), F.sha2(F.col("norm"), 256).alias("sha"),
                       F.substring(F.col("norm").cast("binary"), 1, SPLITTER_BYTES).alias("prefix"),
                       F.monotonically_increasing_id().alias("nth"))
    last = F.col("id").asc_nulls_last()
    ordered = (rows.repartitionByRange("prefix", "sha", last, "nth")
               .sortWithinPartitions("prefix", "sha", "norm", last, "nth"))
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("keep_id", id_type), T.StructField("group_size", T.LongType()),
        T.StructField("kept", T.BooleanType()), T.StructField("text_sha256", T.StringType()),
        T.StructField("range", T.IntegerType()), T.StructField("run", T.IntegerType()), T.StructField("text", T.BinaryType())])
    found = stored(ordered.select("id", "norm", "sha").mapInArrow(runs_of_range, schema), "content-runs")
    # The parts of a text that lies in several ranges: one row a range and text.
    same = Window.partitionBy("text")
    parts = found.filter("text IS NOT NULL").select(
        "range", "run", F.min("id").over(same).alias("whole_keep"), F.sum("group_size").over(same).alias("whole_size"),
        (F.row_number().over(same.orderBy(last, "range", "run")) == 1).alias("leads"))
    at_ends = found.filter("run IS NOT NULL").join(parts, ["range", "run"])
    columns = [F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"]
    return found.filter("run IS NULL").select(*columns).unionAll(at_ends.select(
        F.col("id").alias(id_col), F.col("whole_keep").alias("keep_id"), F.col("whole_size").alias("group_size"),
        (F.col("kept") & F.col("leads")).alias("kept"), "text_sha256"))
