"""Ordered look-ups along one key's timeline, split into stretches of bounded row count.

``lead``/``last`` over ``Window.partitionBy(key)`` send every row of a key to
one task; a key holding a third of the table would then be one third of the
job in one task. Both helpers here partition by ``(key, stretch)`` instead and
settle the rows at the edge of a stretch with a second pass over one row per
``(key, stretch)``. Results are exact.

A stretch ends at a cut: a position of the key's timeline whose hash is 0 modulo
``stretch_rows``. Cuts follow the rows and not the clock, so a burst is cut as
often as its rows require, and a stretch holds ``stretch_rows`` positions on
average whatever the spread of times. A position is an instant where a key has one
row at each (version intervals); in the as-of join it is (instant, mark or event,
hash of the row), so that the rows of one single instant are cut like any others
and what the last mark said is carried over the cut.
The hash is that of ``(key, position)``: every frame is cut alike.
There are about ``rows / stretch_rows`` cuts; they are broadcast only if their
count is at most ``BROADCAST_CUTS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import epoch_micros

STRETCH_ROWS = 250_000
# 40 bytes or so each: at most some 40 MB are broadcast.
BROADCAST_CUTS = 1_000_000
# Powers of two for the binary search in one key's cuts, largest first.
_STEPS = [1 << b for b in range(29, -1, -1)]


POS = "_tl_pos"


def instant(ts: str) -> Column:
    return epoch_micros(ts)


def place(ts: str, kind: int, columns: list[str]) -> Column:
    """Position of a row among the marks (kind 0) and events (kind 1) of one instant."""
    return F.struct(epoch_micros(ts).alias("us"), F.lit(kind).alias("kind"), F.xxhash64(*columns).alias("row"))


def cut_positions(rows: DataFrame, key: list[str], stretch_rows: int) -> DataFrame:
    """(key, ``_tl_cuts``): the sorted cuts of every key that has several.

    A key with one cut is about as long as a stretch may be and stays whole, so that
    tables of short timelines are not split because of a chance cut."""
    chosen = F.pmod(F.xxhash64(*key, POS), F.lit(stretch_rows)) == 0
    return (rows.where(chosen & F.col(POS).isNotNull()).groupBy(*key)
            .agg(F.array_sort(F.collect_set(POS)).alias("_tl_cuts")).where(F.size("_tl_cuts") > 1))


def _cuts_passed(cuts: Column, position: Column) -> Column:
    """How many of the sorted ``cuts`` lie at or before ``position``, by binary search."""
    def step(found: Column, size: Column) -> Column:
        ahead = found + size
        passed = (ahead <= F.size(cuts)) & (F.try_element_at(cuts, ahead) <= position)
        return F.when(passed, ahead).otherwise(found)
    found = F.aggregate(F.array(*[F.lit(s) for s in _STEPS]), F.lit(0), step)
    return F.when(cuts.isNull() | position.isNull(), F.lit(0)).otherwise(found)


class Stretches:
    """Numbers the stretches of each key's timeline by ``POS``, alike for every frame it is given."""

    def __init__(self, rows: DataFrame, key: list[str], stretch_rows: int = STRETCH_ROWS):
        self.key = key
        self.cuts = cut_positions(rows, key, stretch_rows)
        # One pruned scan of (key, position): how many cuts there are decides how they travel.
        self.count = self.cuts.agg(F.sum(F.size("_tl_cuts"))).first()[0] or 0

    def number(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` without its position and with the number of its stretch."""
        columns = [c for c in df.columns if c != POS]
        if not self.count:
            return df.select(*columns, F.lit(0).alias(out))
        cuts = self.cuts.select(*[F.col(k).alias(f"_tl_k{i}") for i, k in enumerate(self.key)], "_tl_cuts")
        same = F.lit(True)
        for i, k in enumerate(self.key):
            same = same & df[k].eqNullSafe(cuts[f"_tl_k{i}"])
        # Beyond the limit the join shuffles, and AQE splits the partition of a hot key.
        j = df.join(F.broadcast(cuts) if self.count <= BROADCAST_CUTS else cuts, same, "left")
        return j.select(*columns, _cuts_passed(F.col("_tl_cuts"), F.col(POS)).alias(out))


def next_time(df: DataFrame, key: list[str], ts: str, out: str, times: DataFrame | None = None,
              stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Add ``out`` = the next later ``ts`` of the same key (NULL for the last).

    ``(key, ts)`` must be unique (the callers de-duplicate first). ``times``
    optionally gives the same ``(key, ts)`` values from a cheaper source (for
    example the log before de-duplication): the first time of each stretch is
    the same either way, and the edge pass then reads two pruned columns with
    map-side partial aggregation instead of re-running the de-duplication.
    """
    b = "_tl_b"
    src = (times if times is not None else df).select(*key, ts, instant(ts).alias(POS))
    stretches = Stretches(src, key, stretch_rows)
    d = stretches.number(df.withColumn(POS, instant(ts)), b)
    d = d.withColumn(out, F.lead(ts).over(Window.partitionBy(*key, b).orderBy(ts)))
    if not stretches.count:
        return d.drop(b)
    firsts = stretches.number(src, b).groupBy(*key, b).agg(F.min(ts).alias("_tl_first"))
    nxt = (firsts
           .withColumn("_tl_next", F.lead("_tl_first").over(Window.partitionBy(*key).orderBy(b)))
           .select(*key, b, "_tl_next"))
    return (d.join(nxt, [*key, b], "left")
             .withColumn(out, F.coalesce(F.col(out), F.col("_tl_next")))
             .drop(b, "_tl_next"))


def last_at_or_before(events: DataFrame, marks: DataFrame, key: list[str], ts: str, payload: str,
                      out: str, stretch_rows: int = STRETCH_ROWS, row_id: Sequence[str] | None = None) -> DataFrame:
    """For every row of ``events`` add ``out`` = the ``payload`` of the latest
    ``marks`` row of the same key whose ``ts`` is <= the event's ``ts``.

    ``marks`` holds ``key``, ``ts`` and ``payload`` (any type, typically a
    struct); ``events`` holds ``key`` and ``ts`` plus anything else, which is
    carried through untouched. No pairs are formed: both sides are unioned,
    sorted within ``(key, stretch)`` and scanned once.

    ``row_id`` names the columns that tell the events of one instant apart (by default
    all): the cuts are chosen in a scan of the key, the time and these.
    """
    b, kind, row = "_tl_b", "_tl_kind", "_tl_row"
    ev_cols = events.columns
    hashed = list(row_id) if row_id else [f.name for f in events.schema.fields if not _unhashable(f.dataType)]
    ev = events.select(*key, F.col(ts), F.lit(1).alias(kind), place(ts, 1, hashed).alias(POS),
                       F.struct(*[F.col(c) for c in ev_cols]).alias(row),
                       F.lit(None).cast(marks.schema[payload].dataType).alias(payload))
    mk = marks.select(*key, F.col(ts), F.lit(0).alias(kind), place(ts, 0, [*key, ts]).alias(POS),
                      F.lit(None).cast(ev.schema[row].dataType).alias(row), F.col(payload))
    stretches = Stretches(ev.select(*key, POS).unionByName(mk.select(*key, POS)), key, stretch_rows)
    # Marks sort before events at the same instant, so ``<=`` holds.
    if not stretches.count:
        w_key = (Window.partitionBy(*key).orderBy(F.col(ts), F.col(kind))
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        u = ev.drop(POS).unionByName(mk.drop(POS)).withColumn("_tl_in", F.last(payload, ignorenulls=True).over(w_key))
        return u.where(F.col(kind) == 1).select(F.col(f"{row}.*"), F.col("_tl_in").alias(out))
    order = "_tl_order"
    u = stretches.number(ev.unionByName(mk).withColumn(order, F.col(POS)), b)
    w_in = Window.partitionBy(*key, b).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_tl_in", F.last(payload, ignorenulls=True).over(w_in))
    ev_out = u.where(F.col(kind) == 1)
    # Rows whose stretch holds no earlier mark take the latest mark of an earlier
    # stretch: one row per (key, stretch) on each side, scanned per key in order.
    # Event rows sort before the mark row of the same number, so they only see
    # strictly earlier stretches.
    last_b = (stretches.number(mk, b)
              .groupBy(*key, b).agg(F.max_by(F.col(payload), F.col(ts)).alias("_tl_p"))
              .withColumn(kind, F.lit(0)))
    ev_b = (stretches.number(ev.select(*key, POS), b).select(*key, b).distinct()
            .withColumn("_tl_p", F.lit(None).cast(last_b.schema["_tl_p"].dataType))
            .withColumn(kind, F.lit(1)))
    w_prev = (Window.partitionBy(*key).orderBy(F.col(b), F.col(kind).desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    prev = (last_b.unionByName(ev_b)
            .withColumn("_tl_prev", F.last("_tl_p", ignorenulls=True).over(w_prev))
            .where(F.col(kind) == 1).select(*key, b, "_tl_prev"))
    return (ev_out.join(prev, [*key, b], "left")
            .select(F.col(f"{row}.*"), F.coalesce(F.col("_tl_in"), F.col("_tl_prev")).alias(out)))


def _unhashable(dtype: T.DataType) -> bool:
    """Types that ``xxhash64`` does not take: maps and variants, at any depth."""
    if isinstance(dtype, T.StructType):
        return any(_unhashable(f.dataType) for f in dtype.fields)
    return _unhashable(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, (T.MapType, T.VariantType))
