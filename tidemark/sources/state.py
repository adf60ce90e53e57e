"""Stored CDC state between runs, merged on read.

A state is two tables, both bucketed by the key into the same number of buckets and
sorted on it within them: the *base*, one row a key, and the *changes*, one
compacted row a key and run. A run appends its compacted batch to the changes, so
it writes as much as it brings, whatever the size of the state. The state's name is
a view that gives every key's last row of the two: the changes are ranked and the
base is joined bucket by bucket, so readers of the view, any SQL included, move no
row. ``fold`` takes the changes into a new base, and may give it another number of
buckets; ``is_due`` says when that pays. The order of changes is that of
``operators.cdc``: the last under ``(ts_ms, lsn)`` decides, on a tie the change.

One writer at a time: runs and folds of one state must not overlap. Readers need
not wait: what a fold replaces stays until the fold after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.sources.catalog import drop_unused, properties

STATE_BUCKETS = 16
# Changes of a bucket where a batch is counted, and so of a task that ranks, sorts or reads one: at most 85 MB of a sort's memory.
BUCKET_ROWS = 250_000
# Properties of the state's view: its two tables and the key.
BASE, CHANGES, KEY = "state.base", "state.changes", "state.key"


@dataclass(frozen=True)
class StateTables:
    base: str
    changes: str
    key: str


def state_tables(spark: SparkSession, name: str) -> StateTables | None:
    """The tables behind the state ``name``; None if there is none yet."""
    told = properties(spark, name)
    return StateTables(told[BASE], told[CHANGES], told[KEY]) if BASE in told else None


def bucket_count(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return int(described.where(F.col("col_name") == "Num Buckets").first()["data_type"])


def _write(df: DataFrame, table: str, key: str, buckets: int, mode: str = "error") -> None:
    df.write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def merged_sql(base: str, changes: str, key: str, columns: list[str]) -> str:
    """Each key's last row of ``base`` and ``changes``; tables bucketed alike by the key meet without an exchange."""
    def quoted(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"
    k, names = quoted(key), [quoted(c) for c in columns]
    order = [quoted(c) for c in (cdc.TS, cdc.LSN)]
    newer = f"struct({', '.join(f's.{c}' for c in order)}) >= struct({', '.join(f'b.{c}' for c in order)})"
    taken = f"b.{k} IS NULL OR (s.{k} IS NOT NULL AND {newer})"
    return f"""
        SELECT {', '.join(f'if({taken}, s.{c}, b.{c}) AS {c}' for c in names)}
        FROM {base} AS b FULL OUTER JOIN (
          SELECT {', '.join(names)} FROM (
            SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {', '.join(f'{c} DESC' for c in order)}) AS _nth
            FROM {changes}) WHERE _nth = 1) AS s
        ON b.{k} = s.{k}"""


def _show(spark: SparkSession, name: str, now: StateTables) -> None:
    columns = spark.table(now.base).columns
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{BASE}' = '{now.base}', '{CHANGES}' = '{now.changes}', "
              f"'{KEY}' = '{now.key}') AS {merged_sql(now.base, now.changes, now.key, columns)}")


@contextmanager
def _ranked_in(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Within the block the session's exchanges have so many partitions, none put together. With as many as buckets,
    the exchange that ranks a batch also deals it to its buckets, and Spark leaves the second one out."""
    wanted = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    usual = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def _fresh(name: str, key: str) -> StateTables:
    run = uuid.uuid4().hex[:8]
    return StateTables(f"{name}__base_{run}", f"{name}__changes_{run}", key)


def read_state(spark: SparkSession, name: str) -> DataFrame:
    """The merged state, with what other sessions (streams) have appended since this one looked."""
    tables = state_tables(spark, name)
    for table in (tables.base, tables.changes):
        spark.catalog.refreshTable(table)
    return spark.table(name)


def merge_into_table(spark: SparkSession, name: str, rows: DataFrame, key: str, buckets: int = STATE_BUCKETS,
                     only_newer: bool = False, count: int | None = None) -> DataFrame:
    """Merge flat change rows into the state ``name``; returns the state.

    The first run writes the base with ``buckets`` buckets (choose state bytes / 256 MB
    or so; ``fold`` can change it). Every later one appends the compacted rows.
    Merging the same changes again changes nothing that readers see, so a replayed
    micro-batch is harmless. With ``only_newer`` the batch first meets the state and
    rows that the state already holds, or has passed, are not written again: for runs
    that read all changes anew each time.

    A caller that knows the ``count`` of its rows tells it: a new base then has as many more
    buckets as keep each at ``BUCKET_ROWS`` changes, and a task's memory is the same whatever the
    batch's size or the session's number of partitions. Such rows come without an exchange of their own.
    """
    tables = state_tables(spark, name)
    batch, needed = cdc.compact(rows, key), -(-(count or 0) // BUCKET_ROWS)
    if tables is None:
        tables, buckets = _fresh(name, key), max(buckets, needed)
        with _ranked_in(spark, buckets) if count else nullcontext():
            _write(batch.repartition(buckets, key), tables.base, key, buckets)
        _write(spark.table(tables.base).limit(0), tables.changes, key, buckets)
        _show(spark, name, tables)
        return spark.table(name)
    if tables.key != key:
        raise ValueError(f"the state {name} is kept by {tables.key}, not by {key}")
    if only_newer:
        # A key's row stands for itself and all before it: only later ones are news.
        held = read_state(spark, name).select(F.col(key).alias("_held"), F.struct(cdc.TS, cdc.LSN).alias("_held_at"))
        batch = batch.join(held, batch[key] == F.col("_held"), "left")
        batch = batch.where(F.col("_held").isNull() | (F.struct(cdc.TS, cdc.LSN) > F.col("_held_at")))
    columns, stored = spark.table(tables.base).columns, bucket_count(spark, tables.base)
    with _ranked_in(spark, max(stored, needed)) if count else nullcontext():
        _write(batch.select(*columns).repartition(stored, key), tables.changes, key, stored, mode="append")
    return read_state(spark, name)


def is_due(spark: SparkSession, name: str, share: float = 0.25) -> bool:
    """True when the changes hold more than ``share`` of the base's rows (counts come from file footers)."""
    tables = state_tables(spark, name)
    read_state(spark, name)
    return spark.table(tables.changes).count() > share * spark.table(tables.base).count()


def fold(spark: SparkSession, name: str, buckets: int | None = None) -> DataFrame:
    """Take the changes into a new base, with another number of buckets if given; returns the state.

    With the same number each task reads, merges and writes one bucket and nothing is
    exchanged. The view moves to the new tables in one catalog call; a fold that dies
    before leaves the state as it was, and its tables go with the next fold.
    """
    old = state_tables(spark, name)
    merged, stored = read_state(spark, name), bucket_count(spark, old.base)
    new, count = _fresh(name, old.key), buckets or stored
    _write(merged if count == stored else merged.repartition(count, old.key), new.base, old.key, count)
    _write(spark.table(new.base).limit(0), new.changes, old.key, count)
    _show(spark, name, new)
    drop_unused(spark, name, {new.base, new.changes, old.base, old.changes})
    return spark.table(name)
