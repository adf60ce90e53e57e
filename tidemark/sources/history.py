"""Stored Type-2 history between snapshot runs.

A history is two kinds of table: one of *closed* versions, partitioned by the run
that closed them, which no later run touches; and the *open* versions, one row a
key, bucketed by it. A run reads the open versions and the source, adds the
versions it closes as a partition of its own and writes the open versions anew. The
history's name is a view of both that moves in one catalog call after both are
written: a run that dies before leaves the history as it was, and its repetition
writes the same partition again. What a run costs follows the keys, not the
versions gathered so far.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scd2 import VALID_TO, fold_into_open
from tidemark.sources.catalog import drop_unused, properties

BUCKETS = 16
# The partition column of the closed versions, and the view's properties.
CLOSED_IN = "closed_in_run"
OPEN, CLOSED, RUN, KEY = "history.open", "history.closed", "history.run", "history.key"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def snapshot_run(spark: SparkSession, name: str, current: DataFrame, key: str, updated_at: str = "updated_at",
                 hard_deletes: str = "ignore", as_of: Column | None = None, tiebreak: Sequence[str] = (),
                 buckets: int = BUCKETS) -> DataFrame:
    """Fold the ``current`` state of the source into the stored history ``name``; returns the history.

    The rules are those of ``scd2_apply``. A run over an unchanged source closes and opens
    nothing. ``buckets`` counts for the first run; one run at a time.
    """
    told = properties(spark, name)
    if told and told.get(KEY) != key:
        raise ValueError(f"the history {name} is kept by {told.get(KEY)}, not by {key}")
    run = int(told[RUN]) + 1 if told else 0
    if told:
        stored = told[OPEN]
        spark.catalog.refreshTable(stored)
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {stored}").where(F.col("col_name") == "Num Buckets")
        buckets = int(described.first()["data_type"])
        moved = fold_into_open(spark.table(stored), current, key, updated_at, hard_deletes, as_of, tiebreak)
    else:
        moved = fold_into_open(None, current, key, updated_at, hard_deletes, as_of, tiebreak)
    fresh = f"{name}__{uuid.uuid4().hex[:8]}"
    closed = told.get(CLOSED, f"{name}__closed")
    # Both parts come from one join: it is kept until they are written.
    moved = moved.persist()
    try:
        ended = moved.where(F.col(VALID_TO).isNotNull()).withColumn(CLOSED_IN, F.lit(run))
        if not told:
            ended.write.format("parquet").mode("overwrite").partitionBy(CLOSED_IN).saveAsTable(closed)
        else:
            columns = [c for c in spark.table(closed).columns if c != CLOSED_IN]
            ended.select(*columns).createOrReplaceTempView(view := f"ended_{uuid.uuid4().hex[:8]}")
            spark.sql(f"INSERT OVERWRITE TABLE {closed} PARTITION ({CLOSED_IN} = {run}) SELECT * FROM {view}")
            spark.catalog.dropTempView(view)
        moved.where(F.col(VALID_TO).isNull()).repartition(buckets, key).write.format("parquet").bucketBy(
            buckets, key).sortBy(key).saveAsTable(fresh)
    finally:
        moved.unpersist()
    columns = ", ".join(_quoted(c) for c in spark.table(fresh).columns)
    # Partitions of a run that died before it took the name are not shown: theirs is a later number.
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{OPEN}' = '{fresh}', '{CLOSED}' = '{closed}', '{RUN}' = '{run}', "
              f"'{KEY}' = '{key}') AS SELECT {columns} FROM {closed} WHERE {CLOSED_IN} <= {run} UNION ALL SELECT {columns} FROM {fresh}")
    drop_unused(spark, name, {fresh, told.get(OPEN, "")})
    return spark.table(name)
