"""Helpers shared by the operators: supplied tables, shared storage, row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own; on a
    cluster a missing setting is an error, since others would not see such a folder.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark removes the files once
    the DataFrame is no longer referenced; without it they stay, as do ``stored`` ones.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_held_out(id_col: str | Column, folds: int = 5) -> Column:
    """True for documents that no model may learn from: crc32(id as text) mod folds = 0."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base
