"""CSV seed tables: header row, explicit schema, decimal columns
typed as declared (``amount`` and ``fee_native`` decimal(38,18),
``usd_value_at_tx`` decimal(18,2)). Booleans are accepted in any case
(``True``/``true``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS][.SSS]")
            .csv(path))


def read_seeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """``users.csv``, ``wallets.csv`` and ``transactions.csv`` under ``root``."""
    return {name: read_seed(spark, f"{root.rstrip('/')}/{name}.csv", schema)
            for name, schema in schemas.ENTITIES.items()}


def write_seed(df: DataFrame, path: str) -> None:
    """One CSV folder with a header (for round trips in tests)."""
    df.write.mode("overwrite").option("header", True).csv(path)
