"""Reading the supplied Parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SUPPLIED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the supplied tables of one folder. Each table is
    resolved once (one file listing and footer read per table, however many
    models scan it); Catalyst still prunes and filters every use separately."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = table(self.spark, self.sf_dir, name)
        return self._cache[name]
