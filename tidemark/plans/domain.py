"""The whole model graph over one input folder, as lazy DataFrames.

``Domain(spark, sf_dir)`` wires fixtures -> bronze -> staging -> snapshot ->
marts the way the warehouse project orders its models. Nothing runs until an
action; each mart is a single Catalyst plan from the Parquet scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import cdc
from tidemark.operators.scd2 import scd2_apply
from tidemark.plans import fixtures, marts, staging
from tidemark.schemas import BRONZE_NAMES
from tidemark.sources.catalog import publish
from tidemark.sources.state import STATE_BUCKETS, read_state
from tidemark.sources.tables import Tables


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)

    # bronze (current-state tables as the batch merge would leave them)
    @cached_property
    def bronze_users(self) -> DataFrame:
        return fixtures.bronze_users(self.t)

    @cached_property
    def bronze_wallets(self) -> DataFrame:
        return fixtures.bronze_wallets(self.t)

    @cached_property
    def bronze_transactions(self) -> DataFrame:
        return fixtures.bronze_transactions(self.t)

    # staging
    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.bronze_users)

    @cached_property
    def stg_wallets(self) -> DataFrame:
        return staging.stg_wallets(self.bronze_wallets)

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.bronze_transactions)

    # snapshot: the first run over bronze users (every user one open version)
    @cached_property
    def users_snapshot(self) -> DataFrame:
        return scd2_apply(None, self.bronze_users, "user_id", "updated_at")

    # marts
    @cached_property
    def dim_users(self) -> DataFrame:
        return marts.dim_users(self.users_snapshot, self.stg_wallets)

    @cached_property
    def dim_users_history(self) -> DataFrame:
        return marts.dim_users_history(self.users_snapshot)

    @cached_property
    def dim_wallets(self) -> DataFrame:
        return marts.dim_wallets(self.stg_wallets)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return marts.fact_transactions(self.stg_transactions, self.dim_wallets)

    @cached_property
    def time_spine(self) -> DataFrame:
        """Calendar days spanning the fact's submission dates."""
        return marts.time_spine_over(self.fact_transactions, "submitted_at")

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every model as a temporary view so SQL written against the
        warehouse models (``select ... from dim_users_history where ...``) runs
        unchanged through ``spark.sql``. Views are lazy: nothing is computed."""
        names = ["stg_users", "stg_wallets", "stg_transactions", "users_snapshot", "dim_users",
                 "dim_users_history", "dim_wallets", "fact_transactions", "time_spine"]
        for n in names:
            getattr(self, n).createOrReplaceTempView(f"{prefix}{n}")
        return [f"{prefix}{n}" for n in names]


class SeedDomain(Domain):
    """The same graph over bronze tables loaded from CSV seeds
    (``users.csv``, ``wallets.csv``, ``transactions.csv`` folders under
    ``seeds_root``), as a local build without the change-capture side runs."""

    def __init__(self, spark: SparkSession, seeds_root: str):
        super().__init__(spark, seeds_root)
        from tidemark.sources.seeds import read_seeds
        self._seeds = read_seeds(spark, seeds_root)

    @cached_property
    def bronze_users(self) -> DataFrame:
        return self._seeds["users"]

    @cached_property
    def bronze_wallets(self) -> DataFrame:
        return self._seeds["wallets"]

    @cached_property
    def bronze_transactions(self) -> DataFrame:
        return self._seeds["transactions"]


class BronzeDomain(Domain):
    """The same graph over the merged states of ``database`` (``plans.bronze``, ``streaming.fanout``).

    A state has one row a key, so staging needs no ranking, and is read bucket by
    bucket. The wallets dimension is a table clustered on ``wallet_id``, written when
    first asked for: the fact moves the transactions to it, once, and nothing else.
    """

    def __init__(self, spark: SparkSession, database: str, buckets: int = STATE_BUCKETS):
        super().__init__(spark, database)
        self.database, self.buckets = database, buckets

    def _state(self, entity: str) -> DataFrame:
        state = cdc.published(read_state(self.spark, f"{self.database}.{BRONZE_NAMES[entity]}"))
        return state.drop(cdc.OP)

    @cached_property
    def bronze_users(self) -> DataFrame:
        return self._state("users")

    @cached_property
    def bronze_wallets(self) -> DataFrame:
        return self._state("wallets")

    @cached_property
    def bronze_transactions(self) -> DataFrame:
        return self._state("transactions")

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.bronze_users, one_per_key=True)

    @cached_property
    def stg_wallets(self) -> DataFrame:
        return staging.stg_wallets(self.bronze_wallets, one_per_key=True)

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.bronze_transactions, one_per_key=True)

    @cached_property
    def users_snapshot(self) -> DataFrame:
        return scd2_apply(None, self.bronze_users.drop(cdc.TS, cdc.LSN), "user_id", "updated_at")

    @cached_property
    def dim_wallets(self) -> DataFrame:
        name = f"{self.database}.dim_wallets"
        rows = marts.dim_wallets(self.stg_wallets).repartition(self.buckets, "wallet_id")
        publish(self.spark, rows, name, cluster_by=(self.buckets, ["wallet_id"]))
        return self.spark.table(name)
