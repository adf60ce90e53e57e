"""Marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clean_email, trunc_ntz
from tidemark.operators.scd2 import VALID_FROM, VALID_TO, with_is_current


def dim_users(users_snapshot: DataFrame, stg_wallets: DataFrame) -> DataFrame:
    """Current version of every user with wallet counts (0 when none).

    The counts are a partial-then-final aggregate on ``user_id``; the join to
    the current users is many-to-one with one count row per user.
    """
    current = users_snapshot.where(F.col(VALID_TO).isNull()).select(
        "user_id",
        clean_email("email").alias("email"),
        F.upper("country_code").alias("country_code"),
        "signup_channel", "kyc_status",
        F.col("created_at").alias("user_created_at"),
        F.col("updated_at").alias("user_updated_at"),
    )
    counts = stg_wallets.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("wallet_count"),
        F.count_if(F.col("chain") == "ethereum").alias("ethereum_wallet_count"),
    )
    j = current.join(counts, "user_id", "left")
    return j.select(
        "user_id", "email", "country_code", "signup_channel", "kyc_status",
        F.coalesce(F.col("wallet_count"), F.lit(0).cast("bigint")).alias("wallet_count"),
        F.coalesce(F.col("ethereum_wallet_count"), F.lit(0).cast("bigint")).alias("ethereum_wallet_count"),
        "user_created_at", "user_updated_at",
    )


def dim_users_history(users_snapshot: DataFrame) -> DataFrame:
    h = users_snapshot.select(
        "user_id",
        clean_email("email").alias("email"),
        F.upper("country_code").alias("country_code"),
        "signup_channel", "kyc_status", VALID_FROM, VALID_TO,
    )
    return with_is_current(h)


def dim_wallets(stg_wallets: DataFrame) -> DataFrame:
    return stg_wallets.select(
        "wallet_id", "user_id", "chain", "address", "wallet_type", "is_primary",
        F.col("created_at").alias("wallet_created_at"),
        F.col("updated_at").alias("wallet_updated_at"),
    )


def fact_transactions(stg_transactions: DataFrame, dim_wallets_df: DataFrame) -> DataFrame:
    """Transactions enriched with the wallet's user and chain; unmatched kept.

    Many-to-one on ``wallet_id`` (the dimension is unique on it), so no
    fan-out. The dimension is not hinted: AQE broadcasts it when its measured
    size is under the threshold and otherwise keeps the sort-merge join, whose
    skewed partitions (a hot wallet) it splits.
    """
    w = dim_wallets_df.select("wallet_id", "user_id", "chain")
    j = stg_transactions.join(w, "wallet_id", "left")
    return j.select(
        "transaction_id", "wallet_id", "user_id", "chain", "tx_hash", "direction", "asset_symbol",
        "amount", "usd_value_at_tx", "fee_native", "status", "confirmation_seconds",
        "submitted_at", "confirmed_at",
        trunc_ntz("day", "submitted_at").alias("submitted_date"),
    )


def time_spine(spark: SparkSession, start: Column | str, end: Column | str) -> DataFrame:
    """One row per calendar day from ``start`` to ``end`` inclusive (``date_day`` DATE).

    Its size is the number of days in the range: bounded, so safe to broadcast.
    """
    s = F.to_date(F.lit(start)) if isinstance(start, str) else F.to_date(start)
    e = F.to_date(F.lit(end)) if isinstance(end, str) else F.to_date(end)
    return spark.range(1).select(F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias("date_day"))


def time_spine_over(df: DataFrame, ts_col: str) -> DataFrame:
    """The spine spanning the days of ``ts_col`` in ``df`` (bounds from one aggregate)."""
    bounds = df.agg(F.min(F.to_date(ts_col)).alias("_lo"), F.max(F.to_date(ts_col)).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias("date_day"))
