"""Staging models: one current, cleaned row per key.

They stay lazy (the warehouse materializes staging as views), so each mart is
one Catalyst plan from the bronze scan to its output.

Of a key's rows the one with the latest ``updated_at`` counts; among equal ones the
last change (``tiebreak``, by default the change's commit time and log position where
the bronze table has them). A merged state holds one row a key and says so
(``one_per_key``): it is read as it lies, without the exchange that ranking needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import boundary_seconds, clean_email, nullif_blank
from tidemark.operators import cdc
from tidemark.operators.dedupe import latest_per_key


def _newest(bronze: DataFrame, key: str, tiebreak: list[str] | None, one_per_key: bool) -> DataFrame:
    if one_per_key:
        return bronze
    if tiebreak is None:
        tiebreak = [c for c in (cdc.TS, cdc.LSN) if c in bronze.columns]
    return latest_per_key(bronze, key, ["updated_at", *tiebreak])


def stg_users(bronze_users: DataFrame, tiebreak: list[str] | None = None, one_per_key: bool = False) -> DataFrame:
    d = _newest(bronze_users, "user_id", tiebreak, one_per_key)
    return d.select(
        "user_id",
        clean_email("email").alias("email"),
        F.upper("country_code").alias("country_code"),
        "signup_channel", "kyc_status", "created_at", "updated_at",
    )


def stg_wallets(bronze_wallets: DataFrame, tiebreak: list[str] | None = None, one_per_key: bool = False) -> DataFrame:
    d = _newest(bronze_wallets, "wallet_id", tiebreak, one_per_key)
    return d.select(
        "wallet_id", "user_id",
        F.lower("chain").alias("chain"),
        F.lower("address").alias("address"),
        "wallet_type", "is_primary", "created_at", "updated_at",
    )


def stg_transactions(bronze_transactions: DataFrame, tiebreak: list[str] | None = None,
                     one_per_key: bool = False) -> DataFrame:
    d = _newest(bronze_transactions, "transaction_id", tiebreak, one_per_key)
    return d.select(
        "transaction_id", "wallet_id",
        nullif_blank("tx_hash").alias("tx_hash"),
        "direction",
        F.upper("asset_symbol").alias("asset_symbol"),
        F.col("amount").cast(schemas.DEC_AMOUNT).alias("amount"),
        F.col("usd_value_at_tx").cast(schemas.DEC_USD).alias("usd_value_at_tx"),
        F.col("fee_native").cast(schemas.DEC_AMOUNT).alias("fee_native"),
        "status", "submitted_at", "confirmed_at", "updated_at",
        F.when(F.col("confirmed_at").isNotNull(),
               boundary_seconds("submitted_at", "confirmed_at")).alias("confirmation_seconds"),
    )
