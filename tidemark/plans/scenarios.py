"""Controlled change sets used to prove the history models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def promote_pending(users: DataFrame, n: int, at: Column, key: str = "user_id") -> DataFrame:
    """The first ``n`` users (by key) with ``kyc_status = 'pending'`` become
    ``verified`` with ``updated_at = at``; everyone else is unchanged.

    The chosen keys are a top-``n`` (a per-task partial limit, then one final
    merge of at most n rows per task), so the broadcast side is at most ``n``
    rows by construction.
    """
    chosen = (users.where(F.col("kyc_status") == "pending").select(key).orderBy(key).limit(n)
              .withColumn("_promoted", F.lit(True)))
    j = users.join(F.broadcast(chosen), key, "left")
    hit = F.col("_promoted").isNotNull()
    return j.select(*[
        F.when(hit, F.lit("verified")).otherwise(F.col(c)).alias(c) if c == "kyc_status"
        else F.when(hit, at.cast(users.schema["updated_at"].dataType)).otherwise(F.col(c)).alias(c)
        if c == "updated_at" else F.col(c)
        for c in users.columns
    ])


def versions_histogram(history: DataFrame, key: str = "user_id") -> DataFrame:
    """How many keys have 1, 2, ... versions (partial aggregation on the key)."""
    per_key = history.groupBy(key).agg(F.count(F.lit(1)).alias("versions"))
    return per_key.groupBy("versions").agg(F.count(F.lit(1)).alias("users"))
