"""Latest row per key and newest N per key.

Both are ``row_number() over (partition by key order by ...)`` filtered to a
rank bound. Catalyst rewrites that filter into a *partial* ``WindowGroupLimit``
that runs in every map task before the shuffle, so at most N rows per key and
per input partition cross the network: a key holding a third of the table
costs one row per map task, not a third of the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rn"


def _order_cols(order_by: Sequence[Column | str], descending: bool) -> list[Column]:
    cols = []
    for c in order_by:
        c = F.col(c) if isinstance(c, str) else c
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return cols


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order_by: Sequence[Column | str],
                   descending: bool = True) -> DataFrame:
    """One row per ``key``: the first under ``order_by`` (descending by default).

    ``order_by`` should be a total order within a key (pass tie-breakers):
    with ties the survivor is whichever row the sort meets first.
    """
    return top_n_per_key(df, key, order_by, 1, descending)


def top_n_per_key(df: DataFrame, key: Sequence[str] | str, order_by: Sequence[Column | str],
                  n: int, descending: bool = True, rank_col: str | None = None) -> DataFrame:
    """At most ``n`` rows per key, optionally keeping the 1-based rank."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by, descending))
    out = df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) <= n)
    if rank_col:
        return out.withColumnRenamed(_RN, rank_col)
    return out.drop(_RN)
