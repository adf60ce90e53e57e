"""The project's declared checks over the model graph.

26 generic checks (13 not_null, 6 unique, 3 accepted_values, 4 relationships)
and the 2 singular ones, plus failing inputs taken from the supplied tables:
the raw (not yet lower-cased) wallet chains and customer balances, which hold
negative values -- the injected-negative-value scenario.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators.quality import Check
from tidemark.plans.domain import Domain
from tidemark.schemas import CHAINS, KYC_STATUSES, TX_STATUSES


MODEL_NAMES = ["stg_users", "stg_wallets", "stg_transactions", "dim_users", "dim_users_history",
               "dim_wallets", "fact_transactions", "bronze_wallets"]
TABLE_NAMES = ["customer", "lineitem"]


def models(d: Domain, names: set[str] | None = None) -> dict[str, DataFrame]:
    """The models (and supplied tables) checks refer to; only ``names`` are built."""
    out = {}
    for n in MODEL_NAMES:
        if names is None or n in names:
            out[n] = getattr(d, n)
    for n in TABLE_NAMES:
        if names is None or n in names:
            out[n] = getattr(d.t, n)
    return out


def checked_columns(checks: Sequence[Check]) -> dict[str, list[str]]:
    """The columns of each model that the checks read."""
    pairs = [(c.model, x) for c in checks for x in (c.column, c.where) if x]
    pairs += [(c.to, c.field) for c in checks if c.to]
    return {model: sorted({x for m, x in pairs if m == model}) for model, _ in pairs}


def passes(checks: Sequence[Check]) -> Counter:
    """How often ``quality.run_checks`` reads each model: once for its own checks
    with one key column, once for each further key column, once a relationship."""
    own = {(c.model, c.column if c.kind in ("unique", "at_most_one") else None) for c in checks if c.kind != "relationships"}
    keyed = {m for m, key in own if key}
    return Counter([m for m, key in own if key or m not in keyed]
                   + [m for c in checks if c.to for m in (c.model, c.to)])


NOT_NULL = [Check("not_null", m, c) for m, c in [
    ("stg_users", "user_id"), ("stg_wallets", "wallet_id"), ("stg_wallets", "user_id"),
    ("stg_transactions", "transaction_id"), ("stg_transactions", "wallet_id"),
    ("dim_users", "user_id"), ("dim_users_history", "user_id"), ("dim_users_history", "valid_from"),
    ("dim_users_history", "is_current"), ("dim_wallets", "wallet_id"), ("dim_wallets", "user_id"),
    ("fact_transactions", "transaction_id"), ("fact_transactions", "wallet_id"),
]]

UNIQUE = [Check("unique", m, c) for m, c in [
    ("stg_users", "user_id"), ("stg_wallets", "wallet_id"), ("stg_transactions", "transaction_id"),
    ("dim_users", "user_id"), ("dim_wallets", "wallet_id"), ("fact_transactions", "transaction_id"),
]]

ACCEPTED = [
    Check("accepted_values", "stg_users", "kyc_status", values=tuple(KYC_STATUSES)),
    Check("accepted_values", "stg_wallets", "chain", values=tuple(CHAINS)),
    Check("accepted_values", "stg_transactions", "status", values=tuple(TX_STATUSES)),
]

RELATIONSHIPS = [
    Check("relationships", "stg_wallets", "user_id", to="stg_users", field="user_id"),
    Check("relationships", "stg_transactions", "wallet_id", to="stg_wallets", field="wallet_id"),
    Check("relationships", "dim_wallets", "user_id", to="dim_users", field="user_id"),
    Check("relationships", "fact_transactions", "wallet_id", to="dim_wallets", field="wallet_id"),
]

SINGULAR = [
    Check("at_most_one", "dim_users_history", "user_id", where="is_current",
          name="assert_one_current_row_per_user"),
    Check("range", "fact_transactions", "usd_value_at_tx", min_value=0,
          name="assert_transaction_usd_value_non_negative"),
]

# Inputs that must fail: mixed-case chains before staging, negative balances,
# and a column that is not a key.
FAILING = [
    Check("accepted_values", "bronze_wallets", "chain", values=tuple(CHAINS)),
    Check("range", "customer", "c_acctbal", min_value=0),
    Check("unique", "lineitem", "l_orderkey"),
]

DECLARED = NOT_NULL + UNIQUE + ACCEPTED + RELATIONSHIPS + SINGULAR
ALL = DECLARED + FAILING
