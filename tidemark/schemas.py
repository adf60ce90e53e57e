"""Explicit schemas and value sets.

Every read in the library passes a schema: JSON inference types an absent
``before`` image as STRING and the delete path's ``before.<pk>`` then fails to
analyse, so nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's (accepted-value sets,
# failure statuses, freshness thresholds). Kept together and in natural order.
# ---------------------------------------------------------------------------
KYC_STATUSES = ["pending", "verified", "rejected"]
CHAINS = ["ethereum", "bsc", "polygon", "arbitrum", "base"]
TX_STATUSES = ["pending", "confirmed", "failed"]
FAILURE_STATUSES = ["fail", "error", "runtime error"]
FRESHNESS_WARN_HOURS = 6
FRESHNESS_ERROR_HOURS = 24
ALERT_MESSAGE_MAX_CHARS = 500
ALERT_TOP_N = 10
# Change-event operations: create, update, delete, snapshot read.
CDC_OPS = ["c", "u", "d", "r"]

DEC_AMOUNT = T.DecimalType(38, 18)
DEC_USD = T.DecimalType(18, 2)

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("signup_channel", T.StringType()),
    T.StructField("kyc_status", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

WALLETS = T.StructType([
    T.StructField("wallet_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("chain", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("wallet_type", T.StringType()),
    T.StructField("is_primary", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("wallet_id", T.LongType()),
    T.StructField("tx_hash", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("asset_symbol", T.StringType()),
    T.StructField("amount", DEC_AMOUNT),
    T.StructField("usd_value_at_tx", DEC_USD),
    T.StructField("fee_native", DEC_AMOUNT),
    T.StructField("status", T.StringType()),
    T.StructField("submitted_at", T.TimestampNTZType()),
    T.StructField("confirmed_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

ENTITIES = {"users": USERS, "wallets": WALLETS, "transactions": TRANSACTIONS}
PRIMARY_KEYS = {"users": "user_id", "wallets": "wallet_id", "transactions": "transaction_id"}
# Bronze table name per entity (the batch job writes cdc_<t>; models read <t>).
BRONZE_NAMES = {t: f"cdc_{t}" for t in ENTITIES}


def as_json_payload(entity: T.StructType) -> T.StructType:
    """The row image as it travels in JSON: decimals and timestamps as strings."""
    fields = []
    for f in entity.fields:
        if isinstance(f.dataType, (T.DecimalType, T.TimestampType, T.TimestampNTZType)):
            fields.append(T.StructField(f.name, T.StringType()))
        else:
            fields.append(T.StructField(f.name, f.dataType))
    return T.StructType(fields)


SOURCE_INFO = T.StructType([
    T.StructField("lsn", T.LongType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("db", T.StringType()),
    T.StructField("table", T.StringType()),
])


def envelope(image: T.StructType) -> T.StructType:
    """One landed change event: ``{table, op, ts_ms, before, after, source, consumed_at}``."""
    return T.StructType([
        T.StructField("table", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("before", image),
        T.StructField("after", image),
        T.StructField("source", SOURCE_INFO),
        T.StructField("consumed_at", T.StringType()),
    ])


# Topic record as a message broker source delivers it (key/value bytes or text).
TOPIC_RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])

# Check-result file written by a test runner: metadata + results[].
CHECK_RESULT = T.StructType([
    T.StructField("unique_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("execution_time", T.DoubleType()),
])
RUN_RESULTS = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("invocation_id", T.StringType())])),
    T.StructField("results", T.ArrayType(CHECK_RESULT)),
])
