"""Domain tables derived from the supplied tables (FIXTURES.md section 3).

``customer`` becomes ``users``, ``(customer, priority)`` pairs of ``orders``
become ``wallets`` and ``orders`` become ``transactions``. Values are dirty on
purpose (padding, mixed case, blank hashes) so the staging models have work
to do. ``events`` read as a change log of users drives the CDC, SCD2 and
streaming operators; ``lineitem`` gives duplicated bronze rows and an on-chain
feed; ``orders`` grouped per customer gives API response bodies.

Everything is a lazy DataFrame over the scans, so each fixture costs what the
model built on it needs and grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import epoch_ms
from tidemark.sources.tables import Tables

# Fixed values of the mapping (FIXTURES.md): the chain named by each order-priority digit.
PRIORITY_CHAIN = {"1": "Ethereum", "2": "BSC", "3": "Polygon", "4": "Arbitrum", "5": "Base"}
PRIORITY_ASSET = {"2": "bnb", "3": "matic"}  # all other priorities: eth
EPOCH_FALLBACK = "1995-01-01 00:00:00"
# Change-log labels of event types: error deletes, signup creates, rest update.
EVENT_OP = {"error": "d", "signup": "c"}
CDC_SPLIT = "2024-01-15 00:00:00"
# Until when each snapshot run of a stored history sees the events; the last one sees all.
SNAPSHOT_RUNS = ["2024-01-10 00:00:00", "2024-01-20 00:00:00", "2100-01-01 00:00:00"]
PAGE_SIZE = 200
ONCHAIN_SPLIT = "1998-01-01 00:00:00"


def _case(col: F.Column, mapping: dict, default) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def ntz(literal: str) -> F.Column:
    return F.lit(literal).cast("timestamp_ntz")


def bronze_users(t: Tables) -> DataFrame:
    c = t.customer
    first_last = (t.orders.groupBy("o_custkey")
                  .agg(F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at")))
    # nation holds one row per country; a customer of an unknown nation has no country code.
    # Its code: a letter for the region, then one for the nation (the supplied names share their first letters).
    letter = lambda c: F.char(F.lit(97) + F.col(c) % 26)
    country = t.nation.select("n_nationkey", F.concat(letter("n_regionkey"), letter("n_nationkey")).alias("country_code"))
    j = (c.join(first_last, c.c_custkey == first_last.o_custkey, "left")
         .join(country, c.c_nationkey == country.n_nationkey, "left"))
    key = F.col("c_custkey")
    return j.select(
        key.alias("user_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("@Example.com ")).alias("email"),
        F.col("country_code"),
        _case(key % 3, {0: "organic", 1: "referral"}, "paid_ad").alias("signup_channel"),
        _case(key % 5, {0: "pending", 4: "rejected"}, "verified").alias("kyc_status"),
        F.coalesce(F.col("first_at"), ntz(EPOCH_FALLBACK)).alias("created_at"),
        F.coalesce(F.col("last_at"), ntz(EPOCH_FALLBACK)).alias("updated_at"),
    )


def _wallet_id(cust: str = "o_custkey", prio: str = "o_orderpriority") -> F.Column:
    return F.col(cust) * 5 + F.substring(F.col(prio), 1, 1).cast("int") - 1


def bronze_wallets(t: Tables) -> DataFrame:
    # Aggregate first (map-side partial aggregation absorbs hot customers), then
    # rank the at most five wallets of each customer.
    g = (t.orders.groupBy("o_custkey", "o_orderpriority")
         .agg(F.min("o_orderdate").alias("created_at"), F.max("o_orderdate").alias("updated_at")))
    digit = F.substring(F.col("o_orderpriority"), 1, 1)
    w = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    return g.select(
        _wallet_id().alias("wallet_id"),
        F.col("o_custkey").alias("user_id"),
        _case(digit, {k: v for k, v in PRIORITY_CHAIN.items() if k != "5"}, PRIORITY_CHAIN["5"]).alias("chain"),
        F.concat(F.lit("0X"), F.upper(F.md5(F.concat(F.col("o_custkey").cast("string"), F.lit("-"),
                                                      F.col("o_orderpriority"))))).alias("address"),
        F.lit("non_custodial").alias("wallet_type"),
        (F.row_number().over(w) == 1).alias("is_primary"),
        "created_at", "updated_at",
    )


def bronze_transactions(t: Tables) -> DataFrame:
    o = t.orders
    key = F.col("o_orderkey")
    digit = F.substring(F.col("o_orderpriority"), 1, 1)
    usd = F.col("o_totalprice").cast(schemas.DEC_USD)
    offset = key % 86400
    return o.select(
        key.alias("transaction_id"),
        _wallet_id().alias("wallet_id"),
        F.when(F.col("o_orderstatus") == "O", F.lit(" ")).otherwise(F.md5(key.cast("string"))).alias("tx_hash"),
        _case(key % 3, {0: "send", 1: "receive"}, "swap").alias("direction"),
        _case(digit, PRIORITY_ASSET, "eth").alias("asset_symbol"),
        usd.cast(schemas.DEC_AMOUNT).alias("amount"),
        usd.alias("usd_value_at_tx"),
        ((key % 100).cast("decimal(18,0)") / 10000).cast("decimal(18,4)").alias("fee_native"),
        _case(F.col("o_orderstatus"), {"F": "confirmed", "O": "pending"}, "failed").alias("status"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=offset)).alias("submitted_at"),
        F.when(F.col("o_orderstatus") == "F",
               F.col("o_orderdate") + F.make_dt_interval(secs=offset + 5 + key % 596)).alias("confirmed_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


# ---------------------------------------------------------------------------
# events as a change log of users
# ---------------------------------------------------------------------------

def change_log(t: Tables) -> DataFrame:
    """Typed change log: one row per event, key ``user_id``, order ``(ts_ms, event_id)``.

    The after-image is ``(user_id, event_type, value, k)``; deletes carry the
    key in their before-image and no after-image, like a real delete event.
    """
    e = t.events
    op = _case(F.col("event_type"), EVENT_OP, "u")
    image = F.struct(
        F.col("user_id"), F.col("event_type"),
        (F.col("value") + F.lit(0.0)).alias("value"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    key_only = F.struct(F.col("user_id"), F.lit(None).cast("string").alias("event_type"),
                        F.lit(None).cast("double").alias("value"), F.lit(None).cast("bigint").alias("k"))
    return e.select(
        F.lit("users").alias("table"),
        op.alias("op"),
        epoch_ms("ts").alias("ts_ms"),
        F.when(op == "d", key_only).alias("before"),
        F.when(op != "d", image).alias("after"),
        F.struct(F.col("event_id").alias("lsn"), epoch_ms("ts").alias("ts_ms"),
                 F.lit("app").alias("db"), F.lit("users").alias("table")).alias("source"),
        F.col("ts"),
    )


def topic_records(t: Tables, prefix: str = "app") -> DataFrame:
    """``events`` as the records a CDC topic delivers (JSON text values).

    Click events arrive as logical-decoding messages (op ``m``, no row image),
    which the decoder must quarantine; every delete is followed by a tombstone
    (NULL value), which it must skip. The after-image travels with ``value``
    as a decimal string, as a connector set to string decimals sends it.
    """
    e = t.events
    base_op = _case(F.col("event_type"), EVENT_OP, "u")
    op = F.when(F.col("event_type") == "click", F.lit("m")).otherwise(base_op)
    after = F.struct(F.col("user_id"), F.col("event_type"),
                     F.format_string("%.2f", F.col("value") + F.lit(0.0)).alias("value"),
                     F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    before = F.struct(F.col("user_id"))
    env = F.struct(
        op.alias("op"),
        epoch_ms("ts").alias("ts_ms"),
        F.when(op == "d", before).alias("before"),
        F.when(op.isin("c", "u"), after).alias("after"),
        F.struct(F.col("event_id").alias("lsn"), epoch_ms("ts").alias("ts_ms")).alias("source"),
    )
    topic = F.lit(f"{prefix}.public.users")
    records = e.select(topic.alias("topic"), F.lit(0).alias("partition"),
                       (F.col("event_id") * 2).alias("offset"), F.to_json(env).alias("value"))
    tombstones = (e.where(F.col("event_type") == "error")
                  .select(topic.alias("topic"), F.lit(0).alias("partition"),
                          (F.col("event_id") * 2 + 1).alias("offset"), F.lit(None).cast("string").alias("value")))
    return records.unionByName(tombstones)


def evolving_changes(t: Tables) -> DataFrame:
    """``events`` as landed lines (``value``, ``table``, ``dt``) whose image changes at ``CDC_SPLIT``:
    from then on it also has ``k``, and the ``value`` of clicks is a text."""
    e, later = t.events, F.col("ts") >= F.lit(CDC_SPLIT).cast("timestamp_ntz")
    op = _case(F.col("event_type"), EVENT_OP, "u")
    k, number = F.get_json_object("props", "$.k").cast("bigint").alias("k"), (F.col("value") + F.lit(0.0)).alias("value")
    text = F.concat(F.lit("about "), F.col("user_id").cast("string")).alias("value")
    image = (F.when(~later, F.to_json(F.struct("user_id", "event_type", number)))
             .when(F.col("event_type") == "click", F.to_json(F.struct("user_id", "event_type", text, k)))
             .otherwise(F.to_json(F.struct("user_id", "event_type", number, k))))
    line = F.concat(F.lit('{"op":"'), op, F.lit('","ts_ms":'), epoch_ms("ts").cast("string"),
                    F.when(op == "d", F.concat(F.lit(',"before":{"user_id":'), F.col("user_id").cast("string"), F.lit("}")))
                    .otherwise(F.concat(F.lit(',"after":'), image)),
                    F.lit(',"source":{"lsn":'), F.col("event_id").cast("string"), F.lit("}}"))
    return e.select(line.alias("value"), F.lit("users").alias("table"),
                    F.when(later, F.lit(LANDING_DAYS[1])).otherwise(F.lit(LANDING_DAYS[0])).alias("dt"))


# ---------------------------------------------------------------------------
# changes of the three entities, as a connector lands them
# ---------------------------------------------------------------------------
# The column that tells the versions of a row apart, and the one that a bad change spoils.
CHANGED = {"users": "kyc_status", "wallets": "wallet_type", "transactions": "status"}
SPOILED = {"users": "updated_at", "wallets": "updated_at", "transactions": "amount"}
LANDING_DAYS = ["2030-01-01", "2030-01-02"]


def entity_changes(bronze: DataFrame, entity: str, landed: str | None = None) -> DataFrame:
    """Landed lines (``value``, ``table``, ``dt``) of two days, or of ``landed`` alone, that lead to ``bronze``.

    Every key k is created, then updated to its row at ``updated_at``; lsn is 10 k
    and a step. Some keys also have: a redelivered update (k mod 7 = 0), a second
    update at the same instant (k mod 5 = 1), a delete (k mod 11 = 3), an older
    change that arrives late (k mod 13 = 4), a value that does not parse
    (k mod 17 = 5), an unknown operation (k mod 19 = 6), an image without key
    (k mod 23 = 7), a cut-off line (k mod 29 = 8).
    """
    payload, key = schemas.as_json_payload(schemas.ENTITIES[entity]), schemas.PRIMARY_KEYS[entity]
    k, ms, n, always = F.col(key), F.col("_ms"), F.col("_n"), F.lit(True)
    # When, day, operation, milliseconds from the update, step.
    changes = [(always, 0, "c", -2000, 0), (always, 0, "u", 0, 1), (k % 7 == 0, 1, "u", 0, 1), (k % 5 == 1, 0, "u", 0, 2),
               (k % 11 == 3, 1, "d", 1000, 3), (k % 13 == 4, 1, "u", -5000, 4), (k % 17 == 5, 1, "u", 2000, 5),
               (k % 19 == 6, 1, "m", 3000, 6), (k % 23 == 7, 0, "u", 4000, 7), (k % 29 == 8, 1, "u", 5000, 8)]
    marked, deleted, spoiled, unknown, keyless, cut = {0: "first", 3: "second", 5: "late"}, 4, 6, 7, 8, 9
    # A value is formatted once a key, for keys with a change to land. The changes are numbers until they are rows,
    # so that each line is formatted once and only on its day; NULL numbers go after the explode, as it then compiles.
    wanted = [(i, c[0]) for i, c in enumerate(changes) if landed in (None, LANDING_DAYS[c[1]])]
    some = wanted[0][1]
    for _, when in wanted[1:]:
        some = some | when
    cells = bronze.where(some).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in payload.fields], epoch_ms("updated_at").alias("_ms"))
    lines = cells.select("*", F.explode(F.array(*[F.when(when, F.lit(i)) for i, when in wanted])).alias("_n")).where(n.isNotNull())

    def told(field):
        return F.element_at(F.array(*[F.lit(c[field]) for c in changes]), n + 1)

    def sent(f):
        value = F.col(f.name)
        if f.name == CHANGED[entity]:
            for i, text in marked.items():
                value = F.when(n == i, F.lit(text)).otherwise(value)
        if f.name == SPOILED[entity]:
            value = F.when(n == spoiled, F.lit("n/a")).otherwise(value)
        if f.name == key:
            value = F.when(n != keyless, value)
        return value.alias(f.name)

    row = F.struct(*[sent(f) for f in payload.fields])
    key_only = F.struct(*[(k if f.name == key else F.lit(None)).cast(f.dataType).alias(f.name) for f in payload.fields])
    body = F.to_json(F.struct(told(2).alias("op"), (ms + told(3)).alias("ts_ms"), F.when(n == deleted, key_only).alias("before"),
                              F.when(~n.isin(deleted, unknown), row).alias("after"),
                              F.struct((k * 10 + told(4)).alias("lsn")).alias("source")))
    text = F.when(n == cut, F.concat(F.lit('{"op": "u", "ts_ms": '), k.cast("string"))).otherwise(body)
    day = F.when(n.isin([i for i, c in enumerate(changes) if c[1] == 0]), F.lit(LANDING_DAYS[0])).otherwise(F.lit(LANDING_DAYS[1]))
    return lines.select(text.alias("value"), F.lit(entity).alias("table"), day.alias("dt"))


# ---------------------------------------------------------------------------
# lineitem as duplicated bronze rows and as an on-chain feed
# ---------------------------------------------------------------------------

LINEITEM_KEY = ["l_orderkey", "l_linenumber"]
LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def onchain_feed(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("hash"),
        F.col("l_returnflag").alias("_chain"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.col("l_partkey").alias("block_number"),
        F.col("l_suppkey").alias("nonce"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_quantity").alias("gas"),
    )


# ---------------------------------------------------------------------------
# orders as API response bodies, one per customer
# ---------------------------------------------------------------------------

def api_bodies(t: Tables) -> DataFrame:
    """Per customer one JSON body ``{status, message, result: [...]}``.

    Customers with ``o_custkey % 10 = 0`` get a rate-limit style error body
    (``status '0'``, ``message 'NOTOK'``); the rest succeed. Values are strings,
    as the API sends them.
    """
    o = t.orders
    # Page the result like the API does (about PAGE_SIZE items per body), so no
    # body grows with one address's history.
    pages = (o.groupBy("o_custkey").agg(F.count("*").alias("_n"))
             .select("o_custkey", F.ceil(F.col("_n") / PAGE_SIZE).alias("_pages")))
    o = o.join(pages, "o_custkey").withColumn("_page", F.pmod(F.col("o_orderkey"), F.col("_pages")))
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("hash"),
        F.col("o_custkey").cast("string").alias("from"),
        F.col("o_orderpriority").alias("to"),
        F.format_string("%.2f", F.col("o_totalprice")).alias("value"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timeStamp"),
    )
    g = o.groupBy("o_custkey", "_page").agg(F.collect_list(item).alias("result"))
    bad = (F.col("o_custkey") % 10) == 0
    body = F.to_json(F.struct(
        F.when(bad, F.lit("0")).otherwise(F.lit("1")).alias("status"),
        F.when(bad, F.lit("NOTOK")).otherwise(F.lit("OK")).alias("message"),
        F.col("result"),
    ))
    return g.select(F.col("o_custkey").cast("string").alias("address"), F.col("_page").alias("page"),
                    F.lit("ethereum").alias("chain"), body.alias("body"))
