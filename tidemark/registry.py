"""Registered queries: one per operator of SURVEY section 2, each over the
whole supplied tables of a folder. ``tidemark.oracle`` holds the equivalent
SQL for every query that has one.

Conventions that keep results comparable across engines: every computed
column is aliased; decimal sums are cast to ``decimal(38, s)``; averages are
rounded to 6 places; timestamps stay ``TIMESTAMP_NTZ``; orderings are total.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_ms
from tidemark.operators import cdc
from tidemark.operators.dedupe import latest_per_key, top_n_per_key
from tidemark.operators.scd2 import as_of_join, scd2_apply, scd2_from_log, with_is_current
from tidemark.plans import fixtures, marts
from tidemark.plans.domain import Domain
from tidemark.plans.metrics import METRICS, MetricRequest, metric_query, users_measure
from tidemark.schemas import DEC_USD
from tidemark.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
ALL_METRICS = list(METRICS)
USER_KEY = "user_id"


def _round_avg(df: DataFrame, col: str = "avg_confirmation_seconds") -> DataFrame:
    return df.withColumn(col, F.round(F.col(col), 6)) if col in df.columns else df


# ---------------------------------------------------------------------------
# staging and marts
# ---------------------------------------------------------------------------

def q_stg_users(spark, sf):
    return Domain(spark, sf).stg_users


def q_stg_wallets(spark, sf):
    return Domain(spark, sf).stg_wallets


def q_stg_transactions(spark, sf):
    return Domain(spark, sf).stg_transactions


def q_latest_per_key(spark, sf):
    li = Tables(spark, sf).lineitem
    return latest_per_key(li, fixtures.LINEITEM_KEY, fixtures.LINEITEM_ORDER)


def q_dim_users(spark, sf):
    return Domain(spark, sf).dim_users


def q_dim_wallets(spark, sf):
    return Domain(spark, sf).dim_wallets


def q_fact_transactions(spark, sf):
    return Domain(spark, sf).fact_transactions


def q_time_spine(spark, sf):
    return marts.time_spine_over(Domain(spark, sf).fact_transactions, "submitted_at")


# ---------------------------------------------------------------------------
# metrics
# ---------------------------------------------------------------------------

def _metrics(spark, sf, group_by, metrics=None, grain="day", fill=None, users=False, fill_span="group"):
    d = Domain(spark, sf)
    req = MetricRequest(metrics=metrics or ALL_METRICS, group_by=group_by, grain=grain, fill=fill, fill_span=fill_span)
    return _round_avg(metric_query(d.fact_transactions, req, d.dim_users if users else None))


def q_metric_volume_by_day(spark, sf):
    return _metrics(spark, sf, ["metric_time"], ["transaction_volume_usd"], "day")


def q_metric_volume_by_week(spark, sf):
    return _metrics(spark, sf, ["metric_time"], ["transaction_volume_usd"], "week")


def q_metric_volume_by_month(spark, sf):
    return _metrics(spark, sf, ["metric_time"], ["transaction_volume_usd"], "month")


def q_metric_all_by_chain(spark, sf):
    return _metrics(spark, sf, ["chain"])


def q_metric_rate_by_status_direction(spark, sf):
    return _metrics(spark, sf, ["status", "direction"],
                    ["transaction_count", "confirmed_transaction_count", "confirmed_transaction_rate"])


def q_metric_by_user_dimension(spark, sf):
    return _metrics(spark, sf, ["user_id__country_code", "user_id__kyc_status", "user_id__signup_channel"],
                    ["transaction_volume_usd", "transaction_count", "confirmed_transaction_rate"], users=True)


def q_metric_wallet_count(spark, sf):
    return users_measure(Domain(spark, sf).dim_users, ["country_code"])


def q_metric_wallets_by_signup_month(spark, sf):
    return users_measure(Domain(spark, sf).dim_users, ["signup_channel"], grain="month")


def q_metric_by_user_created_day(spark, sf):
    """By the day of a user's creation; the supplied dates lie at midnight, so a time of day is added first."""
    d = Domain(spark, sf)
    later = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("user_id") % 86400).cast("decimal(18,6)"))
    users = d.dim_users.withColumn("user_created_at", F.col("user_created_at") + later)
    request = MetricRequest(["transaction_volume_usd", "transaction_count"], ["user_id__user_created_at"])
    return metric_query(d.fact_transactions, request, users)


def q_metric_filled_by_day(spark, sf):
    return _metrics(spark, sf, ["metric_time"], ["transaction_volume_usd", "transaction_count",
                                                  "avg_confirmation_seconds"], "day", fill=0)


def q_metric_filled_by_day_chain(spark, sf):
    """Every day between a chain's first and last, once a chain."""
    return _metrics(spark, sf, ["metric_time", "chain"], ["transaction_volume_usd", "transaction_count",
                                                          "avg_confirmation_seconds"], "day", fill=0)


def q_metric_filled_by_month(spark, sf):
    """Every month of the whole answer for every status and direction."""
    return _metrics(spark, sf, ["metric_time", "status", "direction"], ["transaction_count", "confirmed_transaction_rate"],
                    "month", fill=0, fill_span="all")


def q_metric_across_models(spark, sf):
    """Transactions and wallets by the users' sign-up channel and month, each counted in its own model."""
    from tidemark.plans.metrics import metrics_across
    d = Domain(spark, sf)
    request = MetricRequest(["transaction_count", "wallet_count"], ["user_id__signup_channel", "metric_time"], "month")
    return metrics_across(d.fact_transactions, d.dim_users, request)


# ---------------------------------------------------------------------------
# CDC
# ---------------------------------------------------------------------------
CHANGE_COLS = ["user_id", "event_type", "value", "k"]


def _change_rows(t: Tables) -> DataFrame:
    env = fixtures.change_log(t)
    valid, _ = cdc.split_valid(env, USER_KEY)
    return cdc.flatten(valid, USER_KEY, CHANGE_COLS)


def _state_cols(df: DataFrame) -> DataFrame:
    return df.select(*CHANGE_COLS, cdc.OP, cdc.TS, cdc.LSN)


def _topic_envelope_schema():
    from pyspark.sql import types as T
    from tidemark.schemas import envelope
    image = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                          T.StructField("value", T.StringType()), T.StructField("k", T.LongType())])
    return envelope(image)


def _decoded(t: Tables):
    env = cdc.decode_topic_records(fixtures.topic_records(t), _topic_envelope_schema())
    return cdc.split_valid(env, USER_KEY, env="_env")


def q_cdc_flatten(spark, sf):
    valid, _ = _decoded(Tables(spark, sf))
    flat = cdc.flatten(valid, USER_KEY, CHANGE_COLS, env="_env", keep=["table"])
    good, _ = cdc.cast_columns(flat, {"value": DEC_USD})
    return good


def q_cdc_quarantine(spark, sf):
    _, bad = _decoded(Tables(spark, sf))
    return bad.select("topic", "offset", F.col("_env.op").alias("op"), F.col(cdc.REASON).alias("reason"))


def q_cdc_compact(spark, sf):
    rows = _change_rows(Tables(spark, sf))
    return _state_cols(cdc.published(cdc.compact(rows, USER_KEY)))


def q_cdc_merge(spark, sf):
    t = Tables(spark, sf)
    rows = _change_rows(t)
    split = F.lit(fixtures.CDC_SPLIT).cast("timestamp_ntz")
    split_ms = epoch_ms(split)
    first, second = rows.where(F.col(cdc.TS) < split_ms), rows.where(F.col(cdc.TS) >= split_ms)
    state = cdc.merge_changes(None, first, USER_KEY)
    state = cdc.merge_changes(state, second, USER_KEY)
    return _state_cols(cdc.published(state))


ONCHAIN_KEY = ["hash", "_chain"]
ONCHAIN_FIRST = ["_ingested_at", "block_number", "nonce", "value"]


def q_cdc_insert_only_merge(spark, sf):
    feed = fixtures.onchain_feed(Tables(spark, sf))
    split = F.lit(fixtures.ONCHAIN_SPLIT).cast("timestamp_ntz")
    load1 = feed.where(F.col("_ingested_at") < split).withColumn("_loaded_at", split)
    load2 = feed.where(F.col("_ingested_at") >= split).withColumn(
        "_loaded_at", F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"))
    _, table = cdc.insert_only_merge(None, load1, ONCHAIN_KEY, ONCHAIN_FIRST)
    _, table = cdc.insert_only_merge(table, load2, ONCHAIN_KEY, ONCHAIN_FIRST)
    return table


def q_union_sources(spark, sf):
    """Per-chain landed feeds with differing columns, concatenated by name."""
    o = Tables(spark, sf).orders
    feeds = []
    for digit, chain in fixtures.PRIORITY_CHAIN.items():
        part = o.where(F.substring("o_orderpriority", 1, 1) == digit)
        cols = [F.col("o_orderkey").cast("string").alias("hash"), F.col("o_custkey").alias("from_id"),
                F.col("o_totalprice").alias("value"), F.lit(chain.lower()).alias("_chain")]
        if digit in ("1", "5"):  # feeds of two chains also carry the order status
            cols.append(F.col("o_orderstatus").alias("status"))
        feeds.append(part.select(*cols))
    return cdc.union_all(feeds)


def q_top_n_per_key(spark, sf):
    o = Tables(spark, sf).orders
    top = top_n_per_key(o.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"),
                        "o_custkey", ["o_orderdate", "o_orderkey"], 3, rank_col="rank")
    return top.withColumn("rank", F.col("rank").cast("bigint"))


# ---------------------------------------------------------------------------
# SCD2
# ---------------------------------------------------------------------------

def _user_states(t: Tables) -> DataFrame:
    """events as a users source: state = event_type, version time = ts."""
    return t.events.select("user_id", F.col("event_type").alias("state"), F.col("ts").alias("updated_at"),
                           "event_id")


def q_scd2_apply(spark, sf):
    states = _user_states(Tables(spark, sf))
    cut = F.lit(fixtures.CDC_SPLIT).cast("timestamp_ntz")
    run1 = states.where(F.col("updated_at") < cut).drop("event_id")
    run2 = states.drop("event_id")
    hist = scd2_apply(None, run1, USER_KEY, "updated_at")
    hist = scd2_apply(hist, run2, USER_KEY, "updated_at")
    return hist


def _stored_runs(spark, sf, hard_deletes: str = "ignore") -> DataFrame:
    """Three snapshot runs over a stored history, the last one twice: before each of the two
    instants, then all; with ``invalidate`` every 7th user is gone from the source from the second run on."""
    from tidemark.sources.catalog import job_database
    from tidemark.sources.history import snapshot_run
    name = f"{job_database(spark, 'history')}.users"
    states = _user_states(Tables(spark, sf)).drop("event_id")
    gone = F.col(USER_KEY) % 7 == 0
    for n, until in enumerate([*fixtures.SNAPSHOT_RUNS, fixtures.SNAPSHOT_RUNS[-1]]):
        at = F.lit(until).cast("timestamp_ntz")
        current = states.where(F.col("updated_at") < at)
        if n > 0 and hard_deletes == "invalidate":
            current = current.where(~gone)
        out = snapshot_run(spark, name, current, USER_KEY, "updated_at", hard_deletes, at)
    return out


def q_scd2_stored_runs(spark, sf):
    return _stored_runs(spark, sf)


def q_scd2_hard_deletes(spark, sf):
    return _stored_runs(spark, sf, "invalidate")


def _history(t: Tables, log: DataFrame | None = None) -> DataFrame:
    log = _user_states(t) if log is None else log
    return scd2_from_log(log, USER_KEY, "updated_at", ["user_id", "state", "updated_at"], tiebreak=["event_id"])


def q_scd2_from_log(spark, sf):
    return _history(Tables(spark, sf))


def q_dim_users_history(spark, sf):
    return with_is_current(_history(Tables(spark, sf)).drop("updated_at"))


def q_as_of_join(spark, sf):
    t = Tables(spark, sf)
    facts = (t.events.where(F.col("event_type") == "purchase")
             .select("event_id", "user_id", "ts", (F.col("value") + F.lit(0.0)).alias("value")))
    # The history is a mart (a table): written once, then read by both passes
    # of the as-of join instead of being rebuilt for each.
    from tidemark.sources.catalog import materialize
    # Purchases are the facts; the state they meet is that of all other events.
    others = _user_states(t).where(F.col("state") != "purchase")
    hist = materialize(spark, _history(t, others), "users-history")
    return as_of_join(facts, hist, USER_KEY, "ts", ["state"], how="left", row_id=["event_id"])


# Far below the rows of a user, so that the timelines are cut at every scale.
SMALL_STRETCH = 20


def q_scd2_from_log_split(spark, sf):
    return scd2_from_log(_user_states(Tables(spark, sf)), USER_KEY, "updated_at", ["user_id", "state", "updated_at"],
                         tiebreak=["event_id"], stretch_rows=SMALL_STRETCH)


def q_as_of_join_split(spark, sf):
    """All events at the start of their day, so that many share one instant, meet the state of their user then."""
    from tidemark.functions import trunc_ntz
    from tidemark.sources.catalog import materialize
    t = Tables(spark, sf)
    facts = t.events.select("event_id", "user_id", trunc_ntz("day", "ts").alias("ts"))
    history = scd2_from_log(_user_states(t), USER_KEY, "updated_at", ["user_id", "state", "updated_at"], tiebreak=["event_id"],
                            stretch_rows=SMALL_STRETCH)
    return as_of_join(facts, materialize(spark, history, "users-history"), USER_KEY, "ts", ["state"], stretch_rows=SMALL_STRETCH,
                      row_id=["event_id"])


# ---------------------------------------------------------------------------
# data quality and monitoring
# ---------------------------------------------------------------------------

def _checks(spark, sf, checks):
    """Checks run after a build: each model that more than one pass reads is
    written once, with its checked columns only, and every pass reads that."""
    from tidemark.operators.quality import run_checks
    from tidemark.plans import suite
    from tidemark.sources.catalog import materialize_all
    columns = suite.checked_columns(checks)
    models = {name: df.select(*columns[name]) for name, df in suite.models(Domain(spark, sf), set(columns)).items()}
    reads = suite.passes(checks)
    written = materialize_all(spark, {f"checked-{name}": df for name, df in models.items() if reads[name] > 1})
    return run_checks({name: written.get(f"checked-{name}", df) for name, df in models.items()}, checks)


def q_dq_not_null(spark, sf):
    from tidemark.plans import suite
    return _checks(spark, sf, suite.NOT_NULL)


def q_dq_unique(spark, sf):
    from tidemark.plans import suite
    return _checks(spark, sf, suite.UNIQUE + [c for c in suite.FAILING if c.kind == "unique"])


def q_dq_accepted_values(spark, sf):
    from tidemark.plans import suite
    return _checks(spark, sf, suite.ACCEPTED + [c for c in suite.FAILING if c.kind == "accepted_values"])


def q_dq_relationships(spark, sf):
    from tidemark.plans import suite
    return _checks(spark, sf, suite.RELATIONSHIPS)


def q_dq_one_open_version(spark, sf):
    from tidemark.operators.quality import Check, run_checks
    hist = with_is_current(q_scd2_apply(spark, sf))
    d = Domain(spark, sf)
    checks = [Check("at_most_one", "dim_users_history", "user_id", where="is_current",
                    name="assert_one_current_row_per_user"),
              Check("at_most_one", "events_history", "user_id", where="is_current",
                    name="assert_one_current_row_per_events_user")]
    return run_checks({"dim_users_history": d.dim_users_history, "events_history": hist}, checks)


def q_dq_non_negative(spark, sf):
    from tidemark.plans import suite
    return _checks(spark, sf, [c for c in suite.SINGULAR if c.kind == "range"]
                   + [c for c in suite.FAILING if c.kind == "range"])


FRESHNESS_AS_OF = "2024-01-31 08:00:00"


def q_dq_freshness(spark, sf):
    from tidemark.operators.quality import freshness
    d = Domain(spark, sf)
    sources = {"events": (d.t.events, "ts"), "users": (d.bronze_users, "updated_at"),
               "wallets": (d.bronze_wallets, "updated_at"), "transactions": (d.bronze_transactions, "updated_at")}
    return freshness(sources, F.lit(FRESHNESS_AS_OF).cast("timestamp_ntz"))


def _suite_results(spark, sf, write: bool = True):
    """The whole suite's results (one row per check). With ``write`` they are
    written once, for consumers that read them more than once (the alert)."""
    from tidemark.plans import suite
    from tidemark.sources.catalog import materialize
    results = _checks(spark, sf, suite.ALL)
    return materialize(spark, results, "check-results") if write else results


def q_dq_summary(spark, sf):
    from tidemark.plans.monitoring import status_counts
    return status_counts(_suite_results(spark, sf, write=False))


def q_dq_alert_top(spark, sf):
    from tidemark.plans.monitoring import alert
    return alert(_suite_results(spark, sf), invocation_id="suite")


def q_dq_failures(spark, sf):
    from tidemark.plans.monitoring import failures
    return failures(_suite_results(spark, sf, write=False))


# ---------------------------------------------------------------------------
# scenarios, landing, API bodies, streaming
# ---------------------------------------------------------------------------
RECONCILE_AT = "2030-01-01 00:00:00"


def q_scd2_reconcile(spark, sf):
    from tidemark.plans.scenarios import promote_pending, versions_histogram
    d = Domain(spark, sf)
    snap1 = scd2_apply(None, d.bronze_users, USER_KEY)
    mutated = promote_pending(d.bronze_users, 25, F.lit(RECONCILE_AT).cast("timestamp_ntz"))
    snap2 = scd2_apply(snap1, mutated, USER_KEY)
    return versions_histogram(snap2)


def _users_after_two_runs(spark, d: Domain) -> DataFrame:
    """The users snapshot after two runs: every 41st user comes with the second,
    which also finds every pending user verified. The first run's result is stored."""
    from tidemark.sources.catalog import materialize
    at = F.lit(RECONCILE_AT).cast("timestamp_ntz")
    pending = F.col("kyc_status") == "pending"
    now = d.bronze_users.withColumns({"updated_at": F.when(pending, at).otherwise(F.col("updated_at")),
                                      "kyc_status": F.when(pending, F.lit("verified")).otherwise(F.col("kyc_status"))})
    first = scd2_apply(None, d.bronze_users.where(F.col("user_id") % 41 != 0), USER_KEY)
    return scd2_apply(materialize(spark, first, "users-snapshot"), now, USER_KEY)


def q_dim_users_history_two_runs(spark, sf):
    from tidemark.plans import marts
    return marts.dim_users_history(_users_after_two_runs(spark, Domain(spark, sf)))


def q_dim_users_two_runs(spark, sf):
    """Current users where closed versions exist too."""
    from tidemark.plans import marts
    d = Domain(spark, sf)
    return marts.dim_users(_users_after_two_runs(spark, d), d.stg_wallets)


def q_api_flatten(spark, sf):
    from tidemark.sources.landing import flatten_api_bodies
    rows, _ = flatten_api_bodies(fixtures.api_bodies(Tables(spark, sf)))
    return rows.select(
        "address", "chain", "hash", F.col("from").alias("from_address"), F.col("to").alias("to_address"),
        F.col("value").try_cast(DEC_USD).alias("value"),
        F.to_timestamp_ntz(F.col("timeStamp")).alias("time_stamp"))


def q_api_quarantine(spark, sf):
    from tidemark.sources.landing import flatten_api_bodies
    _, rejected = flatten_api_bodies(fixtures.api_bodies(Tables(spark, sf)))
    return rejected.select("address", "page", "status", "message", "reason")


def _envelope_schema():
    from pyspark.sql import types as T
    from tidemark.schemas import envelope
    image = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                          T.StructField("value", T.DoubleType()), T.StructField("k", T.LongType())])
    return envelope(image)


def _landed_events(t: Tables) -> DataFrame:
    from tidemark.sources.landing import landing_frame
    env = fixtures.change_log(t)
    return landing_frame(env, F.col("ts")).drop("ts")


def q_cdc_land_and_scan(spark, sf):
    """Land the change log as partitioned JSON, scan it back with the schema."""
    from tidemark.sources.landing import read_cdc, write_landing
    from tidemark.streaming.jobs import job_folder
    root = job_folder(spark, "landing")
    write_landing(_landed_events(Tables(spark, sf)), root)
    env = read_cdc(spark, root, "users", _envelope_schema())
    valid, _ = cdc.split_valid(env, USER_KEY)
    return _state_cols(cdc.flatten(valid, USER_KEY, CHANGE_COLS))


def _land_in_two_steps(spark, sf, root, run):
    from tidemark.sources.landing import write_landing
    landed = _landed_events(Tables(spark, sf))
    split_ms = epoch_ms(F.lit(fixtures.CDC_SPLIT).cast("timestamp_ntz"))
    write_landing(landed.where(F.col("ts_ms") < split_ms), root)
    run()
    write_landing(landed.where(F.col("ts_ms") >= split_ms), root)
    run()
    run()  # a third run finds nothing new


def q_stream_append(spark, sf):
    from tidemark.streaming.jobs import append_job, job_folder
    base = job_folder(spark, "stream-append")
    land, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/checkpoint"
    _land_in_two_steps(spark, sf, land, lambda: append_job(
        spark, land, "users", _envelope_schema(), USER_KEY, CHANGE_COLS, sink, ckpt, f"{base}/rejects"))
    return spark.read.parquet(sink).select(*CHANGE_COLS, cdc.OP, cdc.TS, cdc.LSN)


def q_stream_upsert(spark, sf):
    from tidemark.sources.catalog import job_database
    from tidemark.streaming.jobs import job_folder, upsert_job
    base, name = job_folder(spark, "stream-upsert"), f"{job_database(spark, 'stream_upsert')}.users_state"
    _land_in_two_steps(spark, sf, f"{base}/landing", lambda: upsert_job(
        spark, f"{base}/landing", "users", _envelope_schema(), USER_KEY, CHANGE_COLS, name, f"{base}/checkpoint",
        f"{base}/rejects"))
    return _state_cols(cdc.published(spark.table(name)))


ONCHAIN_CHAINS = ["A", "N", "R", "X"]  # "X" has no folder: it must read as empty


def q_onchain_land_and_scan(spark, sf):
    """Land the on-chain feed per chain and date, scan the chains back."""
    from pyspark.sql import types as T
    from tidemark.sources.landing import onchain_landing_frame, read_onchain, write_onchain_landing
    from tidemark.streaming.jobs import job_folder
    root = job_folder(spark, "onchain")
    feed = fixtures.onchain_feed(Tables(spark, sf))
    # One landing run per year of the feed (a yearly backfill): dt = run date.
    landed = onchain_landing_frame(feed, F.col("_chain"), F.col("_ingested_at"),
                                   F.trunc(F.to_date("_ingested_at"), "year"))
    write_onchain_landing(landed, root)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in feed.schema.fields])
    scanned = read_onchain(spark, root, ONCHAIN_CHAINS, schema)
    return scanned.select(*feed.columns)


def q_stream_land_topics(spark, sf):
    """Topic records -> decode -> landing sink (rejected ones to their own folder), as one
    ``availableNow`` stream; the landed folder is then scanned and flattened."""
    from tidemark.schemas import TOPIC_RECORD
    from tidemark.sources.landing import envelopes_for_landing, read_cdc, stream_landing
    from tidemark.streaming.jobs import job_folder
    base = job_folder(spark, "stream-land")
    broker, land, ckpt = f"{base}/broker", f"{base}/landing", f"{base}/checkpoint"
    fixtures.topic_records(Tables(spark, sf)).write.mode("overwrite").json(broker)
    records = spark.readStream.schema(TOPIC_RECORD).json(broker)
    decoded = cdc.decode_topic_records(records, _topic_envelope_schema())
    tagged = cdc.tag_rejects(decoded, USER_KEY, env="_env")
    stream_landing(envelopes_for_landing(tagged), land, ckpt, available_now=True).awaitTermination()
    env = read_cdc(spark, land, "users", _topic_envelope_schema())
    flat = cdc.flatten(env, USER_KEY, CHANGE_COLS, keep=["table"])
    good, _ = cdc.cast_columns(flat, {"value": DEC_USD})
    return good


def q_bronze_cdc_job(spark, sf):
    """The batch CDC job run after each of two landings and once more with
    nothing new; the published state equals one compaction of the whole log."""
    from tidemark.plans.bronze import merge_cdc_table
    from tidemark.sources.catalog import job_database
    from tidemark.streaming.jobs import job_folder
    base, name = job_folder(spark, "bronze-cdc"), f"{job_database(spark, 'bronze_cdc')}.users_state"
    _land_in_two_steps(spark, sf, f"{base}/landing", lambda: merge_cdc_table(
        spark, f"{base}/landing", "users", _envelope_schema(), USER_KEY, CHANGE_COLS, name, f"{base}/rejects"))
    return _state_cols(cdc.published(spark.table(name)))


def _in_four_batches(rows: DataFrame) -> list[DataFrame]:
    """The changes in batches that cut through the keys' histories, the newest quarter first."""
    quarter = F.pmod(F.hash(USER_KEY, cdc.LSN), F.lit(4))
    split_ms = epoch_ms(F.lit(fixtures.CDC_SPLIT).cast("timestamp_ntz"))
    late = F.col(cdc.TS) >= split_ms
    return [rows.where(late & (quarter < 2)), rows.where(~late), rows.where(late & (quarter == 2)),
            rows.where(late & (quarter == 3))]


def q_state_merge_on_read(spark, sf):
    """Four runs append their compacted batch, one of them twice; the view shows one compaction of all."""
    from tidemark.sources import state
    from tidemark.sources.catalog import job_database
    name = f"{job_database(spark, 'state')}.users"
    batches = _in_four_batches(_change_rows(Tables(spark, sf)))
    for batch in [*batches, batches[1]]:
        state.merge_into_table(spark, name, batch, USER_KEY)
    return _state_cols(cdc.published(state.read_state(spark, name)))


def q_state_rebucket(spark, sf):
    """Runs before and after the changes are folded into a base of another number of buckets."""
    from tidemark.sources import state
    from tidemark.sources.catalog import job_database
    name = f"{job_database(spark, 'state')}.users"
    for n, batch in enumerate(_in_four_batches(_change_rows(Tables(spark, sf)))):
        state.merge_into_table(spark, name, batch, USER_KEY, buckets=4)
        if n in (1, 2):
            state.fold(spark, name, buckets=8 * n)
    return _state_cols(cdc.published(state.read_state(spark, name)))


def q_bronze_onchain_job(spark, sf):
    """Land the feed in two runs (before / from 1998), load after each; the
    table holds every key once, first seen wins."""
    from pyspark.sql import types as T
    from tidemark.plans.bronze import load_onchain
    from tidemark.sources.catalog import job_database
    from tidemark.sources.landing import onchain_landing_frame, write_onchain_landing
    from tidemark.streaming.jobs import job_folder
    base = job_folder(spark, "bronze-onchain")
    land, target = f"{base}/landing", f"{job_database(spark, 'onchain')}.onchain_transactions"
    feed = fixtures.onchain_feed(Tables(spark, sf))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in feed.schema.fields])
    split = F.lit(fixtures.ONCHAIN_SPLIT).cast("timestamp_ntz")
    for part, run_day, loaded in [(feed.where(F.col("_ingested_at") < split), fixtures.ONCHAIN_SPLIT,
                                   fixtures.ONCHAIN_SPLIT),
                                  (feed.where(F.col("_ingested_at") >= split), "2100-01-01 00:00:00",
                                   "2100-01-01 00:00:00")]:
        write_onchain_landing(onchain_landing_frame(part, F.col("_chain"), F.col("_ingested_at"),
                                                    F.lit(run_day).cast("timestamp_ntz")), land)
        load_onchain(spark, land, ONCHAIN_CHAINS, schema, target, F.lit(loaded),
                     f"{base}/checkpoint", f"{base}/rejects", first_by=ONCHAIN_FIRST)
    return spark.table(target).select(*feed.columns, "_loaded_at")


def q_bronze_cdc_job_bucketed(spark, sf):
    """As ``bronze_cdc_job``, with a bookmark: each run reads only the landed
    files that no run before has read."""
    from tidemark.sources.catalog import job_database
    from tidemark.streaming.jobs import job_folder, upsert_job
    base, name = job_folder(spark, "bronze-cdc-new"), f"{job_database(spark, 'bronze_cdc_new')}.users_state"
    _land_in_two_steps(spark, sf, f"{base}/landing", lambda: upsert_job(
        spark, f"{base}/landing", "users", _envelope_schema(), USER_KEY, CHANGE_COLS, name, f"{base}/checkpoint",
        f"{base}/rejects"))
    return _state_cols(cdc.published(spark.table(name)))


def q_stream_upsert_bucketed(spark, sf):
    """The foreachBatch upsert in several micro-batches of bounded size a run."""
    from tidemark.sources.catalog import job_database
    from tidemark.streaming.jobs import job_folder, upsert_job
    base, name = job_folder(spark, "stream-upsert-parts"), f"{job_database(spark, 'stream_upsert')}.users_state"
    _land_in_two_steps(spark, sf, f"{base}/landing", lambda: upsert_job(
        spark, f"{base}/landing", "users", _envelope_schema(), USER_KEY, CHANGE_COLS, name, f"{base}/checkpoint",
        f"{base}/rejects", max_files_per_trigger=10))
    return _state_cols(cdc.published(spark.table(name)))


def q_stream_evolving_schema(spark, sf):
    """A field that appears on the second day and one that changes its type, both read as columns."""
    from pyspark.sql import types as T
    from tidemark.streaming.evolving import evolving_job
    from tidemark.streaming.jobs import job_folder
    base = job_folder(spark, "evolving")
    declared = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType())])
    lines = fixtures.evolving_changes(Tables(spark, sf))
    for day in fixtures.LANDING_DAYS:
        lines.where(F.col("dt") == day).write.mode("append").partitionBy("table", "dt").text(f"{base}/landing")
        rows = evolving_job(spark, f"{base}/landing", "users", declared, USER_KEY, f"{base}/rows", f"{base}/checkpoint",
                            f"{base}/rejects")
    return rows.select(*CHANGE_COLS, F.try_variant_get("value_rescued", "$", "string").alias("value_text"),
                       cdc.OP, cdc.TS, cdc.LSN)


# Most bytes of the tables behind one landing task: a key makes some lines, so their text is many times longer.
LANDED_SPLIT_BYTES = 16 * 1024 * 1024


def _land(lines: DataFrame, entity: str, day: str, land: str) -> None:
    """One day's lines of an entity to its folder of that day, quickly compressed, in files of bounded size."""
    spark, split = lines.sparkSession, "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(split)
    spark.conf.set(split, min(LANDED_SPLIT_BYTES, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(usual)))
    try:
        (lines.where(F.col("dt") == day).select("value").write.mode("append").option("compression", "gzip")
         .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1_000_000).text(f"{land}/table={entity}/dt={day}"))
    finally:
        spark.conf.set(split, usual)


def _merged_entity(spark, sf, entity: str, land: str, base: str, database: str) -> DataFrame:
    """Land the entity's changes of two days, one run after each and one with nothing new."""
    from tidemark.plans.bronze import merge_entity
    bronze = getattr(Domain(spark, sf), f"bronze_{entity}")
    state = None
    for day in [*fixtures.LANDING_DAYS, None]:
        if day:
            _land(fixtures.entity_changes(bronze, entity, day), entity, day, land)
        state = merge_entity(spark, land, entity, database, f"{base}/{entity}")
    return cdc.published(state)


def _merged_entities(spark, sf, entities) -> tuple[dict[str, DataFrame], str]:
    from tidemark.sources.catalog import job_database
    from tidemark.streaming.jobs import job_folder
    base, database = job_folder(spark, "bronze-entities"), job_database(spark, "bronze_entities")
    return {e: _merged_entity(spark, sf, e, f"{base}/landing", base, database) for e in entities}, base


def q_bronze_entities(spark, sf):
    """Which change each live key of the three entities shows after all runs."""
    from tidemark import schemas
    tables, _ = _merged_entities(spark, sf, schemas.ENTITIES)
    return cdc.union_all([df.select(F.lit(e).alias("table"), F.col(schemas.PRIMARY_KEYS[e]).alias("key"),
                                    F.col(cdc.OP).alias("op"), F.col(cdc.TS).alias("ts_ms"),
                                    F.col(cdc.LSN).alias("lsn")) for e, df in tables.items()])


def q_bronze_quarantine(spark, sf):
    """How many changes of each entity were kept apart, by reason."""
    from tidemark import schemas
    tables, base = _merged_entities(spark, sf, schemas.ENTITIES)
    kept = [spark.read.parquet(f"{base}/{e}/rejects").withColumn("table", F.lit(e)) for e in tables]
    return cdc.union_all(kept).groupBy("table", F.col(cdc.REASON).alias("reason")).agg(F.count("*").alias("changes"))


def _routed_entities(spark, sf) -> tuple[str, str]:
    """The changes of all three entities through one subscription, a run after each of two days
    and one with nothing new; returns the states' database and the job's folder."""
    from tidemark import schemas
    from tidemark.sources.catalog import job_database
    from tidemark.streaming.fanout import entities_job
    from tidemark.streaming.jobs import job_folder
    from tidemark.streaming.progress import progress_log
    folder, database = job_folder(spark, "entities"), job_database(spark, "entities")
    d = Domain(spark, sf)
    with progress_log(spark, f"{folder}/progress") as log:
        for day in [*fixtures.LANDING_DAYS, None]:
            if day:
                for entity in schemas.ENTITIES:
                    lines = fixtures.entity_changes(getattr(d, f"bronze_{entity}"), entity, day)
                    _land(lines, entity, day, f"{folder}/landing")
            records = spark.readStream.schema("value string, table string, dt date").text(f"{folder}/landing")
            query = entities_job(spark, records, schemas.ENTITIES, database, folder)
            query.awaitTermination()
            log.wait_for(query)
    return database, folder


def q_stream_entities_fanout(spark, sf):
    """Which change each live key of the three entities shows after all runs of the one subscription."""
    from tidemark import schemas
    from tidemark.sources.state import read_state
    database, _ = _routed_entities(spark, sf)
    tables = {e: cdc.published(read_state(spark, f"{database}.{name}")) for e, name in schemas.BRONZE_NAMES.items()}
    return cdc.union_all([df.select(F.lit(e).alias("table"), F.col(schemas.PRIMARY_KEYS[e]).alias("key"),
                                    F.col(cdc.OP).alias("op"), F.col(cdc.TS).alias("ts_ms"),
                                    F.col(cdc.LSN).alias("lsn")) for e, df in tables.items()])


def q_stream_append_rejects(spark, sf):
    """What the subscription could not apply, by entity and reason."""
    _, folder = _routed_entities(spark, sf)
    return spark.read.parquet(f"{folder}/rejects").groupBy("table", F.col(cdc.REASON).alias("reason")).agg(
        F.count("*").alias("changes"))


def q_stream_progress(spark, sf):
    """Rows read, taken and put aside by all runs of the subscription, from its progress table."""
    from tidemark.streaming.progress import totals
    _, folder = _routed_entities(spark, sf)
    return totals(spark, f"{folder}/progress")


def q_stg_users_from_bronze(spark, sf):
    from tidemark.plans import staging
    tables, _ = _merged_entities(spark, sf, ["users"])
    return staging.stg_users(tables["users"], one_per_key=True)


def q_stg_wallets_from_bronze(spark, sf):
    from tidemark.plans import staging
    tables, _ = _merged_entities(spark, sf, ["wallets"])
    return staging.stg_wallets(tables["wallets"], one_per_key=True)


def q_stg_transactions_from_bronze(spark, sf):
    from tidemark.plans import staging
    tables, _ = _merged_entities(spark, sf, ["transactions"])
    return staging.stg_transactions(tables["transactions"], one_per_key=True)


def q_fact_from_bronze(spark, sf):
    """The fact over the states that one subscription keeps."""
    from tidemark.plans.domain import BronzeDomain
    database, _ = _routed_entities(spark, sf)
    return BronzeDomain(spark, database).fact_transactions


def q_seed_build(spark, sf):
    """Write the three bronze tables as CSV seeds, load them back with the
    declared types and build the fact from them (the seed-based local build)."""
    from tidemark import schemas
    from tidemark.plans.domain import SeedDomain
    from tidemark.sources.seeds import write_seed
    from tidemark.streaming.jobs import job_folder
    root = job_folder(spark, "seeds")
    d = Domain(spark, sf)
    for name, df in [("users", d.bronze_users), ("wallets", d.bronze_wallets),
                     ("transactions", d.bronze_transactions)]:
        write_seed(df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.ENTITIES[name].fields]),
                   f"{root}/{name}.csv")
    return SeedDomain(spark, root).fact_transactions


def q_dq_run_results_scan(spark, sf):
    """Suite results written as a run-results document, scanned back and
    summarised (the monitoring path over a test runner's output)."""
    from tidemark.plans.monitoring import status_counts
    from tidemark.sources.results import read_run_results, write_run_results
    from tidemark.streaming.jobs import job_folder
    path = f"{job_folder(spark, 'run-results')}/run_results"
    write_run_results(_suite_results(spark, sf, write=False), path, "suite")
    return status_counts(read_run_results(spark, path, lines=True))


REGISTRY: dict[str, Query] = {
    "stg_users": q_stg_users,
    "stg_wallets": q_stg_wallets,
    "stg_transactions": q_stg_transactions,
    "latest_per_key": q_latest_per_key,
    "dim_users": q_dim_users,
    "dim_wallets": q_dim_wallets,
    "fact_transactions": q_fact_transactions,
    "time_spine": q_time_spine,
    "metric_volume_by_day": q_metric_volume_by_day,
    "metric_volume_by_week": q_metric_volume_by_week,
    "metric_volume_by_month": q_metric_volume_by_month,
    "metric_all_by_chain": q_metric_all_by_chain,
    "metric_rate_by_status_direction": q_metric_rate_by_status_direction,
    "metric_by_user_dimension": q_metric_by_user_dimension,
    "metric_wallet_count": q_metric_wallet_count,
    "metric_wallets_by_signup_month": q_metric_wallets_by_signup_month,
    "metric_by_user_created_day": q_metric_by_user_created_day,
    "metric_filled_by_day": q_metric_filled_by_day,
    "metric_filled_by_day_chain": q_metric_filled_by_day_chain,
    "metric_filled_by_month": q_metric_filled_by_month,
    "metric_across_models": q_metric_across_models,
    "cdc_flatten": q_cdc_flatten,
    "cdc_quarantine": q_cdc_quarantine,
    "cdc_compact": q_cdc_compact,
    "cdc_merge": q_cdc_merge,
    "cdc_insert_only_merge": q_cdc_insert_only_merge,
    "union_sources": q_union_sources,
    "top_n_per_key": q_top_n_per_key,
    "scd2_apply": q_scd2_apply,
    "scd2_stored_runs": q_scd2_stored_runs,
    "scd2_hard_deletes": q_scd2_hard_deletes,
    "scd2_from_log": q_scd2_from_log,
    "dim_users_history": q_dim_users_history,
    "dim_users_history_two_runs": q_dim_users_history_two_runs,
    "dim_users_two_runs": q_dim_users_two_runs,
    "as_of_join": q_as_of_join,
    "scd2_from_log_split": q_scd2_from_log_split,
    "as_of_join_split": q_as_of_join_split,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_relationships": q_dq_relationships,
    "dq_one_open_version": q_dq_one_open_version,
    "dq_non_negative": q_dq_non_negative,
    "dq_freshness": q_dq_freshness,
    "dq_summary": q_dq_summary,
    "dq_failures": q_dq_failures,
    "dq_alert_top": q_dq_alert_top,
    "scd2_reconcile": q_scd2_reconcile,
    "api_flatten": q_api_flatten,
    "api_quarantine": q_api_quarantine,
    "cdc_land_and_scan": q_cdc_land_and_scan,
    "stream_append": q_stream_append,
    "stream_upsert": q_stream_upsert,
    "onchain_land_and_scan": q_onchain_land_and_scan,
    "stream_land_topics": q_stream_land_topics,
    "bronze_cdc_job": q_bronze_cdc_job,
    "bronze_onchain_job": q_bronze_onchain_job,
    "state_merge_on_read": q_state_merge_on_read,
    "state_rebucket": q_state_rebucket,
    "bronze_cdc_job_bucketed": q_bronze_cdc_job_bucketed,
    "stream_upsert_bucketed": q_stream_upsert_bucketed,
    "stream_evolving_schema": q_stream_evolving_schema,
    "stream_entities_fanout": q_stream_entities_fanout,
    "stream_append_rejects": q_stream_append_rejects,
    "stream_progress": q_stream_progress,
    "bronze_entities": q_bronze_entities,
    "bronze_quarantine": q_bronze_quarantine,
    "stg_users_from_bronze": q_stg_users_from_bronze,
    "stg_wallets_from_bronze": q_stg_wallets_from_bronze,
    "stg_transactions_from_bronze": q_stg_transactions_from_bronze,
    "fact_from_bronze": q_fact_from_bronze,
    "seed_build": q_seed_build,
    "dq_run_results_scan": q_dq_run_results_scan,
}
