"""One subscription for three entities and its progress table (A16)."""
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import cdc
from tidemark.sources.catalog import job_database
from tidemark.sources.state import read_state
from tidemark.streaming import fanout
from tidemark.streaming.progress import batches, progress_log, totals

USER = {"user_id": 1, "email": "a", "updated_at": "2024-01-01 00:00:00"}
WALLET = {"wallet_id": 5, "user_id": 1, "chain": "base", "updated_at": "2024-01-01 00:00:00"}


def line(after=None, op="c", ms=10, lsn=1, before=None):
    return json.dumps({"op": op, "ts_ms": ms, "after": after, "before": before, "source": {"lsn": lsn}})


def arrive(spark, root, day, rows):
    df = spark.createDataFrame([(v, t, day) for t, v in rows], "value string, table string, dt string")
    df.write.mode("append").partitionBy("table", "dt").text(f"{root}/landing")


def run(spark, root, database, log=None):
    records = spark.readStream.schema("value string, table string, dt string").text(f"{root}/landing")
    query = fanout.entities_job(spark, records, schemas.ENTITIES, database, root, buckets=2)
    query.awaitTermination()
    if log:
        log.wait_for(query)
    return query


def test_records_are_read_once_and_routed(spark, tmp_dir):
    database = job_database(spark, "fanout")
    arrive(spark, tmp_dir, "2024-01-01", [
        ("users", line(USER)), ("users", line({**USER, "user_id": 2})), ("wallets", line(WALLET)),
        ("wallets", line({**WALLET, "updated_at": "soon"})), ("users", "{cut"), ("orders", line({"id": 1})),
        ("transactions", line({"transaction_id": 9, "wallet_id": 5, "amount": "1.5"})),
        ("transactions", line({"transaction_id": 8, "amount": "much"})), ("users", line(USER, op="m")), ("users", line({"email": "x"})),
        ("users", line(USER, ms=None)), ("users", line(op="u"))])
    with progress_log(spark, f"{tmp_dir}/progress") as log:
        first = run(spark, tmp_dir, database, log)
        assert first.lastProgress["numInputRows"] == 12  # every line was read once, for all sinks
        arrive(spark, tmp_dir, "2024-01-02", [("users", line(op="d", ms=20, lsn=2, before={"user_id": 2})),
                                              ("users", line({**USER, "email": "b"}, op="u", ms=20, lsn=3))])
        second = run(spark, tmp_dir, database, log)
        assert second.lastProgress["numInputRows"] == 2
        run(spark, tmp_dir, database, log)  # nothing new

    def live(entity):
        return cdc.published(read_state(spark, f"{database}.cdc_{entity}"))

    assert [(r["user_id"], r["email"]) for r in live("users").collect()] == [(1, "b")]
    assert [(r["wallet_id"], r["chain"]) for r in live("wallets").collect()] == [(5, "base")]
    assert [(r["transaction_id"], str(r["amount"])) for r in live("transactions").collect()] == [(9, "1.500000000000000000")]
    kept = spark.read.parquet(f"{tmp_dir}/rejects")
    assert sorted((r["table"], r[cdc.REASON]) for r in kept.collect()) == sorted([
        ("wallets", "bad_updated_at"), ("users", "unparsable"), ("orders", fanout.UNKNOWN), ("transactions", "bad_amount"),
        ("users", "unsupported_op"), ("users", "missing_key"), ("users", "missing_ts"), ("users", "missing_after")])
    assert spark.read.parquet(f"{tmp_dir}/log/table=users").count() == 4
    assert tuple(totals(spark, f"{tmp_dir}/progress").first()) == (14, 6, 8)
    assert [tuple(r)[4:] for r in batches(spark, f"{tmp_dir}/progress").orderBy("batch_id").collect()] == [(12, 4, 8), (2, 2, 0)]


def test_a_batch_that_dies_is_run_again_without_loss_or_repeat(spark, tmp_dir, monkeypatch):
    database = job_database(spark, "fanout")
    arrive(spark, tmp_dir, "2024-01-01", [("users", line({**USER, "user_id": k}, lsn=k)) for k in range(1, 8)]
           + [("wallets", line(WALLET)), ("wallets", "{cut")])
    real, calls = fanout.merge_into_table, []

    def dies(spark, name, *rest):
        calls.append(name)
        if name.endswith("cdc_wallets") and len(calls) == 2:
            raise RuntimeError("lost")
        return real(spark, name, *rest)

    monkeypatch.setattr(fanout, "merge_into_table", dies)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_dir, database)
    run(spark, tmp_dir, database)  # the same batch again, from the start
    assert sorted(r["user_id"] for r in cdc.published(read_state(spark, f"{database}.cdc_users")).collect()) == list(range(1, 8))
    assert spark.read.parquet(f"{tmp_dir}/log/table=users").count() == 7
    assert spark.read.parquet(f"{tmp_dir}/log/table=wallets").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 1


def test_rejected_topic_records_land_in_a_folder_of_their_own(spark, tmp_dir):
    from tidemark import registry as R
    from tidemark.sources import landing
    from tidemark.sources.tables import Tables
    records = R.fixtures.topic_records(Tables(spark, "/root/testdata/sf0.001"))
    records = records.unionByName(spark.createDataFrame([("app.public.users", 0, -1, "{not")], records.schema))
    decoded = cdc.tag_rejects(cdc.decode_topic_records(records, R._topic_envelope_schema()), "user_id", env="_env")
    landing.write_landing(landing.envelopes_for_landing(decoded), tmp_dir)
    good = landing.read_cdc(spark, tmp_dir, "users", R._topic_envelope_schema())
    bad = landing.read_rejected(spark, tmp_dir)
    present = records.where("value is not null").count()
    clicks = Tables(spark, "/root/testdata/sf0.001").events.where("event_type = 'click'").count()
    assert good.count() == present - clicks - 1
    assert {r[cdc.REASON]: r["count"] for r in bad.groupBy(cdc.REASON).count().collect()} == {"unsupported_op": clicks, "unparsable": 1}
    assert bad.where(F.col("_raw") == "{not").first()["_entity"] == "users"


def test_fact_over_the_states_moves_the_transactions_once(spark, tmp_dir):
    from tidemark.plans.domain import BronzeDomain
    from tidemark.plans.staging import stg_users
    database = job_database(spark, "fanout")
    lines = [("users", line({**USER, "user_id": k}, lsn=k)) for k in range(9)]
    lines += [("wallets", line({**WALLET, "wallet_id": k, "user_id": k % 9}, lsn=k)) for k in range(40)]
    lines += [("transactions", line({"transaction_id": k, "wallet_id": k % 45, "amount": "1.5", "submitted_at": "2024-01-01 10:00:00"}, lsn=k))
              for k in range(200)]
    arrive(spark, tmp_dir, "2024-01-01", lines)
    run(spark, tmp_dir, database)
    arrive(spark, tmp_dir, "2024-01-02", [("transactions", line({"transaction_id": 3, "wallet_id": 1, "status": "failed"}, op="u", ms=20))])
    run(spark, tmp_dir, database)
    domain = BronzeDomain(spark, database, buckets=3)
    domain.dim_wallets
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = domain.fact_transactions._jdf.queryExecution().executedPlan().toString()
        staged = domain.stg_transactions._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in staged and plan.count("Exchange") == 1, plan
    rows = {r["transaction_id"]: r for r in domain.fact_transactions.collect()}
    assert len(rows) == 200 and rows[3]["status"] == "failed" and rows[3]["user_id"] == 1 and rows[44]["user_id"] is None
    assert domain.dim_users.where("wallet_count > 0").count() == 9
    # A bronze table with several rows a key: the last change decides among rows of one instant.
    twice = spark.createDataFrame([(1, "a", 5, 1), (1, "b", 5, 2)], "user_id long, email string, _cdc_ts_ms long, _cdc_lsn long").selectExpr(
        "*", "'us' as country_code", "'x' as signup_channel", "'pending' as kyc_status", "timestamp_ntz'2024-01-01' as created_at",
        "timestamp_ntz'2024-01-01' as updated_at")
    assert [r["email"] for r in stg_users(twice).collect()] == ["b"]


def test_a_micro_batch_is_parsed_once_and_not_held_by_executors(spark, tmp_dir, monkeypatch):
    records = spark.createDataFrame([("users", line(USER))], "table string, value string")
    plan = fanout.decoded(records, schemas.ENTITIES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == len(schemas.ENTITIES)
    real, held = fanout.merge_into_table, []
    mine = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    def watched(*args):
        held.extend(set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) - mine)
        return real(*args)

    monkeypatch.setattr(fanout, "merge_into_table", watched)
    arrive(spark, tmp_dir, "2024-01-01", [("users", line(USER)), ("wallets", line(WALLET)), ("users", "{cut")])
    run(spark, tmp_dir, job_database(spark, "fanout"))
    assert held == []
    staged = spark.read.parquet(f"{tmp_dir}/staged")
    # A text is staged where it is rejected, a row where it is not.
    assert {(r["table"], r["value"], r["_users"] is not None) for r in staged.collect()} == {
        ("users", "{cut", False), ("users", None, True), ("wallets", None, False)}


@pytest.mark.parametrize("job", ["fanout", "upsert"])
def test_a_task_reads_a_bounded_number_of_staged_rows(spark, tmp_dir, monkeypatch, job):
    """A batch of any size is sorted in tasks of so many rows, however small its files are once compressed."""
    from tidemark.streaming import jobs
    monkeypatch.setattr(jobs, "STAGED_ROWS", 5, raising=False)
    module = fanout if job == "fanout" else jobs
    real, tasks = module.merge_into_table, []

    def watched(session, name, changes, *rest):
        tasks.extend(r["count"] for r in changes.groupBy(F.spark_partition_id()).count().collect())
        return real(session, name, changes, *rest)

    monkeypatch.setattr(module, "merge_into_table", watched)
    lines = [("users", line({**USER, "user_id": k % 30}, lsn=k)) for k in range(40)]
    spark.createDataFrame([(v, t, "2024-01-01") for t, v in lines], "value string, table string, dt string").coalesce(1).write \
        .partitionBy("table", "dt").text(f"{tmp_dir}/landing")
    database, usual = job_database(spark, "fanout"), spark.conf.get("spark.sql.files.openCostInBytes")
    if job == "fanout":
        run(spark, tmp_dir, database)
    else:
        image = schemas.as_json_payload(schemas.USERS)
        jobs.upsert_job(spark, f"{tmp_dir}/landing", "users", schemas.envelope(image), "user_id", image.fieldNames(),
                        f"{database}.cdc_users", f"{tmp_dir}/checkpoint", f"{tmp_dir}/rejects", buckets=2)
    assert sum(tasks) == 40 and max(tasks) <= 5, tasks
    assert spark.conf.get("spark.sql.files.openCostInBytes") == usual
    state = cdc.published(read_state(spark, f"{database}.cdc_users"))
    assert {(r["user_id"], r[cdc.LSN]) for r in state.collect()} == {(k % 30, k) for k in range(10, 40)}


@pytest.mark.parametrize("job", ["fanout", "upsert"])
def test_a_large_first_batch_gets_buckets_of_a_bounded_number_of_changes(spark, tmp_dir, monkeypatch, job):
    """Tasks that rank, write and read a state work on a bucket each: there are more buckets, not larger ones."""
    from tidemark.sources import state
    from tidemark.streaming import jobs
    monkeypatch.setattr(state, "BUCKET_ROWS", 10, raising=False)
    real, stages = state._write, []

    def watched(df, table, key, buckets, **mode):
        stages.append((table, df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"), buckets))
        return real(df, table, key, buckets, **mode)

    monkeypatch.setattr(state, "_write", watched)
    database, image = job_database(spark, "fanout"), schemas.as_json_payload(schemas.USERS)

    def load(day, lines):
        arrive(spark, tmp_dir, day, [("users", x) for x in lines])
        if job == "fanout":
            return run(spark, tmp_dir, database)
        jobs.upsert_job(spark, f"{tmp_dir}/landing", "users", schemas.envelope(image), "user_id", image.fieldNames(),
                        f"{database}.cdc_users", f"{tmp_dir}/checkpoint", f"{tmp_dir}/rejects", buckets=2)

    load("2024-01-01", [line({**USER, "user_id": k}, lsn=k) for k in range(75)])
    tables = state.state_tables(spark, f"{database}.cdc_users")
    assert state.bucket_count(spark, tables.base) == state.bucket_count(spark, tables.changes) == 8
    # The second batch is small: it goes to the buckets that there are.
    load("2024-01-02", [line({**USER, "user_id": k, "email": "b"}, op="u", ms=20, lsn=k) for k in range(70, 80)])
    assert state.bucket_count(spark, tables.changes) == 8
    shown = cdc.published(read_state(spark, f"{database}.cdc_users"))
    assert {(r["user_id"], r["email"]) for r in shown.collect()} == {(k, "b" if k >= 70 else "a") for k in range(80)}
    # Ranked and dealt to the buckets by one exchange; a new table of changes starts empty.
    assert [(n, buckets) for _, n, buckets in stages] == [(1, 8), (0, 8), (1, 8)], stages


def test_all_envelopes_of_a_record_share_one_generator(spark):
    """Each generator writes the whole record, its text included, anew."""
    records = spark.createDataFrame([("users", line(USER)), ("users", '{"op": "u", "ts_ms": 1, "after": {"user_id": "x"}}'),
                                     ("wallets", line(WALLET)), (None, line(USER)), ("users", None)], "table string, value string")
    decoded = fanout.decoded(records, schemas.ENTITIES)
    assert decoded._jdf.queryExecution().optimizedPlan().toString().count("Generate explode(") == 1
    # An envelope that does not fit gives no row, not even the fields that did parse.
    assert [(r["table"], r[cdc.REASON], r["_users"] is not None, r["_wallets"] is not None) for r in decoded.collect()] == [
        ("users", None, True, False), ("users", "unparsable", False, False), ("wallets", None, False, True),
        (None, fanout.UNKNOWN, False, False)]


def test_an_entity_is_staged_in_files_of_its_own(spark, tmp_dir, monkeypatch):
    """A sink opens the files of its rows and no other; what is almost all unlike is written without dictionaries."""
    import glob

    import pyarrow.parquet as pq
    names = ("spark.sql.files.openCostInBytes", "spark.sql.maxConcurrentOutputFileWriters")
    real, seen, usual = fanout.merge_into_table, {}, [spark.conf.get(n) for n in names]

    def watched(session, name, changes, *rest):
        files = {r[0] for r in changes.select(F.input_file_name()).distinct().collect()}
        seen[name.rpartition(".")[2]] = (files, changes.rdd.getNumPartitions(), changes.count())
        return real(session, name, changes, *rest)

    monkeypatch.setattr(fanout, "merge_into_table", watched)
    lines = [("users", line({**USER, "user_id": k}, lsn=k)) for k in range(6)] + [("wallets", line(WALLET)), ("users", "{cut"),
             ("users/x=1", line(USER)), ("", line(USER)), (None, line(USER))]
    spark.createDataFrame(lines, "table string, value string").coalesce(1).write.json(f"{tmp_dir}/broker")
    records = spark.readStream.schema("table string, value string").json(f"{tmp_dir}/broker")
    fanout.entities_job(spark, records, schemas.ENTITIES, job_database(spark, "fanout"), tmp_dir, buckets=2).awaitTermination()
    assert {n: (tasks, rows) for n, (_, tasks, rows) in seen.items()} == {"cdc_users": (1, 6), "cdc_wallets": (1, 1)}
    assert not seen["cdc_users"][0] & seen["cdc_wallets"][0]
    # Rejected records keep the names they came with.
    kept = spark.read.parquet(f"{tmp_dir}/rejects")
    assert {(r["table"], r[cdc.REASON]) for r in kept.collect()} == {
        ("users", "unparsable"), ("users/x=1", fanout.UNKNOWN), ("", fanout.UNKNOWN), (None, fanout.UNKNOWN)}
    for folder in ("staged", "log"):
        for f in glob.glob(f"{tmp_dir}/{folder}/**/part-*.parquet", recursive=True):
            group = pq.ParquetFile(f).metadata.row_group(0)
            columns = [group.column(i) for i in range(group.num_columns)]
            assert {c.compression for c in columns} == {"ZSTD"} and not any(c.has_dictionary_page for c in columns), f
    assert [spark.conf.get(n) for n in names] == usual
