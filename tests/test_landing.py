"""Landing zone, seeds, API bodies, catalog."""
import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import cdc
from tidemark.sources import catalog, landing, seeds

IMG = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("state", T.StringType())])


def test_missing_folder_reads_empty_with_schema(spark, tmp_dir):
    df = landing.read_cdc(spark, os.path.join(tmp_dir, "nothing"), "users", schemas.envelope(IMG))
    assert df.count() == 0
    assert df.schema["before"].dataType == IMG
    on = landing.read_onchain(spark, tmp_dir, ["ethereum", "base"], landing.API_ITEM)
    assert on.count() == 0


def test_before_image_typed_without_any_delete(spark, tmp_dir):
    root = os.path.join(tmp_dir, "cdc")
    os.makedirs(os.path.join(root, "table=users", "dt=2024-01-01"))
    with open(os.path.join(root, "table=users", "dt=2024-01-01", "a.json"), "w") as f:
        f.write('{"op":"c","ts_ms":1,"after":{"user_id":1,"state":"a"}}\n')
        f.write('not json at all\n')
    env = landing.read_cdc(spark, root, "users", schemas.envelope(IMG))
    rows = env.select("op", "before", "after", "dt", landing.CORRUPT).collect()
    assert sum(r[landing.CORRUPT] is not None for r in rows) == 1
    assert env.schema["before"].dataType == IMG
    good = env.where(F.col("op").isNotNull())
    flat = cdc.flatten(good, "user_id", ["user_id", "state"], lsn=None).collect()
    assert [(r.user_id, r.state) for r in flat] == [(1, "a")]


def test_since_dt_prunes_partitions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "cdc")
    for d in ("2024-01-01", "2024-01-02"):
        os.makedirs(os.path.join(root, "table=users", f"dt={d}"))
        with open(os.path.join(root, "table=users", f"dt={d}", "a.json"), "w") as f:
            f.write('{"op":"c","ts_ms":1,"after":{"user_id":1,"state":"a"}}\n')
    df = landing.read_cdc(spark, root, "users", schemas.envelope(IMG), since_dt="2024-01-02")
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_landing_round_trip(spark, tmp_dir):
    env = spark.createDataFrame([("users", "c", 1, None, (1, "a"), dt.datetime(2024, 1, 1, 5))],
                                "table string, op string, ts_ms long, before struct<user_id:long,state:string>, "
                                "after struct<user_id:long,state:string>, ts timestamp_ntz")
    framed = landing.landing_frame(env, F.col("ts")).drop("ts")
    landing.write_landing(framed, os.path.join(tmp_dir, "raw"))
    assert os.path.isdir(os.path.join(tmp_dir, "raw", "table=users", "dt=2024-01-01"))
    back = landing.read_cdc(spark, os.path.join(tmp_dir, "raw"), "users", schemas.envelope(IMG))
    r = back.collect()[0]
    assert (r.table, r.op, r.after.state, r.consumed_at) == ("users", "c", "a", "2024-01-01T05:00:00.000000Z")


def test_api_bodies(spark):
    bodies = spark.createDataFrame([
        ("a1", '{"status":"1","message":"OK","result":[{"hash":"h1","from":"x","to":"y","value":"1","timeStamp":"t"},'
               '{"hash":"h2","from":"x","to":"y","value":"2","timeStamp":"t"}]}'),
        ("a2", '{"status":"0","message":"No transactions found","result":[]}'),
        ("a3", '{"status":"0","message":"NOTOK","result":"Max rate limit reached"}'),
        ("a4", '{"status":"1","message":"OK","result":"oops"}'),
        ("a5", 'garbage'),
    ], "address string, body string")
    rows, rejected = landing.flatten_api_bodies(bodies)
    assert sorted(r.hash for r in rows.collect()) == ["h1", "h2"]
    assert {r.address: r.reason for r in rejected.collect()} == {
        "a3": "api_error", "a4": "result_not_a_list", "a5": "unparsable"}


def test_seed_csv_round_trip(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, 10, "0xabc", "send", "ETH", "1.5", "2.25", "0.001", "confirmed",
          dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 0, 1), dt.datetime(2026, 1, 1, 0, 1))],
        schemas.TRANSACTIONS.simpleString().replace("decimal(38,18)", "string").replace("decimal(18,2)", "string"))
    path = os.path.join(tmp_dir, "transactions")
    seeds.write_seed(df, path)
    back = seeds.read_seed(spark, path, schemas.TRANSACTIONS)
    r = back.collect()[0]
    assert str(r.usd_value_at_tx) == "2.25" and back.schema["amount"].dataType == schemas.DEC_AMOUNT


def test_publish_replaces_table_and_counts(spark):
    catalog.ensure_database(spark, "bronze_test")
    df = spark.range(5).withColumnRenamed("id", "user_id")
    assert catalog.publish(spark, df, "bronze_test.cdc_users") == 5
    again = catalog.read_table(spark, "bronze_test.cdc_users").where("user_id < 3")
    assert catalog.publish(spark, again, "bronze_test.cdc_users") == 3
    assert catalog.table_exists(spark, "bronze_test.cdc_users")
    assert spark.table("bronze_test.cdc_users").count() == 3


def test_models_as_sql_views(spark):
    from tidemark.plans.domain import Domain
    names = Domain(spark, "/root/testdata/sf0.001").register_views(prefix="m_")
    assert "m_dim_users_history" in names
    # a singular check written as SQL against the views
    bad = spark.sql("""select user_id, count(*) as current_row_count from m_dim_users_history
                       where is_current group by 1 having count(*) > 1""")
    assert bad.count() == 0
    neg = spark.sql("select transaction_id from m_fact_transactions where usd_value_at_tx is not null "
                    "and usd_value_at_tx < 0")
    assert neg.count() == 0
    assert spark.sql("select count(*) from m_time_spine").collect()[0][0] > 0


def test_onchain_load_skips_empty_feed_and_appends_new_keys(spark, tmp_dir):
    from tidemark.plans.bronze import load_onchain
    schema = T.StructType([T.StructField("hash", T.StringType()), T.StructField("_chain", T.StringType()),
                           T.StructField("_ingested_at", T.TimestampNTZType())])
    from tidemark.sources.catalog import job_database
    land, target = os.path.join(tmp_dir, "land"), f"{job_database(spark, 'onchain_test')}.onchain"
    loaded = F.lit("2024-01-01 00:00:00")
    assert load_onchain(spark, land, ["ethereum", "base"], schema, target, loaded, f"{tmp_dir}/bookmark", f"{tmp_dir}/rejects") == 0
    assert not spark.catalog.tableExists(target)
    rows = spark.createDataFrame([("h1", dt.datetime(2024, 1, 2)), ("h1", dt.datetime(2024, 1, 1)),
                                  ("h2", dt.datetime(2024, 1, 1))], "hash string, ts timestamp_ntz")
    frame = landing.onchain_landing_frame(rows, F.lit("ethereum"), F.col("ts"), F.lit("2024-01-01")).drop("ts")
    landing.write_onchain_landing(frame, land)
    assert load_onchain(spark, land, ["ethereum", "base"], schema, target, loaded, f"{tmp_dir}/bookmark", f"{tmp_dir}/rejects") == 2
    assert load_onchain(spark, land, ["ethereum", "base"], schema, target, loaded, f"{tmp_dir}/bookmark", f"{tmp_dir}/rejects") == 0  # replay: nothing new
    kept = {r.hash: r._ingested_at for r in spark.table(target).collect()}
    assert kept == {"h1": dt.datetime(2024, 1, 1), "h2": dt.datetime(2024, 1, 1)}  # first seen wins


def test_onchain_load_reads_new_files_only_and_keeps_rows_without_key(spark, tmp_dir):
    from tidemark.plans.bronze import load_onchain
    from tidemark.sources.catalog import job_database
    land, mark, rejects = (f"{tmp_dir}/{x}" for x in ("land", "mark", "rejects"))
    target = f"{job_database(spark, 'onchain_test')}.onchain"
    schema = spark.createDataFrame([], "hash string, _chain string, _ingested_at timestamp_ntz, value string").schema

    def arrive(*lines):
        rows = spark.createDataFrame([(line, "base", "2024-01-01") for line in lines], "value string, chain string, dt string")
        rows.write.mode("append").partitionBy("chain", "dt").text(land)
        return load_onchain(spark, land, ["base", "bsc"], schema, target, F.lit("2024-01-02 00:00:00"), mark, rejects)

    a, b = '{"hash": "a", "_chain": "base", "value": "1"}', '{"hash": "b", "_chain": "base", "value": "2"}'
    assert arrive(a, '{"hash": "a"}', '{"hash": ') == 1
    assert arrive(a, b) == 1
    assert sorted(r["hash"] for r in spark.table(target).collect()) == ["a", "b"]
    assert sorted(r["_reject_reason"] for r in spark.read.option("mergeSchema", True).parquet(rejects).collect()) == [
        "missing_key", "unparsable"]


def test_onchain_load_reads_its_chains_and_moves_its_rows_only(spark, tmp_dir):
    from tidemark.plans.bronze import load_onchain, new_onchain_rows
    from tidemark.sources.catalog import job_database
    land, target = f"{tmp_dir}/land", f"{job_database(spark, 'onchain_test')}.onchain"
    feed = spark.range(2000).selectExpr("concat('h', id) as hash", "elt(1 + id % 3, 'base', 'bsc', 'polygon') as _chain",
                                        "timestamp_ntz'2024-01-01 00:00:00' as _ingested_at")

    def load(df, **options):
        landing.write_onchain_landing(landing.onchain_landing_frame(df, F.col("_chain"), F.col("_ingested_at"), F.lit("2024-01-01")), land)
        return load_onchain(spark, land, ["base", "bsc", "polygon"], feed.schema, target, F.lit("2024-01-02 00:00:00"),
                            f"{tmp_dir}/mark", f"{tmp_dir}/rejects", **options)

    assert load(feed, buckets=5) == 2000
    held = spark.table(target).inputFiles()
    # The same hashes on one chain: a third is there already; the hash alone does not make a key.
    second = feed.withColumn("_chain", F.lit("bsc"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a target of any size but a tiny one
    try:
        plan = new_onchain_rows(spark.table(target), second, ["bsc"], ["_ingested_at"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    assert "Bucketed: true" in lines[scan] and "PartitionFilters: [isnotnull(_chain" in lines[scan] and "= bsc)]" in lines[scan]
    assert "ReadSchema: struct<hash:string>" in lines[scan]
    assert not any("Exchange" in line for line in lines[scan - 4:scan]), plan
    assert load(second) == 1333
    assert load(second) == 0  # the same rows in new files
    assert set(held) < set(spark.table(target).inputFiles())
    assert spark.table(target).groupBy("hash", "_chain").count().where("count > 1").count() == 0


def test_long_running_landing_stops_and_resumes_without_loss_or_repeat(spark, tmp_dir):
    import time

    from tidemark.streaming.progress import batches, counted, progress_log
    source, land, ckpt, log_path = (f"{tmp_dir}/{x}" for x in ("in", "land", "ckpt", "log"))

    def arrive(first):
        spark.range(first, first + 10).select("id", F.lit("users").alias("table"), F.lit("2024-01-01").alias("dt")) \
            .coalesce(1).write.mode("append").json(source)

    def rows_so_far():
        import os
        return batches(spark, log_path).agg(F.sum("total")).first()[0] or 0 if os.path.exists(log_path) else 0

    def consume(total):
        stream = counted(spark.readStream.schema("id long, table string, dt string").json(source), F.lit(False))
        with progress_log(spark, log_path) as log:
            query = landing.stream_landing(stream, land, ckpt, processing_time="200 milliseconds")
            for _ in range(300):
                if rows_so_far() >= total:
                    break
                time.sleep(0.1)
            query.processAllAvailable()
            log.wait_for(query)
            query.stop()
        return rows_so_far()

    arrive(0)
    assert consume(10) == 10
    arrive(10)
    arrive(20)
    assert consume(30) == 30  # the restarted query reads what came since
    assert sorted(r["id"] for r in spark.read.json(land).collect()) == list(range(30))
