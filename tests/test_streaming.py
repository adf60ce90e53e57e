"""Streaming append and foreachBatch upsert."""
import os

import pytest
from pyspark.sql import functions as F

from tidemark import registry as R
from tidemark.operators import cdc
from tidemark.sources import landing
from tidemark.sources.tables import Tables
from tidemark.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_append_rerun_adds_nothing_and_new_files_add_rows(spark, tmp_dir):
    landed = R._landed_events(Tables(spark, SF))
    root, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("land", "sink", "ckpt"))
    first = landed.where(F.col("dt") < "2024-01-15")
    landing.write_landing(first, root)
    run = lambda: jobs.append_job(spark, root, "users", R._envelope_schema(), "user_id", R.CHANGE_COLS, sink, ckpt, f"{tmp_dir}/rejects")
    run()
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.where("op <> 'd'").count()
    run()
    assert spark.read.parquet(sink).count() == n1
    landing.write_landing(landed.where(F.col("dt") >= "2024-01-15"), root)
    run()
    assert spark.read.parquet(sink).count() == landed.where("op <> 'd'").count()


def test_upsert_equals_batch_compaction_and_survives_replay(spark, tmp_dir):
    from tidemark.sources.catalog import job_database
    landed = R._landed_events(Tables(spark, SF))
    root, ckpt, name = f"{tmp_dir}/land", f"{tmp_dir}/ckpt", f"{job_database(spark, 'upsert')}.users"
    landing.write_landing(landed, root)
    state = jobs.upsert_job(spark, root, "users", R._envelope_schema(), "user_id", R.CHANGE_COLS, name, ckpt, f"{tmp_dir}/rejects")
    got = sorted(tuple(r) for r in cdc.published(state).select("user_id", cdc.TS).collect())
    want = sorted(tuple(r) for r in R.q_cdc_compact(spark, SF).select("user_id", cdc.TS).collect())
    assert got == want
    # replaying batch 0 merges the same changes again, which changes nothing
    batch = landing.read_cdc(spark, root, "users", R._envelope_schema())
    jobs.upsert_batch(name, "user_id", R.CHANGE_COLS, f"{tmp_dir}/rejects")(batch, 0)
    again = sorted(tuple(r) for r in cdc.published(spark.table(name)).select("user_id", cdc.TS).collect())
    assert again == want


def test_append_drops_redelivered_events_within_watermark(spark, tmp_dir):
    landed = R._landed_events(Tables(spark, SF)).where(F.col("dt") < "2024-01-05")
    root, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("land", "sink", "ckpt"))
    landing.write_landing(landed, root)
    landing.write_landing(landed, root)  # the same events delivered twice (at-least-once)
    jobs.append_job(spark, root, "users", R._envelope_schema(), "user_id", R.CHANGE_COLS, sink, ckpt,
                    f"{tmp_dir}/rejects", dedupe_within="1 hour")
    assert spark.read.parquet(sink).count() == landed.where("op <> 'd'").count()


def test_topic_landing_stream_lands_only_valid_changes(spark, tmp_dir):
    out = R.q_stream_land_topics(spark, SF)
    assert out.count() == R.q_cdc_flatten(spark, SF).count()


def test_append_reports_progress(spark, tmp_dir):
    landed = R._landed_events(Tables(spark, SF)).where(F.col("dt") < "2024-01-03")
    root, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("land", "sink", "ckpt"))
    landing.write_landing(landed, root)
    progress = jobs.append_job(spark, root, "users", R._envelope_schema(), "user_id", R.CHANGE_COLS, sink, ckpt,
                               f"{tmp_dir}/rejects")
    # Each landed line is read once, although rows and rejects are written apart.
    assert progress is not None and progress["numInputRows"] == landed.count()
    assert spark.read.parquet(sink).count() == landed.where("op <> 'd'").count()


def test_upsert_decides_each_change_once_and_holds_nothing_in_memory(spark, tmp_dir, monkeypatch):
    import json
    from pyspark.sql import types as T
    from tidemark import schemas
    from tidemark.sources.catalog import job_database
    schema = schemas.envelope(T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.StringType())]))

    def change(id, amount, **x):
        return json.dumps({"op": "u", "ts_ms": 1, "after": {"id": id, "amount": amount}, "source": {"lsn": 1}, **x})
    lines = [change(1, "1.5"), change(2, "much"), change(3, "2", op="m"), change(4, None), "{cut"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_dir}/land/table=t/dt=2024-01-01")
    real, held = jobs.merge_into_table, []
    mine = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    def watched(*args):
        held.extend(set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) - mine)
        return real(*args)

    monkeypatch.setattr(jobs, "merge_into_table", watched)
    state = jobs.upsert_job(spark, f"{tmp_dir}/land", "t", schema, "id", ["id", "amount"], f"{job_database(spark, 'upsert')}.t",
                            f"{tmp_dir}/ckpt", f"{tmp_dir}/rejects", types={"amount": T.DecimalType(10, 2)})
    assert held == []
    assert sorted((r["id"], r["amount"] and str(r["amount"])) for r in state.collect()) == [(1, "1.50"), (4, None)]
    rejects = {r[cdc.REASON]: json.loads(r["change"]) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()}
    assert sorted(rejects) == ["bad_amount", "unparsable", "unsupported_op"]
    assert rejects["bad_amount"] == {"id": 2, "amount": "much", cdc.OP: "u", cdc.TS: 1, cdc.LSN: 1}
    assert rejects["unsupported_op"]["op"] == "m" and rejects["unsupported_op"]["table"] == "t"


def test_other_jobs_keep_a_batch_on_disk_only(spark):
    with jobs.held(spark.range(3)) as rows:
        assert rows.count() == 3 and not rows.storageLevel.useMemory and rows.storageLevel.useDisk
    assert not rows.storageLevel.useDisk


def test_changes_land_compressed_in_a_folder_of_their_entity_and_day(spark, tmp_dir):
    from tidemark.plans import fixtures
    from tidemark.plans.domain import Domain
    lines = fixtures.entity_changes(Domain(spark, SF).bronze_users, "users")
    for day in fixtures.LANDING_DAYS:
        R._land(lines, "users", day, f"{tmp_dir}/land")
    files = [f for at, _, names in os.walk(f"{tmp_dir}/land") for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    back = spark.read.schema("value string, table string, dt string").text(f"{tmp_dir}/land")
    assert back.exceptAll(lines).count() == lines.exceptAll(back).count() == 0


def test_staging_over_a_merged_state_does_not_rank_it_again(spark):
    out = R.q_stg_transactions_from_bronze(spark, SF)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("+- Window [") == 1, plan  # that of the appended changes


@pytest.mark.parametrize("entity", ["users", "wallets", "transactions"])
def test_lines_of_one_day_are_formatted_for_its_keys_only(spark, tmp_dir, entity):
    from tidemark import schemas
    from tidemark.plans import fixtures
    from tidemark.plans.domain import Domain
    bronze = getattr(Domain(spark, SF), f"bronze_{entity}")
    key = schemas.PRIMARY_KEYS[entity]
    bronze = bronze.unionByName(bronze.limit(2)).unionByName(bronze.limit(1).withColumn(key, F.lit(None).cast("bigint")))
    whole, split = fixtures.entity_changes(bronze, entity).cache(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    for day in fixtures.LANDING_DAYS:
        lines = fixtures.entity_changes(bronze, entity, day)
        want = whole.where(F.col("dt") == day)
        assert want.count() and lines.exceptAll(want).count() == want.exceptAll(lines).count() == 0
        # No interpreted lambda: explode, values and text are one compiled stage.
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and plan.count("Generate explode(") == 1
        R._land(lines, entity, day, f"{tmp_dir}/land")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    back = spark.read.schema("value string, table string, dt string").text(f"{tmp_dir}/land")
    assert back.exceptAll(whole).count() == whole.exceptAll(back).count() == 0
    whole.unpersist()
