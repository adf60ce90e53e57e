"""Rows that cannot be applied are kept apart, and never change a result."""
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import registry as R
from tidemark.operators import cdc, quality
from tidemark.sources.landing import envelopes_for_landing
from tidemark.streaming import jobs

IMAGE = {"user_id": 1, "event_type": "view", "value": 1.0, "k": 1}


def test_append_job_writes_every_bad_change_to_the_reject_sink(spark, tmp_dir):
    def change(**x):
        return json.dumps({"op": "c", "ts_ms": 5, "after": IMAGE, "source": {"lsn": 1}, **x})
    lines = [change(), change(op=None), change(op="m"), change(op="u", after=None), change(after={**IMAGE, "user_id": None}),
             change(ts_ms=None), "{not json", change(op="d", after=None, before=IMAGE)]
    folder = f"{tmp_dir}/land/table=users/dt=2024-01-01"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    sink, rejects = f"{tmp_dir}/sink", f"{tmp_dir}/rejects"
    for _ in range(2):  # a second run adds nothing
        jobs.append_job(spark, f"{tmp_dir}/land", "users", R._envelope_schema(), "user_id", R.CHANGE_COLS, sink,
                        f"{tmp_dir}/checkpoint", rejects)
    assert [r["user_id"] for r in spark.read.parquet(sink).collect()] == [1]
    reasons = sorted(r[cdc.REASON] for r in spark.read.parquet(rejects).collect())
    assert reasons == ["missing_after", "missing_key", "missing_op", "missing_ts", "unparsable", "unsupported_op"]


def test_bad_json_is_unparsable(spark):
    schema = T.StructType([T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
                           *[T.StructField(n, T.StructType([T.StructField("user_id", T.LongType())])) for n in ("before", "after")]])
    values = ["{not json", "", '{"op": "c", "ts_ms": 1, "after": {"user_id": 3}}', '{"ts_ms": 1}']
    records = spark.createDataFrame([("a.b.users", v) for v in values], "topic string, value string")
    good, bad = cdc.split_valid(cdc.decode_topic_records(records, schema), "user_id", env="_env")
    assert [r["_env"]["after"]["user_id"] for r in good.collect()] == [3]
    assert {r["_raw"]: r[cdc.REASON] for r in bad.collect()} == {
        "{not json": "unparsable", "": "unparsable", '{"ts_ms": 1}': "missing_op"}


def test_landing_date_is_the_day_of_arrival(spark):
    decoded = spark.sql("""select 'users' as table, named_struct('table', 'other', 'op', 'c', 'ts_ms', 0L,
                           'consumed_at', cast(null as timestamp_ntz)) as _env""")
    arrived = F.lit("2024-05-02 10:00:00").cast("timestamp_ntz")
    row = envelopes_for_landing(decoded, ingested_at=arrived).collect()[0]
    assert (row["table"], row["ts_ms"], str(row["dt"])) == ("users", 0, "2024-05-02")


def test_rows_without_a_key_are_never_inserted(spark):
    feed = spark.createDataFrame([("a", "x", 1), (None, "x", 2), ("b", None, 3)], "hash string, _chain string, n int")
    key = ["hash", "_chain"]
    _, loaded = cdc.insert_only_merge(None, feed, key, ["n"])
    again, _ = cdc.insert_only_merge(loaded, feed, key, ["n"])
    assert loaded.count() == 1 and again.count() == 0
    assert sorted(r["n"] for r in cdc.without_key(feed, key).collect()) == [2, 3]


def test_checks_of_an_empty_model_count_no_failures(spark):
    empty = spark.createDataFrame([], "id long, kind string")
    checks = [quality.Check("unique", "m", "id"), quality.Check("not_null", "m", "kind")]
    out = quality.run_checks({"m": empty}, checks).collect()
    assert [(r["failures"], r["status"]) for r in out] == [(0, "pass")] * 2


def test_bad_changes_of_an_entity_are_kept_apart_and_a_late_one_is_read(spark, tmp_dir):
    """A change committed early that arrives after later ones is read by the run after it landed."""
    from tidemark.plans.bronze import merge_entity
    from tidemark.sources.catalog import job_database
    land, database = f"{tmp_dir}/land", job_database(spark, "entity")

    def arrive(day, *lines):
        df = spark.createDataFrame([(line, "users", day) for line in lines], "value string, table string, dt string")
        df.write.mode("append").partitionBy("table", "dt").text(land)
        return merge_entity(spark, land, "users", database, f"{tmp_dir}/users", 4)

    def line(op, ms, lsn, **after):
        import json
        return json.dumps({"op": op, "ts_ms": ms, "after": after, "source": {"lsn": lsn}})

    arrive("2024-05-02", line("c", 10, 1, user_id=1, email="a", updated_at="2024-01-01 00:00:00"), "{cut",
           line("u", 99, 2, user_id=1, updated_at="soon"), line("u", 5, 3, email="no key"))
    # Lands in an older folder, about another user and with an earlier commit time.
    state = arrive("2024-05-01", line("c", 3, 4, user_id=2, email="b"))
    assert sorted((r["user_id"], r["email"]) for r in cdc.published(state).collect()) == [(1, "a"), (2, "b")]
    kept = spark.read.parquet(f"{tmp_dir}/users/rejects")
    assert sorted(r[cdc.REASON] for r in kept.collect()) == ["bad_updated_at", "missing_key", "unparsable"]
    before = spark.table(f"{database}.cdc_users").count()
    assert merge_entity(spark, land, "users", database, f"{tmp_dir}/users", 4).count() == before


def test_a_published_name_keeps_one_older_content(spark):
    from tidemark.sources import catalog
    name = f"{catalog.job_database(spark, 'published')}.numbers"
    contents = []
    for n in (1, 2, 3):
        assert catalog.publish(spark, spark.range(n), name) == n
        contents.append(catalog.content_table(spark, name))
        assert spark.table(name).count() == n
    assert [spark.catalog.tableExists(c) for c in contents] == [False, True, True]
