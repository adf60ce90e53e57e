"""Ordered compaction and merges on literal change sets."""
import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc

SCHEMA = "user_id long, state string, _cdc_op string, _cdc_ts_ms long, _cdc_lsn long"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def live(df):
    return sorted((r.user_id, r.state) for r in cdc.published(df).collect())


def test_delete_then_reinsert_keeps_the_row(spark):
    b = rows(spark, [(1, "a", "c", 1, 1), (1, None, "d", 2, 2), (1, "b", "c", 3, 3)])
    assert live(cdc.merge_changes(None, b, "user_id")) == [(1, "b")]


def test_delete_on_first_load_removes_the_key(spark):
    b = rows(spark, [(1, "a", "c", 1, 1), (1, None, "d", 2, 2), (2, "x", "c", 1, 3)])
    assert live(cdc.merge_changes(None, b, "user_id")) == [(2, "x")]


def test_equal_ts_is_broken_by_lsn(spark):
    b = rows(spark, [(1, "late_lsn", "u", 5, 9), (1, "early_lsn", "u", 5, 2)])
    assert live(cdc.merge_changes(None, b, "user_id")) == [(1, "late_lsn")]


def test_older_late_upsert_cannot_resurrect_a_deleted_key(spark):
    s1 = cdc.merge_changes(None, rows(spark, [(1, "a", "c", 1, 1), (1, None, "d", 10, 2)]), "user_id")
    s2 = cdc.merge_changes(s1, rows(spark, [(1, "stale", "u", 5, 3)]), "user_id")
    assert live(s2) == []
    s3 = cdc.merge_changes(s2, rows(spark, [(1, "fresh", "u", 11, 4)]), "user_id")
    assert live(s3) == [(1, "fresh")]


def test_tie_between_state_and_batch_goes_to_batch(spark):
    s1 = cdc.merge_changes(None, rows(spark, [(1, "old", "u", 5, 1)]), "user_id")
    s2 = cdc.merge_changes(s1, rows(spark, [(1, "new", "u", 5, 1)]), "user_id")
    assert live(s2) == [(1, "new")]


LOG = [(k, f"s{k}_{t}", op, t, t * 10 + k)
       for k in range(1, 5) for t, op in enumerate(["c", "u", "d", "c", "u", "d", "u"][: 3 + k])]


def test_merge_is_idempotent_and_order_free(spark):
    whole = live(cdc.merge_changes(None, rows(spark, LOG), "user_id"))
    batches = [LOG[i::3] for i in range(3)]
    for perm in itertools.permutations(range(3)):
        state = None
        for i in perm:
            state = cdc.merge_changes(state, rows(spark, batches[i]), "user_id")
        # replaying a batch changes nothing
        state = cdc.merge_changes(state, rows(spark, batches[perm[0]]), "user_id")
        assert live(state) == whole


def test_split_valid_quarantines_bad_ops_and_keys(spark):
    env = spark.createDataFrame(
        [("c", None, (1, "a")), (None, None, (2, "b")), ("x", None, (3, "c")),
         ("u", None, None), ("d", (None, None), None), ("d", (5, None), None)],
        "op string, before struct<user_id:long,state:string>, after struct<user_id:long,state:string>")
    good, bad = cdc.split_valid(env, "user_id")
    assert good.count() == 2
    reasons = sorted(r[cdc.REASON] for r in bad.collect())
    assert reasons == ["missing_after", "missing_key", "missing_op", "unsupported_op"]


def test_cast_columns_quarantines_unparsable_decimals(spark):
    df = spark.createDataFrame([("1.50",), ("abc",), (None,)], "amount string")
    good, bad = cdc.cast_columns(df, {"amount": __import__("pyspark.sql.types", fromlist=["x"]).DecimalType(18, 2)})
    assert sorted(str(r.amount) for r in good.collect()) == ["1.50", "None"]
    assert [r[cdc.REASON] for r in bad.collect()] == ["bad_amount"]


def test_insert_only_merge_first_seen_wins(spark):
    schema = "hash string, _chain string, _ingested_at long, v long"
    t1 = spark.createDataFrame([("h1", "eth", 1, 10), ("h1", "eth", 0, 11), ("h2", "eth", 5, 12)], schema)
    new, table = cdc.insert_only_merge(None, t1, ["hash", "_chain"], ["_ingested_at"])
    assert sorted((r.hash, r.v) for r in table.collect()) == [("h1", 11), ("h2", 12)]
    t2 = spark.createDataFrame([("h1", "eth", -5, 99), ("h3", "eth", 7, 13), ("h3", "eth", 8, 14),
                                ("h1", "base", 1, 15)], schema)
    new, table = cdc.insert_only_merge(table, t2, ["hash", "_chain"], ["_ingested_at"])
    assert sorted((r.hash, r._chain, r.v) for r in new.collect()) == [("h1", "base", 15), ("h3", "eth", 13)]
    assert table.count() == 4


def test_union_all_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, 3.0)], "id long, b double")
    out = cdc.union_all([a, b])
    assert sorted(out.columns) == ["a", "b", "id"] and out.count() == 2


def test_decode_skips_tombstones_and_flags_garbage(spark):
    from tidemark.schemas import envelope
    from pyspark.sql import types as T
    img = T.StructType([T.StructField("user_id", T.LongType())])
    recs = spark.createDataFrame(
        [("p.public.users", '{"op":"c","ts_ms":1,"after":{"user_id":1}}'),
         ("p.public.users", None), ("p.public.users", "{not json")], "topic string, value string")
    env = cdc.decode_topic_records(recs, envelope(img))
    good, bad = cdc.split_valid(env, "user_id", env="_env")
    assert [r.table for r in good.collect()] == ["users"]
    assert bad.count() == 1


def test_change_without_commit_time_is_quarantined(spark):
    env = spark.createDataFrame([("c", 1, (1, "a")), ("u", None, (1, "b"))],
                                "op string, ts_ms long, after struct<user_id:long,state:string>")
    env = env.withColumn("before", F.lit(None).cast("struct<user_id:long,state:string>"))
    good, bad = cdc.split_valid(env, "user_id")
    assert good.count() == 1
    assert [r[cdc.REASON] for r in bad.collect()] == ["missing_ts"]


@pytest.mark.parametrize("query", ["q_cdc_flatten", "q_cdc_quarantine"])
def test_each_record_is_parsed_once(spark, query):
    from tidemark import registry as R
    plan = getattr(R, query)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1, plan


def test_envelope_of_texts_that_are_none(spark):
    from pyspark.sql import types as T
    image = T.StructType([T.StructField("user_id", T.LongType())])
    schema = T.StructType([T.StructField("op", T.StringType()), T.StructField("after", image)])
    texts = ['{"op": "u", "after": {"user_id": 1}}', "{}", "", "{cut", '{"op": "u", "after": {"user_id": "x"}}', "null", "[]", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    got = {r["n"]: r["e"] for r in cdc.with_envelope(df, F.col("value"), schema, "e").collect()}
    assert len(got) == 8 and (got[0].op, got[0].after.user_id) == ("u", 1) and (got[1].op, got[1].after) == (None, None)
    assert all(got[n] is None for n in range(2, 8))
