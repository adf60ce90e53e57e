"""Checks pass and fail; freshness; summary and alert."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.operators.quality import Check, failing_rows, freshness, run_checks
from tidemark.plans import monitoring
from tidemark.sources.results import read_run_results


def _results(spark):
    users = spark.createDataFrame([(1, "pending"), (2, "verified"), (2, "weird"), (None, None)],
                                  "user_id long, kyc string")
    wallets = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "wallet_id long, user_id long")
    checks = [Check("not_null", "users", "user_id"), Check("unique", "users", "user_id"),
              Check("accepted_values", "users", "kyc", values=("pending", "verified")),
              Check("relationships", "wallets", "user_id", to="users", field="user_id"),
              Check("range", "wallets", "wallet_id", min_value=11),
              Check("unique", "wallets", "wallet_id")]
    return {r.unique_id: (r.failures, r.status) for r in
            run_checks({"users": users, "wallets": wallets}, checks).collect()}


def test_checks_count_failures_and_ignore_nulls(spark):
    res = _results(spark)
    assert res["not_null_users_user_id"] == (1, "fail")
    assert res["unique_users_user_id"] == (1, "fail")
    assert res["accepted_values_users_kyc"] == (1, "fail")
    assert res["relationships_wallets_user_id__users_user_id"] == (1, "fail")
    assert res["range_wallets_wallet_id"] == (1, "fail")
    assert res["unique_wallets_wallet_id"] == (0, "pass")


def test_failing_rows(spark):
    df = spark.createDataFrame([(1, -1.0), (2, None), (3, 5.0)], "id long, usd double")
    assert [r.id for r in failing_rows(df, Check("range", "t", "usd", min_value=0)).collect()] == [1]


def test_freshness_levels(spark):
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    mk = lambda t: spark.createDataFrame([(t,)], "updated_at timestamp_ntz")
    out = freshness({"fresh": (mk(dt.datetime(2024, 1, 1, 20)), "updated_at"),
                     "warn": (mk(dt.datetime(2024, 1, 1, 12)), "updated_at"),
                     "stale": (mk(dt.datetime(2023, 12, 30)), "updated_at"),
                     "empty": (spark.createDataFrame([], "updated_at timestamp_ntz"), "updated_at")}, as_of)
    assert {r.source: r.status for r in out.collect()} == {"fresh": "pass", "warn": "warn",
                                                           "stale": "error", "empty": "error"}


def test_alert_lists_top_ten_and_counts_the_rest(spark):
    data = [(f"test.{i:02d}", "fail", f"  msg {i} " + "x" * 600, 1.234) for i in range(13)] + \
           [("test.ok", "pass", None, 0.5), ("test.err", "ERROR", "boom", None), ("test.none", None, None, None)]
    res = spark.createDataFrame(data, "unique_id string, status string, message string, execution_time double")
    row = monitoring.alert(res, "inv-1").collect()[0]
    assert row.failed == 14
    lines = row.text.split("\n")
    assert lines[0] == "14 checks need attention in run inv-1; by status: =1, error=1, fail=13, pass=1"
    assert lines[1].startswith("1) [FAIL] test.00: msg 0 xxx")
    assert len(lines[1]) == len("1) [FAIL] test.00: ") + 500
    assert len(lines) == 12 and lines[-1] == "not listed: 4"
    assert monitoring.exit_code(res) == 1
    counts = {r.status: r.n for r in monitoring.status_counts(res).collect()}
    assert counts == {"": 1, "error": 1, "fail": 13, "pass": 1}


def test_alert_when_everything_passes(spark):
    res = spark.createDataFrame([("a", "pass", None, 1.0)],
                                "unique_id string, status string, message string, execution_time double")
    row = monitoring.alert(res).collect()[0]
    assert row.failed == 0 and row.text is None
    assert monitoring.exit_code(res) == 0


def test_run_results_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "run_results.json")
    with open(path, "w") as f:
        json.dump({"metadata": {"invocation_id": "abc"},
                   "results": [{"unique_id": "t1", "status": "fail", "message": "bad", "execution_time": 0.126},
                               {"unique_id": "t2", "status": "pass", "message": None, "execution_time": 1.0}]}, f)
    res = read_run_results(spark, path)
    assert res.count() == 2
    failed = monitoring.failures(res).collect()
    assert [(r.unique_id, r.execution_time) for r in failed] == [("t1", 0.13)]
    long = res.withColumn("message", F.repeat(F.lit("x"), 700))
    assert [(len(r.message), len(r.alert_message)) for r in monitoring.failures(long).collect()] == [(700, 500)]
    missing = read_run_results(spark, os.path.join(tmp_dir, "nope.json"))
    assert missing.count() == 0 and monitoring.exit_code(missing) == 0


def test_at_most_one_open_version_fails_on_two_open_rows(spark):
    hist = spark.createDataFrame([(1, True), (1, True), (2, True), (2, False), (None, True), (None, True)],
                                 "user_id long, is_current boolean")
    res = run_checks({"h": hist}, [Check("at_most_one", "h", "user_id", where="is_current", name="one_open")])
    r = res.collect()[0]
    assert (r.unique_id, r.failures, r.status) == ("one_open", 1, "fail")
    assert r.message == "Got 1 results, configured to fail if != 0"


def test_key_checks_on_two_columns_of_one_model(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 5), (2, "b", 6)], "id long, code string, v long")
    res = {r.unique_id: r.failures for r in run_checks({"t": df}, [
        Check("unique", "t", "id"), Check("unique", "t", "code"), Check("not_null", "t", "v")]).collect()}
    assert res == {"unique_t_id": 1, "unique_t_code": 1, "not_null_t_v": 1}
