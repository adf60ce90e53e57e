"""Metric layer semantics."""
import datetime as dt
from decimal import Decimal

import pytest

from tidemark.plans.metrics import MetricRequest, metric_query

D = dt.datetime
FACT = ("transaction_id long, user_id long, chain string, status string, direction string, asset_symbol string, "
        "usd_value_at_tx decimal(18,2), confirmation_seconds long, submitted_at timestamp_ntz, "
        "submitted_date timestamp_ntz")


def fact(spark):
    rows = [(1, 1, "eth", "confirmed", "send", "ETH", Decimal("10.00"), 5, D(2024, 1, 1, 3), D(2024, 1, 1)),
            (2, 1, "eth", "pending", "send", "ETH", Decimal("2.50"), None, D(2024, 1, 1, 4), D(2024, 1, 1)),
            (3, 2, "bsc", "failed", "swap", "BNB", None, None, D(2024, 1, 3, 1), D(2024, 1, 3))]
    return spark.createDataFrame(rows, FACT)


def test_ratio_is_zero_without_numerator_rows(spark):
    out = metric_query(fact(spark), MetricRequest(["confirmed_transaction_rate", "transaction_count",
                                                   "avg_confirmation_seconds"], ["chain"]))
    got = {r.chain: (r.confirmed_transaction_rate, r.transaction_count, r.avg_confirmation_seconds)
           for r in out.collect()}
    assert got == {"eth": (0.5, 2, 5.0), "bsc": (0.0, 1, None)}


def test_fill_joins_the_day_spine(spark):
    out = metric_query(fact(spark), MetricRequest(["transaction_volume_usd", "transaction_count"],
                                                  ["metric_time"], "day", fill=0))
    got = sorted((r.metric_time__day, r.transaction_volume_usd, r.transaction_count) for r in out.collect())
    assert got == [(D(2024, 1, 1), Decimal("12.50"), 2), (D(2024, 1, 2), Decimal("0.00"), 0),
                   (D(2024, 1, 3), Decimal("0.00"), 1)]


def test_user_dimension_join_only_when_asked(spark):
    users = spark.createDataFrame([(1, "US", "verified", "organic", D(2020, 1, 1)),
                                   (2, "DE", "pending", "paid_ad", D(2020, 1, 1))],
                                  "user_id long, country_code string, kyc_status string, signup_channel string, "
                                  "user_created_at timestamp_ntz")
    out = metric_query(fact(spark), MetricRequest(["transaction_count"], ["user_id__country_code"]), users)
    assert {r.user_id__country_code: r.transaction_count for r in out.collect()} == {"US": 2, "DE": 1}
    with pytest.raises(KeyError):
        metric_query(fact(spark), MetricRequest(["transaction_count"], ["no_such_dim"]))
    with pytest.raises(ValueError):
        metric_query(fact(spark), MetricRequest(["transaction_count"], ["user_id__country_code"]))


def test_where_filter_is_typed(spark):
    from pyspark.sql import functions as F
    out = metric_query(fact(spark), MetricRequest(["transaction_count"], ["chain"], where=F.col("direction") == "send"))
    assert {r.chain: r.transaction_count for r in out.collect()} == {"eth": 2}


def test_two_phase_equals_single_pass(spark):
    from pyspark.sql import functions as F
    from tidemark.plans.domain import Domain
    d = Domain(spark, "/root/testdata/sf0.001")
    req = dict(metrics=["transaction_volume_usd", "transaction_count", "confirmed_transaction_rate",
                        "avg_confirmation_seconds"], group_by=["user_id__kyc_status", "chain"])
    two = metric_query(d.fact_transactions, MetricRequest(**req), d.dim_users)
    always = F.col("user_id__kyc_status").isNull() | F.col("user_id__kyc_status").isNotNull()  # a users column
    one = metric_query(d.fact_transactions, MetricRequest(**req, where=always), d.dim_users)
    key = lambda r: (r.user_id__kyc_status, r.chain)
    norm = lambda rows: sorted(((key(r), r.transaction_volume_usd, r.transaction_count, r.confirmed_transaction_rate,
                                 round(r.avg_confirmation_seconds, 6)) for r in rows), key=lambda x: x[0])
    assert norm(two.collect()) == norm(one.collect())


def test_filter_on_users_column_joins_first(spark):
    from pyspark.sql import functions as F
    users = spark.createDataFrame([(1, "US", "verified", "organic", D(2020, 1, 1)),
                                   (2, "DE", "pending", "paid_ad", D(2020, 1, 1))],
                                  "user_id long, country_code string, kyc_status string, signup_channel string, "
                                  "user_created_at timestamp_ntz")
    by_user_col = metric_query(fact(spark), MetricRequest(["transaction_count"], ["user_id__country_code"],
                                                          where=F.col("user_id__country_code") == "DE"), users)
    assert {r.user_id__country_code: r.transaction_count for r in by_user_col.collect()} == {"DE": 1}
    by_fact_col = metric_query(fact(spark), MetricRequest(["transaction_count"], ["user_id__country_code"],
                                                          where=F.col("status") == "confirmed"), users)
    assert {r.user_id__country_code: r.transaction_count for r in by_fact_col.collect()} == {"US": 1}


USERS_DIM = ("user_id long, country_code string, kyc_status string, signup_channel string, user_created_at timestamp_ntz, "
             "wallet_count long")


def users_dim(spark):
    return spark.createDataFrame([(1, "US", "verified", "organic", D(2024, 1, 5), 2), (2, "DE", "pending", None, D(2023, 11, 2), 1),
                                  (3, "DE", "pending", "paid_ad", D(2024, 1, 1), 4)], USERS_DIM)


def test_fill_keeps_every_period_of_every_group_once(spark):
    rows = fact(spark).unionByName(spark.createDataFrame(
        [(4, 2, None, "failed", "swap", "BNB", Decimal("1.00"), None, D(2024, 1, 5), D(2024, 1, 5)),
         (5, 2, None, "failed", "swap", "BNB", Decimal("1.00"), None, D(2024, 1, 7), D(2024, 1, 7)),
         (6, 2, "bsc", "failed", "swap", "BNB", Decimal("9.00"), None, None, None)], FACT))

    def found(**options):
        out = metric_query(rows, MetricRequest(["transaction_count"], ["chain", "metric_time"], fill=0, **options)).collect()
        assert len({(r.chain, r[1]) for r in out}) == len(out)
        return {(r.chain, r[1] and (r[1].month, r[1].day)): r.transaction_count for r in out}

    own = {("eth", (1, 1)): 2, ("bsc", (1, 3)): 1, (None, (1, 5)): 1, (None, (1, 6)): 0, (None, (1, 7)): 1, ("bsc", None): 1}
    assert found() == own
    whole = {(c, (1, d)): 0 for c in ("eth", "bsc", None) for d in range(1, 8)} | {k: v for k, v in own.items()}
    assert found(fill_span="all") == whole
    spine = spark.sql("select explode(sequence(date'2023-12-30', date'2024-01-07')) as date_day")
    assert found(spine=spine) == {(c, d): 0 for c in ("eth", "bsc", None) for d in ((12, 30), (12, 31))} | whole
    assert found(grain="month") == {("eth", (1, 1)): 2, ("bsc", (1, 1)): 1, (None, (1, 1)): 2, ("bsc", None): 1}
    with pytest.raises(ValueError):
        found(fill_span="some")
    empty = metric_query(rows.limit(0), MetricRequest(["transaction_count"], ["chain", "metric_time"], fill=0))
    assert empty.collect() == []


@pytest.mark.parametrize("grain", ["week", "quarter", "year"])
def test_fill_at_coarse_grains(spark, grain):
    import pandas as pd
    days = [D(2022, 12, 30), D(2023, 6, 1), D(2024, 2, 29)]
    rows = spark.createDataFrame([(i, 1, "eth", "failed", "send", "E", None, None, d, d) for i, d in enumerate(days)], FACT)
    out = metric_query(rows, MetricRequest(["transaction_count"], ["metric_time"], grain, fill=0)).collect()
    code = {"week": "W", "quarter": "Q", "year": "Y"}[grain]
    want = [p.start_time.to_pydatetime() for p in pd.period_range(days[0], days[2], freq=code)]
    assert sorted(r[0] for r in out) == want and sum(r[1] for r in out) == 3


def test_metrics_of_two_models_keep_the_groups_of_either(spark):
    from tidemark.plans.metrics import metrics_across
    request = lambda groups, **o: MetricRequest(["wallet_count", "transaction_count", "confirmed_transaction_rate"], groups, "month", **o)
    out = metrics_across(fact(spark), users_dim(spark), request(["user_id__signup_channel", "metric_time"]))
    got = {(r[0], (r[1].year, r[1].month)): tuple(r)[2:] for r in out.collect()}
    assert got == {("organic", (2024, 1)): (2, 2, 0.5), (None, (2024, 1)): (None, 1, 0.0),
                   (None, (2023, 11)): (1, None, None), ("paid_ad", (2024, 1)): (4, None, None)}
    out = metrics_across(fact(spark), users_dim(spark), request(["user_id__signup_channel", "metric_time"], fill=0))
    got = {(r[0], (r[1].year, r[1].month)): tuple(r)[2:] for r in out.collect()}
    assert got[(None, (2023, 12))] == (0, 0, None) and got[(None, (2024, 1))] == (0, 1, 0.0) and len(got) == 5
    assert [tuple(r) for r in metrics_across(fact(spark), users_dim(spark), request([])).collect()] == [(7, 3, 1 / 3)]
    plan = metrics_across(fact(spark), users_dim(spark), request([]))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(KeyError):
        metrics_across(fact(spark), users_dim(spark), request(["chain"]))
