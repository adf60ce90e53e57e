import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import boundary_seconds, epoch_ms, nullif_blank, trunc_ntz


def _one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("x")).collect()[0]["x"]


def test_boundary_seconds_counts_crossed_boundaries(spark):
    a = dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    b = dt.datetime(2024, 1, 1, 0, 0, 1, 100000)
    assert _one(spark, boundary_seconds("a", "b"), [(a, b)], "a timestamp_ntz, b timestamp_ntz") == 1
    assert _one(spark, boundary_seconds("b", "a"), [(a, b)], "a timestamp_ntz, b timestamp_ntz") == -1


def test_epoch_ms_truncates(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 999999)
    assert _one(spark, epoch_ms("t"), [(t,)], "t timestamp_ntz") == 1704067200999


def test_epoch_ms_is_zone_free(spark):
    t = dt.datetime(2024, 3, 10, 2, 30, 0)
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = _one(spark, epoch_ms("t"), [(t,)], "t timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert ny == _one(spark, epoch_ms("t"), [(t,)], "t timestamp_ntz") == 1710037800000


def test_trunc_ntz_grains(spark):
    t = dt.datetime(2024, 5, 15, 13, 45)
    schema = "t timestamp_ntz"
    assert _one(spark, trunc_ntz("day", "t"), [(t,)], schema) == dt.datetime(2024, 5, 15)
    assert _one(spark, trunc_ntz("week", "t"), [(t,)], schema) == dt.datetime(2024, 5, 13)
    assert _one(spark, trunc_ntz("month", "t"), [(t,)], schema) == dt.datetime(2024, 5, 1)
    assert _one(spark, trunc_ntz("year", "t"), [(t,)], schema) == dt.datetime(2024, 1, 1)


def test_nullif_blank(spark):
    rows = spark.createDataFrame([("  ",), (" a ",), (None,)], "h string") \
        .select(nullif_blank("h").alias("x")).collect()
    assert [r.x for r in rows] == [None, "a", None]


def test_fixed_time_spine_has_731_days(spark):
    from tidemark.plans.marts import time_spine
    days = time_spine(spark, "2025-01-01", "2027-01-01")
    assert days.count() == 731
    assert days.agg(F.min("date_day"), F.max("date_day")).collect()[0] == (dt.date(2025, 1, 1), dt.date(2027, 1, 1))


def test_cluster_conf_sizes_partitions():
    from tidemark.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 1000, 8)
    assert c["spark.sql.shuffle.partitions"] == "102400"
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert cluster_conf(10 * 1024 ** 3, 100, 4)["spark.sql.shuffle.partitions"] == "1200"
