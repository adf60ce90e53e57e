"""Type-2 history and point-in-time joins."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.scd2 import as_of_join, scd2_apply, scd2_from_log

D = dt.datetime
SRC = "user_id long, state string, updated_at timestamp_ntz"


def src(spark, data):
    return spark.createDataFrame(data, SRC)


def hist_rows(df):
    return sorted((r.user_id, r.state, r.valid_from, r.valid_to) for r in df.collect())


def test_first_run_opens_one_version_per_key_even_with_duplicates(spark):
    h = scd2_apply(None, src(spark, [(1, "a", D(2024, 1, 1)), (1, "b", D(2024, 1, 2)), (2, "x", D(2024, 1, 1))]),
                   "user_id")
    assert hist_rows(h) == [(1, "b", D(2024, 1, 2), None), (2, "x", D(2024, 1, 1), None)]


def test_changed_unchanged_new_and_not_newer(spark):
    h1 = scd2_apply(None, src(spark, [(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 1)),
                                      (3, "c", D(2024, 1, 5))]), "user_id")
    run2 = src(spark, [(1, "a2", D(2024, 1, 3)),      # newer: close + open
                       (2, "b", D(2024, 1, 1)),       # unchanged
                       (3, "c_old", D(2024, 1, 4)),   # older: no change
                       (4, "d", D(2024, 1, 2))])      # new key
    h2 = scd2_apply(h1, run2, "user_id")
    assert hist_rows(h2) == [
        (1, "a", D(2024, 1, 1), D(2024, 1, 3)), (1, "a2", D(2024, 1, 3), None),
        (2, "b", D(2024, 1, 1), None), (3, "c", D(2024, 1, 5), None), (4, "d", D(2024, 1, 2), None)]
    # equal updated_at with other values: still no change
    h3 = scd2_apply(h2, src(spark, [(2, "b_changed", D(2024, 1, 1))]), "user_id")
    assert hist_rows(h3) == hist_rows(h2)


def test_hard_deletes_invalidate(spark):
    h1 = scd2_apply(None, src(spark, [(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 1))]), "user_id")
    h2 = scd2_apply(h1, src(spark, [(1, "a", D(2024, 1, 1))]), "user_id", hard_deletes="invalidate",
                    as_of=F.lit("2024-02-01 00:00:00"))
    assert hist_rows(h2) == [(1, "a", D(2024, 1, 1), None), (2, "b", D(2024, 1, 1), D(2024, 2, 1))]
    h2i = scd2_apply(h1, src(spark, [(1, "a", D(2024, 1, 1))]), "user_id")
    assert hist_rows(h2i) == hist_rows(h1)


def test_from_log_equals_run_by_run(spark):
    log = [(1, "a", D(2024, 1, 1)), (1, "b", D(2024, 1, 3)), (1, "c", D(2024, 2, 9)),
           (2, "x", D(2024, 1, 2)), (2, "y", D(2024, 3, 1, 12))]
    whole = scd2_from_log(src(spark, log), "user_id", "updated_at", ["user_id", "state"])
    h = None
    for row in sorted(log, key=lambda r: r[2]):
        h = scd2_apply(h, src(spark, [row]), "user_id")
    assert hist_rows(whole) == hist_rows(h)


def test_from_log_stretch_edges(spark):
    # versions far apart (long gaps between) and close together
    log = [(1, f"s{i}", D(2024, 1, 1) + dt.timedelta(hours=7 * i * i)) for i in range(12)]
    for stretch in (1, 2, 5, 250_000):
        out = scd2_from_log(src(spark, log), "user_id", "updated_at", ["user_id", "state"], stretch_rows=stretch)
        got = sorted((r.valid_from, r.valid_to) for r in out.collect())
        starts = sorted(r[2] for r in log)
        assert got == list(zip(starts, starts[1:] + [None]))


def test_as_of_join_boundaries(spark):
    hist = spark.createDataFrame(
        [(1, "a", D(2024, 1, 1), D(2024, 1, 5)), (1, "b", D(2024, 1, 5), D(2024, 1, 9)),
         (1, "c", D(2024, 3, 1), None), (2, "z", D(2024, 1, 3), None)],
        "user_id long, state string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame(
        [(10, 1, D(2023, 12, 31)),   # before first version
         (11, 1, D(2024, 1, 1)),     # at valid_from: inclusive
         (12, 1, D(2024, 1, 5)),     # at valid_to of a: next version
         (13, 1, D(2024, 2, 1)),     # in a gap (b closed, c not yet open)
         (14, 1, D(2024, 6, 1)),     # open version, long after
         (15, 2, D(2024, 1, 3)),
         (16, 3, D(2024, 1, 3))],    # key without history
        "fact_id long, user_id long, ts timestamp_ntz")
    for stretch in (1, 2, 5, 250_000):
        out = as_of_join(facts, hist, "user_id", "ts", ["state"], stretch_rows=stretch)
        got = {r.fact_id: r.state for r in out.collect()}
        assert got == {10: None, 11: "a", 12: "b", 13: None, 14: "c", 15: "z", 16: None}
    inner = as_of_join(facts, hist, "user_id", "ts", ["state"], how="inner")
    assert sorted(r.fact_id for r in inner.collect()) == [11, 12, 14, 15]
