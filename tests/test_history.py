"""Stored Type-2 history: runs that append what they close."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.scd2 import scd2_apply
from tidemark.sources import history
from tidemark.sources.catalog import job_database, properties

D = dt.datetime


def source(spark, rows):
    return spark.createDataFrame([(k, s, D(2024, 1, d)) for k, s, d in rows], "id long, state string, updated_at timestamp_ntz")


RUNS = [[(1, "a", 1), (2, "b", 1), (3, "c", 2)],
        [(1, "a2", 5), (2, "b", 1), (3, "c-same-time", 2), (4, "new", 4)],
        [(1, "a3", 8), (1, "a3-older", 7), (2, "b", 1), (4, "new2", 9)],
        [(1, "a3", 8), (2, "b2", 20), (4, "new2", 9)]]


def name_of(spark):
    return f"{job_database(spark, 'history_test')}.users"


def seen(df):
    return sorted((tuple(r) for r in df.select("id", "state", "updated_at", "valid_from", "valid_to").collect()), key=str)


@pytest.mark.parametrize("hard_deletes", ["ignore", "invalidate"])
def test_stored_runs_equal_runs_over_the_whole_history(spark, hard_deletes):
    name, whole = name_of(spark), None
    for n, rows in enumerate(RUNS):
        at = F.lit(f"2024-02-0{n + 1} 00:00:00").cast("timestamp_ntz")
        whole = scd2_apply(whole, source(spark, rows), "id", "updated_at", hard_deletes, at)
        stored = history.snapshot_run(spark, name, source(spark, rows), "id", "updated_at", hard_deletes, at, buckets=3)
        assert seen(stored) == seen(whole)
    assert stored.where("id = 3 and valid_to is not null").count() == (hard_deletes == "invalidate")


def test_closed_files_stay_and_a_repeated_run_closes_nothing(spark):
    name, held = name_of(spark), {}
    for n, rows in enumerate([*RUNS, RUNS[-1]]):
        history.snapshot_run(spark, name, source(spark, rows), "id", buckets=2)
        files = set(spark.table(properties(spark, name)[history.CLOSED]).inputFiles())
        assert set(held) <= files
        held = files
    closed = spark.table(properties(spark, name)[history.CLOSED])
    assert {r[0]: r[1] for r in closed.groupBy(history.CLOSED_IN).count().collect()} == {1: 1, 2: 2, 3: 1}


def test_open_versions_meet_the_source_without_being_moved(spark):
    name = name_of(spark)
    history.snapshot_run(spark, name, source(spark, RUNS[0]), "id", buckets=5)
    from tidemark.operators.scd2 import fold_into_open
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fold_into_open(spark.table(properties(spark, name)[history.OPEN]), source(spark, RUNS[1]), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = [i for i, line in enumerate(plan.splitlines()) if "FileScan" in line]
    side = plan.splitlines()[scan[0] - 6:scan[0]]
    assert len(scan) == 1 and not any("Exchange" in line for line in side), plan


def test_a_run_that_dies_leaves_the_history_and_can_be_repeated(spark, monkeypatch):
    name = name_of(spark)
    for rows in RUNS[:2]:
        before = history.snapshot_run(spark, name, source(spark, rows), "id", buckets=2)
    want = seen(before)
    real = type(spark).sql

    def dies(self, query, *args, **kw):
        if query.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("lost")
        return real(self, query, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", dies)
        with pytest.raises(RuntimeError, match="lost"):
            history.snapshot_run(spark, name, source(spark, RUNS[2]), "id")
    assert seen(spark.table(name)) == want  # closed versions of the dead run do not show
    whole = None
    for rows in RUNS[:3]:
        whole = scd2_apply(whole, source(spark, rows), "id")
    assert seen(history.snapshot_run(spark, name, source(spark, RUNS[2]), "id")) == seen(whole)
    database = name.rpartition(".")[0]
    # The dead run's open versions are gone; those of the run before stay for its readers.
    assert spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").count() == 4
    with pytest.raises(ValueError, match="kept by id"):
        history.snapshot_run(spark, name, source(spark, RUNS[2]), "state")
