"""The merge-on-read state: appended changes, an exchange-free reader, the fold."""
import itertools

import pytest

from tidemark.operators import cdc
from tidemark.sources import state
from tidemark.sources.catalog import job_database
from tests.test_cdc import LOG, live, rows


def name_of(spark, what):
    return f"{job_database(spark, 'state_test')}.{what}"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("buckets", [4, 7])
def test_readers_and_folds_move_no_row_and_runs_write_their_batch_only(spark, buckets):
    name = name_of(spark, "users")
    big = [(k, f"s{k}", "c", 1, k) for k in range(2000)]
    state.merge_into_table(spark, name, rows(spark, big), "user_id", buckets)
    for step in range(3):
        state.merge_into_table(spark, name, rows(spark, [(k, f"n{k}", "u", 2 + step, k) for k in range(step, step + 5)]), "user_id")
    tables = state.state_tables(spark, name)
    # Three runs of five changes wrote fifteen rows beside a base of two thousand, which stays as it was.
    assert spark.table(tables.changes).count() == 15 and spark.table(tables.base).count() == 2000
    read = state.read_state(spark, name)
    assert "Exchange" not in plan_of(read) and "Bucketed: true" in plan_of(read)
    assert "Exchange" not in plan_of(read.select("state").where("user_id > 3"))
    want = live(cdc.merge_changes(None, rows(spark, big + [(k, f"n{k}", "u", 2 + s, k) for s in range(3) for k in range(s, s + 5)]), "user_id"))
    assert live(read) == want
    assert not state.is_due(spark, name) and state.is_due(spark, name, 0.005)
    folded = state.fold(spark, name)
    assert live(folded) == want
    after = state.state_tables(spark, name)
    assert spark.table(after.changes).count() == 0 and state.bucket_count(spark, after.base) == buckets
    files = spark.table(after.base).inputFiles()
    assert len({f.rsplit("_", 1)[1].split(".")[0] for f in files}) == len(files)  # one file a bucket


def test_another_number_of_buckets(spark):
    name = name_of(spark, "users")
    for part in (LOG[0::3], LOG[1::3]):
        state.merge_into_table(spark, name, rows(spark, part), "user_id", 4)
    state.fold(spark, name, buckets=9)
    # The job need not know: the stored number counts from now on.
    state.merge_into_table(spark, name, rows(spark, LOG[2::3]), "user_id", 4)
    tables = state.state_tables(spark, name)
    assert state.bucket_count(spark, tables.base) == state.bucket_count(spark, tables.changes) == 9
    assert "Exchange" not in plan_of(state.read_state(spark, name))
    assert live(state.read_state(spark, name)) == live(cdc.merge_changes(None, rows(spark, LOG), "user_id"))


def test_order_of_batches_and_folds_does_not_matter(spark):
    whole = live(cdc.merge_changes(None, rows(spark, LOG), "user_id"))
    batches = [LOG[i::3] for i in range(3)]
    for n, order in enumerate(itertools.permutations(range(3))):
        name = name_of(spark, "users")
        for step, i in enumerate(order):
            state.merge_into_table(spark, name, rows(spark, batches[i]), "user_id", 3)
            if step == n % 3:
                state.fold(spark, name)
        state.merge_into_table(spark, name, rows(spark, batches[order[0]]), "user_id", 3)  # a replay
        assert live(state.read_state(spark, name)) == whole


def test_a_late_older_change_cannot_bring_a_deleted_key_back(spark):
    name = name_of(spark, "users")
    state.merge_into_table(spark, name, rows(spark, [(1, "a", "c", 1, 1)]), "user_id", 2)
    state.merge_into_table(spark, name, rows(spark, [(1, None, "d", 10, 2)]), "user_id")
    state.merge_into_table(spark, name, rows(spark, [(1, "stale", "u", 5, 3), (2, "b", "c", None, None)]), "user_id")
    assert live(state.read_state(spark, name)) == [(2, "b")]
    assert live(state.fold(spark, name)) == [(2, "b")]
    state.merge_into_table(spark, name, rows(spark, [(1, "stale", "u", 6, 3)]), "user_id")
    assert live(state.read_state(spark, name)) == [(2, "b")]


def test_rows_the_state_has_are_not_written_again(spark):
    name = name_of(spark, "users")
    state.merge_into_table(spark, name, rows(spark, LOG), "user_id", 3)
    changes = state.state_tables(spark, name).changes
    state.merge_into_table(spark, name, rows(spark, LOG), "user_id", only_newer=True)
    assert spark.table(changes).count() == 0
    state.merge_into_table(spark, name, rows(spark, LOG + [(1, "new", "u", 99, 1), (77, "x", "c", 1, 1)]), "user_id", only_newer=True)
    spark.catalog.refreshTable(changes)
    assert spark.table(changes).count() == 2


def test_unused_tables_go_and_others_stay(spark):
    name = name_of(spark, "users")
    state.merge_into_table(spark, name, rows(spark, LOG), "user_id", 2)
    database = name.rpartition(".")[0]
    spark.range(3).write.saveAsTable(f"{database}.users__base_0123abcd")  # left by a fold that died
    spark.range(3).write.saveAsTable(f"{database}.users__daily__0123abcd")  # another name's
    old = state.state_tables(spark, name)
    state.fold(spark, name)
    held = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").collect()}
    new = state.state_tables(spark, name)
    assert held == {"users", "users__daily__0123abcd", *(t.rpartition(".")[2] for t in (old.base, old.changes, new.base, new.changes))}
    with pytest.raises(ValueError, match="kept by user_id"):
        state.merge_into_table(spark, name, rows(spark, LOG), "state")
