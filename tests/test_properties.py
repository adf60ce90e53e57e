"""Property tests: the ordered merge equals a plain-Python replay of the log,
whatever the batch boundaries, batch order and replays."""
from hypothesis import given, settings, strategies as st

from tidemark.operators import cdc

SCHEMA = "user_id long, state string, _cdc_op string, _cdc_ts_ms long, _cdc_lsn long"

events = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["c", "u", "d"]), st.integers(0, 15)),
                  min_size=1, max_size=25)


def expected(log):
    last = {}
    for key, op, ts, lsn in log:
        if key not in last or (ts, lsn) > last[key][:2]:
            last[key] = (ts, lsn, op)
    return sorted((k, f"v{v[1]}") for k, v in last.items() if v[2] != "d")


@settings(max_examples=8, deadline=None)
@given(events, st.integers(1, 4), st.randoms(use_true_random=False))
def test_merge_matches_replay(spark, evs, n_batches, rnd):
    log = [(k, op, ts, lsn) for lsn, (k, op, ts) in enumerate(evs)]
    rows = [(k, None if op == "d" else f"v{lsn}", op, ts, lsn) for k, op, ts, lsn in log]
    rnd.shuffle(rows)
    batches = [rows[i::n_batches] for i in range(n_batches)]
    order = list(range(n_batches))
    rnd.shuffle(order)
    state = None
    for i in order + order[:1]:  # the first batch is replayed at the end
        if batches[i]:
            state = cdc.merge_changes(state, spark.createDataFrame(batches[i], SCHEMA), "user_id")
    got = sorted((r.user_id, r.state) for r in cdc.published(state).collect()) if state is not None else []
    assert got == expected(log)
