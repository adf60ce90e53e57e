"""A hot key holding a third of the rows: results equal plain SQL (DuckDB on
the same rows) and the plans keep the per-key work split."""
import duckdb
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.scd2 import as_of_join, scd2_from_log

SF = "/root/testdata/sf0.001"


def skewed_events(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    # every third event belongs to user 0: one key with a third of all rows
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def duck(df):
    con = duckdb.connect()
    con.register("e", df.toArrow())
    return con


import pytest


@pytest.mark.parametrize("stretch_rows", [250_000, 20, 1])
def test_history_and_as_of_with_hot_key(spark, stretch_rows):
    e = skewed_events(spark)
    log = e.where(F.col("event_type").isin("signup", "error", "view")) \
        .select("user_id", F.col("event_type").alias("state"), F.col("ts").alias("updated_at"), "event_id")
    hist = scd2_from_log(log, "user_id", "updated_at", ["user_id", "state"], tiebreak=["event_id"],
                         stretch_rows=stretch_rows)
    facts = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    got = sorted((r.event_id, r.state, r.valid_from) for r in
                 as_of_join(facts, hist, "user_id", "ts", ["state"],
                            stretch_rows=stretch_rows).collect())
    con = duck(e)
    want = con.execute("""
        with h as (select user_id, event_type as state, ts as valid_from,
                          lead(ts) over (partition by user_id order by ts) as valid_to
                   from e where event_type in ('signup','error','view'))
        select f.event_id, h.state, h.valid_from
        from (select * from e where event_type = 'purchase') f
        left join h on f.user_id = h.user_id and f.ts >= h.valid_from
                   and f.ts < coalesce(h.valid_to, timestamp '9999-12-31')
        order by 1""").fetchall()
    assert got == [tuple(w) for w in want]
    hot = [r for r in hist.collect() if r.user_id == 0]
    assert len(hot) == con.execute("select count(*) from e where user_id = 0 and event_type in "
                                   "('signup','error','view')").fetchone()[0]


def test_compaction_with_hot_key_plans_partial_limit(spark):
    e = skewed_events(spark)
    rows = e.select("user_id", F.col("event_type").alias("state"),
                    F.when(F.col("event_type") == "error", "d").otherwise("u").alias("_cdc_op"),
                    F.col("event_id").alias("_cdc_ts_ms"), F.col("event_id").alias("_cdc_lsn"))
    state = cdc.compact(rows, "user_id")
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = sorted((r.user_id, r.state) for r in cdc.published(state).collect())
    want = duck(e).execute("""
        select user_id, event_type from (
          select *, row_number() over (partition by user_id order by event_id desc) rn from e) x
        where rn = 1 and event_type <> 'error' order by 1""").fetchall()
    assert got == [tuple(w) for w in want]


def test_latest_per_key_hot_key(spark):
    e = skewed_events(spark)
    got = sorted(r.event_id for r in latest_per_key(e, "user_id", ["ts", "event_id"]).collect())
    want = [r[0] for r in duck(e).execute("""
        select event_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn
                              from e) x where rn = 1 order by 1""").fetchall()]
    assert got == want


def burst(spark, rows=100_000):
    """One key over ten years, nine of ten rows within one hour; event times at most a second apart there."""
    us = F.when(F.col("id") % 10 < 9, F.col("id") * 36_000).otherwise(F.col("id") * 3_153_600_000)
    return spark.range(rows).select(F.lit(7).alias("user_id"), F.col("id").alias("event_id"),
                                    F.timestamp_micros(us).cast("timestamp_ntz").alias("ts"))


def test_a_burst_of_one_key_is_cut_by_rows(spark):
    from tidemark.operators.timeline import POS, Stretches, instant
    e = burst(spark).withColumn(POS, instant("ts"))
    stretches = Stretches(e, ["user_id"], 5_000)
    sizes = [r["count"] for r in stretches.number(e, "b").groupBy("user_id", "b").count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) > 10
    assert max(sizes) < 40_000  # 5,000 on average; equal widths of time put 90,000 into one


def test_history_and_as_of_of_a_burst_equal_sql(spark):
    e = burst(spark, 20_000)
    log = e.where("event_id % 2 = 0").select("user_id", F.col("event_id").alias("state"),
                                             F.col("ts").alias("updated_at"), "event_id")
    hist = scd2_from_log(log, "user_id", "updated_at", ["user_id", "state"], tiebreak=["event_id"], stretch_rows=500)
    facts = e.where("event_id % 2 = 1")
    got = sorted((r.event_id, r.state) for r in as_of_join(facts, hist, "user_id", "ts", ["state"],
                                                            stretch_rows=500).collect())
    want = duck(e).execute("""
        select f.event_id, h.event_id from (select * from e where event_id % 2 = 1) f
        asof left join (select ts, min(event_id) as event_id from e where event_id % 2 = 0 group by ts) h
        on f.ts >= h.ts order by 1""").fetchall()
    assert got == want


def test_one_instant_is_cut_too(spark):
    """100,000 rows of one key at one instant: stretches stay small, and what the last mark said holds in all."""
    from tidemark.operators.timeline import POS, Stretches, last_at_or_before, place
    at = F.lit("2024-05-01 12:00:00").cast("timestamp_ntz")
    e = spark.range(100_000).select(F.lit(7).alias("user_id"), F.col("id").alias("event_id"), at.alias("ts"))
    placed = e.withColumn(POS, place("ts", 1, e.columns))
    sizes = [r["count"] for r in Stretches(placed, ["user_id"], 2_000).number(placed, "b").groupBy("b").count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) > 25 and max(sizes) < 20_000
    marks = spark.sql("""select * from values (7, timestamp_ntz'2024-05-01 11:00:00', 'earlier'), (7, timestamp_ntz'2024-05-01 12:00:00', 'same'),
                         (7, timestamp_ntz'2024-05-01 12:00:01', 'later') as m(user_id, ts, what)""")
    for held, want in ((marks, "same"), (marks.where("what <> 'same'"), "earlier"), (marks.where("what = 'later'"), None)):
        found = last_at_or_before(e, held, ["user_id"], "ts", "what", "what", 2_000)
        assert [(r["what"], r["count"]) for r in found.groupBy("what").count().collect()] == [(want, 100_000)]
        assert found.select("event_id").distinct().count() == 100_000


def test_events_and_marks_of_few_instants_equal_sql(spark):
    e = spark.range(6_000).select((F.col("id") % 3).alias("user_id"), F.col("id").alias("event_id"),
                                  F.timestamp_micros(F.col("id") % 40 * 1_000_000).cast("timestamp_ntz").alias("ts"),
                                  F.create_map(F.lit("a"), F.col("id")).alias("m"))
    hist = scd2_from_log(e.where("event_id % 7 = 0").select("user_id", F.col("event_id").alias("state"), F.col("ts").alias("updated_at"),
                                                            "event_id"),
                         "user_id", "updated_at", ["user_id", "state"], tiebreak=["event_id"], stretch_rows=3)
    got = sorted((r.event_id, r.state) for r in as_of_join(e, hist, "user_id", "ts", ["state"], stretch_rows=10).collect())
    want = duck(e.drop("m")).execute("""
        select f.event_id, h.event_id from e f
        asof left join (select user_id, ts, min(event_id) as event_id from e where event_id % 7 = 0 group by all) h
        on f.user_id = h.user_id and f.ts >= h.ts order by 1""").fetchall()
    assert got == want
