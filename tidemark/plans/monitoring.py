"""Check-result summary and alert text.

Input is any DataFrame with ``unique_id, status, message, execution_time``:
the results of ``run_checks`` or a scanned run-results file. Everything is a
DataFrame expression; the alert is built from a bounded top-N (the report is
the first ``ALERT_TOP_N`` failures plus a count of the rest), never from a
collect of all failures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import ALERT_MESSAGE_MAX_CHARS, ALERT_TOP_N, FAILURE_STATUSES


def normalized(results: DataFrame) -> DataFrame:
    """Lower-cased status ('' when missing), trimmed message, execution time
    rounded to 2 places (0 when missing)."""
    cols = results.columns
    exec_time = F.col("execution_time") if "execution_time" in cols else F.lit(None).cast("double")
    return results.select(
        "unique_id",
        F.lower(F.coalesce(F.col("status"), F.lit(""))).alias("status"),
        F.trim(F.coalesce(F.col("message"), F.lit(""))).alias("message"),
        F.round(F.coalesce(exec_time, F.lit(0.0)), 2).alias("execution_time"),
    )


def status_counts(results: DataFrame) -> DataFrame:
    """Histogram of statuses, ordered by status."""
    return (normalized(results).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("status"))


def for_alert(message: str) -> Column:
    """The first 500 characters of a message."""
    return F.substring(message, 1, ALERT_MESSAGE_MAX_CHARS)


def failures(results: DataFrame) -> DataFrame:
    """Failed results with the whole ``message`` and its shortened form for an alert."""
    return (normalized(results).where(F.col("status").isin(*FAILURE_STATUSES))
            .withColumn("alert_message", for_alert("message")))


def alert(results: DataFrame, invocation_id: str = "unknown", top_n: int = ALERT_TOP_N) -> DataFrame:
    """One row: ``failed`` (count), ``text`` (the alert; NULL when nothing failed).

    Text: a title line with the status counts, one numbered line for each of the
    first ``top_n`` failures in id order, and how many are not listed beyond them.
    """
    norm = normalized(results)
    hist = (norm.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit("count").alias("kind"), "status", "n",
                    F.lit(None).cast("int").alias("_rk"), F.lit(None).cast("string").alias("line")))
    fails = norm.where(F.col("status").isin(*FAILURE_STATUSES))
    # ``_rk <= N`` over a global row_number is planned as a top-N: a partial
    # limit in every task, so at most N rows per task reach the final sort.
    ranked = fails.withColumn("_rk", F.row_number().over(Window.orderBy("unique_id")))
    top = ranked.where(F.col("_rk") <= top_n).select(
        F.lit("line").alias("kind"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("bigint").alias("n"), "_rk",
        F.format_string("%d) [%s] %s: %s", F.col("_rk"), F.upper("status"), F.col("unique_id"), for_alert("message")).alias("line"))
    # One final aggregate over at most (#statuses + N) rows.
    is_count = F.col("kind") == "count"
    counts = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(is_count, F.struct("status", "n")))),
                                      lambda x: F.format_string("%s=%d", x["status"], x["n"])), ", ")
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~is_count, F.struct("_rk", "line")))),
                                     lambda x: x["line"]), "\n")
    failed = F.coalesce(F.sum(F.when(is_count & F.col("status").isin(*FAILURE_STATUSES), F.col("n"))),
                        F.lit(0).cast("bigint"))
    j = hist.unionByName(top).agg(failed.alias("failed"), counts.alias("counts"), lines.alias("lines"))
    more = F.when(F.col("failed") > top_n, F.format_string("\nnot listed: %d", F.col("failed") - top_n)) \
        .otherwise(F.lit(""))
    text = F.concat(F.col("failed").cast("string"), F.lit(f" checks need attention in run {invocation_id}; by status: "),
                    F.col("counts"), F.lit("\n"), F.col("lines"), more)
    return j.select("failed", F.when(F.col("failed") > 0, text).alias("text"))


def exit_code(results: DataFrame) -> int:
    """1 when any check failed, else 0 (the summary's process exit status)."""
    return 1 if failures(results).limit(1).count() > 0 else 0
