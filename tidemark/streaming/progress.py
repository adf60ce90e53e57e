"""How many rows a running stream has read, taken and put aside.

``counted`` observes a stream's rows, and ``ProgressLog``, a query listener, writes
one row a micro-batch to a table as the stream goes. ``recentProgress`` of a query
forgets all but the last batches; the table does not, and outlives the query.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "rows"
SCHEMA = ("query_id string, batch_id long, at string, read long, total long, accepted long, rejected long")


def counted(stream: DataFrame, rejected: Column) -> DataFrame:
    """``stream`` with its rows, and those for which ``rejected`` holds, observed in every micro-batch."""
    return stream.observe(OBSERVED, F.count(F.lit(1)).alias("total"), F.count_if(~rejected).alias("accepted"),
                          F.count_if(rejected).alias("rejected"))


class ProgressLog(StreamingQueryListener):
    """Appends the counts of every micro-batch of the session's ``counted`` streams to the Parquet table ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.written, self.news = set(), threading.Condition()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        told = p.observedMetrics.get(OBSERVED)
        try:
            if told is not None and told["total"] is not None:
                row = (str(p.id), p.batchId, p.timestamp, p.numInputRows, told["total"], told["accepted"], told["rejected"])
                self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as e:  # noqa: BLE001 -- raised where the log is waited for, not in the listener's thread
            self.failure = e
        with self.news:
            self.written.add((str(p.id), p.batchId))
            self.news.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, query, seconds: float = 120) -> None:
        """Until the counts of the last micro-batch that had rows are in the table."""
        busy = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
        if not busy:
            return
        key = (str(query.id), busy[-1])
        with self.news:
            if not self.news.wait_for(lambda: key in self.written, seconds):
                raise TimeoutError(f"no progress of batch {key[1]} after {seconds} s")
        if self.failure is not None:
            raise self.failure


@contextmanager
def progress_log(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """A ``ProgressLog`` for as long as the block runs."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """One row a query and micro-batch; a batch that was run again after a failure counts as last run."""
    logged = spark.read.schema(SCHEMA).parquet(path)
    last = logged.groupBy("query_id", "batch_id").agg(F.max(F.struct("at", "read", "total", "accepted", "rejected")).alias("r"))
    return last.select("query_id", "batch_id", "r.*")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Rows total, accepted and rejected of all micro-batches so far."""
    return batches(spark, path).agg(*[F.sum(c).alias(c) for c in ("total", "accepted", "rejected")])
