"""Check-result files: ``{metadata: {invocation_id}, results: [...]}``.

A missing file means there is nothing to check: the scan returns an empty
frame with the result schema, and the summary reports no failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import CHECK_RESULT, RUN_RESULTS
from tidemark.sources.landing import _exists


def read_run_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per result: ``invocation_id, unique_id, status, message, execution_time``.

    A file holds one document, or with ``lines`` one on each line."""
    cols = "invocation_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CHECK_RESULT)
    if not _exists(spark, path):
        return spark.createDataFrame([], cols)
    raw = spark.read.schema(RUN_RESULTS).option("multiLine", not lines).json(path)
    return raw.select(F.coalesce(F.col("metadata.invocation_id"), F.lit("unknown")).alias("invocation_id"),
                      F.explode_outer("results").alias("r")) \
              .where(F.col("r").isNotNull()).select("invocation_id", "r.*")


def results_from_checks(checks: DataFrame, invocation_id: str) -> DataFrame:
    """Check results of ``run_checks`` shaped like a scanned result file."""
    return checks.select(F.lit(invocation_id).alias("invocation_id"), "unique_id", "status", "message",
                         F.lit(None).cast("double").alias("execution_time"))


def write_run_results(results: DataFrame, path: str, invocation_id: str) -> None:
    """Write check results as run-results documents of one result a line, in as
    many files as ``results`` has partitions; ``read_run_results(lines=True)`` reads them."""
    spent = (F.col("execution_time") if "execution_time" in results.columns
             else F.lit(None).cast("double")).alias("execution_time")
    one = F.array(F.struct("unique_id", "status", "message", spent)).alias("results")
    doc = results.select(F.struct(F.lit(invocation_id).alias("invocation_id")).alias("metadata"), one)
    doc.write.mode("overwrite").json(path)
