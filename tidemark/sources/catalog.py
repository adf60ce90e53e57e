"""Catalog and materialization.

Staging models stay lazy (views); marts are written as tables. A table that
is being replaced is never overwritten in place while it is read: the new
content goes to a fresh table, and the published name, a view, is then pointed at
it in one catalog call, so that the name is never missing. Where a table format
with MERGE is installed, the ordered merge in ``operators.cdc`` is the source
of the rows either way.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target


# Properties of a published view: the table it shows and the one it showed before.
CONTENT, BEFORE = "content.table", "content.before"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def job_database(spark: SparkSession, name: str) -> str:
    """A database for one job's tables below the shared checkpoint folder."""
    from tidemark.session import checkpoint_root
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    ensure_database(spark, database, f"{checkpoint_root(spark)}/{database}")
    return database


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def content_table(spark: SparkSession, name: str) -> str | None:
    """The table that the published ``name`` shows; None if nothing was published."""
    return properties(spark, name).get(CONTENT)


def drop_unused(spark: SparkSession, name: str, used: set[str]) -> None:
    """Drop the tables written for the published ``name`` that nothing shows any more, those of a
    run that died before it took the name included. Such tables are called ``<name>__<8 hex digits>``,
    with ``base_`` or ``changes_`` before the digits for a state."""
    database, _, short = name.rpartition(".")
    written = re.compile(re.escape(short.lower()) + r"__((base|changes)_)?[0-9a-f]{8}")
    places = {t.rpartition(".")[2].lower() for t in used}
    for row in spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{short}__*'").where("not isTemporary").collect():
        table = row["tableName"].lower()
        if written.fullmatch(table) and table not in places:
            spark.sql(f"DROP TABLE IF EXISTS {f'{database}.' if database else ''}{table}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Staging materialization: a temporary view, nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def publish(spark: SparkSession, df: DataFrame, name: str, partition_by: list[str] | None = None,
            cluster_by: tuple[int, list[str]] | None = None) -> int:
    """Write ``df`` as the content of ``name`` (creating or replacing it) and return the
    number of rows written (from the file footers, no second run of the plan).

    ``cluster_by=(n, keys)`` buckets the table by ``keys`` so later joins and
    merges on those keys read it without a shuffle.
    """
    old = properties(spark, name)
    content = f"{name}__{uuid.uuid4().hex[:8]}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if cluster_by:
        writer = writer.bucketBy(cluster_by[0], *cluster_by[1]).sortBy(*cluster_by[1])
    writer.saveAsTable(content)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{CONTENT}' = '{content}', "
              f"'{BEFORE}' = '{old.get(CONTENT, '')}') AS SELECT * FROM {content}")
    # The content before stays for readers that still use it; the one before that goes.
    drop_unused(spark, name, {content, old.get(CONTENT, "")})
    return spark.table(content).count()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read
    it back: later branches that use it read the files instead of recomputing
    the plan, and the lineage ends there (a lost executor costs a re-read)."""
    from tidemark.session import scratch_dir
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_all(spark: SparkSession, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``materialize`` of several frames that do not depend on each other, as jobs side by side:
    a small one does not leave the cluster idle until the next."""
    if not frames:
        return {}
    with ThreadPoolExecutor(max_workers=min(8, len(frames))) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(materialize), spark, df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in jobs.items()}
