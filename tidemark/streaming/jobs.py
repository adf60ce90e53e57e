"""Structured Streaming jobs over the landing zone.

* ``change_stream``: incremental file source of landed envelopes with a fixed
  schema (``maxFilesPerTrigger`` bounds one micro-batch).
* ``append_job``: the bronze append log -- flattened non-delete images plus
  ``_cdc_op``, ``_cdc_ts_ms`` and ``_stream_ingested_at`` -- appended with a
  checkpoint, run to completion with ``availableNow``.
* ``upsert_job``: ``foreachBatch`` applying the ordered merge of
  ``operators.cdc`` to a current-state table, so the stream sees deletes.

Both read a micro-batch once and write what they cannot apply, with the reason, to
a rejects folder that every job must name.

Progress lives in the checkpoint: a re-run processes only files it has not
seen. The file source does not re-read a file that grows after it was seen,
which is why the landing sink only publishes complete files.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc
from tidemark.session import checkpoint_root
from tidemark.sources.landing import cdc_path
from tidemark.sources.state import STATE_BUCKETS, merge_into_table, read_state, state_tables


def change_stream(spark: SparkSession, root: str, table: str, envelope_schema: T.StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed envelopes of one table as a stream (``<root>/table=<t>/dt=...``).

    The source is the table's own folder, so only ``dt`` is a partition column
    and ``table`` is the folder's name."""
    schema = T.StructType([f for f in envelope_schema.fields if f.name not in ("table", "dt")]
                          + [T.StructField("dt", T.DateType()), T.StructField("_corrupt_record", T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(cdc_path(root, table)).withColumn("table", F.lit(table))


def append_rows(changes: DataFrame, key: str, image_cols: Sequence[str]) -> DataFrame:
    """Stateless projection: after-image columns, op, ts, ingestion time; deletes are
    left to the upsert path. Changes that cannot be applied (``cdc.split_valid``) do
    not become rows; ``rejected_rows`` has them."""
    valid, _ = cdc.split_valid(changes, key)
    return (valid.where(F.col("op") != "d")
            .select(*[F.col(f"after.{c}").alias(c) for c in image_cols],
                    F.col("op").alias(cdc.OP), F.col("ts_ms").alias(cdc.TS),
                    F.col("source.lsn").alias(cdc.LSN),
                    F.current_timestamp().alias("_stream_ingested_at")))


def rejected_rows(changes: DataFrame, key: str) -> DataFrame:
    """What ``append_rows`` leaves out, as JSON text with its reason."""
    _, rejects = cdc.split_valid(changes, key)
    return as_text(rejects)


def as_text(rejects: DataFrame) -> DataFrame:
    """Rejected changes of any columns as JSON text (``change``) with their reason."""
    body = [c for c in rejects.columns if c != cdc.REASON]
    return rejects.select(F.to_json(F.struct(*body)).alias("change"), cdc.REASON)


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet") -> dict | None:
    """Append everything available now, then stop; returns the last progress."""
    q = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    return q.lastProgress


@contextmanager
def held(batch: DataFrame) -> Iterator[DataFrame]:
    """The micro-batch, read and parsed once for all that is done with it. It is kept on the executors'
    disks: a batch may be of any size, their memory is not."""
    kept = batch.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


# Rows of a staged file, and so of a task that reads it: about 40 MB of a sort's memory.
STAGED_ROWS = 125_000


# Changes are almost all unlike: no dictionary (a column of a file would go through one to find that out), a compact codec.
CHANGES_FORMAT = {"compression": "zstd", "parquet.enable.dictionary": "false"}


@contextmanager
def staged(rows: DataFrame, path: str, by: str | None = None) -> Iterator[DataFrame]:
    """Decoded rows of a micro-batch, written to ``path`` (shared storage) and read back from there for all
    that is done with them: columns that a reader does not want are not read, and no executor holds a row.
    The next micro-batch of the job overwrites them.

    A file has at most ``STAGED_ROWS`` rows and a task reads one file. Splits by bytes would not bound a task:
    such rows take many times their compressed size where they are sorted. With ``by``, a column of few
    values, each value has its own files, and who wants one opens no other. Within the block only."""
    spark, cost, writers = rows.sparkSession, "spark.sql.files.openCostInBytes", "spark.sql.maxConcurrentOutputFileWriters"
    usual = {name: spark.conf.get(name) for name in (cost, writers)}
    try:
        writer = rows.write.mode("overwrite").options(**CHANGES_FORMAT).option("maxRecordsPerFile", STAGED_ROWS)
        # So many files open at once, and the rows need not be sorted by the column first.
        spark.conf.set(writers, 8)
        (writer.partitionBy(by) if by else writer).parquet(path)
        # Opening a file counts as a whole split, so that no two files share one.
        spark.conf.set(cost, spark.conf.get("spark.sql.files.maxPartitionBytes"))
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def append_batch(key: str, image_cols: Sequence[str], sink_path: str, rejects_path: str):
    """``foreachBatch`` function: the rows and the rejects of one micro-batch, each to a folder
    of the batch, which a replay overwrites."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        with held(batch) as changes:
            rejected_rows(changes, key).write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
            append_rows(changes, key, image_cols).write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")
    return apply


def append_job(spark: SparkSession, root: str, table: str, envelope_schema: T.StructType, key: str,
               image_cols: Sequence[str], sink_path: str, checkpoint: str, rejects_path: str,
               dedupe_within: str | None = None) -> dict | None:
    """Append the changes that arrived to ``sink_path``, one folder ``batch=<n>`` a micro-batch, and what
    cannot be applied to ``rejects_path``. Each file is read once. A sink belongs to one checkpoint.

    With ``dedupe_within`` the stream itself drops repeated events before they are
    appended; rejected changes, which have no instant to compare, pass beside it
    (the source is then scanned for each of the two)."""
    stream = change_stream(spark, root, table, envelope_schema)
    if dedupe_within:
        valid, rejected = cdc.split_valid(stream, key)
        repeated = [f"_dedupe_{n}" for n in ("key", "ts", "lsn")]
        once = (valid.withColumns(dict(zip(repeated, (F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")), F.col("ts_ms"),
                                                      F.col("source.lsn")))))
                .withColumn("_event_time", F.timestamp_millis(F.col("ts_ms"))).withWatermark("_event_time", dedupe_within)
                .dropDuplicatesWithinWatermark(repeated))
        stream = once.select(*stream.columns).unionByName(rejected.select(*stream.columns))
    query = (stream.writeStream.foreachBatch(append_batch(key, image_cols, sink_path, rejects_path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query.lastProgress


def applied_or_rejected(changes: DataFrame, key: str, image_cols: Sequence[str],
                        types: dict[str, T.DataType]) -> DataFrame:
    """Envelopes, each decided once: ``_row`` (flat and cast) where it can be applied, else ``change``
    (JSON text) and the reason."""
    tagged = cdc.tag_rejects(changes, key).select(F.struct(*changes.columns).alias("_change"), F.col(cdc.REASON).alias("_why"))
    flat = cdc.flatten(tagged, key, image_cols, env="_change", keep=["_change", "_why"])
    names = [c for c in flat.columns if c not in ("_change", "_why")]
    cast = cdc.tag_casts(flat, types)
    row = F.struct(*[F.col(f"_cast_{c}" if c in types else c).alias(c) for c in names])
    rejected, unread = F.col("_why").isNotNull(), F.col(cdc.REASON).isNotNull()
    return cast.select(F.when(~rejected & ~unread, row).alias("_row"),
                       F.when(rejected, F.to_json("_change")).when(unread, F.to_json(F.struct(*names))).alias("change"),
                       F.coalesce("_why", cdc.REASON).alias(cdc.REASON))


def upsert_batch(name: str, key: str, image_cols: Sequence[str], rejects_path: str, buckets: int = STATE_BUCKETS,
                 types: dict[str, T.DataType] | None = None):
    """``foreachBatch`` function: validate, flatten, cast and merge one micro-batch
    into the state ``name``.

    ``types`` names the image columns that travel as text and their types. What
    cannot be applied goes to ``rejects_path``, one folder a micro-batch, which a
    replay overwrites; the decoded rows of the last batch stay beside it, in
    ``<rejects_path>_staged``."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        decided = applied_or_rejected(batch, key, image_cols, types or {})
        with staged(decided, f"{rejects_path.rstrip('/')}_staged") as rows:
            rejects = rows.where(F.col(cdc.REASON).isNotNull()).select("change", cdc.REASON)
            rejects.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
            changes = rows.where(F.col(cdc.REASON).isNull()).select("_row.*")
            count = changes.count()
            if count:
                merge_into_table(batch.sparkSession, name, changes, key, buckets, False, count)
    return apply


def upsert_job(spark: SparkSession, root: str, table: str, envelope_schema: T.StructType, key: str,
               image_cols: Sequence[str], name: str, checkpoint: str, rejects_path: str, buckets: int = STATE_BUCKETS,
               types: dict[str, T.DataType] | None = None, max_files_per_trigger: int | None = None) -> DataFrame | None:
    """Merge the landed files not seen yet into the state ``name``, then stop.

    The checkpoint is the bookmark: a run reads only files that no run before it
    read, whatever their date. Returns the state, None if no change ever came."""
    stream = change_stream(spark, root, table, envelope_schema, max_files_per_trigger)
    q = (stream.writeStream.foreachBatch(upsert_batch(name, key, image_cols, rejects_path, buckets, types))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_state(spark, name) if state_tables(spark, name) else None


def job_folder(spark: SparkSession, name: str) -> str:
    """A folder for a job's sink and checkpoint below the shared checkpoint root."""
    import uuid
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
