"""The bronze batch jobs: landed
JSON -> current-state tables.

* ``merge_cdc_table``: every landed envelope of one entity (the whole landing
  folder, as each run of the source job reads it), validated, flattened and
  merged in order into the entity's state table. Re-running with nothing new
  yields the same state (the merge is idempotent under replay).
* ``merge_entity``: users, wallets or transactions from the landed changes that
  no run before has read into ``<database>.cdc_<entity>``, payload text cast to
  the entity's types, what cannot be applied kept apart.
* ``load_onchain``: newly landed on-chain rows of the given chains, skipped when
  empty, stamped with ``_loaded_at``, de-duplicated and appended where the
  ``(hash, _chain)`` key is new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import cdc
from tidemark.sources.landing import CORRUPT, _exists, is_empty, onchain_stream, read_cdc
from tidemark.sources.state import STATE_BUCKETS, bucket_count, merge_into_table


def merge_cdc_table(spark: SparkSession, raw_root: str, table: str, envelope_schema: T.StructType,
                    key: str, image_cols: Sequence[str], name: str, rejects_path: str,
                    buckets: int = STATE_BUCKETS) -> DataFrame:
    """One run of the CDC merge for ``table``; returns the state.

    The state keeps delete markers; ``cdc.published(state)`` is the table readers
    see. As every run reads all landed envelopes, ``rejects_path`` holds what the
    last one could not apply, and only changes that the state lacks are written.
    """
    from tidemark.streaming.jobs import as_text
    valid, rejected = cdc.split_valid(read_cdc(spark, raw_root, table, envelope_schema), key)
    as_text(rejected).write.mode("overwrite").parquet(rejects_path)
    rows = cdc.flatten(valid, key, image_cols)
    return merge_into_table(spark, name, rows, key, buckets, only_newer=True)


def merge_entity(spark: SparkSession, raw_root: str, entity: str, database: str, folder: str,
                 buckets: int = STATE_BUCKETS) -> DataFrame | None:
    """One run for an entity of ``schemas.ENTITIES``; returns its state (None before any change).

    ``folder`` (shared storage) holds the bookmark and, under ``rejects``, what
    could not be applied: JSON text and reason.
    """
    from tidemark.streaming.jobs import upsert_job
    declared, image = schemas.ENTITIES[entity], schemas.as_json_payload(schemas.ENTITIES[entity])
    types = {f.name: f.dataType for f in declared.fields if f.dataType != image[f.name].dataType}
    return upsert_job(spark, raw_root, entity, schemas.envelope(image), schemas.PRIMARY_KEYS[entity],
                      image.fieldNames(), f"{database}.{schemas.BRONZE_NAMES[entity]}", f"{folder}/checkpoint",
                      f"{folder}/rejects", buckets, types)


ONCHAIN_KEY = ["hash", "_chain"]


def new_onchain_rows(target: DataFrame, rows: DataFrame, chains: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """The rows of ``chains`` whose (hash, chain) the ``target`` lacks, one a key.

    The target is read for these chains and its keys only. Equal hashes meet bucket by
    bucket; the chain is compared as a range of one value, since as a second join key
    it would make Spark deal the bucketed side out anew.
    """
    first = cdc.insert_only_merge(None, rows, ONCHAIN_KEY, list(first_by))[0]
    held = target.where(F.col("_chain").isin(list(chains))).select(F.col("hash").alias("_held"), F.col("_chain").alias("_held_chain"))
    same = (first["hash"] == F.col("_held")) & (first["_chain"] >= F.col("_held_chain")) & (first["_chain"] <= F.col("_held_chain"))
    return first.join(held, same, "left_anti")


def load_onchain(spark: SparkSession, raw_root: str, chains: Sequence[str], schema: T.StructType,
                 target: str, loaded_at: Column, checkpoint: str, rejects: str,
                 first_by: Sequence[str] = ("_ingested_at",), buckets: int = STATE_BUCKETS) -> int:
    """Insert-only load of the landed on-chain files not read before into the
    catalog table ``target``; returns the number of rows appended. ``checkpoint``
    is the bookmark.

    The table is partitioned by chain and bucketed by hash (``buckets`` counts when
    the first load creates it). A load reads the key columns of its own chains only,
    bucket by bucket, and moves nothing but its own rows. Only new keys are written
    (an append), so a repeated micro-batch adds nothing; a feed with no rows is
    skipped without a write. Malformed lines and rows without a whole key are not
    loaded; they go to the folder ``rejects``, one folder a micro-batch.
    """
    from tidemark.streaming.jobs import held
    if not _exists(spark, raw_root):
        return 0
    appended = 0

    def insert(batch: DataFrame, batch_id: int) -> None:
        with held(batch) as raw:
            if not is_empty(raw):
                load(raw, batch_id)

    def load(raw: DataFrame, batch_id: int) -> None:
        nonlocal appended
        rows = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) \
            .withColumn("_loaded_at", loaded_at.cast("timestamp_ntz"))
        broken = raw.where(F.col(CORRUPT).isNotNull()).withColumn(cdc.REASON, F.lit("unparsable"))
        kept = cdc.union_all([cdc.without_key(rows, ONCHAIN_KEY), broken])
        kept.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        session = raw.sparkSession
        if session.catalog.tableExists(target):
            session.catalog.refreshTable(target)
            # At most one value a chain of the feed.
            present = [r[0] for r in rows.select("_chain").distinct().collect() if r[0] is not None]
            new_rows = new_onchain_rows(session.table(target), rows, present, first_by)
            stored = bucket_count(session, target)
            new_rows = new_rows.select(*session.table(target).columns)
        else:
            new_rows, _ = cdc.insert_only_merge(None, rows, ONCHAIN_KEY, list(first_by))
            stored = buckets
        with held(new_rows) as added:
            count = added.count()
            if count:
                (added.repartition(stored, "hash").write.format("parquet").mode("append").partitionBy("_chain")
                 .bucketBy(stored, "hash").sortBy("hash").saveAsTable(target))
        appended += count

    query = (onchain_stream(spark, raw_root, chains, schema).writeStream.foreachBatch(insert)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if spark.catalog.tableExists(target):
        spark.catalog.refreshTable(target)
    return appended
