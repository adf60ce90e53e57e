"""One subscription, several entities.

A micro-batch of change records is read, decoded and cast once, staged in shared storage,
and routed by entity: good rows to the entity's append log and into its state, the
rest to the rejects. Every sink is idempotent by batch: the log and the rejects are
folders of the batch, which a replay overwrites, and merging a change twice changes
nothing. So a batch that dies half-way and is run again leaves no loss and no repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import cdc
from tidemark.sources.state import STATE_BUCKETS, merge_into_table
from tidemark.streaming.jobs import CHANGES_FORMAT, staged
from tidemark.streaming.progress import counted

UNKNOWN = "unknown_entity"
# The entity whose sinks take a staged row; NULL for a rejected one.
TAKEN_BY = "_taken_by"


def change_row(env: Column, declared: T.StructType, key: str) -> Column:
    """Flat change row with the declared types of a decoded envelope; NULL where a text does not parse."""
    payload = schemas.as_json_payload(declared)
    after = env["after"]
    fields = [F.coalesce(after[key], env["before"][key]).alias(key)]
    for f in declared.fields:
        if f.name != key:
            value = after[f.name]
            fields.append((value.try_cast(f.dataType) if payload[f.name].dataType != f.dataType else value).alias(f.name))
    return F.struct(*fields, env["op"].alias(cdc.OP), env["ts_ms"].alias(cdc.TS), env["source"]["lsn"].alias(cdc.LSN))


def row_reason(env: Column, row: Column, declared: T.StructType, key: str) -> Column:
    """Why the envelope of ``cdc.with_parsed``, whose ``change_row`` is ``row``, cannot be applied; NULL when it can."""
    bad = F.lit(None).cast("string")
    for f in declared.fields:
        if f.name != key:
            bad = F.coalesce(bad, F.when(env["after"][f.name].isNotNull() & row[f.name].isNull(), F.lit(f"bad_{f.name}")))
    return (F.when(cdc.unread(env), F.lit("unparsable"))
            .otherwise(F.coalesce(cdc.reject_reason(key, env["op"], env["before"], env["after"]),
                                  F.when(env["ts_ms"].isNull(), F.lit("missing_ts")), bad)))


def decoded(records: DataFrame, entities: dict[str, T.StructType]) -> DataFrame:
    """``table``, ``value``, one struct column ``_<entity>`` each and the reject reason of records
    (``table``, ``value`` as JSON text). A record is parsed once, by its own entity's schema only;
    records without a value (tombstones after deletes) are skipped."""
    own, rows, reason = {e: F.col("table") == e for e in entities}, [], F.lit(UNKNOWN)
    parsed = cdc.with_parsed(records.where(F.col("value").isNotNull()).select("table", "value"), {
        e: (F.when(own[e], F.col("value")), schemas.envelope(schemas.as_json_payload(declared)))
        for e, declared in entities.items()}, "_parsed")
    for e, declared in entities.items():
        key, env = schemas.PRIMARY_KEYS[e], F.col("_parsed")[e]
        rows.append(F.when(own[e] & ~cdc.unread(env), change_row(env, declared, key)).alias(f"_{e}"))
        reason = F.when(own[e], row_reason(env, F.col(f"_{e}"), declared, key)).otherwise(reason)
    cast = parsed.select("*", *rows)
    return cast.select("table", "value", *[f"_{e}" for e in entities], reason.alias(cdc.REASON))


def route(entities: dict[str, T.StructType], database: str, folder: str, buckets: int):
    """``foreachBatch`` function over ``decoded`` records."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, good, bad = batch.sparkSession, F.col(cdc.REASON).isNull(), F.col(cdc.REASON).isNotNull()
        # A text is kept where it is rejected, its row where it is not; the rows of an entity are in files of their own.
        kept = batch.select("table", F.when(bad, F.col("value")).alias("value"),
                            *[F.when(good, F.col(f"_{e}")).alias(f"_{e}") for e in entities], cdc.REASON,
                            F.when(good, F.col("table")).alias(TAKEN_BY))
        with staged(kept, f"{folder}/staged", TAKEN_BY) as rows:
            rejected, taken = rows.where(F.col(TAKEN_BY).isNull()), rows.where(F.col(TAKEN_BY).isNotNull())
            rejected.select("table", "value", cdc.REASON).write.mode("overwrite").parquet(f"{folder}/rejects/batch={batch_id}")
            counts = {r[TAKEN_BY]: r["count"] for r in taken.groupBy(TAKEN_BY).count().collect()}
            for e in entities:
                if e not in counts:
                    continue
                changes = rows.where(F.col(TAKEN_BY) == e).select(f"_{e}.*")
                changes.write.mode("overwrite").options(**CHANGES_FORMAT).parquet(f"{folder}/log/table={e}/batch={batch_id}")
                merge_into_table(spark, f"{database}.{schemas.BRONZE_NAMES[e]}", changes, schemas.PRIMARY_KEYS[e], buckets, False, counts[e])
    return apply


def entities_job(spark: SparkSession, records: DataFrame, entities: dict[str, T.StructType], database: str, folder: str,
                 buckets: int = STATE_BUCKETS, processing_time: str | None = None):
    """Route a stream of change records (``table``, ``value``) of ``entities`` and return the query.

    ``folder`` (shared storage) takes the bookmark (``checkpoint``), the append logs
    (``log/table=<entity>``), the ``rejects`` and, ``staged``, the rows of the last batch; the states are ``<database>.cdc_<entity>``.
    Without ``processing_time`` the job takes what is there and stops.
    For a message broker, ``landing.topic_stream`` gives the records after
    ``cdc.entity_of`` has named the table.
    """
    stream = counted(decoded(records, entities), F.col(cdc.REASON).isNotNull())
    writer = stream.writeStream.foreachBatch(route(entities, database, folder, buckets)).option(
        "checkpointLocation", f"{folder}/checkpoint")
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
