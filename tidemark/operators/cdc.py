"""Change-data-capture operators.

The ordering rule is one comparator for every path: the last change of a key
under ``(ts_ms, lsn)`` decides its state; if that change is a delete the key is
gone. Compacting a batch, merging it into stored state and replaying a batch
that was merged before all apply that rule, so the merge is idempotent and
insensitive to batch boundaries and to the order batches arrive in.

Stored state keeps delete markers (``_cdc_deleted = true``) so a late, older
upsert cannot bring a deleted key back; ``published`` drops them.

There is no table format here (no MERGE on Parquet), so a merge is a pure
DataFrame function ``state, changes -> state``: the batch is compacted to one
row per key with ``row_number() = 1`` -- planned with a partial per-map-task
limit before the shuffle (see ``dedupe``), so a key with very many changes
never lands whole in one task -- and then meets the state in a one-to-one
join on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedupe import latest_per_key
from tidemark.schemas import CDC_OPS

OP, TS, LSN, DELETED, REASON = "_cdc_op", "_cdc_ts_ms", "_cdc_lsn", "_cdc_deleted", "_reject_reason"


# ---------------------------------------------------------------------------
# decode and validate
# ---------------------------------------------------------------------------

def decode_topic_records(records: DataFrame, envelope_schema: T.StructType) -> DataFrame:
    """Topic records (``topic``, ``value`` JSON text, ...) to envelopes.

    Tombstones (NULL value, sent after a delete) are skipped; the entity name is
    the last dot-separated part of the topic. Unparsable values keep a NULL
    envelope and are quarantined by ``split_valid``.
    """
    r = with_envelope(records.where(F.col("value").isNotNull()), F.col("value"), envelope_schema, "_env")
    cols = [c for c in records.columns if c != "value"]
    return r.select(*cols, entity_of("topic").alias("table"), "_env", F.col("value").alias("_raw"))


def entity_of(topic: str) -> Column:
    """The entity of a topic: its last dot-separated part."""
    return F.element_at(F.split(F.col(topic), r"\."), -1)


def with_envelope(records: DataFrame, value: Column, envelope_schema: T.StructType, name: str) -> DataFrame:
    """``records`` and, as column ``name``, the envelope in the JSON text ``value``; NULL if it is none."""
    parsed = with_parsed(records, {name: (value, envelope_schema)}, "_parsed")
    env = F.col("_parsed")[name]
    return parsed.withColumn(name, F.when(~unread(env), env.dropFields("_bad"))).drop("_parsed")


def with_parsed(records: DataFrame, envelopes: dict[str, tuple[Column, T.StructType]], name: str) -> DataFrame:
    """``records`` and, as struct column ``name``, an envelope for each of ``envelopes`` (field: JSON text and
    schema). ``unread`` tells those that are none; their fields mean nothing.

    A generator of one row parses each text once. As a plain expression the parse would be
    repeated for every field and in every filter that looks at the envelope. All texts of a record
    share one generator, as each writes the whole record anew.
    """
    # PERMISSIVE gives a struct of NULLs for bad JSON; the extra field tells it from a real one.
    wholes = [F.from_json(value, T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]),
                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias(field)
              for field, (value, schema) in envelopes.items()]
    return records.select("*", F.explode(F.array(F.struct(*wholes))).alias(name))


def unread(env: Column) -> Column:
    """Whether the text of an envelope of ``with_parsed`` is no envelope."""
    return env.isNull() | env["_bad"].isNotNull()


def reject_reason(key: str, op: Column, before: Column, after: Column) -> Column:
    """Why a change cannot be applied (NULL when it can)."""
    key_of = F.coalesce(after.getField(key), before.getField(key))
    return (F.when(op.isNull(), F.lit("missing_op"))
            .when(~op.isin(*CDC_OPS), F.lit("unsupported_op"))
            .when((op != "d") & after.isNull(), F.lit("missing_after"))
            .when(key_of.isNull(), F.lit("missing_key")))


def tag_rejects(envelopes: DataFrame, key: str, env: str | None = None) -> DataFrame:
    """``envelopes`` with ``_reject_reason``, NULL for a change that can be applied.

    Accepted ops are c, u, r and d; NULL or other ops, a non-delete without an
    after-image, a change without a key and one without ``ts_ms`` are rejected
    rather than silently dropped, turned into all-NULL rows or ordered arbitrarily.
    """
    p = f"{env}." if env else ""
    op, before, after = F.col(f"{p}op"), F.col(f"{p}before"), F.col(f"{p}after")
    reason = reject_reason(key, op, before, after)
    fields = envelopes.schema[env].dataType.fieldNames() if env else envelopes.columns
    if "ts_ms" in fields:
        # A change without a commit time cannot be ordered against the others.
        reason = F.coalesce(reason, F.when(F.col(f"{p}ts_ms").isNull(), F.lit("missing_ts")))
    if "_corrupt_record" in envelopes.columns:
        reason = F.when(F.col("_corrupt_record").isNotNull(), F.lit("unparsable")).otherwise(reason)
    if env:
        reason = F.when(F.col(env).isNull(), F.lit("unparsable")).otherwise(reason)
    return envelopes.withColumn(REASON, reason)


def split_valid(envelopes: DataFrame, key: str, env: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) by ``tag_rejects``; quarantine rows carry ``_reject_reason``.

    Each output evaluates ``envelopes``: a job that writes both keeps them first.
    """
    tagged = tag_rejects(envelopes, key, env)
    return tagged.where(F.col(REASON).isNull()).drop(REASON), tagged.where(F.col(REASON).isNotNull())


def flatten(envelopes: DataFrame, key: str, image_cols: Sequence[str], env: str | None = None,
            lsn: str | None = "source.lsn", keep: Sequence[str] = ()) -> DataFrame:
    """Envelope to one flat change row: the after-image columns, the key (from
    the before-image for deletes), ``_cdc_op``, ``_cdc_ts_ms``, ``_cdc_lsn``,
    plus any ``keep`` columns of the input."""
    p = f"{env}." if env else ""
    cols = [F.col(c) for c in keep]
    cols += [F.coalesce(F.col(f"{p}after.{key}"), F.col(f"{p}before.{key}")).alias(key)]
    cols += [F.col(f"{p}after.{c}").alias(c) for c in image_cols if c != key]
    cols += [F.col(f"{p}op").alias(OP), F.col(f"{p}ts_ms").alias(TS),
             (F.col(f"{p}{lsn}") if lsn else F.lit(None).cast("long")).alias(LSN)]
    return envelopes.select(*cols)


def tag_casts(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """``df`` with each column of ``types`` cast as ``_cast_<column>`` and ``_reject_reason``
    (``bad_<column>``) where a non-NULL value does not parse."""
    out = df.withColumns({f"_cast_{name}": F.col(name).try_cast(dtype) for name, dtype in types.items()})
    reason = F.lit(None).cast("string")
    for name in types:
        bad = F.col(name).isNotNull() & F.col(f"_cast_{name}").isNull()
        reason = F.coalesce(reason, F.when(bad, F.lit(f"bad_{name}")))
    return out.withColumn(REASON, reason)


def cast_columns(df: DataFrame, types: dict[str, T.DataType]) -> tuple[DataFrame, DataFrame]:
    """``try_cast`` string payload columns; rows where a non-NULL value does not
    parse go to quarantine with ``_reject_reason = 'bad_<column>'`` (ANSI casts
    would fail the whole job on one bad value)."""
    out = tag_casts(df, types)
    good = out.where(F.col(REASON).isNull()).drop(REASON)
    for name in types:
        good = good.withColumn(name, F.col(f"_cast_{name}")).drop(f"_cast_{name}")
    bad = out.where(F.col(REASON).isNotNull()).drop(*[f"_cast_{n}" for n in types])
    return good, bad


# ---------------------------------------------------------------------------
# compaction and merges
# ---------------------------------------------------------------------------

def compact(changes: DataFrame, key: str, order: Sequence[str] = (TS, LSN)) -> DataFrame:
    """State of every key after a batch of flat changes: its last change under
    ``order``, with ``_cdc_deleted`` set when that change is a delete."""
    last = latest_per_key(changes, key, list(order))
    return last.withColumn(DELETED, F.col(OP) == "d")


def merge_changes(state: DataFrame | None, changes: DataFrame, key: str,
                  order: Sequence[str] = (TS, LSN)) -> DataFrame:
    """Ordered upsert-and-delete merge of a change batch into stored state.

    For every key the row that is last under ``order`` wins, whether it is in
    the state or in the batch; on an exact tie the batch wins (``s >= t``).
    First and later loads take the same path.

    Planned as the batch compacted to one row per key, then a one-to-one full
    outer join with the state on the key. When the state is a table bucketed
    on the key (``catalog.publish(..., cluster_by=(n, [key]))``), Spark reads
    it already partitioned and shuffles only the (small) batch; the merged
    output keeps that partitioning for the next write.
    """
    batch = compact(changes, key, order)
    if state is None:
        return batch
    cols = state.columns
    t = state.select(F.col(key), F.struct(*[F.col(c) for c in cols]).alias("_t"))
    s = batch.select(F.col(key).alias("_sk"), F.struct(*[F.col(c) for c in cols]).alias("_s"))
    j = t.join(s, t[key] == s["_sk"], "full_outer")
    s_order = F.struct(*[F.col(f"_s.{c}") for c in order])
    t_order = F.struct(*[F.col(f"_t.{c}") for c in order])
    winner = (F.when(F.col("_t").isNull(), F.col("_s"))
              .when(F.col("_s").isNull(), F.col("_t"))
              .when(s_order >= t_order, F.col("_s"))
              .otherwise(F.col("_t")))
    return j.select(winner.alias("_w")).select("_w.*")


def published(state: DataFrame) -> DataFrame:
    """The current-state table readers see: live keys, without delete markers."""
    return state.where(~F.col(DELETED)).drop(DELETED)


def without_key(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that ``insert_only_merge`` leaves out, with ``_reject_reason``."""
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return source.where(missing).withColumn(REASON, F.lit("missing_key"))


def insert_only_merge(target: DataFrame | None, source: DataFrame, key: Sequence[str],
                      first_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Insert rows whose key is new; rows already present stay as they are.

    The source is de-duplicated first (earliest under ``first_by`` wins), so a
    key seen twice in one load is inserted once. Returns ``(new_rows, table)``:
    appending ``new_rows`` to the stored table is the whole write, the target
    itself is never rewritten. The anti-join reads only the target's key
    columns. A row with a NULL in its key can never be found again and is not
    inserted: see ``without_key`` for those rows.
    """
    src = latest_per_key(source.dropna(subset=list(key)), list(key), list(first_by), descending=False)
    if target is None:
        return src, src
    new_rows = src.join(target.select(*key), list(key), "left_anti")
    return new_rows, target.unionByName(new_rows.select(*target.columns))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate feeds whose columns differ; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
