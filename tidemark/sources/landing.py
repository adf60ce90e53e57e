"""Raw landing zone: JSON Lines partitioned by entity and date (SURVEY A1, A2,
A6, A7, A8, A15; Q21, Q23).

Layout: ``<root>/table=<t>/dt=YYYY-MM-DD/part-*.json`` for change events and
``<root>/chain=<c>/dt=YYYY-MM-DD/part-*.json`` for the on-chain feed. Writers are
ordinary partitioned DataFrame writers (batch or streaming); readers always
pass a schema, so an entity whose events never carry a before-image still
types ``before`` as a struct. A folder that does not exist reads as an empty
frame with the schema instead of failing the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc

CORRUPT = "_corrupt_record"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def read_json(spark: SparkSession, path: str, schema: T.StructType,
              partition_cols: Sequence[tuple[str, T.DataType]] = (("dt", T.DateType()),),
              since_dt: str | None = None, base_path: str | None = None) -> DataFrame:
    """Scan landed JSON with a fixed schema; malformed lines keep their text in
    ``_corrupt_record``. ``since_dt`` prunes ``dt=`` folders older than it
    (partition pruning: the skipped folders are never listed for files).
    With ``base_path`` the partition folders between it and ``path`` (such as
    ``table=<t>``) become columns too."""
    full = T.StructType(list(_with_corrupt(schema).fields) + [T.StructField(n, t) for n, t in partition_cols])
    if not _exists(spark, path):
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if base_path:
        reader = reader.option("basePath", base_path)
    df = reader.json(path)
    if since_dt is not None and any(n == "dt" for n, _ in partition_cols):
        df = df.where(F.col("dt") >= F.lit(since_dt).cast("date"))
    return df


def cdc_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/table={table}"


def read_cdc(spark: SparkSession, root: str, table: str, envelope_schema: T.StructType,
             since_dt: str | None = None) -> DataFrame:
    """Every landed change envelope of one table (all ``dt`` partitions)."""
    data = T.StructType([f for f in envelope_schema.fields if f.name != "table"])
    return read_json(spark, cdc_path(root, table), data, since_dt=since_dt, base_path=root,
                     partition_cols=(("table", T.StringType()), ("dt", T.DateType())))


def read_onchain(spark: SparkSession, root: str, chains: Sequence[str], schema: T.StructType) -> DataFrame:
    """All landed on-chain rows of the given chains; a chain with no folder
    contributes nothing rather than failing the scan."""
    paths = [f"{root.rstrip('/')}/chain={c}" for c in chains]
    present = [p for p in paths if _exists(spark, p)]
    full = T.StructType(list(_with_corrupt(schema).fields)
                        + [T.StructField("chain", T.StringType()), T.StructField("dt", T.DateType())])
    if not present:
        return spark.createDataFrame([], full)
    return (spark.read.schema(full).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("basePath", root).json(present))


def onchain_stream(spark: SparkSession, root: str, chains: Sequence[str], schema: T.StructType) -> DataFrame:
    """``read_onchain`` as a stream of the files not read before."""
    full = T.StructType(list(_with_corrupt(schema).fields)
                        + [T.StructField("chain", T.StringType()), T.StructField("dt", T.DateType())])
    return (spark.readStream.schema(full).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("basePath", root)
            .json(f"{root.rstrip('/')}/chain={{{','.join(chains)}}}"))


def is_empty(df: DataFrame) -> bool:
    """Emptiness guard: one row is enough to decide (no full count)."""
    return df.isEmpty()


def landing_frame(envelopes: DataFrame, consumed_at: Column) -> DataFrame:
    """Stamp ``consumed_at`` (ISO-8601 text, UTC) and the ``dt`` partition
    derived from it: the date of *ingestion*, so each file lands under the day
    it was written."""
    stamped = envelopes.withColumn("consumed_at", F.date_format(consumed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return stamped.withColumn("dt", F.to_date(consumed_at).cast("string"))


def write_landing(df: DataFrame, root: str, partition_by: Sequence[str] = ("table", "dt"),
                  mode: str = "append") -> None:
    """Batch landing sink: JSON Lines partitioned by ``partition_by``.

    A ``rebalance`` on the partition columns first gives each folder few,
    well-sized files (AQE coalesces small partitions and splits a skewed one)
    instead of one small file per task and folder."""
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).json(root)


def stream_landing(stream: DataFrame, root: str, checkpoint: str, partition_by: Sequence[str] = ("table", "dt"),
                   available_now: bool = False, processing_time: str | None = None):
    """Streaming landing sink (file sink: exactly-once, only complete files are
    visible, so a reader never sees a file that is still growing). Returns the
    running query: a long-running consumer is stopped with ``query.stop()``;
    ``available_now`` drains what is there and stops by itself."""
    w = (stream.writeStream.format("json").partitionBy(*partition_by)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(root)


# The folder of records that could not be landed as changes.
REJECTED = "_rejected"


def envelopes_for_landing(decoded: DataFrame, env: str = "_env", ingested_at: Column | None = None) -> DataFrame:
    """Decoded topic records to the landed envelope: ``table`` from the topic,
    ``consumed_at`` the ingestion time, ``dt`` its date. The source's commit time
    stays in ``ts_ms``: a late commit lands in the folder of the day it arrives.

    Records tagged by ``cdc.tag_rejects`` land in one pass, good or not: a rejected one
    goes to the folder ``table=_rejected`` with its text and reason in place of the
    envelope (``read_rejected``)."""
    consumed = (F.current_timestamp() if ingested_at is None else ingested_at).cast("timestamp_ntz")
    fields = [f for f in decoded.schema[env].dataType.fieldNames() if f not in ("table", "consumed_at")]
    if cdc.REASON in decoded.columns:
        bad = F.col(cdc.REASON).isNotNull()
        body = decoded.select(F.when(bad, F.lit(REJECTED)).otherwise(F.col("table")).alias("table"),
                              *[F.when(~bad, F.col(f"{env}.{f}")).alias(f) for f in fields],
                              F.when(bad, F.col("table")).alias("_entity"), F.when(bad, F.col("_raw")).alias("_raw"),
                              cdc.REASON, consumed.alias("_consumed"))
    else:
        body = decoded.select("table", *[f"{env}.{f}" for f in fields], consumed.alias("_consumed"))
    return landing_frame(body, F.col("_consumed")).drop("_consumed")


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """What was landed as rejected: ``_entity``, ``_raw`` (the record's text), ``_reject_reason``, ``consumed_at``, ``dt``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("_entity", "_raw", cdc.REASON, "consumed_at")])
    return read_json(spark, cdc_path(root, REJECTED), schema)


def onchain_landing_frame(rows: DataFrame, chain: Column, ingested_at: Column, run_date: Column) -> DataFrame:
    """Stamp ``_ingested_at`` and ``_chain``; ``chain`` and ``dt`` (the date of
    the landing run) become folders."""
    return (rows.withColumn("_ingested_at", ingested_at.cast("timestamp_ntz"))
            .withColumn("_chain", chain).withColumn("chain", chain)
            .withColumn("dt", F.to_date(run_date).cast("string")))


def write_onchain_landing(df: DataFrame, root: str) -> None:
    write_landing(df, root, ("chain", "dt"))


# ---------------------------------------------------------------------------
# API response bodies
# ---------------------------------------------------------------------------

# Fixed names: the fields of one transaction in the API's account listing, all sent as text.
API_FIELDS = ["blockNumber", "blockHash", "timeStamp", "hash", "nonce", "transactionIndex", "from", "to", "value",
              "gas", "gasPrice", "input", "methodId", "functionName", "contractAddress", "cumulativeGasUsed",
              "txreceipt_status", "gasUsed", "confirmations", "isError"]
API_ITEM = T.StructType([T.StructField(f, T.StringType()) for f in API_FIELDS])
API_BODY = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("result", T.ArrayType(API_ITEM)),
])
NO_ROWS_MESSAGE = "No transactions found"


def flatten_api_bodies(bodies: DataFrame, body_col: str = "body",
                       item_schema: T.StructType = API_ITEM) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) from landed API bodies.

    A body is accepted when ``status = '1'`` or its message says there are no
    transactions, and ``result`` is a list; each accepted body becomes one row
    per result item (``explode`` is per body, so no body is ever gathered).
    Rejected bodies keep their status, message and a reason.
    """
    schema = T.StructType([API_BODY["status"], API_BODY["message"],
                           T.StructField("result", T.ArrayType(item_schema)),
                           T.StructField("_bad", T.StringType())])
    keep = [c for c in bodies.columns if c != body_col]
    # One parse: text that is no JSON gives the corrupt field alone, a field of another type only its own NULL.
    parsed = bodies.select(*keep, F.from_json(F.col(body_col), schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("_b"))
    nothing = F.coalesce(F.col("_b.status"), F.col("_b.message")).isNull() & F.col("_b.result").isNull()
    bad_json = F.col("_b._bad").isNotNull() & nothing
    ok_status = (F.col("_b.status") == "1") | (F.col("_b.message") == NO_ROWS_MESSAGE)
    reason = (F.when(F.col("_b").isNull() | bad_json, F.lit("unparsable"))
              .when(~ok_status | F.col("_b.status").isNull(), F.lit("api_error"))
              .when(F.col("_b.result").isNull(), F.lit("result_not_a_list")))
    tagged = parsed.withColumn("_reason", reason)
    rows = (tagged.where(F.col("_reason").isNull())
            .select(*keep, F.explode("_b.result").alias("_item")).select(*keep, "_item.*"))
    rejected = tagged.where(F.col("_reason").isNotNull()).select(
        *keep, F.col("_b.status").alias("status"), F.col("_b.message").alias("message"),
        F.col("_reason").alias("reason"))
    return rows, rejected


# ---------------------------------------------------------------------------
# message-broker source (adapter)
# ---------------------------------------------------------------------------

def topic_stream(spark: SparkSession, bootstrap_servers: str, topics: Sequence[str],
                 starting_offsets: str = "earliest") -> DataFrame:
    """Subscribe to change topics with the Kafka source: ``topic``, ``partition``,
    ``offset`` and ``value`` as text, ready for ``operators.cdc.decode_topic_records``.

    The source owns the offsets (in the query checkpoint), so a restarted query
    resumes where it stopped; stop it with ``query.stop()``. Needs the Kafka
    connector package on the classpath, which this environment does not have:
    the decode and landing steps are tested on frames with the same columns.
    """
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", ",".join(topics))
           .option("startingOffsets", starting_offsets).load())
    return raw.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
