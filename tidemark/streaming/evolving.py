"""Changes whose fields are not all known beforehand.

The declared fields of the after-image become columns as elsewhere. Nothing else is
lost: the whole event is kept as a VARIANT, and the fields that are not declared, or
whose value does not fit the declared type, stand in ``_rescued``. The schema that
each micro-batch really had is written beside the checkpoint; ``observed_schema``
merges these, and ``widened`` turns what was rescued into columns by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc
from tidemark.sources.landing import cdc_path
from tidemark.streaming.jobs import held

PAYLOAD, RESCUED = "_payload", "_rescued"


def path(*names: str) -> str:
    """Variant path of nested fields with any names."""
    return "$" + "".join(f'["{n}"]' if "'" in n else f"['{n}']" for n in names)


def field(variant: str | Column, names: tuple[str, ...], dtype: T.DataType | str) -> Column:
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, path(*names),
                             dtype if isinstance(dtype, str) else dtype.simpleString())


def evolving_rows(lines: DataFrame, declared: T.StructType, key: str, value: str = "value") -> DataFrame:
    """Change rows of JSON lines: declared fields, op, ts, lsn, ``_payload``, ``_rescued`` and the reject reason.

    Deletes have the key and NULLs, as their after-image is absent.
    """
    event = lines.select(F.try_parse_json(value).alias(PAYLOAD), F.col(value).alias("_line"))
    event = event.withColumn("_after", field(PAYLOAD, ("after",), "map<string,variant>"))
    key_type = declared[key].dataType
    images = {}
    for image in ("before", "after"):
        there = field(PAYLOAD, (image,), "map<string,variant>").isNotNull()
        images[image] = F.when(there, F.struct(field(PAYLOAD, (image, key), key_type).alias(key)))
    op, ts = field(PAYLOAD, ("op",), "string"), field(PAYLOAD, ("ts_ms",), "bigint")
    reason = F.when(F.col(PAYLOAD).isNull(), F.lit("unparsable")).otherwise(F.coalesce(
        cdc.reject_reason(key, op, images["before"], images["after"]), F.when(ts.isNull(), F.lit("missing_ts"))))

    def left_over(name: Column, found: Column) -> Column:
        """Not declared, or declared with a type that the value cannot take."""
        odd = ~name.isin(*declared.fieldNames())
        for f in declared.fields:
            odd = odd | ((name == f.name) & F.try_variant_get(found, "$", f.dataType.simpleString()).isNull()
                         & ~F.is_variant_null(found))
        return odd

    rest = F.map_filter("_after", left_over)
    columns = [F.coalesce(images["after"][key], images["before"][key]).alias(key)]
    columns += [field(PAYLOAD, ("after", f.name), f.dataType).alias(f.name) for f in declared.fields if f.name != key]
    return event.select(*columns, op.alias(cdc.OP), ts.alias(cdc.TS), field(PAYLOAD, ("source", "lsn"), "bigint").alias(cdc.LSN),
                        PAYLOAD, F.when(F.size(rest) > 0, F.parse_json(F.to_json(rest))).alias(RESCUED), "_line",
                        reason.alias(cdc.REASON))


def evolving_batch(sink_path: str, rejects_path: str, schema_path: str):
    """``foreachBatch`` function: rows, rejects and the observed schema of one micro-batch, a folder each."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        with held(batch) as rows:
            good = rows.where(F.col(cdc.REASON).isNull()).drop(cdc.REASON, "_line")
            rows.where(F.col(cdc.REASON).isNotNull()).select(F.col("_line").alias("change"), cdc.REASON).write.mode(
                "overwrite").parquet(f"{rejects_path}/batch={batch_id}")
            good.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")
            after = F.try_variant_get(PAYLOAD, path("after"), "variant")
            good.where(F.col(cdc.OP) != "d").agg(F.schema_of_variant_agg(after).alias("observed")).write.mode(
                "overwrite").parquet(f"{schema_path}/batch={batch_id}")
    return apply


def evolving_job(spark: SparkSession, root: str, table: str, declared: T.StructType, key: str, sink_path: str,
                 checkpoint: str, rejects_path: str, max_files_per_trigger: int | None = None) -> DataFrame | None:
    """Append the landed files not seen yet; returns all rows so far, the fields seen so far as columns."""
    reader = spark.readStream.schema("value string, dt date")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    schema_path = f"{checkpoint}-schema"
    query = (evolving_rows(reader.text(cdc_path(root, table)), declared, key).writeStream
             .foreachBatch(evolving_batch(sink_path, rejects_path, schema_path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return widened(spark.read.parquet(sink_path), observed_schema(spark, schema_path), declared)


def merged(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both; VARIANT if no other does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        types = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            types[f.name] = merged(types[f.name], f.dataType) if f.name in types else f.dataType
        return T.StructType([T.StructField(n, t) for n, t in sorted(types.items())])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged(a.elementType, b.elementType))
    numbers = (T.LongType, T.DecimalType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType()
    return T.VariantType()


def observed_schema(spark: SparkSession, schema_path: str) -> T.StructType:
    """The after-image's fields and types over all micro-batches: one short text a batch, equal ones read once."""
    whole: T.DataType = T.StructType([])
    for row in spark.read.parquet(schema_path).select("observed").distinct().collect():
        # An all-empty batch observes VOID.
        if row["observed"] and row["observed"].startswith("OBJECT<"):
            whole = merged(whole, T.DataType.fromDDL(row["observed"].replace("OBJECT<", "STRUCT<")))
    return whole


def _holds(dtype: T.DataType, kind: type) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds(f.dataType, kind) for f in dtype.fields)
    return _holds(dtype.elementType, kind) if isinstance(dtype, T.ArrayType) else isinstance(dtype, kind)


def widened(rows: DataFrame, observed: T.StructType, declared: T.StructType) -> DataFrame:
    """``rows`` with a column for every observed field that is not declared, of its observed type
    (VARIANT where types differ, or none is known), and a column ``<name>_rescued`` (VARIANT) for every
    declared field: the value that did not fit."""
    taken = {c.lower() for c in rows.columns}
    extra = []
    for f in observed.fields:
        known = f.name in declared.fieldNames()
        name = f"{f.name}_rescued" if known else f.name
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        plain = not known and not _holds(f.dataType, T.VariantType) and not _holds(f.dataType, T.NullType)
        extra.append(field(RESCUED, (f.name,), f.dataType if plain else "variant").alias(name))
    return rows.select("*", *extra)
