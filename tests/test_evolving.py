"""Undeclared and changing fields are kept and readable."""
import json

from pyspark.sql import types as T

from tidemark.operators import cdc
from tidemark.streaming import evolving

DECLARED = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("name", T.StringType())])


def line(after=None, op="c", ms=1, **more):
    return json.dumps({"op": op, "ts_ms": ms, "after": after, "source": {"lsn": 7}, **more})


def test_new_and_changed_fields_over_two_days(spark, tmp_dir):
    def arrive(day, lines):
        df = spark.createDataFrame([(x, "t", day) for x in lines], "value string, table string, dt string")
        df.write.mode("append").partitionBy("table", "dt").text(f"{tmp_dir}/land")
        return evolving.evolving_job(spark, f"{tmp_dir}/land", "t", DECLARED, "id", f"{tmp_dir}/rows", f"{tmp_dir}/checkpoint",
                                     f"{tmp_dir}/rejects", max_files_per_trigger=1)

    first = arrive("2024-01-01", [line({"id": 1, "v": 1.5, "name": "a"}), line({"id": 2, "v": None}), "{cut",
                                  line({"id": "x", "v": 1}), line(op="d", before={"id": 3})])
    assert first.columns[:3] == ["id", "v", "name"] and "k" not in first.columns
    assert {r["id"]: (r["v"], r[evolving.RESCUED]) for r in first.collect()} == {1: (1.5, None), 2: (None, None), 3: (None, None)}
    second = arrive("2024-01-02", [line({"id": 4, "v": "n/a", "k": 5, "deep": {"x": [1, 2]}}), line({"id": 5, "v": 2, "k": "five"}),
                                   line({"id": 6, "odd name": True, "v": {"low": 1}, "op": "own"})])
    rows = {r["id"]: r for r in second.selectExpr(
        "id", "v", "to_json(k) k", "deep", "to_json(v_rescued) v_rescued", "`odd name` odd", "op", "_cdc_op").collect()}
    assert len(rows) == 6
    assert (rows[4]["v"], rows[4]["k"], rows[4]["v_rescued"], rows[4]["deep"]["x"]) == (None, "5", '"n/a"', [1, 2])
    assert (rows[5]["v"], rows[5]["k"], rows[5]["v_rescued"]) == (2.0, '"five"', None)
    assert (rows[6]["odd"], rows[6]["v_rescued"], rows[6]["op"], rows[6]["_cdc_op"]) == (True, '{"low":1}', "own", "c")
    assert rows[1]["v"] == 1.5 and rows[1]["k"] is None
    observed = evolving.observed_schema(spark, f"{tmp_dir}/checkpoint-schema")
    assert isinstance(observed["k"].dataType, T.VariantType) and isinstance(observed["id"].dataType, T.LongType)
    kept = spark.read.parquet(f"{tmp_dir}/rejects").collect()
    assert sorted(r[cdc.REASON] for r in kept) == ["missing_key", "unparsable"]
    # Nothing new: nothing is added.
    again = evolving.evolving_job(spark, f"{tmp_dir}/land", "t", DECLARED, "id", f"{tmp_dir}/rows", f"{tmp_dir}/checkpoint", f"{tmp_dir}/rejects")
    assert again.count() == 6


def test_merged_types():
    s = lambda **f: T.StructType([T.StructField(n, t) for n, t in f.items()])
    long, text, none = T.LongType(), T.StringType(), T.NullType()
    assert evolving.merged(long, T.DecimalType(3, 1)) == T.DoubleType()
    assert evolving.merged(s(a=long), s(b=text)) == s(a=long, b=text)
    assert evolving.merged(T.ArrayType(none), T.ArrayType(long)) == T.ArrayType(long)
    assert isinstance(evolving.merged(long, text), T.VariantType)
    assert isinstance(evolving.merged(s(a=long), T.ArrayType(long)), T.VariantType)
