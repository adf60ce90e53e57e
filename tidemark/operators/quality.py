"""Data-quality checks.

Checks are declared as data (``Check``) and run by ``run_checks`` into one
result DataFrame ``(unique_id, kind, model, column_name, failures, status,
message)``. All checks of one model share one pass: row-level checks
(``not_null``, ``accepted_values``, ``range``) are ``count_if`` aggregates and
key checks (``unique``, ``at_most_one``) a grouped count of keys with more than
one row, fused into a single group-by on the key (partial aggregation absorbs
a hot key). ``relationships`` is an anti-join of the child's non-NULL keys
against the parent's distinct keys.

As in the warehouse tests, NULLs pass ``unique``, ``accepted_values`` and
``relationships``; combine with ``not_null`` to forbid them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import epoch_micros
from tidemark.schemas import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS

RESULT_COLS = ["unique_id", "kind", "model", "column_name", "failures", "status", "message"]


@dataclass(frozen=True)
class Check:
    kind: str                       # not_null | unique | accepted_values | relationships | range | at_most_one
    model: str
    column: str
    values: tuple = ()              # accepted_values
    to: str | None = None           # relationships: parent model
    field: str | None = None        # relationships: parent column
    min_value: object = None        # range: failing when column < min_value
    where: str | None = None        # at_most_one: boolean column restricting the rows counted
    name: str | None = None         # explicit id (singular tests)

    @property
    def unique_id(self) -> str:
        if self.name:
            return self.name
        suffix = f"__{self.to}_{self.field}" if self.kind == "relationships" else ""
        return f"{self.kind}_{self.model}_{self.column}{suffix}"


def _row_condition(c: Check) -> Column:
    """True for a row the row-level check rejects."""
    col = F.col(c.column)
    if c.kind == "not_null":
        return col.isNull()
    if c.kind == "accepted_values":
        return col.isNotNull() & ~col.isin(*c.values)
    if c.kind == "range":
        return col.isNotNull() & (col < F.lit(c.min_value))
    raise ValueError(c.kind)


def _stack(wide: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = ", ".join(f"'{c.unique_id}', '{c.kind}', '{c.model}', '{c.column}', _f{i}"
                     for i, c in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {rows}) as (unique_id, kind, model, column_name, failures)")


def _model_pass(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Every row-level and key check of one model in one pass.

    With a key check on column K the model is grouped once by K (partial
    aggregation first, so a hot key is pre-counted in every map task): each
    group carries its row count and its per-check failure counts, and a final
    global aggregate turns them into one number per check. Without key checks
    it is one global aggregate.
    """
    row_cs = [c for c in checks if c.kind in ("not_null", "accepted_values", "range")]
    key_cs = [c for c in checks if c.kind in ("unique", "at_most_one")]
    if not key_cs:
        wide = df.agg(*[F.count_if(_row_condition(c)).alias(f"_f{i}") for i, c in enumerate(row_cs)])
        return _stack(wide, row_cs)
    key = key_cs[0].column
    group_aggs = [F.count_if(_row_condition(c)).alias(f"_g{i}") for i, c in enumerate(row_cs)]
    # An empty model has no groups to sum over: no failures.
    finals = [F.coalesce(F.sum(f"_g{i}"), F.lit(0)).cast("bigint").alias(f"_f{i}") for i in range(len(row_cs))]
    for j, c in enumerate(key_cs):
        counted = F.count_if(F.col(c.where)) if c.where else F.count(F.lit(1))
        group_aggs.append(counted.alias(f"_k{j}"))
        finals.append(F.count_if(F.col(key).isNotNull() & (F.col(f"_k{j}") > 1)).alias(f"_f{len(row_cs) + j}"))
    wide = df.groupBy(key).agg(*group_aggs).agg(*finals)
    return _stack(wide, row_cs + key_cs)


def _orphans(child: DataFrame, parent: DataFrame, c: Check) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent. The child is
    counted per key first (partial aggregation), so the anti-join sees one row
    per distinct key -- a hot key does not reach the join as a third of the
    table -- and the orphan count is the sum of the counts left over."""
    keys = parent.select(F.col(c.field).alias("_pk")).where(F.col("_pk").isNotNull()).distinct()
    kids = (child.select(F.col(c.column).alias("_fk")).where(F.col("_fk").isNotNull())
            .groupBy("_fk").agg(F.count(F.lit(1)).alias("_n")))
    orphans = kids.join(keys, kids["_fk"] == keys["_pk"], "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures")).select(
        F.lit(c.unique_id).alias("unique_id"), F.lit(c.kind).alias("kind"), F.lit(c.model).alias("model"),
        F.lit(c.column).alias("column_name"), "failures")


def run_checks(models: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All checks into one result frame: one pass per model for its row-level
    checks and the key checks on its first checked key column, one
    anti-join per relationship, one extra grouped pass per other key column."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind not in ("not_null", "accepted_values", "range", "unique", "at_most_one", "relationships"):
            raise ValueError(f"unknown check kind {c.kind!r}")
        if c.kind == "relationships":
            parts.append(_orphans(models[c.model], models[c.to], c))
        else:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        key_cols = list(dict.fromkeys(c.column for c in cs if c.kind in ("unique", "at_most_one")))
        first = [c for c in cs if c.kind not in ("unique", "at_most_one") or c.column == key_cols[0]] \
            if key_cols else cs
        parts.append(_model_pass(models[model], first))
        for k in key_cols[1:]:
            parts.append(_model_pass(models[model], [c for c in cs if c.kind in ("unique", "at_most_one")
                                                     and c.column == k]))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    failures = F.col("failures").cast("bigint")
    return counts.select(
        "unique_id", "kind", "model", "column_name", failures.alias("failures"),
        F.when(failures > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.when(failures > 0, F.format_string("Got %d results, configured to fail if != 0", failures))
        .otherwise(F.lit(None).cast("string")).alias("message"),
    )


def failing_rows(df: DataFrame, c: Check) -> DataFrame:
    """The rows a row-level check rejects (what a singular test returns)."""
    return df.where(_row_condition(c))


def freshness(sources: dict[str, tuple[DataFrame, str]], as_of: Column,
              warn_after_hours: float = FRESHNESS_WARN_HOURS,
              error_after_hours: float = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Per source: newest ``loaded_at`` value, its age at ``as_of`` and a status
    (``pass``, ``warn`` past ``warn_after_hours``, ``error`` past
    ``error_after_hours``; ``error`` also for a source with no rows).

    ``as_of`` is an argument, never the wall clock, so a run is reproducible.
    Each source costs one global max aggregate (partial max per task).
    """
    parts = []
    for name, (df, col) in sources.items():
        parts.append(df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("max_loaded_at"))
                     .select(F.lit(name).alias("source"), "max_loaded_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    age = ((epoch_micros(as_of.cast("timestamp_ntz")) - epoch_micros("max_loaded_at")) / 1_000_000).cast("double")
    out = out.withColumn("age_seconds", age)
    status = (F.when(F.col("age_seconds").isNull(), F.lit("error"))
              .when(F.col("age_seconds") > error_after_hours * 3600, F.lit("error"))
              .when(F.col("age_seconds") > warn_after_hours * 3600, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return out.withColumn("status", status)
