"""Governed metrics.

Semantic models and metrics are plain dataclasses: there is no YAML parsing and
no string references to resolve. ``metric_query`` compiles a request into one
``groupBy().agg()`` over the fact table: every metric of the request, filtered
ones included, is a (conditional) aggregate of the same scan, so Spark runs
one partial aggregation per map task and one final aggregation per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import trunc_ntz

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str            # "sum" | "count" | "average"
    expr: str           # column of the model's table


@dataclass(frozen=True)
class Dimension:
    name: str
    kind: str = "categorical"   # or "time"


@dataclass(frozen=True)
class SemanticModel:
    name: str
    primary_entity: str
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    default_time_dimension: str
    foreign_entities: tuple[str, ...] = ()

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(f"{self.name} has no measure {name!r}")

    def has_dimension(self, name: str) -> bool:
        return any(d.name == name for d in self.dimensions)


@dataclass(frozen=True)
class Equals:
    """Metric filter: ``dimension = value`` (the only form the metrics use)."""
    dimension: str
    value: object

    def column(self) -> Column:
        return F.col(self.dimension) == F.lit(self.value)


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str                         # "simple" | "ratio"
    measure: str | None = None
    filter: Equals | None = None
    numerator: str | None = None
    denominator: str | None = None
    model: str = "transactions"


# ---------------------------------------------------------------------------
# The two semantic models and five metrics of the source project.
# ---------------------------------------------------------------------------
TRANSACTIONS = SemanticModel(
    name="transactions",
    primary_entity="transaction_id",
    foreign_entities=("wallet_id", "user_id"),
    dimensions=(Dimension("submitted_date", "time"), Dimension("chain"), Dimension("status"),
                Dimension("direction"), Dimension("asset_symbol")),
    measures=(Measure("usd_value_at_tx", "sum", "usd_value_at_tx"),
              Measure("transaction_count", "count", "transaction_id"),
              Measure("confirmed_transaction_count", "count", "transaction_id"),
              Measure("confirmation_seconds", "average", "confirmation_seconds")),
    default_time_dimension="submitted_date",
)

USERS = SemanticModel(
    name="users",
    primary_entity="user_id",
    dimensions=(Dimension("user_created_at", "time"), Dimension("country_code"),
                Dimension("kyc_status"), Dimension("signup_channel")),
    measures=(Measure("wallet_count", "sum", "wallet_count"),),
    default_time_dimension="user_created_at",
)

METRICS = {m.name: m for m in [
    Metric("transaction_volume_usd", "simple", measure="usd_value_at_tx"),
    Metric("transaction_count", "simple", measure="transaction_count"),
    Metric("confirmed_transaction_count", "simple", measure="confirmed_transaction_count",
           filter=Equals("status", "confirmed")),
    Metric("confirmed_transaction_rate", "ratio", numerator="confirmed_transaction_count",
           denominator="transaction_count"),
    Metric("avg_confirmation_seconds", "simple", measure="confirmation_seconds"),
]}

MODELS = {m.name: m for m in (TRANSACTIONS, USERS)}
# What a request may name: the five metrics, and the users model's measure as a metric.
KNOWN = {**METRICS, "wallet_count": Metric("wallet_count", "simple", measure="wallet_count", model="users")}


@dataclass
class MetricRequest:
    """``fill`` and ``fill_span`` ask for a calendar without gaps, see ``fill_calendar``."""
    metrics: Sequence[str]
    group_by: Sequence[str] = ()
    grain: str = "day"
    where: Column | None = None
    fill: object | None = None
    spine: DataFrame | None = None
    fill_span: str = "group"


def _components(model: SemanticModel, metric: Metric) -> dict[str, tuple[str, Column]]:
    """Additive pieces of a simple metric: name -> (kind, per-row value).

    Every metric is assembled from sums and counts, so it can be aggregated in
    two phases (partials per entity, then per requested group) and still be
    exact: an average is a sum over a count.
    """
    m = model.measure(metric.measure)
    value = F.col(m.expr)
    if metric.filter is not None:
        value = F.when(metric.filter.column(), value)
    if m.agg == "sum":
        return {f"_s_{metric.name}": ("sum", value)}
    if m.agg == "count":
        return {f"_c_{metric.name}": ("count", value)}
    if m.agg == "average":
        return {f"_s_{metric.name}": ("sum", value), f"_c_{metric.name}": ("count", value)}
    raise ValueError(f"unsupported aggregation {m.agg!r}")


def _finish(model: SemanticModel, metric: Metric) -> Column:
    m = model.measure(metric.measure)
    if m.agg == "sum":
        total = F.col(f"_s_{metric.name}")
        if m.expr == "usd_value_at_tx":
            return total.cast("decimal(38,2)")
        return total.cast("bigint") if m.expr == "wallet_count" else total
    if m.agg == "count":
        return F.coalesce(F.col(f"_c_{metric.name}"), F.lit(0).cast("bigint"))
    return (F.col(f"_s_{metric.name}").cast("double")
            / F.nullif(F.col(f"_c_{metric.name}"), F.lit(0)).cast("double"))


def _plan(model: SemanticModel, names: Sequence[str]) -> tuple[dict[str, tuple[str, Column]], list[Column]]:
    """Components to aggregate and the final projection of each requested metric."""
    comps: dict[str, tuple[str, Column]] = {}
    finals: list[Column] = []
    for name in names:
        metric = KNOWN[name]
        if metric.kind == "simple":
            comps.update(_components(model, metric))
            finals.append(_finish(model, metric).alias(name))
        elif metric.kind == "ratio":
            num, den = KNOWN[metric.numerator], KNOWN[metric.denominator]
            comps.update(_components(model, num))
            comps.update(_components(model, den))
            # Both sides come from the same pass: a group with no numerator rows
            # gets 0.0, a group with a zero denominator gets NULL.
            finals.append((_finish(model, num).cast("double")
                           / F.nullif(_finish(model, den), F.lit(0)).cast("double")).alias(name))
        else:
            raise ValueError(f"unknown metric kind {metric.kind!r}")
    return comps, finals


def _first_phase(comps: dict[str, tuple[str, Column]]) -> list[Column]:
    return [(F.sum(v) if kind == "sum" else F.count(v)).alias(n) for n, (kind, v) in comps.items()]


def _second_phase(comps: dict[str, tuple[str, Column]]) -> list[Column]:
    return [F.sum(n).alias(n) for n in comps]


def metric_query(fact: DataFrame, req: MetricRequest, users_dim: DataFrame | None = None) -> DataFrame:
    """Metrics of the ``transactions`` model grouped by any of its dimensions,
    by ``metric_time`` at a grain, and by ``user_id__<dimension>`` of the users
    model (joined on the ``user_id`` entity only when asked for).

    With users dimensions the fact is first aggregated per ``user_id`` (and the
    other requested groups), and only those partial sums and counts are joined
    to the users dimension and aggregated again: the fact never moves to meet
    the dimension, and a user holding a third of the rows is one row per map
    task after the partial aggregation.

    ``fill`` (with a ``metric_time`` grouping at any grain, other groups as well)
    adds the periods without rows, see ``fill_calendar``.
    """
    model = TRANSACTIONS
    fact_groups: list[Column] = []
    names: list[str] = []
    user_dims: list[str] = []
    time_name = None
    for g in req.group_by:
        if g == "metric_time":
            if req.grain not in GRAINS:
                raise ValueError(f"grain must be one of {GRAINS}")
            time_name = f"metric_time__{req.grain}"
            fact_groups.append(trunc_ntz(req.grain, model.default_time_dimension).alias(time_name))
            names.append(time_name)
        elif g.startswith("user_id__"):
            dim = g.split("__", 1)[1]
            if not USERS.has_dimension(dim):
                raise KeyError(f"users has no dimension {dim!r}")
            user_dims.append(dim)
            names.append(g)
        elif model.has_dimension(g):
            fact_groups.append(F.col(g))
            names.append(g)
        else:
            raise KeyError(f"unknown group-by {g!r}")
    comps, finals = _plan(model, req.metrics)
    if user_dims and users_dim is None:
        raise ValueError("users dimension requested without users_dim")
    # The users' time dimension has day grain.
    by_day = {USERS.default_time_dimension}
    users = users_dim.select("user_id", *[(trunc_ntz("day", d) if d in by_day else F.col(d)).alias(f"user_id__{d}")
                                          for d in user_dims]) \
        if user_dims else None
    fact_only = fact
    if user_dims and req.where is not None:
        try:
            fact_only = fact.where(req.where)  # analysis fails if the filter names users columns
        except AnalysisException:
            fact_only = None
    if user_dims and fact_only is None:
        # The filter names users columns: join first, then one aggregation.
        base = fact.join(users, "user_id", "left").where(req.where)
        out = base.groupBy(*fact_groups, *[F.col(f"user_id__{d}") for d in user_dims]).agg(*_first_phase(comps))
    elif user_dims:
        fact_names = [n for n in names if not n.startswith("user_id__")]
        per_user = fact_only.groupBy("user_id", *fact_groups).agg(*_first_phase(comps))
        out = (per_user.join(users, "user_id", "left")
               .groupBy(*fact_names, *[f"user_id__{d}" for d in user_dims]).agg(*_second_phase(comps)))
    else:
        base = fact.where(req.where) if req.where is not None else fact
        out = base.groupBy(*fact_groups).agg(*_first_phase(comps))
    out = out.select(*names, *finals)
    if req.fill is not None:
        if time_name is None:
            raise ValueError("fill needs a metric_time grouping")
        out = fill_calendar(out, req, time_name, [n for n in names if n != time_name]).select(*names, *req.metrics)
    return out


GRAIN_STEP = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month",
              "quarter": "interval 3 months", "year": "interval 1 year"}


def fill_calendar(rows: DataFrame, req: MetricRequest, time_name: str, groups: Sequence[str]) -> DataFrame:
    """Every period of the calendar once for every value of the other groups.

    The calendar of a group value runs from its own first to its own last period
    (``fill_span='group'``), or over all periods of the request, or of ``req.spine`` if
    given (``'all'``). It is one ``sequence`` a group value, exploded: as many rows as
    the answer has, whatever the facts. Simple sum and count metrics of added periods
    are ``req.fill``; other metrics stay NULL. A NULL period keeps its row.
    """
    if req.fill_span not in ("group", "all"):
        raise ValueError("fill_span must be 'group' or 'all'")
    low, high = F.min(time_name).alias("_low"), F.max(time_name).alias("_high")
    if req.spine is not None:
        bounds = req.spine.select(trunc_ntz(req.grain, "date_day").alias(time_name))
    else:
        bounds = rows
    if req.spine is not None or req.fill_span == "all":
        whole = bounds.agg(F.struct(low, high).alias("b")).scalar()
        spans = (rows.select(*groups).distinct() if groups else bounds.sparkSession.range(1).select()).select(
            *groups, whole.alias("_b")).select(*groups, "_b._low", "_b._high")
    else:
        spans = rows.groupBy(*groups).agg(low, high)
    periods = F.explode(F.sequence("_low", "_high", F.expr(GRAIN_STEP[req.grain])))
    calendar = spans.select(*[F.col(g).alias(f"_g_{g}") for g in groups], periods.alias("_g__time"))
    on = F.col("_g__time").eqNullSafe(F.col(time_name))
    for g in groups:
        on = on & F.col(f"_g_{g}").eqNullSafe(F.col(g))
    joined = calendar.join(rows, on, "full_outer")
    # Rows without a period have no place in the calendar and come through on their own.
    in_calendar = F.col("_g__time").isNotNull()
    keys = [F.when(in_calendar, F.col(f"_g_{g}")).otherwise(F.col(g)).alias(g) for g in groups]
    fills = []
    for n in req.metrics:
        m = KNOWN[n]
        additive = m.kind == "simple" and MODELS[m.model].measure(m.measure).agg in ("sum", "count")
        filled = F.coalesce(F.col(n), F.lit(req.fill).cast(rows.schema[n].dataType))
        fills.append((F.when(in_calendar, filled).otherwise(F.col(n)) if additive else F.col(n)).alias(n))
    return joined.select(*keys, F.when(in_calendar, F.col("_g__time")).otherwise(F.col(time_name)).alias(time_name), *fills)


def metrics_across(fact: DataFrame, users_dim: DataFrame, req: MetricRequest) -> DataFrame:
    """Metrics of several models in one answer, such as ``transaction_count`` and
    ``wallet_count`` by ``user_id__signup_channel`` and month.

    Each model is first aggregated to the groups on its own (transactions by their
    submission, users by their creation, at the same grain); only those aggregates,
    one row a group each, are joined, full outer and null-safe, so a group that one
    model lacks is kept. Groups must exist in every model asked: ``metric_time`` and
    ``user_id__<dimension>``. ``where`` would name one model's columns and is refused.
    """
    if req.where is not None:
        raise ValueError("a filter belongs to one model: filter its table instead")
    by_model: dict[str, list[str]] = {}
    for n in req.metrics:
        by_model.setdefault(KNOWN[n].model, []).append(n)
    names = [f"metric_time__{req.grain}" if g == "metric_time" else g for g in req.group_by]
    answers = []
    for model, metrics in by_model.items():
        if model == TRANSACTIONS.name:
            shared = [g for g in req.group_by if g != "metric_time" and not g.startswith("user_id__")]
            if shared and len(by_model) > 1:
                raise KeyError(f"not a group of every model: {shared}")
            answers.append(metric_query(fact, MetricRequest(metrics, req.group_by, req.grain), users_dim))
        else:
            answers.append(_users_metrics(users_dim, metrics, req))
    out = answers[0]
    for other in answers[1:]:
        if not names:
            # Each side is one row.
            out = out.select("*", *[other.select(c).scalar().alias(c) for c in other.columns])
            continue
        marked = other.select(*[F.col(n).alias(f"_o_{n}") for n in names], F.lit(True).alias("_there"),
                              *[c for c in other.columns if c not in names])
        on = F.lit(True)
        for n in names:
            on = on & F.col(n).eqNullSafe(F.col(f"_o_{n}"))
        here = out.withColumn("_here", F.lit(True))
        both = here.join(marked, on, "full_outer")
        out = both.select(*[F.when(F.col("_here"), F.col(n)).otherwise(F.col(f"_o_{n}")).alias(n) for n in names],
                          *[c for c in out.columns if c not in names], *[c for c in other.columns if c not in names])
    out = out.select(*names, *req.metrics)
    if req.fill is not None:
        if "metric_time" not in req.group_by:
            raise ValueError("fill needs a metric_time grouping")
        time_name = f"metric_time__{req.grain}"
        out = fill_calendar(out, req, time_name, [n for n in names if n != time_name]).select(*names, *req.metrics)
    return out


def _users_metrics(users_dim: DataFrame, metrics: Sequence[str], req: MetricRequest) -> DataFrame:
    """Metrics of the users model by its own dimensions and time."""
    if req.grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    groups, names = [], []
    for g in req.group_by:
        dim = g.removeprefix("user_id__")
        if g == "metric_time":
            names.append(f"metric_time__{req.grain}")
            groups.append(trunc_ntz(req.grain, USERS.default_time_dimension).alias(names[-1]))
        elif g.startswith("user_id__") and USERS.has_dimension(dim):
            names.append(g)
            groups.append((trunc_ntz("day", dim) if dim == USERS.default_time_dimension else F.col(dim)).alias(g))
        else:
            raise KeyError(f"not a group of every model: {g!r}")
    comps, finals = _plan(USERS, metrics)
    return users_dim.groupBy(*groups).agg(*_first_phase(comps)).select(*names, *finals)


def users_measure(users_dim: DataFrame, group_by: Sequence[str] = (), grain: str | None = None) -> DataFrame:
    """The users model's ``wallet_count`` sum measure (declared, unused by any metric).

    With a ``grain`` also by ``metric_time``, the model's own time dimension.
    """
    if grain is not None and grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    time = [] if grain is None else [trunc_ntz(grain, USERS.default_time_dimension).alias(f"metric_time__{grain}")]
    return users_dim.groupBy(*time, *group_by).agg(F.sum("wallet_count").cast("bigint").alias("wallet_count"))
