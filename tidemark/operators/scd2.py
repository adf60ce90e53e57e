"""Type-2 history.

Versions are half-open ``[valid_from, valid_to)`` intervals on business time:
``valid_from`` is the row's ``updated_at``, ``valid_to`` the ``updated_at`` of
the next version (NULL while open). A version opens only when ``updated_at``
moves forward; an equal or older ``updated_at`` is no change, even when other
values differ (the timestamp strategy).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import far_future
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.timeline import STRETCH_ROWS, last_at_or_before, next_time

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def scd2_apply(history: DataFrame | None, current: DataFrame, key: str, updated_at: str = "updated_at",
               hard_deletes: str = "ignore", as_of: Column | None = None,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """One snapshot run: fold the ``current`` state of the source into ``history``.

    * key new to the history: a version opens at its ``updated_at``;
    * key whose ``updated_at`` is later than the open version's ``valid_from``:
      the open version closes there and a new one opens;
    * otherwise the open version stays as it is;
    * key absent from ``current``: left open (``hard_deletes='ignore'``) or
      closed at ``as_of`` (``'invalidate'``).

    ``current`` is de-duplicated first (latest ``updated_at`` per key), so a
    duplicated source can never open two versions. Closed versions pass through
    without a shuffle; only open versions meet the source, in a one-to-one
    full outer join on the key.
    """
    if history is None:
        return fold_into_open(None, current, key, updated_at, hard_deletes, as_of, tiebreak)
    closed = history.where(F.col(VALID_TO).isNotNull())
    open_ = history.where(F.col(VALID_TO).isNull())
    return closed.unionByName(fold_into_open(open_, current, key, updated_at, hard_deletes, as_of, tiebreak))


def fold_into_open(open_: DataFrame | None, current: DataFrame, key: str, updated_at: str = "updated_at",
                   hard_deletes: str = "ignore", as_of: Column | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """What a snapshot run makes of the open versions (None before any run): those it closes,
    those that stay open and those it opens. The rules are those of ``scd2_apply``."""
    if hard_deletes not in ("ignore", "invalidate"):
        raise ValueError("hard_deletes must be 'ignore' or 'invalidate'")
    if hard_deletes == "invalidate" and as_of is None:
        raise ValueError("hard_deletes='invalidate' needs as_of")
    cur = latest_per_key(current, key, [updated_at, *tiebreak])
    cols = cur.columns
    new_versions = cur.select(*cols, F.col(updated_at).alias(VALID_FROM),
                              F.lit(None).cast(cur.schema[updated_at].dataType).alias(VALID_TO))
    if open_ is None:
        return new_versions
    columns = open_.columns
    h = open_.select(F.struct(*[F.col(c) for c in columns]).alias("h"), F.col(key).alias("_hk"))
    s = new_versions.select(F.struct(*[F.col(c) for c in columns]).alias("s"), F.col(key).alias("_sk"))
    j = h.join(s, F.col("_hk") == F.col("_sk"), "full_outer")
    newer = F.col(f"s.{updated_at}") > F.col(f"h.{VALID_FROM}")
    close_at = F.when(F.col("_sk").isNotNull() & newer, F.col(f"s.{updated_at}"))
    if hard_deletes == "invalidate":
        close_at = close_at.when(F.col("_sk").isNull(), as_of.cast(cur.schema[updated_at].dataType))
    kept = F.when(F.col("_hk").isNotNull(), F.col("h").withField(VALID_TO, close_at))
    opened = F.when(F.col("_sk").isNotNull() & (F.col("_hk").isNull() | newer), F.col("s"))
    out = (j.select(F.explode(F.array(kept, opened)).alias("v"))
           .where(F.col("v").isNotNull()).select("v.*"))
    return out.select(*columns)


def scd2_from_log(log: DataFrame, key: str, updated_at: str, columns: Sequence[str],
                  tiebreak: Sequence[str] = (), stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """All versions of a complete change log in one pass (what repeated snapshot
    runs would give if every change were seen).

    At one ``updated_at`` the first change under ``tiebreak`` wins, as a
    snapshot applied change by change would keep it. ``valid_to`` is the next
    ``updated_at`` of the key (``lead`` within stretches of the timeline, see ``timeline``).
    """
    firsts = latest_per_key(log, [key, updated_at], list(tiebreak), descending=False) if tiebreak \
        else log.dropDuplicates([key, updated_at])
    v = firsts.select(*columns, F.col(updated_at).alias(VALID_FROM))
    times = log.select(key, F.col(updated_at).alias(VALID_FROM))
    return next_time(v, [key], VALID_FROM, VALID_TO, times=times, stretch_rows=stretch_rows)


def with_is_current(history: DataFrame) -> DataFrame:
    return history.withColumn("is_current", F.col(VALID_TO).isNull())


def as_of_join(facts: DataFrame, history: DataFrame, key: str, fact_ts: str,
               version_cols: Sequence[str], how: str = "left", stretch_rows: int = STRETCH_ROWS,
               row_id: Sequence[str] | None = None) -> DataFrame:
    """Attach to every fact the version valid at ``fact_ts``:
    ``key`` equal and ``valid_from <= fact_ts < coalesce(valid_to, far future)``.

    ``how='left'`` keeps facts without a version (version columns NULL);
    ``how='inner'`` drops them. Versions of one key do not overlap, so the match
    is the latest version starting at or before the fact, if it is still open
    at that instant. Planned as one ordered scan per (key, stretch): no
    fact-by-version pairs are formed, whatever the number of versions per key.
    ``row_id`` (the facts' key, say) keeps the scan that sizes the stretches narrow.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    payload = F.struct(*[F.col(c) for c in version_cols], F.col(VALID_FROM), F.col(VALID_TO))
    marks = history.select(F.col(key), F.col(VALID_FROM).alias(fact_ts), payload.alias("_ver"))
    found = last_at_or_before(facts, marks, [key], fact_ts, "_ver", "_ver", stretch_rows, row_id)
    valid = F.col("_ver").isNotNull() & (F.col(fact_ts) < F.coalesce(F.col(f"_ver.{VALID_TO}"), far_future()))
    found = found.withColumn("_ver", F.when(valid, F.col("_ver")))
    if how == "inner":
        found = found.where(F.col("_ver").isNotNull())
    return found.select(*facts.columns, *[F.col(f"_ver.{c}").alias(c)
                                          for c in [*version_cols, VALID_FROM, VALID_TO]])
