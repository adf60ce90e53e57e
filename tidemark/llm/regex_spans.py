"""Positions of all leftmost non-overlapping matches of a pattern, with SQL functions only.

Spark has functions for the matched strings and for the pieces between them. Both
come from the same left-to-right search, so the start of a match is the total
length of the pieces and matches before it. All work on one text grows with its
length and its number of spans, not with their product.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_name

# Running values are taken in blocks of this many, so that long lists stay linear.
BLOCK = 256
# Long texts are cut into parts of this many characters: reaching a position costs one part, not the text before it.
PART = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once however often the body or its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, zero: int, join: Callable[[Column, Column], Column]) -> Column:
    """For each value of an array<int> the joined values before it; ``zero`` before the first.

    ``join`` is associative and ``zero`` its neutral value.
    """
    none = F.array().cast("array<int>")
    state = F.struct(none.alias("before"), F.lit(zero).alias("so_far"))

    def add(acc: Column, v: Column) -> Column:
        return F.struct(F.concat(acc["before"], F.array(acc["so_far"])).alias("before"),
                        join(acc["so_far"], v).alias("so_far"))

    def follow(acc: Column, block: Column) -> Column:
        return F.struct(
            F.concat(acc["parts"], F.array(F.struct(block["before"].alias("before"), acc["so_far"].alias("base")))).alias("parts"),
            join(acc["so_far"], block["so_far"]).alias("so_far"))

    def scanned(whole: Column) -> Column:
        numbers = F.when(F.size(whole) > 0, F.sequence(F.lit(0), ((F.size(whole) - 1) / BLOCK).cast("int")))
        blocks = F.transform(numbers, lambda b: F.aggregate(F.slice(whole, b * BLOCK + 1, F.lit(BLOCK)), state, add))
        empty = F.struct(F.array().cast("array<struct<before:array<int>,base:int>>").alias("parts"),
                         F.lit(zero).alias("so_far"))
        parts = F.aggregate(blocks, empty, follow)["parts"]
        return F.flatten(F.transform(parts, lambda p: F.transform(p["before"], lambda t: join(p["base"], t))))

    return F.coalesce(let(values, scanned), none)


def running_totals(values: Column) -> Column:
    """For each value of an array<int> the sum of the values before it, from start 0."""
    return running(values, 0, lambda a, b: a + b)


def with_matches(df: DataFrame, text: Column, patterns: dict[str, str],
                 guards: dict[str, Column] | None = None) -> DataFrame:
    """``df`` and for each named pattern an array column of struct(start, end, value).

    Starts count code points from 0, ends are exclusive. Null texts give empty
    arrays. A guard is a cheap condition that every text with a match fulfils:
    other texts are not searched. The pieces are cut only in texts that have a match.
    """
    guards = guards or {}
    spare = {name: fresh_name(df, f"{name}_gaps") for name in patterns}
    found = df.withColumns({name: F.coalesce(
        F.when(guards.get(name, F.lit(True)), F.regexp_extract_all(text, F.lit(p), F.lit(0))),
        F.array().cast("array<string>")) for name, p in patterns.items()})
    gaps = found.withColumns({spare[name]: F.when(F.size(name) > 0, F.transform(F.split(text, p, -1), F.length))
                              for name, p in patterns.items()})
    pairs = gaps.withColumns({name: F.when(F.size(name) > 0, F.zip_with(
        F.slice(spare[name], 1, F.size(name)), name,
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))) for name in patterns})
    totals = pairs.withColumns({spare[name]: running_totals(F.transform(
        name, lambda m: m["gap"] + F.length(m["value"]))) for name in patterns})
    placed = totals.withColumns({name: F.coalesce(F.zip_with(name, spare[name], lambda m, before: F.struct(
        (before + m["gap"]).alias("start"), (before + m["gap"] + F.length(m["value"])).alias("end"),
        m["value"].alias("value"))), F.array().cast("array<struct<start:int,end:int,value:string>>"))
        for name in patterns})
    return placed.drop(*spare.values())


def as_spans(matches: Column, kind: str, rank: int) -> Column:
    """struct(start, rank, kind, end) of each match; sorts by start, then by the rank of its kind."""
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def digest_text(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def runs_of(spans: Column) -> Column:
    """struct(start, before) of each run of touching or overlapping ``spans``, which are sorted by start.

    ``before`` is the end of the run before it, -1 for the first; the last run ends
    at the highest end of all spans.
    """
    ends = running(F.transform(spans, lambda s: s["end"]), -1, lambda a, b: F.greatest(a, b))
    return F.filter(F.zip_with(spans, ends, lambda s, before: F.struct(s["start"].alias("start"), before.alias("before"))),
                    lambda r: r["start"] > r["before"])


def last_end(spans: Column) -> Column:
    return F.array_max(F.transform(spans, lambda s: s["end"]))


def within_runs(places: Column, spans: Column) -> Column:
    """For each of ``places``, sorted by start, whether one run of ``spans`` holds it whole."""
    def ends_of(runs: Column) -> Column:
        ends = F.concat(F.transform(F.slice(runs, F.lit(2), F.greatest(F.size(runs), F.lit(1))), lambda r: r["before"]),
                        F.array(last_end(spans)))
        return F.zip_with(runs, ends, lambda r, e: F.struct(
            r["start"].alias("start"), F.lit(0).alias("place"), e.alias("end"), F.lit(0).alias("need")))

    # One walk over runs and places: the run a place starts in is the last one that starts no later.
    asked = F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(1).alias("place"),
                                                   F.lit(-1).alias("end"), p["end"].alias("need")))
    def walk(both: Column) -> Column:
        reach = running(F.transform(both, lambda e: e["end"]), -1, lambda a, b: F.greatest(a, b))
        answers = F.zip_with(both, reach, lambda e, r: F.struct(e["place"].alias("place"), (r >= e["need"]).alias("inside")))
        return F.transform(F.filter(answers, lambda a: a["place"] == 1), lambda a: a["inside"])

    return F.when(F.size(spans) > 0, let(F.sort_array(F.concat(let(runs_of(spans), ends_of), asked)), walk)).otherwise(
        F.transform(places, lambda p: F.lit(False)))


def pieces_of(text: Column, places: Column) -> Column:
    """The text of each struct(first, last) of ``places``: code points from first, last exclusive."""
    def piece(parts: Column, first: Column, last: Column) -> Column:
        low, high = F.floor(first / PART).cast("int"), F.floor(last / PART).cast("int")
        near = F.array_join(F.slice(parts, low + 1, high - low + 1), "")
        return F.when(last > first, F.substring(near, first - low * PART + 1, last - first)).otherwise("")

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)),
               lambda parts: F.transform(places, lambda p: piece(parts, p["first"], p["last"])))


def masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with each run of overlapping ``spans`` (sorted by start) replaced by ``mask``."""
    def place(first: Column, last: Column) -> Column:
        return F.struct(F.greatest(first, F.lit(0)).alias("first"), last.alias("last"))

    gaps = F.concat(F.transform(runs_of(spans), lambda r: place(r["before"], r["start"])),
                    F.array(place(last_end(spans), F.length(text))))
    return F.when(F.size(spans) > 0, F.array_join(pieces_of(text, gaps), mask)).otherwise(text)
