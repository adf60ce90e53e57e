"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

All work is done with SQL functions. A candidate is a long run of key characters
with letters and digits. A window slides over it one character at a time; the
counts of its characters change by the one that enters and the one that leaves,
and with them the sum of c * log2(c), from which the Shannon entropy follows. The
highest window is held against the threshold of the candidate's character class;
candidates on the allow list are suppressed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_name
from tidemark.llm.regex_spans import as_spans, digest_text, let, masked, with_matches, within_runs

KINDS = ("assign", "access", "hex", "entropy")
KEYWORDS = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|" \
           "[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
ASSIGN_HEAD = KEYWORDS + "[\"']?\\x20*[:=]\\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]"
PATTERNS = {
    "assign": f"{ASSIGN_HEAD}{VALUE}+",
    "access": "AKIA[A-Z0-9]+",
    # Shorter runs of hex digits fail anyway; a run is matched whole or not at all.
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}",
    "candidate": "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}",
}
WINDOW = 20
# Least entropy in bits of the highest window, by character class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.7, "base64": 3.9}
ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?i)example|sample|dummy|placeholder|changeme|lorem",
    "(?i)abcdefgh|01234567",
    "^[A-Z0-9_]*_[A-Z0-9_]*$",
    "^(?:[a-z]+[-_/])+[a-z]+[0-9]*$",
)


def highest_entropy(value: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of any ``window`` consecutive characters."""
    def weight(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))

    def count(counts: Column, c: Column) -> Column:
        return F.coalesce(F.try_element_at(counts, c), F.lit(0))

    def put(counts: Column, c: Column, n: Column) -> Column:
        return F.map_concat(F.map_filter(counts, lambda k, _: k != c), F.create_map(c, n))

    def moved(acc: Column, c: Column, by: int) -> Column:
        return let(count(acc["counts"], c), lambda n: F.struct(
            put(acc["counts"], c, n + by).alias("counts"), (acc["sum"] + weight(n + by) - weight(n)).alias("sum"),
            acc["best"].alias("best")))

    def judged(acc: Column, at: Column) -> Column:
        bits = F.lit(float(window)).cast("double")
        entropy = F.log2(bits) - acc["sum"] / bits
        return F.struct(acc["counts"].alias("counts"), acc["sum"].alias("sum"),
                        F.when(at >= window, F.greatest(acc["best"], entropy)).otherwise(acc["best"]).alias("best"))

    # Position by position: a character leaves, one enters, the full window is judged.
    def slid(chars: Column) -> Column:
        def step(acc: Column, at: Column) -> Column:
            left = F.when(at > window, moved(acc, F.get(chars, at - window - 1), -1)).otherwise(acc)
            return let(let(left, lambda a: moved(a, F.get(chars, at - 1), 1)), lambda a: judged(a, at))

        start = F.struct(F.create_map().cast("map<string,int>").alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step)["best"]

    return let(F.split(value, ""), slid)


def is_high_entropy(value: Column, window: int, thresholds: dict[str, float], allowed: tuple[str, ...]) -> Column:
    """Whether a candidate mixes letters and digits, is not allowed and passes its class's threshold."""
    threshold = (F.when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), thresholds["hex"])
                 .when(value.rlike("^[A-Za-z0-9]+$"), thresholds["alnum"]).otherwise(thresholds["base64"]))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    for pattern in allowed:
        mixed = mixed & ~value.rlike(pattern)
    return F.when(mixed, F.round(highest_entropy(value, window), 9) >= threshold).otherwise(F.lit(False))


def with_secrets(docs: DataFrame, result_col: str, text_col: str = "text", window: int = WINDOW,
                 thresholds: dict[str, float] | None = None, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` and ``result_col``: array of struct(start, rank, kind, end), by start, then kind.

    Kinds are assign, access and hex, and ``entropy`` for what the entropy test
    adds outside them. Offsets are code points, ends exclusive. Null and empty
    texts have no spans; repeated rows give repeated results; extra columns stay.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = {kind: fresh_name(docs, f"found_{kind}") for kind in PATTERNS}
    candidates = with_matches(docs, text, {names["candidate"]: PATTERNS["candidate"]})
    low = F.lower(text)
    keyword = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        keyword = keyword | low.contains(word)
    # A run of 24 hex digits lies within a candidate, so only texts with such a candidate are searched.
    guards = {names["assign"]: keyword, names["access"]: text.contains("AKIA"),
              names["hex"]: F.exists(names["candidate"], lambda m: m["value"].rlike("[0-9a-f]{24}"))}
    found = with_matches(candidates, text, {names[k]: PATTERNS[k] for k in KINDS[:3]}, guards)
    good = {
        "assign": F.filter(names["assign"], lambda m: F.length(F.regexp_replace(m["value"], "^" + ASSIGN_HEAD, "")) >= 6),
        "access": F.filter(names["access"], lambda m: F.length(m["value"]) >= 20),
        "hex": F.col(names["hex"]),
    }
    base_name = fresh_name(docs, "base_spans")
    based = found.withColumn(base_name, F.sort_array(F.concat(*[
        as_spans(good[kind], kind, rank) for rank, kind in enumerate(KINDS[:3])])))
    limits = {**THRESHOLDS, **(thresholds or {})}
    # A candidate that base spans cover wholly adds nothing; another one is tested whole.
    outside = based.withColumn(names["candidate"], F.filter(F.zip_with(
        F.col(names["candidate"]), within_runs(F.col(names["candidate"]), F.col(base_name)),
        lambda m, inside: F.struct(m.alias("m"), inside.alias("inside"))), lambda z: ~z["inside"]))
    added = F.transform(F.filter(names["candidate"], lambda z: is_high_entropy(z["m"]["value"], window, limits, allowed)),
                        lambda z: z["m"])
    result = outside.withColumn(result_col, F.sort_array(F.concat(F.col(base_name), as_spans(added, "entropy", 3))))
    return result.drop(base_name, *names.values())


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``id_col`` and ``spans``. See ``with_secrets``."""
    found = with_secrets(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "spans", **options)
    return found.select(F.col("id").alias(id_col), "spans")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by ``mask``; other columns and null texts stay."""
    name = fresh_name(docs, "secret_spans")
    found = with_secrets(docs, name, text_col, **options)
    return found.withColumn(text_col, masked(F.col(text_col), F.col(name), mask)).drop(name)


def base_of(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != "entropy")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


__all__ = ["base_of", "count_of", "digest_text", "redact", "secret_spans", "with_secrets"]
