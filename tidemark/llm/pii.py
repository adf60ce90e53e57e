"""Personal data: fixed patterns, and terms that reveal protected entities.

All work is done with SQL functions. The values that the patterns find are the
protected entities. The corpus says how strongly a term reveals one: with c(t) the
occurrences of a term among all N words, p(e) = c(e) / N the share of the words that
stand in documents that mention an entity and c(t, e) the occurrences of the term
among those, the term discloses

    PMI(t; e) / IC(e) = log((c(t, e) + m p(e)) / ((c(t) + m) p(e))) / log(1 / p(e))

of the entity's information content; 1 means that the term occurs in documents of the
entity only. A word seen once always does, which says little: as usual for PMI of small
counts, the share is discounted by c(t, e) / (c(t, e) + m), whatever the size of the
corpus. With m = PRIOR words one sight with the entity stays below the thresholds, two
can reach the first, and the second takes three at least; every pair is judged. In documents that mention the
entity all occurrences of a term are generalised from a first threshold on, removed
from a second one on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, fresh_name
from tidemark.llm.regex_spans import with_matches

KINDS = ("email", "ip", "card", "phone", "term")
# \x01 stands for a dot between two domain characters (email) or a separator between two digits (card).
# A search starts only where a run of its first characters starts or the last match ended; a
# later start in the same run would meet the same end. No pattern has a repeated group, whose
# matching would recurse once for each repetition.
EMAIL_CHARS = "A-Za-z0-9._%+\\x01-"
PATTERNS = {
    "email": f"(?:\\G|(?<![{EMAIL_CHARS}]))[{EMAIL_CHARS}]++@[A-Za-z0-9-]+\\x01[A-Za-z0-9\\x01-]+",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++(?:\\.[0-9]+)(?:\\.[0-9]+)(?:\\.[0-9]+)",
    "card": "(?:\\G|(?<![0-9\\x01]))[0-9][0-9\\x01]+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
TERM = "[\\p{L}]{3,}"
GENERALISE = 0.75
REMOVE = 0.85
# Words of independent use that each term is credited with, so that one sight is weaker evidence than several.
PRIOR = 0.5


def passes_luhn(digits: Column) -> Column:
    """Luhn's check of a string of at most 19 digits."""
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, double).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.transform(F.split(value, "\\."), lambda p: F.regexp_replace(p, "^0+", "")), lambda p: (
            F.length(p) <= 3) & (F.concat(F.lit("0"), F.substring(p, 1, 3)).cast("int") <= 255))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), passes_luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def with_base(docs: DataFrame, result_col: str, text: Column) -> DataFrame:
    """``docs`` and ``result_col``: array of struct(start, end, value, kind, rank), by kind, then start."""
    plain = F.translate(text, "\x01", "\x02")
    email_text, card_text = fresh_name(docs, "email_text"), fresh_name(docs, "card_text")
    names = {k: fresh_name(docs, f"found_{k}") for k in PATTERNS}
    has_digit = text.rlike("[0-9]")
    # Both texts differ from the original by single characters only, so positions hold.
    marked = docs.withColumns({
        email_text: F.when(text.contains("@"), F.regexp_replace(plain, "(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])", "\x01")),
        card_text: F.when(has_digit, F.regexp_replace(plain, "(?<=[0-9])[\\x20-](?=[0-9])", "\x01")),
    })
    found = with_matches(marked, F.col(email_text), {names["email"]: PATTERNS["email"]})
    found = with_matches(found, F.col(card_text), {names["card"]: PATTERNS["card"]},
                         {names["card"]: F.col(card_text).rlike("[0-9][0-9\\x01]{12}")})
    found = with_matches(found, text, {names["ip"]: PATTERNS["ip"], names["phone"]: PATTERNS["phone"]},
                         {names["ip"]: text.rlike("[0-9]\\.[0-9]"), names["phone"]: text.contains("+")})
    def spans(rank: int, kind: str) -> Column:
        good = F.filter(names[kind], lambda m: valid(kind, m["value"]))
        return F.transform(good, lambda m: F.struct(
            F.lit(rank).alias("rank"), m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"),
            F.lower(F.translate(m["value"], "\x01", "." if kind == "email" else " ")).alias("value")))

    return found.withColumn(result_col, F.concat(*[spans(r, k) for r, k in enumerate(KINDS[:4])])).drop(email_text, card_text, *names.values())


def entity_groups(kept: DataFrame) -> DataFrame:
    """(row, groups): the groups of entities that each row mentions; a group holds the entities of the same rows.

    Their words are the same, so they are counted once a group. A group's key is
    the number of its rows and two hashes over them.
    """
    mentions = kept.select("row", F.explode(F.array_distinct(F.transform("base", lambda b: b["value"]))).alias("entity"))
    keys = mentions.groupBy("entity").agg(F.struct(
        F.count("*").alias("rows"), F.bit_xor(F.xxhash64("row")).alias("a"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b")).alias("group"))
    return mentions.join(keys, "entity").groupBy("row").agg(F.collect_set("group").alias("groups"))


def words_of(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def disclosure(private: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(group, term, share): the share of an entity's information that each term of its documents discloses.

    ``private`` has a row (groups, text) for each document that mentions an entity.
    All words of all ``docs`` are counted.
    """
    pairs = (private.select("groups", F.explode(words_of(F.col("text"))).alias("term"))
             .select("term", F.explode("groups").alias("group")).groupBy("group", "term").agg(F.count("*").alias("both")))
    entities = (private.select("groups", F.size(words_of(F.col("text"))).alias("words"))
                .select("words", F.explode("groups").alias("group")).groupBy("group").agg(F.sum("words").alias("near")))
    words = docs.select(F.explode(words_of(F.col(text_col).cast("string"))).alias("term"))
    counts = cut(words.groupBy("term").agg(F.count("*").alias("everywhere")))
    total = counts.agg(F.sum("everywhere")).first()[0] or 0
    joined = pairs.join(counts, "term").join(entities, "group").filter(F.col("near") < total)
    p = F.col("near") / F.lit(float(total))
    pmi = F.log((F.col("both") + PRIOR * p) / ((F.col("everywhere") + PRIOR) * p))
    return joined.select("group", "term", F.round(pmi / -F.log(p) * F.col("both") / (F.col("both") + PRIOR), 9).alias("share"))


def with_terms(docs: DataFrame, id_cols: list[str], text_col: str, generalise: float, remove: float) -> DataFrame:
    """A row (``id_cols``, row, base, terms) for each document; ``row`` numbers the rows of this result."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = fresh_name(docs, "private_text")
    found = with_base(docs, "base", text).withColumn(own, F.when(F.size("base") > 0, text))
    kept = cut(found.select(*id_cols, "base", own).withColumn("row", F.monotonically_increasing_id()))
    mentioning = kept.filter(F.size("base") > 0).select("row", "base", F.col(own).alias("text"))
    groups = cut(entity_groups(mentioning))
    private = mentioning.select("row", "text").join(groups, "row")
    shares = disclosure(private, docs, text_col).filter(F.col("share") >= generalise)
    disclosing = (private.select("row", "groups", F.explode(F.array_distinct(words_of(F.col("text")))).alias("term"))
                  .select("row", "term", F.explode("groups").alias("group")).join(shares, ["group", "term"])
                  .groupBy("row", "term").agg(F.max("share").alias("share")))
    places = with_matches(mentioning.select("row", "text"), F.col("text"), {"word": TERM}).select(
        "row", F.explode("word").alias("w")).select("row", F.lower("w.value").alias("term"), "w.start", "w.end")
    terms = places.join(disclosing, ["row", "term"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", "end", F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action")))).alias("terms"))
    joined = kept.join(terms, "row", "left")
    # A term may be part of a mention.
    free = F.filter(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,action:string>>")),
                    lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    return joined.select(*id_cols, "row", "base", free.alias("terms"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
                  remove: float = REMOVE) -> DataFrame:
    """One row per document: ``id_col``, base (spans by kind, then start) and terms (start, end, action).

    Defined cases: null and empty texts have no spans; repeated rows count as
    separate documents and give repeated results; null ids stay; an empty table
    gives no rows; extra columns are not read.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = with_terms(own, ["id"], "text", generalise, remove)
    return found.select(F.col("id").alias(id_col), "base", "terms")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
             remove: float = REMOVE) -> DataFrame:
    """``id_col`` and the text with base values masked, disclosing terms generalised to [TERM] or removed."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = with_terms(own, ["id", "text"], "text", generalise, remove)
    spans = F.sort_array(F.concat(
        F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.concat(
            F.lit("["), F.upper(b["kind"]), F.lit("]")).alias("mask"))),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(
            t["action"] == "remove", "").otherwise("[TERM]").alias("mask")))))
    # Overlapping spans: what lies before the furthest end so far is already masked.
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["at"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])).otherwise("")
        mask = F.when(s["start"] >= acc["at"], s["mask"]).otherwise("")
        return F.struct(F.concat(acc["out"], gap, mask).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(spans, state, step)
    clean = F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.lit(2147483647)))).otherwise(F.col("text"))
    return found.select(F.col("id").alias(id_col), clean.alias(text_col))


def all_spans(base: Column, terms: Column) -> Column:
    """Base spans, then terms, as struct(kind, start, end)."""
    plain = F.transform(base, lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return F.concat(plain, F.transform(terms, lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end"))))

