"""The registered queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, html_text, langid, licenses, pieces, pii, secret_scan, toxicity
from tidemark.llm.common import is_held_out, stored, table
from tidemark.llm.content_sort import exact_groups
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.prefix_trie import prefix_trie
from tidemark.llm.regex_spans import digest_text
from tidemark.llm.simhash import simhash_components
from tidemark.llm.topk import top_k


PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.toxic_spans(docs, model)
    return judged.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", "predicted", "spans")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    counts = [secret_scan.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    base = secret_scan.base_of(F.col("spans"))
    return found.select("doc_id", *counts, F.sha2(digest_text(base), 256).alias("base_sha256"),
                        digest_text(F.col("spans")).alias("spans"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str, model: str = PIECES) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents"), pieces.Vocabulary.load(model), check=True)
    return coded.select("doc_id", "n_tokens", "ids", "round_trip")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.languages(docs, langid.fit(docs))
    return found.select("doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5, scale=256)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [secret_scan.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]]
    actions = F.array_join(F.transform("terms", lambda t: F.concat_ws(
        ":", t["action"], t["start"].cast("string"), t["end"].cast("string"))), ",")
    return found.select("doc_id", *counts, F.sha2(digest_text(F.col("base")), 256).alias("base_sha256"),
                        digest_text(pii.all_spans(F.col("base"), F.col("terms"))).alias("spans"), actions.alias("actions"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = stored(licenses.known_licenses(spark, [*licenses.CATALOGUE, *licenses.entire_licenses()]), "licenses")
    found = licenses.license_hits(table(spark, sf_dir, "documents"), known)
    return found.select("doc_id", "whole", F.array_join("lines", ",").alias("lines"), F.size("lines").cast("long").alias("n_licenses"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("enter", "exit")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op9_main_text": op9_main_text,
    "op6_licenses": op6_licenses,
    "op1_pii": op1_pii,
    "op7_topk": op7_topk,
    "op3_language": op3_language,
    "op10_sentencepiece": op10_sentencepiece,
    "op8_secrets": op8_secrets,
    "op5_decontamination": op5_decontamination,
    "op2_toxicity": op2_toxicity,
    "op4_simhash": op4_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
