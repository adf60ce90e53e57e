"""Very long texts with many spans, and the pipeline's stages on odd rows."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from tidemark.llm import secret_scan, simhash


def checksums(n):
    return [(hashlib.sha256(str(i).encode()).hexdigest(), f"  file{i}.txt") for i in range(n)]


@pytest.mark.parametrize("n", [12_000, 48_000])
def test_megabytes_of_checksums_in_one_text(spark, n):
    lines = checksums(n)
    text = "\n".join(h + name for h, name in lines)
    expected, at = [], 0
    for h, name in lines:
        expected.append(("hex", at, at + len(h)))
        at += len(h) + len(name) + 1
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in secret_scan.secret_spans(docs).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in found[1]] == expected and found[2] == []
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert clean == {1: "\n".join("[SECRET]" + name for _, name in lines), 2: None}


def test_touching_and_overlapping_spans_are_masked_as_one(spark):
    key = "9aB3xY7qLm2Zp8Rt5Vw1"
    texts = {1: f"é😀 token={key}/{key} end", 2: f"AKIA{'Q7' * 10} then password:{key}", 3: key, 4: "plain"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.secret_spans(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    for i, text in texts.items():
        out, at = "", -1
        for s in sorted((s["start"], s["end"]) for s in spans[i]):
            if s[0] > at:
                out += text[max(at, 0):s[0]] + "[SECRET]"
            at = max(at, s[1])
        assert clean[i] == (out + text[at:] if spans[i] else text)
    assert clean[1] == "é😀 [SECRET] end" and clean[4] == "plain"


CLASHING = "doc_id long, text string, found_candidate_gaps int, hits string, judgement int, row_key int, n_chars long"


def test_stages_take_odd_rows_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, "a plain question of ten words that stands alone here now")],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(1, None), (2, ""), (None, "a b c"), (None, None), (4, "word " * 200_000), (4, "word " * 200_000),
           (5, "token=9aB3xY7qLm2Zp8Rt5Vw1 was here")]
    for texts in (odd, []):
        docs = spark.createDataFrame([(i, t, 1, "h", 2, 3, None if t is None else len(t)) for i, t in texts], CLASHING)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            kept = Counter((r["doc_id"], None if r["text"] is None else len(r["text"])) for r in out.collect())
            whole = Counter((i, None if t is None else len(t)) for i, t in texts)
            if name == "simhash_near_dedup" and texts:
                # The three texts without words share a fingerprint; the smallest id of each group stays.
                assert kept == Counter([(1, None), (None, 5), (4, 1_000_000), (5, len(odd[-1][1]))])
            elif name == "secret_scans" and texts:
                assert kept == whole - Counter([(5, len(odd[-1][1]))]) + Counter([(5, len("[SECRET] was here"))])
            else:
                assert kept == whole
        coded = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert Counter(r["doc_id"] for r in coded) == Counter(i for i, _ in texts)


def test_near_copies_of_documents_with_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two three four"), ("a", "one two three four"), (None, "five six seven")],
                                 "doc_id string, text string")
    assert {r["doc_id"] for r in simhash.one_per_component(docs, shingle_words=3, max_bits=2).collect()} == {"a", None}
