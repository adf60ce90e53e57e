"""The pipeline's stages against plain Python on the same rows."""

import sentencepiece

import corpus_pipeline
from tidemark.llm import decontam, secret_scan, simhash, toxicity
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide_as_their_operators(spark):
    docs = table(spark, SF, "documents")
    bench = table(spark, SF, "benchmark")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    rows = {r["doc_id"]: r for r in docs.collect()}
    left = {i: r["text"] for i, r in rows.items() if model.judge([r["text"]])[0]["predicted"] == 0}
    # Components among what the first stage kept, by comparing all pairs.
    fps = {i: simhash.fingerprint(t) for i, t in left.items()}
    group = {i: i for i in left}
    for i in sorted(left):
        for j in sorted(left):
            if i < j and bin((fps[i] ^ fps[j]) & (2 ** 64 - 1)).count("1") <= 2 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    left = {i: t for i, t in left.items() if group[i] == i}
    windows = set()
    for r in bench.collect():
        words = decontam.words_of(r["text"])
        windows |= {tuple(words[k:k + 10]) for k in range(max(1, len(words) - 9))} if words else set()
    left = {i: t for i, t in left.items() if not any(
        tuple(w[k:k + 10]) in windows for w in [decontam.words_of(t)] for k in range(len(w) - 9))}

    got = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, SF)
        assert got.columns == docs.columns
    kept = {r["doc_id"]: r for r in got.collect()}
    assert set(kept) == set(left)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.secret_spans(docs).collect()}
    assert all(r["text"] == left[i] for i, r in kept.items() if not spans[i])
    assert all("[SECRET]" in r["text"] for i, r in kept.items() if spans[i])

    ids = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECES)
    assert ids == {i: library.encode(r["text"]) for i, r in kept.items()}
