"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a three-letter
sequence binds (multiplies) its letters' vectors, the first rotated twice, the
second once. A text's vector bundles (adds) those of its sequences, a
language's prototype those of its training texts. A document gets the
language whose prototype has the highest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import is_held_out

RESULT = "struct<lang_pred:string,score:double>"
RESULT_TYPE = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
DIMENSIONS = 1024
SEED = 20_011
GAP = 32  # the space, which stands for any run of characters that are not letters
PART_CHARS = 500_000
KNOWN_SEQUENCES = 50_000
LETTERS: dict[tuple[int, int], np.ndarray] = {}


def letter_vector(letter: int, dimensions: int) -> np.ndarray:
    """The random vector of a code point, the same in every process."""
    key = (letter, dimensions)
    if key not in LETTERS:
        if len(LETTERS) > KNOWN_SEQUENCES:
            LETTERS.clear()
        signs = np.random.default_rng((SEED, letter)).integers(0, 2, dimensions)
        LETTERS[key] = (2 * signs - 1).astype(np.float32)
    return LETTERS[key]


def sequence_vectors(codes: np.ndarray, alphabet: np.ndarray, dimensions: int) -> np.ndarray:
    """The bound vector of each sequence code (three letter numbers of ``alphabet``)."""
    letters = np.stack([letter_vector(int(c), dimensions) for c in alphabet])
    size = len(alphabet)
    return (np.roll(letters, 2, axis=1)[codes // (size * size)]
            * np.roll(letters, 1, axis=1)[codes // size % size] * letters[codes % size])


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, sequence code) of every three-letter sequence, the alphabet, and whether a text has letters.

    Words are lower-cased; a gap stands before the first and after the last word.
    """
    lowered = [(t or "").lower() for t in texts]
    joined = "\x00".join(lowered)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    alphabet_in = np.unique(points) if len(points) < 4096 else np.flatnonzero(np.bincount(points, minlength=1))
    is_letter = np.array([chr(c).isalpha() for c in alphabet_in], dtype=bool)
    number = np.searchsorted(alphabet_in, points) if len(alphabet_in) > 100_000 else None
    if number is None:
        table = np.zeros(int(alphabet_in[-1]) + 1 if len(alphabet_in) else 1, dtype=np.int64)
        table[alphabet_in[is_letter]] = np.arange(1, is_letter.sum() + 1)
        symbol = table[points]
    else:
        rank = np.cumsum(is_letter) * is_letter
        symbol = rank[number]
    alphabet = np.concatenate(([GAP], alphabet_in[is_letter])).astype(np.int64)
    lengths = np.array([len(t) for t in lowered], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)[:len(points)]
    # Separators between texts are gaps like any other; runs of gaps become one.
    keep = np.ones(len(symbol), dtype=bool)
    keep[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0)
    symbol, owner = symbol[keep], owner[keep]
    symbol = np.concatenate(([0], symbol, [0]))
    owner = np.concatenate((owner[:1], owner, owner[-1:]))
    size = len(alphabet)
    codes = (symbol[:-2] * size + symbol[1:-1]) * size + symbol[2:]
    middle, of = symbol[1:-1] != 0, owner[1:-1]
    has_letters = np.bincount(of[middle], minlength=len(texts)) > 0 if len(of) else np.zeros(len(texts), bool)
    # A sequence belongs to the text of its middle letter; with a gap in the middle it would join two words.
    return of[middle], codes[middle], alphabet, has_letters


def bundles(texts: list[str | None], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The vector of each text, and whether it has a letter."""
    owner, codes, alphabet, has_letters = sequences(texts)
    if not len(codes):
        return np.zeros((len(texts), dimensions), dtype=np.float32), has_letters
    distinct, column = np.unique(codes, return_inverse=True) if len(alphabet) > 100 else compact(codes, len(alphabet) ** 3)
    out = np.zeros((len(texts), dimensions), dtype=np.float32)
    for start in range(0, len(distinct), KNOWN_SEQUENCES // 10):
        stop = min(start + KNOWN_SEQUENCES // 10, len(distinct))
        here = (column >= start) & (column < stop)
        counts = np.bincount(owner[here] * (stop - start) + column[here] - start, minlength=len(texts) * (stop - start))
        vectors = sequence_vectors(distinct[start:stop], alphabet, dimensions)
        out += counts.reshape(len(texts), -1).astype(np.float32) @ vectors
    return out, has_letters


def compact(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes below ``size`` and the number of each code among them, without sorting."""
    present = np.zeros(size, dtype=bool)
    present[codes] = True
    distinct = np.flatnonzero(present)
    number = np.zeros(size, dtype=np.int64)
    number[distinct] = np.arange(len(distinct))
    return distinct, number[codes]


def parts(texts: pa.Array, labels: pa.Array | None = None) -> Iterator[tuple[list, list]]:
    """The texts, and labels if any, in parts of bounded length; a longer text is a part of its own."""
    part, own, waiting = [], [], 0
    for i in range(len(texts)):
        text = texts[i].as_py()
        if part and waiting + len(text or "") > PART_CHARS:
            yield part, own
            part, own, waiting = [], [], 0
        part.append(text)
        own.append(labels[i].as_py() if labels is not None else None)
        waiting += len(text or "")
    if part:
        yield part, own


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype vectors from all documents with a language outside the held-out fold.

    Each task bundles its own documents, so that one vector for each language
    and task is all that is added up.
    """
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for texts, languages in parts(batch.column(0), batch.column(1)):
                order: dict[str, list] = {}
                for t, g in zip(texts, languages):
                    order.setdefault(g, []).append(t)
                # One joined text for each language: a separator is a gap like any other.
                vectors, _ = bundles(["\n".join(t or "" for t in own) for own in order.values()], dimensions)
                for g, v in zip(order, vectors):
                    sums[g] = sums.get(g, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(sums), pa.string()), "vector": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))})

    train = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(id_col))
    by_task = train.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(
        bundle, "lang string, vector array<double>")
    added = (by_task.select("lang", F.posexplode("vector").alias("at", "value"))
             .groupBy("lang", "at").agg(F.sum("value").alias("value"))
             .groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda s: s["value"]).alias("vector")))
    found = {r["lang"]: np.array(r["vector"]) for r in added.collect()}
    return {g: found[g] for g in sorted(found) if np.any(found[g])}


def language_column(prototypes: dict[str, np.ndarray], text: Column, dimensions: int = DIMENSIONS) -> Column:
    names = list(prototypes)
    unit = np.array([v / np.linalg.norm(v) for v in prototypes.values()], dtype=np.float32).reshape(len(names), dimensions)

    @F.arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        rows = []
        for part, _ in parts(texts):
            vectors, has_letters = bundles(part, dimensions)
            norms = np.linalg.norm(vectors, axis=1)
            cosine = vectors @ unit.T / np.maximum(norms, 1e-9)[:, None]
            for letters, scores in zip(has_letters, cosine):
                if not letters or not names:
                    rows.append({"lang_pred": "und", "score": 0.0})
                else:
                    best = int(scores.argmax())
                    rows.append({"lang_pred": names[best], "score": float(np.clip(scores[best], 0.0, 1.0))})
        return pa.array(rows, type=RESULT_TYPE)

    return predict(text)


def languages(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
              dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per document: ``id_col``, lang_pred, score (the cosine, at least 0).

    Defined cases: null texts, texts without a letter and a model without
    languages give ``und`` and score 0; equal cosines go to the first language by
    name; repeated rows give repeated rows; extra columns are not read.
    """
    judged = docs.select(F.col(id_col).alias("id"),
                         language_column(prototypes, F.col(text_col).cast("string"), dimensions).alias("j"))
    return judged.select(F.col("id").alias(id_col), "j.lang_pred", "j.score")
