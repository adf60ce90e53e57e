"""Toxic span tagging with a linear-chain conditional random field.

Two states, clean and offending. Labels exist for documents only, so tokens are
labelled first: in a toxic training document a token offends if its word, or a
prefix of it, is much more frequent among toxic than among clean documents; all
other tokens are clean. The field learns weights of hashed word and affix
features and of the transitions. Exact forward-backward marginals give spans
(tokens more likely offending than not) and, through a small logistic model over
their sum and density, a score for each document.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_name, is_held_out

RESULT = "struct<score:double,predicted:int,spans:array<struct<start:int,end:int,p:float>>>"
RESULT_TYPE = pa.struct([
    ("score", pa.float64()), ("predicted", pa.int32()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float32())])))])
BUCKETS = 1 << 18
TOKEN_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TOKEN = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
BATCH_TOKENS = 1_000_000
CACHED_WORDS = 400_000
TRAIN_STRETCH = 200


def tokens_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TOKEN_BYTES).split() if text else []


def features(token: bytes) -> list[int]:
    """Hashed features: the word, its prefixes of four to six letters, its last three letters."""
    word = token.decode(errors="replace").lower()
    names = ["w" + word, "e" + word[-3:], *(f"{n}{word[:n]}" for n in (4, 5, 6) if len(word) > n)]
    return [zlib.crc32(n.encode()) % BUCKETS for n in names]


class Chains:
    """Sequences laid out by time: step t holds the sequences longer than t, longest first."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        sizes = lengths[order]
        steps = int(sizes[0]) if sizes.size else 0
        self.active = np.searchsorted(-sizes, -np.arange(steps), side="left")
        self.offset = np.concatenate(([0], np.cumsum(self.active)))
        begins = np.cumsum(lengths) - lengths
        time = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
        rank = np.empty(len(lengths), dtype=np.int64)
        rank[order] = np.arange(len(lengths))
        self.place = self.offset[time] + np.repeat(rank, lengths)

    def marginals(self, emission: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of the offending state at each token; expected counts of the four transitions.

        ``emission`` and the messages are log odds of the offending state, in
        which the two-state recursions are exact.
        """
        w = np.exp(transition)
        e = np.empty_like(emission)
        e[self.place] = emission
        forward, ahead = np.empty_like(e), np.zeros_like(e)
        steps = len(self.active)
        for t in range(steps):
            here = slice(self.offset[t], self.offset[t + 1])
            if t == 0:
                forward[here] = e[here]
                continue
            a = np.exp(forward[self.offset[t - 1]:self.offset[t - 1] + self.active[t]])
            forward[here] = np.clip(e[here] + np.log((w[0, 1] + w[1, 1] * a) / (w[0, 0] + w[1, 0] * a)), -60, 60)
        pairs = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            n = self.active[t + 1]
            follow = slice(self.offset[t + 1], self.offset[t + 1] + n)
            b = np.exp(np.clip(e[follow] + ahead[follow], -60, 60))
            here = slice(self.offset[t], self.offset[t] + n)
            ahead[here] = np.log((w[1, 0] + w[1, 1] * b) / (w[0, 0] + w[0, 1] * b))
            a = np.exp(forward[here])
            terms = (w[0, 0], w[0, 1] * b, w[1, 0] * a, w[1, 1] * a * b)
            total = terms[0] + terms[1] + terms[2] + terms[3]
            pairs += np.array([np.sum(x / total) for x in terms]).reshape(2, 2)
        return (1 / (1 + np.exp(-np.clip(forward + ahead, -60, 60))))[self.place], pairs


class Adam:
    def __init__(self, shape, rate: float):
        self.rate, self.m, self.v, self.n = rate, np.zeros(shape), np.zeros(shape), 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.n += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient ** 2
        return -self.rate * (self.m / (1 - 0.9 ** self.n)) / (np.sqrt(self.v / (1 - 0.99 ** self.n)) + 1e-8)


def offending(documents: list[list[bytes]], toxic: np.ndarray, odds: float = 7.0, support: int = 2) -> set[int]:
    """Features that are at least ``odds`` times as frequent among toxic documents, by smoothed document counts."""
    bad, good = Counter(), Counter()
    for tokens, label in zip(documents, toxic):
        (bad if label else good).update({f for w in set(tokens) for f in features(w) if f is not None})
    scale = (len(documents) - toxic.sum() + 1) / (toxic.sum() + 1)
    return {f for f, n in bad.items() if n >= support and (n + 0.5) / (good[f] + 0.5) * scale >= odds}


class Model:
    """Weights of the field and of the document model; ``fit`` learns them from whole texts."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS)
        self.bias = -6.0
        self.transition = np.zeros((2, 2))
        self.document = np.array([-30.0, 0.0, 0.0])
        self.cache: dict[bytes, float] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "cache": {}, "weights": self.weights.astype(np.float32)}

    def fit(self, texts: list[str | None], labels: list[int], clean_weight: float = 1.0, rounds: int = 40,
            decay: float = 1e-3) -> Model:
        toxic = np.array(labels, dtype=bool)
        if not toxic.any():
            return self  # nothing to learn: every score stays near 0
        if toxic.all():
            self.document = np.array([30.0, 0.0, 0.0])
            return self
        documents = [tokens_of(t) for t in texts]
        marks = offending(documents, toxic)
        number: dict[bytes, int] = {}
        words = np.fromiter((number.setdefault(w, len(number)) for d in documents for w in d), dtype=np.int64)
        own = [features(w) for w in number]
        sizes = np.array([len(x) for x in own], dtype=np.int64)
        feature = np.fromiter((f for x in own for f in x), dtype=np.int64, count=int(sizes.sum()))
        of_word = np.repeat(np.arange(len(number)), sizes)
        # The word itself, or its six-letter prefix, marks a token; wider prefixes only weigh in.
        marked = np.array([x[0] in marks or (len(x) == 5 and x[4] in marks) for x in own], dtype=bool)
        lengths = np.array([len(d) for d in documents], dtype=np.int64)
        truth = (marked[words] & np.repeat(toxic, lengths)).astype(float)
        cuts = np.concatenate([np.minimum(TRAIN_STRETCH, n - np.arange(0, n, TRAIN_STRETCH)) for n in lengths]
                              or [np.empty(0)]).astype(np.int64)
        chains = Chains(cuts)
        begins = np.cumsum(cuts) - cuts
        inside = np.ones(len(words), dtype=bool)
        inside[begins[cuts > 0]] = False
        seen = np.zeros((2, 2))
        after = np.flatnonzero(inside)
        np.add.at(seen, (truth[after - 1].astype(int), truth[after].astype(int)), 1)
        adam_w, adam_b, adam_t = Adam(BUCKETS, 0.3), Adam(1, 0.3), Adam((2, 2), 0.1)
        scale = max(1.0, truth.sum())
        for _ in range(rounds):
            emission = self.bias + np.bincount(of_word, self.weights[feature], len(number))
            p, pairs = chains.marginals(emission[words], self.transition)
            by_word = np.bincount(words, p - truth, len(number))
            slope = np.bincount(feature, by_word[of_word], BUCKETS) / scale
            self.weights += adam_w.step(slope + decay * self.weights)
            self.bias += float(adam_b.step(np.array([(p - truth).sum() / scale]))[0])
            self.transition += adam_t.step((pairs - seen) / scale + decay * self.transition)
        self.cache = {}
        x = np.array([self.summary(p) for p in self.token_marginals(documents)])
        weight = np.where(toxic, 1.0, clean_weight)
        theta, ridge = np.zeros(3), 1e-2 * np.eye(3)
        for _ in range(30):
            q = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            curve = x.T @ (x * (weight * q * (1 - q))[:, None]) + ridge
            theta -= np.linalg.solve(curve, x.T @ (weight * (q - toxic)) + ridge @ theta)
        self.document = theta
        return self

    @staticmethod
    def summary(p: np.ndarray) -> np.ndarray:
        """What the document model sees: a constant, the log of expected offending tokens, their log density."""
        expected = float(p.sum()) if p.size else 0.0
        return np.array([1.0, np.log(expected + 0.01), np.log((expected + 0.01) / (p.size + 20))])

    def emission(self, token: bytes) -> float:
        value = self.bias + float(self.weights[features(token)].sum())
        if len(self.cache) >= CACHED_WORDS:
            self.cache.clear()
        self.cache[token] = value
        return value

    def token_marginals(self, documents: list[list[bytes]]) -> list[np.ndarray]:
        lengths = np.array([len(d) for d in documents], dtype=np.int64)
        known = self.cache.get
        emission = np.empty(int(lengths.sum()))
        at = 0
        for d in documents:
            values = [known(w) for w in d]
            emission[at:at + len(d)] = [self.emission(w) if v is None else v for v, w in zip(values, d)] \
                if None in values else values
            at += len(d)
        if not at:
            return [np.empty(0)] * len(documents)
        p, _ = Chains(lengths).marginals(emission, self.transition)
        return np.split(p, np.cumsum(lengths)[:-1])

    def judge(self, texts: list[str | None]) -> list[dict]:
        documents = [tokens_of(t) for t in texts]
        rows = []
        for text, p in zip(texts, self.token_marginals(documents)):
            score = float(1 / (1 + np.exp(-np.clip(self.summary(p) @ self.document, -30, 30))))
            spans = []
            if p.size and p.max() >= 0.5:
                for m, q in zip(TOKEN.finditer(text), p):
                    if q >= 0.5:
                        spans.append({"start": m.start(), "end": m.end(), "p": float(q)})
            rows.append({"score": score, "predicted": int(score >= 0.5), "spans": spans})
        return rows


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = 1000) -> Model:
    """Learn from at most ``per_class`` toxic and as many clean documents, by the hash order of their ids.

    Only labelled documents outside the held-out fold are used. The labels of
    all of them are counted, to weigh the two classes as they occur.
    """
    usable = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(id_col))
              .groupBy(F.col(id_col).alias("labelled_id")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ids = None
    for label in (0, 1):
        part = (usable.filter(F.col("label") == label)
                .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(per_class))
        ids = part if ids is None else ids.unionAll(part)
    chosen = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(ids), F.col("id") == F.col("labelled_id"))
              .select("id", "text", "label").dropDuplicates(["id"]).collect())
    chosen.sort(key=lambda r: r["id"])
    drawn = Counter(r["label"] for r in chosen)
    clean_weight = (counts.get(0, 0) / max(1, drawn[0])) / (max(1, counts.get(1, 0)) / max(1, drawn[1]))
    return Model().fit([r["text"] for r in chosen], [r["label"] for r in chosen], max(clean_weight, 1e-3))


def judgement_column(model: Model, text: Column) -> Column:
    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        rows: list[dict] = []
        part: list[str | None] = []
        waiting = 0
        for t in texts:
            part.append(t.as_py())
            waiting += len(part[-1] or "")
            if waiting >= 6 * BATCH_TOKENS:
                rows += model.judge(part)
                part, waiting = [], 0
        if part:
            rows += model.judge(part)
        return pa.array(rows, type=RESULT_TYPE)

    return judge(text)


def toxic_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, score (0 to 1), predicted (1 from 0.5), spans (code points, end exclusive).

    Defined cases: a null or empty text, or one without words, has no spans and
    the score of zero expected offending tokens; repeated rows give repeated
    rows; without any toxic training document every score is near 0.
    """
    judged = docs.select(F.col(id_col).alias("id"),
                         judgement_column(model, F.col(text_col).cast("string")).alias("j"))
    return judged.select(F.col("id").alias(id_col), "j.score", "j.predicted", "j.spans")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, all columns kept."""
    name = fresh_name(docs, "judgement")
    judged = docs.withColumn(name, judgement_column(model, F.col(text_col).cast("string"))["predicted"])
    return judged.filter(F.col(name) == 0).drop(name)
