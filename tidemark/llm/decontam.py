"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are the word windows of the benchmark items. The search runs on
word numbers, with blocks of two words: a shift table says how far the search may
jump past a block that ends no test string; a block with shift zero selects, by
its hash bucket, the test strings that end in it, and these are compared word by
word. Many positions advance at once: the words of a batch are one array, dealt
to cursors that each scan an equal stretch.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

RESULT = "struct<n_words:bigint,n_hit:bigint,items:array<string>,ranges:array<struct<first:int,last:int>>>"
RESULT_TYPE = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("ranges", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])
# Bytes of words: digits, letters and every byte of a non-ASCII character; the rest separates.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
STRETCH = 512
BATCH_WORDS = 1_000_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class Patterns:
    """The tables of all test strings of one length."""

    def __init__(self, length: int, strings: np.ndarray, owners: np.ndarray, width: int):
        self.length, self.strings, self.owners, self.width = length, strings, owners, width
        self.block = min(2, length)
        ends = np.arange(self.block - 1, length)
        codes = self.codes_at(strings.ravel(), (np.arange(len(strings))[:, None] * length + ends).ravel())
        shifts = np.tile(length - 1 - ends, len(strings))
        order = np.lexsort((shifts, codes))
        self.codes, first = np.unique(codes[order], return_index=True)
        self.shifts = shifts[order][first]
        self.longest_jump = length - self.block + 1
        suffix = np.searchsorted(self.codes, codes.reshape(len(strings), -1)[:, -1])
        self.bucket = np.argsort(suffix, kind="stable")
        self.bucket_size = np.bincount(suffix, minlength=len(self.codes))
        self.bucket_start = np.cumsum(self.bucket_size) - self.bucket_size

    def codes_at(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return words[ends] if self.block == 1 else words[ends - 1] * self.width + words[ends]

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, test string) of every occurrence in ``words``."""
        at = np.arange(self.length - 1, len(words), STRETCH)
        stop = np.minimum(at + STRETCH, len(words))
        starts, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while at.size:
            code = self.codes_at(words, at)
            slot = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            jump = np.where(self.codes[slot] == code, self.shifts[slot], self.longest_jump)
            here = np.flatnonzero(jump == 0)
            if here.size:
                sizes = self.bucket_size[slot[here]]
                begin = np.repeat(at[here] - self.length + 1, sizes)
                within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                string = self.bucket[np.repeat(self.bucket_start[slot[here]], sizes) + within]
                same = words[begin] == self.strings[string, 0]  # the first word, before the whole string
                begin, string = begin[same], string[same]
                same = (words[begin[:, None] + np.arange(self.length)] == self.strings[string]).all(axis=1)
                starts.append(begin[same])
                found.append(string[same])
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        return np.concatenate(starts), np.concatenate(found)


class Benchmark:
    """Search tables of benchmark items: windows of ``window`` words, or an item's all if fewer."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int = 10):
        self.names: list[str | None] = []
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[int, list[int]]]] = {}
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if words:
                length = min(window, len(words))
                for i in range(len(words) - length + 1):
                    by_length.setdefault(length, []).append((len(self.names), words[i:i + length]))
                self.names.append(name)
        self.patterns = [
            Patterns(length, np.array([s for _, s in rows], dtype=np.int64), np.array([o for o, _ in rows]),
                     len(self.vocabulary) + 1)
            for length, rows in sorted(by_length.items())]

    def scan(self, documents: list[list[bytes]]) -> list[tuple[list, list]]:
        """For each document its items and the merged ranges of words that are hit."""
        sizes = np.array([len(d) for d in documents], dtype=np.int64)
        # A separator, word number 0, follows each document: no test string holds it.
        begins = np.cumsum(sizes + 1) - sizes - 1
        number = self.vocabulary.get
        words = np.zeros(int(sizes.sum()) + len(documents), dtype=np.int64)
        for begin, document in zip(begins.tolist(), documents):
            words[begin:begin + len(document)] = [number(w, 0) for w in document]
        results: list[tuple[list, list]] = [([], []) for _ in documents]
        change = np.zeros(len(words) + 1, dtype=np.int64)
        owners = set()
        for p in self.patterns:
            starts, found = p.search(words)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + p.length, -1)
            owner = np.searchsorted(begins, starts, side="right") - 1
            owners.update(zip(owner.tolist(), p.owners[found].tolist()))
        for document, item in owners:
            if self.names[item] is not None:
                results[document][0].append(self.names[item])
        hit = np.concatenate(([0], (np.cumsum(change)[:-1] > 0).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(hit))
        firsts, lasts = edges[::2], edges[1::2]
        owner = np.searchsorted(begins, firsts, side="right") - 1
        for document, a, b in zip(owner.tolist(), (firsts - begins[owner]).tolist(), (lasts - begins[owner]).tolist()):
            results[document][1].append((a, b))
        return results


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def hits_column(bench: Benchmark, text: Column, earlier: Column) -> Column:
    @F.arrow_udf(RESULT)
    def hits(texts: pa.Array, before: pa.Array) -> pa.Array:
        rows: list[dict] = []
        part: list[list[bytes]] = []
        waiting = 0

        def flush() -> None:
            nonlocal part, waiting
            for words, (items, ranges) in zip(part, bench.scan(part)):
                old = before[len(rows)].as_py()
                items = sorted({*items, *(old["items"] if old else ())})
                ranges = merged([*ranges, *((r["first"], r["last"]) for r in old["ranges"])] if old else ranges)
                rows.append({"n_words": len(words), "n_hit": sum(b - a for a, b in ranges), "items": items,
                             "ranges": [{"first": a, "last": b} for a, b in ranges]})
            part, waiting = [], 0

        for text in texts:
            part.append(words_of(text.as_py()))
            waiting += len(part[-1])
            if waiting >= BATCH_WORDS:
                flush()
        flush()
        return pa.array(rows, type=RESULT_TYPE)

    return hits(text, earlier)


def with_hits(docs: DataFrame, benchmark: DataFrame, result_col: str, text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10,
              block_chars: int = 1_000_000) -> DataFrame:
    """``docs`` and a column ``result_col``: n_words, n_hit, items (sorted ids), ranges (of hit words, last exclusive).

    The benchmark is the query set: it is searched in blocks of about
    ``block_chars`` characters, each with tables of bounded size, against all
    documents. One block is the usual case; beyond it each pass adds to the last
    one's result, which is kept in shared storage.

    Defined cases: a null text has no words; an item without words matches
    nothing; an item with a null id hits words but is not listed; repeated items
    count once; repeated documents give repeated rows; an empty benchmark hits nothing.
    """
    items = benchmark.select(F.col(item_id_col).cast("string").alias("item"),
                             F.col(item_text_col).cast("string").alias("words"))
    chars = items.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    out = docs.withColumn(result_col, F.lit(None).cast(RESULT))
    for block in range(blocks):
        own = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        bench = Benchmark([(r["item"], r["words"]) for r in own.toLocalIterator()], window)
        out = out.withColumn(result_col, hits_column(bench, F.col(text_col).cast("string"), F.col(result_col)))
        if blocks > 1:
            out = cut(out)
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_hit, items, ranges, contaminated. See ``with_hits``."""
    found = with_hits(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), benchmark, "hits", **options)
    return found.select(F.col("id").alias(id_col), "hits.n_words", "hits.n_hit", "hits.items", "hits.ranges",
                        (F.col("hits.n_hit") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, all columns kept."""
    name = "hits"
    while name in docs.columns:
        name = f"_{name}"
    return with_hits(docs, benchmark, name, **options).filter(F.col(name)["n_hit"] == 0).drop(name)
