"""SimHash near-duplicate detection with pigeonring candidate filtering.

Fingerprints are cut into ``segments`` parts that form a ring. If two
fingerprints differ in at most t bits in total, some part starts a chain whose
cumulative differences stay within the proportional budget for every length:
the first l parts differ in at most l * t / segments bits. While that budget is
below one bit the parts must be equal, so the longest such run is an equality
key; the budgets of the longer chains prune the candidates that share a key, and
only the survivors reach the full Hamming check.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, fresh_name

BITS = 64
SEED = 42
# Shingles unpacked at a time: 64 bytes each, so a very long text needs 4 MB.
UNPACK_ROWS = 65_536


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """SimHash of one text as a signed 64-bit integer (0 for a text without words)."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
        n = len(words) - shingle_words + 1
    ones = np.zeros(BITS, dtype=np.int64)
    hashes = (xxhash.xxh64_intdigest(s, SEED) for s in shingles)
    while (block := np.fromiter(itertools.islice(hashes, UNPACK_ROWS), dtype=np.uint64)).size:
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprint_column(text_col: str, shingle_words: int = 3) -> Column:
    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), shingle_words) for t in texts], type=pa.int64())

    return fingerprints(F.col(text_col).cast("string"))


def segment_edges(segments: int) -> list[int]:
    return [round(i * BITS / segments) for i in range(segments + 1)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def chain_masks(segments: int, start: int) -> list[int]:
    """Bit masks of the chains of 1, 2, ... ``segments`` parts from part ``start``."""
    edges, masks, mask = segment_edges(segments), [], 0
    for k in range(segments):
        part = (start + k) % segments
        mask |= (1 << edges[part + 1]) - (1 << edges[part])
        masks.append(mask)
    return masks


def ring_keys(fp: Column, segments: int, max_bits: int) -> Column:
    """One struct(part, bits) per part: the equal run that a chain from it requires."""
    run = max((n for n in range(1, segments + 1) if n * max_bits < segments), default=1)
    return F.array(*[
        F.struct(F.lit(start).alias("part"),
                 fp.bitwiseAND(F.lit(signed(chain_masks(segments, start)[run - 1]))).alias("bits"))
        for start in range(segments)])


def chain_holds(diff: Column, part: Column, segments: int, max_bits: int) -> Column:
    """Whether every chain from ``part`` stays within its proportional budget."""
    check = F.lit(False)
    for start in range(segments):
        within = F.lit(True)
        masks = chain_masks(segments, start)
        for length, mask in enumerate(masks, 1):
            budget = length * max_bits // segments
            following = (length + 1) * max_bits // segments
            if length == segments or following > budget:  # the longest chain of each budget implies the rest
                within = within & (F.bit_count(diff.bitwiseAND(F.lit(signed(mask)))) <= budget)
        check = check | ((part == start) & within)
    return check


def linked_pairs(fps: DataFrame, max_bits: int, segments: int, bucket_limit: int) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp`` within ``max_bits``.

    Buckets of one key with up to ``bucket_limit`` fingerprints are compared
    pairwise, so each row meets a bounded number of others. Fingerprints of a
    larger bucket are instead dealt to the points half the distance away: two of
    them are within an even ``max_bits`` exactly if they meet at such a point, and
    all that meet there are linked to the smallest, which keeps every connection
    without a pair for each two members. A point meets at most as many
    fingerprints as there are points in its ball (65 for two bits).
    """
    fps = fps.select("fp")
    keys = fps.select("fp", F.explode(ring_keys(F.col("fp"), segments, max_bits)).alias("k")).select(
        "fp", "k.part", "k.bits")
    sizes = keys.groupBy("part", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut(keys.join(sizes, ["part", "bits"]))

    few = shared.filter(F.col("n") <= bucket_limit)
    left = few.select("part", "bits", F.col("fp").alias("a"))
    right = few.select("part", "bits", F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (left.join(right, ["part", "bits"])
             .filter(F.col("a") < F.col("b"))
             .filter(chain_holds(diff, F.col("part"), segments, max_bits))
             .filter(F.bit_count(diff) <= max_bits)
             .select("a", "b").distinct())

    hot = shared.filter(F.col("n") > bucket_limit).select("fp").distinct()
    flips = [0]
    for size in range(1, max_bits // 2 + 1):
        flips += [signed(sum(1 << b for b in chosen)) for chosen in itertools.combinations(range(BITS), size)]
    points = hot.select("fp", F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp")
    met = points.groupBy("point").agg(F.sort_array(F.collect_list("fp")).alias("fps")).filter(F.size("fps") > 1)
    stars = met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, F.size("fps"))).alias("b"))
    return pairs.union(stars).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) can reach.

    Every round hooks each node to its smallest neighbour, follows those hooks
    to their ends by pointer jumping and contracts the links, until none is left.
    """
    links = cut(links)
    labels = cut(links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
                 .withColumn("root", F.col("node")))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = cut(both.groupBy("a").agg(F.min("b").alias("p"))
                    .select("a", F.least("a", "p").alias("p")))
        moved = True
        while moved:
            ahead = hooks.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            hooks = cut(hooks.join(ahead, "p").select("a", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")))
            moved = not hooks.filter("moved").isEmpty()
            hooks = hooks.select("a", "p")
        labels = cut(labels.join(hooks.withColumnRenamed("a", "root"), "root", "left")
                     .select("node", F.coalesce("p", "root").alias("root")))
        ends = hooks.select(F.col("a").alias("b"), F.col("p").alias("q"))
        links = cut(links.join(hooks, "a").join(ends, "b").filter("p <> q")
                    .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())
    return labels


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = 3, max_bits: int = 2, segments: int = 16,
                       bucket_limit: int = 32) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` (signed 64-bit fingerprint), ``component_id``.

    ``component_id`` is the smallest identifier that a document reaches over
    links of at most ``max_bits`` differing bits (0, 2 or 4), itself included.

    Defined cases: a null text counts as empty; texts without words have
    fingerprint 0 and are linked like any other; a repeated row gives a repeated
    result row; a null identifier is never the smallest one, and a component
    without any other has a null ``component_id``; an empty table gives no rows;
    extra columns are not read. Copies share one fingerprint, which is
    pre-aggregated, so neither they nor near copies are expanded into pairs.
    """
    if max_bits not in (0, 2, 4):
        raise ValueError("max_bits must be 0, 2 or 4")
    rows = cut(docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col, shingle_words).alias("fp")))
    first = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = connected_components(linked_pairs(first, max_bits, segments, bucket_limit))
    linked = roots.join(first, roots["node"] == first["fp"]).select("node", "root", "first_id")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_linked = linked.join(smallest, "root").select(F.col("node").alias("fp"), "component_id")
    component = first.join(of_linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.join(component, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` with one document of each component, all columns kept.

    The smallest identifier of a component stays; among rows of one identifier
    (or of none) the smallest text hash decides, and of fully equal rows one stays.
    Identifiers may be numbers or strings; an empty table stays empty.
    """
    none = F.lit("0").cast(docs.select(id_col).schema[0].dataType)
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col), none).alias("id"),
                   F.xxhash64(F.col(text_col).cast("string")).alias("h"))
    found = simhash_components(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", **options)
    keep = cut(found.filter(F.col("key") == F.col("component_id")).groupBy("key").agg(F.count("*").alias("copies")))
    kept, row = fresh_name(docs, "kept_key"), fresh_name(docs, "row_key")
    once = keep.filter("copies = 1").select(F.col("key").alias(kept))
    again = keep.filter("copies > 1").select(F.col("key").alias(kept))
    single = docs.join(once, key == F.col(kept), "left_semi")
    if again.isEmpty():
        return single
    repeated = docs.withColumn(row, key).join(again, F.col(row) == F.col(kept), "left_semi")
    return single.unionByName(repeated.dropDuplicates([row]).drop(row))
