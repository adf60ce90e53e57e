"""Exact duplicates, hard negatives and the prefix trie against plain Python, with their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidemark.llm import content_sort, hard_negatives, prefix_trie


@contextmanager
def settings(spark, **conf):
    """Small Arrow batches and many small partitions, so that groups cross the edges of both."""
    names = {"batch": "spark.sql.execution.arrow.maxRecordsPerBatch",
             "coalesce": "spark.sql.adaptive.coalescePartitions.enabled", "partitions": "spark.sql.shuffle.partitions"}
    before = {names[k]: spark.conf.get(names[k]) for k in conf}
    for k, v in conf.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# --- exact duplicates ------------------------------------------------------------

DOCS = "doc_id long, text string, id long, norm string, kept string, run int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 7, "n", "k", 1) for i, t in rows], DOCS)


def groups_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = Counter()
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        for n, i in enumerate(ids):
            out[(i, ids[0], len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


def groups_found(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_exact_groups_across_ranges_and_batches(spark, batch):
    rng = random.Random(batch)
    rows = [(i, rng.choice(["", None, "a", "a b", "a \t\n b", " a", "é", "\U0001f600 x", "common"] + ["common"] * 9)) for i in range(200)]
    rows += [(300 + i, "y" * 70 + str(i % 40)) for i in range(80)]  # the same first bytes
    rng.shuffle(rows)
    with settings(spark, batch=batch, coalesce="false", partitions=9):
        df = documents(spark, rows).repartition(5)
        assert groups_found(content_sort.exact_groups(df)) == groups_by_hand(rows)


def test_a_hot_text_is_spread_over_ranges(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(1000)]
    with settings(spark, coalesce="false", partitions=8):
        df = documents(spark, rows)
        key = ("prefix", "sha", F.col("id").asc_nulls_last(), "nth")
        seen = df.select(F.col("doc_id").alias("id"), content_sort.normalised(F.col("text")).alias("norm")).select(
            "id", F.sha2("norm", 256).alias("sha"), F.substring(F.col("norm").cast("binary"), 1, 64).alias("prefix"),
            F.monotonically_increasing_id().alias("nth")).repartitionByRange(*key)
        sizes = [r["count"] for r in seen.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1200
        assert groups_found(content_sort.exact_groups(df)) == groups_by_hand(rows)


def test_exact_groups_defined_cases(spark):
    rows = [(None, "x"), (None, "x"), (4, "x"), (4, "x"), (None, "only"), (1, None), (2, ""), (2, "\n"), (3, " ")]
    rows += [(9, "long " * 300_000), (8, "long  " * 300_000), (7, "long " * 300_000 + "!")]
    assert groups_found(content_sort.exact_groups(documents(spark, rows))) == groups_by_hand(rows)
    assert content_sort.exact_groups(documents(spark, [])).collect() == []
    named = spark.createDataFrame([("b", "t"), ("a", "t")], "name string, body string")
    assert {tuple(r)[:4] for r in content_sort.exact_groups(named, "name", "body").collect()} == {("a", "a", 2, True), ("b", "a", 2, False)}


def test_equal_digests_of_different_texts_do_not_join(spark):
    """With one digest for all texts only the full comparison of neighbours tells them apart."""
    rows = [(i, f"t{i % 7}") for i in range(60)]
    df = documents(spark, rows).select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("norm"), F.lit("0").alias("sha"))
    with settings(spark, batch=4, coalesce="false", partitions=1):
        found = df.repartition(1).sortWithinPartitions("norm", "id").mapInArrow(
            content_sort.runs_of_range, "id long, keep_id long, group_size long, kept boolean, text_sha256 string, "
                                        "range int, run int, text binary").collect()
    assert {(r["id"], r["keep_id"], r["kept"]) for r in found} == {(i, i % 7, i < 7) for i in range(60)}
    assert all(r["run"] is not None for r in found)  # all may go on in another range


# --- hard negatives --------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, id long, aid string, v int, shard int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, "a", 2, 3) for i, v, l in rows], VECTORS)


def mined_by_hand(rows, anchors, positives=5, per=10, low=30, high=90):
    import math
    good = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows
            if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, av, al in good:
        if a % anchors:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(av, v)), i, l) for i, v, l in good if i != a and len(v) == len(av)),
                        key=lambda r: r[:2])
        for p, pi, _ in [r for r in scored if r[2] == al][:positives]:
            inside = [(n, i) for n, i, l in scored if l != al and low * -p <= 100 * -n <= high * -p][:per]
            for rank, (n, i) in enumerate(inside, 1):
                out[(a, pi, rank, i, -p, -n)] += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_hard_negatives_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    # Few distinct values: many equal scores, zero scores and copies.
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(3)], rng.randrange(3)) for i in range(150)]
    rows += rows[:20] + [(i, [1.0, 1.0], i % 2) for i in range(200, 230)]
    rows += [(300, None, 1), (301, [], 1), (302, [float("nan"), 1.0, 1.0], 1), (303, [None, 1.0, 1.0], 1), (310, [1.0, 1.0, 1.0], None),
             (None, [1.0, 1.0, 1.0], 1), (320, [float("inf"), 0.0, 0.0], 0)]
    with settings(spark, batch=rng.choice([5, 64, 10000])):
        found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, shard_rows=rng.choice([20, 60, 1000]))
        assert Counter(tuple(r) for r in found.collect()) == mined_by_hand(rows, 10)


def test_hard_negatives_defined_cases(spark):
    every = F.col("vec_id") % 1 == 0
    assert hard_negatives.hard_negatives(vectors(spark, []), every).collect() == []
    assert hard_negatives.hard_negatives(vectors(spark, [(0, [1.0], 1)]), every).collect() == []
    # No positive, or none that a negative fits.
    assert hard_negatives.hard_negatives(vectors(spark, [(0, [1.0], 1), (1, [1.0], 2), (2, [-1.0], 1)]), F.col("vec_id") == 0).collect() == []
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(vectors(spark, []), every, high=101)


def test_packed_keys_sort_as_their_parts():
    rng = random.Random(5)
    parts = [(rng.randrange(3), rng.choice([-(1 << 62), -1, 0, 1, 1 << 62]), rng.randrange(2), rng.choice([-(1 << 63), -5, 0, 9, (1 << 63) - 1]))
             for _ in range(300)]
    keys = sorted(hard_negatives.packed(*p) for p in parts)
    assert [hard_negatives.unpacked(k) for k in keys] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))


# --- the prefix trie -------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, conv string, key string, id long, n int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "c", "k", 1, 2) for r in rows], TURNS)


def turns_by_hand(rows, rebuild):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [r[3:] for r in sorted(v)] for c, v in own.items()}
    if not rebuild:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_by_hand(rows, rebuild=True):
    convs = turns_by_hand(rows, rebuild)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for node, of in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        ends = ",".join(str(c) for c in sorted(c for c in of if len(convs[c]) == len(node)))
        saved = sum((len(members[n]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", n[-1][1])) for n in below if n)
        leaves = sum(not any(m[:-1] == n for m in below if m) for n in below)
        out.add((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(kids), leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_found(df):
    rows = df.collect()
    assert sorted([r["enter"] for r in rows] + [r["exit"] for r in rows]) == list(range(1, 2 * len(rows) + 1))
    assert len({tuple(r)[:8] for r in rows}) == len(rows)
    return {tuple(r)[:8] for r in rows}


@pytest.mark.parametrize("seed", range(4))
def test_trie_equals_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    # Few texts, so that conversations share turns; gaps, repeated and null turns.
    rows = [(c, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", "", None, " c\td e "]))
            for c in rng.sample(range(-50, 130), 60) for t in range(rng.randrange(1, 9))]
    rows += rows[:10] + [(None, 1, "user", "lost")] * 3
    rows += [(41, 100 + t, "user", "again") for t in range(40)]
    rng.shuffle(rows)
    monkeypatch.setattr(prefix_trie, "BLOCK", rng.choice([1, 2, 5, 4096]))
    with settings(spark, batch=rng.choice([2, 7, 10000]), coalesce="false", partitions=rng.choice([1, 3, 7])):
        df = conversations(spark, rows).repartition(3)
        assert trie_found(prefix_trie.prefix_trie(df)) == trie_by_hand(rows)
        if seed < 2:
            assert trie_found(prefix_trie.prefix_trie(df, rebuild=False)) == trie_by_hand(rows, False)


def test_trie_of_one_long_conversation_and_many_copies(spark, monkeypatch):
    """A third of the rows in one conversation, and a root and an end that most conversations share."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [(20, t, "user", f"turn {t}") for t in range(150)]
    rows += [(1000 + 20 * c, 0, "system", "the same start") for c in range(120)]
    rows += [(5000 + 20 * c, 0, "user", f"alone {c}") for c in range(80)]
    with settings(spark, coalesce="false", partitions=6):
        assert trie_found(prefix_trie.prefix_trie(conversations(spark, rows), rebuild=False)) == trie_by_hand(rows, False)


def test_trie_defined_cases(spark):
    assert prefix_trie.prefix_trie(conversations(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(conversations(spark, [(None, 1, "user", "x")])).collect() == []
    # crc32("1") % 4 is 3: the two own turns go, and conversation 0 is absent.
    rows = [(1, 0, "user", "x"), (1, 1, "user", "y")]
    assert zlib.crc32(b"1") % 4 == 3
    assert trie_found(prefix_trie.prefix_trie(conversations(spark, rows))) == {
        (1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())}
    # Role and text do not run into each other; a text of a megabyte.
    rows = [(0, 0, "ab", "c"), (20, 0, "a", "bc"), (40, 0, "", "abc"), (60, 0, "user", "word " * 250_000), (80, 0, "user", "word " * 250_000)]
    assert trie_found(prefix_trie.prefix_trie(conversations(spark, rows))) == trie_by_hand(rows)
