"""The prefix trie of conversations, measured along its Euler tour.

A node is a distinct sequence of first turns. Its name is a digest chained over the
turns in blocks, so that a conversation of any length is named by many tasks. Every
node gives the tour an enter and an exit arc; the tour's successor of each arc
follows from first children and next siblings. The tour is list-ranked in two
steps: arcs in a range of neighbouring conversations are joined to chains within
one task, and the chains are ranked by pointer jumping. What lies between a node's
two arcs is its subtree, so leaves and savings are differences of sums along the
tour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 4096
OUT_ROWS = 1 << 16


def root_key() -> Column:
    """The name of the node without turns."""
    return F.lit("").cast("binary")


def decimal(col: Column) -> Column:
    return col.cast("string")


def turn_digest() -> Column:
    """Digest of role and text; the role's length keeps the two apart."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    return F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)), 256))


def positions(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), digest, words and the number n of the conversation's turns.

    Rows are range-partitioned by conversation and turn, which splits a long
    conversation; a row's place is that in its range plus the rows in ranges before.
    """
    rows = turns.select("conv", "turn", turn_digest().alias("digest"),
                        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("words"),
                        F.monotonically_increasing_id().alias("nth"))
    placed = stored(rows.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "digest", "nth")
                    .withColumn("range", F.spark_partition_id()), "turns")
    runs = placed.groupBy("range", "conv").agg(F.count("*").alias("held"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("range", "conv", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("earlier"),
                       F.sum("held").over(Window.partitionBy("conv")).alias("n"))
    order = Window.partitionBy("range", "conv").orderBy(F.col("turn").asc_nulls_first(), "digest", "nth")
    return (placed.withColumn("local", F.row_number().over(order)).join(runs, ["range", "conv"])
            .select("conv", (F.col("local") + F.col("earlier")).alias("pos"), "n", "digest", "words"))


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of conversations as they stand: conv, pos, length, digest, words; conv, length."""
    own = cut(positions(turns))
    members = own.groupBy("conv").agg(F.max("n").alias("length"))
    return own.select("conv", "pos", F.col("n").alias("length"), "digest", "words"), members


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, members) after every conversation c has taken its first turns from conversation c - c % group.

    h = crc32(decimal c) % most turns are taken (all if there are fewer, none if that
    conversation is absent); c's own turns after its first h follow.
    """
    own = cut(positions(turns))
    counts = own.groupBy("conv").agg(F.max("n").alias("n"))
    told = counts.select("conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"),
                         (F.crc32(decimal(F.col("conv")).cast("binary")) % most).alias("h"))
    bases = counts.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    told = told.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    told = cut(told.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
               .select("conv", "base", "h", "k", "length"))
    # Only the first turns of bases go to other conversations: fewer than ``most`` rows each, to ``group`` conversations or so.
    heads = own.filter((F.col("pos") < most) & (F.col("conv") % group == 0)).select(F.col("conv").alias("base"), "pos", "digest", "words")
    taken = told.filter("k > 0").join(heads, "base").filter("pos <= k").select("conv", "pos", "length", "digest", "words")
    # The join's key has the block of the turn in it, so a long conversation meets its few numbers in many tasks.
    spans = own.groupBy("conv", F.floor((F.col("pos") - 1) / BLOCK).alias("block")).agg(F.count("*").alias("rows"))
    spans = spans.join(told.select("conv", "h", "k", "length"), "conv").drop("rows")
    kept = (own.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK)).join(spans, ["conv", "block"]).filter("pos > h")
            .select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "length", "digest", "words"))
    return taken.unionByName(kept), told.select("conv", "length")


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the chained digest of every row's block up to it (``local``) and up to the row before (``ahead``)."""
    key, state = None, b""
    for batch in batches:
        convs, blocks = batch.column("conv").to_pylist(), batch.column("block").to_pylist()
        local, ahead = [], []
        for conv, block, digest in zip(convs, blocks, batch.column("digest").to_pylist()):
            if (conv, block) != key:
                key, state = (conv, block), b""
            ahead.append(state)
            state = hashlib.sha256(state + digest).digest()
            local.append(state)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv", "block", "pos", "length", "words")]
            + [pa.array(local, pa.binary()), pa.array(ahead, pa.binary())],
            names=["conv", "block", "pos", "length", "words", "local", "ahead"])


def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the digests of a conversation's blocks in order: the name of the node before each block."""
    conv, state = None, b""
    for batch in batches:
        out = []
        for c, digest in zip(batch.column("conv").to_pylist(), batch.column("local").to_pylist()):
            if c != conv:
                conv, state = c, b""
            out.append(state)
            state = hashlib.sha256(state + digest).digest()
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(out, pa.binary())],
                                         names=["conv", "block", "seed"])


def named(rows: DataFrame) -> DataFrame:
    """conv, pos, length, words, key (the name of the node that the turn reaches) and parent (that of the one before)."""
    blocks = rows.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK))
    local = cut(blocks.select("conv", "block", "pos", "length", "words", "digest").repartition("conv", "block")
                .sortWithinPartitions("conv", "block", "pos")
                .mapInArrow(chained, "conv long, block long, pos long, length long, words long, local binary, ahead binary"))
    # One row for each full block: 1 / BLOCK of the turns.
    ends = local.filter((F.col("pos") % BLOCK == 0) | (F.col("pos") == F.col("length"))).filter(F.col("length") > BLOCK)
    seed = (ends.select("conv", "block", "local").repartition("conv").sortWithinPartitions("conv", "block")
            .mapInArrow(seeds, "conv long, block long, seed binary"))
    early, late = local.filter("block = 0").withColumn("seed", root_key()), local.filter("block > 0").join(seed, ["conv", "block"])
    both = early.unionByName(late)
    name = lambda part: F.unhex(F.sha2(F.concat("seed", part), 256))
    return both.select("conv", "pos", "length", "words", name("local").alias("key"),
                       F.when(F.octet_length("ahead") > 0, name("ahead")).otherwise(F.col("seed")).alias("parent"))


# --- the digest of the conversations that end at a node -------------------------

def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a key from its pieces in order, taken in piece by piece."""
    key, state, out = None, None, []
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
            if k == key:
                state.update(b",")
            else:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())],
                                         names=["key", "ends_sha256"])
        out = []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                         names=["key", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256 from (key, conv): the ids of a key are joined a sorted range at a time, so no
    task ever holds more of a large group than one range; its digest then reads the pieces in turn."""
    placed = stored(ends.repartitionByRange("key", "conv").withColumn("range", F.spark_partition_id()), "trie-ends")
    pieces = placed.groupBy("key", "range").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), decimal), ",").alias("piece"))
    return (pieces.repartition("key").sortWithinPartitions("key", "range").select("key", "piece")
            .mapInArrow(digests, "key binary, ends_sha256 string"))


# --- parents and siblings --------------------------------------------------------

ADJACENT = "id long, pkey binary, parent_id long, parent_conv long, next_id long, range int, opens boolean, closes boolean"


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parent and next sibling of every child in one range of rows sorted by (pkey, tag, conv_id):
    a node's own row (tag 0) stands before those of its children (tag 1)."""
    pid = TaskContext.get().partitionId()
    pkey, parent, waiting, very_first, out = None, (None, None), None, True, []

    def rows(done: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_())
        names = [c.split()[0] for c in ADJACENT.split(", ")]
        return pa.RecordBatch.from_pydict({n: pa.array([r[k] for r in done], t) for k, (n, t) in enumerate(zip(names, kinds))})

    for batch in batches:
        for k, tag, conv, node in zip(*(batch.column(c).to_pylist() for c in ("pkey", "tag", "conv_id", "id"))):
            if waiting is not None:
                waiting[4] = node if tag == 1 and k == waiting[1] else None
                out.append(waiting)
                waiting = None
            if k != pkey:
                pkey, parent = k, (None, None)
            if tag == 0:
                parent = (node, conv)
            else:
                waiting = [node, k, parent[0], parent[1], None, pid, very_first, False]
            very_first = False
        if len(out) >= OUT_ROWS:
            yield rows(out)
            out = []
    if waiting is not None:
        waiting[7] = True
        out.append(waiting)
    yield rows(out)


def adjacency(nodes: DataFrame) -> DataFrame:
    """id, parent_id, parent_conv, next_id (the next sibling) of every node but the root.

    Children follow each other by conv_id. A node of very many children is split over
    ranges; at most one parent and one sibling a range lie elsewhere and are added after.
    """
    own = nodes.select(F.col("key").alias("pkey"), F.lit(0).alias("tag"), "conv_id", "id")
    children = nodes.filter("parent IS NOT NULL").select(F.col("parent").alias("pkey"), F.lit(1).alias("tag"), "conv_id", "id")
    order = ("pkey", "tag", "conv_id")
    placed = own.unionByName(children).repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(placed.mapInArrow(neighbours, ADJACENT), "trie-neighbours")
    far_parent = found.filter("parent_id IS NULL").select("range", "pkey").distinct().join(
        nodes.select(F.col("key").alias("pkey"), F.col("id").alias("far_id"), F.col("conv_id").alias("far_conv")), "pkey")
    edges = found.filter("opens OR closes").groupBy("pkey", "range").agg(
        F.max(F.when(F.col("opens"), F.col("id"))).alias("first"), F.max(F.when(F.col("closes"), F.col("id"))).alias("id"))
    far_next = edges.select("id", F.lead("first").over(Window.partitionBy("pkey").orderBy("range")).alias("far_next"))
    far_next = far_next.filter("id IS NOT NULL AND far_next IS NOT NULL")
    return (found.join(far_parent, ["range", "pkey"], "left").join(far_next, "id", "left")
            .select("id", F.coalesce("parent_id", "far_id").alias("parent_id"),
                    F.coalesce("parent_conv", "far_conv").alias("parent_conv"),
                    F.coalesce("next_id", "far_next").alias("next_id")))


# --- the tour ----------------------------------------------------------------------

ENTER, EXIT, CHAIN = 0, 1, 2
ARCS = "kind int, id long, head long, after long, steps long, leaves long, saved long"
WEIGHTS = ("steps", "leaves", "saved")


def chains_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the arcs of one range of nodes to chains.

    Arc 2 * id enters a node, arc 2 * id + 1 leaves it. Every arc comes out with the
    first arc of its chain (``head``) and the sums of the weights before it in the
    chain; every chain with the arc after it (in another range) and its whole sums.
    Memory: a few numbers for each node of the range.
    """
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    column = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in table])
              for c in ("id", "parent_id", "next_id", "first_id", "leaf", "saves")}
    ids, parent, sibling, child = (column[c] for c in ("id", "parent_id", "next_id", "first_id"))
    n = len(ids)
    order = np.argsort(ids)

    def place(of: np.ndarray) -> np.ndarray:
        at = order[np.minimum(np.searchsorted(ids, of, sorter=order), n - 1)]
        return np.where(ids[at] == of, at, -1)

    # The tour's successor: as an arc, and as a place in this range (-1: not here).
    inward, across, upward = place(child), place(sibling), place(parent)
    after = np.concatenate([np.where(child >= 0, 2 * child, 2 * ids + 1),
                            np.where(sibling >= 0, 2 * sibling, np.where(parent >= 0, 2 * parent + 1, -1))])
    here = np.concatenate([np.where(child >= 0, inward, n + np.arange(n)),
                           np.where(sibling >= 0, across, np.where((parent >= 0) & (upward >= 0), n + upward, -1))])
    zeros = np.zeros(n, dtype=np.int64)
    weight = np.stack([np.ones(2 * n, dtype=np.int64), np.append(column["leaf"], zeros), np.append(column["saves"], zeros)])
    jump, sums = np.arange(2 * n), np.zeros_like(weight)
    linked = np.flatnonzero(here >= 0)
    jump[here[linked]] = linked
    sums[:, here[linked]] = weight[:, linked]
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        sums, jump = sums + sums[:, jump], further
    arcs = np.concatenate([2 * ids, 2 * ids + 1])
    kinds = np.repeat(np.array([ENTER, EXIT], dtype=np.int32), n)
    tails = np.flatnonzero(here < 0)

    def rows(kind, own, head, following, values) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(own), OUT_ROWS):
            part = slice(low, low + OUT_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[part], pa.int32()), pa.array(own[part]), pa.array(head[part]),
                 pa.array(following[part], mask=following[part] < 0)] + [pa.array(v[part]) for v in values],
                names=[c.split()[0] for c in ARCS.split(", ")])

    yield from rows(kinds, np.append(ids, ids), arcs[jump], np.full(2 * n, -1, dtype=np.int64), sums)
    head = arcs[jump[tails]]
    yield from rows(np.full(len(tails), CHAIN, dtype=np.int32), head, head, after[tails], sums[:, tails] + weight[:, tails])


def ranked(chains: DataFrame) -> DataFrame:
    """head and, as ``WEIGHTS``, the sums from the chain's start to the end of the list: pointer jumping.

    Every round doubles what a chain has summed and where it points to. Chains that
    have reached the end look for numbers that no arc has, each for its own.
    """
    chains = cut(chains.select("head", "after", *WEIGHTS))
    for _ in range(max(0, chains.count() - 1).bit_length()):
        onward = chains.select(F.col("head").alias("sought"), F.col("after").alias("further"),
                               *[F.col(c).alias(f"{c}_on") for c in WEIGHTS])
        seeking = chains.withColumn("sought", F.coalesce("after", -1 - F.col("head")))
        chains = cut(seeking.join(onward, "sought", "left").select(
            "head", F.col("further").alias("after"),
            *[(F.col(c) + F.coalesce(f"{c}_on", F.lit(0))).alias(c) for c in WEIGHTS]))
    return chains


def subtree_sums(tree: DataFrame) -> DataFrame:
    """id, enter, exit (places in the tour, from 1), n_leaves and saved_tokens of every node's subtree.

    ``tree`` has id, parent_id, next_id, first_id (-1: none), leaf, saves, and conv_id and
    depth, by which it is dealt to ranges: a conversation's nodes lie next to each other.
    """
    arcs = stored(tree.repartitionByRange("conv_id", "depth").select("id", "parent_id", "next_id", "first_id", "leaf", "saves")
                  .mapInArrow(chains_of_range, ARCS), "trie-arcs")
    ends = ranked(arcs.filter(F.col("kind") == CHAIN)).select("head", *[F.col(c).alias(f"{c}_on") for c in WEIGHTS])
    total = F.lit(arcs.filter(F.col("kind") != CHAIN).count())
    # From an arc to the end of the tour, the arc itself included.
    left = arcs.filter(F.col("kind") != CHAIN).join(ends, "head").select(
        "kind", "id", *[(F.col(f"{c}_on") - F.col(c)).alias(c) for c in WEIGHTS])
    at = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return left.groupBy("id").agg(
        (total - at(ENTER, "steps") + 1).alias("enter"), (total - at(EXIT, "steps") + 1).alias("exit"),
        (at(ENTER, "leaves") - at(EXIT, "leaves")).alias("n_leaves"),
        (at(ENTER, "saved") - at(EXIT, "saved")).alias("saved_tokens"))


def prefix_trie(conversations: DataFrame, rebuild: bool = True, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each node of the trie of conversations.

    conv_id (the smallest member), depth, parent_conv_id (the parent's conv_id), n_convs
    (members), n_children, n_leaves (childless nodes of the subtree), saved_tokens
    (words that the subtree's nodes hold once instead of once a member), ends_sha256
    (of the decimal ids of the conversations that end at the node, ascending, comma-
    joined), enter and exit (the arcs' places in the tour, from 1).
    With ``rebuild`` conversations first take turns from others (``rebuilt``).

    Defined cases: rows without an id take no part; a null role or text is empty; a null
    turn comes first; rows of one turn follow each other in the order of a digest of role
    and text; a repeated row is a turn each time; a conversation left without turns is a
    member of the root only; an empty table gives no rows, not even a root.
    """
    turns = conversations.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                 F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows, members = (rebuilt if rebuild else plain)(turns.filter("conv IS NOT NULL"))
    reached = cut(named(rows))
    nodes = reached.groupBy("key").agg(F.min("parent").alias("parent"), F.min("conv").alias("conv_id"), F.min("pos").alias("depth"),
                                       F.count("*").alias("n_convs"), F.min("words").alias("words"))
    root = members.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        root_key().alias("key"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"),
        "n_convs", F.lit(0).cast("long").alias("words"))
    nodes = cut(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()))
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("n_children"), F.min(F.struct("conv_id", "id"))["id"].alias("first_id"))
    tree = nodes.join(kids, "key", "left").join(adjacency(nodes), "id", "left")
    none = F.lit(-1).cast("long")
    tree = cut(tree.select("id", "key", "conv_id", "depth", "n_convs", F.col("parent_conv").alias("parent_conv_id"),
                           F.coalesce("n_children", F.lit(0)).alias("n_children"),
                           *[F.coalesce(c, none).alias(c) for c in ("parent_id", "next_id", "first_id")],
                           F.col("n_children").isNull().cast("long").alias("leaf"),
                           ((F.col("n_convs") - 1) * F.col("words")).alias("saves")))
    ends = reached.filter("pos = length").select("key", "conv").unionByName(
        members.filter("length = 0").select(root_key().alias("key"), "conv"))
    return (tree.join(subtree_sums(tree), "id").join(end_digests(ends), "key", "left")
            .select(F.col("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "enter", "exit"))
