"""Merkle manifest of a dataset, kept as postorder append logs.

Every row is a leaf. The leaves of a tree (one per language) stand in order;
while several nodes remain, every ``FANOUT`` consecutive ones (the last run
may be shorter, even one) become the digest of their digests. The subroots are
the leaves of one more tree, whose root names the dataset.

Builders are aligned: with ``R`` for FANOUT to the power LEVELS, block ``b`` of
a tree covers the ``R`` leaves from ``b * R`` on, a complete subtree, so it is
built without looking at any other block. A builder appends a node as soon as
its last child is done: its log is the subtree in postorder. Block roots are
the leaves of the next tier, and so on until a tree has one block left. Where a
node stands in a log follows from the subtree sizes alone (``position``), so
proofs read siblings by address: from the top tier down, each log hands every
block below it the siblings on its way to the root.

Bounds: a task holds one block (``R`` digests with their ids), the number of
tiers is the logarithm of the rows to the base ``R``, and what is broadcast has
one row per partition. A language with most of the rows is many blocks.

Defined results: a null field is ``-`` in a leaf; a null language is a tree of
its own, the first one; rows of a tree that share a doc_id stand in the order
of their digests, those without doc_id first; repeated rows are leaves of
their own; an empty table has no leaf, no root and no rows; further columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import written

FANOUT = 8
# Levels of a block: FANOUT**LEVELS leaves.
LEVELS = 4
DIGEST = 32
# Key of the tree over the subroots.
TOP = ""
# Proofs in one Arrow batch.
STEP = 512
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCKS = "tree string, block long, n long, log binary, ids array<long>, others array<binary>"
_PATHS = "tree string, block long, path array<binary>, subroot binary, root binary"
_PROOFS = "doc_id long, leaf binary, subroot binary, root binary, siblings array<binary>, folded binary"


# -- trees -----------------------------------------------------------------
def parent(digests: list[bytes]) -> bytes:
    """Digest of a run: the hex texts of its digests, one after the other."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def sizes(n: int, block: int, levels: int = LEVELS) -> list[int]:
    """Nodes per level of a block with ``n`` leaves. A tree's only block ends at
    one node, any other one has the full height."""
    full = block > 0 or n == FANOUT**levels
    found = [n]
    while (len(found) <= levels) if full else found[-1] > 1:
        found.append(-(-found[-1] // FANOUT))
    return found


def position(counts: list[int], level: int, index: int) -> int:
    """Place of a node in a log of a tree with ``counts`` nodes per level.

    Before it stand, of its own and lower levels, all nodes up to its last
    descendant, and of higher levels those that end before its first leaf.
    """
    below = sum(min((index + 1) * FANOUT ** (level - k), counts[k]) for k in range(level + 1))
    above = sum(index // FANOUT ** (k - level) for k in range(level + 1, len(counts)))
    return below + above - 1


def append_log(leaves: list[bytes], counts: list[int]) -> bytes:
    """All nodes over the leaves in completion order."""
    height = len(counts) - 1
    log = bytearray()
    open_runs: list[list[bytes]] = [[] for _ in range(height + 1)]

    def add(level: int, digest: bytes, last: bool) -> None:
        log.extend(digest)
        if level < height:
            open_runs[level].append(digest)
            if last or len(open_runs[level]) == FANOUT:
                run, open_runs[level] = open_runs[level], []
                add(level + 1, parent(run), last)

    for i, leaf in enumerate(leaves):
        add(0, leaf, i == len(leaves) - 1)
    return bytes(log)


def node(log: bytes, counts: list[int], level: int, index: int) -> bytes:
    at = position(counts, level, index) * DIGEST
    return log[at : at + DIGEST]


def siblings(log: bytes, counts: list[int], index: int) -> list[bytes]:
    """The others of each run on the way up, and the node's place in its run:
    per level one entry, a byte for the place and the digests."""
    path = []
    for level in range(len(counts) - 1):
        base = index - index % FANOUT
        run = range(base, min(base + FANOUT, counts[level]))
        others = b"".join(node(log, counts, level, i) for i in run if i != index)
        path.append(bytes([index - base]) + others)
        index //= FANOUT
    return path


def fold(leaf: bytes, path: list[bytes]) -> bytes:
    """The root that a leaf and its siblings give."""
    for step in path:
        others = [step[i : i + DIGEST] for i in range(1, len(step), DIGEST)]
        leaf = parent([*others[: step[0]], leaf, *others[step[0] :]])
    return leaf


# -- leaves ----------------------------------------------------------------
def field(name: str, value: Column | None = None) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = (F.col(name) if value is None else value).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column | None = None) -> Column:
    """A row's digest, with another text if given."""
    parts = [field(c, text if c == "text" else None) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def tree_of(lang: Column) -> Column:
    """Key of a language's tree; keys sort as the languages do, null first."""
    return F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), lang))


def _ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each tree within the partition, in order."""
    now, n = None, 0
    for batch in batches:
        trees = batch.column(0).to_numpy(zero_copy_only=False)
        rank = np.empty(len(trees), np.int64)
        cuts = np.flatnonzero(trees[1:] != trees[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(trees)], strict=True):
            if a == b:
                continue
            n = n if trees[a] == now else 0
            rank[a:b] = np.arange(n, n + b - a)
            now, n = trees[a], n + b - a
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], [*batch.schema.names, "rank"])


def ordered(leaves: DataFrame, by: list[str]) -> DataFrame:
    """(tree, id, leaf, other) with each leaf's ``place`` in its tree, whose
    leaves stand in the order of ``by``.

    A range shuffle sorts all rows; only the first tree of a partition can have
    begun in an earlier one, so one offset per partition completes the ranks.
    """
    spark = leaves.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The last key deals out repeated rows, which no other key tells apart.
    keyed = leaves.select("tree", "id", "leaf", "other", F.monotonically_increasing_id().alias("tie"))
    order = [F.col(c).asc_nulls_first() for c in ("tree", *by, "tie")]
    dealt = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("tie")
    ranked = dealt.withColumn("part", F.spark_partition_id()).mapInArrow(
        _ranked, "tree string, id long, leaf binary, other binary, part int, rank long"
    )
    stored = written(ranked, "leaves")
    runs = stored.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).where("offset > 0")
    # At most one row per partition.
    starts = F.broadcast(starts.select("tree", "part", "offset"))
    placed = stored.join(starts, ["tree", "part"], "left")
    return placed.select("tree", (F.col("rank") + F.coalesce("offset", F.lit(0))).alias("place"), "id", "leaf", "other")


# -- building --------------------------------------------------------------
def _built(levels: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logs of the blocks, whose leaves come in order."""
    key, held = None, []

    def done() -> pa.RecordBatch:
        ids, leaves, others = zip(*held, strict=True)
        log = append_log(list(leaves), sizes(len(leaves), key[1], levels))
        row = [[key[0]], [key[1]], [len(leaves)], [log], [ids], [others]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
        names = ["tree", "block", "n", "log", "ids", "others"]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names)

    for batch in batches:
        for tree, block, _, *leaf in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (tree, block) != key:
                if held:
                    yield done()
                key, held = (tree, block), []
            held.append(leaf)
    if held:
        yield done()


def _blocks(leaves: DataFrame, label: str, levels: int) -> DataFrame:
    """One tier: a row per aligned block, its log and their ids."""
    cut = leaves.select(
        "tree", F.expr(f"place div {FANOUT**levels}").alias("block"), F.col("place"), "id", "leaf", "other"
    )
    n = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", "place")
    return written(dealt.mapInArrow(partial(_built, levels), _BLOCKS), label)


def _roots(blocks: DataFrame) -> DataFrame:
    """Each block's root, the last node of its log."""
    return blocks.select("tree", "block", F.expr(f"substring(log, -{DIGEST}, {DIGEST})").alias("leaf"))


def tiers(leaves: DataFrame, label: str, levels: int = LEVELS) -> list[DataFrame]:
    """Logs of all tiers of the trees over (tree, place, id, leaf, other),
    from the leaves up; a tree's last block is in the tier where it has one."""
    found = [_blocks(leaves, f"{label}-0", levels)]
    while True:
        several = found[-1].where("block > 0").select("tree").distinct()
        rest = _roots(found[-1]).join(several, "tree", "left_semi")
        if rest.isEmpty():
            return found
        none = [F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("other")]
        up = rest.select("tree", F.col("block").alias("place"), "leaf", *none)
        found.append(_blocks(up, f"{label}-{len(found)}", levels))


def subroots(found: list[DataFrame]) -> DataFrame:
    """(tree, leaf): the root of every tree, in whichever tier it ends."""
    out = None
    for tier in found:
        several = tier.where("block > 0").select("tree").distinct()
        ends = _roots(tier).join(several, "tree", "left_anti").select("tree", "leaf")
        out = ends if out is None else out.unionByName(ends)
    return out


# -- proofs ----------------------------------------------------------------
def _handed_down(levels: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's path and its log give the path of each block below it."""
    names = ["tree", "block", "path", "subroot", "root"]
    types = [pa.string(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
    for batch in batches:
        for tree, block, n, log, path, subroot, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = sizes(n, block, levels)
            for at in range(0, n, STEP):
                below = range(at, min(at + STEP, n))
                paths = [siblings(log, counts, i) + path for i in below]
                rows = [[tree] * len(below), [block * FANOUT**levels + i for i in below], paths, [subroot] * len(below), [root] * len(below)]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types, strict=True)], names)


def _top_paths(levels: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of every subroot, by its tree's key."""
    names = ["tree", "block", "path", "subroot", "root"]
    types = [pa.string(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
    for batch in batches:
        for _, block, n, log, keys, path, _, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = sizes(n, block, levels)
            for at in range(0, n, STEP):
                here = range(at, min(at + STEP, n))
                trees = [keys[i].decode() for i in here]
                paths = [siblings(log, counts, i) + path for i in here]
                leaves = [node(log, counts, 0, i) for i in here]
                rows = [trees, [block] * len(here), paths, leaves, [root] * len(here)]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types, strict=True)], names)


def _down(found: list[DataFrame], tops: DataFrame, label: str, levels: int) -> DataFrame:
    """Paths of the blocks of the lowest tier, from those of the trees' roots
    (tree, path, subroot, root)."""
    paths = None
    for k in range(len(found) - 1, -1, -1):
        several = found[k].where("block > 0").select("tree").distinct()
        own = found[k].select("tree", "block").join(several, "tree", "left_anti")
        ends = own.join(tops, "tree").select("tree", "block", "path", "subroot", "root")
        here = ends if paths is None else ends.unionByName(paths)
        if k == 0:
            return here
        joined = found[k].select("tree", "block", "n", "log").join(here, ["tree", "block"])
        paths = written(joined.mapInArrow(partial(_handed_down, levels), _PATHS), f"{label}-{k}")
    raise ValueError("no tier")


def _proven(levels: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per leaf: its siblings up to the root, and the root folded from
    the leaf's other digest if it has one."""
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.binary()]
    names = ["doc_id", "leaf", "subroot", "root", "siblings", "folded"]
    for batch in batches:
        for row in range(batch.num_rows):
            _, block, n, log, ids, others, path, subroot, root = (c[row].as_py() for c in batch.columns)
            counts = sizes(n, block, levels)
            for at in range(0, n, STEP):
                here = range(at, min(at + STEP, n))
                leaves = [node(log, counts, 0, i) for i in here]
                steps = [siblings(log, counts, i) + path for i in here]
                folded = [fold(others[i] or x, s) for i, x, s in zip(here, leaves, steps, strict=True)]
                k = len(leaves)
                rows = [[ids[i] for i in here], leaves, [subroot] * k, [root] * k, steps, folded]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types, strict=True)], names)


def logs(docs: DataFrame, other: Column | None = None, levels: int = LEVELS) -> list[DataFrame]:
    """Logs of the languages' trees, tier by tier: tree, block, n (leaves),
    log (digests in postorder), the leaves' ids, and their ``other`` digests."""
    leaves = docs.select(
        tree_of(F.col("lang")).alias("tree"),
        F.col("doc_id").cast("long").alias("id"),
        leaf_of().alias("leaf"),
        (F.lit(None).cast("binary") if other is None else other).alias("other"),
    )
    return tiers(ordered(leaves, ["id", "leaf"]), "log", levels)


def proofs(docs: DataFrame, other: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """A row per document: doc_id, leaf, subroot, root, siblings (per level a
    byte for the place in the run, then the digests of the others) and the
    root folded from ``other``, or the leaf where that is null."""
    low = logs(docs, other, levels)
    tops = written(subroots(low), "subroots")
    # One more tree, over the subroots in the order of their keys.
    none = F.lit(None).cast("long").alias("id")
    one = tops.select(F.lit(TOP).alias("tree"), none, "leaf", F.col("tree").cast("binary").alias("other"))
    top = tiers(ordered(one, ["other"]), "top", levels)
    start = subroots(top).select(
        "tree",
        F.array().cast("array<binary>").alias("path"),
        F.lit(None).cast("binary").alias("subroot"),
        F.col("leaf").alias("root"),
    )
    ends = top[0].select("tree", "block", "n", "log", "others").join(_down(top, start, "top-path", levels), ["tree", "block"])
    paths = written(ends.mapInArrow(partial(_top_paths, levels), _PATHS).drop("block"), "top-paths")
    own = _down(low, paths, "path", levels)
    return low[0].join(own, ["tree", "block"]).select(
        "tree", "block", "n", "log", "ids", "others", "path", "subroot", "root"
    ).mapInArrow(partial(_proven, levels), _PROOFS)
