"""Exact deduplication with a cuckoo-filter index.

The digest space is dealt into buckets, one per partition; their number follows
from the rows. A bucket holds a
cuckoo filter over its live digests and the bucketed content behind it: each
digest with the document that stays and the size of its group. A digest that
the filter does not know is new. A hit is verified against the stored digest
of the whole text, for a filter may err. The filter supports deletion, and
when an insertion finds no place it is built anew, twice as large, from the
stored keys.

Defined results: a null text equals the empty one; of equal texts the row with
the largest doc_id stays, a null doc_id only if no other is there; of rows
that also share the doc_id, ``deduplicate`` keeps one.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import free_names, lower_az, partitions, written

SLOTS = 4
MAX_KICKS = 200
FIRST_BUCKETS = 256
# Live digests of a bucket on average: they are a task's memory.
BUCKET_ROWS = 250_000
# Groups (a digest and two numbers each) that may be broadcast, some 40 MB.
BROADCAST_GROUPS = 400_000
# A null doc_id ranks below all others.
NO_DOC = -(2**63)

_GROUPS = "digest binary, keep_id long, group_size long, keep_rows long"
_GROUP_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
_OPS = "digest binary, keep_id long, group_size long, keep_rows long, op int"


class CuckooFilter:
    """Partial-key cuckoo filter of 16-bit fingerprints, four slots a bucket.

    Fingerprint and first bucket come from different bytes of the digest; the
    other bucket is the first one xor a hash of the fingerprint, so that an
    entry can move without its key.
    """

    def __init__(self, n_buckets: int = FIRST_BUCKETS):
        self.n = n_buckets  # a power of two
        self.table = array("H", bytes(2 * SLOTS * n_buckets))

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1  # zero is an empty slot
        first = int.from_bytes(digest[2:10], "little") & (self.n - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.n - 1)

    def _slot(self, bucket: int, mark: int) -> int:
        base = bucket * SLOTS
        for i in range(base, base + SLOTS):
            if self.table[i] == mark:
                return i
        return -1

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._place(digest)
        return self._slot(a, mark) >= 0 or self._slot(b, mark) >= 0

    def insert(self, digest: bytes) -> bool:
        """False if no place was found; the filter then must be built anew."""
        mark, a, b = self._place(digest)
        for bucket in (a, b):
            i = self._slot(bucket, 0)
            if i >= 0:
                self.table[i] = mark
                return True
        bucket = a
        for kick in range(MAX_KICKS):
            i = bucket * SLOTS + kick % SLOTS
            mark, self.table[i] = self.table[i], mark
            bucket = self._other(bucket, mark)
            i = self._slot(bucket, 0)
            if i >= 0:
                self.table[i] = mark
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Only for a digest that is in: another one's mark could go else."""
        mark, a, b = self._place(digest)
        for bucket in (a, b):
            i = self._slot(bucket, mark)
            if i >= 0:
                self.table[i] = 0
                return True
        return False


class BucketIndex:
    """A filter and the bucketed content that its hits are verified against."""

    def __init__(self) -> None:
        self.filter = CuckooFilter()
        self.content: dict[bytes, tuple[int, int, int]] = {}
        self.false_hits = 0
        self.resizes = 0

    def live(self, digest: bytes) -> bool:
        if digest not in self.filter:
            return False
        if digest in self.content:
            return True
        self.false_hits += 1
        return False

    def insert(self, digest: bytes, keep: int, size: int, rows: int) -> None:
        if self.live(digest):
            keep0, size0, rows0 = self.content[digest]
            rows = rows0 if keep0 > keep else rows if keep > keep0 else rows + rows0
            self.content[digest] = (max(keep0, keep), size0 + size, rows)
            return
        self.content[digest] = (keep, size, rows)
        if not self.filter.insert(digest):
            self._resize()

    def delete(self, digest: bytes) -> None:
        if self.live(digest):
            self.filter.delete(digest)
            del self.content[digest]

    def _resize(self) -> None:
        n = self.filter.n
        while True:
            n *= 2
            self.resizes += 1
            self.filter = CuckooFilter(n)
            if all(self.filter.insert(d) for d in self.content):
                return


def _emit(index: BucketIndex, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _GROUPS.split(", ")]
    items = iter(index.content.items())
    while chunk := [x for _, x in zip(range(rows), items, strict=False)]:
        columns = zip(*((d, *v) for d, v in chunk), strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _GROUP_TYPES, strict=True)], names
        )


def _absorb(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = BucketIndex()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            index.insert(*row)
    yield from _emit(index)


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by op: 0 stored keys, 1 deletions, 2 insertions."""
    index = BucketIndex()
    for batch in batches:
        for *row, op in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if op == 1:
                index.delete(row[0])
            else:
                index.insert(*row)
    yield from _emit(index)


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text, in the JVM."""
    return F.unhex(F.sha2(lower_az(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def build(digests: DataFrame) -> DataFrame:
    """Index of a table (doc_id, digest): a row per live digest.

    Every input task first runs its rows through an index of its own, so that
    a text with a third of all rows is one row per task in the shuffle.
    """
    rows = digests.select(
        "digest",
        F.coalesce("doc_id", F.lit(NO_DOC)).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(1).cast("long").alias("keep_rows"),
    )
    n = partitions(digests.sparkSession, digests.count(), BUCKET_ROWS)
    return rows.mapInArrow(_absorb, _GROUPS).repartition(n, "digest").mapInArrow(_absorb, _GROUPS)


def update(index: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The index after deleting digests and inserting others, bucket by bucket."""
    parts = [index.withColumn("op", F.lit(0))]
    if deleted is not None:
        zero = F.lit(0).cast("long")
        parts.append(
            deleted.select("digest").distinct().select("digest", zero, zero, zero, F.lit(1))
        )
    if inserted is not None:
        parts.append(build(inserted).withColumn("op", F.lit(2)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    n = partitions(index.sparkSession, index.count() + (0 if inserted is None else inserted.count()), BUCKET_ROWS)
    dealt = rows.repartition(n, "digest").sortWithinPartitions("op")
    return dealt.mapInArrow(_apply, _GROUPS)


def decisions(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = written(docs.select("doc_id", digest_of(F.col("text")).alias("digest")), "digests")
    groups = build(digests).where("group_size > 1")
    keep = F.expr(f"nullif(keep_id, {NO_DOC})")
    out = digests.join(groups, "digest", "left").select(
        "doc_id",
        F.when(F.col("keep_id").isNull(), F.col("doc_id")).otherwise(keep).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    Texts are not shuffled while the groups of several rows, which are digests
    and ids, are few enough to be broadcast by their measured number. Only rows
    that share text and doc_id with the one that stays meet by digest, each
    task having reduced its own to one.
    """
    columns = docs.columns
    digest, keep, n = free_names(docs, "digest", "keep", "rows")
    keyed = docs.withColumn(digest, digest_of(F.col("text")))
    narrow = written(docs.select("doc_id", digest_of(F.col("text")).alias("digest")), "digests")
    several = build(narrow).where("group_size > 1").select(
        F.col("digest").alias(digest), F.col("keep_id").alias(keep), F.col("keep_rows").alias(n)
    )
    groups = written(several, "groups")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    joined = keyed.join(groups, digest, "left")
    best = F.coalesce("doc_id", F.lit(NO_DOC)) == F.col(keep)
    once = joined.where(F.col(keep).isNull() | (best & (F.col(n) == 1)))
    ties = joined.where(best & (F.col(n) > 1)).dropDuplicates([digest])
    return once.select(columns).unionByName(ties.select(columns))
