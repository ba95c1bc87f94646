"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (LZ78: the shortest prefix of the
rest that isn't a phrase yet). Phrases are hashed, and the least ``SIZE``
hashes are the signature: a uniform sample of the phrase set, so the share of
common hashes among the least of two signatures estimates the Jaccard
similarity of the phrase sets, which follows how well one text's dictionary
compresses the other.

Defined results: a null text counts as empty; a text without phrases has the
empty fingerprint, which is like itself (1.0) and like nothing else (0.0); rows
that share a doc_id are ordered by falling XXH64 of their texts (seed 42,
signed), so that one id of very many rows is parted like any range of ids; a
null doc_id follows all others; one document alone is its own next.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written

SIZE = 128
# Ranges of doc_id, for each partition: evens out what hashing deals unevenly.
RANGES = 4
# A doc_id of about so many rows that fills several ranges is parted itself.
HOT_ROWS = 1000
OUT_ROWS = 500


def parse(text: str, phrases: set[str], rest: str = "") -> str:
    """Add the phrases of ``text`` to a dictionary; returns the open phrase."""
    add = phrases.add
    for c in text:
        rest += c
        if rest not in phrases:
            add(rest)
            rest = ""
    return rest


def hashes(phrases: set[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, phrases), np.uint32, len(phrases))


def signature(found: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The least distinct hashes, in order."""
    if len(found) > 4 * size:
        found = np.partition(found, 2 * size)[: 2 * size + 1]  # few hashes are equal
    return np.unique(found)[:size]


def fingerprint(text: str) -> np.ndarray:
    phrases: set[str] = set()
    parse(text, phrases)
    return signature(hashes(phrases))


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity of two phrase sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    same = both[1:] == both[:-1]
    least = np.concatenate(([True], ~same))
    k = min(size, int(least.sum()))
    last = both[least][k - 1]
    return int((same & (both[1:] <= last)).sum()) / k


def as_text(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_text(fingerprint(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, fingerprint string")


def edit(text: str, follower: str) -> tuple[str, str]:
    """(what stays, what comes behind it) of the edited text."""
    half = len(text) // 2
    return text[: len(text) - half], follower[:half]


def _hot(bounds: list[int], rows: int) -> list[tuple[int, int, int]]:
    """(range, rank, parts) of the ranks that fill several ranges."""
    share = rows / (len(bounds) + 1)
    distinct = sorted(set(map(float, bounds)))
    found = {}
    for rank, n in sorted(Counter(bounds).items()):
        if n > 1 and n * share >= HOT_ROWS:
            # Ranges are parted at doubles; one hot rank in each is enough.
            found.setdefault(distinct.index(float(rank)) + 1, (rank, n))
    return [(place, *of) for place, of in found.items()]


def with_follower(docs: DataFrame) -> DataFrame:
    """Rows in partitions so that each follows its predecessor by falling
    doc_id: columns bucket, tail, rank, turn, copies, doc_id, text, sorted.

    Buckets are ranges of doc_id between quantiles. A doc_id that fills several
    of them is parted by its texts' digests, and its equal texts are one row
    with their number, counted before they move. The first row of a bucket also
    goes to the one before as its tail (the first of all to the last). Only the
    bounds of the ranges and the place of each one's first row come to the
    driver.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(2**63)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).select(
        F.coalesce("doc_id", F.lit(least)).alias("rank"), F.lit(1).cast("long").alias("copies"), "doc_id", "text"
    )
    shares = [i / (RANGES * n) for i in range(1, RANGES * n)]
    found = rows.agg(F.percentile_approx("rank", shares, 100 * RANGES * n), F.count(F.lit(1))).first()
    bounds = found[0] or []
    hot = _hot(bounds, found[1])
    if hot:
        is_hot = F.col("rank").isin([rank for _, rank, _ in hot])
        several = rows.filter(is_hot).groupBy("rank", "doc_id", "text").agg(F.sum("copies").alias("copies"))
        rows = rows.filter(~is_hot).unionByName(written(several, "fingerprint-hot").select(*rows.columns))
    splits = [-math.inf, *sorted(set(map(float, bounds or [0]))), math.inf]
    placing = Bucketizer(splits=splits, inputCol="at", outputCol="range")
    ranged = placing.transform(rows.withColumn("at", F.col("rank").cast("double")))
    ranged = ranged.select(F.col("range").cast("long").alias("range"), "rank", "copies", "doc_id", "text")
    turn = F.xxhash64("text")
    if hot:
        # A row per hot rank, which are fewer than ranges. Within a range, ranks
        # below the hot one are part 0, and those above it the last part.
        last = max(parts for *_, parts in hot) + 1
        table = spark.createDataFrame(hot, "range long, hot long, parts long")
        ranged = ranged.join(F.broadcast(table), "range", "left")
        inside = F.col("rank") == F.col("hot")
        share = F.shiftright((F.shiftright(turn, 32) + F.lit(2**31)) * F.col("parts"), 32)
        part = F.when(inside, share + 1).when(F.col("rank") > F.col("hot"), F.lit(last)).otherwise(F.lit(0))
        bucket, side = F.col("range") * (last + 1) + part, F.when(inside, turn)
    else:
        bucket, side = F.col("range"), F.lit(None).cast("long")
    placed = ranged.select(
        bucket.alias("bucket"), side.alias("side"), "rank", turn.alias("turn"), "copies", "doc_id", "text"
    )
    # A part has one rank, so the greatest rank and digest are of one row.
    first = placed.groupBy("bucket").agg(F.max("rank").alias("rank"), F.max("side").alias("side")).collect()
    first.sort(key=lambda r: r.bucket, reverse=True)
    # The head of each bucket is the tail of the one read before it.
    heads = spark.createDataFrame(
        [(r.bucket, r.rank, r.side, first[i - 1].bucket) for i, r in enumerate(first)],
        "of long, head long, head_side long, before long",
    )
    is_head = (F.col("bucket") == F.col("of")) & (F.col("rank") == F.col("head")) & F.col("side").eqNullSafe(F.col("head_side"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("tail"))
    also = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("tail"))
    dealt = (
        placed.join(F.broadcast(heads), is_head, "left")
        .withColumn("at", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, also))))
        .select("at.bucket", "at.tail", "rank", "turn", "copies", "doc_id", "text")
    )
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "tail", F.desc("rank"), F.desc("turn"), "text")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next's.

    The half that stays is parsed once; its dictionary is then continued with
    the document's own end and with the other one.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def both(text: str, follower: str) -> tuple[str, np.ndarray, np.ndarray]:
        stays, comes = edit(text, follower)
        begun: set[str] = set()
        rest = parse(stays, begun)
        common = hashes(begun)
        found = []
        for end in (text[len(stays) :], comes):
            phrases = begun.copy()
            parse(end, phrases, rest)
            phrases -= begun
            found.append(signature(np.concatenate([common, hashes(phrases)])))
        return hashlib.sha256((stays + comes).encode()).hexdigest(), *found

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def results(batches) -> Iterator[tuple[tuple, int]]:
        """A row and how often it is one."""
        bucket = before = None  # before: the row that waits for its follower
        waiting = None  # a finished row that waits for its follower's fingerprint

        def finished(own: np.ndarray) -> Iterator[tuple[tuple, int]]:
            if waiting is not None:
                row, mine = waiting
                yield (*row, likeness(mine, own)), 1

        def compared(doc, text: str, follower: str) -> tuple[tuple, np.ndarray]:
            sha, own, edited = both(text, follower)
            return (doc, len(text), sha, as_text(own), as_text(edited), likeness(own, edited)), own

        for batch in batches:
            for at, tail, copies, doc, text in zip(
                *(batch.column(c).to_pylist() for c in ("bucket", "tail", "copies", "doc_id", "text")), strict=True
            ):
                if at != bucket:
                    bucket, before, waiting = at, None, None
                if before is not None:
                    mine, written_as, times = before
                    if times > 1:  # all but the last of equal rows precede their like
                        row, own = compared(mine, written_as, written_as)
                        yield from finished(own)
                        waiting = None
                        yield (*row, likeness(own, own)), times - 1
                    row, own = compared(mine, written_as, text)
                    yield from finished(own)
                    waiting = (row, own)
                    if tail:
                        yield from finished(fingerprint(text))
                        waiting = None
                # A tail ends its bucket; rows that tie with it are dropped.
                before = None if tail else (doc, text, copies)

    def task(batches) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row, times in results(batches):
            while times > 0:
                some = min(times, OUT_ROWS - len(out))
                out.extend([row] * some)
                times -= some
                if len(out) >= OUT_ROWS:
                    yield batch_of(out)
                    out.clear()
        yield batch_of(out)

    return with_follower(docs).mapInArrow(task, schema)
