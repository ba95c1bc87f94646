"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``2 r`` bits share a point at most ``r`` bits from
either. Every distinct fingerprint therefore emits all variants within half
the radius (itself and its one-bit flips for a distance of two); variants are
the shuffle key. At most 65 fingerprints lie around one variant, so no group
grows with the data, and neighbours in a group's order are linked instead of
all its pairs: the same components with fewer links. Links are deduplicated,
verified by their bit distance and joined into components.

Defined results: a null or blank text has fingerprint zero, which links like
any other; equal fingerprints are linked; a row without doc_id gets the least
doc_id of its component, or null, and stays in the latter case; rows that
share a doc_id are judged each by its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import free_names, written
from tributary.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# Shingles whose bits are counted in one go: bounds memory on long texts.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    words = text.encode().lower().split()  # bytes: A-Z, and \x20 \x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1 :]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : min(at + BLOCK, n)].tolist(), last[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp): a digest of the text and the fingerprint, signed."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or "", shingle) for t in batch.column(2).to_pylist()]
            fps = pa.array(np.array(found, "<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fps], ["doc_id", "key", "fp"])

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")
    return keyed.mapInArrow(task, "doc_id long, key long, fp long")


def ball(fp: str, radius: int) -> F.Column:
    """All values within ``radius`` bits of a long column, as an array."""
    flips = [0]
    edge = {0}
    for _ in range(radius):
        edge = {m ^ (1 << b) for m in edge for b in range(64) if not m >> b & 1}
        flips += sorted(edge)
    signed = [m - (1 << 64) if m >> 63 else m for m in flips]
    return F.transform(F.array(*[F.lit(m) for m in signed]), lambda m: F.col(fp).bitwiseXOR(m))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified links (u, v) between distinct fingerprints, enough of them to
    hold together whatever lies within ``max_bits`` bits.

    An odd radius is split unevenly and checked by the distance; an even one
    needs no check, as all around a variant are within the radius.
    """
    radius = (max_bits + 1) // 2
    variants = fps.select("fp").distinct().select("fp", F.explode(ball("fp", radius)).alias("variant"))
    around = Window.partitionBy("variant").orderBy("fp")
    if max_bits % 2 == 0:
        pairs = variants.select("fp", F.lag("fp").over(around).alias("other")).where("other is not null")
    else:  # a group is bounded by the ball's size, so its pairs are, too
        near = F.collect_list("fp").over(around.rowsBetween(Window.unboundedPreceding, -1))
        pairs = variants.select("fp", near.alias("near")).select("fp", F.explode("near").alias("other"))
    found = pairs.select(F.col("fp").alias("u"), F.col("other").alias("v")).distinct()
    return found.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """A row per document: doc_id, key, fp, component_id (least doc_id it reaches)."""
    fps = written(fingerprints(docs, shingle), "fingerprints")
    # One node per fingerprint: its documents may all lack an id.
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    members = written(
        nodes.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "members"
    )
    ids = members.groupBy("component").agg(F.min("least").alias("component_id"))
    named = members.join(ids, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "key", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The document with the least doc_id of every component, all columns."""
    doc, key = free_names(docs, "doc", "key")
    classes = near_duplicates(docs, shingle, max_bits)
    stay = classes.where("doc_id <=> component_id").select(F.col("doc_id").alias(doc), F.col("key").alias(key))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key))
    return docs.join(stay, same, "left_semi")
