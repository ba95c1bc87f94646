"""Substring deduplication by unit hashing.

A document is cut into units: its paragraphs (lines between blank ones), its
lines, whatever their length, and in addition the sentences within a line,
since a shared passage need not start on a line of its own. Units are
normalised, their 128-bit digests are grouped over the corpus, and every
occurrence but the earliest ranked one is removed; spans keep their offsets in
the original. ``removals`` compares all units, ``repeats`` sentences alone.

Defined results: a null text has no units; a blank line is no unit; a sentence
that is no line of its own is compared from ``min_words`` words on; a unit of
the same words as the one around it is not compared again; spans may lie within
one another (a paragraph, its lines), and what goes is their union; rank is
(doc_id, position), null doc_ids last; rows that share a doc_id are one
document, so their copies stay or go alike; extra columns are ignored by
``removals`` and ``repeats`` and kept by ``without``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import LOWER, UPPER, free_names, written

MIN_WORDS = 5
LAST_RANK = 2**63 - 1

# A unit ends behind a newline, or behind sentence marks and blanks.
UNIT_END = re.compile(r"[.!?]+[ \t]+|\n")
TO_LOWER = str.maketrans(UPPER, LOWER)
# Only these count as blanks, whatever the library's idea of white space.
BLANKS = re.compile(r"[ \t\r\n]+")

_UNITS = "rank long, unit int, start int, length int, hi long, lo long, again boolean"


def cut(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the units of a text; they cover it without gaps."""
    start = 0
    for mark in UNIT_END.finditer(text):
        yield start, mark.end()
        start = mark.end()
    if start < len(text):
        yield start, len(text)


def normalise(unit: str) -> str:
    return BLANKS.sub(" ", unit).strip(" ").translate(TO_LOWER)


def sentences(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, int, str]]:
    """(unit, start, end, normalised) of the sentences that are long enough."""
    for k, (a, b) in enumerate(cut(text)):
        plain = normalise(text[a:b])
        if plain.count(" ") + 1 >= min_words:
            yield k, a, b, plain


def passages(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, int, str]]:
    """``sentences`` of paragraphs, lines and sentences, by start, the longest
    first; ``unit`` is the number of the sentence that they start with."""
    paragraph: list[list[tuple[int, int, int, str]]] = []
    line: list[tuple[int, int, int, str]] = []
    for k, (a, b) in enumerate(cut(text)):
        line.append((k, a, b, normalise(text[a:b])))
        if text[b - 1] != "\n" and b < len(text):
            continue
        # What parts sentences and lines is blank, so their words join to the whole's.
        plain = " ".join(x[3] for x in line if x[3])
        if plain:
            whole = (line[0][0], line[0][1], b, plain)
            paragraph.append([whole, *(x for x in line if x[3] != plain and x[3].count(" ") + 1 >= min_words)])
        if paragraph and (not plain or b == len(text)):
            if len(paragraph) > 1:
                first, last = paragraph[0][0], paragraph[-1][0]
                yield *first[:2], last[2], " ".join(x[0][3] for x in paragraph)
            for parts in paragraph:
                yield from parts
            paragraph = []
        line = []


def units(docs: DataFrame, min_words: int = MIN_WORDS, of: Callable = sentences) -> DataFrame:
    """A row for each unit that is compared.

    ``again`` marks a unit that the same row holds at an earlier place.
    """

    def task(batches):
        for batch in batches:
            out: list[tuple] = []
            for rank, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = set()
                for k, a, b, plain in of(text or "", min_words):
                    digest = xxhash.xxh3_128_digest(plain.encode())
                    hi, lo = (int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))
                    out.append((rank, k, a, b - a, hi, lo, digest in seen))
                    seen.add(digest)
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            names = [c.split()[0] for c in _UNITS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    ranked = docs.select(F.coalesce("doc_id", F.lit(LAST_RANK)).alias("rank"), "text")
    return ranked.mapInArrow(task, _UNITS)


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``repeats`` of paragraphs, lines and sentences."""
    return repeats(docs, min_words, passages)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, of: Callable = sentences) -> DataFrame:
    """Spans to remove: doc_id, unit, start, length, keep_doc_id, copies.

    Grouping is a hash aggregate on fixed-width keys that combines before the
    shuffle, so a line of a third of all documents is a row per task. The way
    back to the occurrences is a plain join, which adaptive execution splits
    where one digest fills a partition.
    """
    every = written(units(docs, min_words, of), "units")
    groups = (
        every.groupBy("hi", "lo")
        .agg(F.min("rank").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    hits = every.join(groups, ["hi", "lo"]).where("rank > first or again")
    return hits.select(
        F.expr(f"nullif(rank, {LAST_RANK})").alias("doc_id"),
        "unit",
        "start",
        "length",
        F.expr(f"nullif(first, {LAST_RANK})").alias("keep_doc_id"),
        "copies",
    )


def without(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of their texts.

    Adds ``kept_spans``: (start, length) of what is left, in the original.
    The spans of one document meet in one row: they are no more than its units.
    A span may lie within another.
    """
    doc, gone_at = free_names(docs, "doc", "cuts")
    cuts = spans.groupBy(F.col("doc_id").alias(doc)).agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias(gone_at)
    )
    schema = docs.schema
    joined = docs.join(cuts, F.col("doc_id").eqNullSafe(F.col(doc)), "left").drop(doc)
    place = schema.names.index("text")
    span = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "length")])
    out = T.StructType([*schema.fields, T.StructField("kept_spans", T.ArrayType(span))])

    def task(batches):
        for batch in batches:
            kept_texts, kept_spans = [], []
            cut_lists = batch.column(gone_at).to_pylist()
            for text, gone in zip(batch.column(place).to_pylist(), cut_lists, strict=True):
                spans_left, at = [], 0
                for s in gone or []:
                    if s["start"] > at:
                        spans_left.append((at, s["start"] - at))
                    at = max(at, s["start"] + s["length"])
                if text is not None and at < len(text):
                    spans_left.append((at, len(text) - at))
                kept_texts.append(None if text is None else "".join(text[a : a + n] for a, n in spans_left))
                kept_spans.append([{"start": a, "length": n} for a, n in spans_left])
            arrays = [batch.column(i) for i in range(len(schema.names))]
            arrays[place] = pa.array(kept_texts, pa.string())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(kept_spans, kind)], out.names)

    return joined.mapInArrow(task, out)
