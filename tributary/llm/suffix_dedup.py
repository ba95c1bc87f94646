"""Removal of long repeated substrings by digests behind a phrase filter.

It stands in for merging shard suffix structures by interleave refinement: no
Burrows-Wheeler transform, interleave vector or common prefix is built.

Texts are cut into phrases at content-defined anchors (a position whose k-gram
hash is the least of some window of ``W`` positions), so equal passages are cut
alike. Round h counts, over all shards, the digests of the h phrases that start
at each anchor; a digest that occurs once is closed: those phrases have no
second place. A shard sends its distinct digests only. A window of ``min_bytes``
that occurs twice holds ``ROUNDS`` common phrases behind its first inner anchor,
whatever the text, so the open digests of the last round cover all repeats.

What lies in them is then checked by content (digests of 128 bits, and of 96
for single windows). All windows
with the same first inner anchor share a core; a core is closed if it occurs
once, and repeats as a whole if all of its occurrences have the same context.
Only cores with several contexts compare their windows one by one. All messages
are distinct per shard, so a passage that a third of the documents share is one
row per shard, and what is compared never meets in one group.

Texts travel once, compressed one by one, and all rounds read that exchange.

Defined results: a null text counts as empty; documents are compared as UTF-8
bytes and matches end with them; rows that repeat a doc_id are documents of
their own; a character that is cut in two is dropped from the text that
``without_repeats`` returns; extra columns pass through there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import free_names, partitions

MIN_BYTES = 400
ROUNDS = 2
GRAM = 12
BLOCK_BYTES = 12 * 1024 * 1024
# Of a window's digest 96 bits are sent: windows are most of the messages.
WINDOW_BITS = ((1 << 64) - 1) << 64 | (1 << 32) - 1
# Anchors whose Python numbers exist at a time.
CHUNK = 1 << 15
# Positions hashed at a time: their arrays stay in the processor's cache.
SEGMENT = 1 << 17

_NAME = "block int, hi long, n long"
_CORE = "block int, hi long, lo long, low long, high long, n long"
_WINDOW = "block int, hi long, lo long, n long"
# Kinds of answers to a shard.
OPEN, WHOLE, MIXED, AGAIN = range(4)


def window_of(min_bytes: int, rounds: int = ROUNDS) -> int:
    """Largest anchor window for which ``rounds`` phrases fit: the first inner
    anchor is at most 2 W - 2 bytes behind the start, each further one at most
    W on, and the last must have a whole window and gram before the end."""
    w = (min_bytes + 3 - GRAM) // (rounds + 3)
    if w < 2:
        raise ValueError("min_bytes is too small for the number of rounds")
    return w


def anchors(raw: np.ndarray, w: int) -> np.ndarray:
    """Positions whose gram hash is the least of one of their windows.

    Decided by the ``w + GRAM`` bytes around; ties are all taken.
    """
    found = []
    n = len(raw) - GRAM + 1
    margin = w - 1
    for a in range(0, n, SEGMENT):
        b = min(a + SEGMENT, n)
        lo, hi = max(0, a - margin), min(n, b + margin)
        x = raw[lo : hi + GRAM - 1].astype(np.uint32)
        two = x[:-1] * np.uint32(0x01000193) + x[1:]
        four = two[:-2] * np.uint32(0x9E3779B1) + two[2:]
        eight = four[:-4] * np.uint32(0x85EBCA77) + four[4:]
        v = eight[:-4] * np.uint32(0xC2B2AE3D) + four[8:]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        if len(v) < w:
            continue
        least = _slide(v, w, np.minimum)
        # The largest of the minima of the windows that hold a position.
        pad = np.zeros(w - 1, np.uint32)
        most = _slide(np.concatenate([pad, least, pad]), w, np.maximum)
        at = np.flatnonzero(most == v) + lo
        found.append(at[(at >= a) & (at < b)])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _slide(v: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` over all windows of ``w``, by doubling."""
    width = 1
    while 2 * width <= w:
        v = pick(v[:-width], v[width:])
        width *= 2
    return pick(v[: len(v) - (w - width)], v[w - width :]) if w > width else v


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b << np.uint64(23) | b >> np.uint64(41))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


@dataclass
class Shard:
    """The documents of a block, their anchors and phrases."""

    texts: list[bytes]
    min_bytes: int

    def __post_init__(self) -> None:
        self.w = window_of(self.min_bytes)
        self.raw = b"".join(self.texts)
        self.ends = np.cumsum([len(t) for t in self.texts])
        self.at = anchors(np.frombuffer(self.raw, np.uint8), self.w)
        self.doc = np.searchsorted(self.ends, self.at, side="right")

    @cached_property
    def symbols(self) -> np.ndarray:
        """Digest of the phrase from each anchor to the next."""
        raw, digest = self.raw, xxhash.xxh3_64_intdigest
        ends = np.append(self.at[1:], len(raw))
        out = np.empty(len(self.at), np.uint64)
        for i in range(0, len(out), CHUNK):
            spans = zip(self.at[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist(), strict=True)
            out[i : i + CHUNK] = [digest(raw[a:b]) for a, b in spans]
        return out

    def intervals(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(interval, whether it lies within the document) of every suffix.

        Going back over the suffixes, each hands its interval to the one
        before, which puts its own phrase (the symbol) in front.
        """
        inside = np.zeros(len(self.at), bool)
        inside[:-1] = self.doc[:-1] == self.doc[1:]
        name, good = self.symbols, inside
        for _ in range(depth - 1):
            name = _mix(self.symbols, np.append(name[1:], np.uint64(0)))
            good = inside & np.append(good[1:], False)
        return name, good

    def refined(self, depth: int, open_: np.ndarray) -> np.ndarray:
        """Intervals at ``depth`` of suffixes in open intervals of the round
        before whose following suffix is in one, too."""
        name, good = self.intervals(depth)
        if depth > 1:
            before, inside = self.intervals(depth - 1)
            live = inside & _among(before, open_)
            good = good & live & np.append(live[1:], False)
        return name[good]

    def ranges(self, open_: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchors, first, last): starts of the windows whose first inner
        anchor it is; of all anchors, or of those in open intervals."""
        live = np.arange(len(self.at))
        if open_ is not None:
            name, good = self.intervals(ROUNDS)
            live = np.flatnonzero(good & _among(name, open_))
        at, doc = self.at[live], self.doc[live]
        before = np.where(live > 0, self.at[live - 1], -self.w)
        start = np.where(doc > 0, self.ends[doc - 1], 0)
        first = np.maximum(np.maximum(before, at - self.w) - self.w + 2, start)
        last = np.minimum(at - self.w + 1, self.ends[doc] - self.min_bytes)
        some = first <= last
        return at[some], first[some], last[some]

    def cores(self, open_: np.ndarray | None = None) -> Iterator[tuple[int, int, int, int]]:
        """(core, anchor, first, last) of ``ranges``; the core is the digest of
        what all windows with this first inner anchor share."""
        raw, digest = self.raw, xxhash.xxh3_128_intdigest
        every = self.ranges(open_)
        before, behind = 1 - self.w, 2 - 2 * self.w + self.min_bytes
        for i in range(0, len(every[0]), CHUNK):
            for a, first, last in zip(*(x[i : i + CHUNK].tolist() for x in every), strict=True):
                yield digest(raw[a + before : a + behind]), a, first, last

    def context(self, anchor: int, first: int, last: int) -> int:
        """Digest of those windows and where they start, as a positive long."""
        around = self.raw[first : last + self.min_bytes]
        return xxhash.xxh3_64_intdigest(around, seed=(anchor - first) << 16 | (anchor - last)) >> 1

    def windows(self, first: int, last: int) -> list[int]:
        raw, digest, n = self.raw, xxhash.xxh3_128_intdigest, self.min_bytes
        return [digest(raw[a : a + n]) & WINDOW_BITS for a in range(first, last + 1)]

    def spans(self, starts: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each document the maximal (start, length) that windows cover."""
        out: list[list[tuple[int, int]]] = [[] for _ in self.texts]
        if not len(starts):
            return out
        starts = np.unique(starts)
        doc = np.searchsorted(self.ends, starts, side="right")
        new = np.append(True, (np.diff(starts) > self.min_bytes) | (np.diff(doc) > 0))
        a = starts[new]
        b = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)] + self.min_bytes
        for d, x, y in zip(doc[new].tolist(), a.tolist(), b.tolist(), strict=True):
            base = int(self.ends[d - 1]) if d else 0
            out[d].append((x - base, y - x))
        return out


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``wanted`` is sorted."""
    if not len(wanted):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _halves(digests: list[int]) -> tuple[pa.Array, pa.Array]:
    low = (1 << 64) - 1
    return _long([d >> 64 for d in digests]), _long([d & low for d in digests])


def interleave(rows: DataFrame, n: int) -> DataFrame:
    """Merge what the shards sent: (block, hi, lo, mixed) of the keys that occur
    twice in all shards together; ``mixed`` if their contexts differ."""
    names = rows.columns
    pair, contexts = "lo" in names, "low" in names

    def task(batches):
        got = list(batches)
        if not sum(b.num_rows for b in got):
            return
        got = pa.Table.from_batches(got)
        key = got.column("hi").to_numpy()
        second = got.column("lo").to_numpy() if pair else np.zeros(len(key), np.int64)
        order = np.lexsort((second, key)) if pair else np.argsort(key, kind="stable")
        key, second = key[order], second[order]
        new = np.append(True, (key[1:] != key[:-1]) | (second[1:] != second[:-1]))
        group = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        total = np.add.reduceat(got.column("n").to_numpy()[order], starts)
        mixed = np.zeros(len(starts), bool)
        if contexts:
            low = np.minimum.reduceat(got.column("low").to_numpy()[order], starts)
            mixed = low != np.maximum.reduceat(got.column("high").to_numpy()[order], starts)
        stay = total[group] > 1
        yield from pa.table(
            {
                "block": got.column("block").to_numpy()[order][stay],
                "hi": key[stay],
                "lo": second[stay],
                "mixed": mixed[group][stay],
            }
        ).to_batches(max_chunksize=100_000)

    return rows.repartition(n, "hi").mapInArrow(task, "block int, hi long, lo long, mixed boolean")


def _answers(parts: dict[int, DataFrame]) -> DataFrame:
    out = None
    for kind, rows in parts.items():
        part = rows.select("block", F.lit(kind).cast("int").alias("kind"), "hi", "lo")
        out = part if out is None else out.unionByName(part)
    return out


def _squeezed(docs: DataFrame) -> DataFrame:
    """``docs`` with texts as compressed UTF-8, in the same column."""
    schema = T.StructType(
        [T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in docs.schema.fields]
    )
    place = docs.columns.index("text")

    def task(batches) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            small = [None if t is None else squeeze(t.encode()) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(small, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(task, schema)


def _shard(docs: pa.Table, min_bytes: int) -> Shard:
    pa.default_memory_pool().release_unused()  # of the block before
    whole = zstandard.ZstdDecompressor().decompress
    return Shard([b"" if t is None else whole(t) for t in docs.column("text").to_pylist()], min_bytes)


def _names(answers: pa.Table, kind: int) -> np.ndarray:
    mine = answers.column("kind").to_numpy() == kind
    return np.sort(answers.column("hi").to_numpy()[mine].view(np.uint64))


def _pairs(answers: pa.Table, kind: int) -> set[int]:
    mine = answers.column("kind").to_numpy() == kind
    hi, lo = (answers.column(c).to_numpy()[mine].view(np.uint64).tolist() for c in ("hi", "lo"))
    return {a << 64 | b for a, b in zip(hi, lo, strict=True)}


def repeated_spans(docs: DataFrame, finish, schema: str | object, min_bytes: int = MIN_BYTES, n_bytes: int | None = None):
    """Find all repeats and hand each block to ``finish(rows, shard, spans)``,
    which returns a table of ``schema``.

    ``rows`` holds the document's columns, with compressed texts.
    """
    size = n_bytes if n_bytes is not None else docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions(docs.sparkSession, size, BLOCK_BYTES)
    (block,) = free_names(docs, "block")
    dealt = _squeezed(docs.withColumn(block, F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")))
    blocks = dealt.groupBy(block)

    def number(rows: pa.Table, length: int) -> pa.Array:
        return pa.array(np.full(length, rows.column(block)[0].as_py(), np.int32))

    def named(rows: pa.Table, found: np.ndarray) -> pa.Table:
        names, times = np.unique(found, return_counts=True)
        return pa.table({"block": number(rows, len(names)), "hi": _long(names), "n": pa.array(times, pa.int64())})

    def first_round(rows: pa.Table) -> pa.Table:
        return named(rows, _shard(rows, min_bytes).refined(1, np.zeros(0, np.uint64)))

    def round_(depth: int):
        def refine(rows: pa.Table, answers: pa.Table) -> pa.Table:
            return named(rows, _shard(rows, min_bytes).refined(depth, _names(answers, OPEN)))

        return refine

    open_ = interleave(blocks.applyInArrow(first_round, _NAME), n)
    for depth in range(2, ROUNDS + 1):
        asked = _answers({OPEN: open_}).groupBy("block")
        open_ = interleave(blocks.cogroup(asked).applyInArrow(round_(depth), _NAME), n)

    def cores(rows: pa.Table, answers: pa.Table) -> pa.Table:
        shard = _shard(rows, min_bytes)
        seen: dict[int, list[int]] = {}
        for core, *part in shard.cores(_names(answers, OPEN)):
            context = shard.context(*part)
            if (entry := seen.get(core)) is None:
                seen[core] = [context, context, 1]
            else:
                entry[0], entry[1], entry[2] = min(entry[0], context), max(entry[1], context), entry[2] + 1
        hi, lo = _halves(list(seen))
        low, high, times = (pa.array([e[i] for e in seen.values()], pa.int64()) for i in range(3))
        return pa.table({"block": number(rows, len(seen)), "hi": hi, "lo": lo, "low": low, "high": high, "n": times})

    asked = _answers({OPEN: open_}).groupBy("block")
    known = interleave(blocks.cogroup(asked).applyInArrow(cores, _CORE), n)
    whole, mixed = known.where("not mixed"), known.where("mixed")

    def windows(rows: pa.Table, answers: pa.Table) -> pa.Table:
        wanted = _pairs(answers, MIXED)
        seen: Counter[int] = Counter()
        if wanted:
            shard = _shard(rows, min_bytes)
            for core, _, a, b in shard.cores():
                if core in wanted:
                    seen.update(shard.windows(a, b))
        hi, lo = _halves(list(seen))
        return pa.table(
            {"block": number(rows, len(seen)), "hi": hi, "lo": lo, "n": pa.array(list(seen.values()), pa.int64())}
        )

    again = interleave(blocks.cogroup(_answers({MIXED: mixed}).groupBy("block")).applyInArrow(windows, _WINDOW), n)

    def last_(rows: pa.Table, answers: pa.Table) -> pa.Table:
        shard = _shard(rows, min_bytes)
        full, part, twice = (_pairs(answers, k) for k in (WHOLE, MIXED, AGAIN))
        runs: list[tuple[int, int]] = []
        if full or part:
            for core, _, a, b in shard.cores():
                if core in full:
                    runs.append((a, b))
                elif core in part:
                    runs += [(s, s) for s, w in enumerate(shard.windows(a, b), a) if w in twice]
        return finish(rows, shard, shard.spans(_every(runs)))

    asked = _answers({WHOLE: whole, MIXED: mixed, AGAIN: again}).groupBy("block")
    return blocks.cogroup(asked).applyInArrow(last_, schema)


def _every(runs: list[tuple[int, int]]) -> np.ndarray:
    """All numbers of ranges with their last one."""
    if not runs:
        return np.zeros(0, np.int64)
    first, last = np.array(runs, np.int64).T
    length = last - first + 1
    return np.repeat(first - np.cumsum(length) + length, length) + np.arange(length.sum())


def kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, length in spans:
        parts.append(text[at:start])
        at = start + length
    return b"".join([*parts, text[at:]])


def removals(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """A row per document: doc_id, n_bytes, spans (start, length in bytes) and
    the bytes that are left."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))

    def finish(rows: pa.Table, shard: Shard, spans: list[list[tuple[int, int]]]) -> pa.Table:
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "n_bytes": pa.array([len(t) for t in shard.texts], pa.int64()),
                "spans": pa.array([[{"start": a, "length": n} for a, n in s] for s in spans], kind),
                "kept": pa.array([kept(t, s) for t, s in zip(shard.texts, spans, strict=True)], pa.binary()),
            }
        )

    schema = "doc_id long, n_bytes long, spans array<struct<start:int,length:int>>, kept binary"
    return repeated_spans(docs.select(F.col("doc_id").cast("long"), "text"), finish, schema, min_bytes)


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with all columns, the repeats cut out of their texts."""
    columns = docs.columns

    def finish(rows: pa.Table, shard: Shard, spans: list[list[tuple[int, int]]]) -> pa.Table:
        own = rows.select(columns)
        new = [
            None if o is None else kept(t, s).decode(errors="ignore")
            for o, t, s in zip(own.column("text").to_pylist(), shard.texts, spans, strict=True)
        ]
        return own.set_column(columns.index("text"), "text", pa.array(new, pa.string()))

    return repeated_spans(docs, finish, docs.schema, min_bytes)
