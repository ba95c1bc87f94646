"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``. Each
row is kept (cost 0), re-roled to user or assistant (2) or deleted (3); a user
or assistant row with an empty text may be inserted anywhere (2). Rows that are
blank, or repeat an earlier one's role and text, must go; a truncated row that
stays costs 1. Of the cheapest edits those win whose initials, in order, come
first in ASCII (D, I, K, R).

Four states tell how far the pattern has come: nothing yet, after ``s``, after
``u``, after ``a``. The costs to the end, per state, form a vector; a row maps
the vector after it to the one before it. All rows are sorted by one range
shuffle; what a conversation has in one partition is a chunk.

* A conversation with one chunk, nearly every one, is solved where it lies.
* A longer one is solved chunk by chunk. Each starts from a speculative vector
  (zeros; the last one from the true costs of ending) and yields the vector at
  its start. Where the next chunk's result differs from the vector a chunk
  started from by more than a constant, the chunk runs again; passes end when
  none differs. The vectors are then those of one sequential run, up to a
  constant that is summed apart.
* With the stitched costs to the end, every chunk traces the least edits from
  each of the four states; the traces' ends lead from chunk to chunk and pick
  one of the four.

Bounds: a conversation of any length is cut into segments of at most
``SEGMENT`` rows and ``SEGMENT_BYTES`` of text (or one row), so a task holds one
segment, and one byte a row of a chunk's codes and costs; a conversation has a
chunk per partition at most. Its summary, which is one row, reads its segments
one after the other.

Defined results: a null role, text or part of the key of a damaged row counts
as one space; rows of a conversation stand by turn (nulls first), then role,
the text's first characters and its digest; repeated rows are duplicates; a
role that begins with none of s, u, a (or is empty) can't be kept; null
conv_ids are one conversation; a conversation without rows has zeros and an
empty audit; further columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b, sha256
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import written

SEGMENT = 4096
SEGMENT_BYTES = 4 * 1024 * 1024
# Rows of a partition, and so of a chunk, on average at most.
PARTITION_ROWS = 500_000

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# A row's code: its role's initial in the low bits, then what is wrong with it.
OTHER, GONE, CUT, REPEATED = 3, 4, 8, 16
INITIALS = {"s": 0, "u": 1, "a": 2}
ROLES = {1: "user", 2: "assistant"}
BLANKS = " \t\n\v\f\r"

# The pattern's states: start, after s, after u, after a. Which one a kept
# initial leads to, and which one the user or assistant row that fits leads to.
KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
NEXT = (2, 2, 3, 2)
STATES = range(4)
# Costs of ending in a state, with the rows still to be inserted.
END = (0, 2 * INSERT, INSERT, 0)
ANY = (0, 0, 0, 0)

Vector = tuple[int, int, int, int]


# -- Viterbi ---------------------------------------------------------------
def less(vector: Vector) -> tuple[Vector, int]:
    """The vector without its constant, and the constant."""
    low = min(vector)
    return tuple(v - low for v in vector), low  # type: ignore[return-value]


@lru_cache(maxsize=1 << 16)
def before(code: int, after: Vector) -> tuple[Vector, int]:
    """Costs before a row with ``code`` from those after it, and a constant."""
    found = []
    for q in STATES:
        costs = [DELETE + after[q]]
        if not code & GONE:
            extra = TRUNCATED if code & CUT else 0
            to = KEPT[q].get(code & 3)
            if to is not None:
                costs.append(extra + after[to])
            costs.append(extra + REROLE + after[NEXT[q]])
        found.append(min(costs))
    for _ in range(2):  # an insertion may follow another
        found = [min(found[q], INSERT + found[NEXT[q]]) for q in STATES]
    return less(tuple(found))


def backward(codes: bytes, end: Vector) -> tuple[list[Vector], int]:
    """Costs before every row and after the last, without constants, and the
    sum of the constants."""
    vectors, total = [end], 0
    for code in reversed(codes):
        vector, low = before(code, vectors[-1])
        vectors.append(vector)
        total += low
    return vectors[::-1], total


@lru_cache(maxsize=1 << 18)
def choices(code: int, after: Vector, q: int) -> tuple[str, int]:
    """The least cheapest edits up to and with a row, and the state after it."""
    here, low = before(code, after)
    made = ""
    while True:
        cost = here[q] + low
        extra = TRUNCATED if code & CUT else 0
        to = None if code & GONE else KEPT[q].get(code & 3)
        if DELETE + after[q] == cost:
            return made + "D", q
        if INSERT + here[NEXT[q]] + low == cost:
            made, q = made + "I", NEXT[q]
        elif to is not None and extra + after[to] == cost:
            return made + "K", to
        else:
            return made + "R", NEXT[q]


def trace(codes: bytes, vectors: list[Vector], q: int, last: bool) -> tuple[list[str], int]:
    """Edits per row from a state on, and the state at the end; after the last
    row of a conversation come the insertions that complete it."""
    edits = []
    for i, code in enumerate(codes):
        made, q = choices(code, vectors[i + 1], q)
        edits.append(made)
    if last:
        made = ""
        while q in (1, 2):
            made, q = made + "I", NEXT[q]
        edits.append(made)
    return edits, q


def repaired(edits: list[str], roles: list[str], texts: list[str], q: int) -> list[tuple[str, str]]:
    """The rows that the edits leave or insert, from a state on."""
    out = []
    for i, made in enumerate(edits):
        for edit in made:
            if edit == "D":
                continue
            if edit == "K":
                out.append((roles[i], texts[i]))
                q = KEPT[q][INITIALS[roles[i][:1]]]
            else:
                role = ROLES[1 if NEXT[q] == 2 else 2]
                out.append((role, "" if edit == "I" else texts[i]))
                q = NEXT[q]
    return out


# -- rows ------------------------------------------------------------------
def blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): the form that ``segments`` takes."""
    return conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), F.lit(True).alias("present"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that their key's checksum decides on; dropped ones
    stay as absent, so that no conversation is lost."""
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    text = (
        F.when(F.col("kind").isin(0, 1), F.lit(""))
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(times).alias("copy"),
    ).drop("copy")


_SEGMENT = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("whole", pa.bool_()),
        ("codes", pa.binary()), ("digests", pa.list_(pa.binary())),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("edits", pa.list_(pa.string())),
        ("state", pa.int32()), ("cost", pa.int64()),
        ("turns", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("illegal", pa.int64()),
    ]
)
_SEGMENT_DDL = (
    "conv_id long, part int, seg long, whole boolean, codes binary, digests array<binary>, roles array<string>, "
    "texts array<string>, edits array<string>, state int, cost long, turns long, low long, high long, illegal long"
)


def code_of(role: str, text: str) -> int:
    code = INITIALS.get(role[:1], OTHER)
    words = text.rstrip(BLANKS)
    if not words:
        return code | GONE
    return code if words[-1] in ".!?" else code | CUT


def legal(a: int, b: int) -> bool:
    return (a & 3, b & 3) in ((0, 1), (1, 2), (2, 1))


class Piece:
    """Consecutive rows of one conversation."""

    def __init__(self, conv: int | None, part: int, seg: int):
        self.conv, self.part, self.seg = conv, part, seg
        self.codes, self.digests, self.roles, self.texts = bytearray(), [], [], []
        self.size, self.turns, self.low, self.high, self.illegal = 0, 0, None, None, 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        code = code_of(role, text)
        if self.codes and not legal(self.codes[-1], code):
            self.illegal += 1
        self.codes.append(code)
        named = f"{len(role)}:{role}{text}".encode()
        self.digests.append(None if code & GONE else blake2b(named, digest_size=16).digest())
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def full(self) -> bool:
        return len(self.codes) >= SEGMENT or self.size >= SEGMENT_BYTES

    def row(self, whole: bool) -> dict:
        """The segment; a whole conversation's one is solved."""
        edits, cost, codes = None, None, bytes(self.codes)
        if whole:
            seen, repeats = set(), []
            for i, digest in enumerate(self.digests):
                if digest in seen:
                    repeats.append(i)
                elif digest:
                    seen.add(digest)
            codes = mark(codes, repeats)
            vectors, cost = backward(codes, END)
            edits, _ = trace(codes, vectors, 0, True)
            cost += vectors[0][0]
        return {
            "conv_id": self.conv, "part": self.part, "seg": self.seg, "whole": whole, "codes": codes,
            "digests": None if whole else self.digests, "roles": self.roles, "texts": self.texts, "edits": edits,
            "state": 0 if whole else None, "cost": cost, "turns": self.turns, "low": self.low, "high": self.high,
            "illegal": self.illegal,
        }


def mark(codes: bytes, repeats: list[int]) -> bytes:
    """Codes with the repeated rows (none of them blank) marked."""
    out = bytearray(codes)
    for i in repeats:
        out[i] |= REPEATED | GONE
    return bytes(out)


def faults(codes: bytes) -> tuple[int, int, int]:
    """Blank, repeated and truncated rows: each one's first fault."""
    n_blank = sum(1 for c in codes if c & GONE and not c & REPEATED)
    return n_blank, sum(1 for c in codes if c & REPEATED), sum(1 for c in codes if c & CUT and not c & GONE)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SEGMENT)


def _segmented(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows. The first and last conversation of a partition
    may go on in its neighbours: only those between are known to be whole."""
    piece, seen, out, held = None, 0, [], 0

    def flush(done: Piece, whole: bool) -> Iterator[pa.RecordBatch]:
        nonlocal out, held
        out.append(done.row(whole))
        held += done.size
        if len(out) >= 512 or held >= SEGMENT_BYTES:
            yield _batch(out)
            out, held = [], 0

    for batch in batches:
        for conv, turn, role, text, present, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if piece is None or conv != piece.conv:
                if piece is not None:
                    yield from flush(piece, seen > 1 and piece.seg == 0)
                piece, seen = Piece(conv, part, 0), seen + 1
            elif piece.full():
                yield from flush(piece, False)
                piece = Piece(conv, part, piece.seg + 1)
            if present:
                piece.add(turn, role, text)
    if piece is not None:
        yield from flush(piece, False)
    if out:
        yield _batch(out)


def segments(rows: DataFrame) -> DataFrame:
    """All rows in order, cut into segments; those of whole conversations are
    solved already."""
    configured = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(configured, math.ceil(rows.count() / PARTITION_ROWS))
    keyed = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        "present",
        F.substring("text", 1, 32).alias("head"),
        F.xxhash64("text").alias("hash"),
        F.monotonically_increasing_id().alias("tie"),  # deals out repeated rows
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "hash", "tie")]
    dealt = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ready = dealt.select("conv_id", "turn", "role", "text", "present", F.spark_partition_id().alias("part"))
    return written(ready.mapInArrow(_segmented, _SEGMENT_DDL), "segments")


# -- chunks of long conversations ------------------------------------------
CHUNK = ["conv_id", "part"]
_VECTORS = "conv_id long, part int, start array<int>, total long"


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which conv_id may be null."""
    other = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return left.join(other, same, how).drop(*[f"_{c}" for c in keys])


def _by_chunk(rows: DataFrame, *order: Column | str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *CHUNK).sortWithinPartitions(*CHUNK, *order)


def _grouped(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows that are equal in their first ``width`` columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    return groupby(rows, key=lambda row: row[:width])


def _table(schema: pa.Schema, rows: Iterable[tuple], size: int = 512) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), schema.types, strict=True)], schema.names)


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [mark(c, r or []) for c, r in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes, pa.binary())], ["conv_id", "part", "seg", "codes"])


def _codes(parts: DataFrame) -> DataFrame:
    """(conv_id, part, seg, codes) of the segments, repeated rows marked."""
    place = F.shiftleft(F.col("part").cast("long"), 44) + F.shiftleft("seg", 13) + F.col("row")
    rows = parts.select("conv_id", "part", "seg", F.posexplode("digests").alias("row", "digest")).where("digest is not null")
    rows = rows.withColumn("place", place)
    firsts = (
        rows.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    repeats = _matched(rows, firsts, ["conv_id", "digest"]).where("place > first")
    listed = repeats.groupBy("conv_id", "part", "seg").agg(F.collect_list("row").alias("repeats"))  # of one segment
    joined = _matched(parts.select("conv_id", "part", "seg", "codes"), listed, ["conv_id", "part", "seg"], "left")
    return written(joined.mapInArrow(_marked, "conv_id long, part int, seg long, codes binary"), "codes")


def _run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk from its end vector to its start; segments come last first."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("start", pa.list_(pa.int32())), ("total", pa.int64())])

    def found() -> Iterator[tuple]:
        for key, rows in _grouped(batches, 2):
            vector, total = None, 0
            for *_, codes, end in rows:
                vectors, low = backward(codes, tuple(end) if vector is None else vector)
                vector, total = vectors[0], total + low
            yield (*key, vector, total)

    return _table(schema, found())


def _vectors(codes: DataFrame, chunks: DataFrame) -> DataFrame:
    """(conv_id, part, idx, last, end, start, total): passes over the chunks
    until each has run from what the next one yields."""

    def run(todo: DataFrame) -> DataFrame:
        rows = _matched(codes, todo.select(*CHUNK, "end"), CHUNK).select(*CHUNK, "seg", "codes", "end")
        ran = _by_chunk(rows, F.col("seg").desc()).mapInArrow(_run, _VECTORS)
        return written(_matched(todo, ran, CHUNK), "vectors")

    def vector(values: Vector) -> Column:
        return F.array(*map(F.lit, values))

    now = run(chunks.withColumn("end", F.when(F.col("last"), vector(END)).otherwise(vector(ANY))))
    while True:
        after = now.select("conv_id", (F.col("idx") - 1).alias("idx"), F.col("start").alias("wanted"))
        seen = _matched(now, after, ["conv_id", "idx"], "left").withColumn("wanted", F.coalesce("wanted", "end"))
        stale = seen.where("wanted <> end").select(*CHUNK, "idx", "last", F.col("wanted").alias("end"))
        if stale.isEmpty():
            return now
        again = run(stale)
        right = seen.where("wanted = end").select(*now.columns)
        now = written(right.unionByName(again.select(*now.columns)), "passes")


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that a chunk's least edits end in, from each of the four."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("ends", pa.list_(pa.int32()))])

    def found() -> Iterator[tuple]:
        for key, rows in _grouped(batches, 2):
            run = list(rows)
            codes = b"".join(r[3] for r in run)
            vectors, _ = backward(codes, tuple(run[0][4]))
            yield (*key, [trace(codes, vectors, q, False)[1] for q in STATES])

    return _table(schema, found())


def _stitched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that each chunk of a conversation begins in."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("state", pa.int32())])

    def found() -> Iterator[tuple]:
        for key, rows in _grouped(batches, 1):
            q = 0
            for _, _, part, ends in rows:
                yield (*key, part, q)
                q = ends[q]

    return _table(schema, found())


_EDITS = "conv_id long, part int, seg long, codes binary, edits array<string>, state int, cost long"


def _traced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each segment of a chunk, from the state it begins in."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("codes", pa.binary()),
         ("edits", pa.list_(pa.string())), ("state", pa.int32()), ("cost", pa.int64())]
    )

    def found() -> Iterator[tuple]:
        for key, rows in _grouped(batches, 2):
            run = list(rows)
            *_, end, state, total, first, last = run[0]
            vectors, _ = backward(b"".join(r[3] for r in run), tuple(end))
            q, at = state, 0
            cost = total + (vectors[0][0] if first else 0)
            for k, (*_, seg, codes, _, _, _, _, _) in enumerate(run):
                edits, q_next = trace(codes, vectors[at : at + len(codes) + 1], q, last and k == len(run) - 1)
                yield (*key, seg, codes, edits, q, cost)
                q, at, cost = q_next, at + len(codes), 0

    return _table(schema, found(), 16)


def _long(parts: DataFrame) -> DataFrame:
    """The segments of conversations that are not known to be whole, solved."""
    codes = _codes(parts)
    by_part = Window.partitionBy("conv_id").orderBy("part")
    # A conversation has a chunk per partition at most.
    numbered = codes.select(*CHUNK).distinct().select(
        *CHUNK, F.row_number().over(by_part).alias("idx"), F.lead("part").over(by_part).isNull().alias("last")
    )
    vectors = _vectors(codes, written(numbered, "chunks"))
    full = _matched(codes, vectors.select(*CHUNK, "end"), CHUNK).select(*CHUNK, "seg", "codes", "end")
    ends = _by_chunk(full, "seg").mapInArrow(_ends, "conv_id long, part int, ends array<int>")
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = _matched(vectors.select(*CHUNK, "idx"), ends, CHUNK).select("conv_id", "idx", "part", "ends")
    in_order = in_order.repartition(n, "conv_id").sortWithinPartitions("conv_id", "idx")
    states = written(in_order.mapInArrow(_stitched, "conv_id long, part int, state int"), "states")
    known = _matched(vectors, states, CHUNK).select(*CHUNK, "end", "state", "total", (F.col("idx") == 1).alias("first"), "last")
    ready = _matched(codes, known, CHUNK).select(*CHUNK, "seg", "codes", "end", "state", "total", "first", "last")
    edits = _by_chunk(ready, "seg").mapInArrow(_traced, _EDITS)
    rest = parts.drop("codes", "digests", "edits", "state", "cost")
    return _matched(rest, edits, ["conv_id", "part", "seg"])


# -- results ---------------------------------------------------------------
SOLVED = ["conv_id", "part", "seg", "codes", "roles", "texts", "edits", "state", "cost", "turns", "low", "high", "illegal"]


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Solved segments of (conv_id, turn, role, text, present) rows: those of
    conversations with one segment, and those of others. A segment has its rows
    (codes, roles, texts), the edits of each row and the state they begin in."""
    found = segments(rows)
    whole = found.where("whole").select(*SOLVED)
    parts = found.where("not whole").drop("whole")
    return whole, written(_long(parts).select(*SOLVED), "long")


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("row", pa.int32()), ("role", pa.string()), ("text", pa.string())])

    def found() -> Iterator[tuple]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "seg", "roles", "texts", "edits", "state")), strict=True):
                *key, roles, texts, edits, q = row
                for i, (role, text) in enumerate(repaired(edits, roles, texts, q)):
                    yield (*key, i, role, text)

    return _table(schema, found())


def turns(solved: tuple[DataFrame, DataFrame]) -> DataFrame:
    """The repaired rows (conv_id, part, seg, row, role, text); a conversation's
    stand in the order of part, seg, row."""
    ddl = "conv_id long, part int, seg long, row int, role string, text string"
    return solved[0].mapInArrow(_turns, ddl).unionByName(solved[1].mapInArrow(_turns, ddl))


_SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, digest string"
)


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation, whose segments come in order."""
    schema = pa.schema(
        [("conv_id", pa.int64())]
        + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string()), ("digest", pa.string())]
    )

    def found() -> Iterator[tuple]:
        for (conv,), rows in _grouped(batches, 1):
            counts, total, wrong, n_turns = [0, 0, 0], 0, 0, 0
            low = high = last = None
            audit, digest, empty = [], sha256(), True
            for _, _, _, codes, roles, texts, edits, state, cost, n, first, latest, illegal in rows:
                counts = [a + b for a, b in zip(counts, faults(codes), strict=True)]
                total, wrong = total + cost, wrong + illegal
                if codes:
                    wrong += last is not None and not legal(last, codes[0])
                    last = codes[-1]
                if n:
                    n_turns += n - (high is not None and first == high)
                    low, high = first if low is None else low, latest
                audit.append("".join(edits))
                for role, text in repaired(edits, roles, texts, state):
                    digest.update(f"{role}:{text}".encode() if empty else f"\n{role}:{text}".encode())
                    empty = False
            gaps = 0 if low is None else high - low + 1 - n_turns
            yield (conv, gaps, *counts, wrong, total, "".join(audit), digest.hexdigest())

    return _table(schema, found())


def summaries(solved: tuple[DataFrame, DataFrame]) -> DataFrame:
    """A row per conversation: its faults before the repair, the edits' cost and
    initials, and the digest of its repaired rows, ``role:text`` by line."""
    whole, parts = solved
    n = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = parts.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return whole.mapInArrow(_summed, _SUMMARY).unionByName(in_order.mapInArrow(_summed, _SUMMARY))
