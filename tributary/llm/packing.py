"""Best-fit packing of token sequences, certified by lower bounds.

Documents are tokenised, ended by an id, and cut only if longer than a
sequence. Pieces are dealt evenly over partitions; each packs its own best-fit
decreasing and compares its number of bins with lower bounds from dual
feasible functions. A partition that meets its bound is certified and keeps
its bins, all but the emptiest; a partition with a gap gives up its
under-filled bins. What is given up goes to fewer partitions, of a bounded
number of pieces, which mix the documents of several, and is packed best-fit
decreasing again; a repacking that needs no fewer bins than came in is not
taken, and a partition with a gap that gains nothing keeps its bins. So a round
either gains a bin or hands on one bin a partition at most, and rounds end.

Defined results: a null or empty text is one piece that holds the end id;
rows that repeat a doc_id, or have none, are documents of their own; an empty
table packs into nothing; extra columns are dropped.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.bpe import Codec, default_path
from tributary.llm.common import written

CAPACITY = 2048
END_ID = 0
# Pieces in a partition: about 100 MB of its Python worker.
PIECES = 200_000
# Partitions of a round come from so many of the one before.
MIX = 8

# Fixed value: the possessive form of the vocabulary's pretoken pattern.
PRETOKENS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECE + ", sequence_id long, offset long, given_up boolean"


@lru_cache(maxsize=2)
def encoder(path: str):
    """A tiktoken encoding with the vocabulary of a tokenizers file.

    Gives the ids of the tokenizers library in a third of its time; a test
    holds the two against each other.
    """
    import tiktoken

    own = Codec(path)
    special = own.added
    ranks = {b: i for i, b in enumerate(own.bytes_of) if b is not None and i not in special.values()}
    made = own.merged[np.argsort(own.merged, kind="stable")]
    if not (np.array_equal(own.merged, made) and own.byte_ids.max() < own.merged.min()):
        raise ValueError("ids of the vocabulary must follow the order of its merges")
    return tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens=special)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: only the first may be short."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((a, capacity) for a in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Tokenise: a row for each piece, with the CRC-32 of its ids."""
    path = path or default_path()
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in _PIECE.split(", ")]

    def task(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_to_numpy
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or "", allowed_special="all"), END_ID).astype("<u4")
                for k, (a, n) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc, k, a, n, zlib.crc32(ids[a : a + n].tobytes())))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, _PIECE)


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """Least number of bins that dual feasible functions allow.

    Two families, each for all of its useful parameters: sizes over
    ``capacity - t`` count whole and those under ``t`` not at all (Martello and
    Toth); sizes are rounded to k-ths (Fekete and Schepers).
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    mass, number = np.cumsum(count * size), np.cumsum(count)
    best = math.ceil(mass[-1] / capacity)
    for t in range(1, capacity // 2 + 1):
        whole = number[-1] - number[capacity - t]
        between = mass[capacity - t] - mass[t - 1]
        best = max(best, int(whole) + math.ceil(between / capacity))
    for k in range(1, 21):
        scaled = (k + 1) * size
        rounded = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        best = max(best, math.ceil(int((count * rounded).sum()) / (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin of each item. Bins wait by the room they have left; the bits of one
    integer tell which rooms there are, so the best fit is its lowest set bit."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
        else:
            b, room = n, capacity
            n += 1
        bins[i] = b
        left = room - size
        if left:
            waiting[left].append(b)
            rooms |= 1 << left
    return bins


def give_up(fill: np.ndarray, bound: int, capacity: int = CAPACITY) -> np.ndarray:
    """Bins to repack: the emptiest one of a certified partition; of one with a
    gap, the emptiest with room for two bins more than the gap."""
    order = np.argsort(fill, kind="stable")
    order = order[fill[order] < capacity]
    if len(fill) <= bound:
        return order[:1]
    room = np.cumsum(capacity - fill[order])
    return order[: int(np.searchsorted(room, (len(fill) - bound + 2) * capacity)) + 1]


def _pack(items: DataFrame, n: int, turn: int, last: bool, capacity: int) -> DataFrame:
    names = [c.split()[0] for c in _PLACED.split(", ")]

    def task(batches) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if got is None or not got.num_rows:
            return
        sizes = got.column("length").to_numpy()
        bins = best_fit_decreasing(sizes, capacity)
        old = np.unique(got.column("sequence_id").to_numpy(), return_inverse=True)[1] if turn else bins
        gained = not turn or bins.max() < old.max()
        if not gained:
            bins = old  # as they came
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        loose = np.zeros(len(fill), bool)
        bound = lower_bound(sizes, capacity)
        if not last and (gained or len(fill) <= bound):
            loose[give_up(fill, bound, capacity)] = True
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        offset = np.empty(len(sizes), np.int64)
        offset[order] = ends - sizes[order] - (np.cumsum(fill) - fill)[bins[order]]
        number = (turn << 56) | (TaskContext.get().partitionId() << 28)
        own = [got.column(c) for c in names[:5]] + [pa.array(number | bins), pa.array(offset), pa.array(loose[bins])]
        yield from pa.Table.from_arrays(own, names).to_batches(max_chunksize=50_000)

    if turn:  # whole bins travel
        dealt = items.repartition(n, "sequence_id")
    else:
        dealt = items.repartition(n, F.xxhash64("doc_id", "piece", "ids_crc32"))
    return dealt.mapInArrow(task, _PLACED)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place pieces (columns of ``pieces``): adds sequence_id and offset."""
    spark = items.sparkSession
    items = written(items, "pieces")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(items.count() / PIECES))
    done, turn, loose = None, 0, items
    while True:
        placed = written(_pack(loose, n, turn, n == 1, capacity), f"packed-{turn}")
        kept = placed.where("not given_up").drop("given_up")
        done = kept if done is None else done.unionByName(kept)
        if n == 1:
            return done
        loose, turn = placed.where("given_up"), turn + 1
        n = max(n // MIX, math.ceil(loose.count() / PIECES), 1)
