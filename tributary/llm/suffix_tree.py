"""Language-model scoring with a probabilistic suffix tree.

Symbols are the words that training texts hold ``WORD_MIN`` times, and for all
others classes by ending; a word counts with the probability of its symbol in
context times its share of the class. The tree's contexts are sequences of
symbols of variable length, up to ``DEPTH``. It grows by levels: a context is
considered if training texts hold it ``CONTEXT_MIN`` times, a next symbol is
listed if it follows ``ENTRY_MIN`` times, and the context is retained if its
next-symbol distribution diverges from that of its longest retained suffix.
Distributions are smoothed by absolute discounting towards that suffix; the
longest retained suffix of the history is the state that scores a token. All
limits are counts, not shares: the more text, the more words and contexts.

The tree never leaves the executors. Texts are read once, into blocks of bounded
size that keep their tokens as numbers. For each level a block asks for its
distinct strings, a row for each range of string hashes; a range sums what all
blocks have counted and answers each in the order of its questions. Of the blocks
that hold a listed string one puts it into a table, in which contexts are weighed;
their blocks are told what they leave to the suffix. What a block lists of one level
and asks for the next is found in one pass over it, as counts alone decide what is
asked. A string is asked for once a block at most, so none is hot. Only sums over all
words and by ending (two bytes and a mark) come to the driver. Numbers are stored and
sent compressed, so an exchange takes no more disk than the table behind it.

Strings are told apart by 64 bits.

Defined results: a null text is the end token alone; a null doc_id is in the
training part; with no training token every count is zero and all symbols are
alike; rows that repeat a doc_id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import partitions, written
from tributary.session import fresh_dir
from tributary.sources.catalog import remove

WORD_MIN = 32
CLASS_MIN = 32
CONTEXT_MIN = 32
ENTRY_MIN = 3
DEPTH = 3
DISCOUNT = 0.75
# Nats for each listed symbol by which a retained context describes better.
DIVERGENCE = 3.0
ALPHA = 0.1
BLOCK_BYTES = 8 * 1024 * 1024
# Blocks are exchanged in up to so many shares, of so many blocks at least.
WAVES = 4
WAVE_BLOCKS = 24
END = b"\n"  # no word holds it
MARKS = b".,;:!?&*%$#|"
BEFORE = np.uint64(3)  # code of the symbol before a text
_IS_MARK = np.isin(np.arange(256), list(MARKS))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def words_of(text: str | bytes | None) -> list[bytes]:
    """Lower-cased words and the end token. Bytes: only A-Z change, and only
    \\x20 and \\x09-\\x0D part words."""
    data = text.encode() if isinstance(text, str) else text or b""
    return [*data.lower().split(), END]


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def ending(word: bytes) -> int:
    """Class of a word: its last two bytes before marks, and its last mark."""
    stem = word.rstrip(MARKS)
    mark = word[len(stem) :][-1:]
    return int.from_bytes(stem[-2:].rjust(2, b"\0") + (mark or b"\0"), "big")


def endings(words: list[bytes]) -> np.ndarray:
    """``ending`` of each word: words of more than one mark at the end, or of few
    bytes, one by one."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    data = np.frombuffer(b"\0" * 3 + b"".join(words), np.uint8)
    a, b, c = (data[ends + i].astype(np.int32) for i in range(3))  # the last three bytes of each
    mark = _IS_MARK[c]
    out = np.where(mark, a << 16 | b << 8 | c, b << 16 | c << 8)
    odd = (mark & _IS_MARK[b]) | (np.diff(ends, prepend=0) < 3)
    for i in np.flatnonzero(odd).tolist():
        out[i] = ending(words[i])
    return out


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the string ``a`` with the symbol ``b`` behind it."""
    with np.errstate(over="ignore"):
        x = np.uint64(0x9E3779B97F4A7C15) * np.asarray(a, np.uint64) + np.asarray(b, np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct codes, a place of each, the number of each place's code).
    Sorted as plain numbers: a code's first bits, and its place in the last ones;
    codes that only differ in those are rare, and then sorted in full."""
    bits = np.uint64(max(len(codes) - 1, 1).bit_length())
    keys = codes >> bits << bits | np.arange(len(codes), dtype=np.uint64)
    keys.sort()
    order = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = codes[order]
    if (found[1:] < found[:-1]).any():
        order = np.argsort(codes, kind="stable")
        found = codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = found[1:] != found[:-1]
    number = np.empty(len(codes), np.int64)
    number[order] = np.cumsum(new) - 1
    return found[new], order[new], number


def bucket_of(codes: np.ndarray, n: int) -> np.ndarray:
    """Range of each hash: rises with the hash."""
    return ((codes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def bucket_column(code: Column, n: int) -> Column:
    """``bucket_of`` in the JVM."""
    return F.shiftright(F.shiftrightunsigned(code, 32) * F.lit(n), 32).cast("int")


@dataclass
class Model:
    """What all blocks share: sums over words, and classes by ending."""

    n_tokens: int = 0
    n_words: int = 0
    n_symbols: int = 1
    n_ends: int = 0  # training texts
    word_min: int = WORD_MIN
    endings: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    # Tokens and words of each class; the last one is that of all other endings.
    class_tokens: np.ndarray = field(default_factory=lambda: np.zeros(1))
    class_words: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def symbols_of(self, hashes: np.ndarray, endings: np.ndarray, c: np.ndarray) -> tuple:
        """(code, tokens, P(word | symbol)) of words with the counts ``c``."""
        own = c >= self.word_min
        place = np.full(len(hashes), len(self.endings))
        if len(self.endings):
            at = np.minimum(np.searchsorted(self.endings, endings), len(self.endings) - 1)
            place = np.where(self.endings[at] == endings, at, place)
        code = np.where(own, mixed(hashes, np.uint64(1)), mixed(place.astype(np.uint64), np.uint64(2)))
        tokens = np.where(own, c, self.class_tokens[place])
        share = (c + ALPHA) / (self.class_tokens[place] + ALPHA * (self.class_words[place] + 1))
        return code, tokens, np.where(own, 1.0, share)

    def root(self, tokens: np.ndarray) -> np.ndarray:
        return (tokens + ALPHA) / (self.n_tokens + ALPHA * self.n_symbols)


# -- blocks and their words ------------------------------------------------
_BLOCK = (
    "block long, bucket int, hashes binary, endings binary, n binary, "
    "doc_id binary, known binary, held binary, lengths binary, tokens binary"
)


def _bytes(x: np.ndarray, rising: bool = False) -> bytes:
    """Numbers byte by byte, the first bytes first, which leaves the zeros of
    small ones together; of rising ones the differences. Compressed here, as an
    exchange takes other codecs than a table."""
    if rising and len(x):
        x = np.concatenate([x[:1], np.diff(x)])
    x = np.ascontiguousarray(x)
    return zstandard.compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes(), 1)


def _numbers(data: bytes, kind, rising: bool = False) -> np.ndarray:
    """Inverse of ``_bytes``."""
    data, width = zstandard.decompress(data), np.dtype(kind).itemsize
    x = np.frombuffer(data, np.uint8).reshape(width, len(data) // width).T
    x = np.ascontiguousarray(x).view(kind).reshape(-1)
    return np.cumsum(x, dtype=kind) if rising else x


def _cut(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, start, end) of the runs of sorted ``codes`` in each bucket."""
    at = bucket_of(codes, n)
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    return at[starts], starts, np.append(starts[1:], len(at)) if len(starts) else starts


def blocks(docs: DataFrame, n: int) -> DataFrame:
    """Blocks of documents: a row with the tokens, as places in the block's
    sorted distinct word hashes, and a row for each of ``n`` ranges of hashes
    with the words in it and how often training texts of the block hold them."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [("block", pa.int64()), ("bucket", pa.int32())] + [(c, pa.binary()) for c in _names(_BLOCK)[2:]]
        )
        ids, held, lengths, words, size = [], [], [], [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            column = pa.array(words, pa.large_binary()).dictionary_encode()
            index = column.dictionary.to_numpy(zero_copy_only=False).tolist()
            hashes = np.fromiter(map(word_hash, index), np.uint64, len(index))
            kinds = endings(index)
            codes, first, back = distinct(hashes)
            flat = back[column.indices.to_numpy()].astype("<u4")
            trained = np.repeat(~np.array(held), lengths)
            counts = np.bincount(flat[trained], minlength=len(codes)).astype(np.int64)
            known = np.array([d is not None for d in ids])
            state = [
                np.array([d or 0 for d in ids], np.int64), known, np.array(held), np.array(lengths, np.int64), flat,
            ]
            rows = [(number, None, None, None, None, *map(_bytes, state))]
            kinds = kinds[first]
            for b, s, e in zip(*_cut(codes, n), strict=True):
                asked = _bytes(codes[s:e], True), _bytes(kinds[s:e]), _bytes(counts[s:e])
                rows.append((number, int(b), *asked, *[None] * 5))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )
            number += 1
            size = 0
            for x in (ids, held, lengths, words):
                x.clear()

        for batch in batches:
            for doc, text, out in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = words_of(text)
                words += found
                ids.append(doc)
                held.append(out)
                lengths.append(len(found))
                size += len(text or b"") + 64
                if size >= BLOCK_BYTES:
                    yield from finished()
        if ids:
            yield from finished()

    text = F.col("text").cast("binary")
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(task, _BLOCK)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(c, kinds[k]) for c, k in (x.split() for x in schema.split(", "))]).empty_table()


def _joined(column: pa.ChunkedArray | pa.Array, kind, rising: bool = False) -> np.ndarray:
    return _parts(column, kind, rising)[0]


def _parts(column: pa.ChunkedArray | pa.Array, kind, rising: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all cells, where to split them into cells)."""
    cells = [_numbers(x, kind, rising) for x in column.to_pylist()]
    return np.concatenate(cells or [np.zeros(0, kind)]), np.cumsum([len(x) for x in cells], dtype=np.int64)[:-1]


def word_counts(asked: DataFrame, word_min: int) -> DataFrame:
    """Answers (block, bucket, counts) to the blocks' words; beside them, for
    each range, sums by ending: (ending, tokens, words, own): ``own`` is 1 for
    words with a symbol of their own."""

    def answer(group: pa.Table) -> pa.Table:
        hashes, ends = _parts(group.column("hashes"), np.uint64, True)
        codes, first, back = distinct(hashes)
        c = np.bincount(back, _joined(group.column("n"), np.int64), len(codes)).astype(np.int64)
        counts = [_bytes(x) for x in np.split(c[back], ends)]
        kind = _joined(group.column("endings"), np.int32)[first].astype(np.int64) * 2 + (c >= word_min)
        kinds, of = np.unique(kind[c > 0], return_inverse=True)
        blank, rows = [None] * len(kinds), [None] * len(counts)
        return pa.table(
            {
                "block": pa.array(group.column("block").to_pylist() + blank, pa.int64()),
                "bucket": pa.array(group.column("bucket").to_pylist() + blank, pa.int32()),
                "counts": pa.array(counts + blank, pa.binary()),
                "ending": pa.array(rows + (kinds // 2).tolist(), pa.int64()),
                "own": pa.array(rows + (kinds % 2).tolist(), pa.int64()),
                "tokens": pa.array(rows + np.bincount(of, c[c > 0]).astype(np.int64).tolist(), pa.int64()),
                "words": pa.array(rows + np.bincount(of).tolist(), pa.int64()),
            }
        )

    schema = "block long, bucket int, counts binary, ending long, own long, tokens long, words long"
    return asked.groupBy("bucket").applyInArrow(answer, schema)


def shared_model(counts: DataFrame, n_ends: int, word_min: int, class_min: int) -> Model:
    """Sums over all words; what is collected is bounded by the endings."""
    sums = counts.where("block is null").groupBy("ending", "own").agg(F.sum("tokens").alias("c"), F.sum("words").alias("v"))
    rows = sorted((r.ending, r.own, r.c, r.v) for r in sums.collect())
    rest = [r for r in rows if not r[1]]
    own = [r for r in rest if r[2] >= class_min]
    other = [r for r in rest if r[2] < class_min]
    return Model(
        n_tokens=sum(r[2] for r in rows),
        n_words=sum(r[3] for r in rows),
        n_symbols=sum(r[3] for r in rows if r[1]) + len(own) + 1,
        n_ends=n_ends,
        word_min=word_min,
        endings=np.array([r[0] for r in own], np.int64),
        class_tokens=np.array([r[2] for r in own] + [sum(r[2] for r in other)], float),
        class_words=np.array([r[3] for r in own] + [sum(r[3] for r in other)], float),
    )


# -- the tree --------------------------------------------------------------
@dataclass
class Limits:
    """Least counts in training texts."""

    word: int = WORD_MIN
    kind: int = CLASS_MIN  # of an ending with a class of its own
    context: int = CONTEXT_MIN
    entry: int = ENTRY_MIN


class Asked:
    """Distinct strings of one length that a block holds, by hash: the places of
    the tokens that end one, and for each string its context and one such place."""

    def __init__(self, walk: Walk):
        self.candidate = np.flatnonzero(walk.context_n >= walk.limits.context)
        codes = mixed(walk.context[self.candidate], walk.symbol[self.candidate])
        self.codes, first, self.of_token = distinct(codes)
        self.at = self.candidate[first]
        self.context, self.context_n = walk.context[self.at], walk.context_n[self.at]

    @cached_property
    def contexts(self) -> np.ndarray:
        """Distinct contexts, sorted."""
        return self._contexts[0]

    @cached_property
    def of_context(self) -> np.ndarray:
        return self._contexts[2]

    @cached_property
    def _contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return distinct(self.context)


class Walk:
    """The tokens of a block on their way down the levels of the tree."""

    def __init__(self, model: Model, symbol, tokens, lengths, trained, limits: Limits):
        self.symbol, self.trained, self.limits = symbol, trained, limits
        self.starts = np.cumsum(lengths) - lengths
        # What lies before a text is counted as often as there are training texts.
        self.blank, self.n_ends = BEFORE, float(model.n_ends)
        self.p = model.root(tokens)
        self.context, self.context_n = self._behind(symbol, tokens)

    def _behind(self, codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, n = np.roll(codes, 1), np.roll(n, 1).astype(float)
        codes[self.starts], n[self.starts] = self.blank, self.n_ends
        return codes, n

    def counts(self, asked: Asked) -> np.ndarray:
        """How often the block's training texts hold each string; all else that
        is known of a string is alike in all blocks."""
        return np.bincount(asked.of_token, self.trained[asked.candidate], len(asked.codes)).astype(np.int64)

    def weigh(self, asked: Asked, n: np.ndarray, left: np.ndarray) -> None:
        """Probabilities of this level; ``left`` is four times what each string's
        context leaves to its suffix, 0 if it is not retained."""
        share = np.where((left > 0) & (n >= self.limits.entry), (n - DISCOUNT) / asked.context_n, 0.0)
        left = np.where(left > 0, left / 4 / asked.context_n, 1.0)
        self.p[asked.candidate] = share[asked.of_token] + left[asked.of_token] * self.p[asked.candidate]

    def deepen(self, asked: Asked, n: np.ndarray) -> None:
        """One symbol deeper: what was asked for are the next contexts."""
        codes, counts = np.zeros(len(self.p), np.uint64), np.zeros(len(self.p))
        codes[asked.candidate], counts[asked.candidate] = asked.codes[asked.of_token], n[asked.of_token]
        self.blank = mixed(self.blank, BEFORE)
        self.context, self.context_n = self._behind(codes, counts)


_STATE = (
    "block long, doc_id binary, known binary, held binary, lengths binary, n_known binary, base binary, inner binary, "
    "tokens binary, codes binary, counts binary"
)
_ASK = "block long, bucket int, codes binary, n binary"
_ENTRY = (
    "context long, n long, context_n double, parent double, block long, bucket int, contexts binary, "
    "codes binary, counts binary, kind int"
)
LISTED, CONTEXTS, WANTED = range(3)  # kinds of these rows
# ``n`` is twice the count, and one more for the block that is to report the
# string; ``escape`` is four times what the context leaves, 0 if not retained.
_ANSWER = "block long, depth int, bucket int, n binary, escape binary"


def _frequent(tokens: np.ndarray) -> np.ndarray:
    """Symbols by falling frequency: small numbers for most tokens compress better."""
    return np.argsort(-tokens, kind="stable")


def states(cut: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """Blocks as symbols: texts' sums that need no context, and tokens as places
    in the block's symbols."""
    shared = cut.sparkSession.sparkContext.broadcast(model)

    def state(group: pa.Table, counts: pa.Table) -> pa.Table:
        own: Model = shared.value
        rows = group.sort_by("bucket")  # the row of tokens, with no bucket, is the last one
        ask = rows.slice(0, rows.num_rows - 1)
        hashes, kinds = _joined(ask.column("hashes"), np.uint64, True), _joined(ask.column("endings"), np.int32)
        c = _joined(counts.sort_by("bucket").column("counts"), np.int64).astype(float)
        if len(c) != len(hashes):
            raise RuntimeError("a block lacks counts of its words")
        last = rows.slice(rows.num_rows - 1)
        lengths = _joined(last.column("lengths"), np.int64)
        flat = _joined(last.column("tokens"), "<u4")
        starts = np.cumsum(lengths) - lengths
        code, tokens, share = own.symbols_of(hashes, kinds, c)
        codes, first, back = distinct(code)
        base = np.log10((c + ALPHA) / (own.n_tokens + ALPHA * (own.n_words + 1)))
        sums = [np.add.reduceat(x[flat], starts) for x in ((c > 0).astype(np.int64), base, np.log10(share))]
        tokens = tokens[first].astype(float)
        rank = np.empty(len(codes), "<u4" if len(codes) > 65536 else "<u2")
        rank[_frequent(tokens)] = np.arange(len(codes))
        data = [*map(_bytes, (lengths, *sums, rank[back[flat]])), _bytes(codes, True), _bytes(tokens)]
        found = [[last.column(x)[0].as_py()] for x in ("block", "doc_id", "known", "held")] + [[x] for x in data]
        return pa.table({k: pa.array(v, pa.binary() if i else pa.int64()) for i, (k, v) in enumerate(zip(_names(_STATE), found, strict=True))})

    return cut.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(state, _STATE)


def _walked(model: Model, group: pa.Table, answers: pa.Table | None, depth: int, limits: Limits) -> Walk:
    """A block's tokens after ``depth`` levels, whose answers are given."""
    one = {c: group.column(c)[0].as_py() for c in ("lengths", "held", "tokens", "codes", "counts")}
    lengths, codes = _numbers(one["lengths"], np.int64), _numbers(one["codes"], np.uint64, True)
    tokens = _numbers(one["counts"], float)
    place = _frequent(tokens)[_numbers(one["tokens"], "<u4" if len(codes) > 65536 else "<u2")]
    trained = np.repeat(~_numbers(one["held"], bool), lengths)
    walk = Walk(model, codes[place], tokens[place], lengths, trained, limits)
    for d in range(1, depth + 1):
        asked = Asked(walk)
        n = _told(answers, d, "n", np.int64, len(asked.codes)) >> 1
        left = _told(answers, d, "escape", np.int64, len(asked.contexts))[asked.of_context]
        walk.weigh(asked, n, left)
        walk.deepen(asked, n)
    return walk


def _told(answers: pa.Table, depth: int, name: str, kind, number: int) -> np.ndarray:
    """A block's answers of one kind, in the order of its questions."""
    own = answers.filter((pc.field("depth") == depth) & pc.field(name).is_valid()).sort_by("bucket")
    found = _joined(own.column(name), kind)
    if len(found) != number:
        raise RuntimeError("a block lacks answers on its strings")
    return found


def _with_answers(state: DataFrame, answers: DataFrame | None, function, schema: str) -> DataFrame:
    """``function`` of each block and the answers it has got so far."""
    if answers is None:
        return state.groupBy("block").applyInArrow(lambda group: function(group, None), schema)
    return state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(function, schema)


def _runs(codes: np.ndarray, n: int) -> tuple[list[int], list[tuple[int, int]]]:
    """(buckets, (start, end) of each) of sorted ``codes``."""
    at, starts, ends = _cut(codes, n)
    return at.tolist(), list(zip(starts.tolist(), ends.tolist(), strict=True))


def asks(state: DataFrame, model: Model, n: int, limits: Limits) -> DataFrame:
    """The strings that blocks want counted for the first level."""
    shared = state.sparkSession.sparkContext.broadcast(model)

    def ask(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                group = pa.Table.from_batches([batch.slice(i, 1)])
                walk = _walked(shared.value, group, None, 0, limits)
                found = Asked(walk)
                yield from pa.table(_wanted(group, found, walk.counts(found), n, "n")).to_batches()

    return state.mapInArrow(ask, _ASK)


def _wanted(group: pa.Table, asked: Asked, counts: np.ndarray, n: int, name: str) -> dict[str, pa.Array]:
    """A block's questions: its strings in each range, and their counts."""
    at, runs = _runs(asked.codes, n)
    return {
        "block": pa.array([group.column("block")[0].as_py()] * len(at), pa.int64()),
        "bucket": pa.array(at, pa.int32()),
        "codes": pa.array([_bytes(asked.codes[a:b], True) for a, b in runs], pa.binary()),
        name: pa.array([_bytes(counts[a:b]) for a, b in runs], pa.binary()),
    }


def string_counts(asked: DataFrame, depth: int, limits: Limits) -> DataFrame:
    """Answers to the blocks' strings: counts over all blocks, zero below all
    limits. One block is told to report the string."""

    def answer(group: pa.Table) -> pa.Table:
        asked, ends = _parts(group.column("codes"), np.uint64, True)
        codes, first, back = distinct(asked)
        n = np.bincount(back, _joined(group.column("n"), np.int64), len(codes)).astype(np.int64)
        n[n < min(limits.entry, limits.context)] = 0
        told = n[back] * 2
        told[first] += n > 0
        return pa.table(
            {
                "block": group.column("block"),
                "depth": pa.array(np.full(len(group), depth, np.int32)),
                "bucket": group.column("bucket"),
                "n": pa.array([_bytes(x) for x in np.split(told, ends)], pa.binary()),
                "escape": pa.nulls(len(group), pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(answer, _ANSWER)


def entries(state: DataFrame, answers: DataFrame, model: Model, depth: int, n: int, limits: Limits, last: bool) -> DataFrame:
    """The listed strings, each from one block: context, n, context_n, parent.
    Beside them, as other kinds, the distinct contexts of each block: block, bucket, contexts;
    and, but for the ``last`` level, the strings that blocks want counted for the
    next one: block, bucket, codes, counts."""
    shared = state.sparkSession.sparkContext.broadcast(model)

    def listed(group: pa.Table, known: pa.Table) -> pa.Table:
        walk = _walked(shared.value, group, known, depth - 1, limits)
        asked = Asked(walk)
        told = _told(known, depth, "n", np.int64, len(asked.codes))
        count = told >> 1
        own = np.flatnonzero(((told & 1) == 1) & (count >= limits.entry))
        block = group.column("block")[0].as_py()
        at, runs = _runs(asked.contexts, n)
        tables = [
            {
                "context": pa.array(asked.context[own].view(np.int64)),
                "n": pa.array(count[own]),
                "context_n": pa.array(asked.context_n[own]),
                "parent": pa.array(walk.p[asked.at[own]]),
            },
            {
                "block": pa.array([block] * len(at), pa.int64()),
                "bucket": pa.array(at, pa.int32()),
                "contexts": pa.array([_bytes(asked.contexts[a:b], True) for a, b in runs], pa.binary()),
            },
        ]
        if not last:
            walk.deepen(asked, count)
            asked = Asked(walk)
            tables.append(_wanted(group, asked, walk.counts(asked), n, "counts"))
        kinds = [pa.table(x | {"kind": np.full(len(next(iter(x.values()))), k, np.int32)}) for k, x in enumerate(tables)]
        return pa.concat_tables([empty, *kinds], promote_options="default")

    empty = _empty(_ENTRY)
    return state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(listed, _ENTRY)


def retained(listed: DataFrame) -> DataFrame:
    """(context, escape, left) of the contexts that diverge from their suffix; the
    escape is what the listed symbols leave to it, ``left`` four times its part of
    the count, a whole number as ``DISCOUNT`` is three quarters."""
    sums = listed.groupBy("context").agg(F.sum("n").alias("sums"), F.count("*").alias("number"), F.first("context_n").alias("total"))
    left = (F.col("total") - F.col("sums") + DISCOUNT * F.col("number")) / F.col("total")
    whole = (F.col("total") - F.col("sums")) * 4 + F.col("number") * int(4 * DISCOUNT)
    sums = sums.withColumn("escape", left).withColumn("left", whole.cast("long"))
    share = (F.col("n") - DISCOUNT) / F.col("total")
    # What isn't listed loses the part of the suffix that the list takes.
    lost = (F.col("total") - F.col("sums")) * F.log(F.greatest(F.col("escape"), F.lit(1e-12)))
    gains = (
        listed.join(sums, "context")
        .groupBy("context", "number", "escape", "left", lost.alias("lost"))
        .agg(F.sum(F.col("n") * F.log((share + F.col("escape") * F.col("parent")) / F.col("parent"))).alias("gain"))
    )
    return gains.where(F.col("gain") + F.col("lost") >= DIVERGENCE * F.col("number")).select("context", "escape", "left")


def escapes(asked: DataFrame, kept: DataFrame, depth: int, n: int) -> DataFrame:
    """Answers to the blocks' contexts: what they leave, 0 if not retained."""

    def answer(group: pa.Table, known: pa.Table) -> pa.Table:
        wanted, ends = _parts(group.column("contexts"), np.uint64, True)
        keys = known.column("context").to_numpy().view(np.uint64)
        out = np.zeros(len(wanted), np.int64)
        if len(keys) and len(wanted):
            order = np.argsort(keys)
            at = order[np.minimum(np.searchsorted(keys, wanted, sorter=order), len(keys) - 1)]
            out = np.where(keys[at] == wanted, known.column("left").to_numpy()[at], out)
        told = [_bytes(x) for x in np.split(out, ends)] if len(group) else []
        return pa.table(
            {
                "block": group.column("block"),
                "depth": pa.array(np.full(len(group), depth, np.int32)),
                "bucket": group.column("bucket"),
                "n": pa.nulls(len(group), pa.binary()),
                "escape": pa.array(told, pa.binary()),
            }
        )

    placed = kept.drop("escape").withColumn("bucket", bucket_column(F.col("context"), n))
    return asked.groupBy("bucket").cogroup(placed.groupBy("bucket")).applyInArrow(answer, _ANSWER)


# -- scores ----------------------------------------------------------------
def wave_of(block: Column, waves: int) -> Column:
    return F.pmod(block + F.shiftright(block, 32), F.lit(waves)).cast("int")


def in_waves(spark: SparkSession, make, waves: int, path: str, label: str, *by: str) -> DataFrame:
    """The table that ``make`` gives, written a share of the blocks after the
    other: no more than one share is in an exchange at a time."""
    for w in range(waves):
        part = written(make(w), label, f"{path}/wave={w}", *by)
    return spark.read.schema(T.StructType([*part.schema, T.StructField("wave", T.IntegerType())])).parquet(path)


def tree(
    docs: DataFrame, depth: int, limits: Limits, inspect: bool = True
) -> tuple[Model, DataFrame, DataFrame | None, list[tuple[DataFrame, DataFrame]]]:
    """(sums, blocks, answers, levels): a level is its listed strings and its
    retained contexts. The answers hold what scores need of them, so without
    ``inspect`` there are no levels and their tables are removed. Blocks by hash
    are removed once they stand as symbols."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text")), F.count(F.when(~held_out(F.col("doc_id")), 1))).first()
    n = partitions(spark, total[0] or 0, BLOCK_BYTES)
    used = [fresh_dir(spark, x) for x in ("blocks", "word-counts")]
    cut = written(blocks(docs, n), "blocks", used[0])
    asked = cut.where("bucket is not null").select("block", "bucket", "hashes", "endings", "n")
    counts = written(word_counts(asked, limits.word), "word-counts", used[1])
    model = shared_model(counts, total[1], limits.word, limits.kind)
    told = counts.where("block is not null").select("block", "bucket", "counts")
    waves = min(WAVES, max(1, (total[0] or 0) // (WAVE_BLOCKS * BLOCK_BYTES)))

    def share(table: DataFrame, w: int) -> DataFrame:
        return table.where(wave_of(F.col("block"), waves) == w)

    state = in_waves(
        spark, lambda w: states(share(cut.drop("n"), w), share(told, w), model), waves, fresh_dir(spark, "symbols"), "symbols"
    )
    for path in used:
        remove(spark, path)
    asked, answers, levels, used = asks(state, model, n, limits), None, [], []
    for d in range(1, depth + 1):
        got = written(string_counts(asked, d, limits), "counts")
        answers = got if answers is None else answers.unionByName(got)
        for path in used:
            remove(spark, path)
        listing, weighed = (fresh_dir(spark, x) for x in ("entries", "contexts"))

        def listings(w: int, known: DataFrame = answers, d: int = d) -> DataFrame:
            own = state.where(F.col("wave") == w)
            return entries(own, share(known, w), model, d, n, limits, d == depth)

        found = in_waves(spark, listings, waves, listing, "entries", "kind")
        listed = found.where(F.col("kind") == LISTED).select("context", "n", "context_n", "parent")
        kept = written(retained(listed), "contexts", weighed)
        held = found.where(F.col("kind") == CONTEXTS).select("block", "bucket", "contexts")
        answers = answers.unionByName(written(escapes(held, kept, d, n), "escapes"))
        asked = found.where(F.col("kind") == WANTED).select("block", "bucket", "codes", F.col("counts").alias("n"))
        if inspect:
            levels.append((listed, kept))
            continue
        for path in (weighed, *(f"{listing}/wave={w}/kind={k}" for w in range(waves) for k in (LISTED, CONTEXTS))):
            remove(spark, path)
        used = [listing]
    for path in used:
        remove(spark, path)
    return model, state, answers, levels


def scores(docs: DataFrame, depth: int = DEPTH, limits: Limits | None = None) -> DataFrame:
    """A row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    limits = limits or Limits()
    model, state, answers, _ = tree(docs, depth, limits, inspect=False)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )

    def score(group: pa.Table, known: pa.Table | None) -> pa.Table:
        own: Model = shared.value
        walk = _walked(own, group, known, depth, limits)

        def column(name: str, kind) -> np.ndarray:
            return _numbers(group.column(name)[0].as_py(), kind)

        lengths = column("lengths", np.int64)
        return pa.table(
            {
                "doc_id": pa.array(column("doc_id", np.int64), mask=~column("known", bool)),
                "held_out": pa.array(column("held", bool)),
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(column("n_known", np.int64)),
                "train_tokens": pa.array(np.full(len(lengths), own.n_tokens, np.int64)),
                "base_score": pa.array(column("base", float)),
                "score": pa.array(column("inner", float) + np.add.reduceat(np.log10(walk.p), walk.starts)),
            }
        )

    return _with_answers(state, answers, score, schema)
