"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A pretoken's symbols stand in a row; the leaf at each place holds the rank of
the pair that starts there (with the place behind it, so that ties go left),
and the root of the segment tree is the leftmost lowest-rank merge. A merge
changes three leaves, each updated on its way to the root in logarithmic
time, until no leaf can merge. Pretokens of up to 64 bytes are done many at a
time, a numpy row of trees for each; longer ones one by one.

Pretokens recur, so a worker keeps those it has seen, in two generations of
bounded size. The vocabulary file is read by every worker from ``path`` (the
installed public_tokenizers file by default); it is never copied.

Defined results: a null text counts as empty and has no ids; ids outside the
vocabulary can't be decoded and raise; bytes that are no UTF-8 decode to
replacement characters; other columns pass through ``encode`` and ``decode``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import groups_of

VOCABULARY = "byte_bpe_50k.json"
# Fixed value: the split of text into pretokens that goes with the vocabulary.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW_BYTES = 64
ROWS = 1 << 14
CACHED = 250_000
GROUP_BYTES = 2 * 1024 * 1024
NONE = np.int64(1) << 62


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_signs() -> dict[str, int]:
    """Sign -> byte: printable Latin-1 stands for itself, the rest follows 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Vocabulary, merges and the pretoken cache of one worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        signs = byte_signs()
        self.added = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocabulary.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for token, i in vocabulary.items():
            if token not in self.added:
                self.bytes_of[i] = bytes(signs[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.decimal = [b"%d" % i for i in range(size)]
        self.byte_ids = np.zeros(256, np.int64)
        for sign, byte in signs.items():
            self.byte_ids[byte] = vocabulary[sign]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self._hash(left << 32 | right)
        self.pretokens = regex.compile(PRETOKENS)
        names = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # -- ranks of pairs ----------------------------------------------------
    def _hash(self, keys: np.ndarray) -> None:
        """Open addressing: keys and ranks in slots, at most a quarter full."""
        self.bits = int(4 * len(keys)).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slots[at[left]] < 0
            self.slots[at[left[free]]] = keys[left[free]]  # the last of equals wins
            placed = self.slots[at[left]] == keys[left]
            self.ranks[at[left[placed]]] = left[placed]
            left = left[~placed]
            at[left] = (at[left] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = self._slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.ranks[at], NONE)
        go = np.flatnonzero((found != keys) & (found >= 0))
        while len(go):
            at[go] = (at[go] + 1) & (len(self.slots) - 1)
            found = self.slots[at[go]]
            hit = found == keys[go]
            out[go[hit]] = self.ranks[at[go[hit]]]
            go = go[~hit & (found >= 0)]
        return out

    # -- merges ------------------------------------------------------------
    def _rows(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most ``width`` bytes (a power of two), as uint32."""
        m = len(words)
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        ids = self.byte_ids[flat].reshape(m, width)
        places = np.arange(width)
        shift = width.bit_length()
        follow = np.tile(places + 1, (m, 1))
        before = np.tile(places - 1, (m, 1))
        alive = places < lengths[:, None]
        tree = np.full((m, 2 * width), NONE)
        rank = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(m, -1)
        open_ = alive[:, 1:] & (rank < NONE)
        tree[:, width : 2 * width - 1][open_] = (rank << shift | places[:-1])[open_]
        step = width
        while step > 1:
            step //= 2
            tree[:, step : 2 * step] = np.minimum(tree[:, 2 * step : 4 * step : 2], tree[:, 2 * step + 1 : 4 * step : 2])
        rows = np.arange(m)
        while True:
            root = tree[rows, 1]
            rows, root = rows[root < NONE], root[root < NONE]
            if not len(rows):
                break
            at = root & ((1 << shift) - 1)
            gone = follow[rows, at]
            new = self.merged[root >> shift]
            after = follow[rows, gone]
            ids[rows, at] = new
            alive[rows, gone] = False
            follow[rows, at] = after
            tree[rows, width + gone] = NONE
            inside = after < lengths[rows]
            before[rows[inside], after[inside]] = at[inside]
            key = np.full(len(rows), NONE)
            ranks = self.rank(new[inside], ids[rows[inside], after[inside]])
            key[inside] = np.where(ranks < NONE, ranks << shift | at[inside], NONE)
            tree[rows, width + at] = key
            ahead = before[rows, at]
            has = ahead >= 0
            ranks = self.rank(ids[rows[has], ahead[has]], new[has])
            tree[rows[has], width + ahead[has]] = np.where(ranks < NONE, ranks << shift | ahead[has], NONE)
            r = np.concatenate([rows, rows, rows[has]])
            node = width + np.concatenate([at, gone, ahead[has]])
            while node[0] > 1:
                node >>= 1
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
        packed = ids.astype("<u4")[alive].tobytes()
        ends = np.cumsum(alive.sum(1)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _long(self, word: bytes) -> bytes:
        """The same tree for a single long pretoken, in lists."""
        n = len(word)
        width = 1 << (n - 1).bit_length()
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        rank = self.rank(ids[:-1], ids[1:])
        leaves = np.full(width, NONE)
        leaves[: n - 1] = np.where(rank < NONE, rank << 32 | np.arange(n - 1), NONE)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [0, *np.concatenate(levels[::-1]).tolist()]
        ids, none, low = ids.tolist(), int(NONE), (1 << 32) - 1
        follow, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        known: dict[tuple[int, int], int] = {}

        def put(place: int, left: int, right: int) -> None:
            if (rank := known.get((left, right))) is None:
                rank = known[left, right] = int(self.rank(np.array([left]), np.array([right]))[0])
            climb(place, rank << 32 | place if rank < none else none)

        def climb(place: int, key: int) -> None:
            node = width + place
            tree[node] = key
            while node > 1:
                a, b = tree[node], tree[node ^ 1]
                node >>= 1
                least = a if a < b else b
                if tree[node] == least:
                    break
                tree[node] = least

        while (root := tree[1]) < none:
            at, gone = root & low, follow[root & low]
            ids[at] = int(self.merged[root >> 32])
            alive[gone] = False
            after = follow[at] = follow[gone]
            climb(gone, none)
            if after < n:
                before[after] = at
                put(at, ids[at], ids[after])
            else:
                climb(at, none)
            if before[at] >= 0:
                put(before[at], ids[before[at]], ids[at])
        return np.array([i for i, a in zip(ids, alive, strict=True) if a], "<u4").tobytes()

    def encode_pretokens(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian uint32) of pretokens, by width of their tree."""
        raw = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(raw)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            if len(w) > ROW_BYTES:
                out[i] = self._long(w)
            else:
                by_width.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(i)
        for width, members in by_width.items():
            for a in range(0, len(members), ROWS):
                part = members[a : a + ROWS]
                for i, ids in zip(part, self._rows([raw[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    # -- texts -------------------------------------------------------------
    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian uint32 bytes."""
        parts = []
        for text in texts:
            pieces = self.split.split(text) if self.split and self.split.search(text) else [text]
            words: list[str] = []
            for i, piece in enumerate(pieces):
                words += self.pretokens.findall(piece) if i % 2 == 0 else [piece]
            parts.append(words)
        if len(self.young) > CACHED:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = []
        for word in set().union(*parts):
            if word not in young:
                if word in old:
                    young[word] = old[word]
                elif word in self.added:
                    young[word] = np.array([self.added[word]], "<u4").tobytes()
                else:
                    new.append(word)
        young.update(zip(new, self.encode_pretokens(new), strict=True))
        return [b"".join(map(young.__getitem__, words)) for words in parts]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process; workers outlive tasks."""
    return Codec(path)


def coded(
    docs: DataFrame,
    finish: Callable[[list[list[int]], Codec], list[pa.Array]],
    schema: str,
    path: str | None = None,
) -> DataFrame:
    """Encode (doc_id, text) in groups of bounded size; ``finish`` turns the
    ids of a group into the columns behind doc_id."""
    path = path or default_path()

    def task(batches) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in groups_of(batches, GROUP_BYTES):
            found = own.encode([t or "" for t in batch.column(1).to_pylist()])
            ids = [np.frombuffer(x, "<u4").tolist() for x in found]
            columns = finish(ids, own)
            names = [c.split()[0] for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row."""
    return coded(docs, lambda ids, _: [pa.array(ids, pa.list_(pa.int32()))], "doc_id long, ids array<int>", path)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids decode to ''."""
    path = path or default_path()

    def task(batches) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            found = [own.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(task, "doc_id long, text string")
