"""Near-duplicate vectors: an exact metric range join.

On unit vectors a cosine of ``t`` is a distance of ``sqrt(2 - 2 t)``. Vectors
of one space (equal label and dimension) are parted by pivots: a vector's home
is the cell of its nearest pivot. If two vectors lie within the radius ``r``,
the triangle inequality bounds where the second can be seen from the first:

* its distance to the first one's pivot is at most the cell's radius plus ``r``;
* it is at most its distance to its own pivot plus ``2 r``.

A vector is replicated to the cells that meet both bounds, and only to those
before its own, so each pair meets in one cell. A cell whose home vectors are
more than ``CELL`` is cut into blocks, which are joined like cells. Cells join
independently, by matrix products in double precision.

No pair leaves a cell: what does are the number of links per vector, and a
spanning forest of the links, from which components follow. Equal vectors of a
space are one node with a weight, whatever their number. Where vectors are far
from one another in many dimensions no bound can part them; the products then
grow with the square of a space's rows, spread over its cells.

Bounds: a task holds the home vectors of one cell (at most ``CELL``) and one
batch of others; pivots come by a join, to groups of vectors that are dealt
to about ``GROUP`` rows.

Defined results: a vector that is null, empty or zero, holds a null or
non-finite component, or has a null label links with nothing, nor do vectors
of different dimensions. A row without vec_id counts as a link of others and
is never a component's least; its component is null if no row with a vec_id is
reached, and it is kept then. Rows that share a vec_id are rows of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import written
from tributary.llm.components import components

COSINE = 0.93
# Home vectors of a cell, and rows that a group of vectors is dealt to.
CELL = 4096
GROUP = 32768
# Spaces whose sizes may be broadcast.
FEW_SPACES = 100_000
# Rows of a matrix product.
BLOCK = 512
# Rounding of a distance; only widens what is compared.
SLACK = 1e-9

_KEYED = "vec_id long, label string, dim int, key binary, vec binary"


# -- vectors ---------------------------------------------------------------
def _keyed(kind: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row's space, the digest of its vector and its bytes; null without a
    usable vector."""
    dtype = np.dtype(kind)
    for batch in batches:
        dims, keys, vecs = [], [], []
        for label, vec in zip(batch.column(1), batch.column(2), strict=True):
            values = None
            if label.is_valid and vec.is_valid and vec.values.null_count == 0 and len(vec.values):
                values = vec.values.to_numpy(zero_copy_only=False).astype(dtype) + dtype.type(0)  # no negative zero
                wide = values.astype(np.float64)
                if not np.isfinite(wide).all() or not wide.any():
                    values = None
            dims.append(None if values is None else len(values))
            vecs.append(None if values is None else values.tobytes())
            keys.append(None if values is None else blake2b(vecs[-1], digest_size=16).digest())
        arrays = [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "dim", "key", "vec"])


def unit(vecs: pa.Array | pa.ChunkedArray, dtype: np.dtype) -> np.ndarray:
    """Rows of length one, in double precision."""
    raw = b"".join(vecs.to_pylist())
    if not len(vecs):
        return np.zeros((0, 0))
    x = np.frombuffer(raw, dtype).reshape(len(vecs), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares stay finite and above zero
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


# -- cells -----------------------------------------------------------------
# A cell is named by the id of its pivot.
_STATS = "label string, dim int, cell long, n long, far double"


def _cells(kind: str, left: pa.Table, right: pa.Table) -> pa.Table:
    """Home vectors and their greatest distance, per cell of the group."""
    names = ["label", "dim", "cell", "n", "far"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], t) for t in types], names)
    right = right.sort_by("id")
    pivots = unit(right["vec"], np.dtype(kind))
    n, far = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for at in range(0, left.num_rows, BLOCK):
        d = distances(unit(left["vec"].slice(at, BLOCK), np.dtype(kind)), pivots)
        home = d.argmin(axis=1)
        np.add.at(n, home, 1)
        np.maximum.at(far, home, d[np.arange(len(d)), home])
    used = np.flatnonzero(n)
    cells = right["id"].to_numpy()[used]
    rows = [[left["label"][0].as_py()] * len(used), [left["dim"][0].as_py()] * len(used), cells, n[used], far[used]]
    return pa.table([pa.array(v, t) for v, t in zip(rows, types, strict=True)], names)


_DEALT = "label string, dim int, cell long, block int, home boolean, id long, m long, vec binary"


def _dealt(kind: str, radius: float, cell_rows: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """Each vector in its home, and in the cells and blocks before it that may
    hold a vector within the radius."""
    schema = pa.schema(
        [("label", pa.string()), ("dim", pa.int32()), ("cell", pa.int64()), ("block", pa.int32()),
         ("home", pa.bool_()), ("id", pa.int64()), ("m", pa.int64()), ("vec", pa.binary())]
    )
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    right = right.sort_by("id")
    pivots = unit(right["vec"], np.dtype(kind))
    n = right["n"].to_numpy()
    far = right["far"].to_numpy()
    names = right["id"].to_numpy()
    blocks = np.maximum(1, -(-n // cell_rows))
    ids = left["id"].to_numpy()
    cells = np.arange(len(pivots))
    parts = []
    for at in range(0, left.num_rows, BLOCK):
        some = left.slice(at, BLOCK)
        d = distances(unit(some["vec"], np.dtype(kind)), pivots)
        home = d.argmin(axis=1)
        own = (ids[at : at + BLOCK].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[home]
        near = d[np.arange(len(d)), home]
        seen = (d <= far + radius + SLACK) & (d <= near[:, None] + 2 * radius + SLACK) & (cells < home[:, None]) & (n > 0)
        rows, targets = np.nonzero(seen)
        # All blocks of an earlier cell, the earlier ones of the own cell, and the own one.
        row = np.concatenate([np.repeat(rows, blocks[targets]), np.repeat(np.arange(len(d)), own + 1)])
        cell = np.concatenate([np.repeat(targets, blocks[targets]), np.repeat(home, own + 1)])
        counts = np.concatenate([blocks[targets], own + 1])
        block = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at_home = (cell == home[row]) & (block == own[row])
        table = some.select(["label", "dim", "id", "m", "vec"]).take(pa.array(row))
        parts.append(
            pa.table(
                [table["label"], table["dim"], pa.array(names[cell], pa.int64()), pa.array(block, pa.int32()),
                 pa.array(at_home), table["id"], table["m"], table["vec"]], schema=schema,
            )
        )
    return pa.concat_tables(parts)


# -- joining a cell --------------------------------------------------------
class Cell:
    """The home vectors of a cell and what they are linked with."""

    def __init__(self, cosine: float):
        self.cosine = cosine
        self.ids = np.zeros(0, np.int64)
        self.m = np.zeros(0, np.int64)
        self.x = np.zeros((0, 0))
        self.counts = np.zeros(0, np.int64)
        self.group = np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, m: np.ndarray, x: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.m = np.concatenate([self.m, m])
        self.x = np.concatenate([self.x, x]) if len(self.x) else x

    def _tie(self, who: int, linked: np.ndarray, edges: list[tuple[int, int]], at_home: int | None) -> None:
        """Merge the groups of the linked home vectors, by an edge each."""
        groups, first = np.unique(self.group[linked], return_index=True)
        for k in linked[first].tolist():
            if at_home is None or self.group[k] != self.group[at_home]:
                edges.append((who, int(self.ids[k])))
        if at_home is not None:
            groups = np.union1d(groups, self.group[at_home : at_home + 1])
        if len(groups) > 1:
            self.group[np.isin(self.group, groups)] = groups[0]

    def close(self) -> list[tuple[int, int]]:
        """All pairs of home vectors."""
        n = len(self.ids)
        self.counts = np.zeros(n, np.int64)
        self.group = np.arange(n)
        edges: list[tuple[int, int]] = []
        for at in range(0, n, BLOCK):
            hit = self.x[at : at + BLOCK] @ self.x.T >= self.cosine
            hit[np.arange(len(hit)), np.arange(at, at + len(hit))] = False
            self.counts[at : at + len(hit)] += hit @ self.m
            for i in np.flatnonzero(hit.any(axis=1)).tolist():
                self._tie(int(self.ids[at + i]), np.flatnonzero(hit[i]), edges, at + i)
        return edges

    def meet(self, ids: np.ndarray, m: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Other vectors against the home ones: their links and edges."""
        found = np.zeros(len(ids), np.int64)
        edges: list[tuple[int, int]] = []
        for at in range(0, len(ids), BLOCK):
            hit = x[at : at + BLOCK] @ self.x.T >= self.cosine
            found[at : at + len(hit)] = hit @ self.m
            self.counts += m[at : at + len(hit)] @ hit
            for i in np.flatnonzero(hit.any(axis=1)).tolist():
                self._tie(int(ids[at + i]), np.flatnonzero(hit[i]), edges, None)
        return found, edges


_FOUND = "id long, links long, other long"


def _joined(kind: str, cosine: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, links, null) with partial link counts and (id, null, other)
    with edges, from rows that come cell by cell, home vectors first."""
    dtype = np.dtype(kind)
    names = ["id", "links", "other"]

    def out(ids: np.ndarray, counts: np.ndarray, edges: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(counts[some]), pa.nulls(len(some), pa.int64())], names
            )
        if edges:
            u, v = zip(*edges, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.nulls(len(u), pa.int64()), pa.array(v, pa.int64())], names)

    now, cell, closed = None, Cell(cosine), False
    for batch in batches:
        spaces = list(zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True))
        cuts = [0, *(i for i in range(1, len(spaces)) if spaces[i] != spaces[i - 1]), len(spaces)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            *key, home = spaces[a]
            if key != now:
                if now is not None:
                    if not closed:
                        yield from out(cell.ids, np.zeros(0, np.int64), cell.close())
                    yield from out(cell.ids, cell.counts, [])
                now, cell, closed = key, Cell(cosine), False
            part = batch.slice(a, b - a)
            ids, m, x = part.column(5).to_numpy(), part.column(6).to_numpy(), unit(part.column(7), dtype)
            if home:
                cell.add(ids, m, x)
                continue
            if not closed:
                yield from out(cell.ids, np.zeros(0, np.int64), cell.close())
                closed = True
            if len(cell.ids):
                found, edges = cell.meet(ids, m, x)
                yield from out(ids, found, edges)
    if now is not None:
        if not closed:
            yield from out(cell.ids, np.zeros(0, np.int64), cell.close())
        yield from out(cell.ids, cell.counts, [])


# -- the join --------------------------------------------------------------
def links(nodes: DataFrame, kind: str, cosine: float = COSINE, cell_rows: int = CELL, group_rows: int = GROUP) -> DataFrame:
    """(id, links, other) over nodes (id, label, dim, m, vec), see ``_joined``."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * cosine))
    space = ["label", "dim"]
    keys = [*space, "group"]
    cell = [*space, "cell", "block"]
    sizes = written(nodes.groupBy(*space).agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id")), "spaces")
    if sizes.count() <= FEW_SPACES:
        sizes = F.broadcast(sizes)
    cells = F.ceil(F.col("rows") / cell_rows)
    # At most half of a space's cells come before a vector's own on average.
    groups = F.ceil(F.col("rows") * (1 + cells / 2) / group_rows)
    placed = nodes.join(sizes, space).withColumn("group", F.pmod(F.xxhash64("id"), groups).cast("int"))
    chosen = F.pmod(F.xxhash64("id", F.lit(1)), F.col("rows")) < cells
    few = placed.where((F.col("id") == F.col("first_id")) | (chosen & (cells > 1)))
    pivots = written(few.select(*space, "id", "vec", groups.cast("int").alias("groups")), "pivots")

    def everywhere(df: DataFrame) -> DataFrame:
        return df.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")

    rows = placed.select(*keys, "id", "m", "vec")
    near = rows.groupBy(*keys).cogroup(everywhere(pivots).groupBy(*keys)).applyInArrow(partial(_cells, kind), _STATS)
    known = near.groupBy(*space, F.col("cell").alias("id")).agg(F.sum("n").alias("n"), F.max("far").alias("far"))
    full = pivots.join(known, [*space, "id"], "left").na.fill(0, ["n", "far"])
    dealt = rows.groupBy(*keys).cogroup(everywhere(full).groupBy(*keys)).applyInArrow(
        partial(_dealt, kind, radius, cell_rows), _DEALT
    )
    in_order = dealt.repartition(n, *cell).sortWithinPartitions(*cell, F.col("home").desc())
    return in_order.select(*cell, "home", "id", "m", "vec").mapInArrow(partial(_joined, kind, cosine), _FOUND)


def near_duplicates(
    rows: DataFrame, cosine: float = COSINE, cell_rows: int = CELL, group_rows: int = GROUP
) -> DataFrame:
    """A row per input row: vec_id, n_links, component_id, kept."""
    kind = "f4" if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else "f8"
    vector = F.col("embedding") if kind == "f4" else F.col("embedding").cast("array<double>")
    plain = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), vector.alias("embedding"))
    keyed = written(plain.mapInArrow(partial(_keyed, kind), _KEYED), "vectors")
    same = ["label", "dim", "key"]
    usable = keyed.where("key is not null")
    grouped = usable.groupBy(*same, "vec").agg(F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("least"))
    nodes = written(grouped.withColumn("id", F.monotonically_increasing_id()), "vector-nodes")
    found = written(links(nodes, kind, cosine, cell_rows, group_rows), "vector-links")
    linked = found.where("links is not null").groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("id").alias("u"), F.col("other").alias("v"))
    reached = components(edges).withColumnRenamed("node", "id")
    members = nodes.select(*same, "id", "m", "least").join(reached, "id", "left").join(linked, "id", "left")
    members = written(members.withColumn("component", F.coalesce("component", "id")), "vector-members")
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    named = members.join(least, "component").select(
        *same, (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    out = usable.select("vec_id", *same).join(named, same).select("vec_id", "n_links", "component_id")
    alone = keyed.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
