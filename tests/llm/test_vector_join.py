"""The vector join against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import SF_SMALL
from tributary.llm import queries, vector_join


def brute(rows, cosine=vector_join.COSINE):
    """rows: (vec_id, embedding, label)."""
    n = len(rows)
    ok = [
        r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
        for r in rows
    ]
    unit = [np.array(r[1], np.float64) / np.linalg.norm(np.array(r[1], np.float64)) if o else None for r, o in zip(rows, ok)]
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                near[i].append(j)
                near[j].append(i)
    comp = [None] * n
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        comp[i] = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
    return sorted(((r[0], len(a), c, r[0] == c) for r, a, c in zip(rows, near, comp)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def clustered(rng, n, dim, labels):
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        k = int(rng.integers(9))
        v = centres[k] + rng.normal(size=dim) * 0.15 if k < 6 else rng.normal(size=dim)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.choice(labels))))
    return rows


def frame(spark, rows, kind="float"):
    extra = "id int, key int, m int, cell int, block int, dim int, vec int, home int, links int, other int, least int"
    return spark.createDataFrame(
        [(*r, *range(11)) for r in rows], f"vec_id long, embedding array<{kind}>, label int, {extra}"
    )


@pytest.mark.parametrize("cell_rows,group_rows", [(vector_join.CELL, vector_join.GROUP), (17, 40)])
def test_links_of_clusters(spark, cell_rows, group_rows):
    rng = np.random.default_rng(1)
    rows = clustered(rng, 260, 5, [0, 0, 0, 1, 2])
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(90)]  # copies
    rows += [(2000, [x * 2 for x in rows[3][1]], rows[3][2])]  # another length, the same direction
    got = found(vector_join.near_duplicates(frame(spark, rows).repartition(6), cell_rows=cell_rows, group_rows=group_rows))
    assert got == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0),
        (7, [1.0, 0.0], None), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 0), (9, [1.0, -0.0], 0), (None, [1.0, 0.0], 0),
        (10, [1.0, 0.0, 0.0], 0), (None, [0.0, 1.0], 1), (None, [0.0, 1.0], 1), (12, [1e-30, 1e-30], 2), (11, [1e30, 1e30], 2),
        (13, [-1.0, 0.0], 0), (14, [0.95, 0.2], 0), (15, [0.8, 0.6], 0), (16, [1e-300, 0.0], 3),
    ]
    want = brute([(*r[:1], None if r[1] is None else r[1], r[2]) for r in rows])
    want = [(v, n, c, True if c is None and v is None else k) for v, n, c, k in want]
    assert found(vector_join.near_duplicates(frame(spark, rows, "double"))) == sorted(want, key=repr)
    assert found(vector_join.near_duplicates(frame(spark, []))) == []


def test_query_matches_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(queries.queries()["op12_vector_join"](spark, SF_SMALL)) == brute(rows)


def test_bounds_keep_clusters_apart(spark):
    """Far clusters are not replicated to each other's cells."""
    rng = np.random.default_rng(2)
    centres = np.eye(8)
    rows = [(i, [float(x) for x in centres[i % 8] + rng.normal(size=8) * 0.02], 0) for i in range(400)]
    df = frame(spark, rows, "double")
    assert found(vector_join.near_duplicates(df, cell_rows=20)) == brute(rows)
