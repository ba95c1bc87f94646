"""Copies by content (U3) against plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from tributary.operators import dedup

SCHEMA = "id string, a string, b string, c double, _h2 array<string>, loaded int"


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            a, b, c, d = r[1:5]
            groups[a, b, None if c is None else c + 0.0, None if d is None else tuple(d)].append(r[0])
    return sorted((i, len(ids), min(ids)) for ids in groups.values() if len(ids) > 1 for i in ids)


def test_copies_equal_brute_force(spark, ansi):
    rng = random.Random(3)
    kinds = [None, "", "x", "y"]
    rows = [
        (
            None if i % 50 == 0 else f"{i:04d}", rng.choice(kinds), rng.choice(kinds), rng.choice([None, 0.0, -0.0, 1.5]),
            rng.choice([None, [], ["x"], [None, "x"]]), i,
        )
        for i in range(300)
    ]
    rows += [("solo", "only", None, 9.0, None, 0), ("solo2", None, "only", 9.0, None, 0)]
    found = dedup.content_duplicates(spark.createDataFrame(rows, SCHEMA), "id", ["loaded"])
    assert found.columns == ["id", "a", "b", "c", "_h2", "loaded", "copies", "canonical_id"]
    assert sorted((r.id, r.copies, r.canonical_id) for r in found.collect()) == brute(rows)


def test_equal_hashes_of_other_content_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(dedup.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    rows = [(f"{i:03d}", "xy"[i % 2], str(i % 5), None, None, i) for i in range(40)] + [("z", "z", "z", None, None, 0)]
    found = dedup.content_duplicates(spark.createDataFrame(rows, SCHEMA), "id", ["loaded"])
    assert sorted((r.id, r.copies, r.canonical_id) for r in found.collect()) == brute(rows)


def test_only_candidates_are_grouped_by_content(spark):
    """The wide grouping reads rows whose hash occurs again, nothing else."""
    rows = spark.range(5000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 4990).cast("string").alias("a"), F.lit("w").alias("b"))
    found = dedup.content_duplicates(rows, "id")
    assert found.count() == 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and plan.index("LeftSemi") > 0
