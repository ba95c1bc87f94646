"""Merkle manifest against a straightforward one."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from .conftest import EXTRA
from tributary.llm import manifest, queries


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(now[i : i + 8]) for i in range(0, len(now), 8)])
    return levels


def others(levels, i):
    found = []
    for nodes in levels[:-1]:
        base = i - i % 8
        found.append((i - base, [nodes[k] for k in range(base, min(base + 8, len(nodes))) if k != i]))
        i //= 8
    return found


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0], h(map(enc, r)), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by_lang[x].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        trees[x] = up([t[1] for t in by_lang[x]])
    top = up([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, (doc, leaf, r) in enumerate(by_lang[x]):
            path = others(trees[x], i) + others(top, k)
            now = leaf
            if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 and r[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                now = h(map(enc, (*r[:4], low)))
            for at, sib in path:
                now = h([*sib[:at], now, *sib[at:]])
            proof = h([s for _, sib in path for s in sib])
            out.append((doc, leaf, trees[x][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def frame(spark, rows):
    n = len(EXTRA.split(","))
    extra = EXTRA + ", tree int, place int, leaf int, other int, path int, log int, block2 int, part int"
    return spark.createDataFrame(
        [(*r, *range(n + 8)) for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {extra}"
    )


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df, levels=manifest.LEVELS):
    return sorted((tuple(r) for r in queries.manifest_rows(df, levels).select(COLUMNS).collect()), key=repr)


def test_positions_are_postorder():
    for n in (1, 2, 7, 8, 9, 63, 64, 65, 513):
        for block in (0, 1):
            counts = manifest.sizes(n, block)
            log = manifest.append_log([sha256(b"%d" % i).digest() for i in range(n)], counts)
            assert len(log) == manifest.DIGEST * sum(counts)
            places = [manifest.position(counts, lv, i) for lv in range(len(counts)) for i in range(counts[lv])]
            assert sorted(places) == list(range(sum(counts)))
            for lv in range(1, len(counts)):
                for i in range(counts[lv]):
                    below = range(i * 8, min(i * 8 + 8, counts[lv - 1]))
                    kids = [manifest.node(log, counts, lv - 1, k) for k in below]
                    assert manifest.node(log, counts, lv, i) == manifest.parent(kids)


def rows_of(n, rng):
    langs = [None, "", "de", "en", "en", "en", "é", "z" * 300]
    rows = [(i, rng.choice(["web", None]), rng.choice(langs), rng.randrange(9), f"Text {i} É\n") for i in range(n)]
    rows += [(None, None, None, None, None), (None, None, "en", 1, None), (3, "a", "en", None, ""), (3, "a", "en", None, "")]
    return rows + [(5, "s", "en", 1, "AB" * 50_000), (-7, "s", "en", 1, "x"), (n, None, "one", 0, "ALONE")]


def test_manifest_rows(spark):
    rows = rows_of(300, random.Random(2))
    assert found(frame(spark, rows).repartition(7)) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small(spark, n):
    rows = [(i, "s", "en", 1, "Text") for i in range(n)]
    assert found(frame(spark, rows)) == sorted(brute(rows), key=repr)


def test_several_tiers(spark):
    """Trees of many blocks, one of them with most rows, give the same rows."""
    rng = random.Random(3)
    rows = [(i, "s", "en" if i % 3 else f"l{i % 90}", i, f"T{rng.random()}") for i in range(700)]
    df = frame(spark, rows).repartition(5)
    assert found(df, 1) == sorted(brute(rows), key=repr)
    assert len(manifest.logs(df, levels=1)) == 3


def test_tampering_shows(spark):
    rows = [(i, "s", "en", 1, "Text" if i % 2 else "text") for i in range(60)]
    df = queries.manifest_rows(frame(spark, rows))
    for r in df.collect():
        hit = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.doc_id % 2
        assert r.verified == (not hit)
    assert df.select(F.count_distinct("root")).first()[0] == 1
