"""Exact, substring, near and suffix deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from tributary.llm import components, exact_dedup, queries, simhash, substring_dedup, suffix_dedup

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bag(rows):
    return Counter(tuple(r) for r in rows)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# -- op 1 ------------------------------------------------------------------
def brute_spans(rows, min_words=5):
    seen = defaultdict(list)
    for doc, text in rows:
        for k, (a, b) in enumerate(substring_dedup.cut(text or "")):
            plain = substring_dedup.normalise(text[a:b])
            if len(plain.split(" ")) >= min_words:
                seen[plain].append((float("inf") if doc is None else doc, a, k, b - a, doc))
    out = []
    for places in seen.values():
        least = min(p[0] for p in places)
        first = min(a for r, a, *_ in places if r == least)
        keep = next(p[4] for p in places if p[0] == least)
        for rank, a, k, n, doc in places:
            if rank > least or a > first:
                out.append((doc, k, a, n, keep, len(places)))
    return Counter(out)


def test_units_cover_the_text():
    for text in ("", "a", "One. Two! Three?\nfour", "...  \n\n x. y", "no end"):
        spans = list(substring_dedup.cut(text))
        assert "".join(text[a:b] for a, b in spans) == text
        assert all(a < b for a, b in spans)


def test_substring_spans(edge, empty):
    assert bag(substring_dedup.repeats(edge).collect()) == brute_spans(pairs(edge))
    assert substring_dedup.repeats(empty).count() == 0


def test_without_spans_keeps_offsets(edge):
    spans = substring_dedup.repeats(edge)
    out = substring_dedup.without(edge, spans)
    assert out.columns == [*edge.columns, "kept_spans"]
    gone = defaultdict(set)
    for r in spans.collect():
        gone[r.doc_id].add((r.start, r.length))
    texts = defaultdict(list)
    for doc, text in pairs(edge):
        texts[doc].append(text)
    for r in out.select("doc_id", "text", "kept_spans").collect():
        sources = [t for t in texts[r.doc_id] if t is not None]
        if r.text is None:
            assert None in texts[r.doc_id]
            continue
        assert any("".join(t[s.start : s.start + s.length] for s in r.kept_spans) == r.text for t in sources)
    assert out.count() == edge.count()


def brute_units(text):
    """(start, end) of paragraphs and lines of any length and of longer
    sentences, without those of the same words as one around them."""
    lines, at = [], 0
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        lines.append((at, at + len(line)))
        at += len(line)
    found = [s for s in substring_dedup.cut(text) if len(substring_dedup.normalise(text[slice(*s)]).split(" ")) >= 5]
    for full, block in groupby(lines, lambda s: substring_dedup.normalise(text[slice(*s)]) != ""):
        block = list(block)
        if full:
            found += [*block, (block[0][0], block[-1][1])]
    plain = {s: substring_dedup.normalise(text[slice(*s)]) for s in found}
    return {s: p for s, p in plain.items() if not any(q == p and t != s and t[0] <= s[0] and s[1] <= t[1] for t, q in plain.items())}


def test_whole_lines_of_any_length_go(edge, empty, spark):
    seen = defaultdict(list)
    for doc, text in pairs(edge):
        own = sorted((a, b, p) for (a, b), p in brute_units(text or "").items())
        first = {p: a for a, _, p in reversed(own)}
        for a, b, p in own:
            seen[p].append((doc, float("inf") if doc is None else doc, a, b, a > first[p]))
    want = Counter()
    for places in seen.values():
        keep, least = min((p[:2] for p in places), key=lambda p: p[1])
        want.update((d, a, b - a, keep, len(places)) for d, rank, a, b, again in places if rank > least or again)
    got = substring_dedup.removals(edge).select("doc_id", "start", "length", "keep_doc_id", "copies")
    assert bag(got.collect()) == want
    assert substring_dedup.removals(empty).count() == 0

    rows = [
        (1, "Short one.\nThe and attion to it, anea. Eriner thanea.\nown\n"),
        (2, "mine. Eriner thanea.\nshort  ONE. \nThe and attion to it, anea. Eriner thanea.\nEnd"),
        (3, "x\n\nsome words\nand others\n\ny"),
        (4, "some\nwords and others\n\nz\nx"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in substring_dedup.without(df, substring_dedup.removals(df)).collect()}
    assert left == {1: rows[0][1], 2: "mine. Eriner thanea.\nEnd", 3: rows[2][1], 4: "\nz\n"}


# -- op 2 ------------------------------------------------------------------
def test_exact_decisions(edge, empty):
    groups = defaultdict(list)
    for doc, text in pairs(edge):
        groups[(text or "").translate(AZ)].append(doc)
    want = Counter()
    for text, docs in groups.items():
        keep = max((d for d in docs if d is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        want.update((d, keep, len(docs), d == keep, sha) for d in docs)
    assert bag(exact_dedup.decisions(edge).collect()) == want
    assert exact_dedup.decisions(empty).count() == 0


def test_exact_deduplicate_keeps_one_row(edge, empty):
    kept = exact_dedup.deduplicate(edge)
    assert kept.columns == edge.columns
    rows = pairs(kept)
    texts = [(t or "").translate(AZ) for _, t in rows]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(AZ) for _, t in pairs(edge)})
    assert (6, "one two three FOUR five six") in rows
    assert exact_dedup.deduplicate(empty).count() == 0


def test_exact_repeated_rows_of_one_id(spark):
    df = spark.createDataFrame([(1, "t")] * 5 + [(2, "u"), (None, "u"), (None, None), (None, "")], "doc_id long, text string")
    assert sorted(pairs(exact_dedup.deduplicate(df)), key=str) == sorted([(1, "t"), (2, "u"), (None, "")], key=str) or sorted(
        pairs(exact_dedup.deduplicate(df)), key=str
    ) == sorted([(1, "t"), (2, "u"), (None, None)], key=str)


def test_cuckoo_filter_inserts_deletes_and_grows():
    index = exact_dedup.BucketIndex()
    index.filter = exact_dedup.CuckooFilter(2)
    keys = [hashlib.sha256(b"%d" % i).digest() for i in range(3000)]
    for k in keys:
        index.insert(k, 1, 1, 1)
    assert index.resizes > 0 and all(map(index.live, keys))
    for k in keys[::2]:
        index.delete(k)
    assert not any(map(index.live, keys[::2])) and all(map(index.live, keys[1::2]))
    others = [hashlib.sha256(b"o%d" % i).digest() for i in range(20_000)]
    assert not any(map(index.live, others))
    assert index.content.keys() == set(keys[1::2])


def test_cuckoo_false_hits_are_verified():
    index = exact_dedup.BucketIndex()
    key = bytes(32)
    index.insert(key, 1, 1, 1)
    twin = bytes(31) + b"\x01"  # same mark, same places
    assert twin in index.filter and not index.live(twin) and index.false_hits == 1
    index.delete(twin)
    assert index.live(key)


def test_index_update(spark):
    def digests(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.select("doc_id", exact_dedup.digest_of(df.text).alias("digest"))

    index = exact_dedup.build(digests([(1, "a"), (2, "A"), (3, "b"), (4, "c")]))
    new = exact_dedup.update(index, inserted=digests([(9, "a"), (7, "d")]), deleted=digests([(0, "b"), (0, "z")]))
    got = {(r.keep_id, r.group_size) for r in new.collect()}
    assert got == {(9, 3), (4, 1), (7, 1)}


# -- op 4 ------------------------------------------------------------------
def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, linked):
    """items: (id, value); returns the least id reachable for each."""
    parent = list(range(len(items)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(items))]


def test_simhash_edge(edge, empty):
    rows = pairs(edge)
    fps = [(d, brute_fingerprint(t)) for d, t in rows]
    want = Counter(zip([d for d, _ in fps], [f for _, f in fps], brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2), strict=True))
    got = simhash.near_duplicates(edge).collect()
    assert Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_op4_documents(spark):
    """The registered query, hex digits included, against all pairs."""
    rows = pairs(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    fps = [(d, brute_fingerprint(t)) for d, t in rows]
    least = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    got = queries.op4_simhash(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (d, f"{f:016x}", c) for (d, f), c in zip(fps, least, strict=True)
    )


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_find_every_pair(spark, bits):
    rng = random.Random(bits)
    values = {0, 2**63, 2**64 - 1}
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(6):
            values.add(v)
            for _ in range(rng.randrange(1, 4)):
                v ^= 1 << rng.randrange(64)
    values = sorted(values)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(signed[v],) for v in values], "fp long")
    got = [(r.u & (2**64 - 1), r.v & (2**64 - 1)) for r in simhash.links(df, bits).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in got)
    linked = set(got) | {(b, a) for a, b in got}
    items = list(enumerate(values))
    assert brute_components(items, lambda a, b: (a, b) in linked) == brute_components(
        items, lambda a, b: (a ^ b).bit_count() <= bits
    )


def test_simhash_representatives(edge):
    stay = simhash.representatives(edge)
    assert stay.columns == edge.columns
    classes = {(r.doc_id, r.key): r.component_id for r in simhash.near_duplicates(edge).collect()}
    assert sum(d == c for (d, _), c in classes.items()) == stay.select("doc_id", "text").distinct().count()


def test_components_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def test_simhash_bridge_without_an_id(spark, monkeypatch):
    """A fingerprint whose documents all lack an id links what lies around it."""
    made = [(9, 0b0), (None, 0b11), (5, 0b1111), (None, 1 << 40), (None, 3 << 40), (7, 2**50 - 1)]
    fps = spark.createDataFrame([(d, i, f) for i, (d, f) in enumerate(made)], "doc_id long, key long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: fps)
    got = {r.key: r.component_id for r in simhash.near_duplicates(fps).collect()}
    assert got == dict(enumerate(brute_components(made, lambda a, b: (a ^ b).bit_count() <= 2)))
    assert got == {0: 5, 1: 5, 2: 5, 3: 5, 4: 5, 5: 7}


# -- op 8 ------------------------------------------------------------------
def brute_removed(texts, m):
    seen = Counter(t[i : i + m] for t in texts for i in range(len(t) - m + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - m + 1):
            if seen[t[i : i + m]] > 1:
                gone[i : i + m] = True
        out.append(gone)
    return out


def check_removed(df, rows, m):
    raw = [(t or "").encode() for _, t in rows]
    gone = brute_removed(raw, m)
    want = Counter()
    for (d, _), t, g in zip(rows, raw, gone, strict=True):
        starts = int((g & ~np.append(False, g[:-1])).sum()) if len(g) else 0
        want[d, len(t), int(g.sum()), starts, np.frombuffer(t, np.uint8)[~g].tobytes()] += 1
    got = suffix_dedup.removals(df, m).collect()
    assert Counter((r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), bytes(r.kept)) for r in got) == want


@pytest.mark.parametrize("m", [60, 400])
def test_suffix_edge(edge, empty, m):
    check_removed(edge, pairs(edge), m)
    assert suffix_dedup.removals(empty, m).count() == 0


def test_suffix_random_overlaps(spark):
    """Shared pieces around the limit, periodic text, overlaps in one text."""
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abc") for _ in range(n)) for n in (58, 59, 60, 61, 75, 130, 300)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(pieces)
            a = rng.randrange(0, 4)
            parts += [p[a : len(p) - rng.randrange(0, 4)], "".join(rng.choice("abc") for _ in range(rng.randrange(0, 40)))]
        rows.append((i, "".join(parts)))
    rows += [(100, "abcab" * 60), (101, "z" * 59), (102, "y" * 61), (103, "é" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check_removed(df, rows, 60)


def test_suffix_on_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check_removed(df.select("doc_id", "text"), pairs(df), 400)


def test_op8_counts_input_bytes_and_removes_from_400_on(spark, tmp_path):
    """A passage of more than 50 words stays below 400 bytes and goes from there on;
    n_bytes counts the input in either case."""
    words = " ".join(f"w{i:03d}" for i in range(90))
    rows = [(2 * k + j, f"{j}{words[:n] if k else words[:n].upper()}{j}") for k, n in enumerate((399, 400)) for j in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_suffix_dedup(spark, str(tmp_path)).collect()}
    for i, text in rows:
        kept = text if i < 2 else text[:1] + text[-1:]
        assert got[i] == (len(text), len(text) - len(kept), int(i >= 2), hashlib.sha256(kept.encode()).hexdigest())


def test_without_repeats_keeps_columns(edge):
    out = suffix_dedup.without_repeats(edge, 60)
    assert out.columns == edge.columns and out.count() == edge.count()


def test_anchor_guarantee():
    """Every window has its phrases: first inner anchor and ROUNDS more."""
    rng = np.random.default_rng(1)
    w = suffix_dedup.window_of(400)
    raw = rng.integers(97, 100, 20_000).astype(np.uint8)
    at = suffix_dedup.anchors(raw, w)
    for p in range(0, len(raw) - 400, 37):
        inner = at[(at >= p + w - 1) & (at <= p + 401 - w - suffix_dedup.GRAM)]
        assert len(inner) > suffix_dedup.ROUNDS
    cut = suffix_dedup.anchors(raw[1000:1400], w)
    inner = cut[(cut >= w - 1) & (cut <= 401 - w - suffix_dedup.GRAM)]
    assert set(inner + 1000) == {a for a in at if 1000 + w - 1 <= a <= 1000 + 401 - w - suffix_dedup.GRAM}
