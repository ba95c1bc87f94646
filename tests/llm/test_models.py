"""Packing, tokens, lines, fingerprints, language model, quality."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from conftest import SF_MID, SF_SMALL
from tributary.llm import bpe, common, fingerprint, line_dedup, packing, quality, queries, suffix_tree


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.default_path())


def odd_texts():
    rng = random.Random(5)
    texts = [
        "", " ", "\n\n  x", "a" * 999, "ab" * 700, "日本語" * 50, "é" * 129, "1234567890" * 20, "!?" * 99,
        "it's we'll I'D don't 'S ' 'll", "<|endoftext|>a<|endoftext|><|endoftext|>", "<|endoftext| >", "word" * 40,
        "tab\tend \u0085  x᠎ ​", "🙂🙂 🙂‍🙂", "\x00\x01", "  lead", "trail   ", "a  b   c",
    ]
    kinds = [(32, 127), (0x80, 0x800), (0x3000, 0x9FFF), (0x1F300, 0x1FAFF), (9, 33)]
    for _ in range(300):
        texts.append("".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(150))))
    return texts


def every_sign():
    """Each code point between letters, digits, blanks and the end."""
    for a in range(0, sys.maxunicode + 1, 64):
        signs = [chr(c) for c in range(a, min(a + 64, sys.maxunicode + 1)) if not 0xD800 <= c <= 0xDFFF]
        if signs:
            yield "".join(f"a{s}1{s} {s}{s}!{s}" for s in signs)


# -- op 10 -----------------------------------------------------------------
def test_bpe_equals_the_library(reference, codec):
    texts = odd_texts()
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)]
    assert got == want
    assert [codec.decode(i) for i in got] == [reference.decode(i, skip_special_tokens=False) for i in want]


def test_bpe_signs(reference, codec):
    texts = list(every_sign())[:1200]
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == want


def test_bpe_rows_and_single_trees_agree(codec):
    rng = random.Random(2)
    words = [bytes(rng.choice(b"theanio r") for _ in range(rng.randrange(2, 64))) for _ in range(300)]
    for w in words:
        assert codec._long(w) == codec._rows([w], 64)[0]


def test_bpe_bad_utf8_decodes_like_the_library(reference, codec):
    ids = [codec.byte_ids[b] for b in b"\xff\xe3\x81a\xf0\x9f"]
    assert codec.decode([int(i) for i in ids]) == reference.decode([int(i) for i in ids])


def test_bpe_frames(spark, edge, empty, reference):
    coded = bpe.encode(edge)
    want = Counter((d, tuple(reference.encode(t or "", add_special_tokens=False).ids)) for d, t in pairs(edge))
    assert Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == want
    assert Counter(pairs(bpe.decode(coded))) == Counter((d, t or "") for d, t in pairs(edge))
    assert bpe.encode(empty).count() == 0


def test_bpe_query(spark, reference):
    rows = {r.doc_id: r for r in queries.op10_bpe(spark, SF_SMALL).collect()}
    docs = pairs(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert len(rows) == len(docs)
    for d, t in docs:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert tuple(rows[d])[1:] == (len(ids), sha, back)


# -- op 3 ------------------------------------------------------------------
def test_packing_tokens_equal_the_library(reference):
    encoder = packing.encoder(bpe.default_path())
    for texts in (odd_texts(), list(every_sign())):
        want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
        assert [encoder.encode_to_numpy(t, allowed_special="all").tolist() for t in texts] == want


def check_packed(rows, docs, reference, capacity=2048):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    want = Counter()
    for d, t in docs:
        ids = np.array([*reference.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = packing.cut(len(ids), capacity)
        assert all(n == capacity for _, n in cuts[1:]) and sum(n for _, n in cuts) == len(ids)
        want.update((d, k, a, n, zlib.crc32(ids[a : a + n].tobytes())) for k, (a, n) in enumerate(cuts))
    assert Counter(tuple(r)[:5] for r in rows) == want
    bound = packing.lower_bound(np.array([r.length for r in rows], np.int64), capacity)
    assert bound <= len(by_seq) <= bound + max(1, bound // 100)


def test_pack_edge(edge, empty, reference):
    check_packed(packing.pack(packing.pieces(edge)).collect(), pairs(edge), reference)
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_pack_documents(spark, reference):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    check_packed(queries.op3_best_fit_packing(spark, SF_MID).collect(), pairs(docs), reference)


def least_bins(sizes, capacity):
    """Exact, by trying bins for the largest item first."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - sizes[i]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def test_bounds_and_best_fit():
    rng = random.Random(1)
    for _ in range(60):
        sizes = np.array([rng.randrange(1, 21) for _ in range(rng.randrange(1, 9))])
        bins = packing.best_fit_decreasing(sizes, 20)
        fill = np.bincount(bins, weights=sizes)
        exact = least_bins(sizes.tolist(), 20)
        assert fill.max() <= 20 and packing.lower_bound(sizes, 20) <= exact <= len(fill)
    # Sizes alone don't bound these: three of 11 in bins of 20, four of 7 with k-ths.
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3
    assert packing.lower_bound(np.array([7, 7, 7, 7, 7]), 20) == 3


def test_pack_ends_where_best_fit_keeps_a_gap(spark, monkeypatch):
    """Sizes whose bound best fit doesn't reach: a repacking gains nothing."""
    rng = random.Random(3)
    rows = [(i, 0, 0, rng.randrange(300, 700), i) for i in range(12_000)]
    rounds, real = [], packing._pack

    def counted(items, n, turn, last, capacity):
        rounds.append((n, items.count()))
        assert turn < 8
        return real(items, n, turn, last, capacity)

    monkeypatch.setattr(packing, "_pack", counted)
    monkeypatch.setattr(packing, "PIECES", 400)
    placed = packing.pack(spark.createDataFrame(rows, packing._PIECE)).collect()
    assert Counter(tuple(r)[:5] for r in placed) == Counter(rows)
    fill = Counter()
    for r in placed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    assert rounds[0] == (30, 12_000) and all(n >= m / 400 for n, m in rounds)
    first = packing.best_fit_decreasing(np.array([r[3] for r in rows]))
    assert len(fill) <= 1.02 * (first.max() + 1)


# -- op 5 ------------------------------------------------------------------
def brute_lines(html):
    t = re.sub(line_dedup.HIDDEN, " ", html or "")
    t = re.sub(line_dedup.TAGS, "", re.sub(line_dedup.BREAKS, "\n", t))
    return [x for x in (y.strip(" ") for y in re.sub(line_dedup.BLANKS, " ", t).split("\n")) if x]


def test_lines_edge(spark):
    rng = random.Random(7)
    rows = [(None, None, None), (1, "http://A.com/x", None), (2, None, "<p>alone</p>"), (2, None, "<p>alone</p>"), (3, "no scheme", "")]
    for i in range(10, 90):
        host = "hot.com" if i % 3 else f"h{i % 4}.org:80"
        own = "".join(f"<p>line {rng.randrange(30)} {i}</p>" for _ in range(5))
        rows.append((i, f"https://{host}/p?q#f", f"<nav>MENU  home</nav>{own}<div>menu home</div><li>{'foot' * 200}</li>"))
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, host int, lines int")
    hosts = [m[1].lower() if (m := re.match(line_dedup.HOST, u or "")) else "" for _, u, _ in rows]
    pages = Counter(hosts)
    held = Counter((h, x) for h, (_, _, t) in zip(hosts, rows, strict=True) for x in set(brute_lines(t)))
    want = Counter()
    for h, (p, _, t) in zip(hosts, rows, strict=True):
        lines = brute_lines(t)
        kept = [x for x in lines if pages[h] < 2 or held[h, x] < 2 or held[h, x] / pages[h] <= 0.3]
        want[p, h, pages[h], len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    assert Counter(tuple(r) for r in line_dedup.clean(df).collect()) == want
    assert line_dedup.clean(df.limit(0)).count() == 0


def test_salts_follow_a_hosts_pages(spark):
    """A host with most pages is spread by its share; two-page hosts are not."""
    pages = spark.range(4000).selectExpr("if(id % 3 > 0, 'hot', concat('h', id div 6)) as host", "id as page_id", "array('a', string(id)) as lines")
    totals = pages.groupBy("host").agg({"page_id": "count"}).withColumnRenamed("count(page_id)", "host_pages")
    hot = line_dedup.hot_hosts(totals)
    quarters = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = {r.host: r.salts for r in hot.collect()}
    assert set(found) == {"hot"} and quarters / 2 < found["hot"] <= quarters
    dealt = line_dedup.salted(pages, hot, line_dedup.F.xxhash64("page_id")).groupBy("host", "salt").count().collect()
    assert max(r["count"] for r in dealt) < 4000 / quarters * 2
    assert {r.salt for r in dealt if r.host != "hot"} == {0}


def test_small_hosts_lose_their_boilerplate(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    hosts = {p: m[1].lower() if (m := re.match(line_dedup.HOST, r.url or "")) else "" for p, r in pages.items()}
    lines = {p: brute_lines(r.html) for p, r in pages.items()}
    held = Counter((hosts[p], x) for p in pages for x in set(lines[p]))
    size = Counter(hosts.values())
    rows = {r.page_id: r for r in queries.op5_line_dedup(spark, SF_MID).collect()}
    assert rows.keys() == pages.keys()
    dropped = 0
    for p, h in hosts.items():
        kept = [x for x in lines[p] if held[h, x] < 2 or held[h, x] / size[h] <= 0.3]
        assert rows[p].kept_text == "\n".join(kept)
        dropped += (len(lines[p]) - len(kept)) * (size[h] < 5)
    assert dropped > 0


# -- op 6 ------------------------------------------------------------------
def brute_phrases(text):
    seen, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen


def check_fingerprints(rows, docs):
    def turn(text):
        signed = xxhash.xxh64_intdigest(text.encode(), 42)
        return signed - (signed >> 63 << 64)

    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), -turn(d[1] or ""), d[1] or ""))
    want = Counter()
    for i, (d, t) in enumerate(order):
        t, follower = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + follower[:half]
        own, other, after = (fingerprint.fingerprint(x) for x in (t, edited, follower))
        want[
            d, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.as_text(own), fingerprint.as_text(other),
            round(fingerprint.likeness(own, other), 9), round(fingerprint.likeness(own, after), 9),
        ] += 1
    assert Counter((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in rows) == want


def test_fingerprint_edge(edge, empty):
    check_fingerprints(fingerprint.edited_likeness(edge).collect(), pairs(edge))
    assert fingerprint.edited_likeness(empty).count() == 0
    assert fingerprint.fingerprints(edge).count() == edge.count()


def test_fingerprint_single_document(spark):
    df = spark.createDataFrame([(1, "abcabcabc")], "doc_id long, text string")
    check_fingerprints(fingerprint.edited_likeness(df).collect(), [(1, "abcabcabc")])


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: (None, 3, i)[i % 3], lambda i: 2**60 + i // 40])
def test_fingerprint_parts_a_hot_id(spark, monkeypatch, ids):
    """An id of a third of all rows or more is parted by its texts; equal ones
    are counted, not moved."""
    monkeypatch.setattr(fingerprint, "HOT_ROWS", 10)
    rng = random.Random(5)
    docs = [(ids(i), " ".join(rng.choices("abcdefgh", k=40)) if i % 4 else "one text that a quarter of the rows repeat") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    check_fingerprints(fingerprint.edited_likeness(df).collect(), docs)
    if len({d for d, _ in docs}) == 1:
        dealt = fingerprint.with_follower(df).cache()
        sizes = [r["count"] for r in dealt.groupBy("bucket").count().collect()]
        assert max(sizes) < 400 / 4
        assert dealt.filter("tail = 1").count() <= len(sizes)
        dealt.unpersist()


def test_fingerprint_documents(spark):
    rows = queries.op6_fingerprint(spark, SF_SMALL).collect()
    check_fingerprints(rows, pairs(spark.read.parquet(f"{SF_SMALL}/documents.parquet")))
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.98


def test_phrases_and_estimate():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (0, 1, 50, 3000, 3000)]
    texts.append(texts[3][:2000] + texts[4][:1000])
    for t in texts:
        got: set = set()
        fingerprint.parse(t, got)
        assert got == brute_phrases(t)
    for a in texts[2:]:
        for b in texts[2:]:
            x, y = brute_phrases(a), brute_phrases(b)
            near = fingerprint.likeness(fingerprint.fingerprint(a), fingerprint.fingerprint(b))
            assert abs(near - len(x & y) / len(x | y)) < 0.15
    none = fingerprint.fingerprint("")
    assert fingerprint.likeness(none, none) == 1.0 and fingerprint.likeness(none, fingerprint.fingerprint("a")) == 0.0


# -- op 7 ------------------------------------------------------------------
def check_base(rows, docs):
    trained = Counter()
    for d, t in docs:
        if d is None or zlib.crc32(str(d).encode()) % 10:
            trained.update(suffix_tree.words_of(t))
    n, v = sum(trained.values()), len(trained)
    want = Counter()
    for d, t in docs:
        words = suffix_tree.words_of(t)
        base = sum(math.log10((trained[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        held = d is not None and zlib.crc32(str(d).encode()) % 10 == 0
        want[d, held, len(words), sum(trained[w] > 0 for w in words), n, f"{base:.6g}"] += 1
    assert Counter((*tuple(r)[:5], f"{r.base_score:.6g}") for r in rows) == want


def test_scores_edge(edge, empty):
    rows = suffix_tree.scores(edge).collect()
    check_base(rows, pairs(edge))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert suffix_tree.scores(empty).count() == 0


def test_scores_without_training(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    df = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    row = suffix_tree.scores(df).collect()[0]
    assert row.train_tokens == 0 and row.n_known == 0 and math.isfinite(row.score)


def test_scores_beat_the_base(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = queries.op7_suffix_tree(spark, SF_MID).collect()
    check_base(rows, pairs(docs))
    held = [r for r in rows if r.held_out]
    assert np.mean([r.score > r.base_score for r in held]) > 0.9
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > 0.05 + sum(r.base_score for r in held) / sum(
        r.n_tokens for r in held
    )


class BruteTree:
    """The tree in dictionaries, from its definition."""

    def __init__(self, docs, depth, word_min, class_min, context_min, entry_min):
        self.depth = depth
        held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs]
        texts = [suffix_tree.words_of(t) for (_, t), h in zip(docs, held, strict=True) if not h]
        self.c = Counter(w for t in texts for w in t)
        self.own = {w for w, n in self.c.items() if n >= word_min}
        tokens, kinds = Counter(), Counter()
        for w, n in self.c.items():
            if w not in self.own:
                tokens[suffix_tree.ending(w)] += n
                kinds[suffix_tree.ending(w)] += 1
        self.classes = {e for e, n in tokens.items() if n >= class_min}
        self.tokens, self.kinds = Counter({None: 0}), Counter()
        for e, n in tokens.items():
            self.tokens[e if e in self.classes else None] += n
            self.kinds[e if e in self.classes else None] += kinds[e]
        for w in self.own:
            self.tokens[w] = self.c[w]
        total = sum(self.tokens.values())
        self.root = {s: (n + 0.1) / (total + 0.1 * len(self.tokens)) for s, n in self.tokens.items()}
        follows = defaultdict(Counter)
        for t in texts:
            s = ["^"] * depth + [self.symbol(w) for w in t]
            for i in range(depth, len(s)):
                for d in range(1, depth + 1):
                    follows[tuple(s[i - d : i])][s[i]] += 1
        self.kept = [{} for _ in range(depth + 1)]
        candidates = set()
        for d in range(1, depth + 1):
            for context, counts in follows.items():
                if len(context) != d or sum(counts.values()) < context_min or (d > 1 and context[:-1] not in candidates and set(context) != {"^"}):
                    continue
                candidates.add(context)
                n, listed = sum(counts.values()), {x: y for x, y in counts.items() if y >= entry_min}
                if not listed:
                    continue
                left = (n - sum(listed.values()) + 0.75 * len(listed)) / n
                gain = (n - sum(listed.values())) * math.log(max(left, 1e-12))
                for x, y in listed.items():
                    parent = self.p(context[1:], x)
                    gain += y * math.log(((y - 0.75) / n + left * parent) / parent)
                if gain >= 3 * len(listed):
                    self.kept[d][context] = ({x: (y - 0.75) / n for x, y in listed.items()}, left)

    def symbol(self, word):
        if word in self.own:
            return word
        return suffix_tree.ending(word) if suffix_tree.ending(word) in self.classes else None

    def p(self, context, following):
        p = self.root[following]
        for d in range(1, len(context) + 1):
            if tuple(context[-d:]) in self.kept[d]:
                share, left = self.kept[d][tuple(context[-d:])]
                p = share.get(following, 0.0) + left * p
        return p

    def score(self, text):
        words = suffix_tree.words_of(text)
        s, total = ["^"] * self.depth, 0.0
        for w in words:
            x = self.symbol(w)
            total += math.log10(self.p(s[len(s) - self.depth :], x))
            if w not in self.own:
                total += math.log10((self.c[w] + 0.1) / (self.tokens[x] + 0.1 * (self.kinds[x] + 1)))
            s.append(x)
        return total


def check_scores(rows, docs, limits):
    brute = BruteTree(docs, *limits)
    assert Counter((r.doc_id, f"{r.score:.7g}") for r in rows) == Counter((d, f"{brute.score(t):.7g}") for d, t in docs)
    return brute


def test_numbers_round_trip():
    for x in (np.array([3, 9, 2**63 + 1], np.uint64), np.zeros(0, np.uint64), np.array([-1, 7]), np.array([0.5, np.nan])):
        for rising in (False, True):
            if x.dtype != float or not rising:
                back = suffix_tree._numbers(suffix_tree._bytes(x, rising), x.dtype, rising)
                assert np.array_equal(back, x, equal_nan=x.dtype == float)


@pytest.mark.parametrize("limits", [(3, 4, 4, 4, 2), (2, 32, 32, 32, 3), (0, 8, 8, 8, 2)])
def test_scores_equal_brute_force(edge, limits):
    rows = suffix_tree.scores(edge, limits[0], suffix_tree.Limits(*limits[1:])).collect()
    check_scores(rows, pairs(edge), limits)


def test_scores_of_many_blocks_equal_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(3).cache()
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 20_000)
    limits = (3, 8, 8, 8, 2)
    brute = check_scores(suffix_tree.scores(docs, limits[0], suffix_tree.Limits(*limits[1:])).collect(), pairs(docs), limits)
    assert all(brute.kept[1:])
    # Of all symbols, P sums to one in every state.
    for d in range(4):
        for context in [("^",) * d, *sorted(brute.kept[d], key=repr)[:20]]:
            assert abs(sum(brute.p(context, s) for s in brute.root) - 1) < 1e-9


def test_tree_grows_with_the_corpus(spark):
    """More text, more words with a symbol of their own, and more contexts."""
    few, many = (suffix_tree.tree(spark.read.parquet(f"{d}/documents.parquet"), 2, suffix_tree.Limits()) for d in (SF_SMALL, SF_MID))
    assert many[0].n_symbols > 2 * few[0].n_symbols
    for (_, a), (_, b) in zip(few[3], many[3], strict=True):
        assert b.count() > 2 * a.count()


def test_scores_leave_only_tables_they_read(spark, monkeypatch):
    """Tables that no later step reads are off the disk before the scores."""
    made = []
    monkeypatch.setattr(suffix_tree, "written", lambda df, label, *path: made.append(label) or common.written(df, label, *path))
    docs = spark.createDataFrame([(i, "a b c a b d " * 9) for i in range(40)], "doc_id long, text string")
    root = f"{spark.conf.get('spark.checkpoint.dir')}/jobs"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    found = suffix_tree.scores(docs, 2, suffix_tree.Limits(2, 2, 2, 2))
    left = Counter(p.rsplit("-", 1)[0] for p in set(os.listdir(root)) - before)
    assert made.count("entries") == 2 and "blocks" in made
    assert left == {"symbols": 1, "counts": 2, "escapes": 2}
    assert found.count() == 40


def test_hashes_rise_with_their_range(spark):
    codes = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, np.uint64))
    found = suffix_tree.bucket_of(codes, 13)
    assert set(found) == set(range(13)) and (np.diff(found) >= 0).all()
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    assert [r[0] for r in df.select(suffix_tree.bucket_column(df.code, 13)).collect()] == found.tolist()


def test_distinct_equals_sorting_in_full():
    rng = np.random.default_rng(3)
    few = rng.integers(0, 300, 4000).astype(np.uint64)
    for codes in (rng.integers(0, 2**64, 4000, np.uint64), few, few << np.uint64(55), few[:1], few[:0]):
        found, place, number = suffix_tree.distinct(codes)
        want, back = np.unique(codes, return_inverse=True)
        assert np.array_equal(found, want) and np.array_equal(number, back) and np.array_equal(codes[place], want)


def test_endings_equal_those_of_single_words():
    rng = random.Random(4)
    words = [bytes(rng.choice(b"ab\0\xff" + suffix_tree.MARKS) for _ in range(rng.randrange(1, 7))) for _ in range(3000)]
    for some in (words, [suffix_tree.END], []):
        assert suffix_tree.endings(some).tolist() == [suffix_tree.ending(w) for w in some]


def test_cells_are_sent_compressed():
    small = np.arange(4000) % 3
    assert len(suffix_tree._bytes(small)) < 400


def test_first_questions_need_no_exchange(spark):
    docs = spark.createDataFrame([(i, "a b c a b d " * 9) for i in range(40)], "doc_id long, text string")
    limits = suffix_tree.Limits(2, 2, 2, 2)
    model, state, _, _ = suffix_tree.tree(docs, 0, limits)
    asked = suffix_tree.asks(state, model, 4, limits)
    assert "Exchange" not in asked._jdf.queryExecution().executedPlan().toString()
    assert asked.count() > 0


def test_blocks_are_exchanged_in_shares(spark, monkeypatch):
    """Each share is a table of its own; scores are those of the whole, and each
    block is walked once a level for lists and questions."""
    made = []
    monkeypatch.setattr(suffix_tree, "written", lambda df, label, *path: made.append(label) or common.written(df, label, *path))
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 4_000)
    monkeypatch.setattr(suffix_tree, "WAVE_BLOCKS", 2)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(3).cache()
    limits = (2, 8, 8, 8, 2)
    root = f"{spark.conf.get('spark.checkpoint.dir')}/jobs"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    found = suffix_tree.scores(docs, limits[0], suffix_tree.Limits(*limits[1:]))
    left = Counter(p.rsplit("-", 1)[0] for p in set(os.listdir(root)) - before)
    assert Counter(made) == {
        "blocks": 1, "word-counts": 1, "symbols": 4, "counts": 2, "entries": 8, "contexts": 2, "escapes": 2,
    }
    assert left == {"symbols": 1, "counts": 2, "escapes": 2}
    check_scores(found.collect(), pairs(docs), limits)


# -- op 9 ------------------------------------------------------------------
def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = queries.op9_quality(spark, SF_MID).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert np.mean([b for a, b in held if a == 1]) > 0.98


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    held = quality.fold_of(labels.doc_id) == quality.HELD_OUT
    other = labels.withColumn("quality", (quality.F.when(held, 1 - labels.quality).otherwise(labels.quality)))
    a, b = ({r.doc_id: r.score for r in quality.scores(docs, x).collect()} for x in (labels, other))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_quality_fit_equals_an_independent_minimiser(spark):
    """Newton's weights against plain accelerated descent on the same risk."""
    rng = np.random.default_rng(8)
    n, prior = 4000, 0.4
    x = np.abs(rng.normal(0.4, 0.2, (n, quality.N_BASE))).astype("<f4")
    good = rng.random(n) < prior
    x[good, :3] += 0.1
    trusted = good & (rng.random(n) < 0.9)
    rows = [(x[i].tobytes(), bool(trusted[i])) for i in range(n)]
    found = quality.fit(spark.createDataFrame(rows, "x binary, trusted boolean").repartition(4), prior)

    columns = np.concatenate([x, x * x, np.sqrt(x)], axis=1).astype(float)
    mean, scale = columns.mean(0), columns.std(0)
    z = np.concatenate([(columns - mean) / scale, np.ones((n, 1))], axis=1)
    weight = np.append(np.full(z.shape[1] - 1, quality.RIDGE), 0.0)

    def parts(w):
        f = z @ w
        positive = prior * np.logaddexp(0, -f[trusted]).mean()
        negative = np.logaddexp(0, f).mean() - prior * np.logaddexp(0, f[trusted]).mean()
        return positive, negative, (weight * w * w).sum() / 2

    w = before = np.zeros(z.shape[1])
    pace = 4 / np.linalg.eigvalsh(z.T @ z / n + 4 * np.diag(weight))[-1]
    for i in range(5_000):
        at = w + i / (i + 3) * (w - before)
        slope = (1 / (1 + np.exp(-z @ at))) @ z / n - prior * z[trusted].mean(0) + weight * at
        before, w = w, at - pace * slope
    own = np.append(found[:-1] * scale, found[-1] + found[:-1] @ mean)
    assert parts(w)[1] >= 0 and parts(own)[1] >= 0
    assert abs(sum(parts(own)) - sum(parts(w))) < 1e-4
    assert np.abs(1 / (1 + np.exp(-z @ own)) - 1 / (1 + np.exp(-z @ w))).max() < 0.02


def test_quality_edge(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (4, 1), (4, 0), (11, 0), (20, 1), (None, 1), (21, None)], "doc_id long, quality int")
    assert quality.scores(edge, labels).count() == edge.count()
    assert quality.scores(empty, labels).count() == 0
    none = quality.scores(edge, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    kept = quality.accepted(edge, labels)
    assert kept.columns == edge.columns
    assert quality.accepted(empty, labels).count() == 0
