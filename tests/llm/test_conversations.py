"""Conversation repair against brute force."""

from __future__ import annotations

import heapq
import random
import zlib
from hashlib import sha256

import pytest

from conftest import SF_SMALL
from tributary.llm import conversations, queries

BLANKS = " \t\n\v\f\r"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit) by Dijkstra over (row, state): costs and texts only
    grow, so the first arrival at the end is the answer."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, q, kept = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, audit, kept
        for role in ("user", "assistant"):
            if (q, role[0]) in STEP:
                heapq.heappush(heap, (cost + 2, audit + "I", i, STEP[q, role[0]], (*kept, (role, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, kept))
        if fault in ("blank", "duplicate"):
            continue
        more = fault == "truncated"
        if (q, role[:1]) in STEP:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, STEP[q, role[0]], (*kept, (role, text))))
        for new in ("user", "assistant"):
            if (q, new[0]) in STEP:
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, STEP[q, new[0]], (*kept, (new, text))))
    raise AssertionError


def brute(rows):
    convs = {r[0]: [] for r in rows}
    for r in damage(rows):
        convs[r[0]].append(r)
    out = []
    for conv, some in convs.items():
        some.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, named, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in some:
            words = text.strip(BLANKS)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else None
            fault = fault or ("truncated" if words[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            named.append((role, text, fault))
        turns = [r[1] for r in some if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = zip(named, named[1:], strict=False)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, audit, kept = cheapest(named)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    return sorted((tuple(r) for r in queries.repaired_conversations(df).select(COLUMNS).collect()), key=repr)


def frame(spark, rows):
    extra = "part int, seg int, codes int, state int, present int, copy int, kind int, head int, hash int, tie int, row int, cost int"
    return spark.createDataFrame([(*r, *range(12)) for r in rows], f"conv_id long, turn long, role string, text string, {extra}")


def made(rng, convs, longest):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown", "User"]
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", None, "a. \n", "É", "Well\x85"]
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant"][t % 2 :] + roles) if rng.random() < 0.6 else ("user", "assistant")[t % 2]
            text = rng.choice(texts) if rng.random() < 0.4 else f"Text {c} {t} {rng.random()}" + rng.choice([".", "?", ""])
            rows.append((c, rng.choice([t, t, t, t + 1, None, 2 * t]), role, text))
    return rows


def test_damaged_conversations(spark):
    rows = made(random.Random(5), 250, 14)
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (-3, None, "system", "S."), (7_000, 5, "user", "x" * 200_000 + ".")]
    rows += [(8_000, t, "user", "Same.") for t in range(40)] + [(8_001, 3, "user", "Same.")] * 50
    rng = random.Random(6)
    rng.shuffle(rows)
    assert found(frame(spark, rows).repartition(5)) == brute(rows)


def test_empty_and_lost(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(frame(spark, [])) == []
    rows = [(lost, 0, "user", "Gone.")]
    assert found(frame(spark, rows)) == brute(rows) == [(lost, *[0] * 6, "", sha256(b"").hexdigest())]


@pytest.mark.parametrize("kind", ["talk", "users", "deleted"])
def test_long_conversation_over_many_chunks(spark, kind):
    """Most rows are one conversation, which every partition has a chunk of."""
    rng = random.Random(7)
    rows = [(1, t, "system", "S.") for t in range(3)] + made(rng, 60, 5)
    for t in range(3, 3000):
        role = {"talk": ("assistant", "user")[t % 2], "users": "user", "deleted": rng.choice(["user", "assistant"])}[kind]
        text = f"T{t}" + rng.choice([".", "", "!"]) if kind != "deleted" or t < 5 or t > 2990 else rng.choice(["", "Again.", "Same."])
        rows.append((1, t, role if rng.random() < 0.98 else "assistant", text))
    assert found(frame(spark, rows).repartition(7)) == brute(rows)


def test_segments_of_one_partition(spark):
    """Rows over several segments and one chunk, with the turns they leave."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"T {t}.") for c in range(3) for t in range(5000)]
    df = conversations.rows_of(frame(spark, rows))
    solved = conversations.repair(df)
    left = conversations.turns(solved).orderBy("conv_id", "part", "seg", "row").collect()
    assert [(r.conv_id, r.role, r.text) for r in left] == [(c, r, t) for c, _, r, t in rows]
    assert solved[1].agg({"seg": "max"}).first()[0] >= 0


def test_passes_end_where_vectors_agree():
    rng = random.Random(8)
    codes = [bytes(rng.choice([0, 1, 2, 3, 5, 9, 10]) for _ in range(50)) for _ in range(20)]
    whole, total = conversations.backward(b"".join(codes), conversations.END)
    end, parts = conversations.END, 0
    for c in reversed(codes):
        vectors, low = conversations.backward(c, end)
        end, parts = vectors[0], parts + low
    assert (end, parts) == (whole[0], total)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.queries()["op11_conversation_repair"](spark, SF_SMALL).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
