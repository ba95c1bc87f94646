from __future__ import annotations

import random

import pytest

# Extra columns whose names the operators use inside, too.
EXTRA = (
    "rank int, hi int, lo int, digest string, block int, fp int, u int, v int, bucket int, tail int, n int, c int, "
    "__digest int, __doc int, __key int, __block int, __cuts int, doc int, keep int, rows int, cuts int, block_ int, "
    "first int, key int, x int, trusted int, score int, keep_id int, group_size int, sequence_id int, node int, lines int"
)


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def edge_rows(seed=1):
    """Nulls, empty, blank and very long texts, ties, repeated rows, copies."""
    rng = random.Random(seed)
    passage = ". ".join(words(rng, 12) for _ in range(6)) + ". "
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One Two THREE four five six"),
        (5, "one two three FOUR five six"),
        (5, "one two three FOUR five six"),
        (6, "one two three FOUR five six"),
        (None, "a row without an id, alone with its text in here"),
        (None, "One Two THREE four five six"),
        (7, "a"),
        (8, "É é ß İ ſ K"),
        (9, "é é ß İ ſ k"),
        (10, words(rng, 40_000)),
        (11, "x" * 5_000),
        (12, "ab" * 3_000 + " end."),
        (13, "<|endoftext|> and <|endoftext|>"),
    ]
    for i in range(20, 60):
        before, after = words(rng, rng.randrange(5, 200)), words(rng, rng.randrange(5, 200))
        rows.append((i, before + ". " + (passage if i % 3 == 0 else "") + after))
    long = words(rng, 300)
    rows += [(70 + i, long.replace("w1 ", f"v{i} ", 1) if i % 2 else long) for i in range(12)]
    return rows


def docs_frame(spark, rows):
    n = len(EXTRA.split(","))
    return spark.createDataFrame([(*r, *range(n)) for r in rows], f"doc_id long, text string, {EXTRA}")


@pytest.fixture(scope="session")
def edge(spark):
    from tributary.llm.common import prepare

    prepare(spark)
    return docs_frame(spark, edge_rows()).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return docs_frame(spark, [])
