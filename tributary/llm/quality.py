"""Quality classifier by positive-unlabelled learning.

Trusted positives are the labelled good documents of the training fold;
every document of the corpus is unlabelled web text. The class prior is
estimated from the training fold's labels. With the logistic loss the unbiased
risk of a linear model is convex,

    R = prior E_P[loss(f)] + max(0, E_U[loss(-f)] - prior E_P[loss(-f)]),

so damped Newton steps minimise it. Sums run over all documents on the
executors; only sums come to the driver, as many as there are pairs of
features. The second term can't be negative for a true risk: a step that would
make it so is shortened until it isn't (the non-negative estimator).

Features are bounded statistics of the whole text: byte classes, word shapes,
repetition. Labels, lang, source and doc_id are no inputs of a score.

Defined results: a null text scores as the empty one, whose features are all
zero; a document without doc_id is scored and has no label; of several labels
of a doc_id the least counts; without a trusted positive every score is the
prior; ``accepted`` judges rows that share a doc_id each by its text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import free_names, written

FOLDS = 3
HELD_OUT = 1
RIDGE = 1e-3
STEPS = 12
ENOUGH = 1e-5
# Steps tried along the Newton direction, in one pass over the data.
LENGTHS = (1.0, 0.5, 0.25, 0.1, 0.03)

_SIGNS = b"#$%&*|!@^~+=<>{}[]\\/_"


def _classes() -> np.ndarray:
    """Class of every byte: one-hot rows for counting with one product."""
    byte = np.arange(256)
    low, up = (byte >= 97) & (byte <= 122), (byte >= 65) & (byte <= 90)
    digit, blank = (byte >= 48) & (byte <= 57), np.isin(byte, list(b" \t\n\r\v\f"))
    sign, mark = np.isin(byte, list(_SIGNS)), np.isin(byte, list(b".,;:?'\"()-"))
    line, high, ctrl = byte == 10, byte >= 128, (byte < 32) & ~blank
    return np.stack([low, up, digit, blank, sign, mark, line, high, ctrl]).astype(np.float64).T


CLASSES = _classes()
N_BASE = 22


def features(text: str) -> np.ndarray:
    """Bounded statistics of a whole text; all zero for one without words."""
    raw = text.encode()
    words = raw.split()
    out = np.zeros(N_BASE, np.float32)
    if not words:
        return out
    n, w = len(raw), len(words)
    low, up, digit, blank, sign, mark, line, high, ctrl = (
        np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES
    )
    letters = max(low + up + high, 1)
    kinds = len(set(words))
    pairs = len(set(pairwise(words)))
    again = sum(a == b for a, b in pairwise(words))
    lengths = np.fromiter(map(len, words), np.int64, w)
    plain = raw.lower().split()
    lines = raw.split(b"\n")
    out[:] = (
        up / letters,
        digit / n,
        blank / n,
        min(sign / w, 4.0),
        min(mark / w, 4.0),
        high / n,
        ctrl / n,
        min(line / w, 1.0),
        math.log(w) / 10,
        kinds / w,
        pairs / max(w - 1, 1),
        again / w,
        min(lengths.mean() / 10, 5.0),
        min(lengths.std() / 10, 5.0),
        min(lengths.max() / 50, 5.0),
        float((lengths <= 3).mean()),
        len(set(plain)) / w,
        len(set(lines)) / len(lines),
        sum(x.isalpha() for x in words) / w,
        sum(x[:1].isupper() for x in words) / w,
        sum(x.isupper() for x in words) / w,
        sum(x[-1:] in b"!#$%&*|" for x in words) / w,
    )
    return out


def expand(x: np.ndarray) -> np.ndarray:
    """Rows of features with their squares and square roots, and a constant."""
    return np.concatenate([x, x * x, np.sqrt(np.abs(x)), np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, key, x): a digest of the text and the features as little-endian
    float32 bytes."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t or "").astype("<f4").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], ["doc_id", "key", "x"])

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")
    return keyed.mapInArrow(task, "doc_id long, key long, x binary")


def _sums(table: DataFrame, per_rows) -> np.ndarray:
    """Sum over all rows of ``per_rows(x, trusted)``, an array per batch.

    Each task adds up its own rows; Spark adds up those, element by element.
    """

    def task(batches) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<f4").reshape(-1, N_BASE)
                part = per_rows(expand(x), batch.column(1).to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "s"])

    rows = table.select("x", "trusted").mapInArrow(task, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
    found = sorted((r.i, r.s) for r in rows.collect())
    return np.array([s for _, s in found])


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(table: DataFrame, prior: float) -> np.ndarray | None:
    """Weights over standardised ``expand`` columns, folded back to raw ones.

    ``table``: (x, trusted). None without trusted positives.
    """
    d = 3 * N_BASE + 1

    def moments(x, trusted):
        return np.concatenate([x.sum(0), (x * x).sum(0), x[trusted].sum(0), [len(x), trusted.sum()]])

    found = _sums(table, moments)
    if not len(found) or not found[-1]:
        return None
    n_u, n_p = found[-2:]
    mean, scale = found[:d] / n_u, np.sqrt(np.maximum(found[d : 2 * d] / n_u - (found[:d] / n_u) ** 2, 1e-12))
    mean[-1], scale[-1] = 0.0, 1.0
    scale[scale < 1e-5] = np.inf  # a column that never changes
    mean_p = (found[2 * d : 3 * d] / n_p - mean) / scale
    ridge = np.full(d, RIDGE)
    ridge[-1] = 0.0

    w = np.zeros(d)
    w[-1] = math.log(prior / (1 - prior))
    last = math.inf
    for _ in range(STEPS):

        def slopes(x, trusted, w=w):
            z = (x - mean) / scale
            p = _sigmoid(z @ w)
            return np.concatenate([p @ z, ((z * (p * (1 - p))[:, None]).T @ z).ravel()])

        found = _sums(table, slopes) / n_u
        gradient = found[:d] - prior * mean_p + ridge * w
        curve = found[d:].reshape(d, d) + np.diag(ridge + 1e-9)
        step = -np.linalg.solve(curve, gradient)
        tried = [w + a * step for a in LENGTHS]

        def risks(x, trusted, tried=tried):
            z = (x - mean) / scale
            f = z @ np.stack(tried, 1)
            return np.concatenate([_softplus(f).sum(0), _softplus(f[trusted]).sum(0), _softplus(-f[trusted]).sum(0)])

        found = _sums(table, risks).reshape(3, -1)
        negative = found[0] / n_u - prior * found[1] / n_p
        risk = prior * found[2] / n_p + np.maximum(negative, 0) + [(ridge * v * v).sum() / 2 for v in tried]
        good = [i for i in range(len(tried)) if negative[i] >= 0 and risk[i] < last]
        if not good:
            break
        best = min(good, key=lambda i: risk[i])
        gain, last, w = last - risk[best], risk[best], tried[best]
        if gain < ENOUGH:
            break
    raw = w / scale
    raw[-1] -= (raw * mean).sum()
    return raw


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: doc_id, key, held_out, score, predicted."""
    held = F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False))
    marks = (
        labels.where("quality is not null and doc_id is not null")
        .where(~held)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
    )
    counts = marks.agg(F.avg("quality")).first()[0]
    prior = min(max(counts if counts is not None else 0.5, 0.01), 0.99)
    joined = featured(docs).join(marks, "doc_id", "left")
    table = written(joined.select("doc_id", "key", "x", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("trusted")), "features")
    w = fit(table, prior)

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<f4").reshape(-1, N_BASE)
            p = _sigmoid(expand(x) @ w) if w is not None else np.full(len(x), prior)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(p)], ["doc_id", "key", "score"])

    scored = table.select("doc_id", "key", "x").mapInArrow(task, "doc_id long, key long, score double")
    return scored.select(
        "doc_id", "key", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all columns."""
    doc, key = free_names(docs, "doc", "key")
    bad = scores(docs, labels).where("predicted = 0").select(F.col("doc_id").alias(doc), F.col("key").alias(key))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key))
    return docs.join(bad, same, "left_anti")
