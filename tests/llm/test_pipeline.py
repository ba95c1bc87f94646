"""The corpus pipeline against a brute-force version of its stages."""

from __future__ import annotations

import inspect
import random
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from tributary.llm import bpe, quality

from .test_dedup import AZ, brute_components, brute_fingerprint, brute_removed
from .test_models import check_packed


def test_stages():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(set(names)) == len(names) == 5
    for _, f in corpus_pipeline.STAGES:
        assert list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    good = {r.doc_id for r in quality.scores(docs, labels).collect() if r.predicted}
    rows = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id in good}
    keep = defaultdict(int)
    for d, t in rows.items():
        keep[t.translate(AZ)] = max(keep[t.translate(AZ)], d)
    rows = {d: rows[d] for d in keep.values()}
    items = [(d, brute_fingerprint(t)) for d, t in rows.items()]
    least = brute_components(items, lambda a, b: (a ^ b).bit_count() <= 2)
    rows = {d: rows[d] for (d, _), c in zip(items, least, strict=True) if d == c}
    gone = brute_removed([t.encode() for t in rows.values()], corpus_pipeline.PASSAGE_BYTES)
    left = [
        (d, np.frombuffer(t.encode(), np.uint8)[~g].tobytes().decode(errors="ignore"))
        for (d, t), g in zip(rows.items(), gone, strict=True)
    ]
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    check_packed(out, left, Tokenizer.from_file(bpe.default_path()))


def test_passages_of_over_50_words_go(spark):
    """Passages of 51 to 70 words, each in two documents, are found."""
    rng = random.Random(4)
    vowels, rest = "aeiou", "bcdfglmnprst"

    def words(n):
        return " ".join("".join(rng.choice(rest) + rng.choice(vowels) for _ in range(rng.randrange(1, 5))) for _ in range(n))

    planted = [words(rng.randrange(51, 71)) for _ in range(60)]
    rows = [(2 * i + k, f"{words(80)} {p} {words(80)}", "en", "web", 0) for i, p in enumerate(planted) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, docs, SF_SMALL).collect()}
    caught = [all(p not in left[2 * i + k].text for k in range(2)) for i, p in enumerate(planted)]
    assert sum(caught) >= 0.9 * len(planted)
    assert all(r.n_chars == len(r.text) >= 400 for r in left.values())


def test_stages_on_edges(spark, edge, empty):
    for docs in (edge, empty):
        own = docs.withColumn("n_chars", quality.F.length("text").cast("long"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, own, SF_SMALL)
            assert out.columns == own.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in own.schema]
            own = out
        corpus_pipeline.STAGES[-1][1](spark, own, SF_SMALL).count()
