"""Corpus preparation: quality, exact and near duplicates, repeats, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.

Defined results: an empty table passes through all stages; a null text counts
as empty everywhere and scores as such; the operators' docstrings define ties,
repeated rows and null doc_ids. A document whose text is removed as a whole
stays, with an empty text, and is packed as its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from tributary.llm.common import prepare, table, written

# Bytes of a repeat that is removed: a passage of over 50 words has as many,
# of five letters and more a word with its blank on average.
PASSAGE_BYTES = 256


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    prepare(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return simhash.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere, too; n_chars follows."""
    prepare(spark)
    found = suffix_dedup.without_repeats(docs, PASSAGE_BYTES)
    if "n_chars" in found.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the place of every piece of every document."""
    prepare(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", pack),
]

# Learned scores, components and packing are beyond SQL; a test holds the
# result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
