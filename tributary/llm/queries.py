"""Registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, conversations, exact_dedup, fingerprint, line_dedup, manifest, packing, quality, simhash, substring_dedup, suffix_dedup, suffix_tree, vector_join
from tributary.llm.common import lower_az, prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of repeated units that go, with the document whose copy stays."""
    prepare(spark)
    return substring_dedup.removals(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keeper and group of every document."""
    prepare(spark)
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    prepare(spark)
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    prepare(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without its host's boilerplate lines, on hosts of any size."""
    return line_dedup.clean(table(spark, sf_dir, "pages"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    prepare(spark)
    return fingerprint.edited_likeness(table(spark, sf_dir, "documents"))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document."""
    prepare(spark)
    return suffix_tree.scores(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeats of 400 bytes."""
    prepare(spark)
    found = suffix_dedup.removals(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    prepare(spark)
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def _round_trip(ids: list[list[int]], codec: bpe.Codec) -> list[pa.Array]:
    """Digests of the ids and of what they decode to."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    return [
        pa.array([len(x) for x in ids], pa.int64()),
        pa.array([sha(b",".join(map(codec.decimal.__getitem__, x))) for x in ids]),
        pa.array([sha(codec.decode(x).encode()) for x in ids]),
    ]


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again."""
    prepare(spark)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return bpe.coded(table(spark, sf_dir, "documents"), _round_trip, schema)


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """Faults, repair and its digest for every damaged conversation."""
    solved = conversations.repair(conversations.damaged(rows))
    return conversations.summaries(solved).withColumnRenamed("digest", "repaired_sha256")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and least repair of every damaged conversation."""
    prepare(spark)
    return repaired_conversations(table(spark, sf_dir, "conversations"))


def op12_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    prepare(spark)
    return vector_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def manifest_rows(docs: DataFrame, levels: int = manifest.LEVELS) -> DataFrame:
    """Digests of the manifest and of each document's proof, folded from a
    tampered leaf where 3 divides the document's checksum."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(hit, manifest.leaf_of(lower_az(F.col("text"))))
    found = manifest.proofs(docs, tampered, levels)

    def shown(name: str) -> Column:
        return F.lower(F.hex(name))

    # Per level, the first byte of an entry is the place in the run.
    texts = F.transform("siblings", lambda s: F.lower(F.hex(F.substring(s, 2, manifest.FANOUT * manifest.DIGEST))))
    return found.select(
        "doc_id",
        shown("leaf").alias("leaf"),
        shown("subroot").alias("subroot"),
        shown("root").alias("root"),
        F.sha2(F.array_join(texts, "").cast("binary"), 256).alias("proof_sha256"),
        shown("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, root and folded proof of every document."""
    prepare(spark)
    return manifest_rows(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_exact_dedup,
        op3_best_fit_packing,
        op4_simhash,
        op5_line_dedup,
        op6_fingerprint,
        op7_suffix_tree,
        op8_suffix_dedup,
        op9_quality,
        op10_bpe,
        op11_conversation_repair,
        op12_vector_join,
        op13_merkle_manifest,
    )
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


_OP1 = r"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\n]*?(?:[.!?]+[ \t]+|\n|$)') AS units FROM documents
), numbered AS (
    SELECT doc_id, generate_subscripts(units, 1) - 1 AS unit, unnest(units) AS u FROM cut
), placed AS (
    SELECT doc_id, unit, length(u) AS length,
        sum(length(u)) OVER w - length(u) AS start,
        sum(CAST(ends_with(u, chr(10)) AS INTEGER)) OVER w - CAST(ends_with(u, chr(10)) AS INTEGER) AS line,
        translate(trim(regexp_replace(u, '[ \t\r\n]+', ' ', 'g'), ' '),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain
    FROM numbered WHERE length(u) > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY unit)
), lines AS (
    SELECT doc_id, line, min(unit) AS unit, min(start) AS start, sum(length) AS length,
        string_agg(plain, ' ' ORDER BY unit) FILTER (plain <> '') AS plain
    FROM placed GROUP BY doc_id, line
), parted AS (
    SELECT *, sum(CAST(plain IS NULL AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY line) AS paragraph FROM lines
), passages AS (
    SELECT doc_id, min(unit) AS unit, min(start) AS start, sum(length) AS length, string_agg(plain, ' ' ORDER BY line) AS plain
    FROM parted WHERE plain IS NOT NULL GROUP BY doc_id, paragraph HAVING count(*) > 1
    UNION ALL SELECT doc_id, unit, start, length, plain FROM lines WHERE plain IS NOT NULL
    UNION ALL SELECT p.doc_id, p.unit, p.start, p.length, p.plain FROM placed p JOIN lines l USING (doc_id, line)
    WHERE p.plain <> l.plain AND length(p.plain) - length(replace(p.plain, ' ', '')) + 1 >= 5
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, start, length DESC) AS k,
        min(doc_id) OVER (PARTITION BY plain) AS keep_doc_id, count(*) OVER (PARTITION BY plain) AS copies
    FROM passages
)
SELECT doc_id, CAST(unit AS INTEGER) AS unit, CAST(start AS INTEGER) AS start, CAST(length AS INTEGER) AS length,
    keep_doc_id, copies FROM ranked WHERE k > 1
"""

_OP2 = """
WITH keyed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM keyed WINDOW g AS (PARTITION BY text_sha256)
"""

_OP5 = rf"""
WITH shown AS (
    SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{line_dedup.HOST}', 1)) AS host,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
            '{line_dedup.HIDDEN}', ' ', 'g'), '{line_dedup.BREAKS}', chr(10), 'g'),
            '{line_dedup.TAGS}', '', 'g'), '{line_dedup.BLANKS}', ' ', 'g') AS t FROM pages
), lined AS (
    SELECT page_id, host,
        list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
    FROM shown
), totals AS (SELECT host, count(*) AS host_pages FROM lined GROUP BY host),
each AS (SELECT host, unnest(list_distinct(lines)) AS line FROM lined),
boiler AS (
    SELECT host, list(line) AS lines FROM (
        SELECT host, line FROM each JOIN totals USING (host) WHERE host_pages >= {line_dedup.MIN_PAGES}
        GROUP BY host, line, host_pages
        HAVING count(*) > 1 AND count(*) / host_pages > {line_dedup.MAX_RATIO}
    ) GROUP BY host
), kept AS (
    SELECT page_id, host, host_pages, l.lines,
        list_filter(l.lines, lambda x: NOT list_contains(coalesce(b.lines, []), x)) AS kept
    FROM lined l JOIN totals USING (host) LEFT JOIN boiler b USING (host)
)
SELECT page_id, host, host_pages, CAST(len(lines) AS INTEGER) AS n_lines,
    CAST(len(lines) - len(kept) AS INTEGER) AS n_dropped, array_to_string(kept, chr(10)) AS kept_text FROM kept
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": _OP1, "op2_exact_dedup": _OP2, "op5_line_dedup": _OP5}
