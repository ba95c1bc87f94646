"""Feeds that arrive as pages of an API.

A client that walks a cursor API records each response as a JSON line of its
cursor, attempt, status and body, the body as text, just as it came: bodies may
be error messages or cut off, and a page may be asked for again and recorded
twice. Landing reads all of them in parallel (a response is a row, whatever
order they were fetched in), so bronze does not depend on how often a page was
tried:

* a response stands if its status is 200 and its body is an object with the
  array of records; others are stored with their text and count as failed;
* of several that stand for a cursor the last attempt does; responses that
  repeat it in full are one;
* cursors that a page names as the next one but that no response landed are
  reported as missing, so a walk that broke off does not look complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.sources.landing import CORRUPT_COLUMN, FEEDS, with_audit
from tributary.sources.semistructured import parse_lines

RESPONSE = "cursor string, attempt int, status int, body string"
AUDIT = ("source_system", "source_format", "ingestion_timestamp", "file_name")
OK = 200
# Rows of a row group of stored pages: readers hold all of them at once, thousands
# otherwise. Its bytes alone, which are counted compressed, would not bound them.
GROUP_PAGES = 16
# Superseded responses that may be broadcast: two longs each.
BROADCAST_BEATEN = 1_000_000


def read_responses(
    spark: SparkSession, path: str, feed: str, member: str, ingestion_ts: str | None = None
) -> DataFrame:
    """Every recorded response: cursor, attempt, status, ``stands``, next cursor,
    the texts of its records, their number, the body's digest, the body's own
    text where it does not stand, and audit columns. A line that is no response
    has no cursor."""
    body_schema = f"next string, `{member}` array<string>, {CORRUPT_COLUMN} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    lines = with_audit(spark.read.text(path), *FEEDS[feed], ingestion_ts).filter(F.trim("value") != "")
    told = lines.withColumn("r", F.from_json("value", RESPONSE)).select("value", "r.*", *AUDIT)
    parsed = told.withColumn("page", F.from_json("body", body_schema, options))
    records = F.col("page").getField(member)
    whole = F.col("page").getField(CORRUPT_COLUMN).isNull() & records.isNotNull()
    judged = parsed.withColumn("stands", F.coalesce((F.col("status") == OK) & F.col("cursor").isNotNull() & whole, F.lit(False)))
    return judged.select(
        "cursor",
        F.coalesce("attempt", F.lit(0)).alias("attempt"),
        "status",
        "stands",
        F.when(F.col("stands"), F.col("page.next")).alias("next"),
        F.when(F.col("stands"), records).alias("records"),
        F.when(F.col("stands"), F.size(records)).otherwise(0).alias("n_records"),
        F.xxhash64("body").alias("digest"),
        F.when(~F.col("stands"), F.coalesce("body", "value")).alias("rejected_text"),
        *AUDIT,
    )


def standing(responses: DataFrame) -> DataFrame:
    """One response per landed cursor, of a stored table of responses.

    Which ones are superseded is found from cursors, attempts and digests alone,
    and counted; pages move only if they are too many to broadcast. A plain join
    would write the pages to a shuffle before their number is known."""
    place = F.struct("attempt", "digest", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    good = responses.withColumn("place", place).filter("stands")
    tried = good.select("cursor", "place")
    best = tried.groupBy("cursor").agg(F.max("place").alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    beaten = tried.join(best, "cursor").filter(F.col("place") != F.col("best")).select("place.file", "place.row")
    if beaten.limit(BROADCAST_BEATEN + 1).count() <= BROADCAST_BEATEN:
        beaten = F.broadcast(beaten)
    kept = good.withColumns({"file": F.col("place.file"), "row": F.col("place.row")})
    return kept.join(beaten, ["file", "row"], "left_anti").select(*responses.columns)


def records(responses: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of the standing responses: the schema's columns, fields that
    it does not know in ``extra``, and audit columns."""
    each = standing(responses).select(F.explode("records").alias("value"), *AUDIT)
    return parse_lines(each, schema)


def page_report(responses: DataFrame) -> DataFrame:
    """A row per cursor that was asked for or named: responses, failed ones,
    records landed, and whether it is landed at all."""
    asked = responses.select(
        "cursor", F.lit(1).alias("one"), (~F.col("stands")).cast("int").alias("bad"), F.lit(0).alias("n"), F.lit(False).alias("ok")
    )
    zero = F.lit(0)
    kept = standing(responses)
    landed = kept.select("cursor", zero, zero, F.col("n_records"), F.lit(True))
    named = kept.filter(F.col("next").isNotNull()).select("next", zero, zero, zero, F.lit(False))
    return (
        asked.unionAll(landed).unionAll(named).groupBy("cursor").agg(
            F.sum("one").alias("responses"), F.sum("bad").alias("failed"), F.sum("n").alias("records"), F.bool_or("ok").alias("landed")
        )
    )


def land_pages(
    spark: SparkSession, path: str, bronze: str, feed: str, member: str, ingestion_ts: str | None = None, batch: str = "base"
) -> DataFrame:
    """Store the recorded responses as the batch's partition of a bronze table,
    which a retry replaces; returns all stored batches."""
    found = read_responses(spark, path, feed, member, ingestion_ts)
    writer = found.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", str(GROUP_PAGES))
    writer.parquet(f"{bronze}/batch={batch}")
    return spark.read.schema(found.schema).parquet(bronze)
