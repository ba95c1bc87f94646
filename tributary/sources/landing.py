"""Landing: file readers for the three feeds and the bronze layer.

Bronze is raw feed columns plus four audit columns. Readers take an explicit
schema (no inference pass over the data), read every file of a folder in
parallel, and record each row's source file from the scan's ``_metadata``
column, so lineage survives without a driver-side file listing.
"""

from __future__ import annotations

import hashlib
import inspect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.schemas import ECOMMERCE_SCHEMA, MOBILE_SCHEMA, POS_FIELDS, POS_SCHEMA
from tributary.session import workspace_dir
from tributary.sources import fixtures

# Raw text of a line that does not fit its feed, NULL for the others.
CORRUPT_COLUMN = "_corrupt_record"

# Source system and format labels of the three feeds.
FEEDS = {
    "pos": ("legacy_pos", "csv"),
    "ecommerce": ("ecommerce_platform", "json"),
    "mobile": ("mobile_app", "parquet"),
}


def with_audit(
    df: DataFrame, source_system: str, source_format: str, ingestion_ts: str | None = None
) -> DataFrame:
    """Append the audit columns (S6). The file name comes from the scan
    metadata; the ingestion time is a parameter (defaults to the file's
    modification time, which is stable across reruns)."""
    ts = (
        F.lit(ingestion_ts).cast("timestamp")
        if ingestion_ts
        else F.col("_metadata.file_modification_time")
    )
    return df.select(
        *[F.col(c) for c in df.columns],
        F.lit(source_system).alias("source_system"),
        F.lit(source_format).alias("source_format"),
        ts.alias("ingestion_timestamp"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def read_pos_csv(spark: SparkSession, path: str, ingestion_ts: str | None = None) -> DataFrame:
    """POS exports: headered CSV, every field text. Malformed lines are kept
    (PERMISSIVE) with their raw text in ``_corrupt_record``, so nothing is
    dropped at landing; the quality score decides later. Quotes inside quoted
    fields are doubled, as in standard CSV. A quoted line break does not join
    lines: that would make each file one task; such a sale's lines do not fit
    the header and keep their text."""
    schema = T.StructType(POS_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("nullValue", "\\N")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return with_audit(raw, *FEEDS["pos"], ingestion_ts)


def read_ecommerce_json(
    spark: SparkSession, path: str, ingestion_ts: str | None = None
) -> DataFrame:
    """E-commerce orders: JSON lines with the nested order schema; a broken
    line keeps its text in ``_corrupt_record``."""
    schema = T.StructType(ECOMMERCE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )
    return with_audit(raw, *FEEDS["ecommerce"], ingestion_ts)


def read_mobile_parquet(
    spark: SparkSession, path: str, ingestion_ts: str | None = None
) -> DataFrame:
    """Mobile backend logs: Parquet with the typed mobile schema."""
    raw = spark.read.schema(MOBILE_SCHEMA).parquet(path)
    return with_audit(raw, *FEEDS["mobile"], ingestion_ts)


def rejects(bronze: dict[str, DataFrame]) -> DataFrame:
    """Lines that did not fit their feed, in the stored bronze tables: source,
    file and raw text."""
    out = None
    for name in ("pos", "ecommerce"):
        part = bronze[name].filter(F.col(CORRUPT_COLUMN).isNotNull()).select(
            F.lit(name).alias("feed"), "file_name", F.col(CORRUPT_COLUMN).alias("raw_text")
        )
        out = part if out is None else out.unionByName(part)
    return out


def write_landing_files(feeds: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write fixture feeds as landing files in each feed's native format
    (audit columns dropped: the readers add them back). JSON, several times as
    large as the tables, is compressed; a file is a task's share."""
    audit = ["source_system", "source_format", "ingestion_timestamp", "file_name"]
    paths = {}
    for name, df in feeds.items():
        raw = df.drop(*audit)
        path = f"{root}/{name}"
        fmt = FEEDS[name][1]
        writer = raw.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", "true").option("nullValue", "\\N").option("escape", '"').csv(path)
        elif fmt == "json":
            writer.option("compression", "gzip").json(path)
        else:
            writer.parquet(path)
        paths[name] = path
    return paths


# --------------------------------------------------------------------------
# bronze layer over the driver tables
# --------------------------------------------------------------------------

# Landed copies are keyed by the fixture code itself: any change to the
# derivation lands a fresh copy instead of reusing a stale one.
FIXTURE_VERSION = hashlib.sha1(inspect.getsource(fixtures).encode()).hexdigest()[:10]


def _exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system of the path (any scheme)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def bronze_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the landed copy, named by the tables' path, sizes and times:
    a copy of tables that have changed is not used again."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    state = [sf_dir.rstrip("/")]
    for name in ("orders", "lineitem", "events"):
        hpath = jvm.org.apache.hadoop.fs.Path(f"{state[0]}/{name}.parquet")
        fs = hpath.getFileSystem(conf)
        state += [fs.getContentSummary(hpath).getLength(), fs.getFileStatus(hpath).getModificationTime()]
    tag = hashlib.sha1(repr(state).encode()).hexdigest()[:12]
    return workspace_dir(spark, "bronze", f"{tag}-v{FIXTURE_VERSION}")


FEED_NAMES = ("pos", "ecommerce", "mobile")


def land_bronze(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = FEED_NAMES) -> dict[str, DataFrame]:
    """The bronze layer: the fixture feeds, written once to the workspace as
    Parquet and read back.

    Landing first is the medallion contract (bronze is a stored copy of what
    arrived) and also gives every downstream plan a plain scan as its leaf;
    the derivation itself runs once per input folder, not once per query.
    A folder is reused only if its write committed (``_SUCCESS`` present).
    ``names``: the feeds wanted; others are not landed.
    """
    from tributary.plans.concurrent import run_all

    root = bronze_root(spark, sf_dir)
    missing = [n for n in names if not _exists(spark, f"{root}/{n}/_SUCCESS")]
    if missing:
        feeds = fixtures.bronze_feeds(spark, sf_dir)
        # The three feeds share no data: land them as concurrent jobs.
        run_all(
            {n: (lambda n=n: feeds[n].write.mode("overwrite").parquet(f"{root}/{n}")) for n in missing}
        )
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def land_files(
    spark: SparkSession,
    landing_paths: dict[str, str],
    bronze_base: str,
    ingestion_ts: str | None = None,
    batch: str = "base",
) -> dict[str, DataFrame]:
    """Bronze from landing files: each feed read with its typed reader (audit
    columns added) and stored as the batch's partition of a Parquet bronze
    table, which a retry replaces; the three feeds are landed as concurrent
    jobs. Returns the batch's rows."""
    from tributary.plans.concurrent import run_all
    from tributary.sources.semistructured import read_ecommerce

    readers = {"pos": read_pos_csv, "ecommerce": read_ecommerce, "mobile": read_mobile_parquet}
    frames = {n: readers[n](spark, p, ingestion_ts) for n, p in landing_paths.items()}
    run_all(
        {n: (lambda n=n: frames[n].write.mode("overwrite").parquet(f"{bronze_base}/{n}/batch={batch}")) for n in frames}
    )
    return {n: spark.read.parquet(f"{bronze_base}/{n}/batch={batch}") for n in frames}
