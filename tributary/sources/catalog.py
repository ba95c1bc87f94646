"""Layer tables: write, register, inventory.

Layers are catalog namespaces (``bronze``, ``silver``, ``gold``) whose tables
are external file tables under one base path. Writes replace the table's
files and schema (``overwrite``); registration drops and re-creates the
catalog entry at the same location, as the original did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.plans.sizing import input_bytes
from tributary.session import workspace_dir

LAYERS = ("bronze", "silver", "gold")


def delta_available(spark: SparkSession) -> bool:
    """True when a Delta Lake data source is on the classpath."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return True
    except Exception:  # noqa: BLE001 - any failure means "not available"
        return False


def table_format(spark: SparkSession, requested: str | None = None) -> str:
    """The requested format, ``parquet`` by default."""
    if requested == "delta" and not delta_available(spark):
        raise ValueError("format delta was asked for, but its data source is not on the classpath")
    return requested or "parquet"


def create_layers(spark: SparkSession, base: str) -> None:
    """CREATE DATABASE for each layer, located under ``base``."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{base}/{layer}.db'")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> None:
    """Overwrite the files (and schema) at ``path``."""
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def register_table(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", partitioned: bool = False
) -> DataFrame:
    """Drop and re-create ``name`` as an external table at ``path``.
    A missing layer database is created in the shared workspace."""
    if "." in name:
        db = name.split(".", 1)[0]
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{workspace_dir(spark, 'warehouse', db + '.db')}'"
        )
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    if partitioned and fmt != "delta":
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def bucketed_table(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` as an external table bucketed and sorted by ``keys`` (S9):
    joins and groupings by them read it without an exchange. One task writes one
    bucket, so there are as many files."""
    spark = df.sparkSession
    if "." in name:
        db = name.split(".", 1)[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{workspace_dir(spark, 'warehouse', db + '.db')}'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def register_view(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")
    return spark.table(name)


def file_inventory(df: DataFrame) -> DataFrame:
    """Files and bytes behind a file-backed frame (S12), from its file list and
    a listing of those files: no row is read."""
    files = df.inputFiles()
    spark = df.sparkSession
    if files:
        listed = spark.read.format("binaryFile").load(files).select("path", "length")
    else:
        listed = spark.createDataFrame([], "path string, length long")
    return listed.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("length").alias("total_bytes"),
        F.min("length").alias("min_file_bytes"),
        F.max("length").alias("max_file_bytes"),
    )


def data_file_stats(spark: SparkSession, path: str) -> tuple[int, int]:
    """(data file count, total bytes) under ``path``, from the file list of a
    scan: Spark lists large folders in parallel and leaves out marker and
    hidden files; the sizes come from one content summary. No data is read."""
    files = len(spark.read.parquet(path).inputFiles())
    return files, input_bytes(spark, [path])


# --------------------------------------------------------------------------
# file lists and footers
# --------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _fs(spark, path)
    return bool(fs.exists(hpath))


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders below ``path`` that begin with ``prefix``."""
    hpath, fs = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory() and s.getPath().getName().startswith(prefix)]


def listing(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(data files, their bytes, latest change in epoch milliseconds) of one
    folder; marker and hidden files do not count."""
    hpath, fs = _fs(spark, path)
    shown = [s for s in fs.listStatus(hpath) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return len(shown), sum(s.getLen() for s in shown), max((s.getModificationTime() for s in shown), default=0)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose Parquet scans answer COUNT, MIN and
    MAX from the files' footers: no row group is read. Settings of the caller's
    session stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    v1 = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in v1 if s != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def counted(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(name, row_count) of Parquet tables, from their footers."""
    own = footer_session(spark)
    out = None
    for name, path in paths.items():
        part = own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
        part = part.select(F.lit(name).alias("name"), "row_count")
        out = part if out is None else out.unionAll(part)
    return out


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    return {r["name"]: r["row_count"] for r in counted(spark, paths).collect()} if paths else {}


def remove_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    """Remove whole partitions of a table, those that are about to be replaced
    and those that lost all their rows."""
    for value in values:
        remove(spark, f"{path}/{column}={value}")


def replace_partitions(spark: SparkSession, path: str, column: str, values: list[str], ready: str) -> None:
    """Put the partitions of a table that lie written at ``ready`` in the place
    of the old ones, without copying a row; of ``values``, those that are not
    there have lost all their rows and go."""
    hpath, fs = _fs(spark, path)
    fs.mkdirs(hpath)
    written = set(folders(spark, ready, f"{column}="))
    for name in sorted(written | {f"{column}={v}" for v in values}):
        remove(spark, f"{path}/{name}")
        if name in written and not fs.rename(_fs(spark, f"{ready}/{name}")[0], _fs(spark, f"{path}/{name}")[0]):
            raise OSError(f"{ready}/{name} could not be moved to {path}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that the lake has written, if it is there."""
    hpath, fs = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)
