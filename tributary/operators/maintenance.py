"""Table maintenance as user-level Spark jobs (M1-M5).

Without a table format on the classpath, versioning is done with plain files:

* a **snapshot table** is a partitioned table: each published version is one
  ``snapshot_version=<v>/operation=<op>`` folder. Reading a version reads its
  folder, with the columns that this version has; the history is a GROUP BY of
  the partition columns. One writer at a time publishes.
* **compaction** rewrites the latest version into files of a target size as a
  new version: the scan packs small files up to that size, and each scan task
  writes one file, so no row is shuffled and their order stays.
* **clustering** orders rows by an interleaved-bits (Z-order) key over the
  chosen columns so Parquet row-group min/max statistics stay tight for
  filters on any of them. Column values are mapped to buckets by approximate
  quantiles (a bounded list per column), never by a global sort or rank; the
  number of files follows from the bytes.
* **schema evolution** appends batches with new columns or wider types, each in
  a folder of its own; a read casts each to the columns of all.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.sources.catalog import data_file_stats, exists, file_inventory, folders, footer_counts, listing

VERSION_COL = "snapshot_version"
OPERATION_COL = "operation"
TARGET_FILE_BYTES = 128 * 1024 * 1024


# --------------------------------------------------------------------------
# snapshots (M1, M2)
# --------------------------------------------------------------------------

class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def version_path(self, version: int) -> str:
        return f"{self.path}/{VERSION_COL}={version}"

    def _written(self) -> list[tuple[int, str, str, bool]]:
        """(version, operation, folder, committed) of every write that was
        begun, from the folder names; a write that was cut off has no marker."""
        found = []
        for version in folders(self.spark, self.path, f"{VERSION_COL}="):
            for operation in folders(self.spark, f"{self.path}/{version}", f"{OPERATION_COL}="):
                folder = f"{self.path}/{version}/{operation}"
                number, name = version.split("=", 1)[1], operation.split("=", 1)[1]
                found.append((int(number), name, folder, exists(self.spark, f"{folder}/_SUCCESS")))
        return sorted(found)

    def published(self) -> dict[int, tuple[str, str]]:
        """Version to (operation, folder), of the writes that committed."""
        return {v: (operation, folder) for v, operation, folder, done in self._written() if done}

    def versions(self) -> list[int]:
        return sorted(self.published())

    def history(self, limit: int | None = None) -> DataFrame:
        """Versions, newest first (M1): operation, rows, time and files. The
        rows are counted from the files' footers, the rest is the file list."""
        known = sorted(self.published().items(), reverse=True)[:limit]
        counted = footer_counts(self.spark, {str(v): folder for v, (_, folder) in known})
        rows = []
        for version, (operation, folder) in known:
            files, _, latest = listing(self.spark, folder)
            rows.append((version, operation, counted[str(version)], latest / 1000.0, files))
        schema = "version long, operation string, num_rows long, seconds double, num_files long"
        h = self.spark.createDataFrame(rows, schema)
        time = F.timestamp_millis((F.col("seconds") * 1000).cast("long")).alias("timestamp")
        return h.select("version", OPERATION_COL, "num_rows", time, "num_files").orderBy(F.col("version").desc())

    def publish(self, df: DataFrame, operation: str = "WRITE") -> int:
        """Write ``df`` as the next version; the number of a write that was cut
        off is not given again."""
        version = max((v for v, *_ in self._written()), default=-1) + 1
        df.write.mode("overwrite").parquet(f"{self.version_path(version)}/{OPERATION_COL}={operation}")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of ``version`` (default: the latest), with its own columns
        (M2: time travel)."""
        known = self.published()
        if version is None:
            version = max(known, default=None)
        if version not in known:
            raise ValueError(f"no version {'' if version is None else version} at {self.path}")
        return self.spark.read.parquet(known[version][1])

    def diff(self, old: int, new: int) -> DataFrame:
        """Rows added in ``new`` and removed from ``old`` (multiset): one
        signed count per distinct row. A column that one version lacks is NULL
        there."""
        a, b = self.read(old), self.read(new)
        both = b.withColumn("_n", F.lit(1)).unionByName(a.withColumn("_n", F.lit(-1)), allowMissingColumns=True)
        cols = [c for c in both.columns if c != "_n"]
        changed = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
        times = F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_i")
        change = F.when(F.col("_n") > 0, "added").otherwise("removed").alias("change")
        return changed.select(*cols, change, times).drop("_i")


# --------------------------------------------------------------------------
# compaction (M3)
# --------------------------------------------------------------------------

def compact(table: SnapshotTable, target_file_bytes: int = TARGET_FILE_BYTES) -> dict:
    """Rewrite the latest version into ~target-sized files as a new version
    (OPTIMIZE): scan tasks pack files up to the target and write one each."""
    spark = table.spark
    latest = max(table.versions())
    files_before, _ = data_file_stats(spark, table.published()[latest][1])
    packing = {
        "spark.sql.files.maxPartitionBytes": str(target_file_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {k: spark.conf.get(k, None) for k in packing}
    for k, v in packing.items():
        spark.conf.set(k, v)
    try:
        version = table.publish(table.read(latest), "OPTIMIZE")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files_after, _ = data_file_stats(spark, table.published()[version][1])
    return {"version": version, "files_before": files_before, "files_after": files_after}


def crowded_partitions(
    spark: SparkSession, path: str, column: str, target_file_bytes: int = TARGET_FILE_BYTES
) -> dict[str, tuple[int, int]]:
    """Partitions that have more files than their bytes need: value to (files
    needed, files now). Only folders are listed."""
    found = {}
    for name in folders(spark, path, f"{column}="):
        now, size, _ = listing(spark, f"{path}/{name}")
        needed = max(1, math.ceil(size / target_file_bytes))
        if now > needed:
            found[name.split("=", 1)[1]] = (needed, now)
    return found


def compact_partitions(
    spark: SparkSession, path: str, column: str, work: str, target_file_bytes: int = TARGET_FILE_BYTES
) -> dict[str, tuple[int, int]]:
    """Rewrite the crowded partitions of a partitioned table, and only those
    (M3): their rows are dealt to as many files as their bytes need, written to
    ``work`` and then swapped in, partition by partition. Files of partitions
    that are packed already are neither read nor written."""
    crowded = crowded_partitions(spark, path, column, target_file_bytes)
    if not crowded:
        return crowded
    table = spark.read.parquet(path).withColumn(column, F.col(column).cast("string"))
    rows = table.filter(F.col(column).isin(list(crowded)))
    # A row per crowded partition, which the folder listing bounds.
    needs = spark.createDataFrame([(k, n) for k, (n, _) in crowded.items()], f"{column} string, _files int")
    place = F.pmod(F.xxhash64(*[c for c in table.columns if c != column]), F.col("_files")).cast("int")
    dealt = rows.join(F.broadcast(needs), column).withColumn("_place", place).drop("_files")
    n = sum(needed for needed, _ in crowded.values())
    dealt = dealt.repartition(n, column, "_place").drop("_place")
    dealt.write.mode("overwrite").partitionBy(column).parquet(work)
    ready = spark.read.schema(table.schema).parquet(work)
    packing = {"spark.sql.files.maxPartitionBytes": str(2 * target_file_bytes), "spark.sql.files.openCostInBytes": str(2 * target_file_bytes)}
    before = {k: spark.conf.get(k, None) for k in packing}
    for k, v in packing.items():  # a file of ``work`` is a task, and a file again
        spark.conf.set(k, v)
    try:
        ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return crowded


# --------------------------------------------------------------------------
# clustering (M4)
# --------------------------------------------------------------------------

def _ordinal(c: Column, dtype: T.DataType) -> Column:
    """An order-preserving DOUBLE view of a column (NULL sorts first)."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        v = F.unix_micros(c.cast("timestamp")).cast("double")
    elif isinstance(dtype, T.DateType):
        v = F.unix_date(c).cast("double")
    else:
        v = c.cast("double")
    return F.coalesce(v, F.lit(-1.0e300))


# Strings are compared with so many sampled quantiles, of as many characters;
# the sample has about so many rows. All only decide how well files are laid out.
STRING_BUCKETS = 64
STRING_CHARS = 256
STRING_SAMPLE = 100_000


def _string_rank(df: DataFrame, name: str) -> Column:
    """Number of sampled quantiles below a string. The sample is sorted on an
    executor, whose memory its rows and their length bound; only the quantiles
    come to the driver."""
    n = df.count()
    some = df.select(F.substring(name, 1, STRING_CHARS).alias("s")).filter("s IS NOT NULL")
    if n > STRING_SAMPLE:
        some = some.sample(STRING_SAMPLE / n, seed=1)
    found = some.agg(F.sort_array(F.collect_list("s")).alias("s"))
    at = F.transform(
        F.sequence(F.lit(1), F.lit(STRING_BUCKETS - 1)), lambda i: F.get("s", F.floor(i * F.size("s") / STRING_BUCKETS).cast("int"))
    )
    cuts = [c for c in found.select(F.array_distinct(at)).first()[0] if c is not None]
    if not cuts:
        return F.lit(0.0)
    rank = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda b: b <= F.col(name)))
    return F.coalesce(rank, F.lit(-1)).cast("double")


def with_zorder(
    df: DataFrame, columns: list[str], buckets: int = 1024, accuracy: int = 10000, out: str = "_z"
) -> DataFrame:
    """Append an interleaved-bits (Z-order) key over ``columns``.

    Each column is mapped to a bucket by its approximate quantiles (one
    ``percentile_approx`` aggregate; ``buckets - 1`` boundaries per column
    come back to the driver, a bounded list). ``Bucketizer`` finds a row's
    bucket by binary search in the JVM; the bucket numbers' bits are then
    interleaved with shifts and masks.
    """
    from pyspark.ml.feature import Bucketizer

    bits = max(1, (buckets - 1).bit_length())
    tmp = df
    for j, c in enumerate(columns):
        kind = df.schema[c].dataType
        ordinal = _string_rank(df, c) if isinstance(kind, T.StringType) else _ordinal(F.col(c), kind)
        tmp = tmp.withColumn(f"_o{j}", ordinal)
    probs = [i / buckets for i in range(1, buckets)]
    bounds = tmp.agg(
        *[F.percentile_approx(f"_o{j}", probs, accuracy).alias(f"_o{j}") for j in range(len(columns))]
    ).first()
    for j in range(len(columns)):
        inner = sorted(set(x for x in (bounds[j] or []) if x is not None and math.isfinite(x)))
        splits = [-math.inf] + (inner or [0.0]) + [math.inf]
        tmp = Bucketizer(splits=splits, inputCol=f"_o{j}", outputCol=f"_b{j}").transform(tmp)
    key = F.lit(0).cast("long")
    for j in range(len(columns)):
        b = F.col(f"_b{j}").cast("long")
        for i in range(bits):
            bit = F.shiftright(b, i).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    helper = [f"_o{j}" for j in range(len(columns))] + [f"_b{j}" for j in range(len(columns))]
    return tmp.withColumn(out, key).drop(*helper)


def cluster(
    df: DataFrame,
    columns: list[str],
    num_files: int | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Range-partition and sort by the Z-order key (OPTIMIZE ZORDER BY) a
    stored table; without ``num_files`` their number follows from its bytes.

    The range partitioning also orders by a row hash after the key, so rows
    sharing one hot key value are split across several files instead of one.
    """
    n = num_files or max(1, math.ceil((file_inventory(df).first()["total_bytes"] or 0) / target_file_bytes))
    cols = df.columns
    return (
        with_zorder(df, columns)
        .withColumn("_spread", F.xxhash64(*cols))
        .repartitionByRange(n, "_z", "_spread")
        .sortWithinPartitions("_z")
        .drop("_z", "_spread")
    )


# A row group, which is what a lookup reads or leaves out, and the ids that a
# filter of 1 MB holds at one false hit in a hundred.
LOOKUP_GROUP_BYTES = 32 * 1024 * 1024
# Spark hands so many values of one IN to Parquet; longer ones only as a range.
IN_VALUES = 10


def write_with_filters(df: DataFrame, path: str, columns: list[str], row_group_bytes: int = LOOKUP_GROUP_BYTES) -> None:
    """Write a table whose row groups carry a Bloom filter of each of
    ``columns``, as small as their distinct values allow: rows of one value are
    found without reading the other groups, in whatever order the table is."""
    writer = df.write.option("parquet.block.size", str(row_group_bytes)).option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def lookup(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of a stored table that hold one of ``values`` in ``column``, asked
    for in such lists that each value is tested against the filters."""
    wanted = sorted(set(values))
    parts = [F.col(column).isin(wanted[i : i + IN_VALUES]) for i in range(0, len(wanted), IN_VALUES)]
    return df.filter(reduce(lambda a, b: a | b, parts) if parts else F.lit(False))


# --------------------------------------------------------------------------
# schema evolution (M5)
# --------------------------------------------------------------------------

# What a type may widen to.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp", "timestamp_ntz"),
}
APPEND = "append="


class NarrowingError(ValueError):
    """A batch's column has a type that the stored one does not widen to."""


def widened(old: T.DataType, new: T.DataType, where: str) -> T.DataType:
    """The type of a column after a batch: the stored one, or one that widens
    it without loss, member by member."""
    if old == new:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged(old, new, f"{where}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType, f"{where}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, widened(old.valueType, new.valueType, f"{where}[]"))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        if new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale:
            return new
    elif isinstance(old, T.NullType) or new.simpleString() in WIDER.get(old.simpleString(), ()):
        return new
    raise NarrowingError(f"column {where} is {old.simpleString()}; a batch brings {new.simpleString()}, which is not wider: cast it")


def merged(old: T.StructType, new: T.StructType, where: str = "") -> T.StructType:
    """The columns of both, those of ``old`` first."""
    own = {f.name: f.dataType for f in new.fields}
    kept = [T.StructField(f.name, widened(f.dataType, own.get(f.name, f.dataType), where + f.name)) for f in old.fields]
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in old.names])


def _appended(spark: SparkSession, path: str) -> list[tuple[str, T.StructType]]:
    """The committed batches, oldest first, and their columns: one footer each."""
    known = [f"{path}/{b}" for b in sorted(folders(spark, path, APPEND), key=lambda b: int(b.split("=")[1]))]
    return [(b, spark.read.parquet(b).schema) for b in known if exists(spark, f"{b}/_SUCCESS")]


def _columns(batches: list[tuple[str, T.StructType]]) -> T.StructType:
    return reduce(merged, [schema for _, schema in batches], T.StructType([]))


def append_evolving(df: DataFrame, path: str) -> None:
    """Append a batch whose schema may add columns and widen types; one that
    narrows a type is refused before anything is written."""
    merged(_columns(_appended(df.sparkSession, path)), df.schema)
    number = max((int(b.split("=")[1]) for b in folders(df.sparkSession, path, APPEND)), default=-1) + 1
    df.write.parquet(f"{path}/{APPEND}{number}")


def _fit(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A stored value in the merged type; members that it lacks are NULL."""
    if old == new:
        return value
    if isinstance(new, T.StructType):
        return F.when(
            value.isNotNull(),
            F.struct(
                *[
                    (_fit(value[f.name], old[f.name].dataType, f.dataType) if f.name in old.names else F.lit(None).cast(f.dataType)).alias(f.name)
                    for f in new.fields
                ]
            ),
        )
    if isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: _fit(x, old.elementType, new.elementType))
    if isinstance(new, T.MapType):
        return F.transform_values(value, lambda _, x: _fit(x, old.valueType, new.valueType))
    return value.cast(new)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read every batch in the columns of all: those that older batches lack are
    NULL, narrower types are cast. Batches with the same schema are one scan."""
    batches = _appended(spark, path)
    if not batches:
        raise ValueError(f"no batch at {path}")
    whole = _columns(batches)
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for folder, schema in batches:
        alike.setdefault(schema.json(), (schema, []))[1].append(folder)
    parts = []
    for schema, paths in alike.values():
        rows = spark.read.schema(schema).parquet(*paths)
        parts.append(
            rows.select(
                *[
                    (_fit(F.col(f.name), schema[f.name].dataType, f.dataType) if f.name in schema.names else F.lit(None).cast(f.dataType)).alias(f.name)
                    for f in whole.fields
                ]
            )
        )
    return reduce(DataFrame.unionAll, parts)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union of frames with different columns (missing ones are NULL)."""
    return old.unionByName(new, allowMissingColumns=True)
