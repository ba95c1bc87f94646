"""Duplicate detection.

Cross-channel duplicates share customer, product and calendar day and come
from two channels or more: one row survives, that of the highest-priority
channel (e-commerce, then mobile, then point of sale), then the earliest time,
the smallest id, and further columns; rows equal in all of them are told apart
by their place in the input, so exactly one survives. Within one channel a
customer may buy a product twice in a day: such rows are no duplicates, unless
they carry the same transaction id (a record sent again), of which one
survives. Rows with a NULL key part are never duplicates. Rows are flagged,
never dropped.

Plan shape. A window over the duplicate key would send every row of a key to
one task; one hot key (a bulk customer, a default product) would then stall
the whole job. Instead:

1. one aggregate of counts per 64-bit hash of the key: longs only, so a hash
   aggregate that combines a hot key map-side and shuffles 16 bytes a key.
   Hashes seen twice are the suspects, few more than the keys seen twice;
2. only the suspects' rows are looked at exactly: count, least and greatest
   priority per key, then the least ordering tuple per cross-channel key, and
   per repeated id of the others;
3. rows are left-joined to these survivors, which are far fewer than rows.

In the production run each step is written and measured: under a fixed bound
suspects and survivors are broadcast and rows are not shuffled. Beyond it a
bitmap of the suspects' hash positions, whose size is fixed, filters the rows
first, so that only candidates are exchanged; hot keys are split by adaptive
execution. Rows with a NULL key part pass by the joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Channel priority (lower wins) and resolution labels.
SOURCE_PRIORITY = {"ecommerce": 1, "mobile": 2, "pos": 3}
NO_DUPLICATE = "no_duplicate"
KEPT = "kept_by_priority"
SUPERSEDED = "superseded"

KEY = ["customer_id", "product_id", "_dedup_day"]


def _priority():
    out = None
    for source, rank in SOURCE_PRIORITY.items():
        cond = F.col("source_system") == source
        out = F.when(cond, F.lit(rank)) if out is None else out.when(cond, F.lit(rank))
    return out.otherwise(F.lit(len(SOURCE_PRIORITY) + 1))


# Columns that order the rows of a group after the priority.
ORDER = [
    "transaction_date",
    "transaction_id",
    "source_file",
    "quantity",
    "unit_price",
    "total_amount",
    "status",
    "store_id",
    "payment_method",
]


def mark_stub(df: DataFrame) -> DataFrame:
    """The original behaviour: every row is a non-duplicate."""
    return df.withColumn("is_duplicate", F.lit(False)).withColumn(
        "duplicate_resolution", F.lit(NO_DUPLICATE)
    )


def _place(df: DataFrame) -> Column:
    """A row's place: file and row number, or for a frame that is no file scan
    its partition and row number."""
    place = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    try:
        df.select(place)
    except AnalysisException:
        place = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row"))
    return place


def _keyed(silver: DataFrame) -> DataFrame:
    known = [c for c in ORDER if c in silver.columns]
    order = F.struct(_priority().alias("priority"), *known, F.col("_place").alias("place"))
    return (
        silver.withColumn("_place", _place(silver))
        .withColumn("_dedup_day", F.to_date("transaction_date"))
        .withColumn("_order", order)
    )


def _has_key() -> Column:
    return F.col("customer_id").isNotNull() & F.col("product_id").isNotNull() & F.col("_dedup_day").isNotNull()


HASH = "_hash"
# Positions of the filter bitmap: 16 MB, whatever the number of suspects.
FILTER_BITS = 1 << 27


def _hashed(silver: DataFrame) -> DataFrame:
    """Rows with a whole key, and its hash."""
    rows = silver.withColumn("_dedup_day", F.to_date("transaction_date")).filter(_has_key())
    return rows.withColumn(HASH, F.xxhash64(*KEY))


def suspects(silver: DataFrame) -> DataFrame:
    """Hashes of the keys that two rows or more have, and of few others."""
    return _hashed(silver).groupBy(HASH).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(HASH)


def key_filter(found: DataFrame) -> DataFrame:
    """The suspects' positions as bitmaps of 4 KB each (bucket, bits): 4,096
    rows at most, so it may be broadcast."""
    at = F.pmod(HASH, F.lit(FILTER_BITS)) + 1
    return found.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")
    )


MARK = "_marked"


def marked(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Rows with a hash, and whether its position is set in a ``key_filter``:
    always for hashes that are in it, seldom for others. Rows are not shuffled."""
    at = F.pmod(HASH, F.lit(FILTER_BITS)) + 1
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    placed = rows.withColumn("_bucket", F.bitmap_bucket_number(at)).withColumn("_bit", F.bitmap_bit_position(at))
    return placed.join(F.broadcast(bitmaps), "_bucket", "left").select(*rows.columns, found.alias(MARK))


def key_hash() -> Column:
    """The hash of a row's duplicate key, NULL if a part of it is."""
    whole = F.col("customer_id").isNotNull() & F.col("product_id").isNotNull() & F.col("transaction_date").isNotNull()
    return F.when(whole, F.xxhash64("customer_id", "product_id", F.to_date("transaction_date"))).alias(HASH)


def candidates(silver: DataFrame, found: DataFrame, few: bool | None = None) -> DataFrame:
    """The suspects' rows, with what orders them. ``few``: their measured number
    allows a broadcast, or does not, then the filter goes first; None: not
    measured, a plain join."""
    known = [c for c in ORDER if c in silver.columns]
    rows = _hashed(silver.withColumn("_place", _place(silver)))
    order = F.struct(_priority().alias("priority"), *known, F.col("_place").alias("place"))
    rows = rows.select(HASH, *KEY, F.col("transaction_id").alias("_id"), _priority().alias("_priority"), order.alias("_order"))
    if few is not False:
        return rows.join(F.broadcast(found) if few else found, HASH, "left_semi")
    passed = marked(rows, key_filter(found)).filter(MARK)
    # Hashes are distinct; as an inner join it stays behind the filter.
    return passed.select(*rows.columns).join(found, HASH)


def survivors(rows: DataFrame) -> DataFrame:
    """Survivors among candidate rows: key, ``_id`` (NULL for a cross-channel
    key, else the id that one channel sent again) and the best ordering tuple
    ``_best``."""
    several = (
        rows.groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_priority").alias("_least"), F.max("_priority").alias("_most"))
        .filter(F.col("_n") > 1)
        .select(*KEY, (F.col("_least") < F.col("_most")).alias("_cross"))
    )
    of = rows.select(*KEY, "_id", "_order").join(several, KEY).filter(F.col("_cross") | F.col("_id").isNotNull())
    grouped = of.withColumn("_id", F.when(~F.col("_cross"), F.col("_id"))).groupBy(*KEY, "_id").agg(
        F.min("_order").alias("_best"), F.count(F.lit(1)).alias("_n")
    )
    return grouped.filter(F.col("_n") > 1).select(*KEY, "_id", "_best")


def duplicate_keys(silver: DataFrame) -> DataFrame:
    """Survivors of all duplicate groups, as one plan. The keys are computed
    anew, so that a join with them exchanges both sides: only then does adaptive
    execution split a hot key."""
    found = survivors(candidates(silver, suspects(silver)))
    anew = [F.concat(c, F.lit("")).alias(c) if c != "_dedup_day" else F.col(c) for c in KEY]
    return found.select(*anew, "_id", "_best")


def flag_duplicates(
    silver: DataFrame,
    with_winner: bool = False,
    dup_keys: DataFrame | None = None,
    broadcast_keys: bool = False,
) -> DataFrame:
    """Flag duplicates (U2); returns the input columns plus ``is_duplicate``
    and ``duplicate_resolution`` (and ``winner_source`` if asked).

    ``silver`` is best a file scan: it is read more than once. ``dup_keys`` may
    be a materialised ``duplicate_keys`` table; pass ``broadcast_keys=True``
    only when its size has been measured and bounded (``pipeline.run`` does),
    so the rows are joined without being shuffled.
    """
    cols = silver.columns
    keys = (dup_keys if dup_keys is not None else duplicate_keys(silver)).select(
        *[F.col(c).alias(f"_of_{c}") for c in KEY], F.col("_id").alias("_of_id"), "_best"
    )
    if broadcast_keys:
        keys = F.broadcast(keys)
    rows = _keyed(silver)
    same = [F.col(c) == F.col(f"_of_{c}") for c in KEY]
    one = F.col("_of_id").isNull() | (F.col("_of_id") == F.col("transaction_id"))
    joined = rows.filter(_has_key()).join(keys, reduce(Column.__and__, [*same, one]), "left")
    best = F.col("_best")
    resolution = (
        F.when(best.isNull(), F.lit(NO_DUPLICATE))
        .when(F.col("_order") == best, F.lit(KEPT))
        .otherwise(F.lit(SUPERSEDED))
    )
    flagged = joined.select(
        *cols, resolution.alias("duplicate_resolution"), best["priority"].alias("_winner")
    )
    keyless = rows.filter(~_has_key()).select(
        *cols, F.lit(NO_DUPLICATE).alias("duplicate_resolution"), F.lit(None).cast("int").alias("_winner")
    )
    out = flagged.unionByName(keyless).withColumn(
        "is_duplicate", F.col("duplicate_resolution") == SUPERSEDED
    )
    extra = ["is_duplicate", "duplicate_resolution"]
    if with_winner:
        winner = None
        for source, rank in SOURCE_PRIORITY.items():
            winner = (F.when if winner is None else winner.when)(F.col("_winner") == rank, F.lit(source))
        out = out.withColumn("winner_source", F.when(F.col("is_duplicate"), winner))
        extra.append("winner_source")
    return out.select(*cols, *extra)


def several_channels(rows: DataFrame, key: list[str]) -> DataFrame:
    """Whole keys that two channels or more sold, with rows and channels; on a
    table in buckets of the key a local grouping."""
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    return (
        rows.filter(whole)
        .withColumn("_priority", _priority())
        .groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("_priority").alias("best_priority"),
            F.max("_priority").alias("worst_priority"),
        )
        .filter(F.col("best_priority") < F.col("worst_priority"))
    )


def key_table_bytes() -> list:
    """``observe`` metrics bounding the decoded size of a duplicate-key table:
    its row count and the total length of its strings."""
    return [
        F.count(F.lit(1)).alias("key_rows"),
        F.sum(
            F.length("customer_id")
            + F.length("product_id")
            + F.coalesce(F.length("_best.transaction_id"), F.lit(0))
            + F.coalesce(F.length("_best.source_file"), F.lit(0))
        ).alias("key_chars"),
    ]


def summary(flagged: DataFrame) -> DataFrame:
    """Rows per source, resolution and winning channel, with the share of the
    source's rows (U4). Expects ``flag_duplicates(..., with_winner=True)``."""
    counts = flagged.groupBy("source_system", "duplicate_resolution", "winner_source").agg(
        F.count(F.lit(1)).alias("records")
    )
    # The count table has a handful of rows per source: a window over it is free.
    source_total = F.sum("records").over(Window.partitionBy("source_system"))
    return counts.select(
        "source_system",
        "duplicate_resolution",
        "winner_source",
        "records",
        (F.col("records") * F.lit(100.0) / source_total).alias("pct_of_source"),
    )


def content_duplicates(df: DataFrame, id_col: str, ignore: list[str] | None = None) -> DataFrame:
    """Same-content copies under different ids (U3): the rows whose content
    occurs more than once.

    Groups rows by every column except the id (and ``ignore``); NULLs group
    together, rows without an id are corrupt and no copies. Adds ``copies``
    (group size) and ``canonical_id`` (smallest id of the group). Like
    ``flag_duplicates``: hashes of the content are counted first, 8 bytes a
    row; only rows whose hash occurs again are grouped and joined by their
    content itself, so equal hashes of different rows do no harm.
    """
    skip = {id_col, *(ignore or [])}
    content = [c for c in df.columns if c not in skip]
    # NULLs leave a hash as it is, so where they are is hashed, too.
    digest = F.xxhash64(*content, *[F.col(c).isNull() for c in content])
    every = df.filter(F.col(id_col).isNotNull()).withColumn("_h", digest)
    again = every.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h")
    known = every.join(again, "_h", "left_semi")
    groups = (
        known.groupBy("_h", *content)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(id_col).alias("canonical_id"))
        .filter(F.col("copies") > 1)
    )
    g = groups.alias("_g")
    d = known.alias("_d")
    same = [F.col(f"_d.{c}").eqNullSafe(F.col(f"_g.{c}")) for c in content]
    cond = [F.col("_d._h") == F.col("_g._h"), *same]
    return d.join(g, cond, "inner").select(
        *[F.col(f"_d.{c}") for c in df.columns], F.col("_g.copies"), F.col("_g.canonical_id")
    )
