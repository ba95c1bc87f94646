"""Line deduplication by site-relative frequency, in DataFrame functions only.

Pages are reduced to lines of visible text. For each host, the number of its
pages that hold a line is divided by the number of its pages; lines above the
boilerplate ratio are dropped from that host's pages.

Defined results: a null page has no lines; a null url belongs to host ''; a
line counts once per page; blank lines are neither counted nor kept; a line of
a single page stays; hosts of fewer than ``min_pages`` pages keep all lines; rows that repeat a page_id are
pages of their own; extra columns are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written

MAX_RATIO = 0.3
# A single page has no lines in common with its host's others.
MIN_PAGES = 2

# What a page shows nothing of, and the tags that break lines.
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BREAKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    r"h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)"
    r"\b[^>]*>"
)
TAGS = r"<[^>]*>"
BLANKS = r"[ \t\r]+"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def lines_of(html: Column) -> Column:
    """The visible lines of a page, blanks collapsed, without blank lines."""
    shown = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    shown = F.regexp_replace(F.regexp_replace(shown, BREAKS, "\n"), TAGS, "")
    lines = F.split(F.regexp_replace(shown, BLANKS, " "), "\n")
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")


def hot_hosts(totals: DataFrame) -> DataFrame:
    """(host, salts) of the hosts that hold more than a quarter of a partition's
    share of the pages: no more than four for each partition, so they may be
    broadcast, and together they have no more than twice that many salts."""
    quarters = 4 * int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = math.ceil((totals.agg(F.sum("host_pages")).first()[0] or 0) / quarters)
    hot = totals.where(F.col("host_pages") > share)
    return F.broadcast(hot.select("host", F.ceil(F.col("host_pages") / max(share, 1)).cast("int").alias("salts")))


def salted(rows: DataFrame, hot: DataFrame, by: Column) -> DataFrame:
    """Rows with a salt: zero but for those of hot hosts."""
    dealt = rows.join(hot, "host", "left")
    return dealt.withColumn("salt", F.pmod(by, F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")


def spread(hosts: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Each host once for each of its salts."""
    known = hosts if hot is None else hosts.join(hot, "host", "left")
    last = F.coalesce("salts", F.lit(1)) - 1
    return known.withColumn("salt", F.explode(F.sequence(F.lit(0), last))).drop("salts")


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, host_pages, salts, boiler): the digests of each host's boilerplate.

    ``pages``: (host, lines). A host has at most (distinct lines of its average
    page) / max_ratio such lines, so the array doesn't grow with its pages.
    Counts are combined before the shuffle; host totals meet them salted.
    """
    each = pages.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n"))
    totals = written(pages.groupBy("host").agg(F.count("*").alias("host_pages")), "hosts")
    hot = hot_hosts(totals)
    over = (
        salted(counts.where("n > 1"), hot, F.col("line"))
        .join(spread(totals, hot), ["host", "salt"])
        .where(F.col("n") / F.col("host_pages") > max_ratio)
    )
    found = over.groupBy("host").agg(F.collect_list("line").alias("boiler"))
    return totals.join(found, "host", "left").join(hot, "host", "left").select(
        "host",
        "host_pages",
        "salts",
        F.when(F.col("host_pages") >= min_pages, F.coalesce("boiler", F.array().cast("array<bigint>")))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("boiler"),
    )


def clean(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """A row per page: page_id, host, host_pages, n_lines, n_dropped, kept_text."""
    lined = written(pages.select("page_id", host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines")), "lines")
    hosts = written(boilerplate(lined, max_ratio, min_pages), "boilerplate")
    hot = F.broadcast(hosts.where("salts is not null").select("host", "salts"))
    dealt = salted(lined, hot, F.xxhash64("page_id", "lines"))
    joined = dealt.join(spread(hosts), ["host", "salt"])
    kept = joined.withColumn(
        "kept", F.filter("lines", lambda x: ~F.array_contains("boiler", F.xxhash64(x)))
    )
    return kept.select(
        "page_id",
        "host",
        "host_pages",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size("kept")).alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept_text"),
    )
