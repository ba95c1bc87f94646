"""Stored pages of an API are read a few at a time."""

from __future__ import annotations

import glob
import json

import pyarrow.parquet as pq

from tributary.schemas import ECOMMERCE_SCHEMA
from tributary.session import fresh_dir
from tributary.sources import paged


def test_a_row_group_holds_few_pages(spark):
    """a reader's batch is a row group at most, so its bytes are bounded."""
    root = fresh_dir(spark, "large-pages")

    def body(i):
        return json.dumps({"next": None, "orders": [{"orderId": f"{i}-{k}", "totalAmount": 1.5, "platform": "x" * 900} for k in range(256)]})

    lines = [(json.dumps({"cursor": f"c{i}", "attempt": 1, "status": 200, "body": body(i)}),) for i in range(120)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{root}/in")
    stored = paged.land_pages(spark, f"{root}/in", f"{root}/bronze", "ecommerce", "orders", "2024-01-01 00:00:00")
    assert paged.records(stored, ECOMMERCE_SCHEMA).count() == 120 * 256
    found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{root.removeprefix('file://')}/bronze/batch=base/*.parquet")]
    groups = [m.row_group(i) for m in found for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 120
    assert max(g.num_rows for g in groups) <= paged.GROUP_PAGES
