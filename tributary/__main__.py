"""Command line: ``python -m tributary <command>`` (or through spark-submit).

  run    (--input DIR | --pos-csv DIR --ecommerce-json DIR --mobile-parquet DIR)
         --lake DIR [--rules as_coded|documented]
         [--transformation-ts TS] [--report-date DATE] [--master URL]
         Materialise bronze, silver and gold and register the layer tables.
  increment --lake DIR --pos-csv DIR --ecommerce-json DIR --mobile-parquet DIR
         Add newly landed files to a lake built by ``run`` (only the days
         the new rows fall on are re-flagged and re-aggregated).
  maintain --lake DIR [--target-mb N]
         Pack the small files of a lake's partitions.
  query  NAME --input DIR [--rows N] [--out PATH] [--master URL]
         Run one registered query; print N rows or write it as Parquet.
  list   Print the registered query names.
"""

from __future__ import annotations

import argparse
import json
import sys

from tributary.rules import AS_CODED, DOCUMENTED


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tributary")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--input", help="driver tables folder (fixture feeds are derived from it)")
    r.add_argument("--pos-csv", help="folder of POS CSV exports")
    r.add_argument("--ecommerce-json", help="folder of e-commerce JSON orders")
    r.add_argument("--mobile-parquet", help="folder of mobile Parquet logs")
    r.add_argument("--ingestion-ts", help="ingestion time stamped on landed rows")
    r.add_argument("--lake", required=True)
    r.add_argument("--rules", choices=["as_coded", "documented"], default="as_coded")
    r.add_argument("--dedup", choices=["priority", "none"], default="priority")
    r.add_argument("--transformation-ts", help="default: now")
    r.add_argument("--report-date", help="default: today")
    r.add_argument("--master")
    inc = sub.add_parser("increment")
    inc.add_argument("--lake", required=True)
    inc.add_argument("--pos-csv", required=True)
    inc.add_argument("--ecommerce-json", required=True)
    inc.add_argument("--mobile-parquet", required=True)
    inc.add_argument("--ingestion-ts")
    inc.add_argument("--rules", choices=["as_coded", "documented"], default="as_coded")
    inc.add_argument("--dedup", choices=["priority", "none"], default="priority")
    inc.add_argument("--batch", help="name of the batch (default: from its folders)")
    inc.add_argument("--transformation-ts", help="default: now")
    inc.add_argument("--report-date", help="default: today")
    inc.add_argument("--master")
    m = sub.add_parser("maintain")
    m.add_argument("--lake", required=True)
    m.add_argument("--target-mb", type=int, default=128)
    m.add_argument("--master")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--input", required=True)
    q.add_argument("--rows", type=int, default=20)
    q.add_argument("--out")
    q.add_argument("--master")
    sub.add_parser("list")
    args = ap.parse_args(argv)

    from tributary.plans.queries import queries

    if args.cmd == "list":
        print("\n".join(sorted(queries())))
        return 0

    from tributary.session import get_session

    spark = get_session(args.master)
    if args.cmd == "run":
        from tributary.plans import pipeline

        rules = DOCUMENTED if args.rules == "documented" else AS_CODED
        landing = {
            k: v
            for k, v in (
                ("pos", args.pos_csv),
                ("ecommerce", args.ecommerce_json),
                ("mobile", args.mobile_parquet),
            )
            if v
        }
        if landing and len(landing) != 3:
            ap.error("give all three of --pos-csv, --ecommerce-json, --mobile-parquet")
        if not landing and not args.input:
            ap.error("give --input or the three landing folders")
        res = pipeline.run(
            spark,
            args.input,
            args.lake,
            rules=rules,
            transformation_ts=args.transformation_ts or pipeline.now(),
            report_date=args.report_date or pipeline.today(),
            landing_paths=landing or None,
            ingestion_ts=args.ingestion_ts,
            dedup_mode=args.dedup,
        )
        print(json.dumps({"tables": res.tables, "timings": res.timings, "metrics": res.metrics}))
        return 0

    if args.cmd == "increment":
        from tributary.plans import pipeline

        res = pipeline.run_increment(
            spark,
            args.lake,
            {"pos": args.pos_csv, "ecommerce": args.ecommerce_json, "mobile": args.mobile_parquet},
            rules=DOCUMENTED if args.rules == "documented" else AS_CODED,
            transformation_ts=args.transformation_ts or pipeline.now(),
            report_date=args.report_date or pipeline.today(),
            ingestion_ts=args.ingestion_ts,
            register=True,
            dedup_mode=args.dedup,
            batch=args.batch,
        )
        print(json.dumps({"tables": res.tables, "timings": res.timings, "metrics": res.metrics}))
        return 0

    if args.cmd == "maintain":
        from tributary.plans import pipeline

        print(json.dumps(pipeline.maintain(spark, args.lake, args.target_mb << 20)))
        return 0

    df = queries()[args.name](spark, args.input)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
