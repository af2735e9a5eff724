"""Command line for the end-to-end jobs.

    python -m footfall clean    --raw RAW_CSV_DIR --log LOG_DIR [--row-id COL] [--spread N]
    python -m footfall overview --log LOG_DIR
    python -m footfall features --log LOG_DIR --out OUT_DIR [--approx]
    python -m footfall quality  --log LOG_DIR --out OUT_DIR
    python -m footfall publish  --raw RAW_CSV_DIR [--table NAME --database DB] [--spread N]

With ``--text-ids`` ids are text.

Reports are printed as tables (they are small: one row per check or one row
per run); the data itself is only written by Spark.
"""

from __future__ import annotations

import argparse

from footfall.plans import jobs
from footfall.session import get_spark, temporary_stages


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="footfall")
    sub = ap.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--raw", required=True)
    c.add_argument("--log", required=True)
    c.add_argument("--row-id")
    c.add_argument("--csv", action="store_true", help="write the log as CSV instead of Parquet")
    o = sub.add_parser("overview")
    o.add_argument("--log", required=True)
    f = sub.add_parser("features")
    f.add_argument("--log", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--approx", action="store_true", help="approximate quantiles")
    q = sub.add_parser("quality")
    q.add_argument("--log", required=True)
    q.add_argument("--out", required=True)
    p = sub.add_parser("publish")
    p.add_argument("--raw", required=True)
    p.add_argument("--table", default="user_behavior")
    p.add_argument("--database", default="footfall")
    p.add_argument("--row-id")
    for job in (c, p):
        job.add_argument("--spread", type=int, help="deal rows of files that can't be split to that many tasks")
    for job in (c, o, f, q, p):
        job.add_argument("--text-ids", action="store_true", help="ids are text, not numbers")
    args = ap.parse_args(argv)
    kind = "string" if getattr(args, "text_ids", False) else "bigint"

    spark = get_spark()
    if args.job == "clean":
        with temporary_stages(spark):
            res = jobs.clean_job(spark, args.raw, args.log, fmt="csv" if args.csv else "parquet",
                                 row_id_column=args.row_id, id_kind=kind, spread=args.spread)
            res.report.show(truncate=False)
    elif args.job == "overview":
        jobs.overview_job(spark, args.log, id_kind=kind).show(truncate=False)
    elif args.job == "features":
        out = jobs.feature_jobs(spark, args.log, args.out, exact_quantiles=not args.approx, id_kind=kind)
        print(out)
    elif args.job == "quality":
        feats = jobs.FeatureOutputs(f"{args.out}/user_features", f"{args.out}/item_features",
                                    f"{args.out}/category_features")
        jobs.quality_job(spark, args.log, feats, id_kind=kind).show(200, truncate=False)
    elif args.job == "publish":
        jobs.publish_job(spark, args.raw, args.table, args.database, row_id_column=args.row_id, id_kind=kind,
                         spread=args.spread).show()


if __name__ == "__main__":
    main()
