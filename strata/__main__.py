"""Command line: ``python -m strata <step> --root URI --date YYYY-MM-DD``.

Steps: ``run`` (bronze >> silver >> gold, then the report), ``bronze``,
``silver``, ``gold``, ``report`` (print the gold report of a date),
``stream`` (rebuild every date with newly landed pages) and ``sql`` (run a
query over the views landing, bronze, quarantine, silver and gold).  The session comes
from ``spark-submit`` / the environment; set ``spark.checkpoint.dir`` to a
shared folder on a cluster.  ``run`` and ``bronze`` exit with 3 when the landing
is incomplete or nothing landed.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("step", choices=["run", "bronze", "silver", "gold", "report", "stream", "sql"])
    ap.add_argument("query", nargs="?", help="SQL text for the sql step")
    ap.add_argument("--root", required=True, help="lake root; tables are <root>/<layer>")
    ap.add_argument("--date", help="run date, YYYY-MM-DD (all steps but stream)")
    ap.add_argument("--max-null-fraction", type=float, default=None)
    ap.add_argument("--rows", type=int, default=None, help="print at most so many rows (all by default)")
    ap.add_argument("--on-gap", choices=["report", "fail"], default="report",
                    help="what an incomplete landing does to the run")
    ap.add_argument("--expected-pages", type=int, default=None, help="pages a complete landing has")
    args = ap.parse_intermixed_args(argv)
    if args.step not in ("stream", "sql") and not args.date:
        ap.error("--date is required")
    if args.step == "sql" and not args.query:
        ap.error("the sql step needs a query")

    from pyspark.sql import SparkSession

    from strata.operators.report import gold_report
    from strata.plans import jobs
    from strata.session import apply_defaults, shared_dir

    spark = apply_defaults(SparkSession.builder.appName(f"strata-{args.step}").getOrCreate())
    layout = jobs.Layout.under(args.root)
    out: dict = {}
    status = 0

    def show(df) -> None:
        rows = df if args.rows is None else df.limit(args.rows)
        for line in rows.toJSON().toLocalIterator():    # a partition at a time
            print(line)

    if args.step == "run":
        report, out = jobs.run(spark, layout, args.date, args.max_null_fraction,
                               on_gap=args.on_gap, expected_pages=args.expected_pages)
        if report is not None:
            show(report)
        status = 0 if out["bronze"]["complete"] else 3
    elif args.step == "bronze":
        out = jobs.load_bronze(spark, layout, args.date, args.on_gap, args.expected_pages)
        status = 0 if out["complete"] else 3
    elif args.step == "silver":
        out = jobs.transform_silver(spark, layout, args.date)
    elif args.step == "gold":
        out = jobs.transform_gold(spark, layout, args.date, args.max_null_fraction)
    elif args.step == "sql":
        jobs.register_views(spark, layout)
        show(spark.sql(args.query))
    elif args.step == "report":
        show(gold_report(spark, jobs.read_gold(spark, layout, args.date), args.date))
    else:
        from strata.streaming import chain_for_new_pages

        done: list = []
        shared_dir(spark)                       # the bronze job checkpoints page counts
        q = chain_for_new_pages(spark, layout, f"{args.root.rstrip('/')}/_stream_checkpoint",
                                args.max_null_fraction, on_date=lambda d, m: done.append(str(d)),
                                on_gap=args.on_gap)
        q.awaitTermination()
        out = {"dates": done}
    print(json.dumps(out, default=str))
    return status


if __name__ == "__main__":
    sys.exit(main())
