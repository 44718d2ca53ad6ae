"""Command line: ``python -m trendflow run|increment|incremental|quality ...``.

Uses the session the cluster provides (``spark-submit`` settings); nothing
here sets engine configuration.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from trendflow.config import DEFAULT_DQ_TABLES, SILVER_REGIONS


def _regions(text: str | None):
    if text is None:
        return tuple(SILVER_REGIONS)
    return None if text == "all" else [r for r in text.split(",") if r]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="trendflow")
    sub = ap.add_subparsers(dest="cmd", required=True)

    run = sub.add_parser("run", help="reference + statistics lanes, quality gate, Gold")
    run.add_argument("--bronze-statistics", required=True)
    run.add_argument("--bronze-reference", required=True)
    run.add_argument("--silver-root", required=True)
    run.add_argument("--gold-root", required=True)
    run.add_argument("--format", choices=["csv", "json", "mixed"], default="csv")
    run.add_argument("--json-lines", action="store_true", help="API files hold one document a line")
    run.add_argument("--regions", help="comma list, or 'all' (default: the Silver regions)")
    run.add_argument("--run-date", help="trending day for API rows (default: ingestion day)")
    run.add_argument("--dq-tables", default=",".join(DEFAULT_DQ_TABLES))
    run.add_argument("--run-id", help="a stopped run goes on when it is started again with its id")
    run.add_argument("--database", help="register Silver and Gold as tables of this database")

    grow = sub.add_parser("increment", help="new Bronze files -> Silver, quality gate, Gold of the touched months")
    grow.add_argument("--bronze-statistics", required=True)
    grow.add_argument("--silver-root", required=True)
    grow.add_argument("--gold-root", required=True)
    grow.add_argument("--staging", required=True)
    grow.add_argument("--checkpoint", required=True)
    grow.add_argument("--format", choices=["csv", "json"], default="csv")
    grow.add_argument("--regions")
    grow.add_argument("--dq-tables", default=",".join(DEFAULT_DQ_TABLES))
    grow.add_argument("--database")

    inc = sub.add_parser("incremental", help="new Bronze files -> staging -> Silver")
    inc.add_argument("--bronze-statistics", required=True)
    inc.add_argument("--staging", required=True)
    inc.add_argument("--silver", required=True)
    inc.add_argument("--checkpoint", required=True)
    inc.add_argument("--format", choices=["csv", "json"], default="csv")
    inc.add_argument("--regions")

    qc = sub.add_parser("quality", help="quality report over Silver tables")
    qc.add_argument("--silver-root", required=True)
    qc.add_argument("--tables", default=",".join(DEFAULT_DQ_TABLES))

    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"trendflow-{args.cmd}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # dates and stamps do not follow the cluster

    if args.cmd == "run":
        from trendflow.plans.orchestrate import Layout, run_all
        layout = Layout(args.bronze_statistics, args.bronze_reference, args.silver_root,
                        args.gold_root)
        res = run_all(spark, layout, fmt=args.format, regions=_regions(args.regions),
                      run_date=args.run_date, dq_tables=args.dq_tables.split(","),
                      multi_line=not args.json_lines, run_id=args.run_id, database=args.database)
        print(json.dumps({"quality_passed": res.quality_passed, "results": res.quality_results,
                          "silver": res.silver, "reference": res.reference_summary,
                          "gold": res.gold, "skipped": res.skipped}, default=str))
        return 0 if res.quality_passed else 2
    if args.cmd == "increment":
        from trendflow.plans.orchestrate import Layout, run_increment
        layout = Layout(args.bronze_statistics, "", args.silver_root, args.gold_root)
        res = run_increment(spark, layout, args.staging, args.checkpoint, fmt=args.format, regions=_regions(args.regions),
                            dq_tables=args.dq_tables.split(","), database=args.database)
        print(json.dumps({"quality_passed": res.quality_passed, "results": res.quality_results,
                          "silver": res.silver, "gold": res.gold}, default=str))
        return 0 if res.quality_passed else 2
    if args.cmd == "incremental":
        from trendflow.streaming.incremental import incremental_silver
        out = incremental_silver(spark, args.bronze_statistics, args.staging, args.silver,
                                 args.checkpoint, fmt=args.format, regions=_regions(args.regions))
        print(json.dumps({"partitions": len(out["partitions"]), "batches": out["batches"], "metrics": out["metrics"]}))
        return 0
    from trendflow.operators import quality as dq
    root = args.silver_root.rstrip("/")
    tables = {t: (lambda p=f"{root}/{t}": spark.read.parquet(p)) for t in args.tables.split(",")}
    rows = dq.quality_results(spark, tables)
    ok = all(r["passed"] for r in rows)
    print(json.dumps({"quality_passed": ok, "results": rows}, default=str))
    return 0 if ok else 2


if __name__ == "__main__":
    raise SystemExit(main())
