"""The command line: list queries, show their plans, run them, and scan archives."""

from __future__ import annotations

import argparse
import json
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomwright")
    p.add_argument("--master", help="Spark's master, if the session does not name it")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="names of all queries")
    run = sub.add_parser("run", help="run a query over a folder of tables")
    run.add_argument("name")
    run.add_argument("tables")
    run.add_argument("--output", help="folder for the result; else a few rows are shown")
    run.add_argument("--dry-run", action="store_true", help="show the plan only")
    scan = sub.add_parser("scan", help="scan archives for papers with diagrams")
    scan.add_argument("archives")
    scan.add_argument("state")
    scan.add_argument("--from-month", required=True)
    scan.add_argument("--to-month", required=True)
    scan.add_argument("--limit", type=int, default=1, help="archives to scan; 0 is all, which needs --full")
    scan.add_argument("--full", action="store_true")
    scan.add_argument("--max-hours", type=float, default=168.0)
    check = sub.add_parser("validate", help="check the papers of a dataset folder")
    check.add_argument("dataset")
    check.add_argument("--allow-links", action="store_true")
    pack = sub.add_parser("pack", help="validate a dataset and write it as archives, which are read again and checked")
    pack.add_argument("dataset")
    pack.add_argument("output")
    pack.add_argument("--prefix", default="papers")
    pack.add_argument("--shard-bytes", type=int, default=2 << 30)
    pack.add_argument("--resume", action="store_true", help="keep archives that are there with the right members")
    pack.add_argument("--allow-links", action="store_true")
    return p


def _release(spark, a: argparse.Namespace) -> int:
    """Validate a dataset, and pack it if nothing is wrong; a summary is printed as JSON."""
    from pyspark.sql import functions as F

    from loomwright.plans import jobs, releases, stages
    from loomwright.session import settled

    files = releases.dataset_files(spark, a.dataset)
    if a.allow_links:
        files = files.withColumn("link", F.lit(False))
    found = settled(stages.validated(files), "validation")
    summary = stages.audit(found).first().asDict()
    summary["problems"] = {r.arxiv_id: r.errors for r in found.filter(F.size("errors") > 0).orderBy("arxiv_id").limit(20).collect()}
    if a.command == "pack" and not summary["errors"]:
        report, problems = releases.packed(files.drop("link"), a.output, a.prefix, a.shard_bytes, a.resume, a.dataset)
        totals = report.agg(F.count("*").alias("archives"), F.sum("bytes").alias("bytes")).first()
        summary |= {"archives": totals.archives, "bytes": totals.bytes, "problems": [f"{r.filename}: {r.problem}" for r in problems.orderBy("filename", "problem").limit(20).collect()]}
    print(json.dumps(summary, sort_keys=True))
    return jobs.EXIT_FAILED if summary["errors"] or summary["problems"] else jobs.EXIT_DONE


def main(args: list[str] | None = None) -> int:
    """0: done, 2: failed, 3: the job's hours are used up."""
    from loomwright.plans import catalogue, jobs
    from loomwright.session import session
    from loomwright.sources import tables

    a = parser().parse_args(args)
    if a.command == "queries":
        print("\n".join(sorted(catalogue.QUERIES)))
        return jobs.EXIT_DONE
    if a.command == "scan" and (a.limit < 0 or not a.limit and not a.full):
        print("an unlimited scan needs --full", file=sys.stderr)
        return jobs.EXIT_FAILED
    spark = session(a.master)
    try:
        if a.command == "run":
            df = catalogue.QUERIES[a.name](spark, a.tables)
            if a.dry_run:
                df.explain("formatted")
            elif a.output:
                df.write.mode("errorifexists").parquet(a.output)
            else:
                df.show(20, False)
            return jobs.EXIT_DONE
        if a.command in ("validate", "pack"):
            return _release(spark, a)
        lasts = lambda: jobs.within_budget(spark, a.state, a.max_hours)
        if not lasts():
            return jobs.EXIT_BUDGET
        found = tables.read_archives(spark, a.archives)
        print(json.dumps(jobs.scan(spark, found, a.state, a.from_month, a.to_month, a.limit, go_on=lasts), sort_keys=True))
        return jobs.EXIT_DONE
    except jobs.BudgetUsed:
        return jobs.EXIT_BUDGET
    except Exception as e:
        print(f"{type(e).__name__}: {e}"[:2000], file=sys.stderr)
        return jobs.EXIT_FAILED
