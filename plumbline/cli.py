"""Command line: score a scope, all projects and the network, or look at scores."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plumbline.operators.decay import inspect
from plumbline.plans.runner import ScoreRunner, run_all
from plumbline.sources.store import write_summary


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="plumbline", description=__doc__)
    p.add_argument("command", choices=["full", "incremental", "append", "inspect", "status"])
    p.add_argument("--posts", help="Parquet folder of project posts")
    p.add_argument("--user-posts", help="Parquet folder of network posts")
    p.add_argument("--users", help="Parquet folder of users")
    p.add_argument("--out", required=True, help="folder of score versions, state and log")
    p.add_argument("--scope", choices=["project", "global"], help="default: every scope that has posts")
    p.add_argument("--run-id")
    p.add_argument("--where", help="a filter for inspect")
    p.add_argument("--rows", type=int, default=20)
    p.add_argument("--summary", help="a JSON file for the figures of the run")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("plumbline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    paths = {"project": a.posts, "global": a.user_posts}
    scopes = [a.scope] if a.scope else [s for s, path in paths.items() if path] or ["project"]
    runners = {s: ScoreRunner(spark, a.out, s) for s in scopes}
    if a.command == "status":
        print(runners[scopes[0]].log.status(a.run_id))
        return 0
    if a.command == "inspect":
        for r in runners.values():
            scores = r.table.read()
            if scores is not None:
                scores = scores.where(a.where) if a.where else scores
                inspect(scores).show()
                scores.orderBy(F.desc("contribution_score")).show(a.rows, truncate=False)
        return 0
    began = time.time()
    users = spark.read.parquet(a.users)
    done = run_all({s: lambda s=s, r=r: getattr(r, a.command)(spark.read.parquet(paths[s]), users) for s, r in runners.items()})
    if a.summary:
        write_summary(a.summary, {"command": a.command, "seconds": round(time.time() - began, 3), "scopes": done, "states": {s: r.table.state() for s, r in runners.items()}})
    print(done)
    return int(any(v != "done" for v in done.values()))


if __name__ == "__main__":
    raise SystemExit(main())
