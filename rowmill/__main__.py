"""Run the job on a CSV table, or compare stored runs.

    python -m rowmill run      INPUT OUT [--config FILE] [--key id] [--label diagnosis]
                                       [--run-id NAME] [--partitions N]
    python -m rowmill compare  RUNS FIRST [--key id]

The session's settings (master, memory, shuffle partitions) come from spark-submit
or spark-defaults.conf.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rowmill.operators.comparison import run_summary
from rowmill.operators.metrics import report_text
from rowmill.plans.config import JobConfig
from rowmill.plans.job import run_job
from rowmill.sources.artifacts import read_run_results
from rowmill.sources.tables import read_labeled


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rowmill")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run the whole job")
    run.add_argument("input")
    run.add_argument("out")
    run.add_argument("--config")
    run.add_argument("--key", default="id")
    run.add_argument("--label", default="diagnosis")
    run.add_argument("--run-id")
    run.add_argument("--partitions", type=int, help="layout a forest is grown in")
    compare = commands.add_parser("compare", help="compare stored runs with the first")
    compare.add_argument("runs")
    compare.add_argument("first")
    compare.add_argument("--key", default="id")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    if options.command == "run":
        config = JobConfig.load(options.config) if options.config else JobConfig()
        if options.partitions:
            config = config.with_changes(partitions=options.partitions)
    spark = SparkSession.builder.appName("rowmill").getOrCreate()
    if options.command == "run":
        table = read_labeled(spark, options.input, options.key, options.label)
        result = run_job(table, options.key, "target", options.out, config, run_id=options.run_id)
        result.metrics.show(truncate=False)
        print(report_text(result.report))
    else:
        runs = read_run_results(spark, options.runs)
        summary = run_summary(runs, options.first, options.key).orderBy("run_id")
        print(*summary.columns, sep="\t")
        for row in summary.toLocalIterator():  # every run, a line each
            print(*row, sep="\t")


if __name__ == "__main__":
    main()
