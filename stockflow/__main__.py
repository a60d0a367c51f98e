"""The batch jobs from the command line, for spark-submit or `python -m stockflow`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.jobs import DATASETS, clean_exports, flatten_pull, write_suite
from .plans.suite import RESULTS
from .sources.raw_csv import NULL_WORDS
from .sources.tables import read_tables
from .streaming.revenue import keep_daily_revenue


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="stockflow", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    clean = jobs.add_parser("clean", help="raw CSV exports to clean tables, quarantine and quality metrics")
    clean.add_argument("raw")
    clean.add_argument("out")
    clean.add_argument("--null-words", nargs="*", default=list(NULL_WORDS), help="texts that mean a missing value")
    clean.add_argument("--multi-line", action="store_true", help="admit line breaks inside quotes; such files are not split")

    analyse = jobs.add_parser("analyse", help="write the named results of a set of clean tables")
    analyse.add_argument("tables")
    analyse.add_argument("out")
    analyse.add_argument("--names", nargs="*", choices=sorted(RESULTS))
    analyse.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    analyse.add_argument("--preview", type=int, default=0, help="show this many rows of each result")

    flatten = jobs.add_parser("flatten", help="documents of one pull to tables")
    flatten.add_argument("landed")
    flatten.add_argument("out")
    flatten.add_argument("--pull-date", required=True)
    flatten.add_argument("--stores", nargs="+", required=True, help="preferred store first")
    flatten.add_argument("--only", choices=sorted(DATASETS))
    flatten.add_argument("--since", help="orders and payments made on the client on or after this day only")

    ingest = jobs.add_parser("ingest", help="take in newly landed orders, then bring daily revenue up to date")
    ingest.add_argument("landed")
    ingest.add_argument("sink")
    ingest.add_argument("--files-per-batch", type=int)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"stockflow-{args.job}").getOrCreate()
    if args.job == "clean":
        clean_exports(spark, args.raw, args.out, tuple(args.null_words), args.multi_line)
    elif args.job == "analyse":
        written = write_suite(read_tables(spark, args.tables), args.out, args.names, args.format, args.preview)
        if args.preview:
            for name, rows in written.items():
                print(name)
                rows.show(args.preview, truncate=False)
    elif args.job == "flatten":
        flatten_pull(spark, args.landed, args.out, args.pull_date, args.stores, args.only, args.since)
    else:
        keep_daily_revenue(spark, args.landed, args.sink, args.files_per_batch).awaitTermination()


if __name__ == "__main__":
    main()
