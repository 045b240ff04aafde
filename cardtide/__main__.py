"""Command line: ``python -m cardtide <analysis> <input> <output> [--files N] [-D name=value]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.routines import ROUTINES, run


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cardtide", description="Card-transaction analyses on Spark")
    parser.add_argument("analysis", choices=sorted(ROUTINES))
    parser.add_argument("input", help="text file, folder or glob of transaction lines")
    parser.add_argument("output", help="folder for the report")
    parser.add_argument("--files", type=int, help="number of report files (default: chosen by size)")
    parser.add_argument("--mode", choices=["errorifexists", "overwrite"], help="what to do with an existing output")
    parser.add_argument("--stage", help="folder for the profile stage of a multi-step analysis")
    parser.add_argument("-D", dest="properties", action="append", default=[], metavar="NAME=VALUE",
                        help="threshold, for example risk.error.high=0.05")
    args = parser.parse_args(argv)
    properties = dict(p.split("=", 1) for p in args.properties)
    spark = SparkSession.builder.appName(f"cardtide {args.analysis}").getOrCreate()
    run(spark, args.analysis, args.input, args.output, files=args.files, mode=args.mode,
        properties=properties, stage=args.stage)


if __name__ == "__main__":
    main()
