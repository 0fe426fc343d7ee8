"""One run from the command line, e.g. under spark-submit:

    python -m tidemark 2026-07-13 --base s3a://lake/rates --landing s3a://lake/landing

Series come from a JSON file of rows [name, code, frequency, allow_negative]; without one
the built-in catalogue is used.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tidemark.plans.run import run_batch
from tidemark.plans.settings import Paths, Settings
from tidemark.schemas import CATALOGUE, series_dimension


def parse(arguments: list[str]) -> argparse.Namespace:
    default = Settings()
    parser = argparse.ArgumentParser(prog="tidemark", description="Load one batch.")
    parser.add_argument("batch_ref", help="last date of the batch, yyyy-MM-dd")
    parser.add_argument("--base", required=True, help="folder of the tables")
    parser.add_argument("--landing", required=True, help="folder of the payloads")
    parser.add_argument("--series", help="JSON file of series rows")
    parser.add_argument("--layout", choices=["array", "lines"], default=default.layout)
    parser.add_argument("--on-error", choices=["fail", "quarantine"], default=default.on_error)
    parser.add_argument("--policy", choices=["auto", "layered"], default=default.policy)
    parser.add_argument("--threshold", type=int, default=default.threshold)
    parser.add_argument("--null-tolerance", type=int, default=default.null_tolerance)
    parser.add_argument("--gold", choices=["full", "touched"], default=default.gold)
    return parser.parse_args(arguments)


def main(arguments: list[str]) -> None:
    options = parse(arguments)
    rows = CATALOGUE
    if options.series:
        with open(options.series) as source:
            rows = json.load(source)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    settings = Settings(
        layout=options.layout,
        on_error=options.on_error,
        policy=options.policy,
        threshold=options.threshold,
        null_tolerance=options.null_tolerance,
        gold=options.gold,
    )
    counts = run_batch(
        spark,
        options.batch_ref,
        Paths(options.base, options.landing),
        series_dimension(spark, rows),
        settings,
    )
    counts.orderBy("layer", "series_name").show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
