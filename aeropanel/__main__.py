"""Runs the whole study: spark-submit aeropanel/__main__.py or python -m aeropanel --input ... [--output ...]."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from aeropanel.plans.report import Parameters, run_report
from aeropanel.session import tuned
from aeropanel.sources.readers import default_output, read_city_day


def main(argv: list[str] | None = None) -> dict[str, str]:
    args = argparse.ArgumentParser(prog="aeropanel", description=__doc__)
    args.add_argument("--input", required=True, help="daily CSV, any URI the cluster can read")
    args.add_argument("--output", help="folder for the results; by default `output` next to the input")
    args.add_argument("--infer", action="store_true", help="infer the schema instead of using the fixed one")
    args.add_argument("--years", type=int, default=6, help="years a city needs for the fixed comparison")
    args.add_argument("--nulls", choices=["skip", "zero"], default="skip", help="missing values in correlations")
    args.add_argument("--no-models", action="store_true")
    given = args.parse_args(argv)
    spark = tuned(SparkSession.builder.appName("aeropanel").getOrCreate())
    out = given.output or default_output(given.input)
    written = run_report(
        spark, read_city_day(spark, given.input, given.infer), out, Parameters(n_years=given.years, nulls=given.nulls),
        with_models=not given.no_models, source=given.input)
    for name, path in written.items():
        print(f"{name}: {path}")
    return written


if __name__ == "__main__":
    main()
