"""Run an experiment on the census files: ``spark-submit … -m ridgeway`` or ``python -m ridgeway``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ridgeway.plans.census import HOUSING_FILES, PERSON_FILES, census_spec, read_census
from ridgeway.plans.experiment import PRESETS, run_experiment
from ridgeway.sources.metrics_log import MetricsLog


def main() -> None:
    parser = argparse.ArgumentParser(prog="ridgeway", description=__doc__)
    parser.add_argument("experiment", choices=PRESETS)
    parser.add_argument("--data", required=True, help="folder of the person and housing files")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--person", nargs="+", default=list(PERSON_FILES))
    parser.add_argument("--housing", nargs="+", default=list(HOUSING_FILES))
    parser.add_argument("--seed", type=int, default=0, help="of split, folds and column draw")
    parser.add_argument("--keep", default="table", choices=["table", "cache", "nothing"])
    parser.add_argument("--person-schema", help="DDL of the person files (default: types by name)")
    parser.add_argument("--housing-schema", help="DDL of the housing files (default: types by name)")
    parser.add_argument("--no-comparison", action="store_true", help="leave Spark's own model out")
    parser.add_argument("--metrics", help="folder of the metrics table to append to")
    args = parser.parse_args()

    spark = SparkSession.builder.appName(args.experiment).getOrCreate()
    table = read_census(
        spark,
        args.data,
        args.person_schema,
        args.housing_schema,
        person_files=args.person,
        housing_files=args.housing,
        fmt=args.format,
    )
    log = MetricsLog(spark, args.metrics) if args.metrics else None
    result = run_experiment(
        table,
        census_spec(table),
        PRESETS[args.experiment],
        seed=args.seed,
        compare=not args.no_comparison,
        keep=args.keep,
    )
    for step, alpha, score in result.rows():
        print(f"{step:6} alpha {alpha:<8g} r2 {score}")
        if log:
            log.add(step, f"r2 at alpha {alpha:g}", score)
    if log:
        log.flush()


if __name__ == "__main__":
    main()
