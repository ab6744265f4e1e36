"""``spark-submit`` entry: run the batch, or some steps of it, for one snapshot date."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from larder.plans.pipeline import STEPS, Job, run_pipeline


def main() -> None:
    parser = argparse.ArgumentParser(prog="larder", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder of the dated snapshots")
    parser.add_argument("--warehouse", required=True, help="folder of the Parquet tables")
    parser.add_argument("--output", required=True, help="folder of the published results")
    parser.add_argument("--date", required=True, help="snapshot date, YYYY-MM-DD")
    parser.add_argument("--one-array", action="store_true", help="snapshots are one JSON array a source")
    parser.add_argument("--first", choices=STEPS, default="ingest", help="step to start at")
    parser.add_argument("--last", choices=STEPS, default="publish", help="step to end with")
    parser.add_argument("--resume", action="store_true", help="skip steps that are finished and whose inputs and outputs are unchanged")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("larder").getOrCreate()
    job = Job(args.landing, args.warehouse, args.output, args.date, args.one_array)
    for name, found in run_pipeline(spark, job, args.first, args.last, resume=args.resume).items():
        print(name, *found, sep="\n  ")
    spark.stop()


if __name__ == "__main__":
    main()
