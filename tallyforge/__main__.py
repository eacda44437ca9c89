"""``spark-submit``-style entry: run stages over folders with the submitted session."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyforge.plans import job


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyforge")
    parser.add_argument("stage", choices=["bronze", "silver", "gold", "all"])
    for layer in ("raw", "bronze", "silver", "gold"):
        parser.add_argument(f"--{layer}-dir", default=f"data/{layer}")
    args = parser.parse_args()
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.stage in ("bronze", "all"):
        job.run_bronze(spark, args.raw_dir, args.bronze_dir)
    if args.stage in ("silver", "all"):
        job.run_silver(spark, args.bronze_dir, args.silver_dir)
    if args.stage in ("gold", "all"):
        job.run_gold(spark, args.silver_dir, args.gold_dir)


if __name__ == "__main__":
    main()
