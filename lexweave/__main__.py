"""The standard-model run as a job: ``spark-submit`` this module or ``python -m lexweave``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lexweave.config.model import load_mapping
from lexweave.config.standard_model import standard_mapping
from lexweave.plans.jobs import run_standard_model
from lexweave.sources.files import read_raw


def main(argv: list[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(description="Build the standard model of one project type.")
    parser.add_argument("--raw", required=True, help="folder that holds the tenants' raw files")
    parser.add_argument("--out", required=True, help="folder for the tables")
    parser.add_argument("--org", required=True, type=int, help="tenant id")
    parser.add_argument("--project-type", required=True, type=int)
    parser.add_argument("--mapping", help="mapping file; the bundled one if left out")
    parser.add_argument("--typed", action="store_true", help="cast to the mapping's types")
    args = parser.parse_args(argv)
    mapping = load_mapping(args.mapping) if args.mapping else standard_mapping(args.org)
    spark = SparkSession.builder.appName("standard model").getOrCreate()
    raw = read_raw(spark, args.raw, str(args.org), args.project_type)
    return run_standard_model(raw, args.out, mapping, args.typed)


if __name__ == "__main__":
    for name, path in main().items():
        print(name, path)
