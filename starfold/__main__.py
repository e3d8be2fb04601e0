"""``spark-submit`` entry: ``python -m starfold WAREHOUSE OUTPUT [options]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starfold.plans.report import Questions, run, write_answers
from starfold.plans.session import prepare


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starfold", description="Sales report on a star schema.")
    parser.add_argument("warehouse", help="folder with one parquet folder per table")
    parser.add_argument("output", help="folder for the mart, the cuboid and the CSV extract")
    parser.add_argument("--region", default="East", help="region of the slice")
    parser.add_argument("--regions", nargs="+", default=["East", "West"])
    parser.add_argument("--categories", nargs="+", default=["Clothing", "Electronics"])
    parser.add_argument("--year", type=int, help="year to drill into, the latest by default")
    parser.add_argument("--top", type=int, default=5)
    args = parser.parse_args(argv)
    spark = prepare(SparkSession.builder.appName("starfold").getOrCreate())
    ask = Questions(
        ("Region", args.region),
        {"Region": args.regions, "Category": args.categories},
        args.year,
        args.top,
    )
    results, rows = run(spark, args.warehouse, args.output, ask)
    print(f"{rows} reporting rows")
    for name, path in write_answers(results, args.output).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
