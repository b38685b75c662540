"""Write the whole report: ``python -m mastgrid INPUT OUTPUT [--format csv] [--header]``."""
import argparse

from pyspark.sql import SparkSession

from mastgrid.plans.report import write_report
from mastgrid.sources.towers import read_towers


def main():
    parser = argparse.ArgumentParser(prog="mastgrid", description=__doc__)
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--format", default="csv", help="of the input")
    parser.add_argument("--header", action="store_true", help="the CSV input has a header line")
    parser.add_argument("--output-format", default="parquet")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("mastgrid").getOrCreate()
    towers = read_towers(spark, options.input, options.format, options.header)
    write_report(towers, options.output, options.output_format)


if __name__ == "__main__":
    main()
