"""Command line: `python -m gleanfield merge_csvs IN.. -o OUT`."""

import argparse

from pyspark.sql import SparkSession

from gleanfield.session import configure
from gleanfield.sources.io import merge_csvs


def main(argv=None):
    parser = argparse.ArgumentParser(prog="gleanfield")
    commands = parser.add_subparsers(dest="command", required=True)
    merge = commands.add_parser("merge_csvs", help="merge CSV files with differing headers")
    merge.add_argument("input", nargs="+", help="CSV files to merge")
    merge.add_argument("-o", "--output", required=True, help="folder to write")
    args = parser.parse_args(argv)
    merge_csvs(configure(SparkSession.builder.getOrCreate()), args.input, args.output)


if __name__ == "__main__":
    main()
