"""Command line: every report of the batch run from one item file.

    python -m trendlake ITEMS OUT_DIR [--source json] [--as-of "2025-01-01 00:00:00"] [--master local[*]]
"""

from __future__ import annotations

import argparse

from trendlake.plans.reports import write_reports
from trendlake.session import get_spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="trendlake", description=__doc__.splitlines()[0])
    ap.add_argument("items", help="item records (JSON-array files, or a table of --source format)")
    ap.add_argument("out_dir", help="folder for data/{bronze,silver,gold} and output/<report>")
    ap.add_argument("--source", default="json", help="json (default), parquet, csv, ...")
    ap.add_argument("--as-of", default=None, help="reference time of the feature table (default: now)")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--only", nargs="*", default=None, help="report names to write (default: all)")
    args = ap.parse_args(argv)
    spark = get_spark(args.master)
    metrics = write_reports(spark, args.items, args.out_dir, source=args.source, as_of=args.as_of,
                            only=args.only)
    for row in metrics.collect():
        print(f"{row.output}\t{row.row_count}")


if __name__ == "__main__":
    main()
