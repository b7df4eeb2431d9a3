"""Grade prospect points by the parcel that holds them.

    spark-submit jobs/enrich_parcels.py --database default --table prospects \
        --parcels s3://…/parcels/ --output s3://…/enriched/ [--format parquet] [--limit 100]

``--parcels`` holds Parquet files with ``parcel_id``, ``geometry`` (or ``wkt``) and the
parcel attributes.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import Observation, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from parcelgrid.operators import summary  # noqa: E402
from parcelgrid.plans import graded_prospects  # noqa: E402
from parcelgrid.session import start  # noqa: E402
from parcelgrid.sinks import write_csv, write_parquet  # noqa: E402
from parcelgrid.sources import tracts_from_wkt  # noqa: E402


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Parcel grades of prospect points")
    parser.add_argument("--database", default="default")
    parser.add_argument("--table", default="prospects")
    parser.add_argument("--path", help="read prospects from Parquet files instead of a table")
    parser.add_argument("--parcels", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--limit", type=int, help="only the first rows by point_id")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.path:
        prospects = spark.read.parquet(args.path)
    else:
        prospects = spark.table(f"{args.database}.{args.table}")
    parcels = spark.read.parquet(args.parcels)
    if "geometry" not in parcels.columns:
        parcels = tracts_from_wkt(parcels)

    seen = Observation()
    enriched = graded_prospects(prospects, parcels, args.limit, seen)
    if args.format == "csv":
        write_csv(enriched, args.output)
        written = spark.read.csv(args.output, header=True, escape='"', schema=enriched.schema)
        written = written.fillna("", ["error"])
    else:
        write_parquet(enriched, args.output)
        written = spark.read.parquet(args.output)
    print(f"wrote {seen.get['rows']} rows (flagged={seen.get['flagged']}) to {args.output}")
    # From the written rows: the lookup does not run again.
    totals = summary(written).first()
    print(", ".join(f"{name}: {totals[name]}" for name in ("flagged", "high_confidence", "errors")))
    written.select(
        "point_id", "truck_flag", "confidence", "lat", "lon", "parcel_owner", "county"
    ).show(3, truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = start("parcel-enrichment", catalog=args.path is None)
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
