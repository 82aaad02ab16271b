"""Run one job, the full refresh or the ratings stream:

spark-submit tiermill/__main__.py refresh --root s3a://lake/tables --inventory ... --instagram ...
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tiermill.plans.dimensions import DIMENSION_FILES
from tiermill.plans.refresh import JOBS, Sources, refresh, run_job
from tiermill.sources.envelope import read_envelope_files, read_topic
from tiermill.sources.tables import TableStore
from tiermill.streaming.ratings import start_bronze


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tiermill")
    parser.add_argument("job", choices=[*JOBS, "refresh", "stream"])
    parser.add_argument("--root", default="", help="folder of the tables")
    parser.add_argument("--database", default="default", help="database or catalog of the tables")
    parser.add_argument("--provider", default="parquet", choices=["parquet", "iceberg"])
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="default: the current time")
    parser.add_argument("--run", help="name of a refresh; after a failure the same name goes on with it")
    parser.add_argument("--inventory", default="", help="inventory CSV")
    parser.add_argument("--instagram", default="", help="social posts CSV")
    parser.add_argument("--late-instagram", default="", help="social posts CSV that arrived late")
    parser.add_argument("--ratings", default="", help="folder of the ratings stream")
    parser.add_argument("--dimension", action="append", default=[], metavar="TABLE=CSV")
    parser.add_argument("--servers", default="", help="stream: Kafka servers")
    parser.add_argument("--topic", default="", help="stream: topic, or folder of envelope files")
    parser.add_argument("--rejected", help="stream: folder for unreadable messages")
    parser.add_argument("--checkpoint", default="", help="stream: checkpoint folder")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    dimensions = dict(pair.split("=", 1) for pair in args.dimension)
    unknown = set(dimensions) - set(DIMENSION_FILES)
    if unknown:
        raise SystemExit(f"unknown dimensions: {', '.join(sorted(unknown))}")
    spark = SparkSession.builder.appName(f"tiermill {args.job}").getOrCreate()
    if args.job == "stream":
        source = (
            read_topic(spark, args.servers, args.topic)
            if args.servers
            else read_envelope_files(spark, args.topic)
        )
        start_bronze(source, args.ratings, args.checkpoint, args.rejected).awaitTermination()
        return
    store = TableStore(spark, args.root, args.database, args.provider)
    sources = Sources(
        inventory_csv=args.inventory,
        instagram_csv=args.instagram,
        late_instagram_csv=args.late_instagram,
        dimension_files=dimensions,
        ratings_path=args.ratings,
    )
    as_of = args.as_of or datetime.now(timezone.utc)
    if args.job == "refresh":
        refresh(store, sources, as_of, args.run).show(truncate=False)
    else:
        for metric, count in run_job(args.job, store, sources, as_of).items():
            print(f"{metric}: {count}")


if __name__ == "__main__":
    main()
