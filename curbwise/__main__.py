"""Command line: run a named report or metric over a parquet permit model and publish it.

    python -m curbwise run applications_received --tables s3a://b/permits --publish s3a://b/published
    python -m curbwise run inspector_priority --tables ... --publish ... --as-of "2024-06-01 00:00:00"
    python -m curbwise tag --tables ... --publish ... [--full]
    python -m curbwise extract --url jdbc:oracle:... --user u --password-env DB_PASSWORD --tables s3a://b/permits
    python -m curbwise daily-counts sheet_name --csv sheet.csv --date-column "Created" --publish ...
    python -m curbwise snapshot --file active_permits.csv --publish ...
    python -m curbwise publish-file review_time --csv review_time.csv --publish ...

``run`` computes the plan of that name (``registry.PLANS``), publishes it
under ``<publish>/<name>`` by its configured method (replace or keyed upsert,
``sinks.PUBLISH_SPECS``; replace when not configured) and optionally writes a
CSV copy. Plans that need the road-segment dataset read the published
``segment_zone_tags``, which ``tag`` maintains.

``extract`` copies the source tables over JDBC to parquet. ``daily-counts``
counts a sheet's rows per day, ``snapshot`` stamps a published count file with
the file's own time, and ``publish-file`` publishes a result that was written
as CSV by the configured method of its name, its columns typed by what they hold.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import types as T

from curbwise.plans import weekly
from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources import csv_io, sinks
from curbwise.sources.jdbc import extract_to_parquet, from_jdbc


def _as_of(text: str | None) -> str:
    return text or dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def _publish_file(spark, args) -> int:
    """The commands that publish from one CSV file."""
    specs = dict(sinks.PUBLISH_SPECS)
    if args.cmd == "daily-counts":
        name = args.name
        created = T.StructType([T.StructField(args.date_column, T.TimestampNTZType())])
        df = weekly.daily_counts(csv_io.read_csv(spark, args.csv, created), args.date_column)
        specs.setdefault(name, sinks.PublishSpec(name, "replace"))
    elif args.cmd == "snapshot":
        name, df = "active_permits_snapshot", weekly.active_snapshot_from_file(csv_io.read_text(spark, args.file))
    else:
        name, df = args.name, csv_io.read_typed(spark, args.csv)
    print(f"{name} version {sinks.publish(spark, name, df, args.publish, specs)}")
    return 0


def main(argv: list[str] | None = None) -> int:
    from curbwise.plans import tagging
    from curbwise.registry import PLAN_FUNCTIONS, bind
    from curbwise.session import get_spark
    from curbwise.sources.tables import PermitTables

    ap = argparse.ArgumentParser(prog="curbwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="compute and publish a named report / metric")
    run.add_argument("name", choices=sorted(PLAN_FUNCTIONS))
    tag = sub.add_parser("tag", help="tag street segments with zones and upsert them")
    tag.add_argument("--full", action="store_true", help="all segments (replace) instead of the look-back")
    extract = sub.add_parser("extract", help="copy the source tables over JDBC to parquet")
    extract.add_argument("--url", required=True)
    extract.add_argument("--user")
    extract.add_argument("--password-env", help="environment variable that holds the password")
    extract.add_argument("--schema-name")
    extract.add_argument("--only", nargs="*", help="names of the tables (default: all)")
    daily = sub.add_parser("daily-counts", help="rows per day of a sheet saved as CSV")
    daily.add_argument("name", help="name of the published dataset")
    daily.add_argument("--date-column", required=True)
    snap = sub.add_parser("snapshot", help="active-permit snapshot of a published count file")
    snap.add_argument("--file", required=True, help="CSV with foldertype and activepermits")
    pub = sub.add_parser("publish-file", help="publish a result that was written as CSV")
    pub.add_argument("name", choices=sorted(sinks.PUBLISH_SPECS))
    for p in (daily, pub):
        p.add_argument("--csv", required=True)
    for p in (run, tag, extract):
        p.add_argument("--tables", required=True, help="root of the parquet permit model")
    for p in (run, tag, daily, snap, pub):
        p.add_argument("--publish", required=True, help="root of the published datasets")
    for p in (run, tag):
        p.add_argument("--as-of", help="clock of time-relative rules (default: now)")
    for p in (run, tag, extract, daily, snap, pub):
        p.add_argument("--master", help="Spark master for a local run")
    run.add_argument("--csv", help="also write the result as CSV to this folder")
    args = ap.parse_args(argv)

    spark = get_spark(args.master, cluster=args.master is None)
    if args.cmd == "extract":
        password = os.environ[args.password_env] if args.password_env else None
        source = from_jdbc(spark, args.url, args.only or None, user=args.user, password=password, schema_name=args.schema_name)
        extract_to_parquet(source, args.tables)
        print(f"{len(source.names())} tables")
        return 0
    if args.cmd in ("daily-counts", "snapshot", "publish-file"):
        return _publish_file(spark, args)

    t = PermitTables.from_parquet(spark, args.tables)
    as_of = _as_of(args.as_of)

    if args.cmd == "tag":
        tags = tagging.segment_zone_tags(t, as_of, full=args.full)
        if args.full:
            version = sinks.replace(spark, tags, f"{args.publish.rstrip('/')}/segment_zone_tags", ["segment_id"])
        else:
            version = sinks.publish(spark, "segment_zone_tags", tags, args.publish)
        print(f"segment_zone_tags version {version}")
        return 0

    road = sinks.read_latest(spark, f"{args.publish.rstrip('/')}/segment_zone_tags",
                             PERMIT_SCHEMAS["road_segment"])
    if road is not None:  # scoring plans use the published road dataset instead of re-tagging
        t = t.with_table("road_segment", road)
    df = bind(args.name, as_of)(t)
    specs = dict(sinks.PUBLISH_SPECS)
    specs.setdefault(args.name, sinks.PublishSpec(args.name, "replace"))
    version = sinks.publish(spark, args.name, df, args.publish, specs)
    if args.csv:
        csv_io.write_csv(sinks.read_latest(spark, f"{args.publish.rstrip('/')}/{args.name}"), args.csv)
    print(f"{args.name} version {version}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
