"""Command line: ``python -m barloom {transform,load,pipeline,add} ...``."""

from __future__ import annotations

import argparse

from barloom import schemas
from barloom.plans import add_prices, pipeline
from barloom.scratch import scratch_dir
from barloom.session import get_session
from barloom.sinks.catalog import KEYS_AS_STRINGS, KEYS_TYPED
from barloom.sources import deliver_prices, files, reject_counts


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="barloom", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    transform = steps.add_parser("transform", help="enrich one raw table")
    transform.add_argument("--mode", required=True, choices=list(pipeline.PARTITION_KEYS))

    load = steps.add_parser("load", help="register tables and views")
    whole = steps.add_parser("pipeline", help="extract, transform and load")
    add = steps.add_parser("add", help="add delivered prices to the transformed table")
    for step in (whole, add):
        step.add_argument("--source", required=True, help="folder with the delivered CSV files")
        step.add_argument("--market", default=files.MARKET)
        step.add_argument("--date-format", default=files.DATE_FORMAT)

    for step in (transform, load, whole, add):
        step.add_argument("--lake", required=True, help="root URI of the data lake")
    for step in (transform, whole):
        step.add_argument("--companies", help="CSV with Ticker and Company Name")
    for step in (load, whole):
        step.add_argument("--database", required=True)
        step.add_argument("--location", help="storage of the database's tables")
        step.add_argument(
            "--key-typing", default=KEYS_AS_STRINGS, choices=[KEYS_AS_STRINGS, KEYS_TYPED]
        )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = get_session(f"barloom-{args.step}")
    try:
        companies = None
        if getattr(args, "companies", None):
            companies = files.read_csv(spark, args.companies, schemas.COMPANIES)
        if args.step == "pipeline":
            given = {
                "root": args.source, "market": args.market, "date_format": args.date_format,
            }
            pipeline.extract_deliveries(args.lake, pipeline.deliveries(spark, **given))
        if args.step == "add":
            given = {"market": args.market, "date_format": args.date_format}
            stage = scratch_dir(spark, "delivered")
            delivered = deliver_prices(spark, args.source, stage=stage, **given)
            add_prices(spark, args.lake, delivered.rows)
            reject_counts(delivered.rejects).show(truncate=False)
        modes = {"transform": [getattr(args, "mode", None)], "pipeline": pipeline.PARTITION_KEYS}
        for mode in modes.get(args.step, []):
            pipeline.run_transform(spark, args.lake, mode, companies)
        if args.step in ("load", "pipeline"):
            loaded = pipeline.load(
                spark, args.lake, args.database, args.location, args.key_typing
            )
            loaded.quality.show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
