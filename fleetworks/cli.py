"""Run a step over a warehouse folder: ``python -m fleetworks.cli STEP --root DIR --out DIR [...]``.

Steps read the tables under ``--root`` and write new folders under ``--out``; nothing is changed in place.
"""

from __future__ import annotations

import argparse
from datetime import UTC, date, datetime

from fleetworks.plans.signals import status_frequency
from fleetworks.plans.telemetry import calendar_range
from fleetworks.plans.warehouse import DailyRun, Warehouse, inventory_snapshot, tax_filings
from fleetworks.session import build_session, scratch_cleared
from fleetworks.sources import Catalog, conform, write_table
from fleetworks.streaming import FaultLanding, TelemetryLanding, drain, file_source, kafka_source

FAULT_TOPIC = "equipment.fault_events"
TELEMETRY_TOPIC = "equipment.telemetry_daily"


def marts(args, catalog: Catalog) -> None:
    warehouse = Warehouse(catalog)
    stored = warehouse.store(args.out)
    warehouse.check(stored).show(100, truncate=False)


def score(args, catalog: Catalog) -> None:
    run = DailyRun(catalog, args.now, args.holdout_days, args.sample_days, args.carry_hours)
    found, evaluation = run.score(max_iter=args.max_iter)
    print(f"auc {evaluation.auc:.4f} precision {evaluation.precision:.4f} recall {evaluation.recall:.4f}")
    triaged = run.triage(found)
    demand, gaps = run.resolve(triaged)
    reviewed, orders = run.convert(triaged)
    for name, df in (("parts_demand_forecast", demand), ("parts_mapping_gaps", gaps), ("ml_maintenance_signals", reviewed),
                     ("fact_maintenance_events", orders)):
        write_table(conform(df, name), f"{args.out}/{name}")
    status_frequency(catalog.spark.read.parquet(f"{args.out}/ml_maintenance_signals")).show()


def filings(args, catalog: Catalog) -> None:
    write_table(conform(tax_filings(catalog, args.as_of), "fact_tax_filings"), f"{args.out}/fact_tax_filings")


def inventory(args, catalog: Catalog) -> None:
    write_table(conform(inventory_snapshot(catalog, args.as_of), "fact_inventory"), f"{args.out}/fact_inventory")


def calendar(args, catalog: Catalog) -> None:
    write_table(calendar_range(catalog.spark), f"{args.out}/dim_date")


def land(args, catalog: Catalog) -> None:
    """Drain both topics, from Kafka or from folders named after them under ``--root``."""
    for topic, sink in ((FAULT_TOPIC, FaultLanding(args.out)), (TELEMETRY_TOPIC, TelemetryLanding(args.out))):
        if args.kafka:
            messages = kafka_source(catalog.spark, args.kafka, topic)
        else:
            messages = file_source(catalog.spark, f"{args.root}/{topic}")
        drain(sink.decode(messages), sink, f"{args.checkpoints or args.out + '/_checkpoints'}/{topic}")


STEPS = {"marts": marts, "score": score, "filings": filings, "inventory": inventory, "calendar": calendar, "land": land}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fleetworks")
    parser.add_argument("step", choices=sorted(STEPS))
    parser.add_argument("--root", required=True, help="folder with the input tables")
    parser.add_argument("--out", required=True, help="folder for results")
    parser.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--now", type=datetime.fromisoformat, default=datetime.now(UTC).replace(tzinfo=None))
    parser.add_argument("--holdout-days", type=int, default=60)
    parser.add_argument("--sample-days", type=int)
    parser.add_argument("--max-iter", type=int, default=50, help="boosting rounds")
    parser.add_argument("--carry-hours", action="store_true")
    parser.add_argument("--kafka", help="bootstrap servers; without it messages are read from files")
    parser.add_argument("--checkpoints")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session()
    with scratch_cleared(spark):
        STEPS[args.step](args, Catalog(spark, args.root, args.format))


if __name__ == "__main__":
    main()
