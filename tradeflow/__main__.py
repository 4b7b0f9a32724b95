"""Run the whole batch over source files and print what it did.

    python -m tradeflow ORDERS.jsonl INVENTORY.csv PRICE_EVENTS.jsonl OUTPUT_FOLDER
"""

from __future__ import annotations

import argparse

from tradeflow.operators.quality import quarantine_summary
from tradeflow.plans import run, serving
from tradeflow.session import build_session
from tradeflow.sources import tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="tradeflow", description=__doc__.splitlines()[0])
    parser.add_argument("orders")
    parser.add_argument("inventory")
    parser.add_argument("price_events")
    parser.add_argument("output")
    parser.add_argument("--master", help="only for local runs, e.g. local[8]")
    args = parser.parse_args()
    spark = build_session(master=args.master)
    sources = {feed: getattr(args, feed) for feed in run.FEEDS}
    done = run.run_all(spark, sources, args.output)
    for name, value in run.totals(spark, done).first().asDict().items():
        print(f"{name:28s} {value:>16,}")
    for feed in run.FEEDS:
        for reason, rows in quarantine_summary(run.quarantined_rows(spark, done, feed)).items():
            print(f"{feed:12s} {reason:20s} {rows:>11,}")
    stored = {name: done.metric(name) for name in run.METRICS}
    for name, folder in serving.export_metrics(spark, stored, f"{args.output}/export").items():
        print(f"exported {name} to {folder}")
    spark.stop()


if __name__ == "__main__":
    main()
