"""Jobs: ``spark-submit`` this module, or ``python -m faultsift``.

``run`` (the default) is one batch run, ``stream`` triages what is new since the
last call, ``arrivals`` writes the first incident of each cause, ``land`` adds new
payload objects to a landed table and ``pack`` sorts them by URI, ``states`` and
``newest`` keep endpoint states and the newest rows by day, ``posted`` records the numbers of posted
issues, and ``compact`` takes a snapshot of a ledger while other jobs go on, or
with ``--out`` rewrites it elsewhere.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultsift.operators.filters import DEFAULT_DAYS, positive_days
from faultsift.operators.payloads import LandedTable
from faultsift.operators.ranking import newest
from faultsift.plans.run import run_triage
from faultsift.plans.triage import candidates
from faultsift.schemas import APPROVALS, POSTED
from faultsift.session import configure
from faultsift.sources.endpoints import (
    read_endpoint_states,
    read_endpoint_versions,
    start_endpoint_states,
)
from faultsift.sources.investigations import read_investigation_stream, read_investigations
from faultsift.sources.ledger import (
    compact_ledger,
    record_posted,
    snapshot_ledger,
    vacuum_ledger,
)
from faultsift.sources.newest import read_candidates, start_newest
from faultsift.sources.payloads import (
    open_payload_table,
    pack_payloads,
    read_payload_objects,
    start_landing,
)
from faultsift.streaming.intake import start_first_arrivals, start_triage

# What each job cannot do without.
NEEDED = {
    "run": ("investigations|newest", "payloads", "endpoints|endpoint_states", "ledger", "out"),
    "stream": (
        "investigations", "payloads", "endpoints|endpoint_states", "ledger", "out", "checkpoint"
    ),
    "arrivals": ("investigations", "payloads", "out", "checkpoint"),
    "land": ("objects", "payloads", "checkpoint", "buckets"),
    "pack": ("payloads",),
    "states": ("endpoints", "endpoint_states"),
    "newest": ("investigations", "newest"),
    "posted": ("posted", "ledger"),
    "compact": ("ledger",),
}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="faultsift", description="Triage recent incidents.")
    parser.add_argument("job", nargs="?", choices=sorted(NEEDED), default="run")
    parser.add_argument("-d", "--days", type=positive_days, default=DEFAULT_DAYS,
                        help="days to look back, or to wait (default: %(default)s)")
    parser.add_argument("--as-of", type=datetime.fromisoformat,
                        help="end of the look-back (default: now)")
    parser.add_argument("--cap", type=int, help="newest candidates kept (default: all)")
    parser.add_argument("--investigations")
    parser.add_argument("--date-column", help="date partition column of the investigations")
    parser.add_argument("--payloads", help="landed table, or object prefix with --raw")
    parser.add_argument("--raw", action="store_true", help="--payloads is an object prefix")
    parser.add_argument("--landed-since", type=date.fromisoformat,
                        help="read payloads landed from this day on (default: all)")
    parser.add_argument("--objects", help="object prefix to land")
    parser.add_argument("--store", help="URI that pointers have for the object prefix")
    parser.add_argument("--buckets", type=int, help="bucket count of a new landed table")
    parser.add_argument("--endpoints")
    parser.add_argument("--endpoint-states", help="stored states, instead of --endpoints")
    parser.add_argument("--newest", help="stored newest rows by day, instead of --investigations")
    parser.add_argument("--approvals", help="approved fingerprints (default: approve all)")
    parser.add_argument("--posted", help="fingerprints and numbers of posted issues")
    parser.add_argument("--ledger")
    parser.add_argument("--out")
    parser.add_argument("--checkpoint")
    parser.add_argument("--writer", help="name of the run, to repeat it (default: a new one)")
    args = parser.parse_args(argv)
    missing = [n for n in NEEDED[args.job] if all(getattr(args, x) is None for x in n.split("|"))]
    if missing:
        names = ", ".join(f"--{n}".replace("|", " or --").replace("_", "-") for n in missing)
        parser.error(f"{args.job} needs {names}")
    return args


def _payloads(spark: SparkSession, args: argparse.Namespace) -> DataFrame | LandedTable:
    if args.raw:
        return read_payload_objects(spark, args.payloads, args.store)
    return open_payload_table(spark, args.payloads, args.landed_since)


def _endpoints(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.endpoint_states:
        return read_endpoint_states(spark, args.endpoint_states)
    return read_endpoint_versions(spark, args.endpoints)


def _candidates(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.newest:
        return read_candidates(spark, args.newest, args.days, args.as_of)
    rows = read_investigations(spark, args.investigations, args.date_column)
    return candidates(rows, args.days, args.as_of, date_column=args.date_column)


def _run(spark: SparkSession, args: argparse.Namespace, writer: str) -> None:
    found = _candidates(spark, args)
    cut: int | Callable[[], int] = 0
    if args.cap is not None:
        # Counted while the capped rows are taken, when the run writes them.
        counts = Observation()
        found = newest(found.observe(counts, F.count(F.lit(1)).alias("every")), args.cap)
        cut = lambda: max(0, counts.get["every"] - args.cap)
    approvals = spark.read.schema(APPROVALS).parquet(args.approvals) if args.approvals else None
    summary = run_triage(
        found, _payloads(spark, args), _endpoints(spark, args),
        args.out, args.ledger, writer, approvals=approvals, cut=cut,
    )
    row = summary.first()
    print(f"{row.total} candidates, {row.created} drafts, {row.skipped} causes known before")


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = configure(SparkSession.builder.appName("faultsift").getOrCreate())
    writer = args.writer or f"{args.job}-{uuid.uuid4().hex}"
    if args.job == "run":
        _run(spark, args, writer)
    elif args.job == "stream":
        start_triage(
            read_investigation_stream(spark, args.investigations),
            lambda: _payloads(spark, args),
            lambda: _endpoints(spark, args),
            args.out, args.ledger, args.checkpoint, args.days,
        ).awaitTermination()
    elif args.job == "arrivals":
        start_first_arrivals(
            read_investigation_stream(spark, args.investigations),
            args.payloads, args.days, args.out, args.checkpoint,
        ).awaitTermination()
    elif args.job == "land":
        start_landing(
            spark, args.objects, args.payloads, args.checkpoint, args.buckets, args.store
        ).awaitTermination()
    elif args.job == "pack":
        pack_payloads(spark, args.payloads)
    elif args.job == "states":
        start_endpoint_states(spark, args.endpoints, args.endpoint_states).awaitTermination()
    elif args.job == "newest":
        stream = read_investigation_stream(spark, args.investigations)
        start_newest(stream, args.newest).awaitTermination()
    elif args.job == "posted":
        record_posted(spark, spark.read.schema(POSTED).parquet(args.posted), args.ledger, writer)
    elif args.out:
        compact_ledger(spark, args.ledger, args.out)
    else:
        snapshot_ledger(spark, args.ledger)
        vacuum_ledger(spark, args.ledger)


if __name__ == "__main__":
    main()
