"""Command line: one daily run, as the reference's driver does.

    python -m cardwatch --warehouse PATH --feeds PATH --date DDMMYYYY [--seed DIR] [--archive DIR]
    python -m cardwatch --warehouse PATH --start 2021-03-01 --end 2021-03-31

Creates missing tables, loads seed dimensions once (``clients``,
``accounts``, ``cards`` as ``.csv`` or ``.parquet`` in ``--seed``; replays
are skipped by key), loads the day's feeds that are present, runs the four
rules and prints that day's report, and that of every other day that a load
wrote to and no report covers yet (late operations, a run that died).  With
``--archive`` every new feed in the folder is ingested and moved to the
archive.  What each load could not read is printed.  The whole report is printed; ``--rows`` limits it and says how many
rows were left out.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.plans import daily
from cardwatch.plans.ledger import COUNTS, LOADED
from cardwatch.plans.report import read_report
from cardwatch.plans.warehouse import Warehouse
from cardwatch.session import build_session
from cardwatch.sources.feeds import feed_present, read_dimension

SEEDS = {"clients": (schemas.CLIENTS, "client_id"), "accounts": (schemas.ACCOUNTS, "account_num"),
         "cards": (schemas.CARDS, "card_num")}


def load_seeds(wh: Warehouse, folder: str) -> list[str]:
    loaded = []
    for name, (schema, key) in SEEDS.items():
        for ext in ("csv", "parquet"):
            path = f"{folder.rstrip('/')}/{name}.{ext}"
            if feed_present(wh.spark, path):
                wh.load_dimension(name, read_dimension(wh.spark, path, schema, ext), key, key_policy="skip")
                loaded.append(name)
                break
    return loaded


def ingest_with_archive(wh: Warehouse, feed_dir: str, archive_dir: str, as_of=None,
                        history_mode: str = "reference") -> None:
    """Load every new feed file (blacklist, terminals, transactions) and
    archive it, each stream stopping after its backlog."""
    from cardwatch.streaming.ingest import ingest_blacklist, ingest_terminals, ingest_transactions
    ckpt = wh.path("_ingest")
    ingest_blacklist(wh, feed_dir, f"{ckpt}/blacklist", archive_dir).awaitTermination()
    ingest_terminals(wh, feed_dir, f"{ckpt}/terminals", archive_dir, mode=history_mode,
                     as_of=as_of).awaitTermination()
    ingest_transactions(wh, feed_dir, f"{ckpt}/transactions", archive_dir).awaitTermination()


def print_loads(events: list) -> None:
    """One line per feed file loaded, with what could not be read."""
    for e in events:
        if e.state == LOADED:
            print(f"{e.file}: " + ", ".join(f"{k} {e[k]}" for k in COUNTS if k == "rows" or e[k]))


def print_report(report, rows: int | None = None) -> None:
    """Print the report in order, streamed to the driver partition by
    partition; with ``rows`` only that many, and how many were left out."""
    ordered = report.orderBy("event_dt", "event_type", "passport")
    print(" | ".join(report.columns))
    shown = 0
    for r in (ordered if rows is None else ordered.limit(rows)).toLocalIterator():
        print(" | ".join("" if v is None else str(v) for v in r))
        shown += 1
    left = 0 if rows is None else report.count() - shown
    print(f"({shown} rows" + (f", {left} more not shown)" if left else ")"))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cardwatch", description=__doc__.splitlines()[0])
    ap.add_argument("--warehouse", required=True, help="warehouse root on a shared file system")
    ap.add_argument("--feeds", help="folder with <kind>_DDMMYYYY feeds")
    ap.add_argument("--date", help="run day, DDMMYYYY or YYYY-MM-DD")
    ap.add_argument("--start", help="first day of a backfill range (rules only, with --end)")
    ap.add_argument("--end", help="last day of a backfill range")
    ap.add_argument("--key-policy", default="fail", choices=["fail", "skip"],
                    help="repeated transaction ids: fail (primary key) or skip (safe rerun)")
    ap.add_argument("--seed", help="folder with clients/accounts/cards seed files")
    ap.add_argument("--archive", help="ingest every new feed in --feeds through the streaming jobs and "
                                      "move consumed files here (checkpoints under the warehouse)")
    ap.add_argument("--as-of", help="load time for terminal versions (default: the start of each feed's day)")
    ap.add_argument("--terminal-join", default="as_of", choices=["as_of", "all_versions"],
                    help="R3: join the terminal version valid at the operation time, or every version")
    ap.add_argument("--history-mode", default="reference", choices=["reference", "clean"],
                    help="L10: keep the reference's open tombstone on return, or close it")
    ap.add_argument("--master", help="Spark master (default: from spark-submit)")
    ap.add_argument("--rows", type=int, help="print at most this many report rows (default: all)")
    ap.add_argument("--all", action="store_true", help="print the whole report table, not only this run's days")
    args = ap.parse_args(argv)
    if not args.date and not (args.start and args.end):
        ap.error("give --date, or --start and --end")

    spark = build_session(args.master)
    wh = Warehouse(spark, args.warehouse)
    wh.ensure_tables()
    if args.seed:
        load_seeds(wh, args.seed)
    feeds = daily.FeedFolder(args.feeds) if args.feeds else None
    before = len(wh.ledger.events())
    if feeds is not None and args.archive:
        ingest_with_archive(wh, args.feeds, args.archive, args.as_of, args.history_mode)
        feeds = None
    if args.date:
        day = daily.as_date(args.date)
        daily.run_day(wh, day, feeds, as_of=args.as_of, terminal_join=args.terminal_join, key_policy=args.key_policy,
                      history_mode=args.history_mode)
        days = sorted({day, *daily.report_touched(wh, args.terminal_join)})
        report = read_report(wh).where(F.col("event_day").isin(days))
    else:
        report = daily.run_range(wh, args.start, args.end, terminal_join=args.terminal_join)
    print_loads(wh.ledger.events()[before:])
    if args.all:
        report = read_report(wh)
    print_report(report, args.rows)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
