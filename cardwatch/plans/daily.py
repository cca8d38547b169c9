"""Daily run and range backfill (the reference's main flow).

``run_day``: load the day's feeds that are present (each may be absent),
run the four rules for that day, replace the day's report partition.
``report_touched``: the same rules for every day that loads wrote to since it
was reported last.
``run_range``: run the rules for many days together (windows keyed by
card and day, so the result equals one run per day) and replace the report
of every day in the range.  Both shuffle the operations once, by card, and
keep that slice while the four rules run.
"""

from __future__ import annotations

import datetime as _dt
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.functions.expressions import date_lit, ts_ntz
from cardwatch.operators.rules import fraud_report
from cardwatch.operators.sequences import HotGroups, find_hot_groups
from cardwatch.plans.ledger import FeedLoad
from cardwatch.plans.report import read_report, write_day, write_days
from cardwatch.plans.warehouse import Warehouse
from cardwatch.sources.feeds import (
    feed_day_of,
    feed_present,
    parse_run_date,
    read_blacklist_feed,
    read_terminal_snapshot,
    read_transactions_feed,
    rejected_lines,
)
from cardwatch.sources.files import move, names


def as_date(day: _dt.date | str) -> _dt.date:
    if isinstance(day, _dt.date):
        return day
    text = str(day)
    return parse_run_date(text) if len(text) == 8 and text.isdigit() else _dt.date.fromisoformat(text)


# Feed file name prefixes (``<prefix>_DDMMYYYY.<ext>``).
TRANSACTIONS_PREFIX = "transactions"
BLACKLIST_PREFIX = "passport_blacklist"
TERMINALS_PREFIX = "terminals"


@dataclass
class FeedFolder:
    """Feeds named ``<kind>_DDMMYYYY.<ext>`` in one folder."""

    folder: str
    transactions_ext: str = "txt"
    blacklist_ext: str = "csv"
    terminals_ext: str = "csv"

    def _p(self, kind: str, day: _dt.date, ext: str) -> str:
        return f"{self.folder.rstrip('/')}/{kind}_{day.strftime('%d%m%Y')}.{ext}"

    def transactions(self, day: _dt.date) -> str:
        return self._p(TRANSACTIONS_PREFIX, day, self.transactions_ext)

    def blacklist(self, day: _dt.date) -> str:
        return self._p(BLACKLIST_PREFIX, day, self.blacklist_ext)

    def terminals(self, day: _dt.date) -> str:
        return self._p(TERMINALS_PREFIX, day, self.terminals_ext)


    def days(self, spark: SparkSession) -> list[_dt.date]:
        """Days that have a feed of any kind in the folder."""
        kinds = (TRANSACTIONS_PREFIX, BLACKLIST_PREFIX, TERMINALS_PREFIX)
        found = {feed_day_of(n) for n in names(spark, self.folder) if n.startswith(kinds)}
        return sorted(d for d in found if d is not None)


#: Suffix of archived feeds (fixed value).
ARCHIVED = ".backup"


def day_start(day: _dt.date) -> _dt.datetime:
    """When a day's terminal snapshot takes effect: the day's first moment,
    so that the as-of join places that day's operations."""
    return _dt.datetime.combine(day, _dt.time())


#: The feeds' columns, by kind.
FEED_SCHEMAS = {"transactions": schemas.TRANSACTIONS_FEED, "blacklist": schemas.BLACKLIST_FEED, "terminals": schemas.TERMINALS_FEED}


def load_feed(wh: Warehouse, kind: str, path: str, day: _dt.date | None, as_of=None, key_policy: str = "fail",
              history_mode: str = "reference", fmt: str | None = None) -> FeedLoad:
    """Load one feed file through the load ledger; its malformed lines go to
    the quarantine.  A blacklist or terminal feed touches its own ``day``."""
    spark = wh.spark

    def load(torn: bool) -> dict:
        rejected = wh.keep_rejects(kind, path.rsplit("/", 1)[-1], rejected_lines(spark, path, FEED_SCHEMAS[kind], fmt))
        if kind == "transactions":
            # after a try that died, rows that it did write are there already
            found = wh.append_transactions(read_transactions_feed(spark, path, fmt or "csv"), "skip" if torn else key_policy,
                                           "all" if torn else "ledger")
        else:
            if kind == "blacklist":
                wh.load_blacklist(read_blacklist_feed(spark, path, fmt))
            else:
                wh.load_terminals(read_terminal_snapshot(spark, path, fmt), as_of if as_of is not None else day_start(day),
                                  mode=history_mode)
            found = {"days": [day] if day is not None else []}
        return {**found, "rejected": rejected}

    return wh.ledger.load(kind, path, load, parquet=path.rstrip("/").endswith(".parquet"))


def load_feeds(wh: Warehouse, day: _dt.date, feeds: FeedFolder, as_of=None, key_policy: str = "fail",
               history_mode: str = "reference", archive: str | None = None) -> dict[str, FeedLoad | None]:
    """Load each present feed of ``day``; what became of each (None: absent).

    A feed that is loaded already is recognised and not loaded again.
    Terminal versions start at ``as_of``, by default the start of ``day``.
    With ``archive`` each feed is moved there once its load is committed."""
    paths = {"transactions": feeds.transactions(day), "blacklist": feeds.blacklist(day), "terminals": feeds.terminals(day)}
    loaded: dict[str, FeedLoad | None] = {}
    for kind, path in paths.items():
        loaded[kind] = None
        if feed_present(wh.spark, path):
            loaded[kind] = load_feed(wh, kind, path, day, as_of, key_policy, history_mode)
            if archive:
                move(wh.spark, path, archive, ARCHIVED)
    return loaded


def load_terminal_backlog(wh: Warehouse, days: list[_dt.date], feeds: FeedFolder, mode: str = "reference") -> int:
    """All present terminal snapshots of ``days`` as one version, each valid
    from its day's start; a header-only file is an empty snapshot."""
    paths = [(d, feeds.terminals(d)) for d in sorted(days) if feed_present(wh.spark, feeds.terminals(d))]
    if not paths:
        return wh.history_version()
    rows = reduce(DataFrame.unionByName, [read_terminal_snapshot(wh.spark, p).withColumn("as_of", ts_ntz(day_start(d)))
                                          for d, p in paths])
    return wh.load_terminal_series(rows, [day_start(d) for d, _ in paths], mode=mode)


# Columns of the fact that the four rules read.
RULE_COLUMNS = ["trans_id", "trans_date", "amt", "card_num", "oper_result", "terminal"]


def operations(wh: Warehouse, day: _dt.date | str | None = None, start: _dt.date | str | None = None,
               end: _dt.date | str | None = None, days: list[_dt.date] | None = None) -> DataFrame:
    """The fact's rule columns for one day, for ``[start, end]`` or for the
    listed ``days`` (partition-pruned)."""
    txn = wh.table("transactions")
    if days is not None:
        txn = txn.where(F.col("trans_day").isin(days))
    elif day is not None:
        txn = txn.where(F.col("trans_day") == date_lit(as_date(day)))
    else:
        if start is not None:
            txn = txn.where(F.col("trans_day") >= date_lit(as_date(start)))
        if end is not None:
            txn = txn.where(F.col("trans_day") <= date_lit(as_date(end)))
    return txn.select(*RULE_COLUMNS)


def day_report(wh: Warehouse, day: _dt.date | str | None, terminal_join: str = "as_of",
               start: _dt.date | str | None = None, end: _dt.date | str | None = None,
               transactions: DataFrame | None = None, hot: HotGroups | None = None) -> DataFrame:
    """R5 over the warehouse tables, for one day or for ``[start, end]``."""
    txn = transactions if transactions is not None else operations(wh, day, start, end)
    # Clients are loaded through the key guard (K1): one row per client.
    return fraud_report(txn, wh.history(), wh.table("clients"), wh.table("accounts"), wh.table("cards"),
                        wh.table("blacklist"), None if day is None else as_date(day), terminal_join,
                        clients_unique=True, hot=hot)


@contextmanager
def cached_operations(wh: Warehouse, day=None, start=None, end=None, days=None):
    """Yields the operations and their hot groups for one report.

    The rules read the operations three times (R1+R2 join, R3, R4).  Without
    a hot group they are repartitioned by card once and kept, so that both
    windows run where the rows lie: the fact is shuffled a single time.  With
    hot groups each window deals its own buckets out, so they are kept as
    read.  The kept blocks lie in executor memory and on executors' disks;
    lost ones are recomputed from the parquet files, and all are released
    after the report."""
    # an operation without a card or a time is no finding of any rule
    ops = operations(wh, day, start, end, days).where("trans_date IS NOT NULL AND card_num IS NOT NULL")
    hot = find_hot_groups(ops, "card_num", "trans_date")
    if not hot.hashes:
        ops = ops.repartition("card_num")
    ops = ops.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield ops, hot
    finally:
        ops.unpersist()


def run_day(wh: Warehouse, day: _dt.date | str, feeds: FeedFolder | None = None, as_of=None,
            terminal_join: str = "as_of", key_policy: str = "fail", report_dt=None,
            history_mode: str = "reference", archive: str | None = None) -> DataFrame:
    """One daily run; returns that day's report (lazy read of the table)."""
    d = as_date(day)
    wh.ensure_tables()
    if feeds is not None:
        load_feeds(wh, d, feeds, as_of, key_policy, history_mode, archive)
    with cached_operations(wh, day=d) as (ops, hot):
        write_day(wh, day_report(wh, d, terminal_join, transactions=ops, hot=hot), d, report_dt)
    if d in wh.ledger.pending_days():
        wh.ledger.mark_reported([d])
    return read_report(wh, d)


def report_touched(wh: Warehouse, terminal_join: str = "as_of", report_dt=None, days_per_job: int = 31) -> list[_dt.date]:
    """Report every day that a load wrote to and no report covers yet: the
    days of late operations, and those of a run that died.  Only their
    partitions are rewritten.  Returns the days."""
    wh.ensure_tables()
    days = wh.ledger.pending_days()
    for at in range(0, len(days), days_per_job):
        own = days[at:at + days_per_job]
        with cached_operations(wh, days=own) as (ops, hot):
            write_days(wh, day_report(wh, None, terminal_join, transactions=ops, hot=hot),
                       wh.spark.createDataFrame([(d,) for d in own], "event_day date"), report_dt)
        wh.ledger.mark_reported(own)
    return days


def run_range(wh: Warehouse, start: _dt.date | str, end: _dt.date | str, terminal_join: str = "as_of",
              report_dt=None, days_per_job: int = 31) -> DataFrame:
    """Rules for every day of ``[start, end]`` (no feed loading), in jobs of
    at most ``days_per_job`` days, so that what is kept while the rules run is
    bounded however long the range is.

    Every day of the range that has operations or earlier findings is
    replaced, so a rerun after a data fix also clears findings that no
    longer hold."""
    wh.ensure_tables()
    lo, hi = date_lit(as_date(start)), date_lit(as_date(end))
    fact_days = (wh.table("transactions").where(F.col("trans_day").between(lo, hi))
                 .select(F.col("trans_day").alias("event_day")))
    report_days = wh.table("report").where(F.col("event_day").between(lo, hi)).select("event_day")
    days = sorted(r[0] for r in fact_days.unionByName(report_days).distinct().collect())
    for at in range(0, len(days), days_per_job):
        own = days[at:at + days_per_job]
        with cached_operations(wh, start=own[0], end=own[-1]) as (ops, hot):
            write_days(wh, day_report(wh, None, terminal_join, own[0], own[-1], transactions=ops, hot=hot),
                       wh.spark.createDataFrame([(d,) for d in own], "event_day date"), report_dt)
        wh.ledger.mark_reported([d for d in wh.ledger.pending_days() if own[0] <= d <= own[-1]])
    return read_report(wh).where(F.col("event_day").between(lo, hi))
