"""Warehouse tables on a shared file system.

Layout under ``root`` (all parquet, explicit schemas on read):

* ``transactions/trans_day=YYYY-MM-DD/`` fact, partitioned by day so that a
  day's rules read one partition;
* ``blacklist/``, ``clients/``, ``accounts/``, ``cards/``;
* ``terminals_hist/version=N/state=open|closed/`` the type-2 history.
  Parquet has no UPDATE and a table cannot be overwritten while it is
  read, so each snapshot writes the next version: its open rows and the
  rows it closed.  ``terminals_hist_log/`` has one row per finished version
  (its load time, which version holds the last full history, and which
  states it wrote), appended as one file after the version's data.  Readers
  follow the log alone, so a half-written version is never seen and a rerun
  writes it anew.
* ``report/event_day=YYYY-MM-DD/`` the fraud report (see ``report.py``);
* ``load_ledger/``, ``transactions_keys/`` what was loaded (see ``ledger.py``);
* ``rejects/feed=.../file=.../`` malformed feed lines as they stood.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardwatch import schemas
from cardwatch.functions.expressions import day_of, open_end, ts_ntz
from cardwatch.operators import history as H
from cardwatch.operators.keys import guard_unique, insert_if_absent
from cardwatch.plans.ledger import KeyLedger, LoadLedger
from cardwatch.sources.feeds import transactions_from_feed
from cardwatch.sources.files import exists, names, remove

TABLES: dict[str, tuple[StructType, list[str]]] = {
    "transactions": (schemas.TRANSACTIONS, ["trans_day"]),
    "blacklist": (schemas.BLACKLIST, []),
    "clients": (schemas.CLIENTS, []),
    "accounts": (schemas.ACCOUNTS, []),
    "cards": (schemas.CARDS, []),
    "report": (schemas.REPORT, ["event_day"]),
}
HISTORY = "terminals_hist"
KEYS, LEDGER, REJECTS = "transactions_keys", "load_ledger", "rejects"
REJECTS_SCHEMA = "line string, reason string, fields_found int, fields_expected int, feed string, file string"

# SQL view names, as users of the reference's tables know them.
SQL_VIEW_NAMES = {
    "transactions": "dwh_fact_transactions",
    "blacklist": "dwh_fact_passport_blacklist",
    "clients": "dwh_dim_clients",
    "accounts": "dwh_dim_accounts",
    "cards": "dwh_dim_cards",
    "report": "rep_fraud",
}
HISTORY_VIEW_NAME = "dwh_dim_terminals_hist"
HISTORY_LOG = "terminals_hist_log"
HISTORY_LOG_SCHEMA = "version int, base int, as_of timestamp_ntz, states string"
OPEN, CLOSED = "open", "closed"


class SnapshotOrderError(ValueError):
    """A snapshot older than the last one applied."""


@dataclass(frozen=True)
class HistoryVersion:
    """One finished version of the terminal history."""

    version: int
    base: int  # the last version that holds closed rows of a whole history
    as_of: _dt.datetime | None
    states: tuple[str, ...]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (missing columns become NULL).

    ``try_cast``: a value that does not fit becomes NULL, as in the feed
    parsers, instead of failing the load."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
                       for f in schema.fields])


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # -- T1 ------------------------------------------------------------------
    def ensure_tables(self) -> None:
        """Create every table that does not exist yet (empty, typed)."""
        for name, (schema, parts) in TABLES.items():
            if not exists(self.spark, self.path(name)):
                w = self.spark.createDataFrame([], schema).write.mode("overwrite")
                (w.partitionBy(*parts) if parts else w).parquet(self.path(name))
        if not exists(self.spark, self.path(HISTORY_LOG)):
            self.spark.createDataFrame([], HISTORY_LOG_SCHEMA).write.mode("append").parquet(self.path(HISTORY_LOG))

    @property
    def ledger(self) -> LoadLedger:
        return LoadLedger(self.spark, self.path(LEDGER))

    @property
    def key_ledger(self) -> KeyLedger:
        return KeyLedger(self.spark, self.path(KEYS))

    def register_views(self, prefix: str = "") -> None:
        """Expose every table (and the current history) to ``spark.sql`` as
        temporary views named like the reference's tables."""
        for name, view in SQL_VIEW_NAMES.items():
            self.table(name).createOrReplaceTempView(prefix + view)
        self.history().createOrReplaceTempView(prefix + HISTORY_VIEW_NAME)

    def table(self, name: str) -> DataFrame:
        """A warehouse table; an empty typed frame if it was never written
        (tables also appear on their first write)."""
        schema, _ = TABLES[name]
        df = (self.spark.read.schema(schema).parquet(self.path(name)) if exists(self.spark, self.path(name))
              else self.spark.createDataFrame([], schema))
        if name == "report":
            df = df.where(~F.coalesce(F.col("placeholder"), F.lit(False))).drop("placeholder")
        return df

    # -- history versions ----------------------------------------------------
    # terminals_hist/version=N/state=open    every row still open after N
    # terminals_hist/version=N/state=closed  rows that snapshot N closed; of a
    #                                        base version, all its closed rows
    # Closed rows never change again, so a snapshot writes its open rows and
    # its closures only.  History at N = open rows of N, plus the closed rows
    # of every version from the last base on.
    def history_log(self) -> list[HistoryVersion]:
        """The finished versions in order (one short row each)."""
        if not exists(self.spark, self.path(HISTORY_LOG)):
            return []
        rows = self.spark.read.schema(HISTORY_LOG_SCHEMA).parquet(self.path(HISTORY_LOG)).collect()
        return [HistoryVersion(r.version, r.base, r.as_of, tuple(r.states.split(",")) if r.states else ())
                for r in sorted(rows, key=lambda r: r.version)]

    def history_version(self) -> int:
        """The last finished history version (0 for a new, empty history)."""
        log = self.history_log()
        return log[-1].version if log else 0

    def _history_rows(self, folders: list[str]) -> DataFrame:
        """Rows of the named version folders, and no listing of any other."""
        if not folders:
            return self.spark.createDataFrame([], schemas.TERMINALS_HIST)
        return self.spark.read.schema(schemas.TERMINALS_HIST).parquet(*folders)

    def _folder(self, version: int, state: str | None = None) -> str:
        folder = f"{self.path(HISTORY)}/version={version}"
        return folder if state is None else f"{folder}/state={state}"

    def history(self) -> DataFrame:
        """The full type-2 history at the current version."""
        log = self.history_log()
        last = log[-1:]
        folders = [self._folder(e.version, OPEN) for e in last if OPEN in e.states]
        folders += [self._folder(e.version, CLOSED) for e in log if CLOSED in e.states and e.version >= last[0].base]
        return self._history_rows(folders)

    def open_history(self) -> DataFrame:
        """Rows still open at the current version (what a snapshot can change)."""
        return self._history_rows([self._folder(e.version, OPEN) for e in self.history_log()[-1:] if OPEN in e.states])

    def replace_history(self, history: DataFrame, as_of=None) -> int:
        """Write an existing type-2 history (e.g. migrated from another
        store) as the next version and new base; returns that version."""
        version = self.history_version() + 1
        self._write_version(history, version, version, as_of)
        return version

    def compact_history(self) -> int:
        """Rewrite the current history as one new base version, so readers
        no longer gather the closed rows of every earlier version (run now
        and then, e.g. monthly).  Returns the new version."""
        log = self.history_log()
        return self.replace_history(self.history(), log[-1].as_of if log else None)

    def remove_old_versions(self) -> list[int]:
        """Delete the data of versions before the current base; no reader of
        the current version needs them.  Returns those deleted."""
        log = self.history_log()
        if not log:
            return []
        stored = [int(n.split("=")[1]) for n in names(self.spark, self.path(HISTORY)) if n.startswith("version=")]
        old = [v for v in stored if v < log[-1].base]
        for v in old:
            remove(self.spark, self._folder(v))
        return sorted(old)

    def _write_version(self, df: DataFrame, version: int, base: int, as_of) -> None:
        state = F.when(F.col(H.TO) == open_end(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
        (conform(df, schemas.TERMINALS_HIST).withColumn("state", state)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("state")
         .parquet(self._folder(version)))
        states = [s for s in (OPEN, CLOSED) if exists(self.spark, self._folder(version, s))]
        # published last: one file in one commit
        (self.spark.createDataFrame([(version, base, as_of, ",".join(states))], HISTORY_LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.path(HISTORY_LOG)))

    # -- loads -----------------------------------------------------------------
    def append_transactions(self, feed: DataFrame, key_policy: str = "fail", key_scope: str = "ledger") -> dict:
        """T2 + K1: rename feed columns, type them, guard ``trans_id`` against
        the batch and the loaded fact, append into day partitions.

        Returns counts of the rows written and of the values among them that
        could not be read, ``rows``, ``bad_times``, ``bad_amounts`` and
        ``wide_amounts`` (taken while writing; such values are NULL, their rows
        are kept), and ``days``, the days of the batch.

        ``key_scope='ledger'`` checks the key ledger: the whole fact's keys, of
        which only the folders are read that the batch's keys fall into.
        ``'all'`` checks the ``trans_id`` column of every day, ``'same_days'``
        the day partitions the batch writes to: the semi join on ``trans_day``
        lets dynamic partition pruning skip every other day."""
        flags = [c for c in ("bad_time", "bad_amount", "wide_amount") if c in feed.columns]
        facts = transactions_from_feed(feed, *flags).withColumn("trans_day", day_of("trans_date"))
        facts = conform(facts, StructType([f for f in facts.schema.fields if f.name in flags] + schemas.TRANSACTIONS.fields))
        # the guard and the writes read the batch several times; its text is parsed once
        facts = facts.persist(StorageLevel.MEMORY_AND_DISK)
        ledger, loaded = self.key_ledger, self.table("transactions").select("trans_id", "trans_day")
        seen = Observation()
        counted = [F.count(F.lit(1)).alias("rows")] + [F.count_if(f).alias(f"{f}s") for f in flags]
        try:
            days = [r.trans_day for r in facts.select("trans_day").distinct().collect()]  # a row a day
            ledger.repair(loaded)
            if key_scope == "ledger":
                target = ledger.keys(facts)
            elif key_scope == "same_days":
                # Null-safe: rows with an unparsable time sit in the NULL day partition.
                own = facts.select(F.col("trans_day").alias("_day")).distinct()
                target = loaded.join(own, loaded["trans_day"].eqNullSafe(own["_day"]), "left_semi")
            elif key_scope == "all":
                target = loaded
            else:
                raise ValueError(f"unknown key_scope {key_scope!r}")
            guarded = guard_unique(facts, target.select("trans_id"), ["trans_id"], key_policy)
            addition = ledger.begin(days)
            # a day's rows lie together before they are written; large days are split, small ones merged
            (guarded.observe(seen, *counted).drop(*flags).hint("rebalance", "trans_day")
             .write.mode("append").partitionBy("trans_day").parquet(self.path("transactions")))
            ledger.add(facts)
            ledger.end(addition)
        finally:
            facts.unpersist()
        try:
            found = seen.get
        except Py4JJavaError:  # nothing to write: the optimizer dropped the plan and its counters
            found = {"rows": 0}
        return {"bad_times": 0, "bad_amounts": 0, "wide_amounts": 0, **found, "days": sorted(d for d in days if d is not None)}

    def keep_rejects(self, feed: str, file: str, rejected: DataFrame) -> int:
        """Write a file's malformed lines to the quarantine (a repeated load
        replaces them); returns how many."""
        n = rejected.count()
        if n:
            (rejected.select("line", "reason", "fields_found", "fields_expected", F.lit(feed).alias("feed"), F.lit(file).alias("file"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feed", "file").parquet(self.path(REJECTS)))
        return n

    def rejects(self) -> DataFrame:
        """The quarantine: malformed lines with their feed, file and reason."""
        if not exists(self.spark, self.path(REJECTS)):
            return self.spark.createDataFrame([], REJECTS_SCHEMA)
        return self.spark.read.schema(REJECTS_SCHEMA).parquet(self.path(REJECTS))

    def load_blacklist(self, feed: DataFrame, null_keys: str = "reference") -> None:
        """L1: append feed documents not yet listed (``NOT IN`` semantics)."""
        added = insert_if_absent(conform(feed, schemas.BLACKLIST), self.table("blacklist"),
                                 "passport_num", null_keys=null_keys)
        added.write.mode("append").parquet(self.path("blacklist"))

    def load_dimension(self, name: str, rows: DataFrame, key: str, key_policy: str = "skip") -> None:
        """S5 + K1: append dimension rows whose key is new."""
        schema, _ = TABLES[name]
        fresh = guard_unique(conform(rows, schema), self.table(name).select(key), [key], key_policy)
        fresh.write.mode("append").parquet(self.path(name))

    def load_terminals(self, snapshot: DataFrame, as_of, mode: str = "reference",
                       null_keys: str = "reference", null_safe: bool = False,
                       initial_start: str = "1900-01-01 00:00:00") -> int:
        """Apply a full snapshot at ``as_of``; returns the current version
        (unchanged when the snapshot changes nothing).

        Only the open rows are read and rewritten: a snapshot cannot change a
        closed row, and with snapshots applied in ``as_of`` order no closed
        row is active at ``as_of``.  An ``as_of`` before the last one is
        therefore refused.  The version's closures are written beside its
        open rows.

        In ``clean`` mode the first snapshot (empty history) opens its
        versions at ``initial_start`` rather than at the load time, so that
        as-of joins can place operations made before the first load."""
        log = self.history_log()
        current = log[-1].version if log else 0
        if mode == "clean" and current == 0:
            as_of = initial_start
        as_of = self._moment(as_of)
        if log and log[-1].as_of is not None and as_of < log[-1].as_of:
            raise SnapshotOrderError(f"snapshot of {as_of} after one of {log[-1].as_of}")
        opened = conform(self.open_history(), schemas.TERMINALS_HIST)
        snap = conform(snapshot, schemas.TERMINALS_HIST).select(H.KEY, *H.ATTRS)
        # An unchanged snapshot (the usual day, or a replayed file) writes no version.
        if current > 0 and H.snapshot_diff(snap, H.active_versions(opened, as_of), null_keys=null_keys,
                                           null_safe=null_safe).isEmpty():
            return current
        applied = H.scd2_apply(opened, snap, as_of, mode=mode, null_keys=null_keys, null_safe=null_safe)
        # the first version is its own base
        self._write_version(applied, current + 1, log[-1].base if log else 1, as_of)
        return current + 1

    def load_terminal_series(self, snapshots: DataFrame, times: list[_dt.datetime], at: str = "as_of",
                             mode: str = "reference", null_safe: bool = False) -> int:
        """L10 for a backlog: the snapshots of all ``times`` (ascending) in one
        plan and one version (see :func:`history.scd2_apply_series`)."""
        log = self.history_log()
        times = [self._moment(t) for t in times]
        if not times:
            return log[-1].version if log else 0
        if log and log[-1].as_of is not None and times[0] < log[-1].as_of:
            raise SnapshotOrderError(f"snapshot of {times[0]} after one of {log[-1].as_of}")
        version = log[-1].version + 1 if log else 1
        if mode == "clean" and not log:  # as in load_terminals
            start = self._moment("1900-01-01 00:00:00")
            snapshots = snapshots.withColumn(at, F.when(ts_ntz(F.col(at)) == ts_ntz(times[0]), ts_ntz(start)).otherwise(F.col(at)))
            times = [start, *times[1:]]
        applied = H.scd2_apply_series(conform(self.open_history(), schemas.TERMINALS_HIST), snapshots, times, at,
                                      mode=mode, null_safe=null_safe)
        self._write_version(applied, version, log[-1].base if log else 1, times[-1])
        return version

    def _moment(self, as_of) -> _dt.datetime:
        if isinstance(as_of, _dt.datetime):
            return as_of
        return self.spark.range(1).select((as_of if isinstance(as_of, Column) else ts_ntz(as_of)).alias("t")).first().t
