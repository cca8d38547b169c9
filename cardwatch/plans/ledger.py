"""What the warehouse remembers about its loads.

:class:`LoadLedger` has a row for each step of each feed file: ``started``
before its load, ``loaded`` once the load is committed (with the days it
wrote and the counts of what could not be read), and ``reported`` for the days
of a finished report.  Rows are appended one file at a time and never change.
Nothing else decides what is loaded or must be reported, so

* a feed that is sent again (same name, size, lines and content) is recognised;
* a load that died half-way is found by its ``started`` row, and made good with
  the ``skip`` policy against the whole fact;
* days whose load is committed and whose report is not are found again after a
  crash, wherever the feed file lies by then, and a late operation brings the
  day it belongs to.

:class:`KeyLedger` is the primary key of the fact as a table of its own: keys in
folders by hash.  A load reads the folders that its own keys fall into, not the
fact.  Each addition is logged before and after; one that died between the
fact's append and its own is made good from the days it named.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.sources.files import exists, size

LEDGER_SCHEMA = ("seq long, state string, feed string, file string, bytes long, lines long, content string, "
                 "days array<date>, rows long, bad_times long, bad_amounts long, wide_amounts long, rejected long, "
                 "at timestamp_ntz")
STARTED, LOADED, REPORTED = "started", "loaded", "reported"
COUNTS = ("rows", "bad_times", "bad_amounts", "wide_amounts", "rejected")


@dataclass(frozen=True)
class FeedLoad:
    """What became of one feed file."""

    feed: str
    file: str
    replayed: bool  # recognised: nothing was loaded again
    days: tuple[_dt.date, ...]  # days its rows belong to
    counts: dict[str, int]

    def __str__(self) -> str:
        what = "loaded before" if self.replayed else ", ".join(f"{k} {v}" for k, v in self.counts.items() if v or k == "rows")
        return f"{self.file}: {what}"


@dataclass
class LoadLedger:
    spark: SparkSession
    path: str

    def events(self) -> list:
        """All rows in order: a few short ones per feed file."""
        if not exists(self.spark, self.path):
            return []
        return sorted(self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path).collect(), key=lambda r: r.seq)

    def _append(self, state: str, **values) -> None:
        events = self.events()
        row = {"seq": events[-1].seq + 1 if events else 1, "state": state, "at": _dt.datetime.now(), **values}
        names = [part.split()[0] for part in LEDGER_SCHEMA.split(", ")]
        # one file in one commit
        (self.spark.createDataFrame([tuple(row.get(n) for n in names)], LEDGER_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.path))

    def fingerprint(self, path: str, parquet: bool = False) -> dict:
        """Name, size, number of lines and an order-free digest of the content
        (one narrow pass; the digest of a line counts as often as the line)."""
        lines = self.spark.read.parquet(path) if parquet else self.spark.read.text(path)
        digest = F.xxhash64(*[F.col(f"`{c}`") for c in lines.columns]).cast("decimal(38,0)")
        found = lines.agg(F.count(F.lit(1)).alias("n"), F.sum(digest).alias("d")).first()
        return {"file": path.rstrip("/").rsplit("/", 1)[-1], "bytes": size(self.spark, path), "lines": found.n, "content": str(found.d)}

    def load(self, feed: str, path: str, loader: Callable[[bool], dict], parquet: bool = False) -> FeedLoad:
        """Run ``loader`` unless this very file is loaded already.  It is told
        whether an earlier try died half-way, and returns ``days`` and counts."""
        own = {"feed": feed, **self.fingerprint(path, parquet)}
        same = [e for e in self.events() if e.state != REPORTED and all(e[k] == v for k, v in own.items())]
        done = [e for e in same if e.state == LOADED]
        if done:
            return FeedLoad(feed, own["file"], True, tuple(done[-1].days or ()), {k: done[-1][k] or 0 for k in COUNTS})
        if not same:
            self._append(STARTED, **own)
        found = loader(bool(same))
        days, counts = sorted(found.get("days", ())), {k: int(found.get(k, 0)) for k in COUNTS}
        self._append(LOADED, **own, days=days, **counts)
        return FeedLoad(feed, own["file"], False, tuple(days), counts)

    def pending_days(self) -> list[_dt.date]:
        """Days that loads wrote to and no later report covers."""
        pending: set[_dt.date] = set()
        for e in self.events():
            if e.state == LOADED:
                pending.update(e.days or ())
            elif e.state == REPORTED:
                pending.difference_update(e.days or ())
        return sorted(pending)

    def mark_reported(self, days: list[_dt.date]) -> None:
        if days:
            self._append(REPORTED, days=sorted(days))


KEY_SCHEMA = "trans_id string, bucket int"
KEY_LOG_SCHEMA = "addition string, state string, days array<date>"


@dataclass
class KeyLedger:
    spark: SparkSession
    path: str
    key: str = "trans_id"
    buckets: int = 64

    @property
    def log_path(self) -> str:
        return f"{self.path}_log"

    def bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def keys(self, batch: DataFrame | None = None) -> DataFrame:
        """The keys held; with ``batch`` those in the folders that its keys
        fall into (their numbers, at most ``buckets``, reach the driver), so
        that no other folder is read."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], KEY_SCHEMA)
        held = self.spark.read.schema(KEY_SCHEMA).parquet(self.path)
        if batch is not None:
            touched = batch.where(F.col(self.key).isNotNull()).select(self.bucket().alias("b")).distinct().collect()
            held = held.where(F.col("bucket").isin([r.b for r in touched]))
        return held

    def add(self, batch: DataFrame) -> None:
        """Append the keys of ``batch`` that are not held yet."""
        own = batch.where(F.col(self.key).isNotNull()).select(F.col(self.key).cast("string").alias(self.key)).distinct()
        new = own.join(self.keys(own).select(self.key), self.key, "left_anti")
        (new.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
         .write.mode("append").partitionBy("bucket").parquet(self.path))

    def _log(self, addition: str, state: str, days: list[_dt.date | None]) -> None:
        (self.spark.createDataFrame([(addition, state, days)], KEY_LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.log_path))

    def begin(self, days: list[_dt.date | None]) -> str:
        """Logged before the fact's append: the days it will write to."""
        addition = uuid.uuid4().hex
        self._log(addition, "begun", days)
        return addition

    def end(self, addition: str) -> None:
        self._log(addition, "ended", [])

    def repair(self, fact: DataFrame) -> list[str]:
        """Make good the additions that did not end, from the days they named;
        a warehouse older than its ledger gives all its keys once."""
        if not exists(self.spark, self.log_path):
            first = self.begin([])
            self.add(fact)
            self.end(first)
            return []
        log = self.spark.read.schema(KEY_LOG_SCHEMA).parquet(self.log_path).collect()  # two short rows a load
        ended = {r.addition for r in log if r.state == "ended"}
        torn = [r for r in log if r.state == "begun" and r.addition not in ended]
        for r in torn:
            days = [d for d in r.days if d is not None]
            own = F.col("trans_day").isin(days) if days else F.lit(not r.days)
            self.add(fact.where(own | F.col("trans_day").isNull() if None in r.days else own))
            self.end(r.addition)
        return [r.addition for r in torn]
