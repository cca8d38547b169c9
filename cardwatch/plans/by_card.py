"""Tables bucketed by card (C1, R1, R2, R5): the rules run where the rows lie.

A copy of the fact's rule columns and the owners of all cards are kept in
tables bucketed by ``card_num``, so that neither the joins with suspect cards
nor the windows of the sequence rules move the fact:

* ``ops_by_card`` operations, partitioned by ``part`` (day and build) and
  bucketed by card, one file a bucket and part;
* ``ops_of_hot_cards`` the same columns without buckets, for (card, day) groups
  of about ``hot_rows`` rows or more: a bucket is read by one task, so a card
  with a third of all rows must not lie in one.  Their joins broadcast the few
  owners concerned (after a count) and their windows are split as ever;
* ``owners_by_card`` C1 for every card: the owner's report columns, document
  expiry and contract end, bucketed alike.

The copy follows the fact.  A day is built again when the file names of its
partition differ from those it was built from (the fact is append-only, and a
part file's name is unique).  Nothing is overwritten: each build has its own
partitions, and ``by_card_log`` (one row per day and build, appended after the
data as one file) says which of them readers take, so a build that died is
never seen.  ``remove_old_builds`` deletes what no reader takes.

Operations without a card have no owner and those without a time are on no day;
neither is copied.  A day without such operations has an empty build.  Owner rows repeat when the
dimensions do (they are key-guarded, K1).

``buckets`` must be at least the session's shuffle partitions: with fewer,
Spark prefers to exchange both sides for the sake of parallelism.  It is fixed
when the tables are made.  At 4,000 buckets a day of 300 GB has files of 75 MB.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.functions.expressions import day_of
from cardwatch.operators import rules as R
from cardwatch.operators.chain import cards_of_clients, owner_columns
from cardwatch.operators.sequences import HOT_ROWS, HotGroups, find_hot_groups, in_hot_group
from cardwatch.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded
from cardwatch.plans.daily import RULE_COLUMNS, operations
from cardwatch.plans.warehouse import Warehouse
from cardwatch.sources.files import exists, names, remove

OPS, HOT_OPS, OWNERS, LOG = "ops_by_card", "ops_of_hot_cards", "owners_by_card", "by_card_log"
LOG_SCHEMA = "build int, day date, files string"  # the owners' rows have no day
OWNER_COLUMNS = ["card_num", "client_id", "passport_num", "fio", "phone", "passport_valid_to", "account_valid_to"]
_DIMENSIONS = ("clients", "accounts", "cards")


@dataclass
class CardTables:
    wh: Warehouse
    buckets: int
    database: str = "cardwatch_by_card"
    hot_rows: int = HOT_ROWS

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    # -- tables ----------------------------------------------------------------
    def create_tables(self) -> None:
        """Create the database and tables, or attach those that lie in the
        warehouse already (a new session, a new catalog)."""
        spark = self.wh.spark
        self.wh.ensure_tables()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.wh.path('_by_card')}'")
        types = {f.name: f.dataType.simpleString() for f in schemas.TRANSACTIONS.fields}
        ops = [f"{c} {types[c]}" for c in RULE_COLUMNS]
        days = {"passport_valid_to": "date", "account_valid_to": "date"}
        owners = [f"{c} {days.get(c, 'string')}" for c in OWNER_COLUMNS]
        layout = f"CLUSTERED BY (card_num) SORTED BY (card_num) INTO {self.buckets} BUCKETS"
        for table, columns, clustered in ((OPS, ops, layout), (HOT_OPS, ops, ""), (OWNERS, owners, layout)):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)}, part string) USING parquet "
                      f"PARTITIONED BY (part) {clustered} LOCATION '{self.wh.path(table)}'")
            if exists(spark, self.wh.path(table)):
                spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")

    def _log(self) -> list:
        """One short row per day and build."""
        if not exists(self.wh.spark, self.wh.path(LOG)):
            return []
        return sorted(self.wh.spark.read.schema(LOG_SCHEMA).parquet(self.wh.path(LOG)).collect(), key=lambda r: r.build)

    def _current(self) -> dict[_dt.date | None, tuple[int, str]]:
        """Day (None: the owners) -> its last finished build and the files it was built from."""
        return {r.day: (r.build, r.files) for r in self._log()}

    def _new_build(self) -> int:
        """A number that no build has used, finished or not."""
        folders = [n for t in (OPS, HOT_OPS, OWNERS) for n in names(self.wh.spark, self.wh.path(t)) if n.startswith("part=")]
        return max([0, *[r.build for r in self._log()], *[int(n.rsplit(".", 1)[1]) for n in folders]]) + 1

    def _publish(self, build: int, rows: list[tuple]) -> None:
        # one file in one commit
        (self.wh.spark.createDataFrame([(build, *r) for r in rows], LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.wh.path(LOG)))

    def _files(self, *folders: str) -> str:
        """A digest of the data files' names."""
        own = [n for f in folders for n in names(self.wh.spark, self.wh.path(f)) if not n.startswith(("_", "."))]
        return hashlib.sha256("\n".join(own).encode()).hexdigest()

    def _files_of_day(self, day: _dt.date) -> str:
        return self._files(f"transactions/trans_day={day}")

    # -- builds ------------------------------------------------------------------
    def stale_days(self) -> list[_dt.date]:
        """Days whose partition of the fact is not the one they were built from."""
        current = self._current()
        stored = [n.split("=", 1)[1] for n in names(self.wh.spark, self.wh.path("transactions")) if n.startswith("trans_day=")]
        days = [_dt.date.fromisoformat(d) for d in stored if not d.startswith("__")]  # but the partition of no day
        return [d for d in days if current.get(d, (0, ""))[1] != self._files_of_day(d)]

    def refresh(self, days_per_job: int = 31) -> list[_dt.date]:
        """Build the owners if a dimension has changed, and every stale day.
        Returns the days built."""
        files = self._files(*_DIMENSIONS)
        if self._current().get(None, (0, ""))[1] != files:
            self._build_owners(files)
        days = self.stale_days()
        for at in range(0, len(days), days_per_job):
            self._build_days(days[at:at + days_per_job])
        return days

    def _build_owners(self, files: str) -> None:
        t, build = self.wh.table, self._new_build()
        owners = cards_of_clients(owner_columns(t("clients"), "passport_valid_to"), t("accounts"), t("cards"))
        (owners.select(*OWNER_COLUMNS, F.lit(f"all.{build}").alias("part")).repartition(self.buckets, "card_num")
         .write.insertInto(self.name(OWNERS)))
        self._publish(build, [(None, files)])

    def _build_days(self, days: list[_dt.date]) -> None:
        files, build = [self._files_of_day(d) for d in days], self._new_build()
        ops = operations(self.wh, days=days).where("trans_date IS NOT NULL AND card_num IS NOT NULL")
        hot = find_hot_groups(ops, "card_num", "trans_date", self.hot_rows)
        part = F.concat(day_of("trans_date").cast("string"), F.lit(f".{build}"))
        rows = ops.select(*RULE_COLUMNS, part.alias("part"))
        crowded = in_hot_group(hot, "card_num", "trans_date")
        # hash partitions and buckets agree: a task holds one bucket of all days
        (rows.where(~crowded).repartition(self.buckets, "card_num").write.insertInto(self.name(OPS)))
        if hot.hashes:
            rows.where(crowded).hint("rebalance", "part").write.insertInto(self.name(HOT_OPS))
        self._publish(build, [(d, f) for d, f in zip(days, files)])

    def remove_old_builds(self) -> list[str]:
        """Delete the partitions that no reader takes; returns their names."""
        taken, gone = {"all" if d is None else str(d): b for d, (b, _) in self._current().items()}, []
        for table in (OPS, HOT_OPS, OWNERS):
            for n in names(self.wh.spark, self.wh.path(table)):
                day, _, build = n.removeprefix("part=").rpartition(".")
                if n.startswith("part=") and taken.get(day) != int(build):
                    self.wh.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (part = '{day}.{build}')")
                    remove(self.wh.spark, f"{self.wh.path(table)}/{n}")
                    gone.append(f"{table}/{n}")
        return gone

    # -- reads -------------------------------------------------------------------
    def owners(self) -> DataFrame:
        """C1 for every card."""
        build = self._current().get(None, (0, ""))[0]
        return self.wh.spark.table(self.name(OWNERS)).where(F.col("part") == f"all.{build}").drop("part")

    def _ops(self, table: str, days: list[_dt.date] | None) -> DataFrame:
        parts = [f"{d}.{b}" for d, (b, _) in self._current().items() if d is not None and (days is None or d in days)]
        return self.wh.spark.table(self.name(table)).where(F.col("part").isin(parts)).drop("part")

    def operations(self, days: list[_dt.date] | None = None) -> DataFrame:
        """Operations outside hot groups, bucketed by card (of all built days, or of ``days``)."""
        return self._ops(OPS, days)

    def hot_operations(self, days: list[_dt.date] | None = None) -> DataFrame:
        return self._ops(HOT_OPS, days)

    # -- rules -------------------------------------------------------------------
    def _document_suspects(self) -> DataFrame:
        """The owners' table as suspects of R1 (``rules`` gives them from the dimensions)."""
        owners = self.owners()
        expired = owners.where("passport_valid_to IS NOT NULL").select(
            "*", F.lit(R.TAG_OVERDUE_PASSPORT).alias("event_type"), F.col("passport_valid_to").alias("_cutoff"))
        listed = (owners.join(self.wh.table("blacklist").select("passport_num"), "passport_num", "left_semi")
                  .select("*", F.lit(R.TAG_BLOCKED_PASSPORT).alias("event_type"), F.lit(None).cast("date").alias("_cutoff")))
        return expired.select(*R.SUSPECT_COLUMNS).unionByName(listed.select(*R.SUSPECT_COLUMNS))

    def _contract_suspects(self) -> DataFrame:
        return (self.owners().where("account_valid_to IS NOT NULL")
                .select("*", F.lit(R.TAG_OVERDUE_ACCOUNT).alias("event_type"), F.col("account_valid_to").alias("_cutoff"))
                .select(*R.SUSPECT_COLUMNS))

    def _on_suspects(self, suspects: DataFrame, days, max_broadcast_rows: int) -> DataFrame:
        hot = self.hot_operations(days)
        own = suspects.join(hot.select("card_num").distinct(), "card_num", "left_semi")
        return (R.ops_on_suspect_cards(self.operations(days), suspects, None)
                .unionByName(R.ops_on_suspect_cards(hot, broadcast_if_bounded(own, max_broadcast_rows), None)))

    def bad_document_ops(self, days=None, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
        """R1 over the built days."""
        return self._on_suspects(self._document_suspects(), days, max_broadcast_rows)

    def lapsed_contract_ops(self, days=None, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
        """R2 over the built days: both sides are bucketed, neither moves."""
        return self._on_suspects(self._contract_suspects(), days, max_broadcast_rows)

    def report(self, days=None, terminal_join: str = "as_of", max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
        """R5 over the built days.  A (card, day) group lies wholly in one of
        the two tables, so the sequence rules run on each by itself."""
        history = self.wh.history()
        found = []
        for ops in (self.operations(days), self.hot_operations(days)):
            hot = HotGroups(()) if not found else find_hot_groups(ops, "card_num", "trans_date", self.hot_rows)
            # all_versions multiplies rows by its join, and searches again after it
            found.append(R.city_switch_findings(ops, history, terminal_join=terminal_join, max_broadcast_rows=max_broadcast_rows,
                                                hot_rows=self.hot_rows, hot=hot if terminal_join == "as_of" else None))
            found.append(R.amount_guessing_findings(ops, hot_rows=self.hot_rows, hot=hot))
        sequences = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
        suspects = self._document_suspects().unionByName(self._contract_suspects())
        return (self._on_suspects(suspects, days, max_broadcast_rows)
                .unionByName(R.to_report(sequences.join(self.owners(), "card_num"))))
