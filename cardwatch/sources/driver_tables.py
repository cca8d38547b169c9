"""Bank-shaped views over the driver's test tables.

The reference ships no daily feeds, so its warehouse tables are derived from
the driver parquet (``events``, ``customer``, ``supplier``, ``nation``) by
fixed column expressions.  The same expressions are repeated as SQL in the
DuckDB oracle (``__spark_entry__.oracle_sql``).  Everything here is a lazy
projection/filter over a parquet scan, so column pruning and predicate
pushdown reach the files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.expressions import OPEN_END, REJECT, SUCCESS, micros_since_day_start, ts_ntz

# Fixed values of the fixture (dates that define expiry and history).
BASE_DAY = "2024-01-01"
HISTORY_START = "2023-01-01 00:00:00"
VERSION1_END = "2024-01-14 23:59:59"
VERSION2_START = "2024-01-15 00:00:00"
SNAPSHOT_AS_OF = "2024-02-01 00:00:00"
REPORT_DAY = "2024-01-20"
SERIES_TIMES = ("2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00", "2024-02-05 00:00:00")


def _plus_days(n: Column) -> Column:
    return F.date_add(F.lit(BASE_DAY).cast("date"), n.cast("int"))


@dataclass
class DriverTables:
    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- facts -------------------------------------------------------------
    def transactions(self, strict: bool = False) -> DataFrame:
        """``events`` as the transactions fact.

        ``strict=True`` marks only purchases as SUCCESS (used for the amount
        guessing rule so that enough refused attempts exist)."""
        e = self.raw("events")
        if strict:
            result = F.when(F.col("event_type") == "purchase", F.lit(SUCCESS)).otherwise(F.lit(REJECT))
        else:
            result = F.when(F.col("event_type") == "error", F.lit(REJECT)).otherwise(F.lit(SUCCESS))
        return e.select(
            F.col("event_id").alias("trans_id"),
            F.col("ts").alias("trans_date"),
            F.col("value").alias("amt"),
            F.col("user_id").alias("card_num"),
            F.col("event_type").alias("oper_type"),
            result.alias("oper_result"),
            (F.col("event_id") % 10).alias("terminal"),
        )

    def busy_transactions(self) -> DataFrame:
        """``events`` pressed onto 20 cards and the first hour of each day, so
        that cards have long dense sequences: some gaps below 20 minutes and
        some above, whole-second ties, and terminals of which many are
        unknown (300 numbers).  Only purchases succeed."""
        e = self.transactions(strict=True)
        second = (micros_since_day_start("trans_date") / 1_000_000).cast("long")
        when = F.date_trunc("DAY", "trans_date").cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.floor(second / 24).cast("decimal(18,6)"))
        return e.select("trans_id", when.alias("trans_date"), "amt", (F.col("card_num") % 20).alias("card_num"),
                        "oper_type", "oper_result", (F.col("trans_id") % 300).alias("terminal"))

    def feed_lines(self) -> DataFrame:
        """``events`` as lines of the transactions feed, with comma amounts;
        some times and amounts cannot be read."""
        e = self.transactions()
        cents = F.floor(F.col("amt") * 100).cast("long")
        amount = F.concat_ws(",", F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0"))
        return e.select(F.concat_ws(
            ";", F.col("trans_id").cast("string"),
            F.when(F.col("trans_id") % 89 == 0, "never").otherwise(F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss")),
            F.when(F.col("trans_id") % 97 == 0, "n/a").otherwise(amount),
            F.col("card_num").cast("string"), "oper_type", "oper_result", F.col("terminal").cast("string")).alias("line"))

    def keyed_batch(self) -> DataFrame:
        """``events`` with repeated and NULL ids, for the key guard."""
        k = F.col("event_id")
        return self.raw("events").select(F.when(k % 11 == 0, F.lit(None)).otherwise(k % 3000).alias("trans_id"),
                                         F.col("ts").alias("trans_date"), F.col("user_id").alias("card_num"), "event_id")

    def loaded_keys(self) -> DataFrame:
        k = F.col("event_id") % 3000
        return self.raw("events").where(k < 100).select(k.alias("trans_id")).distinct()

    def transactions_feed(self) -> DataFrame:
        """``events`` in the daily feed's column names (before T2)."""
        return self.transactions().select(
            F.col("trans_id").alias("transaction_id"),
            F.col("trans_date").alias("transaction_date"),
            F.col("amt").alias("amount"),
            "card_num", "oper_type", "oper_result", "terminal",
        )

    # -- dimensions ----------------------------------------------------------
    def clients(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        return c.select(
            k.alias("client_id"),
            F.col("c_name").alias("last_name"),
            F.col("c_mktsegment").alias("first_name"),
            F.when(k % 50 == 49, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("patronymic"),
            F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
            F.when(k % 5 == 0, F.lit(None).cast("date")).otherwise(_plus_days(k % 60)).alias("passport_valid_to"),
            F.concat(F.lit("T"), k.cast("string")).alias("phone"),
        )

    def accounts(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            (k + 1000000).alias("account_num"),
            _plus_days((k * 7) % 90).alias("valid_to"),
            k.alias("client"),
        )

    def cards(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(k.alias("card_num"), (k + 1000000).alias("account_num"))

    def blacklist(self) -> DataFrame:
        return (self.raw("customer").where(F.col("c_acctbal") < 0)
                .select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("passport_num")))

    def blacklist_with_null(self) -> DataFrame:
        """Blacklist whose passport is NULL for keys with ``% 50 = 49``."""
        k = F.col("c_custkey")
        return (self.raw("customer").where(F.col("c_acctbal") < 0)
                .select(F.when(k % 50 == 49, F.lit(None).cast("string"))
                        .otherwise(F.concat(F.lit("P"), k.cast("string"))).alias("passport_num")))

    def blacklist_feed(self) -> DataFrame:
        """Feed of documents for the insert-if-absent load (acctbal < 500)."""
        k = F.col("c_custkey")
        return (self.raw("customer").where(F.col("c_acctbal") < 500)
                .select(F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
                        _plus_days(k % 30).alias("entry_dt")))

    # -- terminals -------------------------------------------------------------
    def _suppliers_in(self, nation_shift: Column) -> DataFrame:
        s = self.raw("supplier").select("s_suppkey", "s_name", "s_nationkey")
        n = self.raw("nation").select("n_nationkey", "n_name")
        return s.join(n, (nation_shift) == n["n_nationkey"])

    def terminal_history(self) -> DataFrame:
        """Two-version history used by the city-switch rule."""
        k = F.col("s_suppkey")
        v1 = self._suppliers_in(F.col("s_nationkey")).select(
            k.alias("terminal_id"),
            F.when(k % 2 == 0, F.lit("ATM")).otherwise(F.lit("POS")).alias("terminal_type"),
            F.col("n_name").alias("terminal_city"),
            F.col("s_name").alias("terminal_address"),
            ts_ntz(HISTORY_START).alias("effective_from"),
            F.when(k % 3 == 0, ts_ntz(VERSION1_END)).otherwise(ts_ntz(OPEN_END)).alias("effective_to"),
            F.lit(False).alias("deleted_flg"),
        )
        v2 = self._suppliers_in((F.col("s_nationkey") + 1) % 25).where(k % 3 == 0).select(
            k.alias("terminal_id"),
            F.when(k % 2 == 0, F.lit("ATM")).otherwise(F.lit("POS")).alias("terminal_type"),
            F.col("n_name").alias("terminal_city"),
            F.col("s_name").alias("terminal_address"),
            ts_ntz(VERSION2_START).alias("effective_from"),
            ts_ntz(OPEN_END).alias("effective_to"),
            F.lit(False).alias("deleted_flg"),
        )
        return v1.unionByName(v2)

    def _snapshot_rows(self, keep: Column, moved: Column) -> DataFrame:
        k = F.col("s_suppkey")
        shifted = F.when(moved, (F.col("s_nationkey") + 1) % 25).otherwise(F.col("s_nationkey"))
        return self._suppliers_in(shifted).where(keep).select(
            k.alias("terminal_id"),
            F.when(k % 2 == 0, F.lit("ATM")).otherwise(F.lit("POS")).alias("terminal_type"),
            F.col("n_name").alias("terminal_city"),
            F.col("s_name").alias("terminal_address"),
        )

    def snapshot_old_history(self) -> DataFrame:
        """History holding snapshot 1 (suppliers with key % 7 <> 0), all open."""
        k = F.col("s_suppkey")
        return self._snapshot_rows(k % 7 != 0, F.lit(False)).select(
            "*",
            ts_ntz(HISTORY_START).alias("effective_from"),
            ts_ntz(OPEN_END).alias("effective_to"),
            F.lit(False).alias("deleted_flg"),
        )

    def snapshot_new(self) -> DataFrame:
        """Snapshot 2: suppliers with key % 5 <> 0; key % 3 = 0 moved city."""
        k = F.col("s_suppkey")
        return self._snapshot_rows(k % 5 != 0, k % 3 == 0)

    def snapshot_series(self) -> DataFrame:
        """Snapshots of four days (``as_of``): suppliers come, go, return and
        move; the third day's is empty for every second supplier."""
        k = F.col("s_suppkey")
        parts = [self._snapshot_rows((k + i) % (3 + i) != 0 if i != 2 else k % 2 == 0, (k + i) % 3 == 0)
                 .withColumn("as_of", ts_ntz(t)) for i, t in enumerate(SERIES_TIMES)]
        return reduce(DataFrame.unionByName, parts)
