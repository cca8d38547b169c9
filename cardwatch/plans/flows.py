"""Registered queries that go through files: the driver's rows are written as
feeds or tables to a new folder of the shared file system and read back by the
library's own readers, loads and writers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.operators import keys as K
from cardwatch.plans import daily
from cardwatch.plans.by_card import CardTables
from cardwatch.plans.catalog import Catalog
from cardwatch.plans.ledger import KeyLedger
from cardwatch.plans.report import read_report
from cardwatch.plans.warehouse import Warehouse
from cardwatch.sources import feeds
from cardwatch.sources.driver_tables import SERIES_TIMES, DriverTables
from cardwatch.sources.files import new_folder


def write_feed(lines: DataFrame, header: list[str], path: str) -> str:
    """Lines (column ``line``) as a feed: a folder of files that each start
    with the header, written as they stand."""
    (lines.select(F.col("line").alias(feeds.CSV_SEPARATOR.join(header))).write.option("header", True)
     .option("sep", "\x01").option("quote", "").option("escapeQuotes", False).csv(path))
    return path


def _lines(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows as feed lines, NULLs as empty fields."""
    cells = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(feeds.CSV_SEPARATOR, *cells).alias("line"))


def _ragged(t: DriverTables) -> DataFrame:
    """The transactions feed with surplus fields in some lines and missing
    ones in others."""
    number = F.substring_index("line", ";", 1).cast("long")
    return t.feed_lines().select(
        F.when(number % 83 == 0, F.concat("line", F.lit(";more;fields"))).when(number % 79 == 0, F.substring_index("line", ";", 4))
        .otherwise(F.col("line")).alias("line"))


def _transactions_feed(spark: SparkSession, sf_dir: str) -> str:
    return write_feed(_ragged(DriverTables(spark, sf_dir)), schemas.TRANSACTIONS_FEED.fieldNames(), new_folder(spark, "feed"))


def q_feed_transactions(spark, sf_dir):
    """Whole lines through the file reader."""
    feed = feeds.read_transactions_feed(spark, _transactions_feed(spark, sf_dir), "csv")
    return feed.select("transaction_id", "transaction_date", (F.col("amount") * 100).cast("long").alias("amount_cents"),
                       "card_num", "oper_type", "oper_result", "terminal", "bad_time", "bad_amount")


def q_feed_rejects(spark, sf_dir):
    """Malformed lines."""
    bad = feeds.rejected_lines(spark, _transactions_feed(spark, sf_dir), schemas.TRANSACTIONS_FEED, "csv")
    return bad.select(F.substring_index("line", ";", 1).cast("long").alias("trans_id"), "reason", "fields_found", "fields_expected")


def q_feed_blacklist(spark, sf_dir):
    """S3, L1: the blacklist feed, loaded into a table that holds some of it."""
    t, wh = DriverTables(spark, sf_dir), _warehouse(spark)
    wh.load_blacklist(t.blacklist())
    path = write_feed(_lines(t.blacklist_feed(), "passport_num", "entry_dt"), schemas.BLACKLIST_FEED.fieldNames(), new_folder(spark, "feed"))
    wh.load_blacklist(feeds.read_blacklist_feed(spark, path, "csv"))
    return wh.table("blacklist").select("passport_num", F.col("entry_dt").cast("string").alias("entry_dt"))


def q_feed_terminals(spark, sf_dir):
    """A snapshot feed, applied to a stored history."""
    t, wh = DriverTables(spark, sf_dir), _warehouse(spark)
    wh.replace_history(t.snapshot_old_history())
    names = schemas.TERMINALS_FEED.fieldNames()
    path = write_feed(_lines(t.snapshot_new(), *names), names, new_folder(spark, "feed"))
    wh.load_terminals(feeds.read_terminal_snapshot(spark, path, "csv"), "2024-02-01 00:00:00")
    return wh.history()


def q_terminal_backlog(spark, sf_dir):
    """Snapshot files named by their days, some absent."""
    t, wh, folder = DriverTables(spark, sf_dir), _warehouse(spark), new_folder(spark, "feeds")
    wh.replace_history(t.snapshot_old_history())
    names, feed = schemas.TERMINALS_FEED.fieldNames(), daily.FeedFolder(folder)
    days = [_dt.datetime.fromisoformat(x).date() for x in SERIES_TIMES]
    for day in days:
        own = t.snapshot_series().where(F.col("as_of") == F.lit(str(day)).cast("timestamp_ntz"))
        write_feed(_lines(own, *names), names, feed.terminals(feeds.parse_run_date(day.strftime("%d%m%Y"))))
    daily.load_terminal_backlog(wh, [days[0] + _dt.timedelta(days=k) for k in range(-2, 9)], feed)
    return wh.history()


def q_seed_clients(spark, sf_dir):
    """A seed file, loaded twice."""
    t, wh, seeds = DriverTables(spark, sf_dir), _warehouse(spark), new_folder(spark, "seed")
    names = ["client_id", "last_name", "first_name", "patronymic", "passport_num", "passport_valid_to", "phone"]
    path = write_feed(_lines(t.clients(), *names), names, f"{seeds}/clients.csv")
    for _ in range(2):
        wh.load_dimension("clients", feeds.read_dimension(spark, path, schemas.CLIENTS, "csv"), "client_id")
    return wh.table("clients").select(F.col("client_id").cast("long").alias("client_id"), "last_name", "first_name", "patronymic",
                                      "passport_num", F.col("passport_valid_to").cast("string").alias("passport_valid_to"), "phone")


def q_table_defaults(spark, sf_dir):
    """Rows inserted by SQL with the columns that have defaults left out."""
    catalog = Catalog(_warehouse(spark), f"cardwatch_{new_folder(spark, 'x')[-12:]}")
    catalog.create_tables()
    DriverTables(spark, sf_dir).snapshot_new().createOrReplaceTempView("cardwatch_new_terminals")
    spark.sql(f"INSERT INTO {catalog.name('dwh_dim_terminals_hist')} (terminal_id, terminal_type, terminal_city, terminal_address) "
              "SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM cardwatch_new_terminals")
    catalog.adopt_history()
    return catalog.wh.history().select("terminal_id", "terminal_type", "terminal_city", "terminal_address", "effective_to",
                                       "deleted_flg", F.col("effective_from").isNotNull().alias("started"))


def _warehouse(spark: SparkSession) -> Warehouse:
    wh = Warehouse(spark, new_folder(spark, "warehouse"))
    wh.ensure_tables()
    return wh


def _dimensions(t: DriverTables, wh: Warehouse) -> None:
    wh.load_dimension("clients", t.clients(), "client_id")
    wh.load_dimension("accounts", t.accounts(), "account_num")
    wh.load_dimension("cards", t.cards(), "card_num")
    wh.load_blacklist(t.blacklist())
    wh.replace_history(t.terminal_history())


def _card_tables(spark: SparkSession, sf_dir: str) -> CardTables:
    """The driver's operations in tables bucketed by card, the fullest (card,
    day) groups in the table of hot ones."""
    t, wh = DriverTables(spark, sf_dir), _warehouse(spark)
    _dimensions(t, wh)
    wh.append_transactions(t.transactions_feed())
    tables = CardTables(wh, int(spark.conf.get("spark.sql.shuffle.partitions")), f"cardwatch_{new_folder(spark, 'x')[-12:]}", hot_rows=2)
    tables.create_tables()
    tables.refresh()
    return tables


def q_owners_by_card(spark, sf_dir):
    """C1 for every card, from the bucketed table."""
    owners = _card_tables(spark, sf_dir).owners()
    return owners.select(*[F.col(c).cast("long").alias(c) for c in ("card_num", "client_id")], "passport_num", "fio", "phone",
                         *[F.col(c).cast("string").alias(c) for c in ("passport_valid_to", "account_valid_to")])


def q_bad_document_ops_by_card(spark, sf_dir):
    return _card_tables(spark, sf_dir).bad_document_ops()


def q_lapsed_contract_ops_by_card(spark, sf_dir):
    return _card_tables(spark, sf_dir).lapsed_contract_ops()


def q_fraud_report_by_card(spark, sf_dir):
    return _card_tables(spark, sf_dir).report()


def _loaded(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse that has loaded and archived the driver's operations as one
    feed, with its dimensions."""
    t, wh, folder = DriverTables(spark, sf_dir), _warehouse(spark), new_folder(spark, "feeds")
    _dimensions(t, wh)
    feed, day = daily.FeedFolder(folder), _dt.date(2024, 1, 1)
    names = schemas.TRANSACTIONS_FEED.fieldNames()
    lines = _lines(t.transactions_feed(), "transaction_id", F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss"),
                   F.col("amount").cast("decimal(20,6)"), *names[3:])
    write_feed(lines, names, feed.transactions(day))
    daily.load_feeds(wh, day, feed, archive=f"{folder}/archive")
    return wh


def q_touched_days(spark, sf_dir):
    """The days that a load wrote to, from the load ledger, once its
    feed lies in the archive."""
    days = _loaded(spark, sf_dir).ledger.pending_days()
    return spark.createDataFrame([(str(d),) for d in days], "touched string")


def q_warehouse_report(spark, sf_dir):
    """Feed file to fact to report partitions, read back."""
    wh = _loaded(spark, sf_dir)
    daily.report_touched(wh, report_dt="2024-02-01 00:00:00")
    return read_report(wh).select("event_dt", "passport", "fio", "phone", "event_type", "report_dt")


def q_unique_keys_ledger(spark, sf_dir):
    """K1 against the key ledger: only the folders of the batch's keys."""
    t = DriverTables(spark, sf_dir)
    ledger, batch = KeyLedger(spark, new_folder(spark, "keys")), t.keyed_batch()
    ledger.add(t.loaded_keys())
    held = ledger.keys(batch).select(F.col("trans_id").cast("long").alias("trans_id"))
    return K.guard_unique(batch, held, ["trans_id"], "skip")


FLOWS = {
    "feed_transactions": q_feed_transactions,
    "feed_rejects": q_feed_rejects,
    "feed_blacklist": q_feed_blacklist,
    "feed_terminals": q_feed_terminals,
    "terminal_backlog": q_terminal_backlog,
    "seed_clients": q_seed_clients,
    "table_defaults": q_table_defaults,
    "touched_days": q_touched_days,
    "warehouse_report": q_warehouse_report,
    "unique_keys_ledger": q_unique_keys_ledger,
    "owners_by_card": q_owners_by_card,
    "bad_document_ops_by_card": q_bad_document_ops_by_card,
    "lapsed_contract_ops_by_card": q_lapsed_contract_ops_by_card,
    "fraud_report_by_card": q_fraud_report_by_card,
}
