"""Feeds (S1-S7), warehouse loads (T1, T2, L1, L10), report (T3, T4),
daily and range runs, and the streaming ingest (T5), on temp folders."""

import datetime as dt
import os
import time
from decimal import Decimal

import pytest

from cardwatch.operators.keys import DuplicateKeyError
from cardwatch.plans import daily
from cardwatch.plans.report import read_report
from cardwatch.plans.warehouse import Warehouse
from cardwatch.sources import feeds
from cardwatch.streaming.ingest import ingest_transactions

TXN_HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _dims(spark, wh):
    clients = spark.createDataFrame(
        [("K1", "Ivanov", "Ivan", "I", None, "1111 111111", dt.date(2021, 2, 28), "+7", None, None),
         ("K2", "Petrov", "Petr", "P", None, "2222 222222", None, "+8", None, None)],
        "client_id string, last_name string, first_name string, patronymic string, date_of_birth date, "
        "passport_num string, passport_valid_to date, phone string, create_dt date, update_dt date")
    accounts = spark.createDataFrame([("A1", dt.date(2099, 1, 1), "K1"), ("A2", dt.date(2021, 2, 1), "K2")],
                                     "account_num string, valid_to date, client string")
    cards = spark.createDataFrame([("1111 0000 0000 0001", "A1"), ("2222 0000 0000 0002", "A2")],
                                  "card_num string, account_num string")
    wh.load_dimension("clients", clients, "client_id")
    wh.load_dimension("accounts", accounts, "account_num")
    wh.load_dimension("cards", cards, "card_num")


def _feeds(folder):
    _write(f"{folder}/transactions_01032021.txt", TXN_HEADER +
           "1;2021-03-01 10:00:00;6294,54;1111 0000 0000 0001;PAYMENT;SUCCESS;T1\n"
           "2;2021-03-01 10:20:00;100.00;1111 0000 0000 0001;PAYMENT;SUCCESS;T2\n"
           "3;2021-03-01 11:00:00;abc;2222 0000 0000 0002;PAYMENT;SUCCESS;T1\n"
           "4;not a time;5.00;2222 0000 0000 0002;PAYMENT;SUCCESS;T1\n")
    _write(f"{folder}/passport_blacklist_01032021.csv", "passport;date\n2222 222222;2021-03-01\n")
    _write(f"{folder}/terminals_01032021.csv",
           "terminal_id;terminal_type;terminal_city;terminal_address\nT1;POS;Moscow;a\nT2;ATM;Kazan;b\n")


def test_feed_parsing(spark, scratch):
    _feeds(scratch)
    df = feeds.read_transactions_feed(spark, f"{scratch}/transactions_01032021.txt")
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows["1"].amount == Decimal("6294.54")
    assert rows["3"].amount is None
    assert rows["4"].transaction_date is None
    assert rows["1"].feed_day == dt.date(2021, 3, 1)
    assert feeds.parse_run_date("01032021") == dt.date(2021, 3, 1)
    assert feeds.feed_present(spark, f"{scratch}/transactions_01032021.txt")
    assert not feeds.feed_present(spark, f"{scratch}/transactions_02032021.txt")


def test_run_day_loads_reports_and_reruns_idempotently(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    _dims(spark, wh)
    folder = f"{scratch}/feeds"
    _feeds(folder)
    # No as_of: the snapshot takes effect at the start of its day, so the
    # as-of join places that day's operations.
    rep = daily.run_day(wh, "01032021", daily.FeedFolder(folder), report_dt="2021-03-02 00:00:00")
    got = sorted((r.event_type, r.passport) for r in rep.collect())
    assert got == [("blocked_passport", "2222 222222"),
                   ("diff_city", "1111 111111"),
                   ("overdue_account", "2222 222222"),
                   ("overdue_passport", "1111 111111"),
                   ("overdue_passport", "1111 111111")]
    assert wh.table("transactions").count() == 4
    assert wh.table("blacklist").count() == 1
    assert wh.history_version() == 1 and wh.history().count() == 2
    # Rerun of the day: the feeds are recognised and nothing is loaded again ...
    assert daily.run_day(wh, "01032021", daily.FeedFolder(folder)).count() == 5
    assert wh.table("transactions").count() == 4
    # ... but other content with a known id fails under 'fail' ...
    _write(f"{folder}/transactions_02032021.txt", open(f"{folder}/transactions_01032021.txt").read() + "99;2021-03-02 09:00:00;1;C;P;SUCCESS;T\n")
    with pytest.raises(DuplicateKeyError):
        daily.run_day(wh, "02032021", daily.FeedFolder(folder))
    # ... and without feeds the report partition is replaced, not appended.
    again = daily.run_day(wh, "2021-03-01", None, report_dt="2021-03-03 00:00:00")
    assert again.count() == 5
    assert read_report(wh).count() == 5


def test_absent_and_empty_snapshot(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    folder = f"{scratch}/feeds"
    _write(f"{folder}/terminals_01032021.csv", "terminal_id;terminal_type;terminal_city;terminal_address\nT1;POS;M;a\n")
    daily.load_feeds(wh, dt.date(2021, 3, 1), daily.FeedFolder(folder), as_of="2021-03-01 00:00:00")
    loaded = daily.load_feeds(wh, dt.date(2021, 3, 2), daily.FeedFolder(folder), as_of="2021-03-02 00:00:00")
    assert loaded["terminals"] is None and wh.history_version() == 1
    _write(f"{folder}/terminals_03032021.csv", "terminal_id;terminal_type;terminal_city;terminal_address\n")
    daily.load_feeds(wh, dt.date(2021, 3, 3), daily.FeedFolder(folder), as_of="2021-03-03 00:00:00")
    open_rows = [r for r in wh.history().collect() if r.effective_to.year == 2999]
    assert [(r.terminal_id, r.deleted_flg) for r in open_rows] == [("T1", True)]


def test_range_equals_union_of_days(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    _dims(spark, wh)
    folder = f"{scratch}/feeds"
    _feeds(folder)
    _write(f"{folder}/transactions_02032021.txt", TXN_HEADER +
           "10;2021-03-02 09:00:00;10.00;1111 0000 0000 0001;PAYMENT;SUCCESS;T1\n"
           "11;2021-03-02 09:30:00;10.00;1111 0000 0000 0001;PAYMENT;SUCCESS;T2\n")
    daily.load_feeds(wh, dt.date(2021, 3, 1), daily.FeedFolder(folder), as_of="2021-03-01 00:00:00")
    daily.load_feeds(wh, dt.date(2021, 3, 2), daily.FeedFolder(folder), as_of="2021-03-01 00:00:00")
    per_day = []
    for d in ("2021-03-01", "2021-03-02"):
        per_day += [tuple(r) for r in daily.day_report(wh, d).collect()]
    ranged = [tuple(r) for r in daily.day_report(wh, None, start="2021-03-01", end="2021-03-02").collect()]
    assert sorted(per_day, key=str) == sorted(ranged, key=str) and len(ranged) > 0
    out = daily.run_range(wh, "2021-03-01", "2021-03-02", report_dt="2021-03-05 00:00:00")
    assert out.count() == len(ranged)


def test_streaming_ingest_archives_and_skips_replays(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    inbox, archive, ckpt = f"{scratch}/inbox", f"{scratch}/archive", f"{scratch}/ckpt"
    _write(f"{inbox}/transactions_01032021.txt", TXN_HEADER +
           "1;2021-03-01 10:00:00;1,5;C1;PAYMENT;SUCCESS;T1\n2;2021-03-01 10:01:00;2;C1;PAYMENT;SUCCESS;T1\n")
    q = ingest_transactions(wh, inbox, ckpt, archive)
    q.awaitTermination(120)
    assert wh.table("transactions").count() == 2
    _write(f"{inbox}/transactions_02032021.txt", TXN_HEADER +
           "2;2021-03-01 10:01:00;2;C1;PAYMENT;SUCCESS;T1\n3;2021-03-02 10:00:00;3;C1;PAYMENT;SUCCESS;T1\n")
    time.sleep(1)
    q = ingest_transactions(wh, inbox, ckpt, archive)
    q.awaitTermination(120)
    assert sorted(r.trans_id for r in wh.table("transactions").collect()) == ["1", "2", "3"]
    archived = {f for _, _, fs in os.walk(archive) for f in fs if not f.startswith(".")}
    assert archived == {"transactions_01032021.txt.backup", "transactions_02032021.txt.backup"}
    assert not [f for f in os.listdir(inbox) if f.endswith(".txt")]  # the last batch's file moved too


def test_seed_dimension_csv_and_views(spark, scratch):
    from cardwatch import schemas
    _write(f"{scratch}/seed/cards.csv", "card_num;account_num;create_dt;update_dt\n"
           "9000 0000 0000 0042;A42;2001-01-01;\n"
           "9000 0000 0000 0042;A42;2001-01-01;\n")
    cards = feeds.read_dimension(spark, f"{scratch}/seed/cards.csv", schemas.CARDS)
    assert cards.schema["create_dt"].dataType.typeName() == "date"
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    with pytest.raises(DuplicateKeyError):
        wh.load_dimension("cards", cards, "card_num", key_policy="fail")
    wh.load_dimension("cards", cards, "card_num")
    wh.load_dimension("cards", cards, "card_num")  # replay: nothing new
    wh.register_views()
    assert spark.sql("SELECT count(*) AS n FROM dwh_dim_cards").first().n == 1


def test_key_scope_same_days(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    folder = f"{scratch}/feeds"
    _feeds(folder)
    feed = feeds.read_transactions_feed(spark, f"{folder}/transactions_01032021.txt")
    wh.append_transactions(feed)
    with pytest.raises(DuplicateKeyError):
        wh.append_transactions(feed, key_scope="same_days")
    wh.append_transactions(feed, key_policy="skip", key_scope="same_days")
    assert wh.table("transactions").count() == 4


def test_clean_mode_first_snapshot_opens_in_the_past(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    snap = spark.createDataFrame([("T1", "POS", "M", "a")], "terminal_id string, terminal_type string, "
                                 "terminal_city string, terminal_address string")
    wh.load_terminals(snap, "2021-03-01 12:00:00", mode="clean")
    assert [r.effective_from.year for r in wh.history().collect()] == [1900]
    wh.load_terminals(snap.selectExpr("terminal_id", "terminal_type", "'K' AS terminal_city", "terminal_address"),
                      "2021-03-02 12:00:00", mode="clean")
    rows = sorted((r.terminal_city, r.effective_from.year, r.effective_to.year) for r in wh.history().collect())
    assert rows == [("K", 2021, 2999), ("M", 1900, 2021)]


def test_command_line_daily_run(spark, scratch, capsys):
    from cardwatch.__main__ import load_seeds, main
    seed = f"{scratch}/seed"
    _write(f"{seed}/clients.csv", "client_id;last_name;first_name;patronymic;date_of_birth;passport_num;"
           "passport_valid_to;phone;create_dt;update_dt\n"
           "K1;Ivanov;Ivan;I;1990-01-01;1111 111111;2021-02-28;+7;2001-01-01;\n")
    _write(f"{seed}/accounts.csv", "account_num;valid_to;client;create_dt;update_dt\nA1;2099-01-01;K1;2001-01-01;\n")
    _write(f"{seed}/cards.csv", "card_num;account_num;create_dt;update_dt\n1111 0000 0000 0001;A1;2001-01-01;\n")
    folder = f"{scratch}/feeds"
    _feeds(folder)
    assert main(["--warehouse", f"{scratch}/wh", "--feeds", folder, "--date", "01032021", "--seed", seed]) == 0
    out = capsys.readouterr().out
    assert "overdue_passport" in out and "diff_city" in out
    wh = Warehouse(spark, f"{scratch}/wh")
    assert load_seeds(wh, seed) == ["clients", "accounts", "cards"]  # replay: skipped by key
    assert wh.table("clients").count() == 1
    # a rerun of the day with the skip policy loads nothing twice
    assert main(["--warehouse", f"{scratch}/wh", "--feeds", folder, "--date", "01032021",
                 "--key-policy", "skip", "--rows", "1"]) == 0
    assert "2 more not shown" in capsys.readouterr().out
    assert wh.table("transactions").count() == 4
    assert main(["--warehouse", f"{scratch}/wh", "--start", "2021-03-01", "--end", "2021-03-31"]) == 0
    assert "diff_city" in capsys.readouterr().out
    assert main(["--warehouse", f"{scratch}/wh", "--date", "02032021", "--all"]) == 0
    assert "overdue_passport" in capsys.readouterr().out  # earlier days are printed too


def test_day_run_prunes_fact_partitions(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    _dims(spark, wh)
    folder = f"{scratch}/feeds"
    _feeds(folder)
    daily.load_feeds(wh, dt.date(2021, 3, 1), daily.FeedFolder(folder), as_of="2021-03-01 00:00:00")
    from plan_report import plan_text
    plan = plan_text(daily.day_report(wh, "2021-03-01"))
    fact_scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "/transactions" in line]
    assert fact_scans and all("PartitionFilters: [isnotnull(trans_day" in s and "= 2021-03-01" in s
                              for s in fact_scans)


def test_history_versions_store_open_rows_and_closures(spark, scratch):
    from conftest import HIST_SCHEMA, ts

    from cardwatch.operators import history as H
    snap_schema = "terminal_id string, terminal_type string, terminal_city string, terminal_address string"
    far = ts("2999-12-31 23:59:59")
    start = spark.createDataFrame([("T1", "POS", "A", "a", ts("2020-01-01 00:00:00"), ts("2020-06-01 00:00:00"), False),
                                   ("T1", "POS", "B", "a", ts("2020-06-01 00:00:01"), far, False),
                                   ("T2", "ATM", "C", "c", ts("2020-01-01 00:00:00"), far, False)], HIST_SCHEMA)
    snaps = [[("T1", "POS", "B", "a"), ("T3", "POS", "D", "d")],        # T2 deleted, T3 new
             [("T1", "POS", "Z", "a"), ("T2", "ATM", "C", "c")],        # T1 changed, T2 back, T3 deleted
             [("T1", "POS", "Z", "a"), ("T2", "ATM", "C2", "c")]]       # T2 changed
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    wh.replace_history(start)
    expected = start
    for i, rows in enumerate(snaps):
        snap = spark.createDataFrame(rows, snap_schema)
        as_of = f"2021-0{i + 1}-01 00:00:00"
        wh.load_terminals(snap, as_of)
        expected = H.scd2_apply(expected, snap, as_of).checkpoint()
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, wh.history().collect()), key=key) == \
            sorted(map(tuple, expected.collect()), key=key)
    # each version stores only the rows it closed beside the open ones
    before = sorted(map(tuple, wh.history().collect()), key=key)
    assert wh.compact_history() == 5
    assert sorted(map(tuple, wh.history().collect()), key=key) == before
    parts = spark.read.parquet(f"{scratch}/wh/terminals_hist")
    closed_by_v3 = parts.where("version = 3 AND state = 'closed'").count()
    # T1's old city and T3; in reference mode T2's tombstone stays open
    # beside its new live row (the reference's double open row)
    assert closed_by_v3 == 2
    assert parts.where("version = 1 AND state = 'closed'").count() == 1
    # versions before the base are not needed any more
    assert wh.remove_old_versions() == [1, 2, 3, 4]
    assert sorted(map(tuple, wh.history().collect()), key=key) == before


def test_streaming_blacklist_and_terminal_snapshots(spark, scratch):
    from cardwatch.streaming.ingest import ingest_blacklist, ingest_terminals
    wh = Warehouse(spark, f"{scratch}/wh")
    inbox, archive = f"{scratch}/inbox", f"{scratch}/archive"
    _write(f"{inbox}/passport_blacklist_01032021.csv", "passport;date\nA 1;2021-03-01\nB 2;2021-03-01\n")
    _write(f"{inbox}/passport_blacklist_02032021.csv", "passport;date\nB 2;2021-03-02\nC 3;2021-03-02\n")
    head = "terminal_id;terminal_type;terminal_city;terminal_address\n"
    _write(f"{inbox}/terminals_01032021.csv", head + "T1;POS;Moscow;a\nT2;ATM;Kazan;b\n")
    time.sleep(1.1)
    _write(f"{inbox}/terminals_02032021.csv", head + "T1;POS;Tver;a\n")
    time.sleep(1.1)
    _write(f"{inbox}/terminals_03032021.csv", head)
    ingest_blacklist(wh, inbox, f"{scratch}/ckpt-bl", archive).awaitTermination(120)
    assert sorted(r.passport_num for r in wh.table("blacklist").collect()) == ["A 1", "B 2", "C 3"]
    ingest_terminals(wh, inbox, f"{scratch}/ckpt-term", archive).awaitTermination(180)
    assert wh.history_version() == 3  # one version per snapshot file
    hist = wh.history().collect()
    open_rows = sorted((r.terminal_id, r.terminal_city, r.deleted_flg) for r in hist if r.effective_to.year == 2999)
    # the header-only snapshot deleted T1; T2 was deleted by the second one
    assert open_rows == [("T1", "Tver", True), ("T2", "Kazan", True)]
    assert len(hist) == 5  # T1 Moscow, T1 Tver, T2 Kazan closed; two tombstones open


def test_command_line_with_archive(spark, scratch, capsys):
    from cardwatch.__main__ import main
    seed = f"{scratch}/seed"
    _write(f"{seed}/clients.csv", "client_id;last_name;first_name;patronymic;date_of_birth;passport_num;"
           "passport_valid_to;phone;create_dt;update_dt\nK2;Petrov;Petr;P;;2222 222222;;+8;;\n")
    _write(f"{seed}/accounts.csv", "account_num;valid_to;client;create_dt;update_dt\nA2;2099-01-01;K2;;\n")
    _write(f"{seed}/cards.csv", "card_num;account_num;create_dt;update_dt\n2222 0000 0000 0002;A2;;\n")
    folder = f"{scratch}/feeds"
    _feeds(folder)
    assert main(["--warehouse", f"{scratch}/wh", "--feeds", folder, "--date", "01032021", "--seed", seed,
                 "--archive", f"{scratch}/archive"]) == 0
    assert "blocked_passport" in capsys.readouterr().out
    wh = Warehouse(spark, f"{scratch}/wh")
    assert wh.table("transactions").count() == 4 and wh.history_version() == 1
    # a backlog of two days: both are reported, whatever day is asked for
    for day in ("02032021", "03032021"):
        n = day[1]
        _write(f"{folder}/transactions_{day}.txt", TXN_HEADER +
               f"1{n};2021-03-0{n} 10:00:00;1;2222 0000 0000 0002;PAYMENT;SUCCESS;T1\n")
    assert main(["--warehouse", f"{scratch}/wh", "--feeds", folder, "--date", "03032021",
                 "--archive", f"{scratch}/archive"]) == 0
    out = capsys.readouterr().out
    assert "2021-03-02 10:00:00" in out and "2021-03-03 10:00:00" in out
    assert sorted({r.event_day.day for r in read_report(wh).collect()}) == [1, 2, 3]


def test_range_rerun_clears_findings_that_no_longer_hold(spark, scratch):
    from cardwatch.plans.report import write_days
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    schema = "event_dt timestamp_ntz, passport string, fio string, phone string, event_type string"
    found = spark.createDataFrame([(dt.datetime(2021, 3, 1, 10), "P1", "F", "T", "diff_city"),
                                   (dt.datetime(2021, 3, 2, 10), "P2", "F", "T", "diff_city")], schema)
    days = spark.createDataFrame([(dt.date(2021, 3, 1),), (dt.date(2021, 3, 2),)], "event_day date")
    write_days(wh, found, days, "2021-04-01 00:00:00")
    assert read_report(wh).count() == 2
    # rerun for 1 March only, which now has no findings: the day is cleared,
    # 2 March is untouched, and no placeholder row is ever visible
    write_days(wh, spark.createDataFrame([], schema), days.where("event_day = DATE'2021-03-01'"),
               "2021-04-02 00:00:00")
    assert [r.passport for r in read_report(wh).collect()] == ["P2"]
    assert read_report(wh, "2021-03-01").count() == 0


def test_unchanged_snapshot_writes_no_version(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    snap = spark.createDataFrame([("T1", "POS", "M", "a"), ("T2", "ATM", "K", "b")],
                                 "terminal_id string, terminal_type string, terminal_city string, terminal_address string")
    assert wh.load_terminals(snap, "2021-03-01 00:00:00") == 1
    assert wh.load_terminals(snap, "2021-03-02 00:00:00") == 1  # same snapshot: nothing to write
    assert wh.load_terminals(snap.where("terminal_id = 'T1'"), "2021-03-03 00:00:00") == 2
    assert wh.history().count() == 3  # T1 open, T2 closed, T2 tombstone


def test_operations_cache_is_released(spark, scratch):
    from pyspark import StorageLevel
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    folder = f"{scratch}/feeds"
    _feeds(folder)
    daily.load_feeds(wh, dt.date(2021, 3, 1), daily.FeedFolder(folder), as_of="2021-03-01 00:00:00")
    with daily.cached_operations(wh, day="2021-03-01") as (ops, hot):
        assert hot.hashes == ()
        assert ops.storageLevel == StorageLevel.MEMORY_AND_DISK
        assert ops.count() == 3  # the row with an unparsable time has no day
    assert ops.storageLevel == StorageLevel(False, False, False, False, 1)
