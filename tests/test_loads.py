"""Loads that must not cut data: amounts, NULL keys, headers, snapshots."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from cardwatch.operators.keys import guard_unique
from cardwatch.plans import daily
from cardwatch.plans.warehouse import SnapshotOrderError, Warehouse
from cardwatch.sources import feeds
from conftest import HIST_SCHEMA, SNAP_SCHEMA, ts

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_amounts_are_neither_capped_nor_rounded(spark, scratch):
    path = _write(f"{scratch}/transactions_01032021.txt", HEADER
                  + "1;2021-03-01 10:00:00;123456789,10;C;P;SUCCESS;T\n"
                  + "2;2021-03-01 10:01:00;100,999;C;P;SUCCESS;T\n"
                  + "3;2021-03-01 10:02:00;-5;C;P;SUCCESS;T\n"
                  + "4;2021-03-01 10:03:00;;C;P;SUCCESS;T\n"
                  + "5;2021-03-01 10:04:00;1e;C;P;SUCCESS;T\n"
                  + "6;31.03.2021;7;C;P;SUCCESS;T\n")
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    counts = wh.append_transactions(feeds.read_transactions_feed(spark, path))
    assert counts == {"rows": 6, "bad_times": 1, "bad_amounts": 1, "wide_amounts": 0, "days": [dt.date(2021, 3, 1)]}  # an empty amount is no unreadable one
    amounts = {r.trans_id: r.amt for r in wh.table("transactions").collect()}
    assert amounts["1"] == Decimal("123456789.10") and amounts["2"] == Decimal("100.999")
    assert amounts["3"] == -5 and amounts["4"] is None and amounts["5"] is None
    from cardwatch.functions.expressions import whole_units
    whole = wh.table("transactions").where("trans_id = 2").select(whole_units("amt").alias("w")).first().w
    assert int(whole) == 100


def test_null_keys_pass_and_the_survivor_is_the_smallest_row(spark):
    rows = [(None, 3, "x"), (None, 3, "x"), ("a", 2, "q"), ("a", 1, "z"), ("a", 1, None), ("b", 5, "n"), ("old", 1, "o")]
    batch = spark.createDataFrame(rows, "k string, v int, w string")
    target = spark.createDataFrame([("old",), (None,)], "k string")
    kept = sorted(map(tuple, guard_unique(batch, target, ["k"], "skip").collect()), key=str)
    assert kept == sorted([("a", 1, None), ("b", 5, "n"), (None, 3, "x"), (None, 3, "x")], key=str)
    nulls = batch.where("k IS NULL")
    assert guard_unique(nulls, target, ["k"], "fail").count() == 2


def test_null_ids_load_whole_and_twice_with_skip(spark, scratch):
    path = _write(f"{scratch}/transactions_01032021.txt", HEADER
                  + ";2021-03-01 10:00:00;1;C;P;SUCCESS;T\n;2021-03-01 10:01:00;2;C;P;SUCCESS;T\n"
                  + "1;2021-03-01 10:02:00;3;C;P;SUCCESS;T\n2;2021-03-01 10:03:00;4;C;P;SUCCESS;T\n")
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    wh.append_transactions(feeds.read_transactions_feed(spark, path), "fail")
    assert wh.table("transactions").count() == 4


def test_columns_are_bound_by_header_name(spark, scratch):
    path = _write(f"{scratch}/transactions_01032021.txt",
                  "amount;transaction_id;terminal;transaction_date;card_num;oper_result;oper_type\n"
                  '1,5;7;"T;""1""";2021-03-01 10:00:00;C;SUCCESS;P\n')
    row = feeds.read_transactions_feed(spark, path).first()
    assert (row.transaction_id, row.amount, row.terminal) == ("7", Decimal("1.5"), 'T;"1"')
    assert row.transaction_date == dt.datetime(2021, 3, 1, 10) and row.feed_day == dt.date(2021, 3, 1)
    short = _write(f"{scratch}/transactions_02032021.txt", "transaction_id;amount\n8;2\n")
    assert feeds.read_transactions_feed(spark, short).first().card_num is None


def test_misspelt_header_is_an_error(spark, scratch):
    path = _write(f"{scratch}/terminals_01032021.csv", "terminal_id;terminal_typ;terminal_city;terminal_address\nT;P;M;a\n")
    with pytest.raises(feeds.FeedHeaderError):
        feeds.read_terminal_snapshot(spark, path)


def test_files_of_one_read_with_different_headers_fail(spark, scratch):
    _write(f"{scratch}/in/transactions_01032021.txt", HEADER + "1;2021-03-01 10:00:00;1;C;P;SUCCESS;T\n")
    _write(f"{scratch}/in/transactions_02032021.txt",
           HEADER.replace("transaction_date;amount", "amount;transaction_date") + "2;1;2021-03-01 10:00:00;C;P;SUCCESS;T\n")
    with pytest.raises(Exception, match="header"):
        feeds.read_transactions_feed(spark, f"{scratch}/in").collect()


def _snap(spark, *rows):
    return spark.createDataFrame(list(rows), SNAP_SCHEMA)


def test_replacing_by_an_all_open_history_drops_the_old_one(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    far = ts("2999-12-31 23:59:59")
    wh.load_terminals(_snap(spark, ("T1", "POS", "A", "a")), "2021-03-01 00:00:00")
    wh.load_terminals(_snap(spark, ("T1", "POS", "B", "a")), "2021-03-02 00:00:00")  # closes a row
    wh.replace_history(spark.createDataFrame([("T9", "POS", "Z", "z", ts("2020-01-01 00:00:00"), far, False)], HIST_SCHEMA))
    assert [r.terminal_id for r in wh.history().collect()] == ["T9"]


def test_half_written_version_is_not_seen(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    wh.load_terminals(_snap(spark, ("T1", "POS", "A", "a")), "2021-03-01 00:00:00")
    # a failed job left one file of version 2 and no log row
    half = wh.history().selectExpr("'T7' AS terminal_id", "* EXCEPT (terminal_id)")
    half.write.parquet(f"{scratch}/wh/terminals_hist/version=2/state=open")
    assert wh.history_version() == 1
    assert [r.terminal_id for r in wh.history().collect()] == ["T1"]
    wh.load_terminals(_snap(spark, ("T1", "POS", "B", "a")), "2021-03-02 00:00:00")  # the rerun writes it anew
    assert sorted((r.terminal_id, r.terminal_city) for r in wh.history().collect()) == [("T1", "A"), ("T1", "B")]


def test_snapshots_out_of_order_are_refused(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    wh.load_terminals(_snap(spark, ("T1", "POS", "A", "a")), "2021-03-02 00:00:00")
    with pytest.raises(SnapshotOrderError):
        wh.load_terminals(_snap(spark, ("T1", "POS", "B", "a")), "2021-03-01 00:00:00")
    assert wh.load_terminals(_snap(spark, ("T1", "POS", "A", "a")), "2021-03-02 00:00:00") == 1  # a replay is fine


def test_default_runs_see_new_and_changed_terminals_on_their_day(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    wh.load_dimension("clients", spark.sql("SELECT 'K' AS client_id, 'L' AS last_name, 'F' AS first_name, 'P' AS patronymic, "
                                           "'DOC' AS passport_num, '+1' AS phone"), "client_id")
    wh.load_dimension("accounts", spark.sql("SELECT 'A' AS account_num, DATE'2099-01-01' AS valid_to, 'K' AS client"), "account_num")
    wh.load_dimension("cards", spark.sql("SELECT 'C' AS card_num, 'A' AS account_num"), "card_num")
    folder = f"{scratch}/feeds"
    head = "terminal_id;terminal_type;terminal_city;terminal_address\n"
    op = "{i};2021-03-0{d} 10:{m}:00;1;C;P;SUCCESS;{t}\n"
    _write(f"{folder}/terminals_01032021.csv", head + "T1;POS;Omsk;a\nT2;POS;Omsk;b\n")
    _write(f"{folder}/transactions_01032021.txt", HEADER + op.format(i=1, d=1, m="00", t="T1") + op.format(i=2, d=1, m=20, t="T2"))
    # day 2: T2 moves to another town and T3 is new there
    _write(f"{folder}/terminals_02032021.csv", head + "T1;POS;Omsk;a\nT2;POS;Tver;b\nT3;POS;Perm;c\n")
    _write(f"{folder}/transactions_02032021.txt", HEADER + op.format(i=3, d=2, m="00", t="T1")
           + op.format(i=4, d=2, m=20, t="T2") + op.format(i=5, d=2, m=40, t="T3"))
    archive = f"{scratch}/archive"
    assert daily.run_day(wh, "01032021", daily.FeedFolder(folder), archive=archive).count() == 0
    found = daily.run_day(wh, "02032021", daily.FeedFolder(folder), archive=archive).collect()
    assert sorted((r.event_type, r.event_dt.minute) for r in found) == [("diff_city", 20), ("diff_city", 40)]
    assert len([f for f in os.listdir(archive) if f.endswith(".backup")]) == 4 and not [
        f for f in os.listdir(folder) if not f.startswith(".")]
