"""Load ledger, key ledger, quarantine and touched days: each feed's rows are
there once and every day is reported, wherever a run dies."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardwatch.operators.keys import DuplicateKeyError
from cardwatch.plans import daily
from cardwatch.plans import ledger as L
from cardwatch.plans.report import read_report
from cardwatch.plans.warehouse import Warehouse
from cardwatch.schemas import TRANSACTIONS_FEED
from cardwatch.sources import feeds

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
D1, D2 = dt.date(2021, 3, 1), dt.date(2021, 3, 2)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture
def bank(spark, scratch):
    """A warehouse with one client whose document expired, and feeds of two
    days; the second day's holds a late operation of the first."""
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    wh.load_dimension("clients", spark.createDataFrame(
        [("K", "L", "F", "P", "DOC", dt.date(2020, 1, 1), "+1")],
        "client_id string, last_name string, first_name string, patronymic string, passport_num string, passport_valid_to date, phone string"), "client_id")
    wh.load_dimension("accounts", spark.createDataFrame([("A", dt.date(2099, 1, 1), "K")], "account_num string, valid_to date, client string"), "account_num")
    wh.load_dimension("cards", spark.createDataFrame([("C", "A")], "card_num string, account_num string"), "card_num")
    folder = f"{scratch}/feeds"
    _write(f"{folder}/transactions_01032021.txt", HEADER + "1;2021-03-01 10:00:00;1;C;P;SUCCESS;T\n")
    _write(f"{folder}/transactions_02032021.txt", HEADER + "2;2021-03-02 10:00:00;1;C;P;SUCCESS;T\n"
           + "3;2021-03-01 23:59:00;1;C;P;SUCCESS;T\n")
    return wh, folder


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def reported(wh):
    return sorted(r.event_dt.isoformat(" ") for r in read_report(wh).collect())


ALL = ["2021-03-01 10:00:00", "2021-03-01 23:59:00", "2021-03-02 10:00:00"]


def test_a_late_operation_is_reported_on_its_day(bank):
    wh, folder = bank
    daily.run_day(wh, D1, daily.FeedFolder(folder))
    assert reported(wh) == ALL[:1] and wh.ledger.pending_days() == []
    daily.run_day(wh, D2, daily.FeedFolder(folder))
    assert wh.ledger.pending_days() == [D1]
    untouched = os.stat(f"{wh.path('report')}/event_day=2021-03-02").st_mtime_ns
    assert daily.report_touched(wh) == [D1]
    assert reported(wh) == ALL and wh.ledger.pending_days() == []
    assert os.stat(f"{wh.path('report')}/event_day=2021-03-02").st_mtime_ns == untouched
    assert daily.report_touched(wh) == []


def _fails(*_a, **_k):
    raise RuntimeError("the driver died")


@pytest.mark.parametrize("died", ["before the fact", "after the fact", "after the keys", "before the archive", "before the report"])
def test_a_run_that_died_is_made_good(bank, scratch, monkeypatch, died):
    wh, folder = bank
    archive = f"{scratch}/archive"
    with monkeypatch.context() as m:
        if died == "before the fact":
            m.setattr(L.KeyLedger, "begin", _fails)
        elif died == "after the fact":
            m.setattr(L.KeyLedger, "add", _fails) if wh.key_ledger.repair(wh.table("transactions")) == [] else None
        elif died == "after the keys":
            m.setattr(L.KeyLedger, "end", _fails) if wh.key_ledger.repair(wh.table("transactions")) == [] else None
        elif died == "before the archive":
            m.setattr(daily, "move", _fails)
        else:
            m.setattr(daily, "write_day", _fails)
        with pytest.raises(RuntimeError):
            daily.run_day(wh, D2, daily.FeedFolder(folder), archive=archive)
    daily.run_day(wh, D2, daily.FeedFolder(folder), archive=archive)
    daily.report_touched(wh)
    assert sorted(r.trans_id for r in wh.table("transactions").collect()) == ["2", "3"]
    assert sorted(r.trans_id for r in wh.key_ledger.keys().collect()) == ["2", "3"]
    assert reported(wh) == ALL[1:] and os.listdir(archive) == ["transactions_02032021.txt.backup"]


def test_days_of_an_archived_feed_are_reported_after_a_crash(bank, scratch, monkeypatch):
    from cardwatch.__main__ import main
    wh, folder = bank
    with monkeypatch.context() as m:
        m.setattr(daily, "write_day", _fails)
        with pytest.raises(RuntimeError):
            main(["--warehouse", wh.root, "--feeds", folder, "--date", "02032021", "--archive", f"{scratch}/archive"])
    assert not any(n.startswith("transactions") for n in os.listdir(folder))
    assert main(["--warehouse", wh.root, "--feeds", folder, "--date", "02032021", "--archive", f"{scratch}/archive"]) == 0
    assert reported(wh) == ALL and wh.table("transactions").count() == 3


def test_malformed_lines_are_kept_aside_and_counted(spark, scratch, capsys):
    from cardwatch.__main__ import main
    path = _write(f"{scratch}/feeds/transactions_01032021.txt", HEADER
                  + "1;2021-03-01 10:00:00;1;C;P;SUCCESS;T;surplus;more\n"
                  + "2;2021-03-01 10:00:00;1;C\n"
                  + '3;2021-03-01 10:00:00;1;C;"P;Q";SUCCESS;T\n'
                  + "4;2021-03-01 10:00:00;123456789012345678901,5;C;P;SUCCESS;T\n"
                  + " 3;never;n/a;C;P;SUCCESS;T\n")
    good, bad = feeds.read_transactions_feed(spark, path), feeds.rejected_lines(spark, path, TRANSACTIONS_FEED)
    assert good.count() + bad.count() == 5
    assert sorted((r.reason, r.fields_found, r.fields_expected) for r in bad.collect()) == [
        ("missing fields", 4, 7), ("surplus fields", 9, 7)]
    # ids are taken as they stand: ' 3' is another key than '3'
    assert sorted(r.transaction_id for r in good.collect()) == [" 3", "3", "4"]
    assert main(["--warehouse", f"{scratch}/wh", "--feeds", f"{scratch}/feeds", "--date", "01032021"]) == 0
    assert "transactions_01032021.txt: rows 3, bad_times 1, bad_amounts 1, wide_amounts 1, rejected 2" in capsys.readouterr().out
    wh = Warehouse(spark, f"{scratch}/wh")
    kept = {(r.feed, r.file, r.line) for r in wh.rejects().collect()}
    assert ("transactions", "transactions_01032021.txt", "2;2021-03-01 10:00:00;1;C") in kept and len(kept) == 2
    assert wh.table("transactions").where("amt IS NULL").count() == 2


def test_keys_are_checked_in_their_own_folders_only(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.ensure_tables()
    row = "transaction_id string, transaction_date timestamp_ntz, amount decimal(38,18), card_num string, oper_type string, oper_result string, terminal string"

    def batch(*ids, day=1):
        return spark.createDataFrame([(i, dt.datetime(2021, 3, day), None, "C", "P", "SUCCESS", "T") for i in ids], row)
    wh.append_transactions(batch(*[str(i) for i in range(500)]))
    one = batch("7").select(F.col("transaction_id").alias("trans_id"))
    held = wh.key_ledger.keys(one)
    assert held.select(F.input_file_name()).distinct().count() == 1 and wh.key_ledger.keys().select("bucket").distinct().count() > 50
    bucket = one.select(wh.key_ledger.bucket().alias("b")).first().b
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(held) and f"= {bucket})" in plan_of(held)
    with pytest.raises(DuplicateKeyError):
        wh.append_transactions(batch("7", day=9))
    found = wh.append_transactions(batch("7", "new", None, day=9), "skip")
    assert found["rows"] == 2 and wh.key_ledger.keys().count() == 501
    # a warehouse without a key ledger builds it from its fact
    other = Warehouse(spark, f"{scratch}/other")
    other.ensure_tables()
    wh.table("transactions").write.mode("append").partitionBy("trans_day").parquet(other.path("transactions"))
    with pytest.raises(DuplicateKeyError):
        other.append_transactions(batch("499"))
