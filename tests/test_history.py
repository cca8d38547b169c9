"""L1-L10 and K1/K2 literal cases."""

import pytest
from conftest import HIST_SCHEMA, SNAP_SCHEMA, ts

from cardwatch.operators import history as H
from cardwatch.operators import keys as K

FAR = ts("2999-12-31 23:59:59")
T0 = ts("2023-01-01 00:00:00")


def _hist(spark, rows):
    return spark.createDataFrame(rows, HIST_SCHEMA)


def _snap(spark, rows):
    return spark.createDataFrame(rows, SNAP_SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def _open_rows(df):
    return sorted((r.terminal_id, r.terminal_city, r.deleted_flg) for r in df.collect()
                  if r.effective_to == FAR)


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    with_null = spark.createDataFrame([("a",), (None,)], "k string")
    plain = spark.createDataFrame([("a",)], "k string")
    empty = spark.createDataFrame([], "k string")
    assert _rows(K.not_in(left, with_null, "k")) == []
    assert _rows(K.not_in(left, plain, "k")) == [("b",)]
    assert _rows(K.not_in(left, empty, "k")) == [("a",), ("b",), (None,)]
    assert _rows(K.not_in(left, with_null, "k", null_keys="ignore")) == [("b",), (None,)]


def test_insert_if_absent_keeps_feed_duplicates_and_null_list_blocks(spark):
    feed = spark.createDataFrame([("X",), ("X",), ("Y",)], "passport_num string")
    target = spark.createDataFrame([("Y",)], "passport_num string")
    assert _rows(K.insert_if_absent(feed, target)) == [("X",), ("X",)]
    target_null = spark.createDataFrame([("Y",), (None,)], "passport_num string")
    assert _rows(K.insert_if_absent(feed, target_null)) == []


def test_snapshot_diffs_and_null_keys(spark):
    hist = _hist(spark, [("1", "POS", "A", "a", T0, FAR, False), ("2", "POS", "B", "b", T0, FAR, False)])
    snap = _snap(spark, [("2", "POS", "B2", "b"), ("3", "ATM", "C", "c")])
    act = H.active_versions(hist, "2024-01-01 00:00:00")
    assert [r.terminal_id for r in H.snapshot_new(snap, act).collect()] == ["3"]
    assert [r.terminal_id for r in H.snapshot_deleted(act, snap).collect()] == ["1"]
    assert [(r.terminal_id, r.terminal_city) for r in H.snapshot_changed(snap, act).collect()] == [("2", "B2")]
    snap_null = _snap(spark, [("2", "POS", "B", "b"), (None, "ATM", "C", "c")])
    assert H.snapshot_deleted(act, snap_null).count() == 0
    assert H.snapshot_deleted(act, snap_null, null_keys="ignore").count() == 1


def test_changed_null_to_value(spark):
    hist = _hist(spark, [("1", "POS", None, "a", T0, FAR, False)])
    snap = _snap(spark, [("1", "POS", "A", "a")])
    act = H.active_versions(hist, "2024-01-01 00:00:00")
    assert H.snapshot_changed(snap, act).count() == 0
    assert H.snapshot_changed(snap, act, null_safe=True).count() == 1


def test_active_versions_inclusive_bounds(spark):
    hist = _hist(spark, [("1", "POS", "A", "a", ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00"), False),
                         ("2", "POS", "B", "b", ts("2024-01-02 00:00:00"), FAR, False),
                         ("3", "POS", "C", "c", T0, FAR, True)])
    assert sorted(r.terminal_id for r in H.active_versions(hist, "2024-01-02 00:00:00").collect()) == ["1", "2"]


def test_scd2_delete_return_change_reference_and_clean(spark):
    hist = _hist(spark, [("1", "POS", "A", "a", T0, FAR, False)])
    s_delete = _snap(spark, [])
    s_back = _snap(spark, [("1", "POS", "A", "a")])
    s_change = _snap(spark, [("1", "POS", "B", "a")])
    for mode, open_after_return in (("reference", 2), ("clean", 1)):
        h1 = H.scd2_apply(hist, s_delete, "2024-01-10 00:00:00", mode=mode)
        assert _open_rows(h1) == [("1", "A", True)]
        h2 = H.scd2_apply(h1, s_back, "2024-01-11 00:00:00", mode=mode)
        assert len(_open_rows(h2)) == open_after_return
        h3 = H.scd2_apply(h2, s_change, "2024-01-12 00:00:00", mode=mode)
        assert _open_rows(h3) == [("1", "B", False)]
        closed = [r for r in h3.collect() if r.effective_to == ts("2024-01-11 23:59:59")]
        assert len(closed) == open_after_return


def test_scd2_same_snapshot_twice_changes_nothing(spark):
    hist = _hist(spark, [("1", "POS", "A", "a", T0, FAR, False), ("2", "ATM", "B", "b", T0, FAR, False)])
    snap = _snap(spark, [("2", "ATM", "B2", "b"), ("3", "POS", "C", "c")])
    once = H.scd2_apply(hist, snap, "2024-01-10 00:00:00")
    twice = H.scd2_apply(once, snap, "2024-01-11 00:00:00")
    assert _rows(once) == _rows(twice)
    # only key 2 of the closing set {2, 3} exists in the history
    assert H.close_versions(hist, snap.select("terminal_id"), "2024-01-10 00:00:00").count() == 1


def test_duplicate_keys_and_guard(spark):
    batch = spark.createDataFrame([("t1",), ("t1",), ("t2",)], "trans_id string")
    target = spark.createDataFrame([("t2",), ("t9",)], "trans_id string")
    assert _rows(K.duplicate_keys(batch, ["trans_id"])) == [("t1", 2)]
    with pytest.raises(K.DuplicateKeyError):
        K.guard_unique(batch, None, ["trans_id"], "fail")
    with pytest.raises(K.DuplicateKeyError):
        K.guard_unique(spark.createDataFrame([("t2",)], "trans_id string"), target, ["trans_id"], "fail")
    assert _rows(K.guard_unique(batch, target, ["trans_id"], "skip")) == [("t1",)]


def test_orphans(spark):
    child = spark.createDataFrame([("a", "c1"), ("b", "c9"), ("c", None)], "id string, card string")
    parent = spark.createDataFrame([("c1",)], "card_num string")
    assert _rows(K.orphans(child, parent, "card", "card_num")) == [("b", "c9")]


def test_orphan_report_covers_every_foreign_key(spark):
    txn = spark.createDataFrame([("t1", "C1", "T1"), ("t2", "C9", "T9")], "trans_id string, card_num string, terminal string")
    cards = spark.createDataFrame([("C1", "A1"), ("C2", "A9")], "card_num string, account_num string")
    accounts = spark.createDataFrame([("A1", "K1"), ("A2", "K9")], "account_num string, client string")
    clients = spark.createDataFrame([("K1",)], "client_id string")
    terms = _hist(spark, [("T1", "POS", "A", "a", T0, FAR, False)])
    got = _rows(K.orphan_report(txn, cards, accounts, clients, terms))
    assert got == [("accounts.client -> clients", "A2", "K9"),
                   ("cards.account_num -> accounts", "C2", "A9"),
                   ("transactions.card_num -> cards", "t2", "C9"),
                   ("transactions.terminal -> terminals", "t2", "T9")]


def test_key_twice_in_snapshot_is_inserted_twice(spark):
    hist = _hist(spark, [("1", "POS", "A", "a", T0, FAR, False)])
    snap = _snap(spark, [("1", "POS", "B", "a"), ("1", "POS", "B", "a"), ("2", "ATM", "C", "c"), ("2", "ATM", "C", "c")])
    out = H.scd2_apply(hist, snap, "2024-01-10 00:00:00")
    assert sorted(r[0] for r in _rows(out) if r[5] == FAR) == ["1", "1", "2", "2"]
    assert len(_rows(H.snapshot_new(snap, H.active_versions(hist, "2024-01-10 00:00:00")))) == 2
