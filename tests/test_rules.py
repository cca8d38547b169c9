"""Literal boundary cases of R1-R4 (FIXTURES section 4)."""

import datetime as dt

from conftest import HIST_SCHEMA, Bank, ts

from cardwatch.operators import rules as R

DAY = "2024-01-20"


def _events(df):
    return sorted((r.event_dt.isoformat(sep=" "), r.passport, r.event_type) for r in df.collect())


# -- R1 / R2 -------------------------------------------------------------------

def test_expired_document_boundaries(spark):
    b = Bank(spark, 3, passport_valid_to={1: dt.date(2024, 1, 20), 2: dt.date(2024, 1, 19), 3: None})
    t = b.txns([(f"t{i}", f"{DAY} 10:00:00", 10, f"C{i}", "SUCCESS", "T") for i in (1, 2, 3)])
    bl = spark.createDataFrame([], "passport_num string")
    out = _events(R.bad_document_ops(t, b.clients, b.accounts, b.cards, bl, DAY))
    assert out == [(f"{DAY} 10:00:00", "DOC2", "overdue_passport")]
    assert _events(R.bad_document_ops(t, b.clients, b.accounts, b.cards, bl, None)) == out


def test_expired_and_listed_gives_two_rows(spark):
    b = Bank(spark, 1, passport_valid_to={1: dt.date(2024, 1, 1)})
    t = b.txns([("t1", f"{DAY} 10:00:00", 10, "C1", "SUCCESS", "T")])
    bl = spark.createDataFrame([("DOC1",)], "passport_num string")
    out = R.bad_document_ops(t, b.clients, b.accounts, b.cards, bl, DAY)
    assert sorted(r.event_type for r in out.collect()) == ["blocked_passport", "overdue_passport"]


def test_listed_after_operation_still_reported_and_reject_or_other_day_not(spark):
    b = Bank(spark, 1)
    t = b.txns([("t1", f"{DAY} 10:00:00", 10, "C1", "SUCCESS", "T"),
                ("t2", f"{DAY} 11:00:00", 10, "C1", "REJECT", "T"),
                ("t3", "2024-01-21 10:00:00", 10, "C1", "SUCCESS", "T")])
    bl = spark.createDataFrame([("DOC1", dt.date(2030, 1, 1))], "passport_num string, entry_dt date")
    out = _events(R.bad_document_ops(t, b.clients, b.accounts, b.cards, bl, DAY))
    assert out == [(f"{DAY} 10:00:00", "DOC1", "blocked_passport")]


def test_null_patronymic_keeps_row_with_null_name(spark):
    b = Bank(spark, 1, passport_valid_to={1: dt.date(2024, 1, 1)}, patronymic=None)
    t = b.txns([("t1", f"{DAY} 10:00:00", 10, "C1", "SUCCESS", "T")])
    bl = spark.createDataFrame([], "passport_num string")
    rows = R.bad_document_ops(t, b.clients, b.accounts, b.cards, bl, DAY).collect()
    assert len(rows) == 1 and rows[0].fio is None


def test_lapsed_contract_boundaries(spark):
    b = Bank(spark, 2, account_valid_to={1: dt.date(2024, 1, 20), 2: dt.date(2024, 1, 19)})
    t = b.txns([("t1", f"{DAY} 10:00:00", 10, "C1", "SUCCESS", "T"),
                ("t2", f"{DAY} 10:00:00", 10, "C2", "SUCCESS", "T"),
                ("t3", f"{DAY} 11:00:00", 10, "C2", "REJECT", "T")])
    out = _events(R.lapsed_contract_ops(t, b.clients, b.accounts, b.cards, DAY))
    assert out == [(f"{DAY} 10:00:00", "DOC2", "overdue_account")]
    assert _events(R.lapsed_contract_ops(t, b.clients, b.accounts, b.cards, None)) == out


# -- R3 ------------------------------------------------------------------------

def _history(spark, rows=None):
    far = ts("2999-12-31 23:59:59")
    start = ts("2023-01-01 00:00:00")
    rows = rows or [("TA", "POS", "CityA", "a", start, far, False),
                    ("TB", "POS", "CityB", "b", start, far, False)]
    return spark.createDataFrame(rows, HIST_SCHEMA)


def _r3(spark, b, t, hist=None, mode="as_of", day=DAY, **kw):
    return _events(R.city_switch_ops(t, hist if hist is not None else _history(spark), b.clients,
                                     b.accounts, b.cards, day, terminal_join=mode, **kw))


def test_city_switch_gap_boundaries(spark):
    b = Bank(spark, 2)
    t = b.txns([("t1", f"{DAY} 10:00:00", 1, "C1", "SUCCESS", "TA"),
                ("t2", f"{DAY} 10:59:59", 1, "C1", "SUCCESS", "TB"),
                ("t3", f"{DAY} 10:00:00", 1, "C2", "SUCCESS", "TA"),
                ("t4", f"{DAY} 11:00:00", 1, "C2", "SUCCESS", "TB")])
    assert _r3(spark, b, t) == [(f"{DAY} 10:59:59", "DOC1", "diff_city")]


def test_city_switch_a_b_a_and_reject_and_midnight(spark):
    b = Bank(spark, 3)
    t = b.txns([("t1", f"{DAY} 10:00:00", 1, "C1", "SUCCESS", "TA"),
                ("t2", f"{DAY} 10:10:00", 1, "C1", "SUCCESS", "TB"),
                ("t3", f"{DAY} 10:20:00", 1, "C1", "SUCCESS", "TA"),
                ("u1", f"{DAY} 10:00:00", 1, "C2", "SUCCESS", "TA"),
                ("u2", f"{DAY} 10:10:00", 1, "C2", "REJECT", "TB"),
                ("u3", f"{DAY} 10:20:00", 1, "C2", "SUCCESS", "TA"),
                ("v1", "2024-01-19 23:50:00", 1, "C3", "SUCCESS", "TA"),
                ("v2", f"{DAY} 00:10:00", 1, "C3", "SUCCESS", "TB")])
    assert _r3(spark, b, t, day=None) == [(f"{DAY} 10:10:00", "DOC1", "diff_city"),
                                          (f"{DAY} 10:20:00", "DOC1", "diff_city")]


def test_city_switch_unknown_terminal_is_skipped(spark):
    b = Bank(spark, 1)
    t = b.txns([("t1", f"{DAY} 10:00:00", 1, "C1", "SUCCESS", "TA"),
                ("t2", f"{DAY} 10:05:00", 1, "C1", "SUCCESS", "T?"),
                ("t3", f"{DAY} 10:10:00", 1, "C1", "SUCCESS", "TB")])
    assert _r3(spark, b, t) == [(f"{DAY} 10:10:00", "DOC1", "diff_city")]


def test_city_switch_version_fan_out(spark):
    far = ts("2999-12-31 23:59:59")
    hist = _history(spark, [
        ("TA", "POS", "CityA", "a", ts("2023-01-01 00:00:00"), ts("2024-01-14 23:59:59"), False),
        ("TA", "POS", "CityB", "a", ts("2024-01-15 00:00:00"), far, False)])
    b = Bank(spark, 1)
    t = b.txns([("t1", f"{DAY} 10:00:00", 1, "C1", "SUCCESS", "TA")])
    assert _r3(spark, b, t, hist, "all_versions") == [(f"{DAY} 10:00:00", "DOC1", "diff_city")]
    assert _r3(spark, b, t, hist, "as_of") == []


# -- R4 ------------------------------------------------------------------------

def _guess(b, rows, day=DAY, **kw):
    t = b.txns(rows)
    return _events(R.amount_guessing_ops(t, b.clients, b.accounts, b.cards, day, **kw))


def _seq(card, start, amounts, results, step_s):
    base = ts(start)
    return [(f"{card}-{i}", (base + dt.timedelta(seconds=i * step_s)).isoformat(sep=" "), a, card, r, "T")
            for i, (a, r) in enumerate(zip(amounts, results))]


RRRS = ["REJECT", "REJECT", "REJECT", "SUCCESS"]


def test_guessing_gap_boundary(spark):
    b = Bank(spark, 2)
    # 3 steps of 399.666..s would not be exact; use 19:59 and 20:00 totals.
    rows = _seq("C1", f"{DAY} 10:00:00", [400, 300, 200, 100], RRRS, 0)
    rows[1] = (rows[1][0], f"{DAY} 10:05:00", 300, "C1", "REJECT", "T")
    rows[2] = (rows[2][0], f"{DAY} 10:10:00", 200, "C1", "REJECT", "T")
    rows[3] = (rows[3][0], f"{DAY} 10:19:59", 100, "C1", "SUCCESS", "T")
    rows2 = [(f"x{i}", t.replace("10:19:59", "10:20:00"), a, "C2", r, term)
             for i, (_, t, a, c, r, term) in enumerate(rows)]
    assert _guess(b, rows + rows2) == [(f"{DAY} 10:19:59", "DOC1", "sum_guessing")]


def test_guessing_truncation_and_shapes(spark):
    b = Bank(spark, 3)
    equal_after_trunc = _seq("C1", f"{DAY} 10:00:00", [400.5, 300.9, 100.9, 100.1], RRRS, 60)
    success_between = _seq("C2", f"{DAY} 10:00:00", [400, 300, 200, 100],
                           ["REJECT", "SUCCESS", "REJECT", "SUCCESS"], 60)
    four_falling = _seq("C3", f"{DAY} 10:00:00", [500, 400, 300, 200, 100],
                        ["REJECT"] * 4 + ["SUCCESS"], 60)
    out = _guess(b, equal_after_trunc + success_between + four_falling)
    assert out == [(f"{DAY} 10:04:00", "DOC3", "sum_guessing")]


def test_guessing_crossing_midnight_not_reported(spark):
    b = Bank(spark, 1)
    rows = _seq("C1", "2024-01-19 23:58:00", [400, 300, 200, 100], RRRS, 60)
    assert _guess(b, rows, day=None) == []


def test_guessing_k2(spark):
    b = Bank(spark, 1)
    rows = _seq("C1", f"{DAY} 10:00:00", [300, 200, 100], ["REJECT", "REJECT", "SUCCESS"], 60)
    assert _guess(b, rows, k=2) == [(f"{DAY} 10:02:00", "DOC1", "sum_guessing")]
    assert _guess(b, rows, k=3) == []


def test_repeated_client_row_reported_once(spark):
    b = Bank(spark, 1, passport_valid_to={1: dt.date(2024, 1, 1)})
    clients = b.clients.unionByName(b.clients)  # the same client row twice
    t = b.txns([("t1", f"{DAY} 10:00:00", 10, "C1", "SUCCESS", "T")])
    bl = spark.createDataFrame([], "passport_num string")
    assert R.bad_document_ops(t, clients, b.accounts, b.cards, bl, DAY).count() == 1
    # with the uniqueness promise (warehouse, K1) the dedupe is skipped
    assert R.bad_document_ops(t, b.clients, b.accounts, b.cards, bl, DAY, clients_unique=True).count() == 1


def test_account_without_end_date_never_lapses(spark):
    b = Bank(spark, 2, account_valid_to={1: None, 2: dt.date(2024, 1, 1)})
    t = b.txns([("t1", f"{DAY} 10:00:00", 10, "C1", "SUCCESS", "T"),
                ("t2", f"{DAY} 10:00:00", 10, "C2", "SUCCESS", "T")])
    bl = spark.createDataFrame([], "passport_num string")
    expect = [(f"{DAY} 10:00:00", "DOC2", "overdue_account")]
    assert _events(R.lapsed_contract_ops(t, b.clients, b.accounts, b.cards, DAY)) == expect
    assert _events(R.lapsed_contract_ops(t, b.clients, b.accounts, b.cards, None)) == expect
    both = R.document_and_contract_ops(t, b.clients, b.accounts, b.cards, bl, None)
    assert _events(both) == expect
