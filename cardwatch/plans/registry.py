"""Registered queries: every operator run over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables; ``cardwatch.plans.oracle`` holds the DuckDB SQL for the same keys.
Most are lazy; those with a sequence rule run two small jobs while they are
built (the history's row count and the search for hot groups).  Parameters (report day, as-of time, gaps) are fixed values of the
fixture, identical on both sides.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.expressions import full_name
from cardwatch.operators import history as H
from cardwatch.operators import keys as K
from cardwatch.operators import rules as R
from cardwatch.operators.chain import ownership_chain
from cardwatch.plans.flows import FLOWS
from cardwatch.schemas import TRANSACTIONS_FEED
from cardwatch.sources.driver_tables import REPORT_DAY, SERIES_TIMES, SNAPSHOT_AS_OF, DriverTables
from cardwatch.sources.feeds import CSV_SEPARATOR, transactions_from_feed, typed_transactions

# Fixed parameters of the registered queries.
ACTIVE_AS_OF = "2024-01-20 12:00:00"
GUESS_GAP_FIXTURE = _dt.timedelta(hours=24)

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


def q_day_slice(spark, sf_dir):
    return R.day_slice(_t(spark, sf_dir).transactions(), REPORT_DAY)


# Registered outputs carry no DATE column: pass-through dates are projected
# away (DATE converts differently in the engines' pandas bridges).
def q_ownership_chain(spark, sf_dir):
    t = _t(spark, sf_dir)
    chained = ownership_chain(t.transactions().select("trans_id", "card_num"), t.cards(), t.accounts(), t.clients())
    return chained.drop("account_valid_to")


def q_full_name(spark, sf_dir):
    return _t(spark, sf_dir).clients().select("client_id", full_name().alias("fio"))


def q_expired_documents(spark, sf_dir):
    return R.expired_documents(_t(spark, sf_dir).clients(), REPORT_DAY)


def q_listed_documents(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.listed_documents(t.clients(), t.blacklist())


def q_bad_document_union(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.bad_document_union(t.clients(), t.blacklist(), REPORT_DAY)


def _bad_document_ops(day):
    def q(spark, sf_dir):
        t = _t(spark, sf_dir)
        return R.bad_document_ops(t.transactions(), t.clients(), t.accounts(), t.cards(), t.blacklist(), day)
    return q


def _lapsed_contract_ops(day):
    def q(spark, sf_dir):
        t = _t(spark, sf_dir)
        return R.lapsed_contract_ops(t.transactions(), t.clients(), t.accounts(), t.cards(), day)
    return q


def _city_switch(mode, day=None):
    def q(spark, sf_dir):
        t = _t(spark, sf_dir)
        return R.city_switch_ops(t.transactions(), t.terminal_history(), t.clients(), t.accounts(), t.cards(),
                                 day, terminal_join=mode)
    return q


def _declining(k):
    def q(spark, sf_dir):
        t = _t(spark, sf_dir)
        return R.amount_guessing_ops(t.transactions(strict=True), t.clients(), t.accounts(), t.cards(),
                                     None, k=k, max_gap=GUESS_GAP_FIXTURE)
    return q


def _fraud_report(day):
    def q(spark, sf_dir):
        t = _t(spark, sf_dir)
        return R.fraud_report(t.transactions(), t.terminal_history(), t.clients(), t.accounts(), t.cards(),
                              t.blacklist(), day)
    return q


# The busy fixture: the rules at their real settings, and the paths that large
# groups and large histories take (split windows, shuffled history join).
def q_declining_attempts_k3_gap(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.amount_guessing_ops(t.busy_transactions(), t.clients(), t.accounts(), t.cards())


def q_declining_attempts_split(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.amount_guessing_ops(t.busy_transactions(), t.clients(), t.accounts(), t.cards(), k=2,
                                 hot_rows=8, hot_bucket=_dt.timedelta(minutes=5))


def q_city_switch_split(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.city_switch_ops(t.busy_transactions(), t.terminal_history(), t.clients(), t.accounts(), t.cards(),
                             terminal_join="all_versions", max_broadcast_rows=0, hot_rows=2,
                             hot_bucket=_dt.timedelta(minutes=7))


def q_city_switch_carried(spark, sf_dir):
    """The as-of lookup by carried versions, its crowded groups dealt out."""
    t = _t(spark, sf_dir)
    return R.city_switch_ops(t.busy_transactions(), t.terminal_history(), t.clients(), t.accounts(), t.cards(),
                             max_broadcast_rows=0, hot_rows=2)


def _one_second(t: DriverTables):
    """The busy fixture with each day's operations in one whole second."""
    return t.busy_transactions().withColumn("trans_date", F.date_trunc("DAY", "trans_date").cast("timestamp_ntz"))


def q_declining_attempts_one_second(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.amount_guessing_ops(_one_second(t), t.clients(), t.accounts(), t.cards(), hot_rows=3)


def q_scd2_apply_series(spark, sf_dir):
    t = _t(spark, sf_dir)
    return H.scd2_apply_series(t.snapshot_old_history(), t.snapshot_series(), SERIES_TIMES)


def q_scd2_apply_series_clean(spark, sf_dir):
    t = _t(spark, sf_dir)
    return H.scd2_apply_series(t.snapshot_old_history(), t.snapshot_series(), SERIES_TIMES, mode="clean")


def q_fraud_report_busy(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.fraud_report(t.busy_transactions(), t.terminal_history(), t.clients(), t.accounts(), t.cards(),
                          t.blacklist())


def q_parse_feed_lines(spark, sf_dir):
    lines = _t(spark, sf_dir).feed_lines()
    ddl = ", ".join(f"{n} STRING" for n in TRANSACTIONS_FEED.fieldNames())
    raw = lines.select(F.from_csv("line", ddl, {"sep": CSV_SEPARATOR, "escape": '"'}).alias("r")).select("r.*")
    return typed_transactions(raw).select(
        "transaction_id", "transaction_date", (F.col("amount") * 100).cast("long").alias("amount_cents"), "card_num",
        "oper_type", "oper_result", "terminal", "bad_time", "bad_amount")


def q_unique_keys_guarded(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.guard_unique(t.keyed_batch(), t.loaded_keys(), ["trans_id"], "skip")


def q_orphan_report(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.orphan_report(t.busy_transactions(), t.cards().where(F.col("card_num") % 7 != 0),
                           t.accounts().where(F.col("account_num") % 11 != 0),
                           t.clients().where(F.col("client_id") % 13 != 0), t.terminal_history())


def q_rename_transactions(spark, sf_dir):
    return transactions_from_feed(_t(spark, sf_dir).transactions_feed())


def q_insert_if_absent(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.insert_if_absent(t.blacklist_feed(), t.blacklist()).select("passport_num")


def q_insert_if_absent_null_list(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.insert_if_absent(t.blacklist_feed(), t.blacklist_with_null()).select("passport_num")


def q_insert_if_absent_ignore_nulls(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.insert_if_absent(t.blacklist_feed(), t.blacklist_with_null(), null_keys="ignore").select("passport_num")


def q_active_versions(spark, sf_dir):
    return H.active_versions(_t(spark, sf_dir).terminal_history(), ACTIVE_AS_OF)


def _snapshot_parts(spark, sf_dir):
    t = _t(spark, sf_dir)
    old = t.snapshot_old_history()
    return old, H.active_versions(old, SNAPSHOT_AS_OF), t.snapshot_new()


def q_snapshot_new(spark, sf_dir):
    _, active, snap = _snapshot_parts(spark, sf_dir)
    return H.snapshot_new(snap, active)


def q_snapshot_deleted(spark, sf_dir):
    _, active, snap = _snapshot_parts(spark, sf_dir)
    return H.snapshot_deleted(active, snap)


def q_snapshot_changed(spark, sf_dir):
    _, active, snap = _snapshot_parts(spark, sf_dir)
    return H.snapshot_changed(snap, active)


def q_open_versions(spark, sf_dir):
    _, active, snap = _snapshot_parts(spark, sf_dir)
    return (H.open_versions(H.snapshot_new(snap, active), SNAPSHOT_AS_OF)
            .unionByName(H.open_versions(H.snapshot_changed(snap, active), SNAPSHOT_AS_OF)))


def q_close_versions(spark, sf_dir):
    old, active, snap = _snapshot_parts(spark, sf_dir)
    closing = (H.snapshot_deleted(active, snap).select("terminal_id")
               .unionByName(H.snapshot_changed(snap, active).select("terminal_id")))
    return H.close_versions(old, closing, SNAPSHOT_AS_OF)


def q_tombstones(spark, sf_dir):
    _, active, snap = _snapshot_parts(spark, sf_dir)
    return H.tombstones(H.snapshot_deleted(active, snap), SNAPSHOT_AS_OF)


def q_scd2_apply(spark, sf_dir):
    t = _t(spark, sf_dir)
    return H.scd2_apply(t.snapshot_old_history(), t.snapshot_new(), SNAPSHOT_AS_OF)


def q_duplicate_keys(spark, sf_dir):
    return K.duplicate_keys(_t(spark, sf_dir).raw("lineitem"), ["l_orderkey", "l_linenumber"])


def q_orphans(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.orphans(t.transactions().select("trans_id", "card_num"),
                     t.cards().where(F.col("card_num") % 7 != 0), "card_num")


QUERIES: dict[str, Query] = {
    "day_slice": q_day_slice,
    "ownership_chain": q_ownership_chain,
    "full_name": q_full_name,
    "expired_documents": q_expired_documents,
    "listed_documents": q_listed_documents,
    "bad_document_union": q_bad_document_union,
    "bad_document_ops": _bad_document_ops(None),
    "bad_document_ops_day": _bad_document_ops(REPORT_DAY),
    "lapsed_contract_ops": _lapsed_contract_ops(None),
    "lapsed_contract_ops_day": _lapsed_contract_ops(REPORT_DAY),
    "city_switch_all_versions": _city_switch("all_versions"),
    "city_switch_as_of": _city_switch("as_of"),
    "city_switch_all_versions_day": _city_switch("all_versions", REPORT_DAY),
    "city_switch_as_of_day": _city_switch("as_of", REPORT_DAY),
    "city_switch_split": q_city_switch_split,
    "declining_attempts_k3_gap": q_declining_attempts_k3_gap,
    "declining_attempts_split": q_declining_attempts_split,
    "fraud_report_busy": q_fraud_report_busy,
    "city_switch_carried": q_city_switch_carried,
    "declining_attempts_one_second": q_declining_attempts_one_second,
    "scd2_apply_series": q_scd2_apply_series,
    "scd2_apply_series_clean": q_scd2_apply_series_clean,
    "parse_feed_lines": q_parse_feed_lines,
    "unique_keys_guarded": q_unique_keys_guarded,
    "orphan_report": q_orphan_report,
    "declining_attempts_k2": _declining(2),
    "declining_attempts_k3": _declining(3),
    "fraud_report": _fraud_report(None),
    "fraud_report_day": _fraud_report(REPORT_DAY),
    "rename_transactions": q_rename_transactions,
    "insert_if_absent": q_insert_if_absent,
    "insert_if_absent_null_list": q_insert_if_absent_null_list,
    "insert_if_absent_ignore_nulls": q_insert_if_absent_ignore_nulls,
    "active_versions": q_active_versions,
    "snapshot_new": q_snapshot_new,
    "snapshot_deleted": q_snapshot_deleted,
    "snapshot_changed": q_snapshot_changed,
    "open_versions": q_open_versions,
    "close_versions": q_close_versions,
    "tombstones": q_tombstones,
    "scd2_apply": q_scd2_apply,
    "duplicate_keys": q_duplicate_keys,
    "orphans": q_orphans,
    **FLOWS,
}
