"""Fraud rules R1-R5.

``day=None`` runs a rule over all days at once: each operation is judged
against its own calendar day, and sequences never cross midnight, which is
exactly the union of one run per day.  With a ``day`` the day filter is
applied first and reaches the parquet scan as a pushed range filter (and as
partition pruning on a day-partitioned fact table).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.expressions import (
    SUCCESS,
    TAG_BLOCKED_PASSPORT,
    TAG_DIFF_CITY,
    TAG_OVERDUE_ACCOUNT,
    TAG_OVERDUE_PASSPORT,
    TAG_SUM_GUESSING,
    date_lit,
    day_of,
)
from cardwatch.operators.asof import as_of_lookup
from cardwatch.operators.chain import cards_of_clients, owner_columns, ownership_chain, to_report
from cardwatch.operators.sequences import (
    HOT_BUCKET,
    HOT_ROWS,
    HotGroups,
    attribute_switch,
    declining_attempts,
    find_hot_groups,
)
from cardwatch.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded, bounded

DayLike = _dt.date | str | None

CITY_GAP = _dt.timedelta(minutes=60)
GUESS_GAP = _dt.timedelta(minutes=20)
GUESS_ATTEMPTS = 3


def day_slice(transactions: DataFrame, day: DayLike, ts: str = "trans_date") -> DataFrame:
    """Operations of one calendar day (all rows when ``day`` is None)."""
    if day is None:
        return transactions
    return transactions.where(day_of(ts) == date_lit(day))


def _successful(transactions: DataFrame, day: DayLike) -> DataFrame:
    return day_slice(transactions, day).where(F.col("oper_result") == F.lit(SUCCESS))


# -- R1: operations under an expired or listed document ----------------------

def expired_documents(clients: DataFrame, day: DayLike) -> DataFrame:
    """Clients whose document expired before ``day``.

    With ``day=None`` every client with an expiry date is returned (the
    all-days rules compare the expiry with each operation's own day)."""
    base = clients.where(F.col("passport_valid_to").isNotNull())
    if day is not None:
        base = base.where(date_lit(day) > F.col("passport_valid_to"))
    return owner_columns(base).withColumn("event_type", F.lit(TAG_OVERDUE_PASSPORT))


def listed_documents(clients: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clients whose document is on the blacklist (``IN`` = semi join)."""
    listed = clients.join(blacklist.select("passport_num"), "passport_num", "left_semi")
    return owner_columns(listed).withColumn("event_type", F.lit(TAG_BLOCKED_PASSPORT))


def bad_document_union(clients: DataFrame, blacklist: DataFrame, day: _dt.date | str) -> DataFrame:
    """Distinct union of R1a and R1b for one day (a client in both gives
    two rows, as the tags differ)."""
    return expired_documents(clients, day).unionByName(listed_documents(clients, blacklist)).distinct()


SUSPECT_COLUMNS = ["card_num", "passport_num", "fio", "phone", "event_type", "_cutoff"]


def _document_suspects(clients: DataFrame, accounts: DataFrame, cards: DataFrame, blacklist: DataFrame,
                       day: DayLike, clients_unique: bool = False) -> DataFrame:
    """Cards whose owner has an expired or listed document (R1c extended to
    cards), with ``_cutoff``: the expiry date (an operation counts only after
    it) or NULL for listed documents.

    R1c's ``UNION`` removes repeated client rows; when ``clients`` is known
    to hold one row per client (the warehouse enforces it, K1) that shuffle
    is skipped."""
    exp = clients.where(F.col("passport_valid_to").isNotNull())
    if day is not None:
        exp = exp.where(date_lit(day) > F.col("passport_valid_to"))
    exp = (owner_columns(exp, "passport_valid_to")
           .select("*", F.lit(TAG_OVERDUE_PASSPORT).alias("event_type"))
           .withColumnRenamed("passport_valid_to", "_cutoff"))
    listed = (owner_columns(clients.join(blacklist.select("passport_num"), "passport_num", "left_semi"))
              .select("*", F.lit(TAG_BLOCKED_PASSPORT).alias("event_type"),
                      F.lit(None).cast("date").alias("_cutoff")))
    bad = exp.unionByName(listed)
    if not clients_unique:
        bad = bad.distinct()
    return cards_of_clients(bad, accounts, cards).select(*SUSPECT_COLUMNS)


def _contract_suspects(clients: DataFrame, accounts: DataFrame, cards: DataFrame, day: DayLike) -> DataFrame:
    """Cards on accounts whose contract ended, ``_cutoff`` = its end date.
    An account without an end date never lapses (``day > NULL`` is NULL)."""
    acc = accounts.where(F.col("valid_to").isNotNull())
    if day is not None:
        acc = acc.where(date_lit(day) > F.col("valid_to"))
    owners = cards_of_clients(owner_columns(clients), acc, cards)
    return (owners.select("*", F.lit(TAG_OVERDUE_ACCOUNT).alias("event_type"),
                          F.col("account_valid_to").alias("_cutoff"))
            .select(*SUSPECT_COLUMNS))


def ops_on_suspect_cards(transactions: DataFrame, suspects: DataFrame, day: DayLike) -> DataFrame:
    """Successful operations of ``day`` on suspect cards, after the cutoff."""
    joined = _successful(transactions, day).join(suspects, "card_num").where(
        F.col("_cutoff").isNull() | (day_of("trans_date") > F.col("_cutoff")))
    return to_report(joined)


def bad_document_ops(transactions: DataFrame, clients: DataFrame, accounts: DataFrame,
                     cards: DataFrame, blacklist: DataFrame, day: DayLike = None,
                     clients_unique: bool = False) -> DataFrame:
    """Successful operations of ``day`` under an expired or listed document.

    Both document sets are united first (with their expiry date, NULL for
    listed ones), extended to cards, and joined to the operations once, so
    the fact side is read and shuffled a single time."""
    suspects = _document_suspects(clients, accounts, cards, blacklist, day, clients_unique)
    return ops_on_suspect_cards(transactions, suspects, day)


# -- R2: operations under a lapsed contract ----------------------------------

def lapsed_contract_ops(transactions: DataFrame, clients: DataFrame, accounts: DataFrame,
                        cards: DataFrame, day: DayLike = None) -> DataFrame:
    """R2: successful operations of ``day`` on an account whose contract
    ended before that day."""
    return ops_on_suspect_cards(transactions, _contract_suspects(clients, accounts, cards, day), day)


def document_and_contract_ops(transactions: DataFrame, clients: DataFrame, accounts: DataFrame,
                              cards: DataFrame, blacklist: DataFrame, day: DayLike = None,
                              clients_unique: bool = False) -> DataFrame:
    """R1 and R2 together (all rows of both): the two suspect-card sets are
    united and joined to the day's operations once, so the report shuffles
    the fact side for both rules a single time."""
    suspects = (_document_suspects(clients, accounts, cards, blacklist, day, clients_unique)
                .unionByName(_contract_suspects(clients, accounts, cards, day)))
    return ops_on_suspect_cards(transactions, suspects, day)


# An operation without a time or a card is in no sequence: it can be neither a
# finding nor the row before one (its own group would hold it alone).
_PLACED = "trans_date IS NOT NULL AND card_num IS NOT NULL"


# -- R3: operations in two cities within an hour -----------------------------

def city_switch_findings(transactions: DataFrame, history: DataFrame, day: DayLike = None,
                         terminal_join: str = "as_of", max_gap: _dt.timedelta = CITY_GAP,
                         max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                         hot_rows: int = HOT_ROWS, hot_bucket: _dt.timedelta = HOT_BUCKET,
                         hot: HotGroups | None = None) -> DataFrame:
    """R3 before the owner lookup: ``(trans_date, card_num, event_type)``."""
    hist = history.select("terminal_id", "terminal_city", "effective_from", "effective_to", "deleted_flg")
    ops = (_successful(transactions, day).where(_PLACED)
           .select("trans_id", "trans_date", "card_num", "terminal"))
    if terminal_join == "as_of":
        hist = hist.where(~F.col("deleted_flg"))
        if bounded(hist, max_broadcast_rows):
            valid = ops["trans_date"].between(hist["effective_from"], hist["effective_to"])
            located = ops.join(F.broadcast(hist), (ops["terminal"] == hist["terminal_id"]) & valid)
        else:
            located = as_of_lookup(ops.where("terminal IS NOT NULL"), hist, "terminal", "trans_date", "terminal_id",
                                   "effective_from", "effective_to", ["terminal_city", "effective_from"], hot_rows)
    elif terminal_join == "all_versions":
        hist = broadcast_if_bounded(hist, max_broadcast_rows)
        located = ops.join(hist, ops["terminal"] == hist["terminal_id"])
    else:
        raise ValueError(f"unknown terminal_join {terminal_join!r}")
    located = located.select("trans_id", "trans_date", "card_num", "terminal_city", "effective_from")
    # Ties in time: versions by start, then city, then the operation id.
    switched = attribute_switch(located, "card_num", "trans_date", "terminal_city", max_gap,
                                order_extra=("effective_from", "terminal_city", "trans_id"), hot_rows=hot_rows,
                                hot_bucket=hot_bucket, hot=hot)
    return switched.select("trans_date", "card_num", F.lit(TAG_DIFF_CITY).alias("event_type"))


def city_switch_ops(transactions: DataFrame, history: DataFrame, clients: DataFrame,
                    accounts: DataFrame, cards: DataFrame, day: DayLike = None,
                    terminal_join: str = "as_of", max_gap: _dt.timedelta = CITY_GAP,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    hot_rows: int = HOT_ROWS, hot_bucket: _dt.timedelta = HOT_BUCKET) -> DataFrame:
    """A successful operation in another city than the card's previous
    successful operation of the same day, less than ``max_gap`` later.

    ``terminal_join='all_versions'`` joins every history version of the
    terminal (the reference's behaviour: a terminal with two versions doubles
    its operations); ``'as_of'`` joins the version valid at the operation
    time.  Operations at unknown terminals drop out before the sequence is
    formed.  The history is broadcast after a row-count check, so the
    window's shuffle by card is the rule's only large exchange; beyond the
    bound the versions are carried forward to the operations (``asof``).  Hot
    (card, day) groups are split as described in ``sequences``."""
    found = city_switch_findings(transactions, history, day, terminal_join, max_gap, max_broadcast_rows,
                                 hot_rows, hot_bucket)
    return to_report(ownership_chain(found, cards, accounts, clients))


# -- R4: amount guessing -----------------------------------------------------

def amount_guessing_findings(transactions: DataFrame, day: DayLike = None, k: int = GUESS_ATTEMPTS,
                             max_gap: _dt.timedelta = GUESS_GAP, hot_rows: int = HOT_ROWS,
                             hot_bucket: _dt.timedelta = HOT_BUCKET, hot: HotGroups | None = None) -> DataFrame:
    """R4 before the owner lookup: ``(trans_date, card_num, event_type)``."""
    ops = (day_slice(transactions, day).where(_PLACED)
           .select("trans_id", "trans_date", "card_num", "amt", "oper_result"))
    found = declining_attempts(ops, "card_num", "trans_date", "oper_result", "amt", k=k,
                               max_gap=max_gap, order_extra=("trans_id",), hot_rows=hot_rows,
                               hot_bucket=hot_bucket, hot=hot)
    return found.select("trans_date", "card_num", F.lit(TAG_SUM_GUESSING).alias("event_type"))


def amount_guessing_ops(transactions: DataFrame, clients: DataFrame, accounts: DataFrame,
                        cards: DataFrame, day: DayLike = None, k: int = GUESS_ATTEMPTS,
                        max_gap: _dt.timedelta = GUESS_GAP,
                        hot_rows: int = HOT_ROWS, hot_bucket: _dt.timedelta = HOT_BUCKET) -> DataFrame:
    """A successful operation after ``k`` refused ones of the same card
    and day with strictly falling whole-unit amounts, all within ``max_gap``."""
    found = amount_guessing_findings(transactions, day, k, max_gap, hot_rows, hot_bucket)
    return to_report(ownership_chain(found, cards, accounts, clients))


# -- R5: all rules -------------------------------------------------------------

def fraud_report(transactions: DataFrame, history: DataFrame, clients: DataFrame, accounts: DataFrame,
                 cards: DataFrame, blacklist: DataFrame, day: DayLike = None,
                 terminal_join: str = "as_of", guess_k: int = GUESS_ATTEMPTS,
                 guess_gap: _dt.timedelta = GUESS_GAP,
                 guess_transactions: DataFrame | None = None, clients_unique: bool = False,
                 hot_rows: int = HOT_ROWS, hot_bucket: _dt.timedelta = HOT_BUCKET,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, hot: HotGroups | None = None) -> DataFrame:
    """R1, R2, R3 and R4, all rows kept (no dedupe between rules).

    R1 and R2 share one join with the operations (see
    :func:`document_and_contract_ops`); R3 and R4 share one search for hot
    groups over the day's operations (with ``all_versions`` R3 searches again
    after its join, which multiplies rows); their findings are united and
    looked up in the ownership chain once.

    Operations that are already partitioned by ``card_num`` (a cached
    ``repartition("card_num")``, as the daily runs keep) need no further
    exchange of the fact for either window."""
    if hot is None:
        hot = find_hot_groups(day_slice(transactions, day).where(_PLACED), "card_num", "trans_date", hot_rows)
    sequences = city_switch_findings(transactions, history, day, terminal_join, max_broadcast_rows=max_broadcast_rows,
                                     hot_rows=hot_rows, hot_bucket=hot_bucket,
                                     hot=hot if terminal_join == "as_of" else None).unionByName(
        amount_guessing_findings(guess_transactions if guess_transactions is not None else transactions,
                                 day, guess_k, guess_gap, hot_rows=hot_rows, hot_bucket=hot_bucket, hot=hot))
    return (document_and_contract_ops(transactions, clients, accounts, cards, blacklist, day, clients_unique)
            .unionByName(to_report(ownership_chain(sequences, cards, accounts, clients))))
