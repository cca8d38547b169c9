"""Key operators: SQL ``NOT IN`` (L1, L3, L4), primary-key guard (K1),
orphan report (K2) and insert-if-absent (L1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """Raised by :func:`guard_unique` under the ``fail`` policy."""


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
           null_keys: str = "reference") -> DataFrame:
    """Rows of ``left`` whose key is ``NOT IN`` the keys of ``right``.

    ``null_keys='reference'`` keeps SQL semantics: one NULL key on the right
    empties the result, and a NULL left key survives only an empty right
    side.  It is planned as an ordinary anti join (broadcast when small,
    shuffle otherwise; Spark's null-aware anti join would need the right side
    broadcast) plus two scalar subqueries that each read the right key column
    once.  ``null_keys='ignore'`` is a plain anti join: NULLs never match.
    """
    right_key = right_key or left_key
    keys = right.select(F.col(right_key).alias("_nin_key"))
    kept = left.join(keys, left[left_key] == keys["_nin_key"], "left_anti")
    if null_keys == "ignore":
        return kept
    if null_keys != "reference":
        raise ValueError(f"unknown null_keys {null_keys!r}")
    # One aggregate over the right keys answers both questions; the two
    # references are the same subquery, which Spark runs once.
    stats = keys.select(F.struct(
        F.coalesce(F.max(F.col("_nin_key").isNull()), F.lit(False)).alias("has_null"),
        (F.count(F.lit(1)) == 0).alias("empty"))).scalar()
    return kept.where(~stats.getField("has_null")
                      & (F.col(left_key).isNotNull() | stats.getField("empty")))


def insert_if_absent(feed: DataFrame, target: DataFrame, key: str = "passport_num",
                     target_key: str | None = None, null_keys: str = "reference") -> DataFrame:
    """L1: feed rows whose key is not yet in ``target`` (rows to append).

    Only the target is checked: a key repeated inside the feed is kept every
    time, as the reference does."""
    return not_in(feed, target, key, target_key, null_keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K1 report: key values held by more than one row, with their count.

    The count is partially aggregated before the shuffle, so a key holding a
    large share of all rows costs one row per map task in the exchange."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def guard_unique(batch: DataFrame, target: DataFrame | None, keys: Sequence[str],
                 policy: str = "fail") -> DataFrame:
    """K1: enforce a primary key when appending ``batch`` to ``target``.

    Rows with a NULL key pass under either policy, as a text primary key
    admits any number of NULLs.

    ``fail`` raises :class:`DuplicateKeyError` if a key repeats inside the
    batch or already exists in the target (this check runs a job).
    ``skip`` keeps one row per new key, lazily: the one whose other columns,
    in their order, are smallest (NULLs first), combined map-side."""
    keys = list(keys)
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    if policy == "skip":
        rest = [c for c in batch.columns if c not in keys]
        fresh = batch.where(keyed)
        if rest:
            fresh = (fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
                     .select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in batch.columns]))
        else:
            fresh = fresh.distinct()
        if target is not None:
            fresh = fresh.join(target.select(*keys), keys, "left_anti").select(*batch.columns)
        return fresh.unionByName(batch.where(~keyed))
    if policy != "fail":
        raise ValueError(f"unknown policy {policy!r}")
    clash = duplicate_keys(batch.where(keyed), keys).select(*keys)
    if target is not None:
        clash = clash.unionByName(batch.select(*keys).join(target.select(*keys), keys, "left_semi"))
    if not clash.isEmpty():
        raise DuplicateKeyError(f"primary key {keys} violated")
    return batch


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """K2: rows of ``child`` whose reference has no parent row (NULL
    references are not orphans, as a foreign key allows them)."""
    parent_key = parent_key or child_key
    parents = parent.select(F.col(parent_key).alias("_parent_key"))
    return (child.where(F.col(child_key).isNotNull())
            .join(parents, F.col(child_key) == parents["_parent_key"], "left_anti"))


def orphan_report(transactions: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  terminals: DataFrame) -> DataFrame:
    """K2 for every foreign key the warehouse declares: card -> account,
    account -> client, transaction -> card, transaction -> terminal.

    Returns ``(relation, row_key, reference)`` for each orphan row; each
    relation is one anti join (broadcast or shuffled by AQE)."""
    checks = [
        ("cards.account_num -> accounts", cards, "card_num", "account_num", accounts, "account_num"),
        ("accounts.client -> clients", accounts, "account_num", "client", clients, "client_id"),
        ("transactions.card_num -> cards", transactions, "trans_id", "card_num", cards, "card_num"),
        ("transactions.terminal -> terminals", transactions, "trans_id", "terminal", terminals, "terminal_id"),
    ]
    parts = []
    for relation, child, row_key, ref, parent, parent_key in checks:
        found = orphans(child.select(row_key, ref), parent.select(parent_key), ref, parent_key)
        parts.append(found.select(F.lit(relation).alias("relation"),
                                  F.col(row_key).cast("string").alias("row_key"),
                                  F.col(ref).cast("string").alias("reference")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
