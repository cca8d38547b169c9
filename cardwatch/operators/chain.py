"""Card -> account -> client ownership chain, and the report shape.

All joins are inner equi-joins written from the smaller side outwards; AQE
turns each into a broadcast when the runtime size of a side allows, else
they stay shuffle joins, so no dimension is assumed to fit in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.expressions import full_name

REPORT_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type"]


def owner_columns(clients: DataFrame, *extra: str) -> DataFrame:
    """Client attributes the report needs: id, passport, C2 full name, phone
    (plus any ``extra`` client columns)."""
    return clients.select("client_id", "passport_num", full_name().alias("fio"), "phone", *extra)


def cards_of_clients(owners: DataFrame, accounts: DataFrame, cards: DataFrame) -> DataFrame:
    """``owners`` (keyed by ``client_id``) extended to every card they hold.

    Start from a (filtered) client set: the chain runs client -> account ->
    card, so a selective client filter shrinks both later joins."""
    a = accounts.select(F.col("account_num"), F.col("client").alias("client_id"),
                        F.col("valid_to").alias("account_valid_to"))
    c = cards.select("card_num", "account_num")
    return owners.join(a, "client_id").join(c, "account_num")


def ownership_chain(events: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                    card_col: str = "card_num") -> DataFrame:
    """Attach account and owner to every row of ``events`` (inner joins:
    rows whose card, account or client is unknown drop out)."""
    c = cards.select(F.col("card_num").alias(card_col), "account_num")
    a = accounts.select("account_num", F.col("client").alias("client_id"),
                        F.col("valid_to").alias("account_valid_to"))
    return (events.join(c, card_col)
            .join(a, "account_num")
            .join(owner_columns(clients), "client_id"))


def to_report(df: DataFrame, event_type: str | None = None, ts_col: str = "trans_date") -> DataFrame:
    """Project onto the report's five columns."""
    tag = F.lit(event_type) if event_type is not None else F.col("event_type")
    return df.select(
        F.col(ts_col).alias("event_dt"),
        F.col("passport_num").alias("passport"),
        "fio",
        "phone",
        tag.alias("event_type"),
    )
