"""Explicit schemas: daily feeds (as text) and warehouse tables."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Feeds arrive as delimited text; every column is read as a string and
# parsed with try_* functions so that a bad value becomes NULL, never an error.
TRANSACTIONS_FEED = _strings("transaction_id", "transaction_date", "amount", "card_num",
                             "oper_type", "oper_result", "terminal")
BLACKLIST_FEED = _strings("passport", "date")
TERMINALS_FEED = _strings("terminal_id", "terminal_type", "terminal_city", "terminal_address")

CLIENTS = StructType([
    StructField("client_id", StringType(), False),
    StructField("last_name", StringType(), True),
    StructField("first_name", StringType(), True),
    StructField("patronymic", StringType(), True),
    StructField("date_of_birth", DateType(), True),
    StructField("passport_num", StringType(), True),
    StructField("passport_valid_to", DateType(), True),
    StructField("phone", StringType(), True),
    StructField("create_dt", DateType(), True),
    StructField("update_dt", DateType(), True),
])

ACCOUNTS = StructType([
    StructField("account_num", StringType(), False),
    StructField("valid_to", DateType(), True),
    StructField("client", StringType(), True),
    StructField("create_dt", DateType(), True),
    StructField("update_dt", DateType(), True),
])

CARDS = StructType([
    StructField("card_num", StringType(), False),
    StructField("account_num", StringType(), True),
    StructField("create_dt", DateType(), True),
    StructField("update_dt", DateType(), True),
])

BLACKLIST = StructType([
    StructField("passport_num", StringType(), True),
    StructField("entry_dt", DateType(), True),
])

TERMINALS_HIST = StructType([
    StructField("terminal_id", StringType(), True),
    StructField("terminal_type", StringType(), True),
    StructField("terminal_city", StringType(), True),
    StructField("terminal_address", StringType(), True),
    StructField("effective_from", TimestampNTZType(), True),
    StructField("effective_to", TimestampNTZType(), True),
    StructField("deleted_flg", BooleanType(), True),
])

TRANSACTIONS = StructType([
    StructField("trans_id", StringType(), False),
    StructField("trans_date", TimestampNTZType(), True),
    # wide enough to hold any amount of a feed without rounding its digits
    StructField("amt", DecimalType(38, 18), True),
    StructField("card_num", StringType(), True),
    StructField("oper_type", StringType(), True),
    StructField("oper_result", StringType(), True),
    StructField("terminal", StringType(), True),
    StructField("trans_day", DateType(), True),
])

REPORT = StructType([
    StructField("event_dt", TimestampNTZType(), True),
    StructField("passport", StringType(), True),
    StructField("fio", StringType(), True),
    StructField("phone", StringType(), True),
    StructField("event_type", StringType(), True),
    StructField("report_dt", TimestampNTZType(), True),
    # True only on one marker row per day written by a range run, so that
    # dynamic overwrite replaces days that no longer have findings too.
    StructField("placeholder", BooleanType(), True),
    StructField("event_day", DateType(), True),
])
