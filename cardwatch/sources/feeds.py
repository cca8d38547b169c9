"""Daily feeds (S1-S7) and the feed -> fact projection.

Feeds are delimited text (``;``, header row) named ``<kind>_DDMMYYYY.<ext>``;
blacklist and terminal snapshots may also be parquet.  Every feed column is
read as text with an explicit schema (no inference pass over the data) and
parsed with ``try_*`` functions, so one bad value yields NULL instead of
failing a 100 TB job; the loads count such values.  Columns are bound by the
names in the header, whatever their order.  The feed day is taken from the
file name through the ``_metadata`` column, which lets one read cover a whole
backfill folder.

A line with more or fewer fields than its header is malformed: no field of it
is bound, the readers leave it out and :func:`rejected_lines` returns it as it
stands, so accepted and rejected rows add up to the lines of the file.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardwatch import schemas
from cardwatch.sources.files import exists

# Feed naming and formats.
FEED_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
FEED_DAY_FORMAT = "ddMMyyyy"
FEED_DATE_FORMAT = "yyyy-MM-dd"
CSV_SEPARATOR = ";"


def parse_run_date(text: str) -> _dt.date:
    """``DDMMYYYY`` run parameter -> date."""
    return _dt.datetime.strptime(text, "%d%m%Y").date()


def feed_present(spark: SparkSession, path: str) -> bool:
    """Whether a feed exists.  Absent differs from empty: an empty
    terminal snapshot deletes every terminal, an absent one changes nothing."""
    return exists(spark, path)


class FeedHeaderError(ValueError):
    """A feed's header names a column that its table does not have."""


# How the feeds are written: quotes inside quoted values are doubled.
CSV_OPTIONS = {"sep": CSV_SEPARATOR, "header": True, "escape": '"', "mode": "PERMISSIVE"}


def header_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """All-text schema in the order of the header at ``path`` (only the first
    line is read).  An unknown column, or a header without any known one, is
    an error; a missing column is read as NULL."""
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    unknown = [n for n in names if n not in schema.fieldNames()]
    if unknown or not names:
        raise FeedHeaderError(f"{path}: header {names} does not fit {schema.fieldNames()}")
    return StructType([StructField(n, StringType(), True) for n in names])


REJECTED = "_rejected"


def _read_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All lines of delimited feeds: the header's columns as text and, of a
    malformed line, the line itself in ``_rejected``."""
    found = header_schema(spark, path, schema)
    # enforceSchema=false: of several files, one with another header fails
    return (spark.read.schema(StructType([*found.fields, StructField(REJECTED, StringType(), True)])).options(**CSV_OPTIONS)
            .option("columnNameOfCorruptRecord", REJECTED).option("enforceSchema", False).csv(path))


def _malformed(raw: DataFrame) -> Column:
    """Whether a line is malformed, in a form that the reader neither takes as
    a filter of its own (it would test the column before filling it) nor as a
    scan of that column alone (which it refuses): the length of all columns is
    never below that of this one."""
    line = F.length(F.concat_ws("", REJECTED))
    return (line > 0) & (F.length(F.concat_ws("", *[F.col(c) for c in raw.columns])) >= line)


def _read_text(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    if fmt == "csv":
        raw = _read_lines(spark, path, schema)
        have = [c for c in raw.columns if c != REJECTED]
        whole = raw.where(~_malformed(raw))
        return whole.select(*[(F.col(f.name) if f.name in have else F.lit(None).cast("string")).alias(f.name)
                              for f in schema.fields], *_feed_metadata())
    if fmt == "parquet":
        raw = spark.read.parquet(path)
        return raw.select(*[F.col(f.name).cast("string").alias(f.name) for f in schema.fields])
    raise ValueError(f"unsupported feed format {fmt!r}")


def rejected_lines(spark: SparkSession, path: str, schema: StructType, fmt: str | None = None) -> DataFrame:
    """The malformed lines of a feed: ``file``, ``line``, ``reason``, and
    ``fields_found`` of ``fields_expected`` (separators inside quotes do not
    count).  A parquet feed has none."""
    if _fmt(path, fmt) != "csv":
        return spark.createDataFrame([], "file string, line string, reason string, fields_found int, fields_expected int")
    raw = _read_lines(spark, path, schema)
    expected = len(raw.columns) - 1
    found = F.size(F.split(F.regexp_replace(REJECTED, '"[^"]*"', ""), CSV_SEPARATOR))
    reason = F.when(found > expected, "surplus fields").when(found < expected, "missing fields").otherwise("malformed")
    return (raw.where(_malformed(raw))
            .select(F.col("_metadata.file_name").alias("file"), F.col(REJECTED).alias("line"), reason.alias("reason"),
                    found.alias("fields_found"), F.lit(expected).alias("fields_expected")))


def _fmt(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    return "parquet" if path.rstrip("/").endswith(".parquet") else "csv"


FEED_DAY = "feed_day"


def _feed_metadata() -> list[Column]:
    digits = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{8})", 1)
    return [F.when(digits != "", F.try_to_timestamp(digits, F.lit(FEED_DAY_FORMAT))).cast("date").alias(FEED_DAY)]


def feed_day_of(path: str) -> _dt.date | None:
    """The day in a feed's file name (``<kind>_DDMMYYYY.<ext>``)."""
    m = re.search(r"(\d{8})[^/]*$", path)
    try:
        return parse_run_date(m[1]) if m else None
    except ValueError:
        return None


def parse_amount(text: str | Column) -> Column:
    """Amount text -> decimal(38,18): all digits of amounts below 10^20, with
    at most 18 decimals; a comma decimal separator is accepted and unparsable
    text becomes NULL (as do larger amounts, see :func:`too_wide`)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.translate(F.trim(c), ",", ".").try_cast("decimal(38,18)")


def unparsed(text: str | Column, parsed: Column) -> Column:
    """True where text stands but no value could be read from it."""
    c = F.col(text) if isinstance(text, str) else text
    return (F.trim(F.coalesce(c, F.lit(""))) != "") & parsed.isNull()


def too_wide(text: str | Column, parsed: Column) -> Column:
    """True where a number stands that the column cannot hold."""
    c = F.col(text) if isinstance(text, str) else text
    return parsed.isNull() & F.coalesce(F.trim(c).rlike(r"^[+-]?[0-9]+([.,][0-9]*)?$"), F.lit(False))


def parse_time(text: str | Column, fmt: str = FEED_TIME_FORMAT) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def parse_date(text: str | Column, fmt: str = FEED_DATE_FORMAT) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def read_transactions_feed(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Transactions feed with typed columns, ``feed_day`` and the
    flags ``bad_time``, ``bad_amount`` (text that could not be read) and
    ``wide_amount`` (a number beyond the column's digits)."""
    raw = _read_text(spark, path, schemas.TRANSACTIONS_FEED, _fmt(path, fmt))
    return typed_transactions(raw, *([FEED_DAY] if FEED_DAY in raw.columns else []))


def typed_transactions(raw: DataFrame, *further: str) -> DataFrame:
    """The transactions feed's text columns as typed ones."""
    when, amount = parse_time("transaction_date"), parse_amount("amount")
    wide = too_wide("amount", amount)
    return raw.select(
        "transaction_id",
        when.alias("transaction_date"),
        amount.alias("amount"),
        "card_num", "oper_type", "oper_result", "terminal", *further,
        unparsed("transaction_date", when).alias("bad_time"),
        (unparsed("amount", amount) & ~wide).alias("bad_amount"),
        wide.alias("wide_amount"),
    )


def read_blacklist_feed(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """S3: document blacklist feed -> (passport_num, entry_dt)."""
    raw = _read_text(spark, path, schemas.BLACKLIST_FEED, _fmt(path, fmt))
    return raw.select(F.col("passport").alias("passport_num"), parse_date("date").alias("entry_dt"))


def read_terminal_snapshot(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Full terminal snapshot (absence of a key means deletion)."""
    raw = _read_text(spark, path, schemas.TERMINALS_FEED, _fmt(path, fmt))
    return raw.select(*schemas.TERMINALS_FEED.fieldNames())


def read_dimension(spark: SparkSession, path: str, schema, fmt: str | None = None) -> DataFrame:
    """Clients / accounts / cards seed or refresh, with an explicit schema."""
    fmt = _fmt(path, fmt)
    if fmt == "parquet":
        return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    raw = _read_text(spark, path, _as_text(schema), "csv")
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "date":
            c = parse_date(c)
        out.append(c.alias(f.name))
    return raw.select(*out)


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def transactions_from_feed(feed: DataFrame, *further: str) -> DataFrame:
    """Feed columns -> fact columns (``transaction_id -> trans_id``,
    ``transaction_date -> trans_date``, ``amount -> amt``, rest unchanged)."""
    return feed.select(
        F.col("transaction_id").alias("trans_id"),
        F.col("transaction_date").alias("trans_date"),
        F.col("amount").alias("amt"),
        "card_num", "oper_type", "oper_result", "terminal", *further,
    )
