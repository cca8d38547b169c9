"""Ordered-sequence patterns over keyed event tables.

Both patterns look back a fixed number of rows (``lag``) inside one key and
one calendar day.  A plain window would put each (key, day) group in one
task, so one hot key (a third of all rows, say) would sort in one task.
:func:`previous_rows` therefore splits hot groups and stitches the seams:

1. The heaviest (key, day) groups are found in one pass over two columns by
   an approximate top-k sketch (``approx_top_k``): each task sends a sketch
   of bounded size, nothing else moves.  Those of about ``hot_rows`` rows or
   more are hot; with none the plan is one plain window.  Which groups are
   split never changes a result, so an approximate answer serves.
2. Hot groups are cut into time buckets of ``hot_bucket`` (default one
   second); light groups stay whole.  ``lag`` runs per (key, day, bucket):
   exact for every row except the first ``k`` rows of a hot bucket after the
   first one (the *heads*), whose predecessors lie in earlier buckets.
3. Heads and the last ``k`` rows of every hot bucket (the *tails*) form a
   small table, at most ``2k`` rows per bucket.  A second window over it,
   per (key, day), gives the heads their exact lags: every true predecessor
   of a head is either an earlier head of its bucket or among the last ``k``
   rows of its own bucket.

4. A bucket that is itself hot (a third of all rows on one card in one second)
   is cut further by ranges of ``(ts, order_extra)``.  The bounds are a sample
   of about ``RANGES`` such tuples, drawn by their hash, so the ranges keep the
   order and seams between them are stitched like any other.

The result equals an unsplit window for any data; no row is copied; the
largest task holds one bucket or range of a hot key, or ``2k`` rows per bucket
and range of one hot key-day in the stitch window.  Ties in ``ts`` are ordered by
``order_extra``; the patterns need ``(key, ts, order_extra)`` to be unique
for a deterministic answer, as any ``lag`` does.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.expressions import (
    REJECT,
    SUCCESS,
    day_of,
    gap_below,
    micros_since_day_start,
    whole_units,
)
HOT_ROWS = 1_000_000
HOT_BUCKET = _dt.timedelta(seconds=1)
#: Heaviest groups looked for, and groups that a task's sketch tracks.
TOP_GROUPS, TRACKED_GROUPS = 1_000, 10_000
#: Ranges that a hot bucket is cut into, about.
RANGES = 64

_DAY = "_seq_day"
_HOT = "_seq_hot"
_BUCKET = "_seq_bucket"
_RANGE = "_seq_range"
_RN = "_seq_rn"
_CNT = "_seq_cnt"
_HEAD = "_seq_head"


def _us(t: _dt.timedelta) -> int:
    return (t.days * 86_400 + t.seconds) * 1_000_000 + t.microseconds


@dataclass(frozen=True)
class HotGroups:
    """Hot (key, day) groups found once and shared by several patterns over
    the same keys.  Which groups are split never changes a result (the seam
    stitching is exact for any split), so one search can serve rules whose
    inputs differ slightly (a filtered copy of the same rows), and a group
    that shares a hot group's hash is merely split too."""

    hashes: tuple[int, ...]  # at most TOP_GROUPS


def _group_hash(group: Sequence[str | Column]) -> Column:
    return F.xxhash64(*group)


def find_hot_groups(df: DataFrame, key: str | Sequence[str], ts: str, hot_rows: int = HOT_ROWS) -> HotGroups:
    keys = [key] if isinstance(key, str) else list(key)
    top = (df.select(_group_hash([*keys, day_of(ts)]).alias("_seq_hash"))
           .agg(F.expr(f"approx_top_k(_seq_hash, {TOP_GROUPS}, {TRACKED_GROUPS})")).first()[0])
    return HotGroups(tuple(t["item"] for t in top or [] if t["count"] > hot_rows))


def in_hot_group(hot: HotGroups, key: str, ts: str) -> Column:
    """Whether a row lies in one of the hot (key, day) groups."""
    return _group_hash([key, day_of(ts)]).isin(*hot.hashes) if hot.hashes else F.lit(False)


def _mark_hot(d: DataFrame, group: Sequence[str], hot: HotGroups, ts: str, hot_bucket: _dt.timedelta) -> DataFrame:
    is_hot = _group_hash(group).isin(*hot.hashes) if hot.hashes else F.lit(False)
    w_us = max(_us(hot_bucket), 1)
    # Rows without a timestamp (their day is NULL too) stay in bucket 0.
    bucket = F.when(is_hot & F.col(ts).isNotNull(),
                    F.floor(micros_since_day_start(ts) / F.lit(w_us))).otherwise(F.lit(0))
    return d.withColumn(_HOT, is_hot).withColumn(_BUCKET, bucket.cast("bigint"))


def _mark_ranges(staged: DataFrame, group: Sequence[str], ts: str, order_extra: Sequence[str], hot_rows: int) -> DataFrame:
    """Add ``_seq_range``: the place of a row of a hot bucket among the bounds
    of its ranges; 0 elsewhere.  At most ``TOP_GROUPS`` buckets are looked for,
    so the bounds are a small table."""
    bucket = _group_hash([*group, _BUCKET])
    split = staged.where(F.col(_HOT))
    top = (split.select(bucket.alias("_seq_hash"))
           .agg(F.expr(f"approx_top_k(_seq_hash, {TOP_GROUPS}, {TRACKED_GROUPS})")).first()[0])
    crowded = {t["item"]: t["count"] for t in top or [] if t["count"] > hot_rows}
    if not crowded:
        return staged.withColumn(_RANGE, F.lit(0))
    place = F.struct(ts, *order_extra)
    rates = staged.sparkSession.createDataFrame([(h, max(n // RANGES, 1)) for h, n in crowded.items()], "_seq_hash long, _seq_rate long")
    bounds = (split.select(bucket.alias("_seq_hash"), place.alias("_seq_place")).join(F.broadcast(rates), "_seq_hash")
              .where(F.pmod(F.xxhash64("_seq_place"), F.col("_seq_rate")) == 0)
              .groupBy("_seq_hash").agg(F.collect_set("_seq_place").alias("_seq_bounds")))
    below = F.size(F.filter("_seq_bounds", lambda b: b <= place))
    return (staged.withColumn("_seq_hash", F.when(F.col(_HOT), bucket)).join(F.broadcast(bounds), "_seq_hash", "left")
            .withColumn(_RANGE, F.when(F.col("_seq_bounds").isNotNull(), below).otherwise(F.lit(0)))
            .drop("_seq_hash", "_seq_bounds"))


def with_buckets(df: DataFrame, keys: Sequence[str], ts: str, hot_rows: int = HOT_ROWS,
                 hot_bucket: _dt.timedelta = HOT_BUCKET) -> DataFrame:
    """Add ``_seq_day``, ``_seq_hot`` and ``_seq_bucket`` (0 for light groups)."""
    group = [*keys, _DAY]
    d = df.withColumn(_DAY, day_of(ts))
    hot = find_hot_groups(df, keys, ts, hot_rows)
    return _mark_hot(d, group, hot, ts, hot_bucket)


def previous_rows(df: DataFrame, key: str | Sequence[str], ts: str, lags: dict[str, tuple[str, int]],
                  order_extra: Sequence[str] = (), hot_rows: int = HOT_ROWS,
                  hot_bucket: _dt.timedelta = HOT_BUCKET, hot: HotGroups | None = None) -> DataFrame:
    """Add ``lags`` (``name -> (column, offset)``) computed per key and
    calendar day in ``(ts, *order_extra)`` order.  Output: the input columns
    plus the lag columns.

    The search for hot groups runs first (one narrow pass); when none is hot,
    which is the usual case, the plan is a single window per (key, day)."""
    keys = [key] if isinstance(key, str) else list(key)
    k = max(n for _, n in lags.values())
    out_cols = [*df.columns, *lags]
    group = [*keys, _DAY]
    d = df.withColumn(_DAY, day_of(ts))
    if hot is None:
        hot = find_hot_groups(df, keys, ts, hot_rows)
    if not hot.hashes:
        w = Window.partitionBy(*group).orderBy(ts, *order_extra)
        return d.select("*", *[F.lag(c, n).over(w).alias(name) for name, (c, n) in lags.items()]).select(*out_cols)

    staged = _mark_ranges(_mark_hot(d, group, hot, ts, hot_bucket), group, ts, order_extra, hot_rows)
    # ``_seq_hot`` is a function of (key, day), so adding it to the window
    # keys changes no partition; it lets the seam branch's ``hot`` filter be
    # pushed below its exchange, so only hot rows are shuffled a second time.
    w_bucket = Window.partitionBy(*group, _HOT, _BUCKET, _RANGE).orderBy(ts, *order_extra)
    w_whole_bucket = Window.partitionBy(*group, _HOT, _BUCKET, _RANGE)
    a = staged.select(
        "*",
        F.row_number().over(w_bucket).alias(_RN),
        F.count(F.lit(1)).over(w_whole_bucket).alias(_CNT),
        *[F.lag(c, n).over(w_bucket).alias(name) for name, (c, n) in lags.items()],
    )
    head = F.col(_HOT) & ((F.col(_BUCKET) > 0) | (F.col(_RANGE) > 0)) & (F.col(_RN) <= k)
    tail = F.col(_HOT) & (F.col(_RN) > F.col(_CNT) - k)
    settled = a.where(~head).select(*out_cols)

    seams = a.where(head | tail).select(*df.columns, _DAY, head.alias(_HEAD))
    w_seam = Window.partitionBy(*group).orderBy(ts, *order_extra)
    stitched = (seams.select("*", *[F.lag(c, n).over(w_seam).alias(name) for name, (c, n) in lags.items()])
                .where(F.col(_HEAD)).select(*out_cols))
    return settled.unionByName(stitched)


def attribute_switch(df: DataFrame, key: str | Sequence[str], ts: str, attr: str,
                     max_gap: _dt.timedelta = _dt.timedelta(minutes=60),
                     order_extra: Sequence[str] = (), hot_rows: int = HOT_ROWS,
                     hot_bucket: _dt.timedelta = HOT_BUCKET, hot: HotGroups | None = None) -> DataFrame:
    """Rows whose ``attr`` differs from the previous row of the same key and
    day, less than ``max_gap`` after it (strict).  The later row is returned
    with ``prev_<ts>`` and ``prev_<attr>``; a NULL on either side is no
    switch."""
    prev_ts, prev_attr = f"prev_{ts}", f"prev_{attr}"
    out = previous_rows(df, key, ts, {prev_ts: (ts, 1), prev_attr: (attr, 1)}, order_extra,
                        hot_rows, hot_bucket, hot=hot)
    return out.where((F.col(attr) != F.col(prev_attr)) & gap_below(ts, prev_ts, max_gap))


def declining_attempts(df: DataFrame, key: str | Sequence[str], ts: str, status: str, amount: str,
                       k: int = 3, max_gap: _dt.timedelta = _dt.timedelta(minutes=20),
                       success: str = SUCCESS, reject: str = REJECT, order_extra: Sequence[str] = (),
                       hot_rows: int = HOT_ROWS, hot_bucket: _dt.timedelta = HOT_BUCKET,
                       hot: HotGroups | None = None) -> DataFrame:
    """Successful rows preceded (same key and day) by exactly ``k`` refused
    rows whose whole-unit amounts fall strictly towards it, the ``k``-th
    previous row lying less than ``max_gap`` before (strict).

    Adds ``prev_<status>_i``, ``prev_<amount>_i`` (i = 1..k) and
    ``prev_<ts>_k``."""
    if k < 1:
        raise ValueError("k must be at least 1")
    lags: dict[str, tuple[str, int]] = {}
    for i in range(1, k + 1):
        lags[f"prev_{status}_{i}"] = (status, i)
        lags[f"prev_{amount}_{i}"] = (amount, i)
    prev_ts_k = f"prev_{ts}_{k}"
    lags[prev_ts_k] = (ts, k)
    out = previous_rows(df, key, ts, lags, order_extra, hot_rows, hot_bucket, hot=hot)
    cond: Column = F.col(status) == F.lit(success)
    for i in range(1, k + 1):
        cond = cond & (F.col(f"prev_{status}_{i}") == F.lit(reject))
    chain = [F.col(amount)] + [F.col(f"prev_{amount}_{i}") for i in range(1, k + 1)]
    for later, earlier in zip(chain, chain[1:]):
        cond = cond & (whole_units(later) < whole_units(earlier))
    cond = cond & gap_below(ts, prev_ts_k, max_gap)
    return out.where(cond)
