"""Type-2 history of a dimension rebuilt from full snapshots.

A snapshot lists every live member: a key missing from it is deleted.  The
history keeps one row per version with ``effective_from``/``effective_to``
and ``deleted_flg``; an open version ends at ``OPEN_END``.

Parquet has no UPDATE, so :func:`scd2_apply` returns the whole new history as
one lazy plan (kept rows, closed rows, new versions, tombstones).  The only
large input is the history itself, joined once to the small set of keys
that change; the diffs come from one full outer join between the snapshot
and the active versions.  ``as_of`` replaces the reference's wall clock so that
reruns give identical rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.expressions import OPEN_END, open_end, ts_ntz
from cardwatch.operators.keys import not_in

KEY = "terminal_id"
ATTRS = ("terminal_type", "terminal_city", "terminal_address")
FROM, TO, DELETED = "effective_from", "effective_to", "deleted_flg"

TimeLike = str | _dt.datetime | Column


def _as_of(as_of: TimeLike) -> Column:
    return ts_ntz(as_of)


def _one_second_before(as_of: TimeLike) -> Column:
    return _as_of(as_of) - F.expr("INTERVAL 1 SECOND")


def active_versions(history: DataFrame, as_of: TimeLike) -> DataFrame:
    """L2: versions valid at ``as_of`` (both ends inclusive), not deleted."""
    return history.where(_as_of(as_of).between(F.col(FROM), F.col(TO)) & ~F.col(DELETED))


def snapshot_new(snapshot: DataFrame, active: DataFrame, key: str = KEY,
                 null_keys: str = "reference") -> DataFrame:
    """L3: snapshot rows whose key is ``NOT IN`` the active keys."""
    return not_in(snapshot, active, key, key, null_keys)


def snapshot_deleted(active: DataFrame, snapshot: DataFrame, key: str = KEY,
                     null_keys: str = "reference") -> DataFrame:
    """L4: active rows whose key is ``NOT IN`` the snapshot keys."""
    return not_in(active, snapshot, key, key, null_keys)


def snapshot_changed(snapshot: DataFrame, active: DataFrame, key: str = KEY,
                     attrs: Sequence[str] = ATTRS, null_safe: bool = False) -> DataFrame:
    """Snapshot rows (new values) whose active version differs in an
    attribute.  With ``null_safe=False`` a change from or to NULL is not
    seen, as ``<>`` yields NULL (reference behaviour)."""
    s, a = snapshot.alias("s"), active.alias("a")
    diffs = [(~F.col(f"s.{c}").eqNullSafe(F.col(f"a.{c}"))) if null_safe
             else (F.col(f"s.{c}") != F.col(f"a.{c}")) for c in attrs]
    cond = diffs[0]
    for d in diffs[1:]:
        cond = cond | d
    return s.join(a, F.col(f"s.{key}") == F.col(f"a.{key}")).where(cond).select("s.*")


def open_versions(rows: DataFrame, as_of: TimeLike, key: str = KEY, attrs: Sequence[str] = ATTRS) -> DataFrame:
    """New open versions starting at ``as_of``."""
    return rows.select(key, *attrs, _as_of(as_of).alias(FROM), open_end().alias(TO),
                       F.lit(False).alias(DELETED))


def tombstones(deleted: DataFrame, as_of: TimeLike, key: str = KEY, attrs: Sequence[str] = ATTRS) -> DataFrame:
    """The last active values of deleted keys, flagged deleted, open."""
    return deleted.select(key, *attrs, _as_of(as_of).alias(FROM), open_end().alias(TO),
                          F.lit(True).alias(DELETED))


def _mark_closing(history: DataFrame, closing_keys: DataFrame, key: str) -> DataFrame:
    keys = closing_keys.select(F.col(key).alias("_close_key")).where(F.col("_close_key").isNotNull()).distinct()
    marked = history.join(keys, history[key] == keys["_close_key"], "left")
    is_closing = F.col("_close_key").isNotNull() & (F.col(TO) == open_end())
    return marked.withColumn("_closing", is_closing).drop("_close_key")


def close_versions(history: DataFrame, closing_keys: DataFrame, as_of: TimeLike, key: str = KEY) -> DataFrame:
    """The rows that get closed: every version of a closing key that is
    still open (``effective_to = OPEN_END``, tombstones included), with
    ``effective_to`` set to one second before ``as_of``."""
    marked = _mark_closing(history, closing_keys, key)
    return (marked.where(F.col("_closing")).withColumn(TO, _one_second_before(as_of))
            .drop("_closing").select(*history.columns))


def scd2_apply(history: DataFrame, snapshot: DataFrame, as_of: TimeLike, key: str = KEY,
               attrs: Sequence[str] = ATTRS, mode: str = "reference", null_keys: str = "reference",
               null_safe: bool = False) -> DataFrame:
    """The full history after applying ``snapshot`` at ``as_of``.

    Diffs are computed against the versions active at ``as_of`` before any
    change, by one full outer join of snapshot and active versions.  ``mode='reference'`` closes only deleted and changed keys (a
    key that returns after deletion then has its open tombstone beside a new
    live row); ``mode='clean'`` also closes the open rows of returning keys.

    The plan reads ``history`` several times, so when applying a series of
    snapshots write (or ``checkpoint()``) each version before the next
    apply, as ``plans.warehouse.Warehouse.load_terminals`` does.
    """
    cols = [key, *attrs, FROM, TO, DELETED]
    if mode not in ("reference", "clean"):
        raise ValueError(f"unknown mode {mode!r}")
    history = history.select(*cols)
    diff = snapshot_diff(snapshot.select(key, *attrs), active_versions(history, as_of), key, attrs, null_keys, null_safe)
    closing = diff if mode == "clean" else diff.where(F.col("kind") != NEW)
    marked = _mark_closing(history, closing.select(key), key)
    kept = marked.select(*[F.when(F.col("_closing"), _one_second_before(as_of)).otherwise(F.col(TO)).alias(TO)
                           if c == TO else F.col(c) for c in cols])
    opened = diff.select(key, *attrs, _as_of(as_of).alias(FROM), open_end().alias(TO),
                         (F.col("kind") == GONE).alias(DELETED))
    return kept.unionByName(opened)


NEW, GONE, CHANGED = "new", "deleted", "changed"


def snapshot_diff(snapshot: DataFrame, active: DataFrame, key: str = KEY, attrs: Sequence[str] = ATTRS,
                  null_keys: str = "reference", null_safe: bool = False) -> DataFrame:
    """L3, L4 and L5 together, from one full outer join: ``kind`` (new,
    deleted or changed), the key and the attributes (a deleted key's last
    ones).  ``NOT IN`` semantics as in :func:`keys.not_in`: a NULL key on the
    other side empties new or deleted rows, and a NULL key of one's own counts
    only against an empty other side."""
    def stats(side: DataFrame) -> Column:
        return side.select(F.struct(F.coalesce(F.max(F.col(key).isNull()), F.lit(False)).alias("has_null"),
                                    (F.count(F.lit(1)) == 0).alias("empty"))).scalar()

    def absent(other: DataFrame, own_key: str) -> Column:
        if null_keys == "ignore":
            return F.lit(True)
        if null_keys != "reference":
            raise ValueError(f"unknown null_keys {null_keys!r}")
        found = stats(other)
        return ~found.getField("has_null") & (F.col(own_key).isNotNull() | found.getField("empty"))

    s = snapshot.select(F.lit(True).alias("_s"), F.col(key).alias("_sk"), *[F.col(c).alias(f"_s_{c}") for c in attrs])
    a = active.select(F.lit(True).alias("_a"), F.col(key).alias("_ak"), *[F.col(c).alias(f"_a_{c}") for c in attrs])
    both = s.join(a, F.col("_sk") == F.col("_ak"), "full_outer")
    differs = [(~F.col(f"_s_{c}").eqNullSafe(F.col(f"_a_{c}"))) if null_safe
               else F.coalesce(F.col(f"_s_{c}") != F.col(f"_a_{c}"), F.lit(False)) for c in attrs]
    kind = (F.when(F.col("_a").isNull(), F.when(absent(active, "_sk"), NEW))
            .when(F.col("_s").isNull(), F.when(absent(snapshot, "_ak"), GONE))
            .when(reduce(or_, differs), CHANGED))
    gone = F.col("kind") == GONE
    return (both.withColumn("kind", kind).where(F.col("kind").isNotNull())
            .select("kind", F.when(gone, F.col("_ak")).otherwise(F.col("_sk")).alias(key),
                    *[F.when(gone, F.col(f"_a_{c}")).otherwise(F.col(f"_s_{c}")).alias(c) for c in attrs]))


def snapshot_events(history: DataFrame, snapshots: DataFrame, times: Sequence[TimeLike], at: str = "as_of", key: str = KEY,
                    attrs: Sequence[str] = ATTRS, null_safe: bool = False) -> DataFrame:
    """What a series of snapshots does to each key, from one pass: ``key`` and
    ``events``, an array of ``(at, kind, attrs)`` in order, ``at`` being the
    number of the snapshot (from 1) in ``times``.

    A key's appearances are one array (an entry a snapshot at most); islands
    of appearances and the gaps between them give new and deleted keys, and
    the values of an island, compared with the last version that was opened,
    give the changes."""
    when = F.array(*[_as_of(t) for t in times])
    row = F.struct(*attrs)
    seen = (snapshots.where(F.col(key).isNotNull()).select(key, F.array_position(when, _as_of(F.col(at))).cast("int").alias("_at"), row.alias("_row"))
            .where("_at > 0").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", "_row"))).alias("_seen")))
    live = active_versions(history, times[0]).where(F.col(key).isNotNull()).select(key, row.alias("_live"))
    both = seen.join(live, key, "full_outer")
    event = f"struct<at:int,kind:string,row:{both.schema['_live'].dataType.simpleString()}>"
    state = F.struct(F.col("_live").alias("row"), F.lit(0).alias("last"), F.array().cast(f"array<{event}>").alias("events"))

    def made(number, kind, values):
        return F.array(F.struct(number.alias("at"), F.lit(kind).alias("kind"), values.alias("row")).cast(event))

    def differs(a, b):
        pairs = [(~a[c].eqNullSafe(b[c])) if null_safe else F.coalesce(a[c] != b[c], F.lit(False)) for c in attrs]
        return reduce(or_, pairs)

    def step(s, entry):
        number, values = entry["_at"], entry["_row"]
        gap = s["row"].isNotNull() & (number > s["last"] + 1)
        fresh = s["row"].isNull() | gap
        changed = ~fresh & differs(s["row"], values)
        none = F.array().cast(f"array<{event}>")
        events = F.concat(s["events"], F.when(gap, made(s["last"] + 1, GONE, s["row"])).otherwise(none),
                          F.when(fresh, made(number, NEW, values)).when(changed, made(number, CHANGED, values)).otherwise(none))
        return F.struct(F.when(fresh | changed, values).otherwise(s["row"]).alias("row"), number.alias("last"), events.alias("events"))

    def finish(s):
        ended = s["row"].isNotNull() & (s["last"] < len(times))
        return F.concat(s["events"], F.when(ended, made(s["last"] + 1, GONE, s["row"])).otherwise(F.array().cast(f"array<{event}>")))

    nothing = F.array().cast(both.schema["_seen"].dataType)
    return both.select(key, F.aggregate(F.coalesce("_seen", nothing), state, step, finish).alias("events")).where(F.size("events") > 0)


def scd2_apply_series(history: DataFrame, snapshots: DataFrame, times: Sequence[TimeLike], at: str = "as_of",
                      key: str = KEY, attrs: Sequence[str] = ATTRS, mode: str = "reference",
                      null_safe: bool = False) -> DataFrame:
    """L10 for a series: the history after applying the snapshot of each of
    ``times`` (ascending, different) in turn, as one plan.  ``snapshots`` holds
    the rows of all of them, told apart by the column ``at``; a time without
    rows is an empty snapshot, which deletes every key.

    Equals repeated :func:`scd2_apply` with ``null_keys='ignore'`` where a key
    stands once in a snapshot; rows without a key are ignored.  No version of
    ``history`` may start after the first of ``times``."""
    if mode not in ("reference", "clean"):
        raise ValueError(f"unknown mode {mode!r}")
    cols = [key, *attrs, FROM, TO, DELETED]
    history = history.select(*cols)
    if not times:
        return history
    events = snapshot_events(history, snapshots, times, at, key, attrs, null_safe)
    when = F.array(*[_as_of(t) for t in times])

    def end_after(number: Column) -> Column:
        """The end of a version that is open after event ``number``."""
        closing = F.filter("events", lambda e: (e["at"] > number) & (F.lit(mode == "clean") | (e["kind"] != NEW)))
        first = F.element_at(when, F.array_min(F.transform(closing, lambda e: e["at"])))
        return F.when(F.size(closing) > 0, first - F.expr("INTERVAL 1 SECOND")).otherwise(open_end())

    opened = events.select(key, "events", F.explode("events").alias("_e")).select(
        key, *[F.col(f"_e.row.{c}").alias(c) for c in attrs], F.element_at(when, F.col("_e.at")).alias(FROM),
        end_after(F.col("_e.at")).alias(TO), (F.col("_e.kind") == GONE).alias(DELETED))
    ends = events.select(F.col(key).alias("_close_key"), end_after(F.lit(0)).alias("_end"))
    closed = F.when((F.col(TO) == open_end()) & F.col("_end").isNotNull(), F.col("_end")).otherwise(F.col(TO))
    kept = (history.join(ends, history[key] == ends["_close_key"], "left")
            .select(*[closed.alias(TO) if c == TO else F.col(c) for c in cols]))
    return kept.unionByName(opened)


def initial_history(snapshot: DataFrame, start: TimeLike = "1900-01-01 00:00:00", key: str = KEY,
                    attrs: Sequence[str] = ATTRS) -> DataFrame:
    """History opened from a first snapshot.  A start far in the past lets
    as-of joins place operations that predate the first load."""
    return open_versions(snapshot, start, key, attrs)


__all__ = [
    "OPEN_END", "active_versions", "snapshot_new", "snapshot_deleted", "snapshot_changed",
    "open_versions", "tombstones", "close_versions", "scd2_apply", "scd2_apply_series", "snapshot_events",
    "initial_history",
]
