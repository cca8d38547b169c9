"""As-of lookup without a range join.

Each event takes the versions of its key that are valid at its time.  A join
on the key alone, filtered by time, meets every version with every event of a
key.  Here versions and events are united and sorted, and the last state is
carried forward:

1. *Segments*: the bounds of a key's versions cut its time into segments; each
   carries the list of versions valid in it (usually one, or none).  Versions
   may overlap, so the result equals the range join's for any history.
2. *Opening states*: for every (key, day) that has events, the state at the
   day's start, carried over the segments and those day starts alone.
3. *Events*: per (key, day), the opening state, the segments that begin inside
   the day and the events, in order; ``last(..., ignorenulls)`` gives each event
   its state.  Events do not depend on each other, so a crowded (key, day)
   group is dealt to several tasks by a hash, each with its own copy of the
   day's few states.

No step multiplies events, except by versions that overlap, as the range join
does.  One key's versions are one array, a key's event days one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.expressions import day_of
from cardwatch.operators.sequences import HOT_ROWS, find_hot_groups

#: Tasks that a crowded (key, day) group is dealt to.
DEAL = 64


def version_segments(versions: DataFrame, key: str, start: str, end: str, values: Sequence[str]) -> DataFrame:
    """``key``, ``_at`` and ``_live``: from ``_at`` on (to the key's next
    segment) the versions of ``_live`` are valid.  Both ends of a version are
    inclusive, to the microsecond; a NULL end makes it valid never."""
    own = (versions.where(F.col(start).isNotNull() & F.col(end).isNotNull() & F.col(key).isNotNull())
           .groupBy(key).agg(F.collect_list(F.struct(F.col(start).alias("_from"), F.col(end).alias("_to"), *values)).alias("_versions")))
    after = F.expr("INTERVAL '0.000001' SECOND")
    bounds = F.array_distinct(F.concat(F.transform("_versions", lambda v: v["_from"]),
                                       F.transform("_versions", lambda v: v["_to"] + after)))
    cut = own.select(key, "_versions", F.explode(bounds).alias("_at"))
    valid = F.filter("_versions", lambda v: (v["_from"] <= F.col("_at")) & (F.col("_at") <= v["_to"]))
    return cut.select(key, "_at", F.transform(valid, lambda v: F.struct(*[v[c].alias(c) for c in values])).alias("_live"))


def as_of_lookup(events: DataFrame, versions: DataFrame, key: str, ts: str, version_key: str, start: str, end: str,
                 values: Sequence[str], hot_rows: int = HOT_ROWS, deal: int = DEAL) -> DataFrame:
    """``events`` (with a non-NULL ``key`` and ``ts``) and the ``values`` of
    each version valid at ``ts``; events without one drop out, as in an inner
    join."""
    hot = find_hot_groups(events, key, ts, hot_rows)
    day = day_of(ts)
    part = F.when(F.xxhash64(key, day).isin(*hot.hashes), F.pmod(F.xxhash64(*events.columns), F.lit(deal))
                  ).otherwise(F.lit(0)) if hot.hashes else F.lit(0)
    placed = events.select(F.col(key).alias("_key"), day.alias("_day"), part.cast("int").alias("_part"),
                           F.col(ts).alias("_at"), F.struct(*events.columns).alias("_event"))
    segments = version_segments(versions, version_key, start, end, values).withColumnRenamed(version_key, "_key")

    groups = placed.select("_key", "_day", "_part").distinct()
    days = groups.select("_key", "_day").distinct()
    starts = days.select("_key", F.col("_day").cast("timestamp_ntz").alias("_at"), "_day")
    states = segments.join(days.select("_key").distinct(), "_key", "left_semi")
    carried = Window.partitionBy("_key").orderBy("_at", F.col("_day").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    opening = (states.unionByName(starts, allowMissingColumns=True)
               .withColumn("_live", F.last("_live", ignorenulls=True).over(carried))
               .where("_day IS NOT NULL AND _live IS NOT NULL").select("_key", "_day", "_at", "_live"))
    inside = states.select("_key", day_of("_at").alias("_day"), "_at", "_live").join(days, ["_key", "_day"], "left_semi")
    known = opening.unionByName(inside).join(groups, ["_key", "_day"])

    order = Window.partitionBy("_key", "_day", "_part").orderBy("_at", F.col("_event").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    located = (known.unionByName(placed, allowMissingColumns=True)
               .withColumn("_live", F.last("_live", ignorenulls=True).over(order)).where("_event IS NOT NULL"))
    found = located.select("_event", F.explode("_live").alias("_found"))
    return found.select("_event.*", *[F.col(f"_found.{c}").alias(c) for c in values])
