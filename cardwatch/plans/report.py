"""The fraud report table.

Rows are written into ``event_day`` partitions.  A day run replaces its own
partition, so rerunning a day never duplicates findings (the reference
appends again).  A range run uses dynamic partition overwrite in one job;
it adds one placeholder row for every day of the range that has
operations or earlier findings, so those days are replaced even when they
no longer have findings.  Readers never see placeholder rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.functions.expressions import day_of, ts_ntz
from cardwatch.plans.warehouse import Warehouse, conform


def stamp(report: DataFrame, report_dt=None) -> DataFrame:
    """Add ``report_dt`` (load time; pass a value for repeatable runs) and
    ``event_day``."""
    when = ts_ntz(report_dt) if report_dt is not None else F.current_timestamp().cast("timestamp_ntz")
    return report.withColumn("report_dt", when).withColumn("event_day", day_of("event_dt"))


def write_day(wh: Warehouse, report: DataFrame, day: _dt.date | str, report_dt=None) -> None:
    """T3 for one day: replace that day's partition (also when empty)."""
    rows = conform(stamp(report, report_dt).withColumn("placeholder", F.lit(False)), schemas.REPORT)
    rows = rows.drop("event_day")
    rows.write.mode("overwrite").parquet(f"{wh.path('report')}/event_day={_dt.date.fromisoformat(str(day))}")


def write_days(wh: Warehouse, report: DataFrame, days: DataFrame, report_dt=None) -> None:
    """T3 for a range: one dynamic-overwrite job replacing every day listed
    in ``days`` (column ``event_day``) and every day with findings."""
    rows = conform(stamp(report, report_dt).withColumn("placeholder", F.lit(False)), schemas.REPORT)
    markers = conform(days.select("event_day").distinct().withColumn("placeholder", F.lit(True)), schemas.REPORT)
    (rows.unionByName(markers).hint("rebalance", "event_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_day").parquet(wh.path("report")))


def read_report(wh: Warehouse, day: _dt.date | str | None = None) -> DataFrame:
    """T4: the report (one day via partition pruning, or all)."""
    rep = wh.table("report")
    return rep if day is None else rep.where(F.col("event_day") == F.lit(str(day)).cast("date"))
