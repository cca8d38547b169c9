"""Size-checked broadcast.

A side is broadcast only after proving it has at most ``max_rows`` rows.
The proof is a plain ``count()``: no column is needed, every task sends one
number, and a parquet scan is answered from the footers.  Beyond the bound
the frame is returned unhinted and Spark plans a shuffle join (AQE may still
broadcast it if the runtime size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One million history rows of (id, city, two timestamps, flag) is about
# 100 MB on every executor: the largest side this library broadcasts.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    return max_rows > 0 and df.count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if bounded(df, max_rows) else df
