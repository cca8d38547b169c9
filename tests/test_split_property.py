"""Forced hot-group splitting equals the unsplit window on random sequences."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardwatch.operators.sequences import attribute_switch, declining_attempts

BASE = dt.datetime(2024, 1, 1, 10, 0, 0)

events = st.lists(
    st.tuples(st.sampled_from(["a", "b"]),              # key
              st.integers(0, 7200),                      # seconds after BASE (two hours)
              st.sampled_from(["SUCCESS", "REJECT"]),
              st.integers(1, 9),                          # amount
              st.sampled_from(["X", "Y", "Z"])),          # city
    min_size=1, max_size=40, unique_by=lambda e: (e[0], e[1]))


def _frame(spark, rows):
    data = [(k, BASE + dt.timedelta(seconds=s), r, float(a), c) for k, s, r, a, c in rows]
    return spark.createDataFrame(data, "key string, ts timestamp_ntz, status string, amt double, city string")


def _keys(df):
    return sorted((r.key, r.ts) for r in df.select("key", "ts").collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=events, width=st.integers(1, 900), k=st.integers(1, 3))
def test_split_equals_unsplit(spark, rows, width, k):
    df = _frame(spark, rows)
    bucket = dt.timedelta(seconds=width)
    gap = dt.timedelta(minutes=30)
    plain = declining_attempts(df, "key", "ts", "status", "amt", k=k, max_gap=gap)
    split = declining_attempts(df, "key", "ts", "status", "amt", k=k, max_gap=gap, hot_rows=1, hot_bucket=bucket)
    assert _keys(plain) == _keys(split)
    plain = attribute_switch(df, "key", "ts", "city", gap)
    split = attribute_switch(df, "key", "ts", "city", gap, hot_rows=1, hot_bucket=bucket)
    assert _keys(plain) == _keys(split)
