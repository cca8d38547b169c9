"""Hot-group splitting of sequence windows gives exactly the unsplit result.

Checked against a brute-force pandas evaluation on random data with one
hot key holding most rows.  A low ``hot_rows`` threshold forces the split
(and the seam stitching) for that key, with buckets from seconds (most
buckets hold fewer than k rows) to hours (many rows per bucket).
"""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.operators.sequences import attribute_switch, declining_attempts

GAP = dt.timedelta(minutes=60)


def _random_events(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.6, "hot", rng.choice(["k1", "k2", "k3", "k4"], n))
    start = np.datetime64("2024-01-01T00:00:00")
    offs = rng.integers(0, 3 * 86_400_000_000, n).astype("timedelta64[us]")
    pdf = pd.DataFrame({
        "key": keys,
        "ts": (start + offs).astype("datetime64[us]"),
        "city": rng.choice(["A", "B", "C"], n),
        "status": rng.choice(["SUCCESS", "REJECT"], n, p=[0.3, 0.7]),
        "amt": rng.integers(1, 500, n).astype(float) + rng.random(n),
    }).drop_duplicates(["key", "ts"])
    df = spark.createDataFrame(pdf, "key string, ts timestamp_ntz, city string, status string, amt double")
    return pdf, df


def _brute_switch(pdf, gap):
    out = []
    for (_, _), g in pdf.assign(day=pdf.ts.dt.date).groupby(["key", "day"]):
        g = g.sort_values("ts")
        prev = g.shift(1)
        hit = (g.city != prev.city) & prev.ts.notna() & ((g.ts - prev.ts) < gap)
        out += list(zip(g.key[hit], g.ts[hit]))
    return sorted(out)


def _brute_decline(pdf, k, gap):
    out = []
    for _, g in pdf.assign(day=pdf.ts.dt.date).groupby(["key", "day"]):
        g = g.sort_values("ts").reset_index(drop=True)
        for i in range(k, len(g)):
            if g.status[i] != "SUCCESS":
                continue
            prev = g.iloc[i - k:i][::-1]
            if not (prev.status == "REJECT").all():
                continue
            chain = [int(g.amt[i])] + [int(a) for a in prev.amt]
            if not all(a < b for a, b in zip(chain, chain[1:])):
                continue
            if g.ts[i] - g.ts[i - k] < gap:
                out.append((g.key[i], g.ts[i]))
    return sorted(out)


def _spark_pairs(df):
    return sorted((r.key, pd.Timestamp(r.ts)) for r in df.select("key", "ts").collect())


WIDTHS = [dt.timedelta(seconds=30), dt.timedelta(minutes=7), dt.timedelta(hours=1), dt.timedelta(hours=5)]


@pytest.mark.parametrize("width", WIDTHS)
def test_attribute_switch_split_equals_brute_force(spark, width):
    pdf, df = _random_events(spark)
    got = attribute_switch(df, "key", "ts", "city", GAP, hot_rows=100, hot_bucket=width)
    assert _spark_pairs(got) == [(k, pd.Timestamp(t)) for k, t in _brute_switch(pdf, pd.Timedelta(GAP))]


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("k", [2, 3])
def test_declining_attempts_split_equals_brute_force(spark, width, k):
    pdf, df = _random_events(spark, n=6000, seed=11)
    gap = dt.timedelta(hours=3)
    got = declining_attempts(df, "key", "ts", "status", "amt", k=k, max_gap=gap, hot_rows=100, hot_bucket=width)
    expect = _brute_decline(pdf, k, pd.Timedelta(gap))
    assert len(expect) > 0
    assert _spark_pairs(got) == [(k_, pd.Timestamp(t)) for k_, t in expect]


def test_unsplit_default_equals_brute_force(spark):
    pdf, df = _random_events(spark)
    got = attribute_switch(df, "key", "ts", "city", GAP)
    assert _spark_pairs(got) == [(k, pd.Timestamp(t)) for k, t in _brute_switch(pdf, pd.Timedelta(GAP))]


def test_only_hot_groups_are_split(spark):
    _, df = _random_events(spark)
    from cardwatch.operators.sequences import with_buckets
    staged = with_buckets(df, ["key"], "ts", hot_rows=300, hot_bucket=dt.timedelta(hours=4))
    per_key = {r.key: r.n for r in staged.groupBy("key").agg(
        F.countDistinct("_seq_day", "_seq_bucket").alias("n")).collect()}
    assert per_key["hot"] == 3 * 6  # 3 days x 6 buckets of 4 hours
    assert all(n == 3 for k, n in per_key.items() if k != "hot")  # one bucket per day


def test_split_keeps_every_row_including_null_times(spark):
    from cardwatch.operators.sequences import previous_rows
    rows = [("hot", None, 1.0)] * 5 + [("hot", dt.datetime(2024, 1, 1, 0, 0, i), float(i)) for i in range(50)]
    rows += [("cold", dt.datetime(2024, 1, 1, 1, 0, 0), 1.0), (None, dt.datetime(2024, 1, 1, 2, 0, 0), 2.0)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, v double")
    plain = previous_rows(df, "key", "ts", {"p1": ("v", 1), "p2": ("v", 2)})
    split = previous_rows(df, "key", "ts", {"p1": ("v", 1), "p2": ("v", 2)}, hot_rows=3,
                          hot_bucket=dt.timedelta(seconds=7))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert split.count() == len(rows)
    assert sorted(map(tuple, plain.where("ts IS NOT NULL").collect()), key=key) == \
        sorted(map(tuple, split.where("ts IS NOT NULL").collect()), key=key)
