"""Stored neighbourhood states add up to the memo and the thresholds of whole runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from qualmark.operators import limits as L
from qualmark.plans import checks as CH
from qualmark.session import scratch_path
from qualmark.sources import sinks as SK

KEYS = ["gamecode", "column"]
D = dt.date(2024, 1, 20)


def counts(spark, seed, width=600, days=9):
    r, rows = random.Random(seed), []
    for series in (("g", "a"), ("g", None), ("h", "b")):
        for back in range(days):
            for slot in range(86400 // width):
                edge = slot in (0, 1, 86400 // width - 1)
                if r.random() < (0.9 if edge else 0.15):
                    at = dt.datetime.combine(D - dt.timedelta(days=back - 1), dt.time()) + dt.timedelta(seconds=slot * width)
                    n = r.randint(0, 30)
                    rows.append((*series, at, r.randint(0, n), n))
    return spark.createDataFrame(rows, "gamecode string, column string, bucket_dt timestamp_ntz, null_count long, total_count long")


def as_rows(df):
    return sorted(str([None if v is None else round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


@pytest.mark.parametrize("lags,closed,radius,width", [((0, 1, 2, 3), True, 600, 600), ((1, 2, 3), False, 600, 600), ((0, 2), True, 1800, 600),
                                                      ((0, 1, 2, 3), False, 900, 300)])
def test_states_of_days_add_up_to_the_memo(spark, lags, closed, radius, width):
    df = counts(spark, len(lags) + radius, width)
    day = F.to_date("bucket_dt")
    days = [r[0] for r in df.select(day).distinct().collect()]
    states = None
    for d in days:                          # each day on its own, as the daily job stores them
        part = L.null_states(df.where(day == F.lit(d)), KEYS, radius, closed, width).withColumn("dt", F.lit(d))
        states = part if states is None else states.unionByName(part)
    got = L.null_memo_of_states(states, D, KEYS, lags)
    want = L.null_memo(df, D, KEYS, radius, lags, closed, width)
    assert as_rows(got) == as_rows(want) and want.count() > 100


def test_stored_thresholds_read_states_only(spark):
    df = counts(spark, 1)
    path = scratch_path(spark, "t_states")
    day = F.to_date("bucket_dt")
    for back in range(8, -1, -1):
        d = D - dt.timedelta(days=back - 1)
        SK.write_partitioned(L.null_states(df.where(day == F.lit(d)), KEYS).withColumn("dt", F.lit(d)), path, cluster_by=KEYS, replace=[d])
    got = CH.stored_null_threshold(spark, path, D, KEYS)
    assert as_rows(got) == as_rows(CH.compute_null_threshold(df, D, KEYS)) and got.count() > 20
    plan = CH.stored_null_threshold(spark, path, D, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters" in plan
    # a corrected day replaces its state alone
    fixed = df.withColumn("null_count", F.when(day == F.lit(D - dt.timedelta(days=2)), 0).otherwise(F.col("null_count")))
    d = D - dt.timedelta(days=2)
    SK.write_partitioned(L.null_states(fixed.where(day == F.lit(d)), KEYS).withColumn("dt", F.lit(d)), path, cluster_by=KEYS, replace=[d])
    assert as_rows(CH.stored_null_threshold(spark, path, D, KEYS)) == as_rows(CH.compute_null_threshold(fixed, D, KEYS))
