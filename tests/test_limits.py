"""Null-rate and class-frequency limits on hand-made fixtures and brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from qualmark.operators import counts as C
from qualmark.operators import limits as L

D = dt.date(2024, 1, 20)
T = dt.datetime(2024, 1, 20, 12, 0)
NC_SCHEMA = "gamecode string, column string, bucket_dt timestamp_ntz, null_count bigint, total_count bigint"


def _rows(df):
    return {tuple(r) for r in df.collect()}


def brute_memo(rows, as_of, lags=(0, 1, 2, 3), radius=600, left_closed=True):
    """Literal OR-of-ranges join, in Python."""
    d0 = dt.datetime.combine(as_of, dt.time())
    targets = [r for r in rows if d0 - dt.timedelta(days=3) <= r[2] < d0 + dt.timedelta(days=1)]
    sources = [r for r in rows if d0 - dt.timedelta(days=6) <= r[2] < d0 + dt.timedelta(days=1)]
    out = {}
    for t in targets:
        sx = sn = 0
        hit = False
        for s in sources:
            if s[:2] != t[:2]:
                continue
            ok = False
            for k in lags:
                c = t[2] - dt.timedelta(days=k)
                lo = c - dt.timedelta(seconds=radius)
                hi = c + dt.timedelta(seconds=radius)
                if (lo <= s[2] if left_closed else lo < s[2]) and s[2] <= hi:
                    ok = True
            if ok:
                hit = True
                sx += s[3]
                sn += s[4]
        if hit:
            p = sx / sn
            pi = t[3] / t[4]
            sig = math.sqrt(p * (1 - p) / t[4])
            z = (pi - p) / sig if sig else None
            out[(t[0], t[1], t[2])] = (p, z)
    return out


def _grid_rows(seed, series=(("g", "a"), ("g", "b")), days=8, step=600, dropout=0.3):
    rnd = random.Random(seed)
    rows = []
    start = dt.datetime(2024, 1, 13)
    for g, c in series:
        t = start
        while t < dt.datetime(2024, 1, 21):
            if rnd.random() > dropout and (t.hour in (0, 11, 12, 23)):
                n = rnd.randint(1, 9)
                rows.append((g, c, t, rnd.randint(0, n), n))
            t += dt.timedelta(seconds=step)
    return rows


@pytest.mark.parametrize("lags,left_closed", [((0, 1, 2, 3), True), ((1, 2, 3), False)])
def test_null_memo_equals_or_join(spark, lags, left_closed):
    rows = _grid_rows(7)
    df = spark.createDataFrame(rows, NC_SCHEMA)
    got = {(r.gamecode, r.column, r.bucket_dt): (r.p, r.zi) for r in
           L.null_memo(df, D, lags=lags, left_closed=left_closed).collect()}
    want = brute_memo(rows, D, lags=lags, left_closed=left_closed)
    assert set(got) == set(want)
    for k, (p, z) in want.items():
        assert got[k][0] == pytest.approx(p, rel=1e-12)
        if z is None:
            assert got[k][1] is None
        else:
            assert got[k][1] == pytest.approx(z, rel=1e-9, abs=1e-12)


def test_neighbourhood_edges(spark):
    """Buckets 600 s before/after and 601 s after the target, on days D..D-4."""
    rows = [("g", "c", T, 1, 2)]
    for k in range(0, 5):
        base = T - dt.timedelta(days=k)
        for off, x in ((-600, 1), (600, 2), (601, 100)):
            if k == 0 and off == 601:
                continue
            rows.append(("g", "c", base + dt.timedelta(seconds=off), x, 10))
    df = spark.createDataFrame(rows, NC_SCHEMA)
    memo = {r.bucket_dt: r for r in L.null_memo(df, D, bucket_seconds=1).collect()}
    m = memo[T]
    # lags 0..3 closed: the target itself + (-600, +600) on D..D-3; +601 and day D-4 excluded
    assert m.xi == 1 and m.ni == 2
    assert m.p == pytest.approx((1 + 4 * (1 + 2)) / (2 + 8 * 10))
    eff = {r.bucket_dt: r for r in L.null_memo(df, D, lags=(1, 2, 3), left_closed=False,
                                               bucket_seconds=1).collect()}
    # effective reference form: only the +600 side of D-1..D-3
    assert eff[T].p == pytest.approx(3 * 2 / (3 * 10))


def test_sigma_zero_and_all_null(spark):
    base = dt.datetime(2024, 1, 20, 5, 0)
    rows = []
    for k in range(0, 7):
        rows.append(("g", "zero", base - dt.timedelta(days=k), 0, 5))
        rows.append(("g", "full", base - dt.timedelta(days=k), 5, 5))
    df = spark.createDataFrame(rows, NC_SCHEMA)
    memo = L.null_memo(df, D)
    for r in memo.collect():
        assert r.sigma_pi == 0.0 and r.zi is None
    thr = L.null_threshold(memo, D).collect()
    assert len(thr) == 2 and all(r.threshold is None for r in thr)
    counts = df.withColumn("bucket_dt", F.col("bucket_dt") + F.expr("INTERVAL 1 DAY"))
    alerts = L.null_alerts(counts, L.null_threshold(memo, D)).collect()
    by = {r.column: r for r in alerts}
    assert by["zero"].threshold == 0.0 and by["zero"].alert is None
    assert by["full"].threshold == 0.0 and by["full"].alert == -1.0


def test_series_do_not_mix(spark):
    rows = _grid_rows(3, series=(("g", "a"),))
    other = _grid_rows(4, series=(("g", "b"),))
    one = spark.createDataFrame(rows, NC_SCHEMA)
    both = spark.createDataFrame(rows + other, NC_SCHEMA)
    def rounded(d):
        return {tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in d.collect()}

    a1 = rounded(L.null_threshold(L.null_memo(one, D), D))
    a2 = rounded(L.null_threshold(L.null_memo(both, D), D).where(F.col("column") == "a"))
    assert a1 == a2 and a1


def test_threshold_at_least_p(spark):
    df = spark.createDataFrame(_grid_rows(11), NC_SCHEMA)
    for r in L.null_threshold(L.null_memo(df, D), D).collect():
        if r.threshold is not None:
            assert r.threshold >= r.p - 1e-15


FC_SCHEMA = "gamecode string, column string, dt date, class string, cnt bigint"


def _freq_fixture():
    rows = []
    for k in range(0, 8):
        d = D - dt.timedelta(days=k)
        if k == 2:
            continue                       # a day missing altogether
        rows.append(("g", "c", d, "a", 10 + k))
        rows.append(("g", "c", d, "b", 5))
        if k >= 1:
            rows.append(("g", "c", d, "gone", 3))   # gone on day D
    rows.append(("g", "c", D, "new", 4))            # new on day D
    return rows


def brute_freq(rows, as_of, weight=6):
    memo = {}
    for (g, c, d, cls, n) in rows:
        if as_of - dt.timedelta(days=3) <= d <= as_of:
            x = sum(r[4] for r in rows if r[:2] == (g, c) and r[3] == cls
                    and d - dt.timedelta(days=3) <= r[2] <= d)
            memo[(g, c, d, cls)] = (n, x)
    rates = {}
    for (g, c, d, cls), (xi, x) in memo.items():
        ni = sum(v[0] for k, v in memo.items() if k[:3] == (g, c, d))
        n = sum(v[1] for k, v in memo.items() if k[:3] == (g, c, d))
        pi, p = xi / ni, x / n
        s = math.sqrt(p * (1 - p) / ni)
        rates[(g, c, d, cls)] = (pi, p, s, (pi - p) / s if s else None)
    out = {}
    for (g, c, d, cls), (pi, p, s, z) in rates.items():
        if d != as_of:
            continue
        zs = [v[3] for k, v in rates.items() if k[:2] == (g, c) and k[3] == cls
              and d - dt.timedelta(days=3) <= k[2] <= d and v[3] is not None]
        if not zs:
            out[cls] = None
            continue
        mu = sum(zs) / len(zs)
        sz = math.sqrt(sum((z - mu) ** 2 for z in zs) / len(zs))
        out[cls] = (p - weight * s * sz, p + weight * s * sz)
    return out


def test_freq_threshold_fixture(spark):
    rows = _freq_fixture()
    df = spark.createDataFrame(rows, FC_SCHEMA)
    thr = L.freq_threshold(L.freq_rates(L.freq_memo(df, D)), D).collect()
    want = brute_freq(rows, D)
    got = {r["class"]: (r.lowerbound, r.upperbound) for r in thr}
    assert set(got) == set(want) == {"a", "b", "new"}
    for k, v in want.items():
        if v is None:
            assert got[k] == (None, None)
        else:
            assert got[k][0] == pytest.approx(v[0], rel=1e-9, abs=1e-12)
            assert got[k][1] == pytest.approx(v[1], rel=1e-9, abs=1e-12)


def test_freq_all_days_equals_daily_runs(spark):
    df = spark.createDataFrame(_freq_fixture(), FC_SCHEMA)
    all_days = L.freq_threshold(L.freq_rates(L.freq_memo(df, None)), None)
    def rounded(d):
        return {tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in d.collect()}

    for day in (D, D - dt.timedelta(days=1)):
        daily = rounded(L.freq_threshold(L.freq_rates(L.freq_memo(df, day)), day))
        assert daily and daily == rounded(all_days.where(F.col("dt") == F.lit(day)))


def test_freq_shares_sum_to_one(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("gamecode", F.lit("e"))
    fc = C.freq_count(ev, "ts", ["event_type", "user_id"], keys=["gamecode"])
    sums = C.day_totals(fc, ["gamecode", "column"]).groupBy("gamecode", "column", "dt").agg(
        F.sum("share").alias("s")).collect()
    assert sums and all(abs(r.s - 1) < 1e-9 for r in sums)


def test_freq_alerts_fixture(spark):
    counts = spark.createDataFrame([("g", "c", D, "a", 90), ("g", "c", D, "b", 10)], FC_SCHEMA)
    thr = spark.createDataFrame([("g", "c", D - dt.timedelta(days=1), "a", 0.5, 0.8),
                                 ("g", "c", D - dt.timedelta(days=1), "b", 0.05, 0.2),
                                 ("g", "c", D - dt.timedelta(days=1), "b", 0.05, 0.2)],
                                "gamecode string, column string, dt date, class string, lowerbound double, upperbound double")
    out = {r["class"]: r for r in L.freq_alerts(counts, thr, D).collect()}
    assert out["a"].pi == 0.9 and out["a"].alert == 1
    assert out["b"].pi == 0.1 and out["b"].alert == 0


def test_null_count_totals(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    nc = C.null_count(ev, "ts", {"et": F.expr("nullif(event_type, 'error')"), "v": "value"})
    tot = nc.groupBy("column").agg(F.sum("total_count").alias("t"), F.sum("null_count").alias("n")).collect()
    n = ev.count()
    errors = ev.where("event_type = 'error'").count()
    got = {r.column: (r.t, r.n) for r in tot}
    assert got == {"et": (n, errors), "v": (n, 0)}


def test_buckets_ignore_session_time_zone(spark):
    """Wall-clock buckets and seasonal slots do not move with a DST session zone."""
    from qualmark.functions.time import bucket_start, epoch_seconds, from_epoch_seconds
    rows = [(dt.datetime(2024, 3, 10, 2, 37, 5),), (dt.datetime(2024, 7, 1, 0, 7),), (dt.datetime(1969, 12, 31, 23, 59, 59),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(epoch_seconds("ts").alias("s"), bucket_start("ts").alias("b"),
                        from_epoch_seconds(epoch_seconds("ts")).alias("back"), "ts").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    import calendar
    for r in got:
        assert r.s == calendar.timegm(r.ts.timetuple())
        assert r.back == r.ts
        assert r.b == r.ts.replace(minute=r.ts.minute - r.ts.minute % 10, second=0)


def test_null_memo_property_random_grids(spark):
    """E1 equals the OR join for random radius, bucket width, lags and edge rule."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(bucket=st.sampled_from([300, 600, 900]), mult=st.integers(0, 3), extra=st.integers(0, 1),
           lags=st.lists(st.integers(0, 3), min_size=1, max_size=4, unique=True), closed=st.booleans(),
           seed=st.integers(0, 1000))
    def check(bucket, mult, extra, lags, closed, seed):
        radius = bucket * mult + (bucket // 3) * extra          # on or off the grid
        rows = _grid_rows(seed, step=bucket, dropout=0.5)
        df = spark.createDataFrame(rows, NC_SCHEMA)
        got = {(r.gamecode, r.column, r.bucket_dt): r.p for r in
               L.null_memo(df, D, radius=radius, lags=tuple(lags), left_closed=closed,
                           bucket_seconds=bucket).collect()}
        want = brute_memo(rows, D, lags=tuple(lags), radius=radius, left_closed=closed)
        assert set(got) == set(want)
        for k, (p, _) in want.items():
            assert got[k] == pytest.approx(p, rel=1e-12)

    check()


def test_freq_threshold_property_random_counts(spark):
    """E3-E5 equal the self-join formulation on random counts with missing days and classes."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(seed=st.integers(0, 10_000), classes=st.integers(1, 5), gap=st.floats(0.0, 0.5))
    def check(seed, classes, gap):
        rnd = random.Random(seed)
        rows = [("g", "c", D - dt.timedelta(days=k), f"k{j}", rnd.randint(1, 50))
                for k in range(8) for j in range(classes) if rnd.random() >= gap]
        if not rows:
            return
        df = spark.createDataFrame(rows, FC_SCHEMA)
        got = {r["class"]: (r.lowerbound, r.upperbound)
               for r in L.freq_threshold(L.freq_rates(L.freq_memo(df, D)), D).collect()}
        want = brute_freq(rows, D)
        assert set(got) == set(want)
        for k, v in want.items():
            if v is None:
                assert got[k] == (None, None)
            else:
                assert got[k][0] == pytest.approx(v[0], rel=1e-9, abs=1e-12)
                assert got[k][1] == pytest.approx(v[1], rel=1e-9, abs=1e-12)

    check()
