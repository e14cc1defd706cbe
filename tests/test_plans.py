from pyspark.sql import functions as F
"""Physical-plan properties that the scale design relies on."""

import datetime as dt


from qualmark.operators import counts as C
from qualmark.operators import density as KD
from qualmark.operators import limits as L
from qualmark.operators import sampling as S

D = dt.date(2024, 1, 20)
NC_SCHEMA = "gamecode string, column string, bucket_dt timestamp_ntz, null_count bigint, total_count bigint"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _counts(spark):
    rows = [("g", "c", dt.datetime(2024, 1, 14) + dt.timedelta(minutes=10 * i), i % 3, 5) for i in range(1008)]
    return spark.createDataFrame(rows, NC_SCHEMA)


def test_seasonal_memo_is_one_aggregate_without_join(spark):
    p = plan(L.null_memo(_counts(spark), D))
    assert "Join" not in p and "NestedLoop" not in p and "Cartesian" not in p
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in p            # map-side combine before the shuffle


def test_threshold_adds_one_more_shuffle(spark):
    p = plan(L.null_threshold(L.null_memo(_counts(spark), D), D))
    assert "Join" not in p and p.count("Exchange hashpartitioning") == 2


def test_trailing_window_is_a_range_frame(spark):
    fc = spark.createDataFrame([("g", "c", D - dt.timedelta(days=i), "a", 1) for i in range(8)],
                               "gamecode string, column string, dt date, class string, cnt bigint")
    p = plan(L.freq_memo(fc, D))
    assert "RangeFrame, -3, currentrow" in p and "Join" not in p


def test_score_summary_limits_groups_map_side(spark):
    df = spark.createDataFrame([("g", "c", f"v{i}", float(i % 7)) for i in range(100)],
                               "gamecode string, column string, value string, score double")
    p = plan(C.score_summary(df, ["gamecode", "column"], sample_count=3))
    assert "WindowGroupLimit" in p
    assert "collect_list" in p


def test_null_count_is_single_scan_wide_aggregate(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = plan(C.null_count(ev, "ts", {"a": "event_type", "b": "value", "c": "props"}))
    assert p.count("FileScan") == 1 and p.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in p


def test_kde_values_meet_one_row_and_the_model_is_read_once(spark, tmp_path, monkeypatch):
    """A near value meets one local expansion, a shifted one an edge on either side, whatever the
    distances; the model is read once for all of them."""
    keys = ["gamecode", "column"]
    spark.createDataFrame([("g", "c", i / 40.0, 1) for i in range(4000)], "gamecode string, column string, __c double, weight bigint") \
        .write.parquet(str(tmp_path / "model"))
    model = spark.read.parquet(str(tmp_path / "model"))
    KD.local_expansions(model, keys, 1.0).write.parquet(str(tmp_path / "local"))
    local = spark.read.parquet(str(tmp_path / "local"))
    assert local.where("__own is not null").count() == 100 and local.count() == 100 + 2 * 13
    near = spark.createDataFrame([(i, i / 7.0, 4000, "g", "c") for i in range(600)],
                                 "__id bigint, __z double, __ntot bigint, gamecode string, column string")
    met = KD._near_pass(near, local, keys, 1.0, -20.0)
    p = plan(met)
    assert "Generate" not in p and "Cartesian" not in p and "NestedLoop" not in p and met.count() == 600
    far = near.withColumn("__z", F.pow(F.lit(1.05), F.col("__id")) + 200)         # distances of 42 octaves
    written, plans = {}, {}
    keep = KD.materialize

    def noted(df, name="stage"):
        plans[name] = plan(df)
        return written.setdefault(name, keep(df, name))
    monkeypatch.setattr(KD, "materialize", noted)
    out = KD._far_pass(far, local, model, keys, 1.0, -20.0)
    assert "NestedLoop" not in plan(out) and out.count() == 600
    assert written["kde_asked"].count() == 600 and written["kde_groups"].count() == 1
    assert plans["kde_groups"].count("model]") == 1


def test_page_numbers_without_global_window(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    p = plan(S.page_by_row_number(orders, ["o_orderkey"], 0, 9))
    # the only window runs over per-partition counts (an aggregate), never over the rows
    assert p.count("Window [") == 1 and "HashAggregate" in p.split("Window [")[1]
    assert "row_number" not in p


def test_daily_checks_read_only_the_day(spark):
    from qualmark.plans.checks import day_counts
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("gamecode", F.lit("events"))
    import qualmark.plans.checks as checks
    seen = []
    keep = checks.materialize
    try:
        checks.materialize = lambda df, name="stage": (seen.append(plan(df)), keep(df, name))[1]
        nulls, classes = day_counts(ev, "ts", {"props": "props"}, ["event_type"], "2024-01-20")
    finally:
        checks.materialize = keep
    assert len(seen) == 1 and seen[0].count("FileScan") == 1
    assert "GreaterThanOrEqual(ts,2024-01-20T00:00)" in seen[0] and "LessThan(ts,2024-01-21T00:00)" in seen[0]
    assert nulls.where("column = 'props'").agg(F.sum("total_count")).first()[0] == classes.agg(F.sum("cnt")).first()[0] > 0


def test_cluster_settings_scale_with_input(spark):
    from qualmark.session import BROADCAST_MAX_BYTES, cluster_settings
    small, big, huge = (cluster_settings(n)["spark.sql.shuffle.partitions"] for n in (10 ** 9, 100 * 1024 ** 4,
                                                                                      10 ** 18))
    assert (int(small), int(big), int(huge)) == (200, 12800, 50000)
    conf = cluster_settings()
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == str(BROADCAST_MAX_BYTES)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor") == "4"
