"""Rules, sampling, copies and pages."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from qualmark.operators import rules as R
from qualmark.operators import sampling as S

VALUES = ["9.9", "10", "10.5", "100", "100.5", "abc", "", None, "it's", "a\tb", "ñandú",
          "x" * 15, "y" * 16, "z" * 17]
REG = "2024-01-21 00:00:00"


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame([("g", "c", v) for v in VALUES], "gamecode string, column string, value string")


def test_min_max_rule(values):
    got = sorted(r.data for r in R.rule_min_max(values, "value", ["gamecode", "column"], regdatetime=REG).collect())
    assert got == ["100.5", "9.9"]


def test_min_max_one_sided_and_empty(values):
    assert sorted(r.data for r in R.rule_min_max(values, min_value=None, max_value=100).collect()) == ["100.5"]
    assert sorted(r.data for r in R.rule_min_max(values, min_value=10, max_value="").collect()) == ["9.9"]
    empty = R.rule_min_max(values, min_value=None, max_value=None)
    assert empty.count() == 0 and "regdatetime" in empty.columns


def test_length_rule(values):
    got = sorted(r.data for r in R.rule_length(values, max_len=2).collect())
    assert got == ["", "10"]


def test_passthrough_rules_array(values):
    rows = R.rule_passthrough(values.where("value is not null"), regdatetime=REG).collect()
    assert len(rows) == len(VALUES) - 1
    assert all(r.rules == ["0"] and r.regdatetime == dt.datetime(2024, 1, 21) for r in rows)


def test_split_value_md5(spark):
    df = spark.createDataFrame([("abc\t900150983cd24fb0d6963f7d28e17f72",), ("plain",)], "value string")
    assert [r.value for r in R.split_value_md5(df).collect()] == ["abc", "plain"]


def test_date_range_is_pushed_down(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = R.date_range(ev, "ts", "20240120", -3, 1).select("event_id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    lo, hi = dt.datetime(2024, 1, 17), dt.datetime(2024, 1, 21)
    want = ev.where((F.col("ts") >= lo) & (F.col("ts") < hi)).count()
    assert out.count() == want


def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def _key(v):
    return "|NULL" if v is None else f"|{len(str(v))}:{v}"


def test_sample_rows_exact_top_n(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    rows = orders.select("o_orderkey", "o_totalprice").collect()
    want = sorted(rows, key=lambda r: (_md5("s1" + _key(r.o_orderkey)), r.o_totalprice))[:37]
    got = S.sample_rows(orders, "o_totalprice", 37, key=["o_orderkey"], seed="s1").collect()
    assert sorted(r.o_totalprice for r in got) == sorted(r.o_totalprice for r in want)
    # more rows asked than exist: every non-null row
    assert S.sample_rows(orders.limit(10), "o_totalprice", 50, key=["o_orderkey"]).count() == 10


def test_sample_rows_md5_matches_hashlib(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    for r in S.sample_rows_md5(part, "p_name", 5, key=["p_partkey"]).collect():
        assert r.md5 == _md5(r.p_name)


def test_extract_dispatch(spark):
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    assert S.extract(cust, "c_mktsegment", "test", size=-1).count() == cust.select("c_mktsegment").distinct().count()
    assert S.extract(cust, "c_mktsegment", "train", size=7, key=["c_custkey"]).count() == 7
    with pytest.raises(ValueError):
        S.extract(cust, "c_mktsegment", "rule_null_freq_raw")


def test_page_by_row_number(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    keys = sorted(r.o_orderkey for r in orders.select("o_orderkey").collect())
    for lo, hi in ((0, 9), (1234, 1300), (len(keys) - 5, len(keys) + 10)):
        got = S.page_by_row_number(orders, ["o_orderkey"], lo, hi).select("o_orderkey", "rnum").collect()
        want = [(k, i + 1) for i, k in enumerate(keys) if lo + 1 <= i + 1 <= hi + 1]
        assert sorted((r.o_orderkey, r.rnum) for r in got) == want


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_numbers_are_right_across_partitions(spark, parts):
    """All columns kept, a shuffled input of many files, several partition counts."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").repartition(7)
        keys = sorted((r.o_totalprice, r.o_orderkey) for r in orders.select("o_totalprice", "o_orderkey").collect())
        want = {k: i + 1 for i, (_, k) in enumerate(keys)}
        for df in (S.number_rows(orders, ["o_totalprice", "o_orderkey"]),
                   S.page_by_row_number(orders, ["o_totalprice", "o_orderkey"], 3000, 11_000)):
            assert df.columns == [*orders.columns, "rnum"]
            got = {r.o_orderkey: r.rnum for r in df.select("o_orderkey", "rnum").collect()}
            assert all(want[k] == n for k, n in got.items())
            assert len(got) in (len(want), 8001)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_samples_keep_null_keys_whole_seeds_and_kinds_apart(spark):
    df = spark.range(1000).select(F.expr("if(id % 2 = 0, null, id)").alias("k"), F.col("id").alias("v"),
                                  F.expr("if(id < 500, null, 's')").alias("series"))
    assert S.sample_rows(df, "v", 900, key=["k", "v"]).count() == 900
    assert S.sample_rows(df, "v", 2000, key=["k"]).count() == 1000
    per = S.sample_per_series(df, ["series"], "v", 400, key=["v"]).groupBy("series").count().collect()
    assert sorted((r["series"] or "", r["count"]) for r in per) == [("", 400), ("s", 400)]
    draw = lambda seed: {r.v for r in S.sample_rows(df, "v", 200, key=["v"], seed=seed).collect()}
    assert 10 < len(draw("train1") & draw("train2")) < 80
    unkeyed = [{r.v for r in S.sample_rows(df, "v", 200, seed=s).collect()} for s in ("train1", "train2")]
    assert unkeyed[0] != unkeyed[1]
    kind = lambda k, **kw: {r.v for r in S.extract(df, "v", k, size=100, key=["v"], **kw).collect()}
    assert 0 < len(kind("train") & kind("eval")) < 40
    assert not kind("train", disjoint=True) & kind("eval", disjoint=True)
    assert S.hash_order_key("s", "a") is not None


def test_min_max_takes_only_numbers(spark):
    vals = spark.createDataFrame([(v,) for v in ("9.9", "10", "100.5", "abc", "", None, "NaN", "inf", "-Infinity", "250d", "1e3", ".5", "+7", "5.")],
                                 "value string")
    got = sorted(r.data for r in R.rule_min_max(vals, dt="2024-01-20").collect())
    assert got == sorted(["9.9", "100.5", "1e3", ".5", "+7", "5."])
    assert "dt" in R.rule_length(vals, dt="2024-01-20").columns
    doubles = spark.createDataFrame([(5.0,), (float("nan"),), (float("inf"),), (50.0,)], "value double")
    assert [r.data for r in R.rule_min_max(doubles).collect()] == [5.0]


def test_copy_table(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    got = [r.o_orderkey for r in S.copy_table(orders, 5, ["o_orderkey"]).collect()]
    assert got == sorted(r.o_orderkey for r in orders.select("o_orderkey").collect())[:5]
    assert S.copy_table(orders).count() == orders.count()


def test_sample_rows_unkeyed_is_row_uniform(spark):
    """Without a key, copies of one value are drawn independently (not all or none)."""
    df = spark.createDataFrame([("a",)] * 900 + [("b",)] * 100, "v string")
    got = [r.v for r in S.sample_rows(df, "v", 200, seed="x").collect()]
    assert len(got) == 200 and 140 <= got.count("a") <= 199 and got.count("b") >= 1
    again = [r.v for r in S.sample_rows(df, "v", 200, seed="x").collect()]
    assert sorted(got) == sorted(again)


def test_sample_per_series_exact(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    rows = orders.select("o_orderpriority", "o_orderkey", "o_totalprice").collect()
    got = S.sample_per_series(orders, ["o_orderpriority"], "o_totalprice", 25, key=["o_orderkey"], seed="z").collect()
    by = {}
    for r in rows:
        by.setdefault(r.o_orderpriority, []).append(r)
    want = sorted((p, r.o_totalprice) for p, rs in by.items()
                  for r in sorted(rs, key=lambda r: (_md5("z" + _key(r.o_orderkey)), r.o_totalprice))[:25])
    assert sorted((r.o_orderpriority, r.o_totalprice) for r in got) == want
    # a series smaller than n gives all its rows; the unkeyed mode gives n rows per series
    small = orders.where("o_orderkey < 40")
    assert S.sample_per_series(small, ["o_orderpriority"], "o_totalprice", 1000, key=["o_orderkey"]).count() == \
        small.count()
    unk = S.sample_per_series(orders, ["o_orderpriority"], "o_totalprice", 7, seed="u")
    assert sorted(r[0] for r in unk.groupBy("o_orderpriority").count().select("count").collect()) == [7] * 5


def test_selection_in_many_rounds_is_exact_and_bounded(spark, monkeypatch):
    """One digit a round and pieces of a few rows: the same sample, and the last step gets hardly more than it."""
    monkeypatch.setattr(S, "DIGITS", 1)
    monkeypatch.setattr(S, "PIECE_ROWS", 3)
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 97).alias("v"), F.expr("if(id % 3 = 0, null, 's')").alias("series"))
    rows = [(i, i % 97, None if i % 3 == 0 else "s") for i in range(5000)]
    order = lambda r: (_md5("z" + _key(r[0])), r[1])
    got = S.sample_rows(df, "v", 300, key=["k"], seed="z")
    assert sorted(r.v for r in got.collect()) == sorted(r[1] for r in sorted(rows, key=order)[:300])
    assert S.smallest(S._ordered(df, ["v"], ["k"], "z"), [], 300).count() <= 303
    per = S.sample_per_series(df, ["series"], "v", 40, key=["k"], seed="z").collect()
    for s in (None, "s"):
        assert sorted(r.v for r in per if r.series == s) == sorted(r[1] for r in sorted((r for r in rows if r[2] == s), key=order)[:40])
    assert S.smallest(S._ordered(df, ["series", "v"], ["k"], "z"), ["series"], 40).count() <= 2 * 43
    # all rows share one key: their hashes tie and values decide
    tied = S.sample_rows(df.withColumn("k", F.lit(None).cast("long")), "v", 60, key=["k"]).collect()
    assert sorted(r.v for r in tied) == sorted(r[1] for r in rows)[:60]
    assert S.sample_rows(df.limit(0), "v", 5, key=["k"]).collect() == [] and S.sample_rows(df, "v", 4999, seed="q").count() == 4999


def test_pages_with_ties_fit_together(spark):
    rows = [(k, i, None if i % 7 == 0 else float(i % 5)) for i, k in enumerate([1, 1, 2, 3, None, None, 3, 3, 3] * 20)]
    df = spark.createDataFrame(rows + rows[:4], "k int, i int, x double").repartition(5)
    n, seen = len(rows) + 4, []
    for lo in range(0, n, 23):
        page = S.page_by_row_number(df, ["k"], lo, lo + 22).collect()
        assert [r.rnum for r in sorted(page, key=lambda r: r.rnum)] == list(range(lo + 1, min(lo + 23, n) + 1))
        seen += page
    assert sorted((r.k is not None, r.k or 0, r.i) for r in seen) == sorted((k is not None, k or 0, i) for k, i, _ in rows + rows[:4])
    assert [r.k for r in sorted(seen, key=lambda r: r.rnum)] == sorted((k for k, _, _ in rows + rows[:4]), key=lambda k: (k is not None, k or 0))
    assert S.page_by_row_number(df, ["k"], n, n + 5).collect() == [] and S.page_by_row_number(df.limit(0), ["k"], 0, 5).collect() == []
    wide = S.page_by_row_number(df, ["x", "k"], 10, 60)
    assert wide.columns == ["k", "i", "x", "rnum"] and wide.count() == 51
