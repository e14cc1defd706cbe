"""Stored daily tables, rule tables, model versions, headed and delimited files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from qualmark.operators import density as KD
from qualmark.operators import rules as R
from qualmark.operators import strings as ST
from qualmark.plans import checks as CH
from qualmark.plans import scoring as SC
from qualmark.session import scratch_path
from qualmark.sources import models as M
from qualmark.sources import readers as RD
from qualmark.sources import sinks as SK

KEYS = ["gamecode", "column"]


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_rerun_that_finds_less_replaces_the_day(spark):
    path = scratch_path(spark, "t_stored")
    day = lambda d, vs: spark.createDataFrame([(v, d) for v in vs], "v string, dt string").withColumn("dt", F.to_date("dt"))
    SK.write_partitioned(day("2024-01-19", []), path, cluster_by=["v"], replace=["2024-01-19"])
    assert SK.read_stored(spark, path).collect() == [] and SK.read_stored(spark, path).columns == ["v", "dt"]
    SK.write_partitioned(day("2024-01-19", "ab"), path, cluster_by=["v"], replace=["2024-01-19"])
    SK.write_partitioned(day("2024-01-20", "cd"), path, cluster_by=["v"], replace=["2024-01-20"])
    SK.write_partitioned(day("2024-01-20", "c"), path, cluster_by=["v"], replace=["2024-01-20"])
    assert sorted(r.v for r in SK.read_stored(spark, path).collect()) == ["a", "b", "c"]
    SK.write_partitioned(day("2024-01-20", []), path, cluster_by=["v"], replace=["2024-01-20"])
    assert sorted(r.v for r in SK.read_stored(spark, path).collect()) == ["a", "b"]


def test_daily_checks_on_an_empty_first_day_and_all_null_classes(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("gamecode", F.lit("events"))
    out = scratch_path(spark, "t_first")
    nulls = {"event_type": F.col("event_type")}
    run = lambda logs, day: CH.write_daily_checks(logs, "ts", nulls, ["event_type"], day, out)
    paths = run(ev, "2030-01-01")                                           # no row on that day, and the first of all
    assert all(SK.read_stored(spark, p).collect() == [] for p in paths.values())
    paths = run(ev.withColumn("event_type", F.lit(None).cast("string")), "2024-01-19")
    assert SK.read_stored(spark, paths["freq_count"]).collect() == []
    assert SK.read_stored(spark, paths["null_count"]).count() > 0
    run(ev, "2024-01-20")
    run(ev, "2024-01-21")
    alerts = SK.read_stored(spark, paths["freq_alert"]).where("dt = '2024-01-21'")
    assert alerts.count() > 0
    run(ev.limit(0), "2024-01-21")                                          # corrected: the day has nothing
    assert all(SK.read_stored(spark, p).where("dt = '2024-01-21'").collect() == [] for p in paths.values())
    assert SK.read_stored(spark, paths["null_count"]).where("dt = '2024-01-20'").count() > 0


def test_rule_tables(spark, tmp_path):
    vals = spark.createDataFrame([("a", "x", v) for v in ("1", "50", "500", "abc", "NaN", None)] + [("b", None, v) for v in ("1", "zz", "7.5")]
                                 + [("c", "no rule", "1")], "gamecode string, column string, value string")
    rules = spark.createDataFrame([("a", "x", "length", 1, None, None), ("a", "x", "min_max", None, 10.0, 100.0),
                                   ("a", "x", "min_max", None, 10.0, 100.0), ("b", None, "min_max", None, None, 5.0),
                                   ("b", None, "base", None, None, None), ("d", "no values", "base", None, None, None),
                                   ("a", "x", "min_max", None, None, None)],
                                  "gamecode string, column string, rule string, max_len int, min double, max double")
    found = R.evaluate_rules(vals, rules, KEYS, dt="2024-01-20", regdatetime="2024-01-21 00:00:00")
    got = sorted((r.gamecode, r.rule, r.data) for r in found.collect())
    assert got == [("a", "length", "1"), ("a", "min_max", "1"), ("a", "min_max", "500"), ("b", "base", "1"), ("b", "base", "7.5"),
                   ("b", "base", "zz"), ("b", "min_max", "7.5")]
    # as the single rules say
    one = R.rule_min_max(vals.where("gamecode = 'a'"), "value", KEYS, 10, 100)
    assert sorted(r.data for r in one.collect()) == ["1", "500"]
    vals.write.parquet(str(tmp_path / "values"))
    plan = R.evaluate_rules(spark.read.parquet(str(tmp_path / "values")), rules, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert R.evaluate_rules(vals.limit(0), rules, KEYS).collect() == [] == R.evaluate_rules(vals, rules.limit(0), KEYS).collect()


def test_rule_job_reads_the_day_of_all_series(spark):
    root, out = scratch_path(spark, "t_rules_in"), scratch_path(spark, "t_rules_out")
    for series, day, vs in (("x", "20240119", ["old"]), ("x", "20240120", ["a", "a", "bcd"]), ("y", "20240120", ["7", "70"])):
        SK.write_delimited(spark.createDataFrame([(v,) for v in vs], "value string"), f"{root}/game/{series}/{day}/test")
    rules = spark.createDataFrame([("game", "x", "length", 2, None, None), ("game", "y", "min_max", None, 10.0, None)],
                                  "gamecode string, column string, rule string, max_len int, min double, max double")
    path = CH.write_daily_rules(spark, root, rules, "2024-01-20", out)
    got = SK.read_stored(spark, path).select("gamecode", "column", "data", "rule", "dt").collect()
    assert sorted(map(tuple, got)) == [("game", "x", "a", "length", dt.date(2024, 1, 20)), ("game", "y", "7", "min_max", dt.date(2024, 1, 20))]
    assert CH.write_daily_rules(spark, root, rules, "2024-02-01", out) == path            # a day without folders
    assert SK.read_stored(spark, path).count() == 2


def test_uncommitted_and_older_models_are_not_read(spark):
    path = scratch_path(spark, "t_models")
    with pytest.raises(FileNotFoundError):
        M.read_models(spark, path)
    model = lambda day, c: spark.createDataFrame([("g", "c", c, 1, day)], "gamecode string, column string, centre double, weight bigint, model_dt string") \
        .withColumn("model_dt", F.to_date("model_dt"))
    assert M.write_models(model("2024-01-19", 1.0).unionByName(model("2024-01-20", 2.0)), path) == 1
    assert M.write_models(model("2024-01-20", 3.0), path) == 2
    M.stage_models(model("2024-01-20", 99.0), path, 3)                      # a run that died before its commit
    assert M.committed_versions(spark, path) == [1, 2]
    got = M.read_models(spark, path)
    assert sorted((str(r.model_dt), r.centre) for r in got.collect()) == [("2024-01-19", 1.0), ("2024-01-20", 3.0)]
    assert sorted({f.split("/version=")[1].split("/part")[0] for f in got.inputFiles()}) == ["1/model_dt=2024-01-19", "2/model_dt=2024-01-20"]
    assert M.read_models(spark, path, [dt.date(2024, 1, 18)]).collect() == []
    assert M.write_models(model("2024-01-21", 4.0), path) == 4              # the dead run's number is not used again
    vals = spark.createDataFrame([("g", "c", "2024-01-21", 3.0)], "gamecode string, column string, dt string, value double").withColumn("dt", F.to_date("dt"))
    one = SC.score_day_stored(spark, path, vals, KEYS).collect()
    assert len(one) == 1 and one[0].score == pytest.approx(0.918938533)


def test_stored_string_models_and_the_report_table(spark):
    path, out = scratch_path(spark, "t_smodels"), scratch_path(spark, "t_report")
    vals = spark.createDataFrame([("g", "c", d, v) for d in ("2024-01-20", "2024-01-21") for v in ("abc", "abd", "x")],
                                 "gamecode string, column string, dt string, value string").withColumn("dt", F.to_date("dt"))
    M.write_models(ST.fit_string_profile(vals.withColumnRenamed("dt", "model_dt"), [*KEYS, "model_dt"]), path)
    want = ST.score_day_strings(ST.fit_string_profile(vals.withColumnRenamed("dt", "model_dt"), [*KEYS, "model_dt"]), vals, KEYS)
    assert rows(SC.score_day_stored(spark, path, vals, KEYS, strings=True)) == rows(want) and want.count() == 3
    logs = spark.createDataFrame([(f"2024-01-{d} 10:00:00", float(v)) for d in (19, 20) for v in range(20)], "ts string, value double") \
        .withColumn("ts", F.to_timestamp_ntz("ts")).withColumns({"gamecode": F.lit("g"), "column": F.lit("value")})
    report = SC.numeric_score_report(logs, "ts", "value", "2024-01-20", KEYS)
    for _ in range(2):
        SC.publish_report(report, out, "2024-01-20", KEYS)
    assert SK.read_stored(spark, out).count() == report.count() > 0


def test_headers_of_many_files_and_splits(spark):
    path = scratch_path(spark, "t_headers")
    os.makedirs(path.removeprefix("file:"))
    want = []
    for i in range(4):
        lines = [f"file {i} line {j} " + "x" * (j % 50) for j in range(400 * i)]
        want += lines
        with open(os.path.join(path.removeprefix("file:"), f"f{i}.txt"), "w") as f:
            f.write("\n".join(["header", *lines]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = RD.read_lines(spark, path, skip_header=True)
        assert sorted(r.value for r in got.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("sep", [",", "|", ";", "\t", " ", "\u0002"])
def test_separators_in_values(spark, sep):
    odd = ["a,b", "a|b", ";", " ", "\\", "\\s", "\\,", "\u0001s", "s", "", None, "\\N", "a\tb\nc", "\u0002", "|,;"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "i int, v string")
    path = scratch_path(spark, "t_sep")
    SK.write_delimited(df, path, sep=sep)
    assert sorted(map(tuple, RD.read_delimited(spark, path, "i int, v string", sep=sep).collect())) == sorted(map(tuple, df.collect()))


def test_separators_that_no_escape_can_carry(spark):
    for sep in ("", "||", "\\", "\n", "t"):
        with pytest.raises(ValueError):
            SK.write_delimited(spark.range(1), "/nowhere", sep=sep)


def test_series_of_empty_strings_score(spark):
    tr = spark.createDataFrame([("g", "e", ""), ("g", "e", ""), ("g", "f", "ab")], "gamecode string, column string, value string")
    te = spark.createDataFrame([("g", "e", ""), ("g", "e", "xyz"), ("g", "f", "ab")], "gamecode string, column string, value string")
    profile = ST.fit_string_profile(tr, KEYS)
    assert {(r.column, r.n_train) for r in profile.collect()} == {("e", 2), ("f", 1)}
    got = {(r.column, r.value): r.score for r in ST.score_strings(profile, te, KEYS).collect()}
    assert got["e", ""] == 0 and got["e", "xyz"] > 0 and len(got) == 3
    assert [r.column for r in ST.profile_mode(profile, KEYS).collect()] == ["f"]


def test_density_evaluation(spark):
    df = spark.range(400).select(F.lit("g").alias("gamecode"), F.lit("c").alias("column"), "id", (F.col("id") % 20).cast("double").alias("value"))
    r = SC.evaluate_densities(df, "value", KEYS, ["id"]).collect()
    assert len(r) == 1 and 10 < r[0].n < 80 and 2.5 < r[0].distortion < 3.5
    assert KD.BANDWIDTH == 1.0
