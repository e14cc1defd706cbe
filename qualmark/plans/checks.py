"""End-to-end daily checks (E8-E11): one DataFrame plan per check, many series.

``compute_null_threshold`` reads the seven past days of bucket counts and
derives day D's thresholds; ``compute_freq_threshold`` does the same for class
limits. The ``*_count`` plans are the daily count extracts, tagged by series.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_KEYS
from ..functions.time import as_date, date_literal
from ..operators.counts import freq_count, null_count
from ..operators.limits import (ADJACENT_WINDOW_SECONDS, FREQ_WEIGHT, NULL_WEIGHT, SEASONAL_LAGS, freq_alerts, freq_memo,
                                freq_rates, freq_threshold, null_alerts, null_memo,
                                null_memo_of_states, null_states, null_threshold)
from ..operators.rules import evaluate_rules
from ..session import materialize
from ..sources.readers import RULE_VALUES_SCHEMA, read_dated, read_dated_paths
from ..sources.sinks import read_stored, write_partitioned


def compute_null_count(logs: DataFrame, ts: str, columns, as_of=None, keys: Iterable[str] = ("gamecode",)) -> DataFrame:
    """The day's ten-minute null counts of every listed column."""
    src = read_dated(logs, as_of, 0, ts=ts) if as_of is not None else logs
    return null_count(src, ts, columns, keys)


def compute_null_threshold(counts: DataFrame, as_of, keys: Iterable[str] = DEFAULT_KEYS,
                           weight: float = NULL_WEIGHT, radius: int = ADJACENT_WINDOW_SECONDS,
                           lags: Sequence[int] = SEASONAL_LAGS, left_closed: bool = True) -> DataFrame:
    """Counts of days ``[D-7, D]`` -> memo -> thresholds of day D."""
    src = read_dated(counts, as_of, 7, ts="bucket_dt")
    memo = null_memo(src, as_of, keys, radius=radius, lags=lags, left_closed=left_closed)
    return null_threshold(memo, as_of, keys, weight=weight, radius=radius, lags=lags, left_closed=left_closed)


def compute_freq_count(logs: DataFrame, ts: str, columns, as_of=None, keys: Iterable[str] = ("gamecode",)) -> DataFrame:
    """The day's class counts of every listed column."""
    src = read_dated(logs, as_of, 0, ts=ts) if as_of is not None else logs
    return freq_count(src, ts, columns, keys)


def compute_freq_threshold(counts: DataFrame, as_of, keys: Iterable[str] = DEFAULT_KEYS,
                           weight: float = FREQ_WEIGHT) -> DataFrame:
    """Counts of days ``[D-7, D]`` -> memo -> rates -> limits of day D."""
    src = read_dated(counts, as_of, 7, day="dt")
    # the memo feeds both the class rows and the day totals of the rates:
    # written once, so its window (and the counts under it) runs once
    memo = materialize(freq_memo(src, as_of, keys), "freq_memo")
    return freq_threshold(freq_rates(memo, keys), as_of, keys, weight=weight)


def null_check_day(logs: DataFrame, ts: str, columns, as_of, keys: Iterable[str] = ("gamecode",),
                   weight: float = NULL_WEIGHT, radius: int = ADJACENT_WINDOW_SECONDS,
                   lags: Sequence[int] = SEASONAL_LAGS, left_closed: bool = True) -> DataFrame:
    """Day D's null thresholds straight from the raw logs.

    The raw rows are cut to the source days ``[D-6, D]`` on the event-time
    column itself, so the range reaches the scan (row-group skipping on
    Parquet, partition pruning when the table is partitioned by day) before
    the ten-minute aggregate; the memo then needs no further date filter.
    """
    keys = list(keys)
    raw = read_dated(logs, as_of, 6, ts=ts)
    counts = null_count(raw, ts, columns, keys)
    series = [*keys, "column"]
    memo = null_memo(counts, as_of, series, radius=radius, lags=lags, left_closed=left_closed)
    return null_threshold(memo, as_of, series, weight=weight, radius=radius, lags=lags, left_closed=left_closed)


def null_alert_day(logs: DataFrame, ts: str, columns, as_of, keys: Iterable[str] = ("gamecode",),
                   weight: float = NULL_WEIGHT) -> DataFrame:
    """Alerts of day D+1 against day D's thresholds, from the raw logs.

    The day D+1 counts read only that day (a pushed-down range on ``ts``).
    """
    keys = list(keys)
    nxt = as_date(as_of) + _dt.timedelta(days=1)
    counts = null_count(read_dated(logs, nxt, 0, ts=ts), ts, columns, keys)
    thresholds = null_check_day(logs, ts, columns, as_of, keys, weight=weight)
    return null_alerts(counts, thresholds, [*keys, "column"])


def freq_check_day(logs: DataFrame, ts: str, columns, as_of, keys: Iterable[str] = ("gamecode",),
                   weight: float = FREQ_WEIGHT) -> DataFrame:
    """Day D's class limits straight from the raw logs (source days ``[D-6, D]``;
    the day range on the event time reaches the scan)."""
    keys = list(keys)
    counts = freq_count(read_dated(logs, as_of, 6, ts=ts), ts, columns, keys)
    series = [*keys, "column"]
    memo = materialize(freq_memo(counts, as_of, series), "freq_memo")   # read twice by the rates
    return freq_threshold(freq_rates(memo, series), as_of, series, weight=weight)


def day_counts(logs: DataFrame, ts: str, null_columns, freq_columns, as_of,
               keys: Iterable[str] = ("gamecode",)) -> tuple[DataFrame, DataFrame]:
    """Day D's null counts and class counts from one scan of that day's raw rows.

    Every row gives one entry per checked column; the entries are counted in a
    single aggregate, combined map-side, and written once.
    """
    from ..functions.time import epoch_seconds, from_epoch_seconds
    from ..operators.counts import _named_columns
    keys = list(keys)
    slot = F.floor(epoch_seconds(ts) / F.lit(600)).cast("long")
    none = F.lit(None).cast("string")
    entries = [F.struct(F.lit(0).alias("kind"), F.lit(n).alias("column"), slot.alias("slot"), none.alias("class"),
                        e.isNull().cast("long").alias("nulls")) for n, e in _named_columns(null_columns)]
    entries += [F.struct(F.lit(1).alias("kind"), F.lit(n).alias("column"), F.lit(0).cast("long").alias("slot"),
                         e.cast("string").alias("class"), F.lit(0).cast("long").alias("nulls"))
                for n, e in _named_columns(freq_columns)]
    rows = read_dated(logs, as_of, 0, ts=ts).select(*keys, F.inline(F.array(*entries)))
    rows = rows.where((F.col("kind") == 0) | F.col("class").isNotNull())
    both = materialize(rows.groupBy(*keys, "kind", "column", "slot", "class").agg(
        F.sum("nulls").alias("null_count"), F.count(F.lit(1)).alias("cnt")), "day_counts")
    nulls = both.where("kind = 0").select(*keys, "column", from_epoch_seconds(F.col("slot") * 600).alias("bucket_dt"),
                                          "null_count", F.col("cnt").alias("total_count"))
    classes = both.where("kind = 1").select(*keys, "column", date_literal(as_of).alias("dt"), "class", "cnt")
    return nulls, classes


def write_daily_checks(logs: DataFrame, ts: str, null_columns, freq_columns, as_of, out: str,
                       keys: Iterable[str] = ("gamecode",)) -> dict[str, str]:
    """The reference's four daily commands and its two alert queries as one job family.

    Counts day D from its raw rows alone and stores the counts and the day's share of
    the null memo (``null_state``); the limits of day D come from the stored states and
    class counts of the past days, and the alerts of day D from
    its counts and the stored limits of day D-1. A day that was never
    counted is simply not there. Tables lie in ``out/<table>``, partitioned by
    ``dt`` and clustered by series: re-running a day replaces that day, also where
    less or nothing is found (the reference appended to MySQL, so re-runs
    duplicated rows). Read them with ``read_stored``. Returns the table paths.
    """
    keys = list(keys)
    series = [*keys, "column"]
    day, before = date_literal(as_of), date_literal(as_date(as_of) - _dt.timedelta(days=1))
    spark = logs.sparkSession
    paths = {name: f"{out}/{name}" for name in ("null_count", "freq_count", "null_state", "null_threshold", "freq_threshold", "null_alert", "freq_alert")}

    def write(df: DataFrame, name: str) -> None:
        write_partitioned(df if "dt" in df.columns else df.withColumn("dt", day), paths[name], cluster_by=series, replace=[as_date(as_of)])

    def stored(name: str, of) -> DataFrame:
        return read_stored(spark, paths[name]).where(F.col("dt") == of)

    nulls, classes = day_counts(logs, ts, null_columns, freq_columns, as_of, keys)
    write(nulls, "null_count")
    write(classes, "freq_count")
    write(null_states(stored("null_count", day).drop("dt"), series), "null_state")
    write(stored_null_threshold(spark, paths["null_state"], as_of, series), "null_threshold")
    write(stored_freq_threshold(spark, paths["freq_count"], as_of, series), "freq_threshold")
    write(null_alerts(stored("null_count", day).drop("dt"), stored("null_threshold", before).drop("dt"), series), "null_alert")
    write(freq_alerts(stored("freq_count", day), stored("freq_threshold", before), None, series), "freq_alert")
    return paths


def stored_null_threshold(spark, path: str, as_of, series: Iterable[str] = DEFAULT_KEYS, weight: float = NULL_WEIGHT,
                          lags: Sequence[int] = SEASONAL_LAGS) -> DataFrame:
    """Day D's null thresholds from the stored states of days ``[D-6, D]`` (``dt`` partitions of
    ``null_states``); no counts are read or spread again."""
    memo = null_memo_of_states(read_stored(spark, path), as_of, series, lags)
    return null_threshold(memo, as_of, series, weight=weight, lags=lags)


def stored_freq_threshold(spark, path: str, as_of, series: Iterable[str] = DEFAULT_KEYS) -> DataFrame:
    """Day D's class limits from the stored counts of the past days."""
    return compute_freq_threshold(read_stored(spark, path), as_of, series)


def write_rules(values: DataFrame, rules: DataFrame, as_of, out: str, value: str = "value", keys: Iterable[str] = DEFAULT_KEYS,
                regdatetime=None) -> str:
    """Day D's values against a table of rules (``evaluate_rules``), in one scan of the values.

    Violations replace the day's partition of ``out/rule_violations`` (``dt``, then ``rule``),
    also if there are none this time. Returns the table's path.
    """
    keys, path = list(keys), f"{out}/rule_violations"
    found = evaluate_rules(values, rules, keys, value, regdatetime, as_of)
    write_partitioned(found, path, ("dt", "rule"), cluster_by=keys, replace=[as_date(as_of)])
    return path


def write_daily_rules(spark, root: str, rules: DataFrame, as_of, out: str, keys: Iterable[str] = DEFAULT_KEYS, kind: str = "test",
                      regdatetime=None) -> str:
    """The daily rule job: reads day D's value files of all series (``root/<key>/.../YYYYMMDD/kind/*``)
    and stores the violations of their rules. Values are distinct, as the day's extract has them."""
    keys = list(keys)
    day = read_dated_paths(spark, root, as_of, 0, kind, RULE_VALUES_SCHEMA, keys=keys)
    return write_rules(day.select(*keys, "value").distinct(), rules, as_of, out, "value", keys, regdatetime)
