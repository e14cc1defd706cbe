"""Train -> predict -> report for one day, as one DataFrame plan.

The reference ran this as three cluster jobs with files in between: extract
yesterday's values, train a model on them, score today's distinct
values with yesterday's model, then summarise the scores by ``floor(score)``.
Here each step is a DataFrame: the model is a table keyed by the series, so
any number of series are trained and scored in the same job.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import as_date
from ..operators.counts import score_summary
from ..operators.density import BANDWIDTH, fit_kde, score_day, score_kde
from ..operators.keys import join_on
from ..operators.sampling import sample_per_series, split_rows
from ..operators.strings import fit_string_profile, score_day_strings, score_strings
from ..session import materialize
from ..sources.models import read_models
from ..sources.readers import read_dated
from ..sources.sinks import write_partitioned


def _day_values(logs: DataFrame, ts: str, value: str, day, keys: list[str]) -> DataFrame:
    return read_dated(logs, day, 0, ts=ts).where(F.col(value).isNotNull()).select(*keys, value)


def _train_rows(logs: DataFrame, ts: str, value: str, day, keys: list[str], sample_size: int | None,
                row_key: Iterable[str] | None, seed: str) -> DataFrame:
    """All rows of ``day``, or a sample of ``sample_size`` per series on request."""
    src = read_dated(logs, day, 0, ts=ts)
    if sample_size is None:
        return src.where(F.col(value).isNotNull()).select(*keys, value)
    return sample_per_series(src, keys, value, sample_size, key=list(row_key) if row_key else None, seed=seed)


def numeric_score_report(logs: DataFrame, ts: str, value: str, as_of, keys: Iterable[str],
                         sample_size: int | None = None, row_key: Iterable[str] | None = None,
                         seed: str = "qualmark", bandwidth: float = BANDWIDTH, sample_count: int = 1,
                         sample_length: int = -1, regdatetime=None) -> DataFrame:
    """Kernel density of day D-1 scores day D's values; summary by ``floor(score)``.

    Values that are no numbers have no score; the summary counts them under rank NULL.
    """
    keys = list(keys)
    d = as_date(as_of)
    train = _train_rows(logs, ts, value, d - _dt.timedelta(days=1), keys, sample_size, row_key, seed)
    scores = score_kde(fit_kde(train, keys, value), _day_values(logs, ts, value, d, keys), keys, value,
                       bandwidth=bandwidth)
    # the summary reads the scores twice (counts, bounded samples): write them
    # once, as the reference wrote its prediction files before summarising
    scores = materialize(scores, "numeric_scores")
    return score_summary(scores, keys, value, "score", sample_count=sample_count, sample_length=sample_length,
                         dt=d, regdatetime=regdatetime)


def string_score_report(logs: DataFrame, ts: str, value: str, as_of, keys: Iterable[str],
                        sample_size: int | None = None, row_key: Iterable[str] | None = None, seed: str = "qualmark",
                        sample_count: int = 1, sample_length: int = -1, regdatetime=None) -> DataFrame:
    """String profile of day D-1 scores day D's values; summary by ``floor(score)``."""
    keys = list(keys)
    d = as_date(as_of)
    train = _train_rows(logs, ts, value, d - _dt.timedelta(days=1), keys, sample_size, row_key, seed)
    scores = score_strings(fit_string_profile(train, keys, value), _day_values(logs, ts, value, d, keys), keys, value)
    scores = materialize(scores, "string_scores")   # read twice by the summary
    return score_summary(scores, keys, value, "score", sample_count=sample_count, sample_length=sample_length,
                         dt=d, regdatetime=regdatetime)


def score_day_stored(spark, path: str, values: DataFrame, keys: Iterable[str], value: str = "value", day: str = "dt",
                     lag_days: int = 1, strings: bool = False, **params) -> DataFrame:
    """F7 from a stored model table (``sources.models``): the days of ``values`` under the newest
    committed models of ``day - lag_days``; only those models' partitions are read."""
    days = [r[0] for r in values.select(F.date_sub(F.col(day), lag_days)).distinct().collect()]     # as many as days are scored
    models = read_models(spark, path, [d for d in days if d is not None])
    score = score_day_strings if strings else score_day
    return score(models, values, keys, value, day, "model_dt", lag_days, **params)


def publish_report(report: DataFrame, path: str, as_of, keys: Iterable[str]) -> None:
    """Store a day's score summary in the report table, replacing that day (the reference appended)."""
    write_partitioned(report, path, ("dt",), cluster_by=list(keys), replace=[as_date(as_of)])


def evaluate_densities(rows: DataFrame, value: str, keys: Iterable[str], row_key: Iterable[str],
                       seed: str = "qualmark", bandwidth: float = BANDWIDTH) -> DataFrame:
    """Fit on the train split, measure on the eval split: mean ``score`` (negative log density) per
    numeric eval row (``distortion``) and eval rows (``n``) of every series."""
    keys, row_key = list(keys), list(row_key)
    rows = rows.where(F.col(value).isNotNull())
    model = fit_kde(split_rows(rows, "train", row_key, seed), keys, value)
    held = split_rows(rows, "eval", row_key, seed).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    scores = join_on(score_kde(model, held, keys, value, bandwidth), held, [*keys, value]).where(F.col("score").isNotNull())
    return scores.groupBy(*keys).agg((F.sum(F.col("score") * F.col("__n")) / F.sum("__n")).alias("distortion"), F.sum("__n").alias("n"))


def evaluate_strings(rows: DataFrame, value: str, keys: Iterable[str], row_key: Iterable[str],
                     seed: str = "qualmark") -> DataFrame:
    """Fit on the train split, measure on the eval split: mean loss per eval row
    (``distortion``) and eval rows (``n``) of every series. The splits share no row."""
    keys, row_key = list(keys), list(row_key)
    rows = rows.where(F.col(value).isNotNull())
    profile = fit_string_profile(split_rows(rows, "train", row_key, seed), keys, value)
    held = split_rows(rows, "eval", row_key, seed).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    scores = join_on(score_strings(profile, held, keys, value), held, [*keys, value])
    return scores.groupBy(*keys).agg((F.sum(F.col("score") * F.col("__n")) / F.sum("__n")).alias("distortion"),
                                     F.sum("__n").alias("n"))
