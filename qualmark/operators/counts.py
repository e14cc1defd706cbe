"""Counting operators.

* ``null_count``     - nulls and rows per ten-minute bucket, many columns in one pass
* ``freq_count``     - rows per class per day, many columns in one pass
* ``day_totals``     - per-day totals joined back to the class rows
* ``dedupe_by_max``  - ``max`` per key, absorbs re-runs that appended duplicates
* ``score_summary``  - scores grouped by ``floor(score)`` with a bounded sample
* ``score_metrics``  - mean score per series

Scale notes: ``null_count`` and ``freq_count`` aggregate the raw logs; both
are single hash aggregates with map-side partial aggregation, so the shuffle
carries at most one row per (series, bucket) per input partition. Columns are
turned into rows *after* the wide aggregate (``null_count``) or inside the
same stage before the partial aggregate (``freq_count``), never by re-reading.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import date_literal, epoch_seconds, from_epoch_seconds, registered
from .keys import join_on

# Fixed values of the reference's score summary: values shown per rank, the
# cut length of each value (-1: whole value) and the delimiter between them.
SAMPLE_COUNT = 1
SAMPLE_LENGTH = -1
SAMPLE_DELIMITER = "_|_"


def _named_columns(columns) -> list[tuple[str, Column]]:
    """Accept names, a mapping name -> Column, or (name, Column) pairs."""
    if isinstance(columns, str):
        return [(columns, F.col(columns))]
    if isinstance(columns, Mapping):
        return [(k, (F.col(v) if isinstance(v, str) else v)) for k, v in columns.items()]
    out = []
    for item in columns:
        if isinstance(item, str):
            out.append((item, F.col(item)))
        else:
            name, expr = item
            out.append((name, F.col(expr) if isinstance(expr, str) else expr))
    return out


def null_count(df: DataFrame, ts: str, columns, keys: Iterable[str] = (), bucket_seconds: int = 600,
               column_name: str = "column") -> DataFrame:
    """Per bucket: ``null_count`` = rows where the column is NULL, ``total_count`` = rows.

    Returns ``keys..., column, bucket_dt, null_count, total_count`` with one row
    per series and bucket (unique, so later stages need no de-duplication).
    ``columns`` may map output names to expressions, e.g.
    ``{"event_type": F.expr("nullif(event_type, 'error')")}``.
    """
    keys = list(keys)
    named = _named_columns(columns)
    aggs = [F.count(F.lit(1)).alias("total_count")]
    aggs += [F.count_if(expr.isNull()).alias(f"__n{i}") for i, (_, expr) in enumerate(named)]
    # raw rows are grouped by an integer slot, which becomes a timestamp after the aggregate
    slot = F.floor(epoch_seconds(ts) / F.lit(bucket_seconds)).cast("long")
    wide = df.groupBy(*keys, slot.alias("__slot")).agg(*aggs) \
        .withColumn("bucket_dt", from_epoch_seconds(F.col("__slot") * F.lit(bucket_seconds)))
    pairs = F.array(*[
        F.struct(F.lit(name).alias(column_name), F.col(f"__n{i}").alias("null_count"))
        for i, (name, _) in enumerate(named)
    ])
    return wide.select(*keys, "bucket_dt", "total_count", F.inline(pairs)).select(
        *keys, column_name, "bucket_dt", "null_count", "total_count")


def freq_count(df: DataFrame, day, columns, keys: Iterable[str] = (), column_name: str = "column") -> DataFrame:
    """Rows per non-null class per day: ``keys..., column, dt, class, cnt``.

    ``day`` is a DATE/TIMESTAMP column name or expression; classes are compared
    as text so many columns of different types share one output.
    """
    keys = list(keys)
    named = _named_columns(columns)
    day_col = F.to_date(F.col(day) if isinstance(day, str) else day).alias("dt")
    pairs = F.array(*[
        F.struct(F.lit(name).alias(column_name), expr.cast("string").alias("class")) for name, expr in named
    ])
    long = df.select(*keys, day_col, F.inline(pairs))
    return (long.where(F.col("class").isNotNull())
            .groupBy(*keys, column_name, "dt", "class")
            .agg(F.count(F.lit(1)).alias("cnt")))


def day_totals(counts: DataFrame, keys: Iterable[str], day: str = "dt", count: str = "cnt",
               total: str = "day_total") -> DataFrame:
    """Adds the per-day total of ``count`` to every class row, and the class share.

    The total is a grouped pre-aggregate joined back on ``(keys, day)``, not a
    window over ``(keys, day)``: a series with millions of classes would put a
    whole day into one window task, while the aggregate is map-side combined
    and the (small) totals side is broadcast by AQE at run time.
    """
    keys = list(keys)
    totals = counts.groupBy(*keys, day).agg(F.sum(count).alias(total))
    return (join_on(counts, totals, [*keys, day])
            .withColumn("share", F.try_divide(F.col(count).cast("double"), F.col(total))))


def dedupe_by_max(df: DataFrame, keys: Iterable[str], values: Iterable[str]) -> DataFrame:
    """``max`` of each value column per key; absorbs duplicated re-runs."""
    return df.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def score_summary(preds: DataFrame, keys: Iterable[str] = (), value: str = "value", score: str = "score",
                  sample_count: int = SAMPLE_COUNT, sample_length: int = SAMPLE_LENGTH,
                  delimiter: str = SAMPLE_DELIMITER, dt=None, regdatetime=None) -> DataFrame:
    """Scores grouped by ``rank = floor(score)``: row count and a text sample.

    ``sample`` joins the first ``sample_count`` values of the rank in value
    order (each cut to ``sample_length`` characters when that is > 0) with
    ``delimiter``. The sample is bounded before it is collected:
    ``row_number() <= sample_count`` lets Spark apply a map-side group limit,
    so a rank holding a third of all rows still ships only ``sample_count``
    rows per map task, and no unbounded list is ever built. Values without a
    score form a rank of their own (NULL). With ``dt`` (the scored day) the rows
    also carry ``dt`` and ``regdatetime``, as the stored summary does.
    """
    keys = list(keys)
    v = F.col(value).cast("string")
    shown = F.substring(v, 1, sample_length) if sample_length and sample_length > 0 else v
    base = preds.select(*keys, F.floor(F.col(score)).cast("long").alias("rank"), shown.alias("__s"))
    counts = base.groupBy(*keys, "rank").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*keys, "rank").orderBy(F.col("__s").asc_nulls_last())
    firsts = (base.where(F.col("__s").isNotNull())
              .withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") <= sample_count)
              .groupBy(*keys, "rank")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__rn", "__s"))),
                                            lambda e: e["__s"]), delimiter).alias("sample")))
    tags = [] if dt is None else [date_literal(dt).alias("dt"), registered(regdatetime).alias("regdatetime")]
    return (join_on(counts, firsts, [*keys, "rank"], how="left")
            .select(*keys, "rank", "count", F.coalesce(F.col("sample"), F.lit("")).alias("sample"), *tags)
            .orderBy(*keys, "rank"))


def score_metrics(scores: DataFrame, keys: Iterable[str] = (), score: str = "score") -> DataFrame:
    """Mean score (the evaluation ``distortion``) and row count per series."""
    return scores.groupBy(*keys).agg(F.avg(score).alias("distortion"), F.count(F.lit(1)).alias("n"))
