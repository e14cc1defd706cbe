"""Projections, filters and value rules.

Rule checks return the rows that break the rule, tagged with the series keys,
the rule parameters and a registration time. ``regdatetime`` is a parameter
(the reference evaluated it once at import time).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import number_column
from ..functions.time import date_literal, day_bounds, registered, ts_literal
from ..session import broadcast_if_small
from .keys import join_on

# Fixed values of the reference rule checks: the base rule list, the length
# limit and the min/max bounds.
BASE_RULES = ("0",)
LENGTH_LIMIT = 2
MIN_MAX_BOUNDS = (10, 100)


def _tags(dt, regdatetime) -> list[Column]:
    """Day and registration time of a violation row (the day only if it is given)."""
    return ([] if dt is None else [date_literal(dt).alias("dt")]) + [registered(regdatetime).alias("regdatetime")]


def tag_series(df: DataFrame, tags: Mapping[str, object]) -> DataFrame:
    """B1: add constant tag columns (e.g. ``gamecode``, ``column``, ``dt``)."""
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def name_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """B2: positional columns (``_c0, _c1, ...``) to names."""
    return df.toDF(*names)


def rule_passthrough(values: DataFrame, value: str = "value", keys: Iterable[str] = (),
                     rules: Sequence[str] = BASE_RULES, regdatetime=None, dt=None) -> DataFrame:
    """Every value row annotated with the rule list (base rule ``['0']``)."""
    keys = list(keys)
    return values.select(*keys, F.col(value).alias("data"),
                         F.array(*[F.lit(str(r)) for r in rules]).alias("rules"),
                         *_tags(dt, regdatetime))


def rule_length(values: DataFrame, value: str = "value", keys: Iterable[str] = (), max_len: int = LENGTH_LIMIT,
                regdatetime=None, dt=None) -> DataFrame:
    """Rows with ``length(value) <= max_len`` (characters)."""
    keys = list(keys)
    return (values.where(F.length(F.col(value).cast("string")) <= max_len)
            .select(*keys, F.col(value).alias("data"), F.lit(int(max_len)).alias("range"),
                    *_tags(dt, regdatetime)))


def rule_min_max(values: DataFrame, value: str = "value", keys: Iterable[str] = (), min_value=MIN_MAX_BOUNDS[0],
                 max_value=MIN_MAX_BOUNDS[1], regdatetime=None, dt=None) -> DataFrame:
    """Rows whose numeric value is ``< min_value`` or ``> max_value``.

    Only finite decimal numbers are compared: other text (``NaN``, ``inf``, ``250d``)
    and non-finite numbers are not a violation. A ``None`` bound makes the rule one-sided; both ``None`` gives
    an empty result with the same schema.
    """
    keys = list(keys)
    x = number_column(values, value)
    lo = None if min_value in (None, "") else float(min_value)
    hi = None if max_value in (None, "") else float(max_value)
    if lo is None and hi is None:
        cond = F.lit(False)
    elif lo is None:
        cond = x > hi
    elif hi is None:
        cond = x < lo
    else:
        cond = (x < lo) | (x > hi)
    return values.where(cond).select(
        *keys, F.col(value).alias("data"), F.lit(lo).cast("double").alias("min"),
        F.lit(hi).cast("double").alias("max"), *_tags(dt, regdatetime))


def evaluate_rules(values: DataFrame, rules: DataFrame, keys: Iterable[str], value: str = "value", regdatetime=None, dt=None) -> DataFrame:
    """B3-B5 as a table of rules, in one pass over the values.

    ``rules``: one row per rule of a series: ``keys..., rule``, and ``max_len`` (rule
    ``length``: values of at most so many characters), ``min`` and ``max`` (rule
    ``min_max``: numbers outside; a NULL bound is none). Rule ``base`` lists every value.
    A series' rules are one row that its values meet (NULL keys meet NULL keys), and the
    violations of a value are inlined. Returns ``keys..., data, rule, max_len, min, max``
    and the tags.
    """
    keys = list(keys)
    x = number_column(values, value)
    one = F.struct("rule", F.col("max_len").cast("int").alias("max_len"), F.col("min").cast("double").alias("min"),
                   F.col("max").cast("double").alias("max"))
    per = rules.groupBy(*keys).agg(F.sort_array(F.collect_set(one)).alias("__rules"))     # as many as the series has rules
    per, vals = broadcast_if_small(per, values.where(F.col(value).isNotNull())
                                   .select(*keys, F.col(value).alias("data"), F.length(F.col(value).cast("string")).alias("__len"), x.alias("__x")),
                                   row_bytes=256)

    def broken(r: Column) -> Column:
        return ((r["rule"] == "base") | ((r["rule"] == "length") & (F.col("__len") <= r["max_len"]))
                | ((r["rule"] == "min_max") & (F.coalesce(F.col("__x") < r["min"], F.lit(False)) | F.coalesce(F.col("__x") > r["max"], F.lit(False)))))

    met = join_on(vals, per, keys).select(*keys, "data", F.filter("__rules", broken).alias("__rules"))
    return met.select(*keys, "data", F.inline("__rules")).select(*keys, "data", "rule", "max_len", "min", "max", *_tags(dt, regdatetime))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNotNull())


def date_range(df: DataFrame, ts: str, as_of, lo: int, hi: int) -> DataFrame:
    """Rows with ``ts`` in the half-open day range ``[D+lo, D+hi)``.

    Written as two literal comparisons on the column, so the filter reaches
    the Parquet scan (``PushedFilters``) and prunes row groups / partitions.
    """
    start, end = day_bounds(as_of, lo, hi)
    return df.where((F.col(ts) >= ts_literal(start)) & (F.col(ts) < ts_literal(end)))


def split_value_md5(df: DataFrame, line: str = "value", out: str = "value") -> DataFrame:
    """Keep the text before the first tab of a ``value<TAB>md5`` line."""
    return df.withColumn(out, F.substring_index(F.col(line), "\t", 1))
