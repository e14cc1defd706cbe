"""Control limits and alerts.

The limits have the shape of a Laney p' chart: ``p +- k * sigma_pi * sigma_z``
with ``sigma_pi = sqrt(p(1-p)/n_i)`` and ``sigma_z`` the population standard
deviation of ``z_i = (p_i - p)/sigma_pi`` over a neighbourhood.

Null rates (E1, E2) use a *seasonal neighbourhood*: bucket ``t`` is compared
with all buckets within ``radius`` seconds of ``t - k days`` for each lag
``k``. Written as SQL this is an OR-of-ranges theta join, which Spark can only
plan as a nested loop. Here it is one hash aggregate instead: every source
bucket is emitted once per (lag, grid offset) to the target bucket it falls
next to, plus once to itself (carrying the target's own counts), and the
emissions are summed per target. No join, one shuffle, and the shuffle is
map-side combined. It is exact because buckets lie on a ``bucket_seconds``
grid (``null_count`` guarantees that), so every target within the radius of a
shifted source is one of a fixed, small set of grid offsets.

Class frequencies (E3-E5) use a trailing window of days per class: a
``rangeBetween(-3, 0)`` window frame over the day number, partitioned by
(series, class) - one shuffle instead of a self-join and its row blow-up.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import DEFAULT_KEYS
from ..functions.stats import binomial_sigma, safe_div, z_score
from ..functions.time import (DAY_SECONDS, as_date, date_literal, day_bounds, day_number, epoch_seconds,
                              from_epoch_seconds, ts_literal)
from .counts import dedupe_by_max
from .keys import join_on

# Fixed values of the reference checks: neighbourhood radius in seconds, the
# confidence weights of the null and frequency limits, the seasonal lags in
# days, and the day windows around the target day D.
ADJACENT_WINDOW_SECONDS = 600
NULL_WEIGHT = 3
FREQ_WEIGHT = 6
SEASONAL_LAGS = (0, 1, 2, 3)
MEMO_DAYS = (-3, 1)       # memo targets: [D-3, D+1)
SOURCE_DAYS = (-6, 1)     # memo sources: [D-6, D+1)
THRESHOLD_DAYS = (0, 1)   # threshold targets: [D, D+1)
TRAILING_DAYS = 3         # frequency window [d-3, d]
LITERAL_EMISSIONS = 256   # emission lists up to this size are a constant array


def _grid_range(radius: int, bucket_seconds: int, left_closed: bool) -> tuple[int, int]:
    """Grid offsets ``j`` of a neighbour: ``t = s + k*day + j*w``.

    A source ``s`` is a neighbour of target ``t`` at lag ``k`` when
    ``s - (t - k*day)`` lies in ``[-radius, radius]`` (or ``(-radius, radius]``
    when ``left_closed`` is false), i.e. ``-radius <= j*w <= radius``
    (resp. ``-radius <= j*w < radius``).
    """
    if DAY_SECONDS % bucket_seconds:
        raise ValueError("bucket_seconds must divide one day")
    if 2 * radius >= DAY_SECONDS:
        raise ValueError("radius must be under half a day so lags do not overlap")
    j_min = -(radius // bucket_seconds)
    j_max = radius // bucket_seconds if left_closed else (radius + bucket_seconds - 1) // bucket_seconds - 1
    return j_min, j_max


def _seasonal_emit(df: DataFrame, keys: list[str], bucket: str, cols: list[str], radius: int,
                   bucket_seconds: int, lags: Sequence[int], left_closed: bool,
                   target_lo: int, target_hi: int) -> DataFrame:
    """Emit each bucket row to the target slots it belongs to (see module doc).

    Emissions are ``(offset, neighbour, self)``: one per (lag, grid offset) -
    a constant array when short, else built by ``transform`` over ``sequence``
    so the expression stays small for any radius - plus the self emission (merged into lag 0, offset 0 when
    lag 0 is in ``lags``). Emissions outside the target days are dropped
    before the shuffle.
    """
    j_min, j_max = _grid_range(radius, bucket_seconds, left_closed)
    w = bucket_seconds

    def emit(k, j):
        return F.struct((k.cast("long") * F.lit(DAY_SECONDS) + j.cast("long") * F.lit(w)).alias("__off"),
                        F.lit(1).alias("__nb"),
                        F.when((k == 0) & (j == 0), 1).otherwise(0).alias("__me"))

    self_row = F.struct(F.lit(0).cast("long").alias("__off"), F.lit(0).alias("__nb"), F.lit(1).alias("__me"))
    n_emit = len(lags) * max(0, j_max - j_min + 1)
    if n_emit == 0:
        # no neighbour offsets (e.g. radius 0 with an open left edge): only the
        # self row, so targets exist but none has a neighbour (inner semantics)
        arr = F.array(self_row)
    elif n_emit <= LITERAL_EMISSIONS:
        # a constant array: folded once by the optimiser, no per-row lambda
        arr = F.array(*[F.struct(F.lit(k * DAY_SECONDS + j * w).cast("long").alias("__off"), F.lit(1).alias("__nb"),
                                 F.lit(1 if (k == 0 and j == 0) else 0).alias("__me"))
                        for k in lags for j in range(j_min, j_max + 1)])
    else:
        arr = F.flatten(F.transform(F.array(*[F.lit(int(k)) for k in lags]),
                                    lambda k: F.transform(F.sequence(F.lit(j_min), F.lit(j_max)),
                                                          lambda j: emit(k, j))))
    # the self row rides on (lag 0, offset 0) when that emission exists
    if n_emit > 0 and not (0 in set(lags) and j_min <= 0 <= j_max):
        arr = F.concat(arr, F.array(self_row))
    out = (df.select(*keys, epoch_seconds(bucket).alias("__sec"), *cols, F.inline(arr))
           .withColumn("__t", F.col("__sec") + F.col("__off")))
    return out.where((F.col("__t") >= F.lit(int(target_lo))) & (F.col("__t") < F.lit(int(target_hi))))


def _utc_seconds(dt) -> int:
    import calendar
    return calendar.timegm(dt.timetuple())


def null_memo(counts: DataFrame, as_of, keys: Iterable[str] = DEFAULT_KEYS, radius: int = ADJACENT_WINDOW_SECONDS,
              lags: Sequence[int] = SEASONAL_LAGS, left_closed: bool = True, bucket_seconds: int = 600,
              bucket: str = "bucket_dt", nulls: str = "null_count", totals: str = "total_count") -> DataFrame:
    """Per target bucket of days ``[D-3, D+1)``: ``xi, ni, pi, p, sigma_pi, zi``.

    ``p`` pools null and total counts of all source buckets (days ``[D-6, D+1)``)
    within ``radius`` seconds of ``t``, ``t-1d``, ... (``lags``). Targets without
    any neighbour are dropped (inner-join semantics). Input must hold one row
    per (series, bucket) on a ``bucket_seconds`` grid, as ``null_count`` gives.

    Defaults are the intended form (lags 0..3, closed window). The reference's
    effective behaviour is ``lags=(1, 2, 3), left_closed=False``.
    """
    keys = list(keys)
    s_lo, s_hi = day_bounds(as_of, *SOURCE_DAYS)
    t_lo, t_hi = day_bounds(as_of, *MEMO_DAYS)
    src = counts.where((F.col(bucket) >= ts_literal(s_lo)) & (F.col(bucket) < ts_literal(s_hi))).select(
        *keys, bucket, F.col(nulls).cast("long").alias("__x"), F.col(totals).cast("long").alias("__n"))
    em = _seasonal_emit(src, keys, bucket, ["__x", "__n"], radius, bucket_seconds, lags, left_closed,
                        _utc_seconds(t_lo), _utc_seconds(t_hi))
    nb = F.col("__nb") == 1
    me = F.col("__me") == 1
    agg = (em.groupBy(*keys, "__t").agg(
        F.sum(F.when(nb, F.col("__x"))).alias("sum_x"),
        F.sum(F.when(nb, F.col("__n"))).alias("sum_n"),
        F.sum("__nb").alias("__matches"),
        F.max(F.when(me, F.col("__x"))).alias("xi"),
        F.max(F.when(me, F.col("__n"))).alias("ni"),
        F.max("__me").alias("__has_self"))
        .where((F.col("__has_self") == 1) & (F.col("__matches") > 0)))
    return _memo_columns(agg, keys, bucket)


def _memo_columns(sums: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """The memo's rates from ``sum_x, sum_n, xi, ni`` per target ``__t``."""
    pi = safe_div(F.col("xi").cast("double"), F.col("ni"))
    p = safe_div(F.col("sum_x").cast("double"), F.col("sum_n"))
    out = sums.select(*keys, from_epoch_seconds(F.col("__t")).alias(bucket), "xi", "ni",
                      pi.alias("pi"), p.alias("p"))
    out = out.withColumn("sigma_pi", binomial_sigma(F.col("p"), F.col("ni")))
    return out.withColumn("zi", z_score(F.col("pi"), F.col("p"), F.col("sigma_pi")))


def null_states(counts: DataFrame, keys: Iterable[str] = DEFAULT_KEYS, radius: int = ADJACENT_WINDOW_SECONDS, left_closed: bool = True,
                bucket_seconds: int = 600, bucket: str = "bucket_dt", nulls: str = "null_count", totals: str = "total_count") -> DataFrame:
    """A day's share of the null memo, ready to be added to other days': per slot (``slot``, in
    epoch seconds) the null and total counts of the day's buckets within ``radius`` seconds
    of it (``sum_x, sum_n, matches``), and the slot's own ``xi, ni`` if it is one of them.

    States of different days add up (``null_memo_of_states``), so the neighbourhood of a
    bucket is spread once, on its own day, and not again on the six days after it.
    """
    keys = list(keys)
    src = counts.select(*keys, bucket, F.col(nulls).cast("long").alias("__x"), F.col(totals).cast("long").alias("__n"))
    far = 1 << 60
    em = _seasonal_emit(src, keys, bucket, ["__x", "__n"], radius, bucket_seconds, (0,), left_closed, -far, far)
    nb, me = F.col("__nb") == 1, F.col("__me") == 1
    return em.groupBy(*keys, F.col("__t").alias("slot")).agg(
        F.sum(F.when(nb, F.col("__x"))).alias("sum_x"), F.sum(F.when(nb, F.col("__n"))).alias("sum_n"), F.sum("__nb").alias("matches"),
        F.max(F.when(me, F.col("__x"))).alias("xi"), F.max(F.when(me, F.col("__n"))).alias("ni"), F.max("__me").alias("own"))


def null_memo_of_states(states: DataFrame, as_of, keys: Iterable[str] = DEFAULT_KEYS, lags: Sequence[int] = SEASONAL_LAGS,
                        day: str = "dt", bucket: str = "bucket_dt") -> DataFrame:
    """``null_memo`` from the stored ``null_states`` of days ``[D-6, D]`` (column ``day``): every slot's
    sums go to the same time of the ``lags`` days after it, and add up there."""
    keys, d = list(keys), as_date(as_of)
    t_lo, t_hi = (_utc_seconds(x) for x in day_bounds(as_of, *MEMO_DAYS))
    src = states.where((F.col(day) >= F.date_sub(date_literal(d), -SOURCE_DAYS[0])) & (F.col(day) <= date_literal(d)))
    one = lambda k, nb, me: F.struct(F.lit(k * DAY_SECONDS).cast("long").alias("__off"), F.lit(nb).alias("__nb"), F.lit(me).alias("__me"))
    emissions = [one(k, True, k == 0) for k in lags] + ([] if 0 in lags else [one(0, False, True)])
    em = src.select("*", F.inline(F.array(*emissions))).withColumn("__t", F.col("slot") + F.col("__off")) \
        .where((F.col("__t") >= F.lit(t_lo)) & (F.col("__t") < F.lit(t_hi)))
    nb, me = F.col("__nb"), F.col("__me") & (F.col("own") == 1)
    agg = em.groupBy(*keys, "__t").agg(
        F.sum(F.when(nb, F.col("sum_x"))).alias("sum_x"), F.sum(F.when(nb, F.col("sum_n"))).alias("sum_n"),
        F.sum(F.when(nb, F.col("matches"))).alias("__matches"), F.max(F.when(me, F.col("xi"))).alias("xi"),
        F.max(F.when(me, F.col("ni"))).alias("ni"), F.max(F.when(me, 1).otherwise(0)).alias("__has_self")) \
        .where((F.col("__has_self") == 1) & (F.col("__matches") > 0))
    return _memo_columns(agg, keys, bucket)


def null_threshold(memo: DataFrame, as_of, keys: Iterable[str] = DEFAULT_KEYS, weight: float = NULL_WEIGHT,
                   radius: int = ADJACENT_WINDOW_SECONDS, lags: Sequence[int] = SEASONAL_LAGS,
                   left_closed: bool = True, bucket_seconds: int = 600, bucket: str = "bucket_dt") -> DataFrame:
    """For buckets of day D: ``threshold = p + weight * sigma_pi * sigma_zi``.

    ``sigma_zi`` is ``stddev_pop(zi)`` over the memo rows (days ``[D-3, D+1)``)
    in the same seasonal neighbourhood as ``null_memo``. NULL ``zi`` (p = 0 or 1)
    are skipped; if all are NULL the threshold is NULL.
    """
    keys = list(keys)
    s_lo, s_hi = day_bounds(as_of, *MEMO_DAYS)
    t_lo, t_hi = day_bounds(as_of, *THRESHOLD_DAYS)
    src = memo.where((F.col(bucket) >= ts_literal(s_lo)) & (F.col(bucket) < ts_literal(s_hi))).select(
        *keys, bucket, F.col("zi").alias("__z"), F.col("p").alias("__p"), F.col("sigma_pi").alias("__s"))
    em = _seasonal_emit(src, keys, bucket, ["__z", "__p", "__s"], radius, bucket_seconds, lags, left_closed,
                        _utc_seconds(t_lo), _utc_seconds(t_hi))
    nb = F.col("__nb") == 1
    me = F.col("__me") == 1
    agg = (em.groupBy(*keys, "__t").agg(
        F.stddev_pop(F.when(nb, F.col("__z"))).alias("sigma_zi"),
        F.sum("__nb").alias("__matches"),
        F.max(F.when(me, F.col("__p"))).alias("p"),
        F.max(F.when(me, F.col("__s"))).alias("sigma_pi"),
        F.max("__me").alias("__has_self"))
        .where((F.col("__has_self") == 1) & (F.col("__matches") > 0)))
    return agg.select(*keys, from_epoch_seconds(F.col("__t")).alias(bucket), "p", "sigma_pi", "sigma_zi",
                      (F.col("p") + F.lit(float(weight)) * F.col("sigma_pi") * F.col("sigma_zi")).alias("threshold"))


def null_alerts(counts: DataFrame, thresholds: DataFrame, keys: Iterable[str] = DEFAULT_KEYS,
                bucket: str = "bucket_dt", score_digits: int = 9) -> DataFrame:
    """today's null rate of each bucket against yesterday's threshold.

    Both inputs are first reduced to ``max`` per (series, bucket), which absorbs
    duplicated re-runs. A NULL threshold counts as 0. ``alert = -score`` when
    the score exceeds the threshold, else NULL.
    """
    keys = list(keys)
    thr = dedupe_by_max(thresholds, [*keys, bucket], ["threshold"])
    sc = (counts.select(*keys, bucket,
                        F.round(safe_div(F.col("null_count").cast("double"), F.col("total_count")),
                                score_digits).alias("score"))
          .groupBy(*keys, bucket).agg(F.max("score").alias("score")))
    t = thr.select(*keys, F.col(bucket).alias("__tb"), "threshold")
    s = sc.withColumn("__tb", F.col(bucket) - F.expr("INTERVAL 1 DAY"))
    joined = join_on(s, t, [*keys, "__tb"])
    thr_col = F.coalesce(F.col("threshold"), F.lit(0.0))
    return joined.select(*keys, bucket, thr_col.alias("threshold"), "score",
                         F.when(thr_col < F.col("score"), -F.col("score")).alias("alert"))


def freq_memo(counts: DataFrame, as_of=None, keys: Iterable[str] = DEFAULT_KEYS, days: int = TRAILING_DAYS,
              day: str = "dt", cls: str = "class", count: str = "cnt") -> DataFrame:
    """Per class and day: own count ``xi`` and ``x`` = counts of days ``[d-days, d]``.

    With ``as_of`` (day D) the sources are days ``[D-6, D+1)`` and the targets
    ``[D-3, D+1)``, as one daily run; with ``as_of=None`` every day is a target
    (each day's result equals its own daily run, since the window is exact).
    Input must hold one row per (series, day, class), as ``freq_count`` gives.
    """
    keys = list(keys)
    src = counts
    if as_of is not None:
        d = as_date(as_of)
        src = src.where((F.col(day) >= F.date_sub(date_literal(d), -SOURCE_DAYS[0]))
                        & (F.col(day) <= date_literal(d)))
    w = Window.partitionBy(*keys, cls).orderBy(day_number(F.col(day))).rangeBetween(-days, 0)
    out = src.select(*keys, day, cls, F.col(count).cast("long").alias("xi"),
                     F.sum(F.col(count).cast("long")).over(w).alias("x"))
    if as_of is not None:
        d = as_date(as_of)
        out = out.where(F.col(day) >= F.date_sub(date_literal(d), -MEMO_DAYS[0]))
    return out


def freq_rates(memo: DataFrame, keys: Iterable[str] = DEFAULT_KEYS, day: str = "dt") -> DataFrame:
    """Day totals ``ni = sum(xi)``, ``n = sum(x)``; ``pi, p, sigma_pi, zi``.

    Totals are a map-side combined aggregate joined back on (series, day);
    AQE broadcasts the totals when their measured size is small.
    """
    keys = list(keys)
    totals = memo.groupBy(*keys, day).agg(F.sum("xi").alias("ni"), F.sum("x").alias("n"))
    out = join_on(memo, totals, [*keys, day])
    out = out.withColumn("pi", safe_div(F.col("xi").cast("double"), F.col("ni")))
    out = out.withColumn("p", safe_div(F.col("x").cast("double"), F.col("n")))
    out = out.withColumn("sigma_pi", binomial_sigma(F.col("p"), F.col("ni")))
    return out.withColumn("zi", z_score(F.col("pi"), F.col("p"), F.col("sigma_pi")))


def freq_threshold(rates: DataFrame, as_of=None, keys: Iterable[str] = DEFAULT_KEYS, weight: float = FREQ_WEIGHT,
                   days: int = TRAILING_DAYS, day: str = "dt", cls: str = "class") -> DataFrame:
    """E5: ``lower/upper = p -+ weight * sigma_pi * sigma_zi`` per class and day.

    ``sigma_zi`` is ``stddev_pop(zi)`` of the class over days ``[d-days, d]``.
    With ``as_of`` only day D is returned (inputs ``[D-3, D+1)``).
    """
    keys = list(keys)
    src = rates
    if as_of is not None:
        d = as_date(as_of)
        src = src.where((F.col(day) >= F.date_sub(date_literal(d), days))
                        & (F.col(day) <= date_literal(d)))
    w = Window.partitionBy(*keys, cls).orderBy(day_number(F.col(day))).rangeBetween(-days, 0)
    out = src.select(*keys, day, cls, "pi", "p", "sigma_pi", F.stddev_pop("zi").over(w).alias("sigma_zi"))
    if as_of is not None:
        out = out.where(F.col(day) == date_literal(as_of))
    band = F.lit(float(weight)) * F.col("sigma_pi") * F.col("sigma_zi")
    return out.select(*keys, day, cls, "pi", "p", "sigma_pi", "sigma_zi",
                      (F.col("p") - band).alias("lowerbound"), (F.col("p") + band).alias("upperbound"))


def freq_alerts(counts: DataFrame, thresholds: DataFrame, as_of=None, keys: Iterable[str] = DEFAULT_KEYS,
                count_days: int = 4, threshold_days: int = 5, day: str = "dt", cls: str = "class",
                count: str = "cnt", share_digits: int = 9) -> DataFrame:
    """Each class share ``pi`` against the previous day's limits.

    With ``as_of`` (the reference's "today") counts of days ``> as_of - count_days``
    and limits of days ``> as_of - threshold_days`` are used. Classes without
    yesterday's limits drop out (inner join). Sorted alert desc, day desc, pi desc.
    """
    keys = list(keys)
    c = dedupe_by_max(counts, [*keys, day, cls], [count])
    t = dedupe_by_max(thresholds, [*keys, day, cls], ["lowerbound", "upperbound"])
    if as_of is not None:
        d = date_literal(as_of)
        c = c.where(F.col(day) > F.date_sub(d, count_days))
        t = t.where(F.col(day) > F.date_sub(d, threshold_days))
    totals = c.groupBy(*keys, day).agg(F.sum(count).alias("ni"))
    shares = join_on(c, totals, [*keys, day]).withColumn("__td", F.date_sub(F.col(day), 1))
    t = t.withColumnRenamed(day, "__td")
    j = join_on(shares, t, [*keys, "__td", cls])
    pi = F.round(safe_div(F.col(count).cast("double"), F.col("ni")), share_digits)
    out = j.select(*keys, day, cls, F.col(count).alias("xi"), "ni", pi.alias("pi"), "lowerbound", "upperbound")
    alert = F.when((F.col("upperbound") < F.col("pi")) | (F.col("lowerbound") > F.col("pi")), 1).otherwise(0)
    return out.withColumn("alert", alert).orderBy(F.desc("alert"), F.desc(day), F.desc("pi"))
