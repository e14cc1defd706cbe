"""String-value anomaly scores.

Fidelity note: the reference trains a convolutional variational autoencoder
on one-hot ``16 x 128`` string images and scores a value by its negative
Bernoulli log-likelihood (``distortion``). The network is not reproduced.
These operators keep the same score *definition* - the negative Bernoulli
log-likelihood of the same one-hot cells - with the latent code removed: the
per-cell probability is the smoothed share of training strings with that code
at that position. Scores are comparable in ranking use, not in value.

Model tables are ordinary DataFrames keyed by the series columns, so models
for many series are fitted, stored and applied in one job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import ENC_SIZE, SEQ_LEN, position_codes
from ..session import broadcast_if_small, materialize
from .density import latest_models
from .keys import join_on


def encode_positions(df: DataFrame, value: str = "value", seq_len: int = SEQ_LEN, size: int = ENC_SIZE,
                     overflow: str = "mod", unit: str = "byte", out: str = "codes", pad_md5: bool = False) -> DataFrame:
    """adds ``codes``: one code per position of the first ``seq_len`` units."""
    return df.withColumn(out, position_codes(F.col(value), seq_len, size, overflow, unit, pad_md5))


def fit_string_profile(train: DataFrame, keys: Iterable[str], value: str = "value", seq_len: int | None = None,
                       size: int = ENC_SIZE, overflow: str = "mod", unit: str = "byte",
                       alpha: float = 1.0, pad_md5: bool = False) -> DataFrame:
    """per series, position and code: ``cnt`` strings with that code there,
    ``n_train`` training strings, ``prob = (cnt + alpha) / (n_train + 2 alpha)``.
    A series whose strings are all empty has one row, with no position.

    Whole values are read; ``seq_len=16`` gives the reference's encoding, which
    sees only that many bytes. At most (positions x size) rows per series. NULL values are not training
    strings (the reference turned them into the text 'None').
    """
    keys = list(keys)
    base = train.where(F.col(value).isNotNull()).select(*keys, position_codes(F.col(value), seq_len, size,
                                                                              overflow, unit, pad_md5).alias("__codes"))
    n_train = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_train"))
    cells = (base.select(*keys, F.posexplode("__codes").alias("pos", "code"))
             .where(F.col("code") >= 0)
             .groupBy(*keys, "pos", "code").agg(F.count(F.lit(1)).alias("cnt")))
    a = float(alpha)
    # a series of empty texts has no cell: one row without a position keeps its n_train
    return (join_on(n_train, cells, keys, "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))
            .select(*keys, "pos", "code", "cnt", "n_train")
            .withColumn("prob", (F.col("cnt") + F.lit(a)) / (F.col("n_train") + F.lit(2 * a))))


def _series_models(profile: DataFrame, keys: list[str], seq_len: int | None, size: int, alpha: float) -> DataFrame:
    """One row per series: the log-odds of its seen cells as a map (positions x
    ``size`` entries at most) and the constant ``sum over all cells of log(1-p)``.
    Without ``seq_len`` the positions are those of the training values."""
    a = float(alpha)
    p0 = F.lit(a) / (F.col("n_train") + F.lit(2 * a))
    cell = F.col("pos") * F.lit(size) + F.col("code")
    logodds = F.log(F.col("prob")) - F.log1p(-F.col("prob"))
    has = F.col("pos").isNotNull()
    per = profile.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.when(has, F.struct(cell.cast("int"), logodds)))).alias("__odds"),
        F.coalesce(F.sum(F.when(has, F.log1p(-F.col("prob")))), F.lit(0.0)).alias("__seen_log1m"),
        F.count("pos").alias("__seen"),
        F.coalesce(F.max("pos") + 1, F.lit(0)).alias("__len"),
        F.max("n_train").alias("n_train"))
    return per.select(
        *keys, "__odds", "__seen",
        (F.col("__seen_log1m") + ((F.col("__len") if seq_len is None else F.lit(seq_len)) * F.lit(size) - F.col("__seen"))
         * F.log1p(-p0)).alias("__const"),
        (F.log(p0) - F.log1p(-p0)).alias("__odds0"))


def score_strings(profile: DataFrame, values: DataFrame, keys: Iterable[str], value: str = "value",
                  seq_len: int | None = None, size: int = ENC_SIZE, overflow: str = "mod", unit: str = "byte",
                  alpha: float = 1.0, pad_md5: bool = False) -> DataFrame:
    """``score = -log L`` of each distinct value under its series' profile.

    ``log L = sum over all cells of y log p + (1-y) log(1-p)``,
    computed as the series constant ``sum log(1-p)`` plus the log-odds of the
    value's hot cells (unseen cells use the smoothing probability). The values
    are joined to one small model row per series and scored by a higher-order
    column expression, so there is no explode and no per-cell join.
    The whole value is scored: the cells are those of the training positions,
    and every byte beyond them costs the log-odds of an unseen cell. Pass
    ``seq_len=16`` (as in ``fit_string_profile``) for the reference's encoding.
    Returns ``keys..., value, log_likelihood, score``.
    """
    keys = list(keys)
    models = _series_models(profile, keys, seq_len, size, alpha)
    vals = values.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    codes = position_codes(F.col(value), seq_len, size, overflow, unit, pad_md5)
    cells = F.filter(F.transform(codes, lambda c, i: F.when(c >= 0, i * size + c)), lambda c: c.isNotNull())
    hot = F.aggregate(cells, F.lit(0.0),
                      lambda acc, c: acc + F.coalesce(F.try_element_at(F.col("__odds"), c), F.col("__odds0")))
    # one model row per series: broadcast when their counted map entries fit,
    # else a sort-merge join (AQE splits a hot series)
    models = materialize(models, "string_models")
    most = models.agg(F.max("__seen")).first()[0] or 0
    models, vals = broadcast_if_small(models, vals, row_bytes=64 + 24 * most)
    scored = join_on(vals, models, keys).select(
        *keys, value, (F.col("__const") + hot).alias("log_likelihood"))
    return scored.withColumn("score", F.lit(0.0) - F.col("log_likelihood"))     # 0 stays 0, not -0


def score_day_strings(models: DataFrame, values: DataFrame, keys: Iterable[str], value: str = "value", day: str = "dt",
                      model_day: str = "model_dt", lag_days: int = 1, version: str = "version", **encoding) -> DataFrame:
    """F7 for string models: each day's distinct values under the newest profile
    of ``day - lag_days`` (``models``: profiles keyed by series and ``model_day``,
    with an optional ``version``)."""
    keys = list(keys)
    m = latest_models(models, [*keys, model_day], version)
    m = m.drop(version) if version in m.columns else m
    v = values.select(*keys, F.date_sub(F.col(day), lag_days).alias(model_day), value)
    scored = score_strings(m, v, [*keys, model_day], value, **encoding)
    return scored.select(*keys, F.date_add(F.col(model_day), lag_days).alias(day), value, "log_likelihood", "score")


def rank_anomalies(scores: DataFrame, k: int, keys: Iterable[str] = (), score: str = "score",
                   value: str = "value", out: str = "rank") -> DataFrame:
    """F8: the ``k`` highest scores (ties by value), globally or per series.

    Per series it is ``row_number() <= k``, which Spark runs with a map-side
    group limit; globally it is an ordered limit (top-k is the feature).
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(value)) if keys else \
        Window.orderBy(F.desc(score), F.asc(value))
    if not keys:
        top = scores.orderBy(F.desc(score), F.asc(value)).limit(k)
        return top.withColumn(out, F.row_number().over(w))
    return scores.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def profile_mode(profile: DataFrame, keys: Iterable[str]) -> DataFrame:
    """the most likely code at each position, joined into one string per series.

    Ties go to the smaller code; code 0 is skipped (as in the reference's
    argmax decode). Each series collects at most ``seq_len`` entries.
    """
    keys = list(keys)
    best = profile.groupBy(*keys, "pos").agg(
        F.max_by(F.col("code"), F.struct(F.col("prob"), -F.col("code"))).alias("code"))
    return (best.where(F.col("code") != 0)
            .groupBy(*keys)
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))),
                                          lambda e: F.chr(e["code"])), "").alias("mode")))
