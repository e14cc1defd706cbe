"""Numeric-value anomaly scores: Gaussian kernel density.

``log_density(x) = log( sum_i w_i exp(-((x - c_i)/h)^2 / 2) ) - log(sum_i w_i) - log h - log(2 pi)/2``

over the weighted centres ``c_i`` of a series (``fit_kde``: the distinct
numeric values of a training sample with their counts - the reference kept
only its first batch of 100; here every sample row counts, equally weighted).

No (value, centre) pairs are formed; a series answers for many centres at once
(the Fast Gauss Transform idea, Greengard & Strain 1991). Numbers are scaled by
the power of two below ``h``, which loses no digit.

* Near: around the middle of a bin of width 1, with ``u`` and ``v`` the distances of
  value and centre from it in bandwidths,

      exp(-(u-v)^2/2) = exp(-u^2/2) * sum_k u^k * v^k exp(-v^2/2) / k!

  Every centre is added once to the *local expansions* of all bins within reach of
  it, so the model has one complete series per bin, and a value meets one row of it.
  It is final when all other centres together stay under ``rel_tol`` of its sum.
* Far: such a value lies in a gap between centres. The nearest non-empty bin on
  either side is found by sorting values and bins together. At distance ``A`` from
  the gap's edge, a centre ``t`` behind the edge adds
  ``exp(-A^2/2) exp(-t^2/2) exp(-A t)``. The centres behind an edge are grouped once by
  the eighth of an octave that ``t`` lies in, which serves every ``A``: where
  ``A t`` is large enough to strain a group's series, its share is negligible. So a
  shifted unit costs a value two rows of the model, and the model is read once,
  whatever the distances.

Bin numbers are doubles. Beyond 2^53 widths a centre is a bin of its own. Counts
are exact to ``rel_tol`` up to 10^15 rows per series within reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import HALF_LOG_2PI
from ..functions.strings import number_column
from ..session import broadcast_if_small, materialize
from .keys import join_on

# Fixed value of the reference's density model: the kernel bandwidth.
BANDWIDTH = 1.0

NEAR = 13.0               # reach of the local expansions, in bandwidths
TERMS = 30                # series terms
STEPS = 8                 # groups of centres per octave of their distance from an edge
LEAST_TOL = 1e-12         # a smaller relative tolerance is below what doubles keep
EXACT = float(1 << 53)    # bin numbers from here on stand for one centre each


def fit_kde(train: DataFrame, keys: Iterable[str], value: str = "value") -> DataFrame:
    """kernel centres of a numeric sample: ``keys..., centre, weight``.

    Text that is no decimal number, and non-finite values, are not centres.
    Equal values are one weighted centre (a ``groupBy``).
    """
    keys = list(keys)
    return (train.select(*keys, number_column(train, value).alias("centre")).where(F.col("centre").isNotNull())
            .groupBy(*keys, "centre").agg(F.count(F.lit(1)).alias("weight")))


def _bin(z: Column) -> Column:
    """Number of the bin of width 1 that holds ``z``."""
    return F.when(F.abs(z) < EXACT, F.floor(z).cast("double")).otherwise(z)


def _middle(b: Column) -> Column:
    return F.when(F.abs(b) < EXACT, b + 0.5).otherwise(b)


def _unit(h: float) -> tuple[float, float]:
    """The power of two not above ``h``, and ``h`` in it (from 1 to 2)."""
    g = 2.0 ** math.floor(math.log2(h))
    return g, h / g


def _moments(weight: Column, v: Column) -> list[Column]:
    """Sums of ``weight v^k / k!``, named ``__M0..``."""
    return [F.sum(weight * F.pow(v, F.lit(float(k))) / F.lit(float(math.factorial(k)))).alias(f"__M{k}") for k in range(TERMS)]


def _series(u: Column, term=lambda k: F.col(f"__M{k}")) -> Column:
    """``sum_k M_k u^k`` (Horner; plain arithmetic inside generated code)."""
    poly = term(TERMS - 1)
    for k in range(TERMS - 2, -1, -1):
        poly = poly * u + term(k)
    return poly


def _on(left: list[str], right: list[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def local_expansions(model: DataFrame, keys: list[str], r: float) -> DataFrame:
    """The series of every bin that a centre of ``model`` (``keys, __c, weight``) reaches:
    ``__bin, __M0.., __near`` (rows within reach), and of the bin's own centres ``__own``
    (rows, NULL if it has none), ``__min`` and ``__max``."""
    most = math.ceil(NEAR * r)
    step, c = F.sequence(F.lit(-most), F.lit(most)), F.col("__c")
    around = F.when(F.abs(c) < EXACT, F.transform(step, lambda k: F.floor("__c").cast("double") + k)) \
        .otherwise(F.array_distinct(F.transform(step, lambda k: F.col("__c") + k)))
    rows = model.withColumn("__bin", F.explode(around)).withColumn("__v", (c - _middle(F.col("__bin"))) / F.lit(r)) \
        .withColumn("__g", F.col("weight") * F.exp(F.lit(-0.5) * F.col("__v") * F.col("__v")))
    own = F.col("__bin") == _bin(c)
    return rows.groupBy(*keys, "__bin").agg(*_moments(F.col("__g"), F.col("__v")), F.sum("weight").alias("__near"),
                                            F.sum(F.when(own, F.col("weight"))).alias("__own"),
                                            F.min(F.when(own, c)).alias("__min"), F.max(F.when(own, c)).alias("__max"))


def _near_pass(values: DataFrame, local: DataFrame, keys: list[str], r: float, log_tol: float) -> DataFrame:
    """``__s`` (the near sum) and ``__final`` of every value; a value meets at most one row."""
    local, asked = broadcast_if_small(local.drop("__min", "__max"), values.withColumn("__b", _bin(F.col("__z"))), row_bytes=8 * (TERMS + 5) + 64)
    names = [f"__key{i}" for i in range(len(keys))]
    met = asked.join(local.withColumnsRenamed(dict(zip(keys, names))), _on([*keys, "__b"], [*names, "__bin"]), "left")
    u = (F.col("__z") - _middle(F.col("__bin"))) / F.lit(r)
    met = met.withColumn("__u", u).withColumn("__s", F.exp(F.lit(-0.5) * F.col("__u") * F.col("__u")) * _series(F.col("__u")))
    near = F.coalesce("__near", F.lit(0))
    rest = (F.col("__ntot") - near).cast("double")
    few = (rest <= 0) | (F.log(rest) - 0.5 * NEAR ** 2 - F.log("__s") < log_tol)
    exact = F.log("__s") - F.log(near.cast("double")) > -32.0            # the series' own error stays below 1e-11
    final = F.col("__own").isNotNull() | ((F.col("__s") > 0) & exact & few)
    return met.select(*values.columns, "__s", F.coalesce(final, F.lit(False)).alias("__final"))


def _nearest(far: DataFrame, bins: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``__lo`` and ``__hi``: the nearest non-empty bins (number, least and
    greatest centre) not above and above each value's own bin.

    Values and bins are range partitioned together and carried inside their
    partition; what a partition lacks comes from a table of each partition's
    first and last bin per series.
    """
    parts = int(far.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bin_ = F.struct(F.col("__bin").alias("b"), F.col("__min").alias("least"), F.col("__max").alias("most"))
    rows = bins.select(*keys, F.col("__bin").alias("__b"), F.lit(0).alias("__kind"), F.lit(None).cast("long").alias("__id"),
                       bin_.alias("__at")) \
        .unionByName(far.select(*keys, _bin(F.col("__z")).alias("__b"), F.lit(1).alias("__kind"), "__id"), allowMissingColumns=True)
    rows = materialize(rows.repartitionByRange(parts, *keys, "__b").withColumn("__pid", F.spark_partition_id()), "kde_sorted")
    here = Window.partitionBy("__pid", *keys).orderBy("__b", "__kind")
    carried = rows.withColumn("__lo", F.last("__at", True).over(here.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("__hi", F.first("__at", True).over(here.rowsBetween(1, Window.unboundedFollowing))) \
        .where("__kind = 1")
    along = Window.partitionBy(*keys).orderBy("__pid")
    edges = rows.where("__kind = 0").groupBy("__pid", *keys).agg(F.min_by("__at", "__b").alias("f"), F.max_by("__at", "__b").alias("l"))
    # a partition that holds values but no bin of a series needs an edge row too
    edges = edges.unionByName(join_on(carried.select("__pid", *keys).distinct(), edges.select("__pid", *keys), ["__pid", *keys],
                                      "left_anti"), allowMissingColumns=True)
    edges = edges.select(F.col("__pid").alias("__p"), *[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)],
                         F.last("l", True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
                         F.first("f", True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("__after"))
    found = carried.join(edges, _on(["__pid", *keys], ["__p", *(f"__key{i}" for i in range(len(keys)))])).select(
        "__id", F.coalesce("__lo", "__before").alias("__lo"), F.coalesce("__hi", "__after").alias("__hi"))
    return far.join(found, "__id")


def _edges(asked: DataFrame, model: DataFrame, keys: list[str], r: float, widest: int) -> DataFrame:
    """``__e`` (centre at a gap's edge), ``__side`` and ``__groups``: the centres behind it as
    an array of (middle, half width, moments) by distance. ``asked`` has the edges with
    the ``__band`` that their values need; ``widest`` bounds it."""
    names = [f"__key{i}" for i in range(len(keys))]
    edges = asked.groupBy(*keys, "__side", "__e").agg(F.max("__band").alias("__band"))
    step = F.sequence(F.lit(0), F.lit(widest + 1))
    behind = F.when(F.abs("__e") < EXACT, F.transform(step, lambda k: F.floor("__e").cast("double") + F.col("__side") * k)) \
        .otherwise(F.array_distinct(F.transform(step, lambda k: F.col("__e") + F.col("__side") * k)))
    wanted = edges.withColumn("__b", F.explode(behind)).withColumnsRenamed(dict(zip(keys, names)))
    centres = model.withColumn("__bin", _bin(F.col("__c")))
    wanted, centres = broadcast_if_small(materialize(wanted, "kde_edges"), centres, row_bytes=96)
    met = centres.join(wanted, _on([*keys, "__bin"], [*names, "__b"])) \
        .withColumn("__t", (F.col("__c") - F.col("__e")) * F.col("__side")).where((F.col("__t") >= 0) & (F.col("__t") <= F.col("__band")))
    octave = F.when(F.col("__t") > 0, F.floor(F.log2("__t")).cast("int"))
    met = met.withColumn("__o", octave).withColumn("__w", F.pow(F.lit(2.0), F.col("__o")) / STEPS) \
        .withColumn("__q", F.floor(F.col("__t") / F.col("__w")).cast("int"))      # the octave is STEPS groups of width w wide
    mid = F.coalesce(F.col("__w") * (F.col("__q") + 0.5), F.lit(0.0))
    y = F.coalesce((F.col("__t") - mid) / (F.col("__w") / 2), F.lit(0.0))
    met = met.withColumn("__mid", mid).withColumn("__y", y) \
        .withColumn("__g", F.col("weight") * F.exp(F.lit(-0.5) * F.col("__t") * F.col("__t") / F.lit(r * r)))
    table = met.groupBy(*names, "__side", "__e", "__o", "__q").agg(
        F.first("__mid").alias("__mid"), F.coalesce(F.first("__w") / 2, F.lit(0.0)).alias("__half"), *_moments(F.col("__g"), F.col("__y")))
    # at most STEPS groups per octave of a double that lies within the band
    return table.groupBy(*names, "__side", "__e").agg(F.collect_list(F.struct("__mid", "__half", *[f"__M{k}" for k in range(TERMS)])).alias("__groups"))


def _far_pass(far: DataFrame, local: DataFrame, model: DataFrame, keys: list[str], r: float, log_tol: float) -> DataFrame:
    """``__id, __log`` (log of the full sum) of values that lie in gaps between centres."""
    z = F.col("__z")
    near = _nearest(far, local.where(F.col("__own").isNotNull()), keys) \
        .withColumn("__below", F.col("__lo.most")).withColumn("__above", F.col("__hi.least"))
    d = F.least(z - F.col("__below"), F.col("__above") - z)
    room = (F.log(F.col("__ntot").cast("double")) - log_tol) * (r * r)
    # sqrt(d^2 + 2 room), in the form that stays finite for any d
    reach = F.when(F.col("__d") < 1e6, F.sqrt(F.col("__d") * F.col("__d") + 2 * room)).otherwise(F.col("__d") + room / F.col("__d"))
    near = near.withColumn("__d", d).withColumn("__reach", reach)
    sides = [(side, near.withColumn("__away", away).withColumn("__e", F.col(e)).where((F.col("__away") <= F.col("__reach")) | (F.col("__away") == F.col("__d")))
              .withColumn("__side", F.lit(side)).withColumn("__band", F.greatest(F.col("__reach") - F.col("__away"), F.lit(0.0))))
             for side, e, away in ((-1, "__below", z - F.col("__below")), (1, "__above", F.col("__above") - z))]
    near = materialize(sides[0][1].unionByName(sides[1][1]).select("__id", *keys, "__side", "__e", "__away", "__band"), "kde_asked")
    most = near.agg(F.max("__band")).first()[0] or 0.0
    edges = _edges(near, model, keys, r, math.ceil(most))
    names = [f"__key{i}" for i in range(len(keys))]
    edges, near = broadcast_if_small(materialize(edges.withColumnsRenamed({"__side": "__s", "__e": "__at"}), "kde_groups"), near,
                                     row_bytes=8 * (TERMS + 2) * STEPS * 8)
    met = near.join(edges, _on([*keys, "__side", "__e"], [*names, "__s", "__at"]))
    away = F.col("__away")

    def share(g: Column) -> Column:
        """What a group adds, beside ``exp(-A^2/2)``; beyond the cut it is nothing beside the edge itself."""
        x = away * g["__mid"] / F.lit(r * r)
        return F.when(x < 200.0, F.exp(-x) * _series(-away * g["__half"] / F.lit(r * r), lambda k: g[f"__M{k}"])).otherwise(F.lit(0.0))

    total = F.aggregate("__groups", F.lit(0.0), lambda acc, g: acc + share(g))
    logs = met.select("__id", (F.lit(-0.5) * (away / F.lit(r)) * (away / F.lit(r)) + F.log(total)).alias("__e"))
    both = logs.groupBy("__id").agg(F.max("__e").alias("__x"), F.min("__e").alias("__y"), F.count("*").alias("__n"))
    # log(exp(x) + exp(y)) of the two sides
    pair = F.col("__x") + F.log1p(F.exp(F.col("__y") - F.col("__x")))
    return both.select("__id", F.when((F.col("__n") == 1) | (F.col("__x") == float("-inf")), F.col("__x")).otherwise(pair).alias("__log"))


def score_kde(model: DataFrame, values: DataFrame, keys: Iterable[str], value: str = "value",
              bandwidth: float = BANDWIDTH, rel_tol: float = 1e-9) -> DataFrame:
    """``log_density`` and ``score = -log_density`` of each distinct value.

    Values whose series has no model are not scored (inner semantics); values
    that are not finite numbers get NULL scores. The result equals the full
    sum over all centres to a relative ``rel_tol``; a value too far away for
    a double (beyond about 1e154 bandwidths) has density 0, ``score`` infinity.
    """
    keys = list(keys)
    h, log_tol = float(bandwidth), math.log(max(rel_tol, LEAST_TOL))
    g, r = _unit(h)
    model = materialize(model.select(*keys, (F.col("centre") / F.lit(g)).alias("__c"), "weight"), "kde_model")
    local = materialize(local_expansions(model, keys, r), "kde_bins")
    names = [f"__key{i}" for i in range(len(keys))]
    totals = local.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.sum("__own").alias("__ntot"))
    vals = values.where(F.col(value).isNotNull()).select(*keys, value).distinct().join(totals, _on(keys, names)).drop(*names) \
        .withColumn("__z", number_column(values, value) / F.lit(g))
    near = _near_pass(vals, local, keys, r, log_tol).withColumn("__id", F.monotonically_increasing_id())
    near = materialize(near, "kde_near")
    far = near.where(F.col("__z").isNotNull() & ~F.col("__final"))
    log = F.when(F.col("__final"), F.log("__s"))
    if not far.isEmpty():
        found = _far_pass(far.select("__id", "__z", "__ntot", *keys), local, model, keys, r, log_tol)
        near, log = near.join(found, "__id", "left"), F.coalesce(log, F.col("__log"))
    dens = log - F.log(F.col("__ntot").cast("double")) - F.lit(math.log(h) + HALF_LOG_2PI)
    out = near.select(*keys, value, dens.alias("log_density"))
    return out.withColumn("score", -F.col("log_density"))


def latest_models(models: DataFrame, keys: Iterable[str], version: str = "version") -> DataFrame:
    """The rows of the newest ``version`` of each series' model."""
    keys = list(keys)
    if version not in models.columns:
        return models
    newest = models.groupBy(*keys).agg(F.max(version).alias(version))
    return join_on(models, newest.withColumn("__newest", F.lit(True)), [*keys, version]).drop("__newest")


def score_day(models: DataFrame, values: DataFrame, keys: Iterable[str], value: str = "value",
              day: str = "dt", model_day: str = "model_dt", lag_days: int = 1,
              bandwidth: float = BANDWIDTH, version: str = "version") -> DataFrame:
    """score each day's distinct values with the newest model of ``day - lag_days``.

    ``models`` is a ``fit_kde`` table with a ``model_day`` column (and an
    optional ``version``); every day of ``values`` is scored in the same job.
    """
    keys = list(keys)
    m = latest_models(models, [*keys, model_day], version)
    if version in m.columns:
        m = m.drop(version)
    # one model day per scored day, so (series, model_day) identifies the day
    v = values.select(*keys, F.date_sub(F.col(day), lag_days).alias(model_day), value)
    scored = score_kde(m, v, [*keys, model_day], value, bandwidth)
    return scored.select(*keys, F.date_add(F.col(model_day), lag_days).alias(day), value, "log_density", "score")
