"""Two-dimensional latent code of string values and its reconstruction error.

Fidelity note: the reference encodes the one-hot ``16 x 128`` string image
into a 2-d latent code with a convolutional network and scores the decoded
reconstruction. Here the code is linear: the top ``k`` principal components
of the one-hot cells of the training strings (PCA, population covariance).
The score is the squared reconstruction error of the centred one-hot vector,
``||x-mu||^2 - sum_k ((x-mu).v_k)^2``; ``z`` is the latent code.

Fitting is a subspace iteration on the sparse cells; no covariance matrix is
formed, so whole values of any length can be read. ``k + SPARE`` vectors of a series
lie in a table with a row per seen cell. A round multiplies them by the covariance:
every distinct string adds up its cells' entries, and every cell its strings' sums
(two joins and two aggregates, combined map-side); between two bases the products
are the steps of a Chebyshev polynomial. Small matrices of products of the vectors,
also aggregates over the cells, give the eigenvectors within their span, and
rounds end when ``C v = lambda v`` holds to ``TOL`` for the first ``k``. Python sees only
those matrices, ``3 (k + SPARE)^2`` numbers a series. Scoring joins the values' cells to
the model's, one aggregate per value.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import ENC_SIZE, position_codes
from ..session import BROADCAST_MAX_BYTES, broadcast_if_small, materialize
from .keys import join_on

SPARE = 6                        # vectors beside the k wanted ones, which speed the rounds up
STEPS = 4                        # products with the covariance between two bases
TOL = 1e-12                      # residual of the k components, relative to the largest eigenvalue
ROUGH = 1e-7                     # residuals above it can be read from the small matrices
ROUNDS = 100                     # bases at most; beyond it the eigenvalues are too alike to be told apart


def _cells(value, seq_len: int | None, size: int, overflow: str, unit: str):
    codes = position_codes(F.col(value), seq_len, size, overflow, unit)
    return F.filter(F.transform(codes, lambda c, i: F.when(c >= 0, i * size + c)), lambda c: c.isNotNull())


def _product(strings: DataFrame, vectors: DataFrame, keys: list[str], b: int, hint: str, step: str = "plain") -> DataFrame:
    """``vectors`` (``keys, cell, mu, __tot, __low, v0.., p0..``) times the covariance: new ``v0..``, and the
    old ones as ``p0..``. ``first`` and ``next`` are the steps of a Chebyshev polynomial, which damps
    eigenvalues from 0 to ``__low`` and raises those above it."""
    cell = strings.select("__sid", *keys, F.explode("__cells").alias("cell"))
    v = [f"v{j}" for j in range(b)]
    of_string = join_on(cell, vectors.select(*keys, "cell", *v).hint(hint), [*keys, "cell"]).groupBy("__sid") \
        .agg(*[F.expr(f"sum(v{j}) as y{j}") for j in range(b)])
    back = strings.join(of_string, "__sid").select("*", F.explode("__cells").alias("cell"))
    of_cell = back.groupBy(*keys, "cell").agg(*[F.expr(f"sum(y{j} * __n) as z{j}") for j in range(b)])
    means = vectors.groupBy(*keys).agg(*[F.expr(f"sum(mu * v{j}) as m{j}") for j in range(b)])
    met = join_on(join_on(vectors, of_cell, [*keys, "cell"]), means, keys)
    new = {"plain": "(z{j} / __tot - mu * m{j})", "first": "(2 / __low * (z{j} / __tot - mu * m{j}) - v{j})",
           "next": "(2 * (2 / __low * (z{j} / __tot - mu * m{j}) - v{j}) - p{j})"}[step]
    return met.select(*keys, "cell", "mu", "__tot", "__low", *[F.expr(new.format(j=j) + f" as v{j}") for j in range(b)],
                      *[F.expr(f"v{j} as p{j}") for j in range(b)])


def _grams(rows: DataFrame, keys: list[str], v: list[str], w: list[str]) -> DataFrame:
    """Per series the products of columns ``v`` and ``w`` with each other: v v, v w and w w, in one array."""
    pairs = [(a, c) for x, y in ((v, v), (v, w), (w, w)) for a in x for c in y]
    once = {tuple(sorted(p)): f"g{i}" for i, p in enumerate(pairs)}
    sums = rows.groupBy(*keys).agg(*[F.expr(f"sum({a} * {c}) as {name}") for (a, c), name in once.items()])
    return sums.select(*keys, F.array(*[once[tuple(sorted(p))] for p in pairs]).alias("__g"))


def _solver(b: int, k: int):
    """A SQL function on those products, with ``w = C v``: the coefficients of the best eigenvectors
    in the span of ``v`` (b x b, by falling eigenvalue), the eigenvalues, and the largest residual
    of the first ``k`` relative to the first eigenvalue."""
    @F.pandas_udf("array<double>")
    def solve(grams: pd.Series) -> pd.Series:
        out = []
        for m in grams:
            vv, vw, ww = np.array(m, float).reshape(3, b, b)
            scale = 1 / np.sqrt(np.where(np.diag(vv) > 0, np.diag(vv), np.inf))
            lam, q = np.linalg.eigh(vv * scale * scale[:, None])
            keep = lam > 1e-13 * max(lam.max(), 1e-300)
            base = scale[:, None] * q * np.where(keep, 1 / np.sqrt(np.where(keep, lam, 1)), 0)      # v base is orthonormal
            lam, q = np.linalg.eigh(base.T @ (vw + vw.T) @ base / 2)
            lam, turn = lam[::-1], base @ q[:, ::-1]
            off = np.sqrt(np.abs(np.einsum("ij,ik,kj->j", turn, ww, turn) - lam ** 2))[:k].max() / max(lam[0], 1e-300)
            out.append(np.concatenate([turn.reshape(-1), lam, [off if lam[0] > 1e-15 else 0.0]]))
        return pd.Series(out)

    return solve


def _turned(v: str, b: int, j: int) -> str:
    """Column ``j`` of ``v0..`` times the matrix ``__t``, as SQL."""
    return "(" + " + ".join(f"{v}{i} * __t[{i * b + j}]" for i in range(b)) + ")"


def fit_latent(train: DataFrame, keys: Iterable[str], value: str = "value", k: int = 2, seq_len: int | None = None,
               size: int = ENC_SIZE, overflow: str = "mod", unit: str = "byte") -> DataFrame:
    """Per series and seen cell: ``mu`` (share of strings hot there) and ``comp``
    (the cell's entries in the top ``k`` components, the largest of each positive).

    Whole values are read; ``seq_len=16`` gives the reference's encoding. A series whose
    strings are all empty has one row, with no cell.
    """
    keys, b = list(keys), k + SPARE
    v, p = [f"v{j}" for j in range(b)], [f"p{j}" for j in range(b)]
    # equal strings are one weighted row
    strings = train.where(F.col(value).isNotNull()).select(*keys, _cells(value, seq_len, size, overflow, unit).alias("__cells")) \
        .groupBy(*keys, "__cells").agg(F.count(F.lit(1)).alias("__n"))
    strings = materialize(strings.withColumn("__sid", F.monotonically_increasing_id()), "latent_strings")
    totals = strings.groupBy(*keys).agg(F.sum("__n").alias("__tot"))
    seen = strings.select(*keys, "__n", F.explode("__cells").alias("cell")).groupBy(*keys, "cell").agg(F.sum("__n").alias("__c"))
    start = [(F.pmod(F.xxhash64("cell", F.lit(j)), F.lit(1 << 20)) / float(1 << 19) - 1).alias(c) for j, c in enumerate(v)]
    vectors = join_on(seen, totals, keys).select(*keys, "cell", (F.col("__c") / F.col("__tot")).alias("mu"), "__tot",
                                                 F.lit(1.0).alias("__low"), *start)
    vectors, solve, lam = materialize(vectors, "latent_start"), _solver(b, k), b * b
    # a row per seen cell in every round; series are fewer
    hint = "broadcast" if vectors.count() * (8 * b + 64) <= BROADCAST_MAX_BYTES else "merge"
    for turn_no in range(ROUNDS):
        image = vectors
        for step in ["first", *["next"] * (STEPS - 2)] * (turn_no > 0) + ["plain"]:
            image = materialize(_product(strings, image, keys, b, hint, step), "latent_image")
        turn = materialize(_grams(image, keys, p, v).withColumn("__t", solve("__g")).drop("__g"), "latent_turn")
        met = join_on(image, turn, keys)
        found = met.select(*keys, "cell", "mu", F.expr(f"__t[{lam}] as __top"), *[F.expr(f"{_turned('p', b, j)} as u{j}") for j in range(k)],
                           *[F.expr(f"{_turned('v', b, j)} - __t[{lam + j}] * {_turned('p', b, j)} as r{j}") for j in range(k)])
        worst = turn.agg(F.expr(f"max(__t[{lam + b}])")).first()[0]
        if worst is None:
            break
        if worst < ROUGH:                      # the matrices cannot tell less: look at the vectors
            off = found.groupBy(*keys).agg(F.max("__top").alias("__top"), *[F.expr(f"sqrt(sum(r{j} * r{j})) as r{j}") for j in range(k)])
            worst = off.agg(F.max(F.greatest(*[f"r{j}" for j in range(k)], F.lit(0.0)) / F.greatest("__top", F.lit(1e-300)))).first()[0]
            if worst < TOL:
                break
        low = F.expr(f"greatest(__t[{lam + b - 1}], 1e-6 * __t[{lam}], 1e-300) as __low")
        vectors = materialize(met.select(*keys, "cell", "mu", "__tot", low, *[
            F.expr(f"if(__t[{lam + j}] > 1e-12 * __t[{lam}], {_turned('v', b, j)} / __t[{lam + j}], 0) as v{j}") for j in range(b)]), "latent_basis")
    found = materialize(found, "latent_found")
    # the sign: the entry of largest size (the first such cell) is positive
    best = found.groupBy(*keys).agg(*[F.max_by(f"u{j}", F.struct(F.round(F.abs(f"u{j}"), 9), -F.col("cell"))).alias(f"s{j}") for j in range(k)])
    comp = F.array(*[F.col(f"u{j}") * F.signum(f"s{j}") for j in range(k)])
    model = join_on(found, best, keys).select(*keys, F.col("cell").cast("int").alias("cell"), "mu", comp.alias("comp"))
    return join_on(totals.drop("__tot"), model, keys, "left")


def latent_scores(model: DataFrame, values: DataFrame, keys: Iterable[str], value: str = "value", k: int = 2,
                  seq_len: int | None = None, size: int = ENC_SIZE, overflow: str = "mod",
                  unit: str = "byte") -> DataFrame:
    """``keys..., value, z (array of k), score`` for each distinct value. A byte where training
    had none adds 1 to the score and nothing to ``z``."""
    keys = list(keys)
    model = materialize(model, "latent_models")
    names = [f"c{j}" for j in range(k)]
    cells = model.where(F.col("cell").isNotNull()).select(*keys, "cell", "mu", *[F.element_at("comp", j + 1).alias(c) for j, c in enumerate(names)])
    per = model.groupBy(*keys).agg(F.coalesce(F.sum(F.col("mu") * F.col("mu")), F.lit(0.0)).alias("__mu2"),
                                   *[F.coalesce(F.sum(F.col("mu") * F.element_at("comp", j + 1)), F.lit(0.0)).alias(f"__m{j}") for j in range(k)])
    vals = values.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    asked = vals.select(*keys, value, F.explode_outer(_cells(value, seq_len, size, overflow, unit)).alias("cell"))
    small, big = broadcast_if_small(cells, asked, 64 + 8 * k)
    sums = join_on(big, small, [*keys, "cell"], "left").groupBy(*keys, value).agg(
        F.count("cell").alias("__len"), F.coalesce(F.sum("mu"), F.lit(0.0)).alias("__mu"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names])
    per, sums = broadcast_if_small(per, sums, 64 + 8 * k)
    met = join_on(sums, per, keys)
    z = [F.col(c) - F.col(f"__m{j}") for j, c in enumerate(names)]
    err = F.col("__len").cast("double") - 2 * F.col("__mu") + F.col("__mu2")
    for zz in z:
        err = err - zz * zz
    return met.select(*keys, value, F.array(*z).alias("z"), err.alias("score"))
