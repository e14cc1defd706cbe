"""Exact top-k inner products with vector-approximation files.

Equal vectors are one class. Classes are cut into blocks; a block stores each
component's cell number (the approximation) apart from the exact components.
Cell borders come from a bounded sample; each block also knows its own least
and greatest components, so cells are closed on both sides for every row.

A search reads the approximations twice. The first scan bounds every score
from below and takes, per query, the (k+1)-th greatest bound as a threshold;
the second keeps what can still reach it. Exact vectors are then read in the
order of their upper bounds: a first portion fixes the k-th exact score, and
every remaining candidate whose bound reaches it is read too. What is left
unread is certain not to belong to the result.

Queries are a stated set, taken in blocks of ``QUERY_BLOCK`` vectors against
blocks of rows; equal query vectors are searched once. Of a class only the
``k + 1`` smallest ids can appear in a result, so a vector that a third of the
rows share costs one candidate.

Cases: vectors that are null or hold null or non-finite components, and rows
with a null id, take no part; vectors meet only vectors of equal length; rows
equal in id and vector are one row; a score beyond 64 bits raises; with fewer
than k other rows all are returned; empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textops import few_rows

BITS = 6
CELLS = 1 << BITS
SAMPLE = 4096            # vectors that set the cell borders
QUERY_BLOCK = 512
ROW_BLOCK = 4096
GROUPS = 64              # groups that the blocks of rows are dealt to, at most
GROUP_BLOCKS = 4         # blocks of a group, at least
EXACT_LIMIT = float(1 << 52)   # float64 sums of integers below this are exact


def integer_vectors(emb: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, ints, dim`` of the rows that take part: floor(scale * x) per component (one that
    leaves 64 bits raises)."""
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(y) < float(1 << 63), F.floor(y)).otherwise(F.raise_error(F.lit("a component leaves 64 bits")).cast("long"))

    ints = F.transform("embedding", whole)
    return emb.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"),
                                                          ints.alias("ints"), F.size("embedding").alias("dim"))


def vector_key() -> "F.Column":
    return F.sha2(F.concat_ws(",", F.transform("ints", lambda x: x.cast("string"))), 256)


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """``key, dim, ints, ids``: distinct vectors with their ``k + 1`` smallest ids."""
    by = Window.partitionBy("key").orderBy("vec_id")
    ranked = vectors.withColumn("key", vector_key()).dropDuplicates(["key", "vec_id"]) \
        .withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1)
    return ranked.groupBy("key").agg(F.first("dim").alias("dim"), F.first("ints").alias("ints"),
                                     F.sort_array(F.collect_list("vec_id")).alias("ids"))


def cell_borders(cls: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the inner cell borders of each component: quantiles of
    a sample of ``SAMPLE`` distinct vectors, smallest hash first."""
    rows = few_rows(cls.select("key", "dim", "ints"), "key", SAMPLE, cls.count()).collect()
    out = {}
    for dim in {r.dim for r in rows}:
        m = np.array([r.ints for r in rows if r.dim == dim], dtype=np.int64)
        q = np.quantile(m, np.arange(1, CELLS) / CELLS, axis=0, method="lower") if dim else np.zeros((CELLS - 1, 0))
        out[dim] = q.astype(np.int64)
    return out


# -------------------------------------------------------------------- files
BLOCKS = "block string, dim int, n int, cells binary, lo binary, hi binary"


def build(cls: DataFrame, borders: dict[int, np.ndarray]) -> tuple[DataFrame, DataFrame]:
    """The approximation table (a row per block) and the exact table (a row per
    class, with its block and place), both written to the shared folder."""
    shipped = cls.sparkSession.sparkContext.broadcast(borders)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(a, ROW_BLOCK)
                name, dims = uuid.uuid4().hex, np.asarray(part.column(1))
                slot = pd.Series(dims).groupby(dims).cumcount().to_numpy(np.int32)
                block = pa.array([f"{name}-{d}" for d in dims], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, block, pa.array(slot)],
                                                 names=[*part.schema.names, "block", "slot"])

    def approximate(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("slot")
        block, dim = g["block"].iloc[0], int(g["dim"].iloc[0])
        m = np.array(g["ints"].tolist(), dtype=np.int64).reshape(len(g), dim)
        inner = shipped.value.get(dim, np.zeros((CELLS - 1, dim), np.int64))
        cell = np.empty((len(g), dim), np.uint8)
        for j in range(dim):
            cell[:, j] = np.searchsorted(inner[:, j], m[:, j], side="right")
        least, most = m.min(axis=0), m.max(axis=0)
        lo = np.clip(np.vstack([least[None], inner]), least, most)
        hi = np.clip(np.vstack([inner - 1, most[None]]), least, most)
        return pd.DataFrame([(block, dim, len(g), cell.tobytes(), lo.tobytes(), hi.tobytes())],
                            columns=["block", "dim", "n", "cells", "lo", "hi"])

    exact = materialize(cls.select("key", "dim", "ints", "ids").mapInArrow(
        place, "key string, dim int, ints array<long>, ids array<long>, block string, slot int"), "va_exact")
    cells = exact.select("block", "dim", "ints", "slot").groupBy("block", "dim").applyInPandas(approximate, BLOCKS)
    return materialize(cells, "va_cells"), exact


def score_bounds(q: np.ndarray, cells: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of ``q`` (queries x dim) with a block."""
    dim = np.arange(cells.shape[1])
    least, most = lo[cells, dim].astype(float), hi[cells, dim].astype(float)
    pos, neg = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    upper, lower = pos @ most.T + neg @ least.T, pos @ least.T + neg @ most.T
    top = np.abs(q).max(initial=0) * max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0)) * float(len(dim))
    if top >= EXACT_LIMIT:                                    # allow for the rounding of large sums
        slack = top * len(dim) * 2.0 ** -50
        upper, lower = upper + slack, lower - slack
    return lower, upper


# ------------------------------------------------------------------- search
def _query_blocks(queries: DataFrame) -> DataFrame:
    """``dim, qb, keys, q``: distinct query vectors in blocks of about ``QUERY_BLOCK``."""
    n = queries.count()
    blocks = max(1, -(-n // QUERY_BLOCK))
    return queries.withColumn("qb", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).groupBy("dim", "qb") \
        .agg(F.sort_array(F.collect_list(F.struct("key", "ints"))).alias("q"))


def top_k(emb: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, first: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each query row.

    ``emb`` and ``queries`` have ``vec_id, embedding``; ties go to the smaller id.
    ``first`` exact vectors are read per query before the k-th score is taken.
    """
    first = first or 4 * k
    cls = materialize(classes(integer_vectors(emb, scale), k), "va_classes")
    cells, exact = build(cls, cell_borders(cls))
    q = materialize(integer_vectors(queries, scale).withColumn("key", vector_key())
                    .dropDuplicates(["key", "vec_id"]), "va_queries")
    qvec = q.groupBy("key").agg(F.first("dim").alias("dim"), F.first("ints").alias("ints"))
    qblocks = materialize(_query_blocks(qvec), "va_qblocks")

    def scan(rows: pd.DataFrame, i: int):
        r = rows.iloc[i]
        d = int(r["dim"])
        qm = np.array([x["ints"] for x in r["q"]], dtype=np.int64).reshape(len(r["q"]), d)
        keys = [x["key"] for x in r["q"]]
        cell = np.frombuffer(r["cells"], np.uint8).reshape(int(r["n"]), d)
        lo, hi = (np.frombuffer(r[c], np.int64).reshape(CELLS, d) for c in ("lo", "hi"))
        return keys, r, score_bounds(qm, cell, lo, hi)

    def thresholds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for i in range(len(rows)):
                keys, _, (lower, _) = scan(rows, i)
                m = min(k + 1, lower.shape[1])
                best = np.partition(lower, lower.shape[1] - m, axis=1)[:, -m:]
                yield pd.DataFrame({"key": np.repeat(keys, m), "low": best.reshape(-1)})

    # equal lengths are one key: blocks of rows are dealt to groups, and every query block is in each group
    groups = max(1, min(GROUPS, cells.count() // GROUP_BLOCKS))
    cells = cells.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    in_each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")
    both = cells.join(qblocks.select("*", in_each), ["dim", "grp"])
    ranked = both.mapInPandas(thresholds, "key string, low double") \
        .withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("low")))).where(F.col("r") <= k + 1)
    tau = ranked.groupBy("key").agg(F.min("low").alias("tau"), F.count("*").alias("n")) \
        .select("key", F.when(F.col("n") > k, F.col("tau")).otherwise(F.lit(float("-inf"))).alias("tau"))
    limits = qblocks.select("dim", "qb", F.explode("q").alias("x")).select("dim", "qb", "x.key", "x.ints") \
        .join(tau, "key").groupBy("dim", "qb").agg(F.sort_array(F.collect_list(F.struct("key", "ints", "tau"))).alias("q"))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for i in range(len(rows)):
                keys, r, (_, upper) = scan(rows, i)
                qi, slot = np.nonzero(upper >= np.array([x["tau"] for x in r["q"]])[:, None])
                yield pd.DataFrame({"key": np.array(keys, dtype=object)[qi], "block": r["block"],
                                    "slot": slot.astype(np.int32), "up": upper[qi, slot]})

    cand = materialize(cells.join(limits.select("*", in_each), ["dim", "grp"]).mapInPandas(
        candidates, "key string, block string, slot int, up double"), "va_candidates")
    order = F.struct((-F.col("up")).alias("less"), "block", "slot")
    ahead = cand.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(order))).where(F.col("r") <= first).drop("r")
    ahead = materialize(ahead, "va_first")

    def read(c: DataFrame) -> DataFrame:
        """Exact scores of candidates."""
        own = qvec.select(F.col("key"), F.col("ints").alias("qi"))
        got = c.join(exact.select("block", "slot", "ints", "ids"), ["block", "slot"]).join(own, "key")
        dot = F.aggregate(F.zip_with("qi", "ints", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return got.select("key", "ids", dot.alias("score"))

    near = materialize(read(ahead), "va_near")
    spread = near.select("key", "score", F.explode("ids").alias("id"))
    kth = spread.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score")))) \
        .where(F.col("r") == k + 1).select("key", F.col("score").alias("kth"))
    last = ahead.groupBy("key").agg(F.max(order).alias("last"))
    rest = cand.join(last, "key").where(order > F.col("last")).join(kth, "key", "left") \
        .where(F.col("kth").isNull() | (F.col("up") >= F.col("kth"))).select("key", "block", "slot")
    scored = near.unionByName(read(rest)).select("key", "score", F.explode("ids").alias("vec_id"))
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))) \
        .where(F.col("r") <= k + 1).drop("r")
    by = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return q.select(F.col("vec_id").alias("query_id"), "key").join(best, "key") \
        .where(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(by)) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
