"""Sampling, distinct values, copies and pages.

Samples are reproducible: rows are ordered by a hash of the seed and the row's
key (``rand(seed)`` when no key is given) and the first ``n`` kept. A plain
``orderBy().limit(n)`` would make every map task send its own top ``n`` to one
final task. Instead the n-th smallest hash is found by radix selection: one pass
counts rows per series and leading digits (combined map-side), the running sum
over that small table gives the digits at which a series reaches ``n``, and the
rows up to them are written. Rounds over these refine the one prefix that the cut
falls into by its next digits, until it holds at most ``PIECE_ROWS`` rows; the rows
up to it are then ranked. The result is the exact top ``n``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import hash_order_key
from ..session import broadcast_if_small, materialize

# Fixed value of the reference's extract: the default sample size.
SAMPLE_SIZE = 100000

DIGITS = 3                       # hex digits of the order hash that a round of the selection tells apart
PIECE_ROWS = 10_000              # rows of the cut's prefix that need no further round
DRAW_BITS = 52                   # of a random order


def seed_number(seed: str) -> int:
    """31-bit number from the whole seed text (its digest)."""
    return int.from_bytes(hashlib.sha256(str(seed).encode()).digest()[:4], "big") & 0x7FFFFFFF


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def _ordered(df: DataFrame, keep: list[str], key: Sequence[str] | None, seed: str) -> DataFrame:
    """``keep`` plus the order column ``__h``, hex digits of one length."""
    if key:
        return df.select(*keep, hash_order_key(seed, *key).alias("__h"))
    # rand() is fixed per input split, but a shuffled input may present its rows
    # in another order when it is read again: the draw is written once
    draw = F.floor(F.rand(seed_number(seed)) * F.lit(float(1 << DRAW_BITS))).cast("long")
    return materialize(df.select(*keep, F.lpad(F.hex(draw), DRAW_BITS // 4, "0").alias("__h")), "sample_draw")


def _within(rows: DataFrame, cuts: DataFrame, keys: list[str], inside: bool) -> DataFrame:
    """The rows up to their series' ``__cut`` prefix (or only those inside it), with ``__before``."""
    def test(cut: Column) -> Column:
        prefix = F.substring(F.col("__h"), F.lit(1), F.length(cut))
        return prefix == cut if inside else prefix <= cut

    if not keys:                               # one cut
        one = cuts.select("__cut", "__before").first()
        return rows.where(test(F.lit(one["__cut"]))).withColumn("__before", F.lit(one["__before"])) if one \
            else rows.withColumn("__before", F.lit(0).cast("long")).limit(0)
    names = [f"__k{i}" for i in range(len(keys))]
    small, big = broadcast_if_small(cuts.select(*names, "__cut", "__before"), rows, 64 + 32 * len(keys))
    on = test(F.col("__cut"))
    for k, n in zip(keys, names):
        on = on & _same(k, n)
    return big.join(small, on).drop(*names, "__cut")


def smallest(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The rows of ``n`` smallest ``__h`` of every series, and at most ``PIECE_ROWS`` more (rows
    that share one hash are not parted): ``rows`` as they are, or a written part of them."""
    names = [f"__k{i}" for i in range(len(keys))]
    alias = [F.col(k).alias(a) for k, a in zip(keys, names)]
    cuts, depth = None, 0
    while True:
        digits = F.substring("__h", 1, DIGITS * (depth + 1))
        if cuts is None:
            inside = rows.withColumn("__before", F.lit(0).cast("long"))
        else:
            inside = _within(rows, cuts.where("__open"), keys, True)
        counts = inside.groupBy(*keys, digits.alias("__cut")).agg(F.count(F.lit(1)).alias("__c"), F.max("__before").alias("__before"))
        upto = F.sum("__c").over(Window.partitionBy(*keys).orderBy("__cut").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = counts.withColumn("__upto", F.col("__before") + upto).where(F.col("__upto") - F.col("__c") < n)
        last = found.groupBy(*keys).agg(F.max_by(F.struct("__cut", "__c", (F.col("__upto") - F.col("__c")).alias("__before"),
                                                          (F.col("__upto") >= n).alias("__full")), "__cut").alias("x"))
        # a series with fewer than n rows takes them all; a cut of few rows is fine enough
        open_ = F.col("x.__full") & (F.col("x.__c") > PIECE_ROWS)
        fresh = last.select(*alias, F.col("x.__cut").alias("__cut"), F.col("x.__before").alias("__before"), open_.alias("__open"))
        if cuts is not None:
            fresh = fresh.unionByName(cuts.where("not __open"))
        cuts, depth = materialize(fresh, "sample_cuts"), depth + 1
        more = not cuts.where("__open").isEmpty() and DIGITS * depth < 32
        if depth == 1 and more:                # later rounds read only what the first one leaves
            rows = materialize(_within(rows, cuts, keys, False).drop("__before"), "sample_part")
        if not more:
            return _within(rows, cuts, keys, False).drop("__before")


def sample_rows(df: DataFrame, column: str, n: int, key: Sequence[str] | None = None, seed: str = "qualmark",
                with_md5: bool = False) -> DataFrame:
    """``n`` non-null rows of ``column`` in a uniform random order.

    With ``key`` (the columns that identify a row, NULLs included) the order is
    a hash of seed and key: the same rows on every run and engine. Without it
    the order is ``rand(seed)`` over the rows (duplicates of a value are sampled
    independently, as with the reference's ``ORDER BY rand()``). Returns
    ``min(n, rows)`` rows. ``with_md5`` adds ``md5(column)``.
    """
    base = _ordered(df.where(F.col(column).isNotNull()), [column], key, seed)
    out = smallest(base, [], n).orderBy("__h", column).limit(n)
    cols = [F.col(column)] + ([F.md5(F.col(column).cast("string")).alias("md5")] if with_md5 else [])
    return out.select(*cols)


def sample_per_series(df: DataFrame, keys: Sequence[str], column: str, n: int, key: Sequence[str] | None = None,
                      seed: str = "qualmark") -> DataFrame:
    """Up to ``n`` non-null rows of ``column`` per series, in the order of ``sample_rows``.

    A series whose key is NULL is a series like any other. The final window
    ranks at most ``n`` rows of a series and ``PIECE_ROWS`` more.
    """
    keys = list(keys)
    base = _ordered(df.where(F.col(column).isNotNull()), [*keys, column], key, seed)
    w = Window.partitionBy(*keys).orderBy("__h", column)
    return smallest(base, keys, n).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).select(*keys, column)


def sample_rows_md5(df: DataFrame, column: str, n: int, key: Sequence[str] | None = None,
                    seed: str = "qualmark") -> DataFrame:
    """``sample_rows`` plus ``md5(value)``."""
    return sample_rows(df, column, n, key=key, seed=seed, with_md5=True)


def distinct_values(df: DataFrame, column: str, keys: Iterable[str] = (), with_md5: bool = False) -> DataFrame:
    """Distinct non-null values (hash aggregate, map-side combined)."""
    keys = list(keys)
    out = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    if with_md5:
        out = out.withColumn("md5", F.md5(F.col(column).cast("string")))
    return out


def distinct_values_md5(df: DataFrame, column: str, keys: Iterable[str] = ()) -> DataFrame:
    return distinct_values(df, column, keys, with_md5=True)


EXTRACT_KINDS = ("train", "eval", "test", "rule_null_count_raw", "rule_freq_count_raw")
# Share of the rows that each kind may draw from when the samples are disjoint.
SPLIT = {"train": (0, 80), "eval": (80, 90), "test": (90, 100)}


def split_rows(df: DataFrame, kind: str, key: Sequence[str], seed: str = "qualmark") -> DataFrame:
    """The rows of one of the disjoint splits, by a hash of seed and key."""
    lo, hi = SPLIT[kind]
    u = F.conv(F.substring(hash_order_key(f"{seed}/split", *key), 1, 8), 16, 10).cast("long") % 100
    return df.where((u >= lo) & (u < hi))


def extract(df: DataFrame, column: str, kind: str = "train", size: int = SAMPLE_SIZE, md5: bool = False,
            key: Sequence[str] | None = None, seed: str = "qualmark", ts: str | None = None,
            disjoint: bool = False) -> DataFrame:
    """The exporter's dispatch.

    ``train``/``eval``/``test``: a sample of ``size`` rows, or all distinct
    values when ``size == -1``. Each kind draws with a seed of its own, so the
    samples are independent; with ``disjoint`` (needs ``key``) they come from
    rows divided 80/10/10 and share none. ``rule_null_count_raw``: ten-minute
    null counts of ``column`` over ``ts``; ``rule_freq_count_raw``: class counts
    per day of ``ts``. Unknown kinds raise (the reference silently exported nothing).
    """
    from .counts import freq_count, null_count
    if kind in SPLIT:
        if disjoint:
            if not key:
                raise ValueError("disjoint samples need the key of a row")
            df = split_rows(df, kind, key, seed)
        if size == -1:
            return distinct_values(df, column, with_md5=md5)
        return sample_rows(df, column, size, key=key, seed=f"{seed}/{kind}", with_md5=md5)
    if kind == "rule_null_count_raw":
        return null_count(df, ts, [column]).drop("column")
    if kind == "rule_freq_count_raw":
        return freq_count(df, ts, [column]).drop("column")
    raise ValueError(f"unknown extract kind {kind!r}; expected one of {EXTRACT_KINDS}")


def copy_table(df: DataFrame, limit: int | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """A5: ``SELECT *`` with an optional limit; ordered by ``order_by`` first so
    the limited rows are the same on every run."""
    out = df
    if limit is not None:
        if order_by:
            out = out.orderBy(*order_by)
        out = out.limit(int(limit))
    return out


def number_rows(df: DataFrame, order_by: Sequence[str], out: str = "rnum") -> DataFrame:
    """Rows numbered 1.. in ``order_by`` order, without a one-task window.

    The rows are range partitioned and sorted, and written once with their
    partition and position. The offsets come from that same table: one row per
    partition, so the window over them and their broadcast are bounded by the
    partition count. Rows that tie on ``order_by`` are numbered in any order.
    """
    order = list(order_by)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()          # (partition << 33) + position in the partition
    ranged = materialize(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__mid", mid), "row_numbers")
    pid = F.shiftright("__mid", 33)
    sizes = ranged.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__cnt"))
    before = F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__pid", F.coalesce(before, F.lit(0)).alias("__off"))
    numbered = ranged.withColumn("__pid", pid).join(F.broadcast(offsets), "__pid")
    position = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return numbered.withColumn(out, F.col("__off") + position + 1).drop("__pid", "__mid", "__off")


def page_by_row_number(df: DataFrame, order_by: Sequence[str], lo: int, hi: int, out: str = "rnum",
                       unique: bool = False) -> DataFrame:
    """Rows numbered 1.. in ``order_by`` order, keeping ``lo+1 <= rnum <= hi+1``.

    Rows that tie on ``order_by`` follow a hash of all their columns, so that pages
    asked for one by one fit together; ``unique`` promises that none tie and saves
    the hash. Only the order columns are sorted and numbered, which gives the keys
    at the page's edges; the rows from the one to the other (ties included) are then
    cut from ``df`` and numbered by partition and position from the first one's number.
    """
    order = list(order_by)
    tag = [] if unique else [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__tag")]
    names = [f"__o{i}" for i in range(len(order) + len(tag))]
    keyed = df.select("*", *[F.col(c).alias(n) for c, n in zip(order, names)], *[t.alias(names[-1]) for t in tag])
    numbered = number_rows(keyed.select(*names), names, out)
    edges = {r[out]: r for r in numbered.where(F.col(out).isin(lo + 1, hi + 1)).collect()}
    if lo + 1 not in edges:
        return keyed.select(*df.columns, F.lit(None).cast("long").alias(out)).limit(0)
    place = F.struct(*names)

    def edge(row) -> Column:
        return F.struct(*[F.lit(row[n]).cast(keyed.schema[n].dataType).alias(n) for n in names])

    first = edge(edges[lo + 1])
    before = numbered.where(place < first).count()
    page = keyed.where(place >= first)
    if edges[lo + 1][names[0]] is not None:                    # for the scan: a struct is not pushed down
        page = page.where(F.col(names[0]) >= F.lit(edges[lo + 1][names[0]]))
    if hi + 1 in edges:
        page = page.where(place <= edge(edges[hi + 1]))
        if edges[hi + 1][names[0]] is not None:
            page = page.where(F.col(names[0]).isNull() | (F.col(names[0]) <= F.lit(edges[hi + 1][names[0]])))
    page = number_rows(page, names, out).withColumn(out, F.col(out) + F.lit(before))
    return page.where((F.col(out) >= lo + 1) & (F.col(out) <= hi + 1)).select(*df.columns, out)
