"""Vectorised byte and word helpers shared by the text operators.

All functions work on one bounded batch inside a task; Spark splits and
shuffles the work. A *word* is a maximal run of the bytes ``0-9``, ``a-z``
(after lower-casing ``A-Z``) and all bytes of non-ASCII letters, which is the
pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on UTF-8.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_P = U64(0x9E3779B97F4A7C15 | 1)


def _lower_table() -> np.ndarray:
    t = np.zeros(256, dtype=np.uint8)
    t[0x30:0x3A] = np.arange(0x30, 0x3A)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


LOWER_WORD = _lower_table()      # word bytes lower-cased, every other byte 0


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and its row offsets (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    off = off[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] \
        else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows with about ``max_bytes`` of ``column``
    (a single longer row stays whole)."""
    if batch.num_rows == 0:
        return
    col = batch.column(batch.schema.get_field_index(column))
    n = np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
    end, start = np.cumsum(n), 0
    while start < batch.num_rows:
        base = end[start - 1] if start else 0
        stop = int(np.searchsorted(end, base + max_bytes, side="right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), one stream per ``seed``."""
    h = h + U64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def powers(n: int) -> np.ndarray:
    """``_P ** 0 .. _P ** (n-1)`` modulo 2**64."""
    out = np.full(max(n, 1), _P, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The words of a batch: 64-bit hash, byte start and end, and row bounds.

    ``first[i] : first[i + 1]`` are the words of row ``i``.
    """

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        low = LOWER_WORD[buf]
        isw = low != 0
        n = len(buf)
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True                                   # a word never crosses rows
        prev = np.zeros(n + 1, dtype=bool)
        prev[1:] = isw
        here = np.zeros(n + 1, dtype=bool)
        here[:n] = isw
        self.start = np.flatnonzero(here & (~prev | edge))
        self.end = np.flatnonzero(prev & (~here | edge))
        wb = low[isw]
        lens = self.end - self.start
        if len(lens):
            at = np.cumsum(lens) - lens
            pos = np.arange(len(wb)) - np.repeat(at, lens)
            val = wb.astype(np.uint64) * powers(int(lens.max()))[pos]
            self.hash = mix(np.add.reduceat(val, at) + lens.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)


def column_words(col: pa.Array) -> Words:
    return Words(*column_bytes(col))


def repeat_ranges(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenate ``lo[i], lo[i]+1, .. lo[i]+count[i]-1`` for every i."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(count) - count
    return np.arange(total) - np.repeat(at - lo, count)


def merge_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans: touching or overlapping spans become one."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > hi[:-1]
    at = np.flatnonzero(new)
    return lo[at], np.append(hi[at[1:] - 1], hi[-1])


def segment_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, streams: int = 2) -> list[np.ndarray]:
    """Independent 64-bit hashes of the byte segments ``start[i]:end[i]``, which
    follow one another without overlap (an empty segment hashes its length)."""
    lens = end - start
    idx = repeat_ranges(start, lens)
    at = np.cumsum(lens) - lens
    pos = np.arange(len(idx)) - np.repeat(at, lens)
    full = lens > 0
    out = []
    for s in range(streams):
        base = mix(powers(int(lens.max()) if len(lens) else 0), s) | U64(1)      # one odd weight per position
        h = np.zeros(len(lens), np.uint64)
        if len(idx):
            h[full] = np.add.reduceat(mix(buf[idx].astype(np.uint64), s + 11) * base[pos], at[full])
        out.append(mix(h + lens.astype(np.uint64), s))
    return out


def pack(docs: DataFrame) -> Column:
    """Every column but ``text`` as one struct, so no name can clash on the way."""
    names = [c for c in docs.columns if c != "text"]
    return F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("none"))


def unpack(docs: DataFrame, row: str = "row") -> list[Column]:
    """The columns of ``docs`` again: ``text`` as it now is, the others from the struct."""
    return [F.col("text") if c == "text" else F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]


def few_rows(df: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """``n`` rows (all, if fewer) of smallest key hash. Only about ``4 n`` rows of the
    ``total`` pass the first filter, so the tasks' candidates do not add up with their number."""
    h = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    cut = (1 << 31) if total <= 4 * n else (4 * n << 31) // total
    return df.where(h < cut).orderBy(h, key).limit(n)


def _trim() -> None:
    """Give freed memory back: an idle Python worker keeps its largest task's otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)        # of glibc; others give it back by themselves
    if trim is not None:
        trim(0)


def tidy(run):
    """An Arrow batch function that gives its freed memory back when its task ends."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()
    return tidied


ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``ARROW_ROWS`` rows and about ``ARROW_BYTES`` for the
    session's later plans: ten thousand whole texts at once, on both sides of a
    Python worker, are too much for small executors. Smaller settings stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = str(spark.conf.get(key)).lower().rstrip("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
