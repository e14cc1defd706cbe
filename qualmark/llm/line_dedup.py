"""Line deduplication over overlapping three-line windows.

Every run of three consecutive lines is a window. A window's first occurrence
in the corpus (smallest document, then smallest line) stays; the lines covered
by any later occurrence are removed, overlaps merged into spans.

Window hashes are grouped with a map-side minimum, so a window shared by a
third of the documents is one row per task; only windows seen more than once
are joined back to their occurrences, by a splittable skewed key. Texts are
shuffled once, to meet their own document's spans.

Cases: null text has no line and stays null; an empty text is one empty line;
fewer than three lines form no window; lines are compared byte by byte (a
128-bit hash stands for them) and cut at ``\\n`` alone; documents are ordered
by ``doc_id`` (null first), then text hash; rows equal in both are one
document, each row getting its result; other columns are kept whatever their
names; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .textops import U64, column_bytes, merge_spans, mix, pack, segment_hashes, slices, small_batches, tidy, unpack

WIDTH = 3
BATCH_BYTES = 1 << 20


def line_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and the index of each row's first line."""
    cut = np.flatnonzero(buf == 10)
    start = np.concatenate([off[:-1], cut + 1])
    row = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, cut, side="right") - 1])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.empty_like(start)
    first = np.searchsorted(row, np.arange(len(off)))
    end[:-1] = start[1:] - 1
    end[first[1:] - 1] = off[1:]
    return start, end, first


def windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per window: ``doc, th`` (text hash), ``pos`` and the hash ``a, b`` of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                buf, off = column_bytes(part.column(2))
                start, end, first = line_bounds(buf, off)
                lines = np.diff(first)
                n = np.maximum(lines - width + 1, 0)
                row = np.repeat(np.arange(len(n)), n)
                pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                at = first[:-1][row] + pos
                hashed = []
                for h in segment_hashes(buf, start, end):
                    w = np.zeros(len(at), np.uint64)
                    for j in range(width):
                        w = mix(w * U64(0x9E3779B97F4A7C15) + h[at + j], j)
                    hashed.append(pa.array(w.view(np.int64)))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(pos.astype(np.int32)), *hashed],
                    names=["doc", "th", "pos", "a", "b"])

    return docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc"),
                                                        F.xxhash64("text").alias("th"), "text") \
        .mapInArrow(tidy(run), "doc long, th long, pos int, a long, b long")


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc, th, starts``: the windows of a document that occur earlier in the corpus."""
    w, at = windows(docs, width), F.struct("doc", "th", "pos")
    seen = w.groupBy("a", "b").agg(F.min(at).alias("first"), F.max(at).alias("last")) \
        .where(F.col("first") != F.col("last")).select("a", "b", "first")
    return w.join(seen, ["a", "b"]).where(F.struct("doc", "th", "pos") != F.col("first")) \
        .groupBy("doc", "th").agg(F.collect_set("pos").alias("starts"))


def drop_lines(text: str, starts: list[int], width: int = WIDTH) -> tuple[str | None, int, int, int]:
    """The text without the lines of the windows at ``starts`` (None if no line
    is left), how many lines it had, how many went, and in how many runs."""
    lines = text.split("\n")
    lo, hi = merge_spans(np.array(starts), np.array(starts) + width)
    kept, at = [], 0
    for a, b in zip(lo, hi):
        kept += lines[at:a]
        at = b
    kept += lines[at:]
    return "\n".join(kept) if kept else None, len(lines), len(lines) - len(kept), len(lo)


def line_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text`` (null if none is left)
    and a struct ``line_dedup`` of ``n_lines``, ``n_removed`` (lines) and
    ``n_spans`` (merged runs of removed lines); it replaces a column so named."""
    docs = docs.drop("line_dedup")
    small_batches(docs.sparkSession)
    hits = repeated_windows(docs, width).select(F.col("doc").alias("d"), F.col("th").alias("t"), "starts")
    src = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("th"), "text",
                      pack(docs).alias("row"))
    joined = src.join(hits, F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left") \
        .select("text", "row", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                out = []
                for text, starts in zip(part.column(0).to_pylist(), part.column(2).to_pylist()):
                    if text is None or not starts:
                        out.append((text, 0 if text is None else text.count("\n") + 1, 0, 0))
                    else:
                        out.append(drop_lines(text, starts, width))
                cols = [pa.array(list(c), t) for c, t in zip(zip(*out), [pa.string()] + [pa.int64()] * 3)]
                yield pa.RecordBatch.from_arrays([cols[0], part.column(1), *cols[1:]],
                                                 names=["text", "row", "n_lines", "n_removed", "n_spans"])

    done = joined.mapInArrow(tidy(run), StructType([StructField("text", StringType()), src.schema["row"]]
                                             + [StructField(c, LongType()) for c in ("n_lines", "n_removed", "n_spans")]))
    return done.select(*unpack(docs), F.struct("n_lines", "n_removed", "n_spans").alias("line_dedup"))
