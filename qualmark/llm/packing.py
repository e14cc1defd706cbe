"""Documents packed into compressed batches, and integer arrays squeezed for shuffles.

A batch holds a bounded run of documents of one task. It keeps its name once
written, so that later stages can ask other tasks questions about its content
and receive the answers by name, without shuffling the texts again and again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textops import column_bytes, slices, small_batches

BATCH_BYTES = 1 << 20            # text per batch; a longer document is a batch of its own

PACKED = "batch string, n_bytes long, n_docs long, doc_ids array<long>, hashes array<long>, lens binary, text binary"


def squeeze(a: np.ndarray) -> bytes:
    """Compress an integer array byte plane by byte plane (high planes are mostly zero)."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return zstd.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstd.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def squeeze_bytes(a: np.ndarray, level: int = 3) -> bytes:
    return zstd.ZstdCompressor(level=level).compress(np.ascontiguousarray(a).tobytes())


def expand_bytes(b: bytes) -> np.ndarray:
    return np.frombuffer(zstd.ZstdDecompressor().decompress(b), np.uint8)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of an Arrow batch, one at a time: a batch of packed texts is not copied whole."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def batch_text(lens: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a packed batch."""
    return expand_bytes(text), np.concatenate([[0], np.cumsum(expand(lens, np.int64))])


def pack_documents(docs: DataFrame, name: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, text`` (null: empty) as batches, written to the shared folder;
    ``hashes`` tell apart different texts of one doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                buf, off = column_bytes(part.column(2))
                one = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([len(buf)]), pa.array([part.num_rows]),
                     pa.ListArray.from_arrays(one, part.column(0)), pa.ListArray.from_arrays(one, part.column(1)),
                     pa.array([squeeze(np.diff(off))], pa.binary()), pa.array([squeeze_bytes(buf, 6)], pa.binary())],
                    names=[x.split()[0] for x in PACKED.split(", ")])

    small_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    return materialize(src.mapInArrow(run, PACKED), name)
