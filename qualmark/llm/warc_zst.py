"""WARC archives compressed with Zstandard: one frame per record, and a shared
dictionary in a leading skippable frame.

File layout: a skippable frame with magic ``0x184D2A5D`` holding the
dictionary (left out when there is none), then one Zstandard frame per record.
Files are written by Spark's text sink into any store it can reach: a row is
one frame, and the line separator between rows is itself an empty skippable
frame, which every Zstandard reader passes over. They are read back with
Spark's binary file source.

Records are WARC/1.1 ``response`` and ``revisit`` records with an HTTP head.
A record whose payload equals another's (at least ``min_revisit`` bytes) is
written as a revisit of the one with the largest id, with the HTTP head alone.

Cases: null payload is an empty one; null uri leaves the header out; a null id
is smaller than any other; rows equal in id and payload are the same kind; a
table without rows writes no archive and reads back as no record; control
characters of a uri are percent-encoded; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textops import few_rows, slices, small_batches, tidy

# Fixed values of the format.
DICT_MAGIC = 0x184D2A5D
EMPTY_FRAME = "\x50\x2a\x4d\x18\x00\x00\x00\x00"       # skippable frame without content
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
NEXT_FRAME = EMPTY_FRAME.encode("latin-1") + ZSTD_MAGIC
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

FILE_BYTES = 32 << 20            # payload per archive file
DICT_SAMPLE = 256                # pages whose payloads train the dictionary
DICT_SAMPLE_BYTES = 16 << 10     # of each such payload
DICT_BYTES = 32 << 10
RECORD_BYTES = 512               # headers of a record, about

RECORD = "file string, offset long, record_id string, page_id long, record_type string, target_uri string, " \
         "payload_bytes long, payload_digest string, refers_to long, payload binary, error string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return "<urn:qualmark:page:%s>" % ("none" if page_id is None else page_id)


def page_of(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:qualmark:page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def _clean_uri(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), uri)


def build_record(page_id: int | None, uri: str | None, payload: bytes, revisit_of: int | None) -> bytes:
    """One uncompressed WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit_of is not None else http + payload
    head = [VERSION, "WARC-Type: " + ("response" if revisit_of is None else "revisit"),
            "WARC-Record-ID: " + record_uri(page_id), "WARC-Date: " + DATE]
    if uri is not None:
        head.append("WARC-Target-URI: " + _clean_uri(uri))
    head.append("WARC-Payload-Digest: sha1:" + base32_sha1(payload))
    if revisit_of is not None:
        head += ["WARC-Profile: " + REVISIT_PROFILE, "WARC-Refers-To: " + record_uri(revisit_of)]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    """A validated record, or ``error`` with whatever could be read."""
    offset: int = 0
    headers: dict | None = None
    payload: bytes | None = None
    payload_bytes: int | None = None
    error: str | None = None


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError("header line without a name")
        out[name.strip().decode().title()] = value.strip().decode()
    return out


def parse_record(raw: bytes, offset: int = 0) -> Record:
    """Check version line, required headers, block length, record end and payload digest."""
    rec = Record(offset)
    try:
        head, sep, rest = raw.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        if not sep or lines[0] != VERSION.encode():
            raise ValueError("no version line")
        rec.headers = h = _fields(lines[1:])
        missing = [x for x in REQUIRED if x.title() not in h]
        if missing:
            raise ValueError("missing header " + missing[0])
        size = h["Content-Length"]
        if not size.isascii() or not size.isdigit() or len(rest) != int(size) + 4:
            raise ValueError("Content-Length differs from the block")
        if not rest.endswith(b"\r\n\r\n"):
            raise ValueError("record does not end with two line breaks")
        http, sep, body = rest[:-4].partition(b"\r\n\r\n")
        if not sep:
            raise ValueError("no HTTP head")
        inner = _fields(http.split(b"\r\n")[1:])
        rec.payload_bytes = int(inner["Content-Length"])
        kind = h["Warc-Type"]
        if kind == "revisit":
            if body or "Warc-Refers-To" not in h:
                raise ValueError("revisit with a payload or without a reference")
        elif kind == "response":
            if len(body) != rec.payload_bytes:
                raise ValueError("HTTP Content-Length differs from the payload")
            if h.get("Warc-Payload-Digest") != "sha1:" + base32_sha1(body):
                raise ValueError("payload digest differs")
            rec.payload = body
        else:
            raise ValueError("unknown record type")
    except (ValueError, KeyError, UnicodeDecodeError) as e:
        rec.error = str(e) or type(e).__name__
    return rec


def read_archive(data: bytes) -> Iterator[Record]:
    """Walk the frames of one archive: load the dictionary from the leading
    skippable frame, decode one record per frame, of any size. A damaged frame gives
    an error record; reading goes on after the next separator that a frame follows."""
    view, at, dictionary = memoryview(data), 0, None
    while at < len(data):
        if len(data) - at < 8:
            yield Record(at, error="truncated frame")
            return
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(data):
                yield Record(at, error="truncated skippable frame")
                return
            if at == 0 and magic == DICT_MAGIC:
                raw = bytes(view[8:8 + size])
                if raw[:4] == ZSTD_MAGIC:                              # the dictionary may be compressed itself
                    raw = zstd.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
                dictionary = zstd.ZstdCompressionDict(raw)
            at += 8 + size
            continue
        try:
            claimed = zstd.frame_content_size(bytes(view[at:at + 18]))
            one = zstd.ZstdDecompressor(dict_data=dictionary).decompressobj()
            bound = len(data) - at if claimed < 0 else claimed + (claimed >> 7) + 1024
            raw = one.decompress(bytes(view[at:at + bound]))
            if not one.eof:
                raise zstd.ZstdError("truncated frame")
            if claimed >= 0 and len(raw) != claimed:
                raise zstd.ZstdError("frame content size differs")
        except zstd.ZstdError as e:
            yield Record(at, error=f"bad frame: {e}")
            at = data.find(NEXT_FRAME, at + 1)
            if at < 0:
                return
            continue
        used = min(len(data) - at, bound) - len(one.unused_data)
        yield parse_record(raw, at)
        at += used


# ------------------------------------------------------------------- Spark
def train_dictionary(pages: DataFrame, payload: str = "payload", page_id: str = "page_id") -> bytes | None:
    """A dictionary from a bounded sample: the ``DICT_SAMPLE`` pages of smallest
    id hash, the leading ``DICT_SAMPLE_BYTES`` of each. None if they are too few or too alike."""
    some = pages.select(F.substring(F.col(payload), 1, DICT_SAMPLE_BYTES).alias("p"), F.col(page_id).alias("id"))
    rows = few_rows(some, "id", DICT_SAMPLE, pages.count()).collect()
    samples = sorted(bytes(r.p) for r in rows if r.p)
    if len(samples) < 16:
        return None
    try:
        return zstd.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstd.ZstdError:
        return None


def with_revisits(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """``page_id, uri, payload`` plus ``refers_to`` (null for responses).

    The payload's digest is counted before the shuffle (map-side combine), and
    only digests seen more than once are joined back; a payload shared by a
    third of the pages is one row there and a splittable skewed key here.
    """
    src = pages.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    firsts = src.where(F.col("size") >= min_revisit).groupBy("digest") \
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = src.join(firsts, "digest", "left")
    revisit = F.col("response_id").isNotNull() & (F.col("size") >= min_revisit) \
        & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select("page_id", "uri", "payload", F.when(revisit, F.col("response_id")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, dictionary: bytes | None, records: int, file_bytes: int = FILE_BYTES) -> None:
    """Write ``page_id, uri, payload, refers_to`` as archives below ``path``, of at most
    ``records`` frames and ``file_bytes`` of payload each (a longer record is a file of its
    own); every task writes what it holds. A file that is full by its bytes is filled up
    with empty frames, since Spark starts files by their rows."""
    small_batches(pages.sparkSession)
    shipped = pages.sparkSession.sparkContext.broadcast(dictionary)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shipped.value
        packer = zstd.ZstdCompressor(level=3, dict_data=zstd.ZstdCompressionDict(d) if d else None,
                                     write_content_size=True)
        rows = held = 0
        for batch in batches:
            for part in slices(batch, "payload", 4 << 20):
                out = []
                for pid, uri, payload, ref in zip(*(c.to_pylist() for c in part.columns)):
                    if rows % records and held + len(payload or b"") > file_bytes:
                        out += [b""] * (records - rows % records)
                        rows += records - rows % records
                    if rows % records == 0:
                        held = 0
                    held += len(payload or b"") + RECORD_BYTES
                    if d and rows % records == 0:             # Spark starts a file after every `records` rows
                        out.append(struct.pack("<II", DICT_MAGIC, len(d)) + d)
                        rows += 1
                    rows += 1
                    out.append(packer.compress(build_record(pid, uri, payload or b"", ref)))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    records = max(2, records)                              # the dictionary and a record
    pages.select("page_id", "uri", "payload", "refers_to").mapInArrow(tidy(frames), "frame binary") \
        .select(F.col("frame").cast("string").alias("value")) \
        .write.option("maxRecordsPerFile", records).option("lineSep", EMPTY_FRAME).option("compression", "none").mode("overwrite").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path`` (see ``RECORD``); records
    that fail a check carry ``error`` and no payload."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for r in read_archive(content.as_py()):
                    h = r.headers or {}
                    rows.append((name, r.offset, h.get("Warc-Record-Id"), page_of(h.get("Warc-Record-Id")),
                                 h.get("Warc-Type"), h.get("Warc-Target-Uri"), r.payload_bytes,
                                 (h.get("Warc-Payload-Digest") or "").removeprefix("sha1:") or None,
                                 page_of(h.get("Warc-Refers-To")), r.payload, r.error))
                    size += len(r.payload or b"")
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    return files.mapInArrow(tidy(read), RECORD)


_ARROW = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
          pa.int64(), pa.binary(), pa.string()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[] for _ in _ARROW]
    names = [x.split()[0] for x in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(cols, _ARROW)], names=names)


def records_per_file(pages: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Records of the table's mean payload that fill ``file_bytes``."""
    mean = pages.agg(F.avg(F.octet_length("payload"))).first()[0] or 0
    return max(2, int(file_bytes / (mean + RECORD_BYTES)))
