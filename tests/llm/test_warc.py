import base64
import hashlib
import struct

import pytest
import zstandard as zstd
from helpers import SF_ORACLE
from pyspark.sql import functions as F

from qualmark.llm import warc_zst as wz
from qualmark.llm.queries import op9_warc
from qualmark.session import scratch_path


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def brute(rows):
    out = []
    for i, _, p in rows:
        p = p or b""
        same = [j for j, _, q in rows if (q or b"") == p and j is not None]
        ref = max(same) if same and i != max(same) else None
        out.append((i, len(p), digest(p), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    pages = [(r.page_id, r.url, (r.html or "").encode()) for r in spark.read.parquet(f"{SF_ORACLE}/pages.parquet").collect()]
    got = op9_warc(spark, SF_ORACLE).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute(pages) and not any(r.error for r in got)


@pytest.mark.parametrize("with_dict", [True, False])
def test_round_trip(spark, with_dict):
    rows = [(1, "http://a/\r\nX: y", b"same"), (2, None, b"same"), (3, "http://b", b""), (9, "u", None), (4, "http://é", "é\r\n\r\n".encode()),
            (5, "x", bytes(range(256)) * 3000), (6, "x", wz.EMPTY_FRAME.encode() * 5), (2, None, b"same"), (None, "n", b"same")]
    df = spark.createDataFrame(rows, "page_id long, uri string, payload binary").withColumn("digest", F.lit("clash")) \
        .withColumn("payload", F.coalesce("payload", F.lit(b"")))
    text = [f"<html><p>page {i} of the same words and so on</p>".encode() * 20 for i in range(40)]
    d = zstd.train_dictionary(4096, text).as_bytes() if with_dict else None
    path = scratch_path(spark, "t_warc")
    wz.write_archives(wz.with_revisits(df), path, d, 3)
    got = wz.read_archives(spark, path).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == brute(rows)
    assert all(r.error is None for r in got)
    back = {r.page_id: r for r in got if r.record_type == "response"}
    assert back[5].payload == rows[5][2] and back[4].target_uri == "http://é" and back[6].payload == rows[6][2]


def test_threshold_and_empty(spark):
    df = spark.createDataFrame([(1, "u", b"ab"), (2, "u", b"ab"), (3, "u", b"abc"), (4, "u", b"abc")], "page_id long, uri string, payload binary")
    got = {r.page_id: r.refers_to for r in wz.with_revisits(df, min_revisit=3).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}
    path = scratch_path(spark, "t_warc")
    wz.write_archives(wz.with_revisits(df.limit(0)), path, None, 2)
    assert wz.read_archives(spark, path).count() == 0
    assert wz.train_dictionary(df) is None and wz.records_per_file(df) > 1000


def archive(records, d=None, packed=False):
    c = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(d) if d else None)
    head = b""
    if d:
        body = zstd.ZstdCompressor().compress(d) if packed else d
        head = struct.pack("<II", wz.DICT_MAGIC, len(body)) + body
    return head + b"".join(c.compress(r) for r in records)


def test_reader_validates():
    ok = wz.build_record(7, "http://a", b"payload", None)
    d = zstd.train_dictionary(2048, [ok * 3 + bytes([i]) * 50 for i in range(60)]).as_bytes()
    for packed in (False, True):
        assert [r.payload for r in wz.read_archive(archive([ok, ok], d, packed))] == [b"payload"] * 2
    bad = {"no version line": ok.replace(b"WARC/1.1", b"WARC/9"), "missing header WARC-Date": ok.replace(b"WARC-Date", b"WARC-Dat3"),
           "Content-Length differs from the block": ok.replace(b"payload\r\n", b"payload!\r\n"),
           "payload digest differs": ok.replace(b"payload\r\n", b"paYload\r\n"),
           "unknown record type": ok.replace(b": response\r\nWARC-R", b": whatever\r\nWARC-R"),
           "header line without a name": ok.replace(b"WARC-Date: 2024-01-01T00:00:00Z", b"WARC-Date 2024")}
    for why, raw in bad.items():
        got = list(wz.read_archive(archive([raw, ok])))
        assert got[0].error == why and got[0].payload is None and got[1].error is None, why
    whole = archive([ok, ok])
    cut = list(wz.read_archive(whole[:-5]))
    assert cut[0].error is None and cut[1].error.startswith("bad frame")
    assert list(wz.read_archive(whole[:3]))[0].error == "truncated frame"
    assert list(wz.read_archive(b"")) == []
    flipped = bytearray(whole)
    flipped[0] ^= 0xFF
    assert list(wz.read_archive(bytes(flipped)))[0].error.startswith("bad frame")


def test_files_are_bounded_by_bytes_and_damage_costs_one_record(spark):
    """Long payloads that lie together; no file holds more than the bound and a record."""
    rows = [(i, f"http://x/{i}", bytes(str(i), "ascii") * (4000 if i % 50 < 25 else 3)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, uri string, payload binary").coalesce(1)
    path = scratch_path(spark, "warc_test")
    wz.write_archives(wz.with_revisits(pages), path, wz.train_dictionary(pages), 64, file_bytes=40_000)
    out = wz.read_archives(spark, path)
    got = {r.page_id: (r.file, r.payload_bytes, r.error) for r in out.collect()}
    assert {i: n for i, (_, n, _) in got.items()} == {i: len(p) for i, _, p in rows} and not any(e for *_, e in got.values())
    size = {}
    for f, n, _ in got.values():
        size[f] = size.get(f, 0) + n
    assert len(size) > 8 and max(size.values()) <= 40_000 + 12_000
    frames = [zstd.ZstdCompressor().compress(wz.build_record(i, "u", b"x" * 50 * i, None)) for i in range(1, 5)]
    frames[1] = frames[1][:-9] + b"damaged!!"
    read = list(wz.read_archive(wz.EMPTY_FRAME.encode("latin-1").join(frames)))
    assert [wz.page_of((r.headers or {}).get("Warc-Record-Id")) for r in read if r.error is None] == [1, 3, 4]
    assert sum(r.error is not None for r in read) == 1
