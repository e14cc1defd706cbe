import numpy as np
import pyarrow as pa
from helpers import docs_frame, rng, spans_of

from qualmark.llm import line_dedup as ld
from qualmark.llm.textops import column_bytes, segment_hashes


def brute(docs, width=3):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda r: r[0]):
        lines = t.split("\n") if t is not None else []
        gone = [False] * len(lines)
        for i in range(len(lines) - width + 1):
            w = tuple(lines[i:i + width])
            if w in seen:
                gone[i:i + width] = [True] * width
            seen.add(w)
        kept = [x for x, g in zip(lines, gone) if not g]
        out.append((d, "\n".join(kept) if kept else None, len(lines), sum(gone), spans_of(gone)))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r.text, *r.line_dedup) for r in ld.line_dedup(df).collect()], key=str)


def test_equals_brute_force(spark):
    r = rng(1)
    docs = [(i, "\n".join(r.choice(["", "a", "b", "é c", "x" * 50, " "]) for _ in range(r.randint(1, 12)))) for i in range(90)]
    docs += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, docs[1][1]), (104, "\n".join(map(str, range(20_000)))),
             (105, "\n".join(map(str, range(5, 10_000))))]
    df = docs_frame(spark, docs).withColumnRenamed("lang", "starts").withColumnRenamed("source", "row")
    assert result(df) == brute(docs)
    assert ld.line_dedup(df).columns == [*df.columns, "line_dedup"]


def test_repeated_rows_null_ids_and_empty(spark):
    t = "a\nb\nc\nd"
    got = [(x[0], x[3]) for x in result(docs_frame(spark, [(1, t), (1, t), (2, t)]))]
    assert got == [(1, 0), (1, 0), (2, 4)]
    assert sorted((x[0] is None, x[3]) for x in result(docs_frame(spark, [(None, t), (2, t)]))) == [(False, 4), (True, 0)]
    assert result(docs_frame(spark, [(1, t)]).limit(0)) == []


def test_line_bounds_and_hashes():
    col = pa.array(["a\n\nb", "", None, "\n", "xyz"])
    buf, off = column_bytes(col)
    start, end, first = ld.line_bounds(buf, off)
    lines = [buf[s:e].tobytes() for s, e in zip(start, end)]
    assert lines == [b"a", b"", b"b", b"", b"", b"", b"", b"xyz"] and first.tolist() == [0, 3, 4, 5, 7, 8]
    for h in segment_hashes(buf, start, end):
        assert len(np.unique(h)) == len(set(lines))
