import hashlib
import re

import numpy as np
import xxhash
from helpers import docs_frame, rand_text, rng
from pyspark.sql import functions as F

from qualmark.llm import bottom_k as bk
from qualmark.llm import queries

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def xx(values, seed=42):
    """Spark's xxHash64 of strings or longs, one after the other."""
    for v in values:
        raw = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed=seed & (2**64 - 1))
        seed = seed - 2**64 if seed >= 2**63 else seed
    return seed


def shingle_set(text, width=5):
    text = text or ""
    h = [xx([w]) for w in WORD.findall(text.lower())]
    top = lambda v: (v & (2**64 - 1)) >> 16
    if not h:
        return {top(xx([text]))} if text else set()
    return {top(xx(h[i:i + width])) for i in range(max(1, len(h) - width + 1))}


def alike(a, b, k=256):
    u = sorted(set(sorted(a)[:k]) | set(sorted(b)[:k]))[:k]
    return len(set(u) & a & b) / len(u) if u else 1.0


def brute(docs, k=256):
    text = lambda s: "".join(f"{h:012X}" for h in sorted(s)[:k])
    order = sorted(docs, key=lambda d: -d[0])
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, b, c = map(shingle_set, (t, edited, nxt))
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), alike(a, b), alike(a, c)))
    return sorted(out)


def world(n=60, seed=4):
    r = rng(seed)
    vocab = ["Alpha", "beta", "ÉTÉ", "straße", "日本語", "𝔘𝔫𝔦", "x1", "don't", "q" * 30] + [f"w{i}" for i in range(40)]
    docs = [(7 * i - 100, rand_text(r, r.randint(0, 40), vocab)) for i in range(n)]
    return docs + [(1000, None), (1001, ""), (1002, "!!"), (1003, "one"), (1004, "\x00a b\x00c"), (1005, docs[3][1]),
                   (1006, rand_text(r, 9000, vocab)), (1007, rand_text(r, 9000, vocab)), (1008, "𝔘" * 501)]


def test_query_equals_brute_force(spark, tmp_path, monkeypatch):
    docs = world()
    docs_frame(spark, docs, 4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(bk.with_next, "__defaults__", (None, 6))          # many ranges of few rows
    got = sorted(map(tuple, queries.QUERIES["op12_fingerprint"](spark, str(tmp_path)).collect()))
    assert got == brute(docs)


def test_next_with_repeated_rows_null_ids_and_no_rows(spark):
    docs = [(None, "n1"), (None, "n2"), (3, "a"), (3, "a"), (3, "b"), (9, None), (5, "five"), (1, "x")] + [(4, "hot")] * 40
    df = docs_frame(spark, docs).withColumnsRenamed({"lang": "part", "source": "next"})
    for rows in (2, 1000):
        got = bk.with_next(df, range_rows=rows).select("row.*", "text", F.col("next.text").alias("after")).collect()
        assert got[0].__fields__[:4] == ["doc_id", "part", "next", "n_chars"]
        seen = sorted(((r.doc_id is None, -(r.doc_id or 0)), r.text, r.after) for r in got)
        assert [x[1] for x in seen if not x[0][0]].count("hot") == 40
        place = {}
        for key, text, after in seen:
            place.setdefault((key, text), []).append(after)
        assert place[((False, -9), "")] == ["five"] and place[((False, -5), "five")] == ["hot"]
        assert sorted(place[((False, -4), "hot")])[1:] == ["hot"] * 39            # and one that the next id follows
        chain = [a for x in place.values() for a in x]
        assert sorted(chain) == sorted(t or "" for _, t in docs)                # everyone follows someone, once
    one = docs_frame(spark, [(1, "self")])
    assert bk.with_next(one).first()["next"]["text"] == "self"
    assert bk.with_next(one.limit(0)).collect() == [] and bk.fingerprint(one.limit(0)).collect() == []


def test_sketches_merge_and_estimate(spark):
    r = np.random.default_rng(2)
    words = [f"w{i}" for i in range(5000)]
    a, b = " ".join(words), " ".join(words[1000:] + [f"v{i}" for i in range(1000)])
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    s = bk.fingerprint(df)
    x, y = (s.where(f"doc_id = {i}").select(F.col("fingerprint").alias(n)) for i, n in ((1, "x"), (2, "y")))
    both = x.withColumn("j", F.lit(1)).join(y.withColumn("j", F.lit(1)), "j")
    j, c = both.select(bk.resemblance(F.col("x"), F.col("y")), bk.containment(F.col("x"), F.col("y"))).first()
    assert abs(j - 4 / 6) < 0.1 and abs(c - 0.8) < 0.1
    many = docs_frame(spark, [(k, " ".join(f"w{k}x{i}" for i in range(2000))) for k in range(20)])
    n = [r[0] / 1996 for r in bk.fingerprint(many).select(bk.distinct_shingles(F.col("fingerprint"))).collect()]
    assert abs(np.mean(n) - 1) < 4 / np.sqrt(254 * 20) and max(abs(np.array(n) - 1)) < 4 / np.sqrt(254)
    assert sorted(shingle_set(a))[:256] == x.first()[0]
    # a sketch of parts merged is the sketch of all their shingles, also for a hot key with nulls
    parts = [(k, shingle_set(" ".join(r.choice(words, 30)))) for k in [None] * 40 + ["a"] * 3 + ["b"]] + [("c", set())]
    rows = spark.createDataFrame([(k, sorted(v)[:16], 5) for k, v in parts], "key string, sketch array<long>, hash int").repartition(5)
    got = {m.key: m.sketch for m in bk.merge(rows, ["key"], k=16).collect()}
    want = {k: sorted(set().union(*(v for q, v in parts if q == k)))[:16] for k in {p[0] for p in parts}}
    assert got == want


def test_text_form_round_trip_and_cases(spark):
    df = docs_frame(spark, [(1, "a b c d e f g " * 3), (2, ""), (3, None), (4, "??"), (5, "A B c")])
    s = bk.fingerprint(df)
    back = s.select("doc_id", "fingerprint", bk.from_text(bk.to_text(F.col("fingerprint"))).alias("back")).collect()
    assert all(r.back == r.fingerprint for r in back)
    by = {r.doc_id: r.fingerprint for r in back}
    assert by[2] == by[3] == [] and len(by[4]) == len(by[5]) == 1 and by[5] == sorted(shingle_set("a b C"))


def test_no_python_in_the_plan(spark):
    plan = queries.QUERIES["op12_fingerprint"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
