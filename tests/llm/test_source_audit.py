import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from helpers import DOC, rng
from pyspark.sql import functions as F

from qualmark.llm import source_audit as sa

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=10, most=10):
    """The contract in plain Python integers, from (text, lang, source) rows."""
    groups, in_docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang or "", source or ""].update(found)
        in_docs[lang or ""].update(set(found))
    out = []
    for lang in in_docs:
        kept = [t for t, d in in_docs[lang].items() if d >= min_docs]
        v = len(kept)
        here = {s: c for (g, s), c in groups.items() if g == lang}
        total = Counter()
        for c in here.values():
            total.update(c)

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 2) // (n + 2 * v) for t in kept}
        p = {s: share(c) for s, c in here.items()}
        q = share(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in here:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in here if o != s]
            term = [(-f(p[s][t], q[t]), t.encode()) for t in kept if here[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:most])):
                out += [(lang, s, part, i.decode(), -v, r + 1) for r, (v, i) in enumerate(items)]
    return sorted(out)


def result(df, **params):
    return sorted(map(tuple, sa.divergence_report(df, **params).collect()))


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, g, s, 0) for i, (t, g, s) in enumerate(rows)], DOC).repartition(parts)


def corpus(seed=3, n=160, sources=9):
    r = rng(seed)
    vocab = ["Alpha", "beta", "ÉTÉ", "été", "x" * 60, "straße", "日本", "o", "İ", "q9q", "a_b", "don't"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(6)]
    return [(" ".join(r.choice(vocab[: 20 + k % 40]) for _ in range(r.randint(0, 60))), r.choice(["en", "en", "de", None]), f"s{min(r.randint(0, 2 * sources), sources)}")
            for k in range(n)]


def test_equals_brute_force(spark):
    rows = corpus() + [(None, "en", "s0"), ("", "en", None), ("alpha \x00 beta\n" * 30, "en", "s1"), ("beta " * 200_000, "de", "s2"),
                       ("lonely words", "fr", "only"), ("here", "it", "a"), ("there", "it", "b"), ("here", "it", "b")]
    df = frame(spark, rows).withColumns({"term": F.lit(1), "n": F.lit(2), "size": F.lit("z")})
    want = brute(rows)
    assert result(df) == want and any(x[2] == "term" for x in want)
    assert {x[4] for x in want if x[0] == "it"} == {0}            # no kept term: every pair is 0
    # tiles of two sources, shards, and runs that cut inside a shard, give the same
    assert result(df, tile=2, shards=3, rows=7) == want


def test_a_single_kept_term_ties_and_repeated_rows(spark):
    rows = [("one", "en", "a")] * 12 + [("two", "en", "b")] * 9 + [(None, "en", "c"), (None, "en", "d")]
    assert result(frame(spark, rows)) == brute(rows)
    rows = [("x y", "en", s) for s in "abcd" for _ in range(5)]    # all equal: ties by item
    assert result(frame(spark, rows)) == brute(rows)


def test_no_rows(spark):
    assert result(frame(spark, [("a", "b", "c")]).limit(0)) == []


def test_arrow_pipeline_and_flushing(spark):
    b = pa.record_batch({"lang": ["en", "en"], "source": ["a", "a"], "text": ["Ab ab,AB 1 ÀB", ""]})
    t = sa.term_counts(b).sort_by("term").to_pydict()
    assert (t["term"], t["n"], t["docs"]) == (["ab", "Àb"], [3, 1], [1, 1])
    df = frame(spark, corpus(4, 60))
    few = sa.partial_counts(df, held_rows=5).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("d"))
    full = sa.partial_counts(df).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("d"))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, full.collect()))


def test_exact_shares():
    r = np.random.default_rng(1)
    size = r.integers(10, 1 << 52, 2000)
    count = (r.random(2000) * (size - 2)).astype(np.int64)
    count[:5] = size[:5] - 2
    assert sa.shares(count, size).tolist() == [1 + 10**9 * (int(c) + 2) // int(s) for c, s in zip(count, size)]
