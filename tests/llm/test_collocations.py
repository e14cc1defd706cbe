import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from helpers import DOC, rng
from pyspark.sql import functions as F

from qualmark.llm import collocations as co


def brute(rows, least=100, top=2000):
    """The contract in plain Python, from (text, lang) rows."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            f[lang or "und"].update(tuple(words[i:i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {d[i:i + m] for d, a in cand.items() for m in range(2, len(d)) for i in range(len(d) - m + 1) if a >= count[d[i:i + m]]}
        best = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                best.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, l, x, n[lang], -s) for r, (s, a, p, l, x) in enumerate(sorted(best)[:top])]
    return sorted(out)


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, g, "s", 0) for i, (t, g) in enumerate(rows)], DOC).repartition(parts)


def result(df, **params):
    return sorted(map(tuple, co.collocations(df, **params).collect()))


def corpus(seed=5, n=150):
    r = rng(seed)
    vocab = ["Alpha", "beta", "ÉTÉ", "été", "x" * 70, "don't", "日本", " ", " ", "a", "b", "New", "York", "\x00"]
    def text():
        out = []
        for _ in range(r.randint(0, 40)):
            out.append("New \t York City  hall a" if r.random() < 0.2 else r.choice(vocab))
            out.append(r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\v", "-"]))
        return "".join(out)
    return [(text(), r.choice(["en", "en", "de", None])) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = corpus() + [(None, "en"), ("", None), ("...", "fr"), ("beta a " * 60_000, "de"), ("one two three four five six " * 30, "it")]
    df = frame(spark, rows).withColumns({"doc": F.lit(1), "n": F.lit("x"), "phrase": F.lit(2), "want": F.lit(3)})
    want = brute(rows, least=8)
    assert result(df, least=8) == want and len({x[0] for x in want}) == 4
    top = brute(rows, least=8, top=5)
    assert result(df, least=8, top=5) == top


def test_collisions_are_told_apart(spark):
    """Fingerprints of ten bits, and bit tables that let all pass: the same result."""
    rows = corpus(6, 100)
    assert result(frame(spark, rows), least=6, fp_bits=10, bits=6) == brute(rows, least=6)


def test_repeated_rows_null_ids_ties_and_no_rows(spark):
    rows = [("red green", "en")] * 12 + [("blue green", "en")] * 12 + [("up down", None)] * 11
    df = frame(spark, rows).withColumn("doc_id", F.lit(None).cast("long"))
    assert result(df, least=10) == brute(rows, least=10)
    assert result(df.unionByName(df), least=20) == brute(rows * 2, least=20)
    assert result(df.limit(0)) == [] and result(df) == []


def test_the_threshold_default_and_the_longer_phrase_rule(spark):
    rows = [("one two three", "en")] * 99 + [("one two", "en")] + [("a b c", "de")] * 100
    got = result(frame(spark, rows))
    assert got == brute(rows) and [x[2] for x in got] == ["a b c", "one two"]


def test_held_counts_and_places(spark):
    df = frame(spark, corpus(7, 40), 3)
    full = 1, np.full(1, 2**64 - 1, np.uint64)
    rows = lambda x: {tuple(r) for r in x.collect()}
    places = co.counts(df, (0, 1, 2, 3), full, bits=6)
    assert rows(co.counts(df, (0, 1, 2, 3), full, bits=6, held=3)) == rows(places)
    # every place reads back as its own phrase, and a wrong one is not taken
    assert co.read_phrases(df, places).count() == places.count()
    assert co.read_phrases(df, places.withColumn("place", F.col("place") + 8)).count() < places.count() / 2


def test_polynomials_do_not_depend_on_the_place():
    for stream in (0, 1):
        v = np.arange(5000, dtype=np.uint64) % 7
        p = co.prefix_polynomial(v, stream)
        h = co.between(p, np.array([0, 7, 700]), np.array([50, 57, 750]), stream)
        assert h[0] == h[1] == h[2] and h[0] != co.between(p, np.array([1]), np.array([51]), stream)[0]
    assert co.Pieces(*co.column_bytes(pa.array(["a b, c", "d"]))).run.tolist() == [2, 1, 1, 1]
