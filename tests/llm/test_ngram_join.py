from collections import Counter

import numpy as np
from helpers import docs_frame, rng, words

from qualmark.llm import ngram_join as nj
from qualmark.llm.components import components


def brute(docs):
    sets = []
    for _, t in docs:
        w = words(t)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = Counter()
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    first = {}
    for i, (d, _) in enumerate(docs):
        first[find(i)] = min(first.get(find(i), d), d)
    return sorted((d, first[find(i)], links[i]) for i, (d, _) in enumerate(docs))


def corpus(seed, n=260):
    r = rng(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5)))
    base = [[word() for _ in range(r.choice([1, 3, 20, 40, 80]))] for _ in range(12)]
    docs = []
    for i in range(n):
        b = list(r.choice(base[:4] if i % 2 else base))
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            b[r.randrange(len(b))] = word()
        docs.append((i * 7 % 263, " ".join(b) if i % 50 else r.choice([None, "", "..."])))
    return docs + [(500, docs[3][1]), (500, docs[3][1]), (501, " ".join(word() for _ in range(30_000)))]


def test_equals_brute_force(spark):
    docs = corpus(2)
    got = nj.jaccard_join(docs_frame(spark, docs), bucket=16, block=8).collect()   # small: buckets split, tiles multiply
    assert sorted(map(tuple, got)) == brute(docs)
    assert max(r.n_links for r in got) > 20


def test_keep_first(spark):
    docs = corpus(3, 120)
    df = docs_frame(spark, docs).withColumnRenamed("lang", "first").withColumnRenamed("source", "row")
    out = nj.keep_first(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c, _ in brute(docs)})


def test_nulls_and_empty_table(spark):
    t = "one two three four five six seven"
    got = nj.jaccard_join(docs_frame(spark, [(None, t), (4, t), (3, t.upper()), (7, None), (None, "else")])).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in got) == [(0, 0, 0), (0, 3, 2), (3, 3, 2), (4, 3, 2), (7, 7, 0)]
    assert nj.jaccard_join(docs_frame(spark, [(1, t)]).limit(0)).count() == 0


def test_runs_reach_the_recall():
    miss = (1 - 0.8 ** nj.DEPTH) ** nj.runs_for()
    assert miss <= 1 - nj.RECALL


def test_overlap_and_forest():
    r = np.random.default_rng(0)
    a = [np.unique(r.integers(0, 60, n).astype(np.uint64)) for n in (0, 5, 30, 12)]
    b = [np.unique(r.integers(0, 60, n).astype(np.uint64)) for n in (9, 0, 40)]
    want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert nj.overlap(a, b).tolist() == want
    ids = np.arange(5)
    link = np.zeros((5, 5), bool)
    for i, j in ((4, 3), (3, 1), (0, 2)):
        link[i, j] = link[j, i] = True
    assert nj.forest(link, ids, ids)[0].tolist() == [0, 1, 0, 1, 1]


def test_components(spark):
    r = rng(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = {x: find(x) for x in root}
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
