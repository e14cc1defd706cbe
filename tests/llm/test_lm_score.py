import math
from collections import Counter

import numpy as np
from helpers import docs_frame, rand_text, rng, words
from hypothesis import given
from hypothesis import strategies as st

from qualmark.llm import lm_score
from qualmark.llm.packing import expand, squeeze


def brute(docs, target, alpha):
    pairs, ctx, vocab = (Counter(), Counter()), (Counter(), Counter()), set()
    toks = [(d, words(t)) for d, t in docs]
    for d, w in toks:
        for v, x in zip(["<s>", *w], w):
            vocab.add(x)
            for m in (0, 1) if d in target else (0,):
                pairs[m][v, x] += 1
                ctx[m][v] += 1
    n = [sum(c.values()) for c in ctx]
    a = [alpha, alpha * n[1] / n[0] if n[1] else alpha]
    out = []
    for d, w in toks:
        loss = [sum(math.log(ctx[m][v] + a[m] * len(vocab)) - math.log(pairs[m][v, x] + a[m]) for v, x in zip(["<s>", *w], w))
                / len(w) if w else None for m in (1, 0)]
        out.append((d, len(w), *(round(x, 9) if x is not None else None for x in loss)))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    r = rng(1)
    docs = [(i, rand_text(r, r.randint(0, 60), ["a", "b", "the", "é", "Of", "x1"])) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "!!"), (5, docs[5][1]), (63, rand_text(r, 4000, ["a", "b", "zz"]))]
    target = list(range(0, 60, 3)) + [61]
    ids = spark.createDataFrame([(t,) for t in target + [target[0], 999]] + [(None,)], "doc_id long")
    df = docs_frame(spark, docs).withColumnRenamed("lang", "batch").withColumnRenamed("source", "target")
    for kw in ({}, {"range_grams": 100}):
        got = lm_score.cross_entropy_difference(df, ids, **kw).collect()
        assert sorted([(x.doc_id, x.n_tokens, *(round(y, 9) if y is not None else None
                                                for y in (x.loss_target, x.loss_background))) for x in got], key=str) \
            == brute(docs, set(target), lm_score.ALPHA)


def test_target_like_documents_score_lower(spark):
    good = [(i, "the cat sat on the mat " * 3) for i in range(20)]
    bad = [(100 + i, "buy now cheap pills buy now " * 3) for i in range(20)]
    ids = spark.createDataFrame([(i,) for i in range(10)], "doc_id long")
    got = {r.doc_id: r.score for r in lm_score.cross_entropy_difference(docs_frame(spark, good + bad), ids).collect()}
    assert max(got[i] for i, _ in good) < min(got[i] for i, _ in bad)


def test_no_target_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long")
    got = lm_score.cross_entropy_difference(docs_frame(spark, [(1, "a b c")]), none).collect()
    assert len(got) == 1 and round(got[0].loss_target, 6) == round(math.log(3), 6)
    assert lm_score.cross_entropy_difference(docs_frame(spark, [(1, "a")]).limit(0), none).count() == 0


@given(st.lists(st.integers(0, 2 ** 63 - 1), max_size=50))
def test_squeeze_round_trip(values):
    for t in (np.int64, np.uint64):
        assert expand(squeeze(np.array(values, t)), t).tolist() == values
