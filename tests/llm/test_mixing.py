import hashlib
import math

import numpy as np
import pytest
from helpers import docs_frame, rng
from pyspark.sql import functions as F

from qualmark.llm import mixing


def counted(df):
    return df.withColumn("n_tokens", mixing.token_count(F.col("text")))


def corpus(seed=1, n=400):
    r = rng(seed)
    docs = [(i, " ".join(["w"] * r.randint(0, 30))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, " \n\t ")]
    return docs


def brute(rows, weights, budget, seed="mix"):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    out = {}
    for s, w in weights.items():
        mine = [(i, n) for i, src, n in rows if src == s]
        total = sum(n for _, n in mine)
        if not total:
            out |= {i: 0 for i, _ in mine}
            continue
        due = math.floor(w * budget + 1e-6)
        epochs, left = divmod(due, total)
        place = lambda i: (md5(f"{seed}|{s}|{epochs}|{md5(f'{seed}:{i}')[:2]}"), md5(f"{seed}:{i}"), i)
        for i, n in sorted(mine, key=lambda x: place(x[0])):
            left -= n
            out[i] = epochs + (left >= 0)
    return out


@pytest.mark.parametrize("refine", [mixing.REFINE_ROWS, 1])
def test_draws_equal_brute_force(spark, monkeypatch, refine):
    monkeypatch.setattr(mixing, "REFINE_ROWS", refine)
    df = counted(docs_frame(spark, corpus()).withColumn("source", F.expr("case when doc_id % 10 = 0 then null when doc_id % 10 < 7 "
                                                                         "then 'hot' else concat('s', doc_id % 3) end")))
    got = mixing.mix(df.withColumnRenamed("lang", "row").withColumnRenamed("n_chars", "hash"), budget=9000.0).collect()
    rows = [(r.doc_id, r.source or "null", r.n_tokens) for r in got]
    weights = {r.source or "null": r.mix.weight for r in got}
    assert abs(sum(weights.values()) - 1) < 1e-9
    assert {r.doc_id: r.mix.repeats for r in got} == brute(rows, weights, 9000.0)


def test_exponent_meets_targets(spark):
    tokens = {"a": 1000, "b": 100, "c": 10, "d": 1, "empty": 0}
    t = spark.createDataFrame(list(tokens.items()), "source string, tokens long")
    live = [v for v in tokens.values() if v]

    def weights(a):
        raw = [(v / sum(live)) ** a for v in live]
        return [x / sum(raw) for x in raw]
    entropy = lambda a: -sum(w * math.log(w) for w in weights(a))
    a = mixing.find_exponent(t, 1111.0, entropy=0.8, max_epochs=None)
    assert entropy(a) >= 0.8 * math.log(4) - 1e-6 > entropy(a + 2 / mixing.STEPS)
    b = mixing.find_exponent(t, 1111.0, entropy=None, max_epochs=4.0)
    most = lambda a: max(w * 1111 / v for w, v in zip(weights(a), live))
    assert most(b) <= 4.0 + 1e-6 < most(b - 2 / mixing.STEPS) + 2e-3
    assert mixing.find_exponent(t, 1111.0) == max(mixing.find_exponent(t, 1111.0, max_epochs=None), b)
    assert mixing.find_exponent(t.limit(0), 1.0) == 1.0


def test_every_source_once_and_schedule(spark):
    df = counted(docs_frame(spark, corpus(2)))
    mixed = mixing.mix(df, budget=None)
    assert mixed.where("n_tokens > 0 and mix.repeats < 1").count() == 0
    rows = mixing.schedule(mixed)
    assert rows.columns == [*df.columns, "mix_epoch", "mix_order"]
    assert rows.count() == mixed.agg(F.sum("mix.repeats")).first()[0]
    assert mixing.mix(df.limit(0)).count() == 0


def test_least_budget_draws_all_of_large_sources(spark):
    r = np.random.default_rng(2)
    rows = [(f"{i}", int(n)) for i, n in enumerate(r.integers(1, 10**11, 60))]
    bad = []
    for a in range(0, 60, 6):
        totals = spark.createDataFrame(rows[a:a + 6], "source string, tokens long")
        for exponent in (0.3, 0.7, 1.0):
            bad += [x for x in mixing.source_budgets(totals, exponent, None).collect() if x.epochs < 1]
    assert not bad
