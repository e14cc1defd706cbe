import time
import zlib

import numpy as np
from pyspark.sql import functions as F
from helpers import SF_ORACLE, docs_frame

from qualmark.llm import langid
from qualmark.llm.queries import op6_language_id


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang").collect()}
    got = op6_language_id(spark, SF_ORACLE).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert len(out) > 100 and np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.95


def test_undetermined_texts_and_columns(spark):
    r = np.random.default_rng(3)
    rows = [(i, " ".join(r.choice(["the", "and", "of"] if i % 2 else ["der", "und", "von"], 40))) for i in range(40)]
    train = docs_frame(spark, rows).withColumn("lang", F.expr("if(doc_id % 2 = 1, 'en', 'de')"))
    model = langid.fit(train, docs_per_lang=20)
    assert model.langs == ["de", "en"]
    docs = docs_frame(spark, [(1, None), (2, ""), (3, "12 34 !?"), (4, "the and of the and"), (5, "der und " * 20000), (4, "the and of the and")]) \
        .withColumnRenamed("source", "row").withColumnRenamed("lang", "score_")
    got = sorted((x.doc_id, x.lang_pred, x.score > 0.5) for x in langid.predict(docs, model, docs.columns).collect())
    assert got == [(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True), (5, "de", True)]
    assert langid.predict(docs.limit(0), model, ["doc_id"]).count() == 0


def test_no_labels(spark):
    docs = docs_frame(spark, [(1, "some text")])
    assert langid.fit(docs.limit(0)) is None
    assert [(x.lang_pred, x.score) for x in langid.predict(docs, None, ["doc_id"]).collect()] == [("und", 0.0)]


def test_tables_equal_direct_convolution():
    r = np.random.default_rng(0)
    m = langid.train(r.integers(1, 255, (64, 16)).astype(np.uint8), r.integers(0, 2, 64), ["a", "b"], embed=3, filters=2, epochs=1)
    win = r.integers(1, 255, (5, 16)).astype(np.uint8)
    x = np.concatenate([win, np.zeros((5, 3), np.uint8)], axis=1)
    h = []
    for w in langid.WIDTHS:
        pos = np.stack([sum(m.emb[x[:, i + j]] @ m.kern[w][j] for j in range(w)) for i in range(16)], axis=1)
        h.append(pos.max(axis=1))
    z = np.maximum(np.concatenate(h, axis=1) + m.bias, 0) @ m.out + m.out_bias
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(m.window_probs(win, m.tables()), p, atol=1e-5)


def test_sample_takes_different_rows_with_letters(spark):
    r = np.random.default_rng(4)
    text = lambda v: " ".join(r.choice(v, 30))
    en, de = ["the", "and", "of"], ["der", "und", "von"]
    rows = [(i, text(en), "en") for i in range(40)] + [(i, f"{i} 12 !?", "de") for i in range(100, 160)] + [(i, text(de), "de") for i in (500, 501)]
    rows += [(1, text(en), "en")] * 200 + [(2, text(en), "en") for _ in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = langid.sample_rows(df, 20)
    assert [x.lang for x in got].count("en") == 20 and sorted(x.doc_id for x in got if x.lang == "de") == [500, 501]
    assert len({(x.doc_id, x.windows) for x in got}) == 22
    assert langid.fit(df, 20).langs == ["de", "en"]


def test_learned_counts_and_limits_are_exact(spark, monkeypatch):
    """Byte pairs of whole texts and limits over all rows; shards do not depend on partitions."""
    r = np.random.default_rng(5)
    text = lambda v, n: " ".join(r.choice(v, n))
    rows = [(i, text(["the", "and", "of"], 10 + i), "en") for i in range(90)] + [(i, text(["der", "und", "für"], 10 + i), "de") for i in range(90, 180)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("half", F.expr("cast(doc_id % 2 as int)"))
    want = np.zeros((2, 65536))
    for i, t, lang in rows:
        for a, b in zip(t.encode(), t.encode()[1:]):
            want[int(lang == "en"), a * 256 + b] += 1
    n = want.reshape(2, 256, 256) + 0.02
    want = np.log(n / n.sum(axis=2, keepdims=True)).reshape(2, 65536)
    assert np.allclose(langid.pair_logs(langid.pair_counts(df), ["de", "en"], (0, 1)), want, atol=1e-5)
    values = [(k, float(x)) for k, m in ((0, 20), (1, 700), (2, 3), (3, 251)) for x in r.normal(-3, 2, m)]
    got = langid.quantiles_by_kind(spark.createDataFrame(values, "kind int, v double"), "v")
    own = lambda k: np.quantile([x for c, x in values if c == k], langid.LIMIT_SHARE, method="lower")
    assert got[0] == float("-inf") and np.allclose(got[1:], [own(1), own(1), own(3)], atol=1e-8)
    monkeypatch.setattr(langid, "SHARD_WINDOWS", 200)
    (a, *x), (b, *y) = langid.learn(df), langid.learn(df.repartition(5))
    assert x == y and (a.emb == b.emb).all() and (a.out == b.out).all() and (a.pairs == b.pairs).all()


def plain_steps(par, windows, labels, rng, epochs, batch, rate):
    """``descend`` written out: every position of every filter, every tap by itself."""
    _, embed, filters = par[2].shape
    mom = {n: (np.zeros_like(v), np.zeros_like(v)) for n, v in par.items()}
    x_all = np.concatenate([windows, np.zeros((len(windows), 3), windows.dtype)], axis=1)
    size, t = windows.shape[1], 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), batch):
            x, y = x_all[order[a:a + batch]].astype(np.int32), labels[order[a:a + batch]]
            best, where = [], []
            for w in langid.WIDTHS:
                h = sum((par["emb"] @ par[w][j]).take(x[:, j:j + size], axis=0) for j in range(w))
                where.append(h.argmax(axis=1))
                best.append(np.take_along_axis(h, where[-1][:, None], axis=1)[:, 0])
            pre = np.concatenate(best, axis=1) + par["bias"]
            h = np.maximum(pre, 0)
            z = h @ par["out"] + par["out_bias"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            p = z / z.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            grad = {n: np.zeros_like(v) for n, v in par.items()}
            grad["out"], grad["out_bias"] = h.T @ p, p.sum(axis=0)
            g = (p @ par["out"].T) * (pre > 0)
            grad["bias"] = g.sum(axis=0)
            for i, w in enumerate(langid.WIDTHS):
                gw = g[:, i * filters:(i + 1) * filters]
                for j in range(w):
                    byte = np.take_along_axis(x, where[i] + j, axis=1)
                    grad[w][j] = np.einsum("nfe,nf->ef", par["emb"][byte], gw)
                    cell = (byte[:, :, None] * embed + np.arange(embed)).ravel()
                    np.add.at(grad["emb"].reshape(-1), cell, (gw[:, :, None] * par[w][j].T[None]).ravel())
            t += 1
            for n, v in par.items():
                m, s = mom[n]
                m += 0.1 * (grad[n] - m)
                s += 0.001 * (grad[n] ** 2 - s)
                v -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)


def test_training_steps_equal_plain_ones_and_cost_less():
    """The same parameters to the last bit, any sizes, in well under the plain steps' CPU time."""
    r = np.random.default_rng(8)
    spent = {langid.descend: [], plain_steps: []}
    for n, size, embed, filters, batch, runs in ((70, 20, 5, 4, 64, 1), (9, 1, 8, 16, 4, 1), (130, 37, 8, 16, 64, 1), (3, 7, 2, 2, 64, 1), (1280, 128, 8, 16, 64, 5)):
        win, y = r.integers(0, 256 if n < 1000 else 60, (n, size)).astype(np.uint8), r.integers(0, 3, n)
        for _ in range(runs):
            got = {}
            for steps in spent:
                par, rng = langid.first_parameters(3, embed, filters)
                start = time.process_time()
                steps(par, win, y, rng, 1 if runs > 1 else 3, batch, 0.01)
                spent[steps].append(time.process_time() - start)
                got[steps] = par
            assert all(np.array_equal(v, got[plain_steps][k]) for k, v in got[langid.descend].items())
    fast, plain = (min(spent[steps][-5:]) for steps in (langid.descend, plain_steps))
    assert fast < 0.85 * plain
