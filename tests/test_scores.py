"""String profile, string scores, kernel density and score summaries."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qualmark.operators import counts as C
from qualmark.operators import density as KD
from qualmark.operators import strings as ST

KEYS = ["gamecode", "column"]


def codes_py(v, seq_len=16, size=128, overflow="mod"):
    out = []
    for b in v.encode("utf-8")[:seq_len]:
        if b < size:
            out.append(b)
        elif overflow == "mod":
            out.append(b % size)
        elif overflow == "drop":
            out.append(-1)
        else:
            out.append(32)
    return out


@pytest.mark.parametrize("overflow", ["mod", "drop", "space"])
def test_encode_positions(spark, overflow):
    vals = ["it's", "a\tb", "ñandú", "x" * 15, "y" * 16, "z" * 17, ""]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    got = {r.value: r.codes for r in ST.encode_positions(df, overflow=overflow).collect()}
    assert got == {v: codes_py(v, overflow=overflow) for v in vals}


def brute_scores(train, test, alpha=1.0, seq_len=16, size=128):
    n = len(train)
    cnt = {}
    for v in train:
        for i, c in enumerate(codes_py(v, seq_len)):
            cnt[(i, c)] = cnt.get((i, c), 0) + 1
    p0 = alpha / (n + 2 * alpha)
    out = {}
    for v in test:
        hot = {(i, c) for i, c in enumerate(codes_py(v, seq_len))}
        ll = 0.0
        for i in range(seq_len):
            for c in range(size):
                p = (cnt[(i, c)] + alpha) / (n + 2 * alpha) if (i, c) in cnt else p0
                ll += math.log(p) if (i, c) in hot else math.log(1 - p)
        out[v] = -ll
    return out


def test_string_scores_brute_force(spark):
    rnd = random.Random(5)
    train = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 18))) for _ in range(60)]
    test = list(set(train[:10])) + ["zzzz", "abca", "", "a'b\tc", "ñ"]
    tr = spark.createDataFrame([("g", "c", v) for v in train], "gamecode string, column string, value string")
    te = spark.createDataFrame([("g", "c", v) for v in test], "gamecode string, column string, value string")
    prof = ST.fit_string_profile(tr, KEYS, seq_len=16)
    got = {r.value: r.score for r in ST.score_strings(prof, te, KEYS, seq_len=16).collect()}
    want = brute_scores(train, test)
    assert set(got) == set(want)
    for v in want:
        assert got[v] == pytest.approx(want[v], rel=1e-10)
    # an unseen alphabet scores higher than a usual value of the same length
    assert got["zzzz"] > got["abca"]


def test_profile_mode_and_series_isolation(spark):
    rows = [("g", "a", "abc")] * 3 + [("g", "a", "abd")] + [("g", "b", "xy")] * 2
    df = spark.createDataFrame(rows, "gamecode string, column string, value string")
    prof = ST.fit_string_profile(df, KEYS)
    modes = {r.column: r.mode for r in ST.profile_mode(prof, KEYS).collect()}
    assert modes == {"a": "abc", "b": "xy"}
    only_a = ST.fit_string_profile(df.where("column = 'a'"), KEYS)
    assert {tuple(r) for r in only_a.collect()} == {tuple(r) for r in prof.where("column = 'a'").collect()}


def test_rank_anomalies(spark):
    df = spark.createDataFrame([("g", "a", "v%d" % i, float(i)) for i in range(10)] +
                               [("g", "b", "w%d" % i, float(-i)) for i in range(4)],
                               "gamecode string, column string, value string, score double")
    top = ST.rank_anomalies(df, 3, KEYS).collect()
    assert sorted((r.column, r.value, r["rank"]) for r in top) == [
        ("a", "v7", 3), ("a", "v8", 2), ("a", "v9", 1), ("b", "w0", 1), ("b", "w1", 2), ("b", "w2", 3)]
    glob = ST.rank_anomalies(df, 2).collect()
    assert [r.value for r in sorted(glob, key=lambda r: r["rank"])] == ["v9", "v8"]


def brute_kde(centres, x, h=1.0):
    c = np.array(centres, dtype=float)
    e = -0.5 * ((x - c) / h) ** 2
    m = e.max()
    return m + math.log(np.exp(e - m).sum()) - math.log(len(c)) - math.log(h) - 0.5 * math.log(2 * math.pi)


@pytest.mark.parametrize("h", [1.0, 0.3])
def test_kde_brute_force(spark, h):
    rnd = random.Random(9)
    centres = [rnd.gauss(50, 10) for _ in range(300)] + [rnd.gauss(500, 1) for _ in range(20)] + [50.0] * 5
    tests = [rnd.gauss(50, 12) for _ in range(200)] + [200.0, -1e4, 1e6, 520.0, 50.0]
    tr = spark.createDataFrame([("g", "v", str(c)) for c in centres], "gamecode string, column string, value string")
    te = spark.createDataFrame([("g", "v", str(x)) for x in tests] + [("g", "v", "abc"), ("g", "v", "NaN")],
                               "gamecode string, column string, value string")
    model = KD.fit_kde(tr, KEYS)
    assert model.agg(F.sum("weight")).first()[0] == len(centres)
    got = {r.value: r.log_density for r in KD.score_kde(model, te, KEYS, bandwidth=h).collect()}
    assert got["abc"] is None and got["NaN"] is None
    for x in tests:
        want = brute_kde(centres, x, h)
        assert got[str(x)] == pytest.approx(want, rel=1e-11, abs=1e-9), x


def test_score_day_uses_previous_day_model(spark):
    rows = [("g", "v", "2024-01-01", "1.0"), ("g", "v", "2024-01-02", "1.0"), ("g", "v", "2024-01-02", "5.0"),
            ("g", "v", "2024-01-03", "5.0")]
    df = spark.createDataFrame(rows, "gamecode string, column string, dt string, value string") \
        .withColumn("dt", F.to_date("dt"))
    models = KD.fit_kde(df.withColumnRenamed("dt", "model_dt"), KEYS + ["model_dt"])
    models = models.withColumn("version", F.lit(1)).unionByName(
        models.withColumn("version", F.lit(0)).withColumn("centre", F.col("centre") + 100))
    out = {(str(r.dt), r.value): r.log_density for r in KD.score_day(models, df, KEYS).collect()}
    assert set(out) == {("2024-01-02", "1.0"), ("2024-01-02", "5.0"), ("2024-01-03", "5.0")}
    assert out[("2024-01-02", "1.0")] == pytest.approx(brute_kde([1.0], 1.0))
    assert out[("2024-01-03", "5.0")] == pytest.approx(brute_kde([1.0, 5.0], 5.0))


def test_score_summary(spark):
    rows = [("g", "c", "alpha", 1.2), ("g", "c", "beta", 1.9), ("g", "c", "gamma", 1.0), ("g", "c", "delta", -0.5),
            ("g", "c", "eps", -0.1)]
    df = spark.createDataFrame(rows, "gamecode string, column string, value string, score double")
    out = {r["rank"]: (r["count"], r.sample) for r in
           C.score_summary(df, KEYS, sample_count=2, sample_length=3).collect()}
    assert out == {1: (3, "alp_|_bet"), -1: (2, "del_|_eps")}
    metrics = C.score_metrics(df, KEYS).first()
    assert metrics.distortion == pytest.approx(sum(r[3] for r in rows) / 5) and metrics.n == 5


def brute_latent(train, test, k=2):
    def vec(v):
        x = np.zeros(16 * 128)
        for i, c in enumerate(codes_py(v)):
            x[i * 128 + c] = 1
        return x
    X = np.array([vec(v) for v in train])
    mu = X.mean(axis=0)
    cov = (X - mu).T @ (X - mu) / len(train)
    vals, vecs = np.linalg.eigh(cov)
    top = vecs[:, np.argsort(vals)[::-1][:k]]
    out = {}
    for v in test:
        d = vec(v) - mu
        z = d @ top
        out[v] = (float(d @ d - z @ z), sorted(abs(z)))
    return out


def test_latent_scores_brute_force(spark):
    from qualmark.operators import latent as LT
    rnd = random.Random(3)
    train = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) + rnd.choice(["x", "yy", ""])
             for _ in range(80)]
    test = list(set(train[:15])) + ["zzz", "", "ñ"]
    tr = spark.createDataFrame([("g", "c", v) for v in train], "gamecode string, column string, value string")
    te = spark.createDataFrame([("g", "c", v) for v in test], "gamecode string, column string, value string")
    model = LT.fit_latent(tr, KEYS)
    got = {r.value: (r.score, sorted(abs(x) for x in r.z)) for r in LT.latent_scores(model, te, KEYS).collect()}
    want = brute_latent(train, test)
    assert set(got) == set(want)
    for v, (err, z) in want.items():
        assert got[v][0] == pytest.approx(err, rel=1e-8, abs=1e-9)
        assert got[v][1] == pytest.approx(z, rel=1e-6, abs=1e-8)


def test_latent_scores_of_whole_values_and_many_series(spark, monkeypatch):
    """Values that differ behind byte 16, a series without variance, one of empty strings, a NULL key."""
    from qualmark.operators import latent as LT
    rnd = random.Random(5)
    long = ["x" * 16 + rnd.choice(["A", "BB", "<script>", ""]) + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))) for _ in range(60)]
    rows = [(None, "long", v) for v in long] + [("g", "flat", "same")] * 5 + [("g", "empty", "")] * 3
    tr = spark.createDataFrame(rows, "gamecode string, column string, value string")
    te = tr.unionByName(spark.createDataFrame([(None, "long", "x" * 16 + "Q" * 40), ("g", "flat", "sameX"), ("g", "empty", "ab"), ("h", "none", "v")], tr.schema))
    model = LT.fit_latent(tr, KEYS)
    got = {(r.column, r.value): r for r in LT.latent_scores(model, te, KEYS).collect()}
    assert len(got) == len(set(long)) + 1 + 2 + 2
    assert got["flat", "same"].score == pytest.approx(0) and got["flat", "sameX"].score == pytest.approx(1)
    assert got["empty", ""].score == 0 and got["empty", "ab"].score == 2
    m = max(len(v) for v in long)
    X = np.zeros((len(long), m * 128))
    for i, v in enumerate(long):
        for j, c in enumerate(v.encode()):
            X[i, j * 128 + c] = 1
    mu = X.mean(axis=0)
    vals, vecs = np.linalg.eigh((X - mu).T @ (X - mu) / len(long))
    z = (X - mu) @ vecs[:, ::-1][:, :2]
    for i, v in enumerate(long):
        assert got["long", v].score == pytest.approx(((X[i] - mu) ** 2).sum() - (z[i] ** 2).sum(), abs=1e-9)
        assert sorted(abs(x) for x in got["long", v].z) == pytest.approx(sorted(abs(z[i])), abs=1e-9)
    assert len({round(got["long", "x" * 16 + e].score, 6) for e in ("A", "BB", "<script>") if ("long", "x" * 16 + e) in got}) == \
        sum(("long", "x" * 16 + e) in got for e in ("A", "BB", "<script>"))
    plan = LT._product(*[spark.createDataFrame([], s) for s in ("__sid long, gamecode string, column string, __cells array<int>, __n long",
                       "gamecode string, column string, cell int, mu double, __tot long, __low double, v0 double")], KEYS, 1, "merge")
    assert "Pandas" not in plan._jdf.queryExecution().executedPlan().toString()


def test_pad_md5_reproduces_reference_encoding(spark):
    import hashlib
    df = spark.createDataFrame([("ab",), ("abcdefghijklmnopq",)], "value string")
    got = {r.value: r.codes for r in ST.encode_positions(df, pad_md5=True).collect()}
    for v in ("ab", "abcdefghijklmnopq"):
        assert got[v] == codes_py(v + "\t" + hashlib.md5(v.encode()).hexdigest())


def test_large_model_path_gives_same_scores(spark, monkeypatch):
    """Above the broadcast limit the model joins by sort-merge; results must not change."""
    import qualmark.session as SS
    rnd = random.Random(4)
    centres = [rnd.gauss(0, 3) for _ in range(120)]
    tests = [rnd.gauss(0, 4) for _ in range(40)] + [60.0]
    tr = spark.createDataFrame([("g", "v", str(c)) for c in centres], "gamecode string, column string, value string")
    te = spark.createDataFrame([("g", "v", str(x)) for x in tests], "gamecode string, column string, value string")
    monkeypatch.setattr(SS, "BROADCAST_MAX_BYTES", 0)
    got = {r.value: r.log_density for r in KD.score_kde(KD.fit_kde(tr, KEYS), te, KEYS).collect()}
    for x in tests:
        assert got[str(x)] == pytest.approx(brute_kde(centres, x), rel=1e-11, abs=1e-9)
    words = ["abc", "abd", "xyz", "abca"]
    sv = spark.createDataFrame([("g", "c", w) for w in words], "gamecode string, column string, value string")
    small = {r.value: r.score for r in ST.score_strings(ST.fit_string_profile(sv, KEYS, seq_len=16), sv, KEYS, seq_len=16).collect()}
    want = brute_scores(words, words)
    assert all(small[w] == pytest.approx(want[w], rel=1e-10) for w in words)


def test_string_scores_see_whole_values(spark):
    train = ["aaaaaaaaaaaaaaaaXX", "aaaaaaaaaaaaaaaaXY", "bb"]
    test = ["aaaaaaaaaaaaaaaaXX", "aaaaaaaaaaaaaaaa<script>%%%", "aaaaaaaaaaaaaaaaXX%", ""]
    frame = lambda vs: spark.createDataFrame([("g", None, v) for v in vs], "gamecode string, column string, value string")
    got = {r.value: r.score for r in ST.score_strings(ST.fit_string_profile(frame(train), KEYS), frame(test), KEYS).collect()}
    assert len(got) == 4                                              # a NULL in the series key is a series like any other
    assert got[test[1]] > got[test[2]] > got[test[0]]
    want = brute_scores(train, test[:1], seq_len=18)
    assert got[test[0]] == pytest.approx(want[test[0]], rel=1e-10)


@pytest.mark.parametrize("h", [1.0, 0.3, 7.0])
def test_kde_far_and_huge_values(spark, h):
    rnd = random.Random(9)
    centres = [rnd.gauss(0, 30) for _ in range(150)] + [1000.0, 1000.01, 1e5, 1e19, 1e19 + 1e4, -1e15, 1e300, -3e16, -3e16 + 4]
    tests = [rnd.gauss(0, 60) for _ in range(60)] + [rnd.uniform(900, 1e5) for _ in range(20)] + [
        1e19, 1e21, -1e21, 2.0 ** 53, -3e16 + 2, 1e150, -1e15 + 30, -1e15 - 11]
    m = spark.createDataFrame([("g", None, c, 1) for c in centres], "gamecode string, column string, centre double, weight bigint")
    t = spark.createDataFrame([("g", None, x) for x in tests] + [("g", None, 1e300), ("g", None, float("nan")), ("z", None, 1.0)],
                              "gamecode string, column string, value double")
    got = {repr(r.value): r.log_density for r in KD.score_kde(m, t, KEYS, bandwidth=h).collect()}
    assert len(got) == len(tests) + 2 and got["nan"] is None
    for x in tests:
        e = [-0.5 * ((x - c) / h) ** 2 for c in centres if abs(x - c) / h < 1e153]
        want = max(e) + math.log(math.fsum(math.exp(v - max(e)) for v in e)) - math.log(len(centres) * h) - 0.5 * math.log(2 * math.pi)
        assert got[repr(x)] == pytest.approx(want, rel=1e-9), x
