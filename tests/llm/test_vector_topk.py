import numpy as np
import pytest

from qualmark.llm import vafile


def brute(rows, k):
    ok = [(i, np.floor(1024 * np.asarray(v, float)).astype(int)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ok = list({(i, tuple(v)): (i, v) for i, v in ok}.values())
    out = []
    for q, a in ok:
        if q % 100 == 0:
            s = sorted((-int(a @ b), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=10, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, ints int").repartition(3)
    return sorted(map(tuple, vafile.top_k(df, df.where("vec_id % 100 = 0"), k, **kw).collect()))


def test_equals_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(i, (r.normal(size=6) * r.choice([0.1, 1])).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)]                      # a vector many rows share, some of them queries
    rows += [(200, rows[200][1]), (2000, None), (2001, [0.1, None] * 3), (2002, [float("nan")] * 6), (2100, [float("inf")] * 6),
             (None, rows[1][1]), (2200, [1.0, 2.0]), (2201, [0.5, 0.5]), (2300, []), (2301, []), (2400, [0.5])]
    got = run(spark, rows)
    assert got == brute(rows, 10)
    assert run(spark, rows, first=1) == got


def test_large_components(spark):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=3) * 2.0 ** 17).astype(np.float32).tolist()) for i in range(300)]
    assert run(spark, rows, 3) == brute(rows, 3)


def test_overflow_raises(spark):
    with pytest.raises(Exception):
        run(spark, [(0, [3e25, 1.0]), (1, [3e25, 1.0])])


def test_huge_components_raise_instead_of_saturating(spark):
    with pytest.raises(Exception, match="leaves 64 bits"):
        run(spark, [(0, [0.0015, 0.0]), (1, [1e30, 0.0])])
    assert run(spark, [(0, [0.0015, 0.0]), (1, [1e15, 0.0])]) == [(0, 1, 1, 1024 * int(np.float32(1e15)))]


def test_many_blocks_of_rows_and_queries_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vafile, "ROW_BLOCK", 16)
    monkeypatch.setattr(vafile, "QUERY_BLOCK", 2)
    monkeypatch.setattr(vafile, "GROUP_BLOCKS", 2)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = np.random.default_rng(5)
        rows = [(i, (r.normal(size=4)).astype(np.float32).tolist()) for i in range(700)] + [(1000 + i, [0.5] * 3) for i in range(40)]
        assert run(spark, rows, 5) == brute(rows, 5)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_bounds_hold():
    r = np.random.default_rng(3)
    m = r.integers(-500, 500, (50, 4))
    inner = np.sort(r.integers(-500, 500, (vafile.CELLS - 1, 4)), axis=0)
    cells = np.stack([np.searchsorted(inner[:, j], m[:, j], side="right") for j in range(4)], axis=1)
    lo = np.clip(np.vstack([m.min(0)[None], inner]), m.min(0), m.max(0))
    hi = np.clip(np.vstack([inner - 1, m.max(0)[None]]), m.min(0), m.max(0))
    q = r.integers(-500, 500, (7, 4))
    low, up = vafile.score_bounds(q, cells, lo, hi)
    assert (low <= q @ m.T).all() and (q @ m.T <= up).all()
