"""Time our rewrites against the literal reference formulations, in Spark.

Usage: python tools/measure_rewrites.py [sf_dir]
Series are ``events.user_id`` (many series derived from the given table).
Prints one JSON line per comparison with both timings and whether results agree.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from qualmark.operators import counts as C  # noqa: E402
from qualmark.operators import density as KD  # noqa: E402
from qualmark.operators import limits as L  # noqa: E402
from qualmark.session import local_session  # noqa: E402

D = dt.date(2024, 1, 20)


def timed(build, repeats=2):
    """Best of ``repeats`` runs of building the DataFrame (multi-pass operators
    run jobs while building) and collecting it."""
    best = None
    for _ in range(repeats):
        t = time.perf_counter()
        spark_ = None
        rows = build().collect()
        dt_ = time.perf_counter() - t
        best = dt_ if best is None else min(best, dt_)
    return best, rows


def rounded(rows, digits=9):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in rows)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("gamecode", F.col("user_id").cast("string"))
    n_series = ev.select("user_id").distinct().count()

    # Seasonal neighbourhood, slot explode vs the literal OR-of-ranges join
    counts = C.null_count(ev, "ts", {"event_type": F.expr("nullif(event_type, 'error')")}, ["gamecode"])
    counts = counts.cache()
    counts.count()
    counts.createOrReplaceTempView("nc")
    ours_t, ours = timed(lambda: L.null_memo(counts, D).select("gamecode", "column", "bucket_dt", "p"))
    or_cond = " OR ".join(
        f"(t.bucket_dt - INTERVAL {k} DAY - INTERVAL 600 SECOND <= s.bucket_dt AND "
        f"s.bucket_dt <= t.bucket_dt - INTERVAL {k} DAY + INTERVAL 600 SECOND)" for k in range(4))
    lit_sql = (f"""
        SELECT t.gamecode, t.column, t.bucket_dt, SUM(s.null_count) / SUM(s.total_count) AS p
        FROM (SELECT * FROM nc WHERE bucket_dt >= '2024-01-17' AND bucket_dt < '2024-01-21') t
        JOIN (SELECT * FROM nc WHERE bucket_dt >= '2024-01-14' AND bucket_dt < '2024-01-21') s
          ON t.gamecode = s.gamecode AND t.column = s.column AND ({or_cond})
        GROUP BY t.gamecode, t.column, t.bucket_dt""")
    lit_t, lit_rows = timed(lambda: spark.sql(lit_sql))
    print(json.dumps({"compare": "E1 null_memo: slot explode vs OR join", "series": n_series,
                      "ours_sec": round(ours_t, 3), "literal_sec": round(lit_t, 3), "rows": len(ours),
                      "agree": rounded(ours) == rounded(lit_rows)}))

    # E1 on dense series: every bucket of every day is filled (series = event_type x 4 lags of data)
    dense = C.null_count(ev.withColumn("gamecode", F.col("event_type")), "ts",
                         {"user_id": F.expr("nullif(user_id % 7, 0)")}, ["gamecode"]).cache()
    dense.count()
    dense.createOrReplaceTempView("nc")
    ours_t, ours = timed(lambda: L.null_memo(dense, D).select("gamecode", "column", "bucket_dt", "p"))
    lit_t, lit_rows = timed(lambda: spark.sql(lit_sql))
    print(json.dumps({"compare": "E1 null_memo, dense series: slot explode vs OR join",
                      "series": dense.select("gamecode").distinct().count(),
                      "ours_sec": round(ours_t, 3), "literal_sec": round(lit_t, 3), "rows": len(ours),
                      "agree": rounded(ours) == rounded(lit_rows)}))

    # Trailing window vs self-join
    fc = C.freq_count(ev, "ts", ["event_type"], ["gamecode"]).cache()
    fc.count()
    fc.createOrReplaceTempView("fc")
    ours_t, ours = timed(lambda: L.freq_memo(fc, None).select("gamecode", "column", "dt", "class", "xi", "x"))
    lit_sql = ("""
        SELECT t1.gamecode, t1.column, t1.dt, t1.class, MAX(t1.cnt) AS xi, SUM(t2.cnt) AS x
        FROM fc t1 JOIN fc t2 ON t1.gamecode = t2.gamecode AND t1.column = t2.column AND t1.class = t2.class
         AND t2.dt >= date_sub(t1.dt, 3) AND t2.dt <= t1.dt
        GROUP BY t1.gamecode, t1.column, t1.dt, t1.class""")
    lit_t, lit_rows = timed(lambda: spark.sql(lit_sql))
    print(json.dumps({"compare": "E3 freq_memo: range window vs self-join", "series": n_series,
                      "ours_sec": round(ours_t, 3), "literal_sec": round(lit_t, 3), "rows": len(ours),
                      "agree": rounded(ours) == rounded(lit_rows)}))

    # every day's values against the previous day's model; moments + far passes vs cross join
    vals = ev.select(F.lit("events").alias("gamecode"), F.lit("value").alias("column"),
                     F.to_date("ts").alias("dt"), "value")
    models = KD.fit_kde(vals.withColumnRenamed("dt", "model_dt"), ["gamecode", "column", "model_dt"]).cache()
    models.count()
    ours_t, ours = timed(lambda: KD.score_day(models, vals, ["gamecode", "column"]).select("dt", "value", "log_density"))
    models.createOrReplaceTempView("m")
    vals.createOrReplaceTempView("v")
    lit_sql = ("""
        WITH q AS (SELECT DISTINCT dt, value FROM v WHERE value IS NOT NULL),
        e AS (SELECT q.dt, q.value, m.weight, -0.5 * (q.value - m.centre) * (q.value - m.centre) AS e
              FROM q JOIN m ON m.model_dt = date_sub(q.dt, 1)),
        mx AS (SELECT dt, value, MAX(e) AS mx, SUM(weight) AS n FROM e GROUP BY dt, value)
        SELECT e.dt, e.value, mx.mx + ln(SUM(e.weight * exp(e.e - mx.mx))) - ln(MAX(mx.n)) - 0.5 * ln(2 * pi())
        FROM e JOIN mx ON e.dt = mx.dt AND e.value = mx.value GROUP BY e.dt, e.value, mx.mx""")
    lit_t, lit_rows = timed(lambda: spark.sql(lit_sql))
    print(json.dumps({"compare": "F7 score_day: binned expansion vs cross join", "values": len(ours),
                      "ours_sec": round(ours_t, 3), "literal_sec": round(lit_t, 3),
                      "agree": rounded(ours, 6) == rounded(lit_rows, 6)}))


if __name__ == "__main__":
    main()
