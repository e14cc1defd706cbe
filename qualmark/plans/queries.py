"""Registered queries over the driver's test tables, with their DuckDB oracles.

Each ``q_*`` builder takes ``(spark, sf_dir)`` and returns a DataFrame that
reads the whole input tables. ``ORACLE`` holds, per query, an independent SQL
formulation for DuckDB: the seasonal neighbourhood as lookups of time slots and
(``null_memo_effective``) as the literal OR-of-ranges join, the trailing window as
lookups of days, the kernel density as the full cross join - so the oracle does not
share our rewrites. Doubles are rounded to 6 digits on both sides (sums in a
different order differ in the last bits).

Series of the test data (keys ``gamecode, column``):

* null checks: ``events`` with ``event_type`` made NULL where it is 'error',
  and ``props`` (never NULL: p = 0, so z and the threshold are NULL)
* frequency checks: ``events.event_type`` per day and ``orders.o_orderpriority``
  per order date
* rules / strings: ``part`` columns; samples: ``orders``, ``part``, ``customer``
* kernel density: ``events.value``, model of day D-1 scores day D
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators import counts as C
from ..operators import density as KD
from ..operators import limits as L
from ..operators import rules as R
from ..operators import sampling as S
from ..operators import strings as ST
from ..sources import readers as RD
from ..sources import sinks as SK
from ..session import materialize, scratch_path

# Fixed parameters of the registered queries.
AS_OF = _dt.date(2024, 1, 20)          # target day D of the daily checks
ORDER_DAY = _dt.date(1999, 6, 14)      # target day of the order checks (orders end in 2001)
ALERT_DAY = _dt.date(2024, 1, 24)      # "today" of the frequency alert view
REGDATETIME = "2024-01-21 00:00:00"    # registration time stamped on rule rows
SEED = "qualmark"
KEYS = ["gamecode", "column"]
DIGITS = 6


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _round(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# --------------------------------------------------------------- null checks
def null_columns() -> dict:
    """Checked columns: ``event_type`` with 'error' read as NULL, and ``props``."""
    return {"event_type": F.expr("nullif(event_type, 'error')"), "props": F.col("props")}


def null_counts(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events").withColumn("gamecode", F.lit("events"))
    return C.null_count(ev, "ts", null_columns(), keys=["gamecode"])


def _events(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "events").withColumn("gamecode", F.lit("events"))


def null_memo_df(spark, sf_dir) -> DataFrame:
    # the memo reads source days [D-6, D]; cut the raw rows on ts so the range reaches the scan
    raw = RD.read_dated(_events(spark, sf_dir), AS_OF, 6, ts="ts")
    return L.null_memo(C.null_count(raw, "ts", null_columns(), keys=["gamecode"]), AS_OF, KEYS)


def null_threshold_df(spark, sf_dir) -> DataFrame:
    from .checks import null_check_day
    return null_check_day(_events(spark, sf_dir), "ts", null_columns(), AS_OF, ["gamecode"])


def q_null_count(spark, sf_dir):
    return null_counts(spark, sf_dir)


def q_null_memo(spark, sf_dir):
    return _round(null_memo_df(spark, sf_dir))


def q_null_memo_effective(spark, sf_dir):
    """The reference's effective form: lags 1..3, left edge open."""
    raw = RD.read_dated(_events(spark, sf_dir), AS_OF, 6, ts="ts")
    memo = L.null_memo(C.null_count(raw, "ts", null_columns(), keys=["gamecode"]), AS_OF, KEYS,
                       lags=(1, 2, 3), left_closed=False)
    return _round(memo)


def q_null_threshold(spark, sf_dir):
    return _round(null_threshold_df(spark, sf_dir).select(*KEYS, "bucket_dt", "threshold"))


def q_null_alerts(spark, sf_dir):
    from .checks import null_alert_day
    return _round(null_alert_day(_events(spark, sf_dir), "ts", null_columns(), AS_OF, ["gamecode"]))


def q_compute_null_threshold(spark, sf_dir):
    from .checks import compute_null_threshold
    raw = RD.read_dated(_events(spark, sf_dir), AS_OF, 7, ts="ts")       # the plan's source days, cut before the count
    counts = C.null_count(raw, "ts", null_columns(), keys=["gamecode"])
    return _round(compute_null_threshold(counts, AS_OF, KEYS).select(
        *KEYS, "bucket_dt", "threshold"))


def q_compute_null_count(spark, sf_dir):
    from .checks import compute_null_count
    ev = _t(spark, sf_dir, "events").withColumn("gamecode", F.lit("events"))
    return compute_null_count(ev, "ts", null_columns(), AS_OF, keys=["gamecode"])


_NC_SQL = """
nc AS (
  SELECT 'events' AS gamecode, 'event_type' AS "column", time_bucket(INTERVAL '10 minutes', ts) AS bucket_dt,
         CAST(SUM(CASE WHEN NULLIF(event_type, 'error') IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
         CAST(COUNT(*) AS BIGINT) AS total_count
  FROM events GROUP BY 3
  UNION ALL
  SELECT 'events', 'props', time_bucket(INTERVAL '10 minutes', ts),
         CAST(SUM(CASE WHEN props IS NULL THEN 1 ELSE 0 END) AS BIGINT), CAST(COUNT(*) AS BIGINT)
  FROM events GROUP BY 3
)"""


# Oracle of the seasonal statistics: each series becomes one map from slot
# number (600 s) to its row, and a statistic of bucket t is a list function over
# the map's values at the neighbour slots t - 144 k + j.
def _memo_sql(lags=(0, 1, 2, 3), left_closed=True) -> str:
    back = [144 * k + j for k in lags for j in ((-1, 0, 1) if left_closed else (-1, 0))]
    return f"""
slots AS (
  SELECT gamecode, "column", CAST(epoch(bucket_dt) // 600 AS BIGINT) AS slot, bucket_dt, null_count AS x, total_count AS n
  FROM nc WHERE bucket_dt >= TIMESTAMP '2024-01-14' AND bucket_dt < TIMESTAMP '2024-01-21'
),
by_slot AS (
  SELECT gamecode, "column", map_from_entries(list(row(slot, x))) AS xs, map_from_entries(list(row(slot, n))) AS ns
  FROM slots GROUP BY ALL
),
pooled AS (
  SELECT gamecode, "column", slot, bucket_dt, x AS xi, n AS ni,
         list_sum(list_transform({back}, lambda d: xs[slot - d])) AS all_x,
         list_sum(list_transform({back}, lambda d: ns[slot - d])) AS all_n
  FROM slots NATURAL JOIN by_slot WHERE bucket_dt >= TIMESTAMP '2024-01-17'
),
memo AS (
  SELECT gamecode, "column", slot, bucket_dt, xi, ni, xi / NULLIF(ni, 0) AS pi, all_x / NULLIF(all_n, 0) AS p,
         sqrt(p * (1 - p) / NULLIF(ni, 0)) AS sigma_pi, (pi - p) / NULLIF(sigma_pi, 0) AS zi
  FROM pooled WHERE all_n IS NOT NULL
)"""


_THRESHOLD_SQL = f"""
thr AS (
  SELECT gamecode, "column", slot, bucket_dt,
         p + 3 * sigma_pi * list_stddev_pop(list_transform({[144 * k + j for k in range(4) for j in (-1, 0, 1)]},
                                                           lambda d: zs[slot - d])) AS threshold
  FROM memo NATURAL JOIN (SELECT gamecode, "column", map_from_entries(list(row(slot, zi))) AS zs FROM memo GROUP BY ALL)
  WHERE bucket_dt >= TIMESTAMP '2024-01-20'
)"""

_MEMO_COLS = ("gamecode, \"column\", bucket_dt, xi, ni, ROUND(pi, 6) AS pi, ROUND(p, 6) AS p, "
              "ROUND(sigma_pi, 6) AS sigma_pi, ROUND(zi, 6) AS zi")

ORACLE = {}
ORACLE["null_count"] = f"WITH {_NC_SQL} SELECT * FROM nc"
ORACLE["null_memo"] = f"WITH {_NC_SQL}, {_memo_sql()} SELECT {_MEMO_COLS} FROM memo"
# the neighbourhood as the literal join on ranges of time: it shares no grid with the engine
ORACLE["null_memo_effective"] = f"""WITH {_NC_SQL},
met AS (
  SELECT t.gamecode, t."column", t.bucket_dt, any_value(t.null_count) AS xi, any_value(t.total_count) AS ni,
         sum(s.null_count) / sum(s.total_count) AS p
  FROM nc t JOIN nc s ON s.gamecode = t.gamecode AND s."column" = t."column" AND ({" OR ".join(
      f"(s.bucket_dt > t.bucket_dt - INTERVAL {k} DAY - INTERVAL 600 SECOND AND s.bucket_dt <= t.bucket_dt - INTERVAL {k} DAY + INTERVAL 600 SECOND)"
      for k in (1, 2, 3))})
  WHERE t.bucket_dt >= TIMESTAMP '2024-01-17' AND t.bucket_dt < TIMESTAMP '2024-01-21'
    AND s.bucket_dt >= TIMESTAMP '2024-01-14' AND s.bucket_dt < TIMESTAMP '2024-01-21'
  GROUP BY 1, 2, 3),
memo AS (SELECT *, xi / ni AS pi, sqrt(p * (1 - p) / ni) AS sigma_pi, (xi / ni - p) / NULLIF(sqrt(p * (1 - p) / ni), 0) AS zi FROM met)
SELECT {_MEMO_COLS} FROM memo"""
ORACLE["null_threshold"] = (f"WITH {_NC_SQL}, {_memo_sql()}, {_THRESHOLD_SQL} "
                            "SELECT gamecode, \"column\", bucket_dt, ROUND(threshold, 6) AS threshold FROM thr")
ORACLE["compute_null_threshold"] = ORACLE["null_threshold"]
ORACLE["null_alerts"] = f"""WITH {_NC_SQL}, {_memo_sql()}, {_THRESHOLD_SQL},
limits AS (SELECT gamecode, "column", map_from_entries(list(row(slot + 144, threshold))) AS due FROM thr GROUP BY ALL),
rates AS (
  SELECT gamecode, "column", bucket_dt, CAST(epoch(bucket_dt) // 600 AS BIGINT) AS slot,
         ROUND(null_count / NULLIF(total_count, 0), 9) AS score FROM nc
)
SELECT gamecode, "column", bucket_dt, ROUND(COALESCE(due[slot], 0), 6) AS threshold, ROUND(score, 6) AS score,
       ROUND(IF(score > COALESCE(due[slot], 0), -score, NULL), 6) AS alert
FROM rates NATURAL JOIN limits WHERE map_contains(due, slot)"""
ORACLE["compute_null_count"] = (f"WITH {_NC_SQL} SELECT * FROM nc WHERE bucket_dt >= TIMESTAMP '2024-01-20' "
                                "AND bucket_dt < TIMESTAMP '2024-01-21'")


# ---------------------------------------------------------- frequency checks
def freq_counts(spark, sf_dir) -> DataFrame:
    """Daily class counts of both series."""
    return _event_counts(spark, sf_dir).unionByName(_order_counts(spark, sf_dir))


def _event_counts(spark, sf_dir) -> DataFrame:
    return C.freq_count(_events(spark, sf_dir), "ts", ["event_type"], keys=["gamecode"])


def _order_counts(spark, sf_dir) -> DataFrame:
    return C.freq_count(_t(spark, sf_dir, "orders").withColumn("gamecode", F.lit("orders")), "o_orderdate",
                        ["o_orderpriority"], keys=["gamecode"])


def freq_thresholds_all(spark, sf_dir) -> DataFrame:
    memo = materialize(L.freq_memo(freq_counts(spark, sf_dir), None, KEYS), "freq_memo")     # read twice by the rates
    return L.freq_threshold(L.freq_rates(memo, KEYS), None, KEYS)


def q_freq_count(spark, sf_dir):
    return freq_counts(spark, sf_dir)


def q_day_totals(spark, sf_dir):
    return _round(C.day_totals(freq_counts(spark, sf_dir), KEYS))


def q_freq_memo(spark, sf_dir):
    return L.freq_memo(freq_counts(spark, sf_dir), None, KEYS)


def q_freq_rates(spark, sf_dir):
    return _round(L.freq_rates(L.freq_memo(freq_counts(spark, sf_dir), None, KEYS), KEYS))


def q_freq_threshold(spark, sf_dir):
    return _round(freq_thresholds_all(spark, sf_dir).select(*KEYS, "dt", "class", "lowerbound", "upperbound"))


def q_freq_threshold_day(spark, sf_dir):
    """``events`` from the raw logs of its days, ``orders`` from its day counts."""
    from .checks import compute_freq_threshold, freq_check_day
    ev = freq_check_day(_events(spark, sf_dir), "ts", ["event_type"], AS_OF, ["gamecode"])
    od = compute_freq_threshold(_order_counts(spark, sf_dir), ORDER_DAY, KEYS)
    out = ev.unionByName(od)
    return _round(out.select(*KEYS, "dt", "class", "lowerbound", "upperbound"))


def q_freq_alerts(spark, sf_dir):
    """The alert view of either series on its own "today"."""
    out = None
    ev = _event_counts(spark, sf_dir)
    for counts, today in ((ev, ALERT_DAY), (_order_counts(spark, sf_dir), ORDER_DAY + _dt.timedelta(days=1))):
        # limits are needed for days > A-5; each reads rates of [d-3, d], each rate
        # counts of [d-3, d]: counts from A-10 on give exactly those limits (a day
        # filter cannot pass through the windows' ordering column by itself)
        counts = materialize(counts.where(F.col("dt").between(F.date_sub(F.lit(today), 10), F.lit(today))), "recent_counts")
        memo = materialize(L.freq_memo(counts, None, KEYS), "freq_memo")
        thresholds = L.freq_threshold(L.freq_rates(memo, KEYS), None, KEYS)
        part = L.freq_alerts(counts, thresholds, today, KEYS)
        out = part if out is None else out.unionByName(part)
    return _round(out.select(*KEYS, "dt", "class", "pi", "lowerbound", "upperbound", "alert"))


def q_compute_freq_count(spark, sf_dir):
    from .checks import compute_freq_count
    ev = _t(spark, sf_dir, "events").withColumn("gamecode", F.lit("events"))
    return compute_freq_count(ev, "ts", ["event_type"], AS_OF, keys=["gamecode"])


_FC_SQL = """
fc AS (
  SELECT 'events' AS gamecode, 'event_type' AS "column", CAST(ts AS DATE) AS dt, event_type AS class,
         CAST(COUNT(*) AS BIGINT) AS cnt
  FROM events WHERE event_type IS NOT NULL GROUP BY 3, 4
  UNION ALL
  SELECT 'orders', 'o_orderpriority', CAST(o_orderdate AS DATE), o_orderpriority, CAST(COUNT(*) AS BIGINT)
  FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 3, 4
)"""


# Oracle of the class limits: each class becomes one map from day to count (or
# z), and trailing statistics are list functions over the last four days' values.
_FREQ_SQL = """
days AS (SELECT gamecode, "column", class, map_from_entries(list(row(dt, cnt))) AS by_day FROM fc GROUP BY ALL),
fmemo AS (
  SELECT gamecode, "column", dt, class, cnt AS xi,
         CAST(list_sum(list_transform([0, 1, 2, 3], lambda k: by_day[dt - CAST(k AS INTEGER)])) AS BIGINT) AS x
  FROM fc NATURAL JOIN days
),
frates AS (
  SELECT *, CAST(SUM(xi) OVER d AS BIGINT) AS ni, CAST(SUM(x) OVER d AS BIGINT) AS n, xi / NULLIF(ni, 0) AS pi, x / NULLIF(n, 0) AS p,
         sqrt(p * (1 - p) / NULLIF(ni, 0)) AS sigma_pi, (pi - p) / NULLIF(sigma_pi, 0) AS zi
  FROM fmemo WINDOW d AS (PARTITION BY gamecode, "column", dt)
),
zs AS (SELECT gamecode, "column", class, map_from_entries(list(row(dt, zi))) AS by_day FROM frates GROUP BY ALL),
fthr AS (
  SELECT gamecode, "column", dt, class, 6 * sigma_pi * list_stddev_pop(list_transform([0, 1, 2, 3],
           lambda k: by_day[dt - CAST(k AS INTEGER)])) AS band, p - band AS lowerbound, p + band AS upperbound
  FROM frates NATURAL JOIN zs
)"""


_FREQ_DAYS = "(gamecode = 'events' AND dt = DATE '2024-01-20') OR (gamecode = 'orders' AND dt = DATE '1999-06-14')"
_FTHR_COLS = "gamecode, \"column\", dt, class, ROUND(lowerbound, 6) AS lowerbound, ROUND(upperbound, 6) AS upperbound"
ORACLE["freq_count"] = f"WITH {_FC_SQL} SELECT * FROM fc"
ORACLE["day_totals"] = f"""WITH {_FC_SQL}
SELECT fc.gamecode, fc."column", fc.dt, fc.class, fc.cnt, t.day_total, ROUND(fc.cnt / NULLIF(t.day_total, 0), 6) AS share
FROM fc JOIN (SELECT gamecode, "column", dt, CAST(SUM(cnt) AS BIGINT) AS day_total FROM fc GROUP BY 1, 2, 3) t
  ON fc.gamecode = t.gamecode AND fc."column" = t."column" AND fc.dt = t.dt"""
ORACLE["freq_memo"] = f"WITH {_FC_SQL}, {_FREQ_SQL} SELECT * FROM fmemo"
ORACLE["freq_rates"] = f"""WITH {_FC_SQL}, {_FREQ_SQL}
SELECT gamecode, "column", dt, class, xi, x, ni, n, ROUND(pi, 6) AS pi, ROUND(p, 6) AS p,
       ROUND(sigma_pi, 6) AS sigma_pi, ROUND(zi, 6) AS zi FROM frates"""
ORACLE["freq_threshold"] = f"WITH {_FC_SQL}, {_FREQ_SQL} SELECT {_FTHR_COLS} FROM fthr"
ORACLE["freq_threshold_day"] = f"WITH {_FC_SQL}, {_FREQ_SQL} SELECT {_FTHR_COLS} FROM fthr WHERE {_FREQ_DAYS}"
ORACLE["freq_alerts"] = f"""WITH {_FC_SQL}, {_FREQ_SQL},
yesterday AS (SELECT gamecode, "column", dt + 1 AS dt, class, lowerbound, upperbound FROM fthr),
shares AS (
  SELECT gamecode, "column", dt, class, ROUND(cnt / NULLIF(SUM(cnt) OVER (PARTITION BY gamecode, "column", dt), 0), 9) AS pi FROM fc
)
SELECT gamecode, "column", dt, class, ROUND(pi, 6) AS pi, ROUND(lowerbound, 6) AS lowerbound, ROUND(upperbound, 6) AS upperbound,
       CAST(COALESCE(NOT pi BETWEEN lowerbound AND upperbound, FALSE) AS INTEGER) AS alert
FROM shares NATURAL JOIN yesterday
WHERE (gamecode = 'events' AND dt BETWEEN DATE '2024-01-21' AND DATE '2024-01-24')
   OR (gamecode = 'orders' AND dt BETWEEN DATE '1999-06-12' AND DATE '1999-06-15')"""
ORACLE["compute_freq_count"] = (f"WITH {_FC_SQL} SELECT * FROM fc WHERE gamecode = 'events' "
                                "AND dt = DATE '2024-01-20'")


# ------------------------------------------------------- filters, date ranges
def q_date_range(spark, sf_dir):
    return R.date_range(_t(spark, sf_dir, "events"), "ts", AS_OF, -3, 1).select("event_id", "ts", "event_type")


def q_read_dated(spark, sf_dir):
    return RD.read_dated(_t(spark, sf_dir, "events"), AS_OF, 7, ts="ts").select("event_id", "ts", "value")


def q_not_null(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return R.not_null(ev, "event_type").select("event_id", "event_type")


def q_tag_series(spark, sf_dir):
    pt = S.distinct_values(_t(spark, sf_dir, "part"), "p_type")
    return R.tag_series(pt, {"gamecode": "part", "column": "p_type"}).select("gamecode", "column", "p_type")


ORACLE["date_range"] = ("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-17' "
                        "AND ts < TIMESTAMP '2024-01-21'")
ORACLE["read_dated"] = ("SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-13' "
                        "AND ts < TIMESTAMP '2024-01-21'")
ORACLE["not_null"] = ("SELECT event_id, NULLIF(event_type, 'error') AS event_type FROM events "
                      "WHERE NULLIF(event_type, 'error') IS NOT NULL")
ORACLE["tag_series"] = "SELECT DISTINCT 'part' AS gamecode, 'p_type' AS \"column\", p_type FROM part WHERE p_type IS NOT NULL"


# ------------------------------------------------------------------- rules
def rule_values(spark, sf_dir) -> DataFrame:
    """Distinct values of several part columns as text, one series per column, and
    a derived series of texts that only look like numbers (or do not, but are)."""
    part = _t(spark, sf_dir, "part")
    parts = []
    size = F.col("p_size").cast("string")
    odd = (F.when(F.col("p_partkey") % 5 == 0, F.lit("NaN")).when(F.col("p_partkey") % 5 == 1, F.lit("-inf"))
           .when(F.col("p_partkey") % 5 == 2, F.concat(size, F.lit("50d"))).when(F.col("p_partkey") % 5 == 3, F.concat(size, F.lit("e3")))
           .otherwise(F.concat(F.lit("-."), size)))
    for c, v in (("p_size", size), ("p_retailprice", F.col("p_retailprice").cast("string")), ("p_brand", F.col("p_brand")),
                 ("p_type", F.col("p_type")), ("odd_numbers", odd)):
        parts.append(part.select(F.lit("part").alias("gamecode"), F.lit(c).alias("column"), v.alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("value").isNotNull()).distinct()


_RV_SQL = """
rv0 AS (
  SELECT DISTINCT 'part' AS gamecode, 'p_size' AS "column", CAST(p_size AS VARCHAR) AS value FROM part WHERE p_size IS NOT NULL
  UNION SELECT DISTINCT 'part', 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part WHERE p_retailprice IS NOT NULL
  UNION SELECT DISTINCT 'part', 'p_brand', p_brand FROM part WHERE p_brand IS NOT NULL
  UNION SELECT DISTINCT 'part', 'p_type', p_type FROM part WHERE p_type IS NOT NULL
  UNION SELECT DISTINCT 'part', 'odd_numbers', CASE p_partkey % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN '-inf' WHEN 2 THEN p_size || '50d'
    WHEN 3 THEN p_size || 'e3' ELSE '-.' || p_size END FROM part
),
rv AS (
  SELECT *, CASE WHEN regexp_full_match(value, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(value AS DOUBLE) END AS x
  FROM rv0
)"""


def q_rule_passthrough(spark, sf_dir):
    out = R.rule_passthrough(rule_values(spark, sf_dir), "value", KEYS, regdatetime=REGDATETIME, dt=AS_OF)
    return out.withColumn("rules", F.array_join("rules", ","))


def q_rule_length(spark, sf_dir):
    return R.rule_length(rule_values(spark, sf_dir), "value", KEYS, max_len=1, regdatetime=REGDATETIME, dt=AS_OF)


def q_rule_min_max(spark, sf_dir):
    return R.rule_min_max(rule_values(spark, sf_dir), "value", KEYS, regdatetime=REGDATETIME, dt=AS_OF)


def q_rule_min_only(spark, sf_dir):
    return R.rule_min_max(rule_values(spark, sf_dir), "value", KEYS, min_value=10, max_value=None,
                          regdatetime=REGDATETIME, dt=AS_OF)


ORACLE["rule_passthrough"] = (f"WITH {_RV_SQL} SELECT gamecode, \"column\", value AS data, '0' AS rules, "
                              f"TIMESTAMP '{REGDATETIME}' AS regdatetime, DATE '{AS_OF}' AS dt FROM rv")
ORACLE["rule_length"] = (f"WITH {_RV_SQL} SELECT gamecode, \"column\", value AS data, 1 AS \"range\", "
                         f"TIMESTAMP '{REGDATETIME}' AS regdatetime, DATE '{AS_OF}' AS dt FROM rv WHERE length(value) <= 1")
ORACLE["rule_min_max"] = (f"WITH {_RV_SQL} SELECT gamecode, \"column\", value AS data, CAST(10 AS DOUBLE) AS min, CAST(100 AS DOUBLE) AS max, "
                          f"TIMESTAMP '{REGDATETIME}' AS regdatetime, DATE '{AS_OF}' AS dt FROM rv "
                          "WHERE x < 10 OR x > 100")
ORACLE["rule_min_only"] = (f"WITH {_RV_SQL} SELECT gamecode, \"column\", value AS data, CAST(10 AS DOUBLE) AS min, "
                           f"CAST(NULL AS DOUBLE) AS max, TIMESTAMP '{REGDATETIME}' AS regdatetime, DATE '{AS_OF}' AS dt FROM rv "
                           "WHERE x < 10")


# --------------------------------------------------------- sampling, copies
def q_sample_rows(spark, sf_dir):
    return S.sample_rows(_t(spark, sf_dir, "orders"), "o_totalprice", 100, key=["o_orderkey"], seed=SEED)


def q_sample_per_series(spark, sf_dir):
    return S.sample_per_series(_t(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", 40,
                               key=["o_orderkey"], seed=SEED)


def q_sample_rows_md5(spark, sf_dir):
    return S.sample_rows_md5(_t(spark, sf_dir, "part"), "p_name", 50, key=["p_partkey"], seed=SEED)


def q_distinct_values(spark, sf_dir):
    return S.distinct_values(_t(spark, sf_dir, "part"), "p_type")


def q_distinct_values_md5(spark, sf_dir):
    return S.distinct_values_md5(_t(spark, sf_dir, "part"), "p_brand")


def q_extract(spark, sf_dir):
    return S.extract(_t(spark, sf_dir, "customer"), "c_mktsegment", kind="train", size=20, md5=True,
                     key=["c_custkey"], seed=SEED)


def q_extract_all(spark, sf_dir):
    return S.extract(_t(spark, sf_dir, "customer"), "c_mktsegment", kind="test", size=-1, md5=True)


def q_copy_table(spark, sf_dir):
    return S.copy_table(_t(spark, sf_dir, "orders"), limit=100, order_by=["o_orderkey"])


def q_page_by_row_number(spark, sf_dir):
    return S.page_by_row_number(_t(spark, sf_dir, "orders"), ["o_orderkey"], 100, 199)


ORACLE["sample_rows"] = (f"SELECT o_totalprice FROM orders WHERE o_totalprice IS NOT NULL "
                         f"ORDER BY md5('{SEED}' || '|' || length(CAST(o_orderkey AS VARCHAR)) || ':' || CAST(o_orderkey AS VARCHAR)), o_totalprice LIMIT 100")
ORACLE["sample_per_series"] = (f"SELECT o_orderpriority, o_totalprice FROM (SELECT o_orderpriority, o_totalprice, "
                               f"ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY md5('{SEED}' || '|' || length(CAST(o_orderkey AS VARCHAR)) || ':' || CAST(o_orderkey AS VARCHAR)), o_totalprice) AS rn FROM orders "
                               "WHERE o_totalprice IS NOT NULL) x WHERE rn <= 40")
ORACLE["sample_rows_md5"] = (f"SELECT p_name, md5(p_name) AS md5 FROM (SELECT p_name FROM part WHERE p_name IS NOT NULL "
                             f"ORDER BY md5('{SEED}' || '|' || length(CAST(p_partkey AS VARCHAR)) || ':' || CAST(p_partkey AS VARCHAR)), p_name LIMIT 50) x")
ORACLE["distinct_values"] = "SELECT p_type FROM part WHERE p_type IS NOT NULL GROUP BY p_type"
ORACLE["distinct_values_md5"] = "SELECT p_brand, md5(p_brand) AS md5 FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand"
ORACLE["extract"] = (f"SELECT c_mktsegment, md5(c_mktsegment) AS md5 FROM (SELECT c_mktsegment FROM customer "
                     f"WHERE c_mktsegment IS NOT NULL ORDER BY md5('{SEED}/train' || '|' || length(CAST(c_custkey AS VARCHAR)) || ':' || CAST(c_custkey AS VARCHAR)), "
                     "c_mktsegment LIMIT 20) x")
ORACLE["extract_all"] = ("SELECT c_mktsegment, md5(c_mktsegment) AS md5 FROM customer WHERE c_mktsegment IS NOT NULL "
                         "GROUP BY c_mktsegment")
ORACLE["copy_table"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100"
ORACLE["page_by_row_number"] = ("SELECT * FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rnum FROM orders) x "
                                "WHERE rnum BETWEEN 101 AND 200")


# ----------------------------------------------------------- string scores
def string_values(spark, sf_dir) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    a = part.select(F.lit("part").alias("gamecode"), F.lit("p_name").alias("column"), F.col("p_name").alias("value"))
    b = part.select(F.lit("part").alias("gamecode"), F.lit("p_type").alias("column"), F.col("p_type").alias("value"))
    return a.unionByName(b)


def string_profile_df(spark, sf_dir) -> DataFrame:
    """Profiles in the reference's encoding: the first 16 bytes."""
    return ST.fit_string_profile(string_values(spark, sf_dir), KEYS, seq_len=ST.SEQ_LEN)


def string_scores_df(spark, sf_dir) -> DataFrame:
    vals = string_values(spark, sf_dir)
    return ST.score_strings(ST.fit_string_profile(vals, KEYS, seq_len=ST.SEQ_LEN), vals, KEYS, seq_len=ST.SEQ_LEN)


def q_encode_positions(spark, sf_dir):
    part = ST.encode_positions(_t(spark, sf_dir, "part"), "p_type")
    return part.select("p_partkey", F.posexplode("codes").alias("pos", "code"))


def q_string_profile(spark, sf_dir):
    return _round(string_profile_df(spark, sf_dir))


def q_string_scores(spark, sf_dir):
    return _round(string_scores_df(spark, sf_dir))


def q_profile_mode(spark, sf_dir):
    return ST.profile_mode(string_profile_df(spark, sf_dir), KEYS)


def q_rank_anomalies(spark, sf_dir):
    scores = _round(string_scores_df(spark, sf_dir))
    return ST.rank_anomalies(scores, 5, KEYS).select(*KEYS, "value", "score", "rank")


def q_latent_scores(spark, sf_dir):
    """reconstruction error of the two leading components."""
    from ..operators import latent as LT
    vals = string_values(spark, sf_dir)
    out = LT.latent_scores(LT.fit_latent(vals, KEYS), vals, KEYS)
    return _round(out.select(*KEYS, "value", "score"))


def q_score_metrics(spark, sf_dir):
    return _round(C.score_metrics(string_scores_df(spark, sf_dir), KEYS))


def q_score_summary(spark, sf_dir):
    scores = materialize(string_scores_df(spark, sf_dir), "scores")        # read twice by the summary
    return _round(C.score_summary(scores, KEYS, "value", "score", sample_count=3, sample_length=6, dt=AS_OF,
                                  regdatetime=REGDATETIME))


_SV_SQL = """
sv AS (
  SELECT 'part' AS g, 'p_name' AS c, p_name AS value FROM part WHERE p_name IS NOT NULL
  UNION ALL SELECT 'part', 'p_type', p_type FROM part WHERE p_type IS NOT NULL
),
ntr AS (SELECT g, c, COUNT(*) AS n_train FROM sv GROUP BY 1, 2),
cells AS (
  SELECT g, c, CAST(i - 1 AS INTEGER) AS pos, ascii(substr(value, i, 1)) % 128 AS code
  FROM sv CROSS JOIN range(1, 17) r(i) WHERE i <= length(value)
),
prof AS (
  SELECT cells.g, cells.c, pos, code, CAST(COUNT(*) AS BIGINT) AS cnt, ntr.n_train,
         CAST(COUNT(*) + 1 AS DOUBLE) / (ntr.n_train + 2) AS prob
  FROM cells JOIN ntr ON cells.g = ntr.g AND cells.c = ntr.c GROUP BY cells.g, cells.c, pos, code, ntr.n_train
),
consts AS (
  SELECT g, c, SUM(ln(1 - prob)) + (2048 - COUNT(*)) * ln(1 - 1 / CAST(MAX(n_train) + 2 AS DOUBLE)) AS const,
         ln(1 / CAST(MAX(n_train) + 2 AS DOUBLE)) - ln(1 - 1 / CAST(MAX(n_train) + 2 AS DOUBLE)) AS odds0
  FROM prof GROUP BY 1, 2
),
dv AS (SELECT DISTINCT g, c, value FROM sv),
hot AS (
  SELECT g, c, value, CAST(i - 1 AS INTEGER) AS pos, ascii(substr(value, i, 1)) % 128 AS code
  FROM dv CROSS JOIN range(1, 17) r(i) WHERE i <= length(value)
),
hs AS (
  SELECT hot.g, hot.c, hot.value, SUM(COALESCE(ln(prof.prob) - ln(1 - prof.prob), consts.odds0)) AS h
  FROM hot JOIN consts ON hot.g = consts.g AND hot.c = consts.c
  LEFT JOIN prof ON hot.g = prof.g AND hot.c = prof.c AND hot.pos = prof.pos AND hot.code = prof.code
  GROUP BY 1, 2, 3
),
ss AS (
  SELECT dv.g AS gamecode, dv.c AS "column", dv.value, consts.const + COALESCE(hs.h, 0) AS log_likelihood,
         -(consts.const + COALESCE(hs.h, 0)) AS score
  FROM dv JOIN consts ON dv.g = consts.g AND dv.c = consts.c
  LEFT JOIN hs ON dv.g = hs.g AND dv.c = hs.c AND dv.value = hs.value
)"""

ORACLE["encode_positions"] = ("SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, ascii(substr(p_type, i, 1)) % 128 AS code "
                              "FROM part CROSS JOIN range(1, 17) r(i) WHERE i <= length(p_type)")
ORACLE["string_profile"] = (f"WITH {_SV_SQL} SELECT g AS gamecode, c AS \"column\", pos, code, cnt, n_train, "
                            "ROUND(prob, 6) AS prob FROM prof")
ORACLE["string_scores"] = (f"WITH {_SV_SQL} SELECT gamecode, \"column\", value, ROUND(log_likelihood, 6) AS "
                           "log_likelihood, ROUND(score, 6) AS score FROM ss")
ORACLE["profile_mode"] = f"""WITH {_SV_SQL},
best AS (
  SELECT g, c, pos, code, ROW_NUMBER() OVER (PARTITION BY g, c, pos ORDER BY prob DESC, code ASC) AS rn FROM prof
)
SELECT g AS gamecode, c AS "column", string_agg(chr(code), '' ORDER BY pos) AS mode
FROM best WHERE rn = 1 AND code <> 0 GROUP BY 1, 2"""
ORACLE["rank_anomalies"] = f"""WITH {_SV_SQL}
SELECT gamecode, "column", value, score, rank FROM (
  SELECT gamecode, "column", value, ROUND(score, 6) AS score,
         CAST(ROW_NUMBER() OVER (PARTITION BY gamecode, "column" ORDER BY ROUND(score, 6) DESC, value ASC) AS INTEGER) AS rank
  FROM ss) x WHERE rank <= 5"""
ORACLE["score_metrics"] = (f"WITH {_SV_SQL} SELECT gamecode, \"column\", ROUND(AVG(score), 6) AS distortion, "
                           "CAST(COUNT(*) AS BIGINT) AS n FROM ss GROUP BY 1, 2")
ORACLE["score_summary"] = f"""WITH {_SV_SQL},
ranked AS (
  SELECT gamecode, "column", CAST(FLOOR(score) AS BIGINT) AS rank, substr(value, 1, 6) AS s,
         ROW_NUMBER() OVER (PARTITION BY gamecode, "column", CAST(FLOOR(score) AS BIGINT) ORDER BY substr(value, 1, 6)) AS rn
  FROM ss
)
SELECT gamecode, "column", rank, CAST(COUNT(*) AS BIGINT) AS count,
       string_agg(CASE WHEN rn <= 3 THEN s END, '_|_' ORDER BY rn) AS sample, DATE '2024-01-20' AS dt,
       TIMESTAMP '2024-01-21 00:00:00' AS regdatetime
FROM ranked GROUP BY 1, 2, 3"""


# ------------------------------------------------------------ kernel density
def kde_values(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    return ev.select(F.lit("events").alias("gamecode"), F.lit("value").alias("column"),
                     F.to_date("ts").alias("dt"), F.col("value"))


def q_kde_fit(spark, sf_dir):
    day = AS_OF - _dt.timedelta(days=1)
    train = kde_values(spark, sf_dir).where(F.col("dt") == F.lit(day))
    return KD.fit_kde(train, KEYS)


def q_kde_scores(spark, sf_dir):
    vals = kde_values(spark, sf_dir)
    model = KD.fit_kde(vals.where(F.col("dt") == F.lit(AS_OF - _dt.timedelta(days=1))), KEYS)
    return _round(KD.score_kde(model, vals.where(F.col("dt") == F.lit(AS_OF)), KEYS))


def q_score_day(spark, sf_dir):
    vals = kde_values(spark, sf_dir)
    models = KD.fit_kde(vals.withColumnRenamed("dt", "model_dt"), [*KEYS, "model_dt"])
    return _round(KD.score_day(models, vals, KEYS))


def q_sorted_scores(spark, sf_dir):
    scores = _round(string_scores_df(spark, sf_dir))
    path = scratch_path(spark, "sorted_scores")
    SK.export_sorted_scores(scores, path)
    return RD.read_delimited(spark, path, "score DOUBLE, value STRING")


_KDE_MODEL_SQL = """
m AS (SELECT value AS centre, CAST(COUNT(*) AS BIGINT) AS weight FROM events
      WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20' AND value IS NOT NULL GROUP BY 1)"""
ORACLE["kde_fit"] = f"WITH {_KDE_MODEL_SQL} SELECT 'events' AS gamecode, 'value' AS \"column\", centre, weight FROM m"
ORACLE["kde_scores"] = f"""WITH {_KDE_MODEL_SQL},
q AS (SELECT DISTINCT value FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21' AND value IS NOT NULL),
e AS (SELECT q.value, m.weight, -0.5 * (q.value - m.centre) * (q.value - m.centre) AS e FROM q CROSS JOIN m),
mx AS (SELECT value, MAX(e) AS mx FROM e GROUP BY 1),
ld AS (
  SELECT e.value, mx.mx + ln(SUM(e.weight * exp(e.e - mx.mx))) - ln((SELECT SUM(weight) FROM m)) - 0.5 * ln(2 * pi()) AS log_density
  FROM e JOIN mx ON e.value = mx.value GROUP BY e.value, mx.mx
)
SELECT 'events' AS gamecode, 'value' AS "column", value, ROUND(log_density, 6) AS log_density,
       ROUND(-log_density, 6) AS score FROM ld"""
ORACLE["score_day"] = """WITH
m AS (SELECT CAST(ts AS DATE) AS model_dt, value AS centre, COUNT(*) AS weight FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
mt AS (SELECT model_dt, SUM(weight) AS ntot FROM m GROUP BY 1),
q AS (SELECT DISTINCT CAST(ts AS DATE) AS dt, value FROM events WHERE value IS NOT NULL),
e AS (SELECT q.dt, q.value, m.weight, -0.5 * (q.value - m.centre) * (q.value - m.centre) AS e
      FROM q JOIN m ON m.model_dt = q.dt - INTERVAL 1 DAY),
mx AS (SELECT dt, value, MAX(e) AS mx FROM e GROUP BY 1, 2),
ld AS (
  SELECT e.dt, e.value, mx.mx + ln(SUM(e.weight * exp(e.e - mx.mx))) - ln(MAX(mt.ntot)) - 0.5 * ln(2 * pi()) AS log_density
  FROM e JOIN mx ON e.dt = mx.dt AND e.value = mx.value JOIN mt ON mt.model_dt = e.dt - INTERVAL 1 DAY
  GROUP BY e.dt, e.value, mx.mx
)
SELECT 'events' AS gamecode, 'value' AS "column", CAST(dt AS DATE) AS dt, value, ROUND(log_density, 6) AS log_density,
       ROUND(-log_density, 6) AS score FROM ld"""
ORACLE["sorted_scores"] = (f"WITH {_SV_SQL} SELECT ROUND(score, 6) AS score, value FROM ss")


# ------------------------------------------------- train -> score -> report
def q_value_report(spark, sf_dir):
    from .scoring import numeric_score_report
    ev = _events(spark, sf_dir).withColumn("column", F.lit("value"))
    return _round(numeric_score_report(ev, "ts", "value", AS_OF, KEYS, sample_count=3, regdatetime=REGDATETIME))


def q_string_report(spark, sf_dir):
    from .scoring import string_score_report
    ev = _events(spark, sf_dir).withColumn("column", F.lit("props"))
    return _round(string_score_report(ev, "ts", "props", AS_OF, KEYS, sample_count=3, sample_length=8,
                                      regdatetime=REGDATETIME))


def _train_sql(col: str) -> str:
    return f"""
tr AS (SELECT {col} AS value FROM events
       WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20' AND {col} IS NOT NULL),
te AS (SELECT DISTINCT {col} AS value FROM events
       WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21' AND {col} IS NOT NULL)"""


def _report_sql(sample_len: int | None) -> str:
    s = "substr(CAST(value AS VARCHAR), 1, %d)" % sample_len if sample_len else "CAST(value AS VARCHAR)"
    return f"""
ranked AS (
  SELECT CAST(FLOOR(score) AS BIGINT) AS rank, {s} AS s,
         ROW_NUMBER() OVER (PARTITION BY CAST(FLOOR(score) AS BIGINT) ORDER BY {s}) AS rn
  FROM sc
)
SELECT 'events' AS gamecode, COL AS "column", rank, CAST(COUNT(*) AS BIGINT) AS count,
       string_agg(CASE WHEN rn <= 3 THEN s END, '_|_' ORDER BY rn) AS sample, DATE '2024-01-20' AS dt,
       TIMESTAMP '2024-01-21 00:00:00' AS regdatetime
FROM ranked GROUP BY rank"""


ORACLE["value_report"] = f"""WITH {_train_sql("value")},
m AS (SELECT value AS centre, COUNT(*) AS weight FROM tr GROUP BY 1),
e AS (SELECT te.value, m.weight, -0.5 * (te.value - m.centre) * (te.value - m.centre) AS e FROM te CROSS JOIN m),
mx AS (SELECT value, MAX(e) AS mx FROM e GROUP BY 1),
sc AS (
  SELECT e.value, -(mx.mx + ln(SUM(e.weight * exp(e.e - mx.mx))) - ln((SELECT SUM(weight) FROM m)) - 0.5 * ln(2 * pi())) AS score
  FROM e JOIN mx ON e.value = mx.value GROUP BY e.value, mx.mx
),
{_report_sql(None).replace("COL", "'value'")}"""

def _whole_string_sql(train: str, test: str, by: str) -> str:
    """Scores of ``test`` under the whole-value profile of ``train`` (relations with
    ``by`` columns, as in ``g, c``, and ``value``), in ASCII text."""
    on = lambda a, b: " AND ".join(f"{a}.{x.strip()} = {b}.{x.strip()}" for x in by.split(","))
    pick = lambda a: ", ".join(f"{a}.{x.strip()}" for x in by.split(","))
    return f"""
w_n AS (SELECT {by}, COUNT(*) AS n_train, MAX(length(value)) AS len FROM {train} GROUP BY ALL),
w_cell AS (SELECT {by}, i - 1 AS pos, ascii(substr(value, CAST(i AS BIGINT), 1)) % 128 AS code
           FROM (SELECT *, unnest(range(1, length(value) + 1)) AS i FROM {train})),
w_prof AS (SELECT {pick('w_cell')}, pos, code, (COUNT(*) + 1) / (any_value(n_train) + 2) AS prob
           FROM w_cell JOIN w_n ON {on('w_cell', 'w_n')} GROUP BY ALL),
w_const AS (
  SELECT {pick('w_n')}, any_value(1 / (n_train + 2)) AS p0,
         SUM(ln(1 - prob)) + (any_value(len) * 128 - COUNT(*)) * ln(1 - any_value(1 / (n_train + 2))) AS const
  FROM w_n JOIN w_prof ON {on('w_n', 'w_prof')} GROUP BY ALL),
w_val AS (SELECT DISTINCT {by}, value FROM {test} WHERE value IS NOT NULL),
w_hot AS (SELECT {by}, value, i - 1 AS pos, ascii(substr(value, CAST(i AS BIGINT), 1)) % 128 AS code
          FROM (SELECT *, unnest(range(1, length(value) + 1)) AS i FROM w_val)),
w_sum AS (
  SELECT {pick('w_hot')}, w_hot.value, SUM(ln(COALESCE(prob, p0)) - ln(1 - COALESCE(prob, p0))) AS hot
  FROM w_hot JOIN w_const ON {on('w_hot', 'w_const')}
  LEFT JOIN w_prof ON {on('w_hot', 'w_prof')} AND w_hot.pos = w_prof.pos AND w_hot.code = w_prof.code GROUP BY ALL),
w_score AS (
  SELECT {pick('w_val')}, w_val.value, const + COALESCE(hot, 0) AS log_likelihood, -(const + COALESCE(hot, 0)) AS score
  FROM w_val JOIN w_const ON {on('w_val', 'w_const')}
  LEFT JOIN w_sum ON {on('w_val', 'w_sum')} AND w_val.value = w_sum.value)"""


ORACLE["string_report"] = f"""WITH {_train_sql("props")},
tr1 AS (SELECT 1 AS g, value FROM tr), te1 AS (SELECT 1 AS g, value FROM te),
{_whole_string_sql("tr1", "te1", "g")}, sc AS (SELECT value, score FROM w_score),
{_report_sql(8).replace("COL", "'props'")}"""


# ------------------------------------------------------------ round trips
def q_delimited_roundtrip(spark, sf_dir):
    counts = freq_counts(spark, sf_dir)
    path = scratch_path(spark, "freq_count_tsv")
    SK.write_delimited(counts, path)
    return RD.read_delimited(spark, path, "gamecode STRING, column STRING, dt DATE, class STRING, cnt BIGINT")


def q_predictions_roundtrip(spark, sf_dir):
    scores = _round(string_scores_df(spark, sf_dir))
    path = scratch_path(spark, "predictions_json")
    SK.write_predictions(scores, path)
    return RD.read_predictions(spark, path).select("value", "score")


def q_lines_roundtrip(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select(F.concat_ws("\t", "p_name", F.md5("p_name")).alias("line"))
    path = scratch_path(spark, "value_md5_lines")
    part.write.mode("overwrite").text(path)
    return R.split_value_md5(RD.read_lines(spark, path), "value", "value").select("value")


def q_name_columns(spark, sf_dir):
    counts = null_counts(spark, sf_dir).select("bucket_dt", "null_count", "total_count")
    path = scratch_path(spark, "null_count_tsv")
    SK.write_delimited(counts, path)
    raw = spark.read.option("sep", "\t").csv(path)          # _c0, _c1, _c2 as text
    named = R.name_columns(raw, ["bucket_dt", "null_count", "total_count"])
    return named.select(F.to_timestamp_ntz("bucket_dt").alias("bucket_dt"),
                        F.col("null_count").cast("long").alias("null_count"),
                        F.col("total_count").cast("long").alias("total_count"))


ORACLE["delimited_roundtrip"] = ORACLE["freq_count"]
ORACLE["predictions_roundtrip"] = (f"WITH {_SV_SQL} SELECT value, ROUND(score, 6) AS score FROM ss")
ORACLE["lines_roundtrip"] = "SELECT p_name AS value FROM part"
ORACLE["name_columns"] = f"WITH {_NC_SQL} SELECT bucket_dt, null_count, total_count FROM nc"


QUERIES = {
    "null_count": q_null_count,
    "null_memo": q_null_memo,
    "null_memo_effective": q_null_memo_effective,
    "null_threshold": q_null_threshold,
    "null_alerts": q_null_alerts,
    "compute_null_threshold": q_compute_null_threshold,
    "compute_null_count": q_compute_null_count,
    "freq_count": q_freq_count,
    "day_totals": q_day_totals,
    "freq_memo": q_freq_memo,
    "freq_rates": q_freq_rates,
    "freq_threshold": q_freq_threshold,
    "freq_threshold_day": q_freq_threshold_day,
    "freq_alerts": q_freq_alerts,
    "compute_freq_count": q_compute_freq_count,
    "date_range": q_date_range,
    "read_dated": q_read_dated,
    "not_null": q_not_null,
    "tag_series": q_tag_series,
    "rule_passthrough": q_rule_passthrough,
    "rule_length": q_rule_length,
    "rule_min_max": q_rule_min_max,
    "rule_min_only": q_rule_min_only,
    "sample_rows": q_sample_rows,
    "sample_per_series": q_sample_per_series,
    "sample_rows_md5": q_sample_rows_md5,
    "distinct_values": q_distinct_values,
    "distinct_values_md5": q_distinct_values_md5,
    "extract": q_extract,
    "extract_all": q_extract_all,
    "copy_table": q_copy_table,
    "page_by_row_number": q_page_by_row_number,
    "encode_positions": q_encode_positions,
    "string_profile": q_string_profile,
    "string_scores": q_string_scores,
    "profile_mode": q_profile_mode,
    "rank_anomalies": q_rank_anomalies,
    "latent_scores": q_latent_scores,
    "score_metrics": q_score_metrics,
    "score_summary": q_score_summary,
    "kde_fit": q_kde_fit,
    "kde_scores": q_kde_scores,
    "score_day": q_score_day,
    "sorted_scores": q_sorted_scores,
    "value_report": q_value_report,
    "string_report": q_string_report,
    "delimited_roundtrip": q_delimited_roundtrip,
    "predictions_roundtrip": q_predictions_roundtrip,
    "lines_roundtrip": q_lines_roundtrip,
    "name_columns": q_name_columns,
}


# ------------------------------------------- further queries of round 2
def q_sample_null_keys(spark, sf_dir):
    """The row key holds NULLs and fewer rows are asked for than there are."""
    od = _t(spark, sf_dir, "orders").withColumn("k", F.expr("if(o_orderkey % 2 = 0, null, o_orderkey)"))
    return S.sample_rows(od, "o_orderkey", 5000, key=["k", "o_custkey", "o_totalprice"], seed=SEED)


def q_extract_eval(spark, sf_dir):
    """An eval sample that shares no row with the train sample."""
    return S.extract(_t(spark, sf_dir, "orders"), "o_orderkey", kind="eval", size=300, key=["o_orderkey"], seed=SEED, disjoint=True)


def q_number_rows(spark, sf_dir):
    """Every row numbered, all columns kept."""
    return S.page_by_row_number(_t(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 0, 1 << 60)


def q_page_across_partitions(spark, sf_dir):
    return S.page_by_row_number(_t(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey"], 3000, 11999)


def _long_values(spark, sf_dir) -> DataFrame:
    """Texts that agree in their first 16 bytes and differ behind them."""
    return _t(spark, sf_dir, "part").select(F.lit("part").alias("gamecode"), F.lit("long").alias("column"),
                                            F.concat(F.lit("the same start: "), "p_type", F.lit("/"), F.col("p_brand"),
                                                     F.repeat(F.lit("%"), F.col("p_size") % 7)).alias("value"))


def q_string_scores_long(spark, sf_dir):
    """Whole values, half of them in training: bytes behind the training lengths cost too."""
    vals = _long_values(spark, sf_dir)
    profile = ST.fit_string_profile(vals.where(F.length("value") < 45), KEYS)
    return _round(ST.score_strings(profile, vals, KEYS))


def _day_strings(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).select("gamecode", F.lit("props").alias("column"), F.to_date("ts").alias("dt"),
                                         F.col("props").alias("value"))


def q_score_day_strings(spark, sf_dir):
    vals = _day_strings(spark, sf_dir)
    models = ST.fit_string_profile(vals.withColumnRenamed("dt", "model_dt"), [*KEYS, "model_dt"])
    return _round(ST.score_day_strings(models, vals, KEYS))


def q_score_day_versions(spark, sf_dir):
    """Each day's model is stored in two versions; the newest (on all rows) wins."""
    vals = kde_values(spark, sf_dir)
    train = vals.withColumnRenamed("dt", "model_dt")
    old = KD.fit_kde(train.where("value < 50"), [*KEYS, "model_dt"]).withColumn("version", F.lit(1))
    new = KD.fit_kde(train, [*KEYS, "model_dt"]).withColumn("version", F.lit(2))
    stored = materialize(old.unionByName(new), "model_versions")
    return _round(KD.score_day(stored, vals, KEYS))


def q_kde_shifted(spark, sf_dir):
    """Every value of day D comes in another unit: far from the whole model."""
    vals = kde_values(spark, sf_dir)
    model = KD.fit_kde(vals.where(F.col("dt") == F.lit(AS_OF - _dt.timedelta(days=1))), KEYS)
    day = vals.where(F.col("dt") == F.lit(AS_OF)).withColumn("value", F.col("value") * 60 + 1000)
    return _round(KD.score_kde(model, day, KEYS))


def q_eval_metrics(spark, sf_dir):
    from .scoring import evaluate_strings
    rows = _events(spark, sf_dir).select("gamecode", F.lit("props").alias("column"), "event_id", F.col("props").alias("value"))
    return _round(evaluate_strings(rows, "value", KEYS, ["event_id"], SEED))


def _daily_store(spark, sf_dir, last=AS_OF, days: int = 7) -> dict:
    """The days up to ``last`` counted one after the other into the stored tables."""
    from .checks import write_daily_checks
    out, paths = scratch_path(spark, "daily"), {}
    for back in range(days, -1, -1):
        paths = write_daily_checks(_events(spark, sf_dir), "ts", null_columns(), ["event_type"], last - _dt.timedelta(days=back), out)
    return paths


def q_stored_null_threshold(spark, sf_dir):
    t = SK.read_stored(spark, _daily_store(spark, sf_dir)["null_threshold"]).where(F.col("dt") == F.lit(AS_OF))
    return _round(t.select(*KEYS, "bucket_dt", "threshold"))


def q_stored_freq_threshold(spark, sf_dir):
    t = SK.read_stored(spark, _daily_store(spark, sf_dir)["freq_threshold"]).where(F.col("dt") == F.lit(AS_OF))
    return _round(t.select(*KEYS, "dt", "class", "lowerbound", "upperbound"))


def _write_rule_values(spark, sf_dir, root: str, day, corrected: bool = False) -> None:
    """The day's distinct values as delimited folders, one per series and day."""
    vals = materialize(rule_values(spark, sf_dir), "rule_values")
    for (column,) in sorted(vals.select("column").distinct().collect()):        # as many as there are checked columns
        own = vals.where(F.col("column") == column)
        if corrected:
            own = own.where(F.col("value").try_cast("double").between(10, 100) & (F.length("value") > 2))
        SK.write_delimited(own.select("value"), f"{root}/part/{column}/{day:%Y%m%d}/test")


def _rule_table(spark) -> DataFrame:
    """The checked rules, as a rule table has them: series differ in kinds and bounds."""
    return spark.createDataFrame([("part", "p_size", "length", 2, None, None), ("part", "p_size", "min_max", None, 10.0, 40.0),
                                  ("part", "p_retailprice", "min_max", None, 1000.0, None), ("part", "odd_numbers", "min_max", None, 0.0, 100.0),
                                  ("part", "odd_numbers", "length", 4, None, None), ("part", "p_brand", "base", None, None, None)],
                                 "gamecode string, column string, rule string, max_len int, min double, max double")


def q_daily_rules(spark, sf_dir):
    """The rule job from the day's value folders: every series by its own rules."""
    from .checks import write_daily_rules
    root, out = scratch_path(spark, "rule_days"), scratch_path(spark, "rules")
    _write_rule_values(spark, sf_dir, root, AS_OF)
    path = write_daily_rules(spark, root, _rule_table(spark), AS_OF, out, KEYS, regdatetime=REGDATETIME)
    return SK.read_stored(spark, path).select(*KEYS, "data", "rule", "max_len", "min", "max", "dt", "regdatetime")


def q_daily_rules_rerun(spark, sf_dir):
    """Day D is run again on corrected values that break no rule; day D-1 keeps its violations."""
    from .checks import write_daily_rules
    root, out, path = scratch_path(spark, "rule_days"), scratch_path(spark, "rules"), ""
    rules = _rule_table(spark).where("rule = 'length'")
    for day, corrected in ((AS_OF - _dt.timedelta(days=1), False), (AS_OF, False), (AS_OF, True)):
        _write_rule_values(spark, sf_dir, root, day, corrected)
        path = write_daily_rules(spark, root, rules.where("max_len = 2"), day, out, KEYS, regdatetime=REGDATETIME)
    return SK.read_stored(spark, path).select(*KEYS, "data", "rule", "dt")


_ODD_TEXT = ("concat(' ', p_type)", "concat(p_type, ' ')", "concat('a', char(9), 'b', p_type)", "concat(p_brand, char(10), p_type)",
             "concat(char(34), p_brand, char(34), char(13))", "concat(p_type, char(92))", "''", "cast(null as string)",
             "concat(char(92), 'N')")


def q_text_roundtrip(spark, sf_dir):
    """Texts with edge spaces, tabs, line ends, quotes, backslashes, empty and NULL."""
    cases = " ".join(f"when {i} then {e}" for i, e in enumerate(_ODD_TEXT))
    part = _t(spark, sf_dir, "part").select("p_partkey", F.expr(f"case p_partkey % {len(_ODD_TEXT)} {cases} end").alias("value"))
    path = scratch_path(spark, "odd_text")
    SK.write_delimited(part, path)
    return RD.read_delimited(spark, path, "p_partkey BIGINT, value STRING").withColumn("value", F.hex(F.encode("value", "UTF-8")))


def q_read_dated_paths(spark, sf_dir):
    """Day folders of class counts, one of them missing."""
    root = scratch_path(spark, "dated")
    counts = materialize(_event_counts(spark, sf_dir), "dated_counts")
    for back in range(7, -1, -1):
        day = AS_OF - _dt.timedelta(days=back)
        if back != 2:
            SK.write_delimited(counts.where(F.col("dt") == F.lit(day)).select("class", "cnt"), f"{root}/{day:%Y%m%d}/freq_count")
    return RD.read_dated_paths(spark, root, AS_OF, 7, "freq_count", "class STRING, cnt BIGINT")


def _key(col: str) -> str:
    return f"coalesce('|' || length(CAST({col} AS VARCHAR)) || ':' || CAST({col} AS VARCHAR), '|NULL')"


ORACLE["sample_null_keys"] = f"""
SELECT o_orderkey FROM orders
ORDER BY md5('{SEED}' || coalesce('|' || length(CAST(CASE WHEN o_orderkey % 2 <> 0 THEN o_orderkey END AS VARCHAR)) || ':'
             || CAST(CASE WHEN o_orderkey % 2 <> 0 THEN o_orderkey END AS VARCHAR), '|NULL') || {_key("o_custkey")} || {_key("o_totalprice")}),
         o_orderkey LIMIT 5000"""
ORACLE["extract_eval"] = f"""
SELECT o_orderkey FROM orders
WHERE CAST('0x' || substr(md5('{SEED}/split' || {_key("o_orderkey")}), 1, 8) AS BIGINT) % 100 BETWEEN 80 AND 89
ORDER BY md5('{SEED}/eval' || {_key("o_orderkey")}), o_orderkey LIMIT 300"""
ORACLE["number_rows"] = "SELECT *, ROW_NUMBER() OVER (ORDER BY o_totalprice, o_orderkey) AS rnum FROM orders"
ORACLE["page_across_partitions"] = ("SELECT *, ROW_NUMBER() OVER (ORDER BY o_custkey, o_orderkey) AS rnum FROM orders "
                                    "QUALIFY rnum BETWEEN 3001 AND 12000")
ORACLE["string_scores_long"] = f"""WITH lv AS (
  SELECT 'part' AS g, 'long' AS c, 'the same start: ' || p_type || '/' || p_brand || repeat('%', p_size % 7) AS value FROM part),
lt AS (SELECT * FROM lv WHERE length(value) < 45),
{_whole_string_sql("lt", "lv", "g, c")}
SELECT g AS gamecode, c AS "column", value, ROUND(log_likelihood, 6) AS log_likelihood, ROUND(score, 6) AS score FROM w_score"""
ORACLE["score_day_strings"] = f"""WITH tr AS (SELECT CAST(ts AS DATE) + 1 AS dt, props AS value FROM events WHERE props IS NOT NULL),
te AS (SELECT CAST(ts AS DATE) AS dt, props AS value FROM events),
{_whole_string_sql("tr", "te", "dt")}
SELECT 'events' AS gamecode, 'props' AS "column", dt, value, ROUND(log_likelihood, 6) AS log_likelihood, ROUND(score, 6) AS score FROM w_score"""
ORACLE["score_day_versions"] = ORACLE["score_day"]
ORACLE["kde_shifted"] = ORACLE["kde_scores"].replace("SELECT DISTINCT value FROM events", "SELECT DISTINCT value * 60 + 1000 AS value FROM events")
ORACLE["eval_metrics"] = f"""WITH ev AS (
  SELECT 'events' AS g, 'props' AS c, props AS value, CAST('0x' || substr(md5('{SEED}/split' || {_key("event_id")}), 1, 8) AS BIGINT) % 100 AS u
  FROM events WHERE props IS NOT NULL),
tr AS (SELECT g, c, value FROM ev WHERE u < 80), te AS (SELECT g, c, value FROM ev WHERE u BETWEEN 80 AND 89),
{_whole_string_sql("tr", "te", "g, c")}
SELECT te.g AS gamecode, te.c AS "column", ROUND(AVG(score), 6) AS distortion, COUNT(*) AS n
FROM te JOIN w_score ON te.value = w_score.value GROUP BY ALL"""
ORACLE["stored_null_threshold"] = ORACLE["null_threshold"]
ORACLE["stored_freq_threshold"] = (f"WITH {_FC_SQL}, {_FREQ_SQL} SELECT {_FTHR_COLS} FROM fthr "
                                   "WHERE gamecode = 'events' AND dt = DATE '2024-01-20'")
ORACLE["daily_rules"] = f"""WITH {_RV_SQL},
rules(c, rule, max_len, lo, hi) AS (
  VALUES ('p_size', 'length', 2, NULL, NULL), ('p_size', 'min_max', NULL, 10.0, 40.0), ('p_retailprice', 'min_max', NULL, 1000.0, NULL),
         ('odd_numbers', 'min_max', NULL, 0.0, 100.0), ('odd_numbers', 'length', 4, NULL, NULL), ('p_brand', 'base', NULL, NULL, NULL))
SELECT gamecode, "column", value AS data, rule, max_len::int AS max_len, lo::double AS min, hi::double AS max, DATE '{AS_OF}' AS dt,
       TIMESTAMP '{REGDATETIME}' AS regdatetime
FROM rv JOIN rules ON c = "column"
WHERE rule = 'base' OR (rule = 'length' AND length(value) <= max_len) OR (rule = 'min_max' AND (coalesce(x < lo, false) OR coalesce(x > hi, false)))"""
ORACLE["daily_rules_rerun"] = f"""WITH {_RV_SQL}
SELECT gamecode, "column", value AS data, 'length' AS rule, DATE '{AS_OF - _dt.timedelta(days=1)}' AS dt
FROM rv WHERE "column" = 'p_size' AND length(value) <= 2"""
ORACLE["text_roundtrip"] = """SELECT p_partkey, hex(encode(CASE p_partkey % 9 WHEN 0 THEN ' ' || p_type WHEN 1 THEN p_type || ' '
  WHEN 2 THEN 'a' || chr(9) || 'b' || p_type WHEN 3 THEN p_brand || chr(10) || p_type WHEN 4 THEN '"' || p_brand || '"' || chr(13)
  WHEN 5 THEN p_type || chr(92) WHEN 6 THEN '' WHEN 8 THEN chr(92) || 'N' END)) AS value FROM part"""
ORACLE["read_dated_paths"] = f"""WITH {_FC_SQL} SELECT class, cnt, dt FROM fc
WHERE gamecode = 'events' AND dt BETWEEN DATE '2024-01-13' AND DATE '2024-01-20' AND dt <> DATE '2024-01-18'"""

# The latent score as the formulas have it: covariance of the seen cells as a matrix,
# its first two eigenvectors by power iteration with deflation, the reconstruction error.
ORACLE["latent_scores"] = f"""WITH {_SV_SQL},
lcell AS (SELECT g, c, pos, code, row_number() OVER (PARTITION BY g, c ORDER BY pos, code) AS i, cnt / n_train AS mu FROM prof),
lval AS (  -- each training string as its set of cells, equal strings weighted
  SELECT cells.g, cells.c, cells.value, any_value(w) AS w, list(i ORDER BY i) AS idx
  FROM (SELECT DISTINCT g, c, value, CAST(p - 1 AS INTEGER) AS pos, ascii(substr(value, p, 1)) % 128 AS code
        FROM sv CROSS JOIN range(1, 17) r(p) WHERE p <= length(value)) cells
  JOIN (SELECT g, c, value, count(*) AS w FROM sv GROUP BY ALL) ws ON ws.g = cells.g AND ws.c = cells.c AND ws.value = cells.value
  JOIN lcell ON lcell.g = cells.g AND lcell.c = cells.c AND lcell.pos = cells.pos AND lcell.code = cells.code GROUP BY cells.g, cells.c, cells.value),
lgram AS (
  SELECT g, c, a, b, sum(w) AS n FROM (SELECT g, c, w, a, unnest(idx) AS b FROM (SELECT *, unnest(idx) AS a FROM lval)) GROUP BY ALL),
lcov AS (
  SELECT x.g, x.c, x.i AS a, list(coalesce(n / n_train, 0) - x.mu * y.mu ORDER BY y.i) AS cov
  FROM lcell x JOIN lcell y ON x.g = y.g AND x.c = y.c JOIN ntr ON ntr.g = x.g AND ntr.c = x.c
  LEFT JOIN lgram ON lgram.g = x.g AND lgram.c = x.c AND lgram.a = x.i AND lgram.b = y.i GROUP BY ALL),
lmat AS (SELECT g, c, list(cov ORDER BY a) AS m FROM lcov GROUP BY ALL),
lone AS (
  SELECT g, c, m, list_reduce(list_transform(range(0, 400), lambda k: list_transform(m, lambda r: CAST(IF(k = 0, 1 + r[1], k % 10) AS DOUBLE))),
    lambda v, k: CASE WHEN k[1] <> 0 THEN list_transform(m, lambda r: list_inner_product(r, v))
                      ELSE list_transform(v, lambda e: e / sqrt(list_inner_product(v, v))) END) AS v
  FROM lmat),
lunit AS (SELECT g, c, m, list_transform(v, lambda e: e / sqrt(list_inner_product(v, v))) AS v1 FROM lone),
ldef AS (
  SELECT g, c, m, v1, list_transform(m, lambda r, a: list_transform(r, lambda e, b: e - lam * v1[a] * v1[b])) AS m2
  FROM (SELECT *, list_inner_product(v1, list_transform(m, lambda r: list_inner_product(r, v1))) AS lam FROM lunit)),
ltwo AS (
  SELECT g, c, v1, m2, list_reduce(list_transform(range(0, 400), lambda k: list_transform(m2, lambda r: CAST(IF(k = 0, 1 + r[1], k % 10) AS DOUBLE))),
    lambda v, k: CASE WHEN k[1] <> 0 THEN list_transform(m2, lambda r: list_inner_product(r, v))
                      ELSE list_transform(v, lambda e: e / sqrt(list_inner_product(v, v))) END) AS v
  FROM ldef),
lvec AS (SELECT g, c, v1, list_transform(v, lambda e: e / sqrt(list_inner_product(v, v))) AS v2 FROM ltwo),
lmu AS (SELECT g, c, list(mu ORDER BY i) AS mu FROM lcell GROUP BY ALL)
SELECT lval.g AS gamecode, lval.c AS "column", value,
  ROUND(len(idx) - 2 * list_sum(list_transform(idx, lambda i: mu[i])) + list_inner_product(mu, mu)
        - pow(list_sum(list_transform(idx, lambda i: v1[i])) - list_inner_product(mu, v1), 2)
        - pow(list_sum(list_transform(idx, lambda i: v2[i])) - list_inner_product(mu, v2), 2), 6) AS score
FROM lval JOIN lvec ON lvec.g = lval.g AND lvec.c = lval.c JOIN lmu ON lmu.g = lval.g AND lmu.c = lval.c"""


# ------------------------------------------- further queries of round 3
def q_page_with_ties(spark, sf_dir):
    """A page of rows whose key is not unique: each row once."""
    page = S.page_by_row_number(_t(spark, sf_dir, "orders"), ["o_custkey"], 2500, 9499)
    return page.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("orders"),
                                         F.min("rnum").alias("first"), F.max("rnum").alias("last"))


ORACLE["page_with_ties"] = """
SELECT o_custkey, count(*) AS n, count(*) AS orders, min(rnum) AS first, max(rnum) AS last
FROM (SELECT o_custkey, ROW_NUMBER() OVER (ORDER BY o_custkey) AS rnum FROM orders) WHERE rnum BETWEEN 2501 AND 9500 GROUP BY o_custkey"""


def q_stored_null_alerts(spark, sf_dir):
    """The alert table of the daily job: day D+1 against the stored limits of day D."""
    nxt = AS_OF + _dt.timedelta(days=1)
    t = SK.read_stored(spark, _daily_store(spark, sf_dir, nxt, 8)["null_alert"]).where(F.col("dt") == F.lit(nxt))
    return _round(t.select(*KEYS, "bucket_dt", "threshold", "score", "alert"))


def q_stored_freq_alerts(spark, sf_dir):
    nxt = AS_OF + _dt.timedelta(days=1)
    t = SK.read_stored(spark, _daily_store(spark, sf_dir, nxt, 8)["freq_alert"]).where(F.col("dt") == F.lit(nxt))
    return _round(t.select(*KEYS, "dt", "class", "pi", "lowerbound", "upperbound", "alert"))


def q_score_day_stored(spark, sf_dir):
    """Models of every day in a versioned table; a newer version was never committed."""
    from ..sources import models as M
    from .scoring import score_day_stored
    vals = kde_values(spark, sf_dir)
    train = vals.withColumnRenamed("dt", "model_dt")
    path = scratch_path(spark, "models")
    half = F.col("model_dt") < F.lit(AS_OF)
    M.write_models(KD.fit_kde(train.where("value < 50"), [*KEYS, "model_dt"]), path)
    M.write_models(KD.fit_kde(train.where(half), [*KEYS, "model_dt"]), path)
    M.write_models(KD.fit_kde(train.where(~half), [*KEYS, "model_dt"]), path)
    M.stage_models(KD.fit_kde(train.where("value > 50"), [*KEYS, "model_dt"]), path, 4)
    return _round(score_day_stored(spark, path, vals, KEYS))


def q_lines_with_header(spark, sf_dir):
    """Several files that begin with a header line each."""
    path = scratch_path(spark, "headed")
    part = _t(spark, sf_dir, "part")
    for i in range(3):
        own = part.where(F.col("p_partkey") % 3 == i).select(F.col("p_partkey").alias("k"), F.col("p_name").alias("value"))
        head = own.agg(F.lit(-1).cast("long").alias("k"), F.lit("the header").alias("value"))
        own.select(F.col("k").cast("long").alias("k"), "value").unionByName(head).coalesce(1).sortWithinPartitions("k") \
            .select("value").write.mode("append").text(path)
    return RD.read_lines(spark, path, skip_header=True)


def q_string_scores_empty(spark, sf_dir):
    """A series whose training strings are all empty still scores its values."""
    part = _t(spark, sf_dir, "part").select(F.lit("part").alias("gamecode"), F.lit("empty").alias("column"), "p_brand", F.lit("").alias("value"))
    vals = part.select("gamecode", "column", F.col("p_brand").alias("value")).unionByName(part.select("gamecode", "column", "value"))
    return _round(ST.score_strings(ST.fit_string_profile(part, KEYS), vals, KEYS))


def q_density_metrics(spark, sf_dir):
    from .scoring import evaluate_densities
    rows = _events(spark, sf_dir).select("gamecode", F.lit("value").alias("column"), "event_id", "value")
    return _round(evaluate_densities(rows, "value", KEYS, ["event_id"], SEED))


def q_latent_scores_long(spark, sf_dir):
    """Texts that agree in their first 16 bytes and differ behind them."""
    from ..operators import latent as LT
    vals = _long_values(spark, sf_dir)
    return _round(LT.latent_scores(LT.fit_latent(vals, KEYS), vals, KEYS).select(*KEYS, "value", "score"))


_LONG_SV = """sv AS (
  SELECT 'part' AS g, 'long' AS c, 'the same start: ' || p_type || '/' || p_brand || repeat('%', p_size % 7) AS value FROM part),
ntr AS"""
ORACLE["latent_scores_long"] = ORACLE["latent_scores"].replace("range(1, 17)", "range(1, 65)") \
    .replace(ORACLE["latent_scores"][ORACLE["latent_scores"].index("sv AS ("):ORACLE["latent_scores"].index("ntr AS") + 6], _LONG_SV)
ORACLE["stored_null_alerts"] = ORACLE["null_alerts"]
ORACLE["stored_freq_alerts"] = ORACLE["freq_alerts"].split("WHERE (gamecode = 'events'")[0] + "WHERE gamecode = 'events' AND dt = DATE '2024-01-21'"
ORACLE["score_day_stored"] = ORACLE["score_day"]
ORACLE["lines_with_header"] = "SELECT p_name AS value FROM part"
ORACLE["string_scores_empty"] = """WITH n AS (SELECT 1 / (count(*) + 2) AS p0 FROM part),
v AS (SELECT DISTINCT p_brand AS value FROM part WHERE p_brand IS NOT NULL UNION SELECT '')
SELECT 'part' AS gamecode, 'empty' AS "column", value, ROUND(strlen(value) * (ln(p0) - ln(1 - p0)), 6) + 0.0 AS log_likelihood,
       ROUND(strlen(value) * (ln(1 - p0) - ln(p0)), 6) AS score FROM v, n"""
ORACLE["density_metrics"] = f"""WITH ev AS (
  SELECT value, CAST('0x' || substr(md5('{SEED}/split' || {_key("event_id")}), 1, 8) AS BIGINT) % 100 AS u FROM events WHERE value IS NOT NULL),
m AS (SELECT value AS centre, count(*) AS weight FROM ev WHERE u < 80 GROUP BY 1),
q AS (SELECT value, count(*) AS n FROM ev WHERE u BETWEEN 80 AND 89 GROUP BY 1),
e AS (SELECT q.value, any_value(n) AS n, max(-0.5 * pow(q.value - centre, 2)) AS mx FROM q, m GROUP BY q.value),
s AS (SELECT e.value, any_value(e.n) AS n, any_value(mx) + ln(sum(weight * exp(-0.5 * pow(e.value - centre, 2) - mx))) AS l FROM e, m GROUP BY e.value)
SELECT 'events' AS gamecode, 'value' AS "column",
       ROUND(sum(-(l - ln((SELECT sum(weight) FROM m)) - 0.5 * ln(2 * pi())) * n) / sum(n), 6) AS distortion, sum(n)::bigint AS n FROM s"""

QUERIES |= {name.removeprefix("q_"): fn for name, fn in list(globals().items())
            if name.startswith("q_") and name.removeprefix("q_") not in QUERIES}
