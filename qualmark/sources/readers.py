"""Readers (A1-A4). Every reader takes an explicit schema: no inference pass
over the data, and typed columns from the first stage on."""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.time import as_date
from .sinks import check_separator

# The typed schemas of the reference's count and prediction files.
NULL_COUNT_SCHEMA = "bucket_dt TIMESTAMP_NTZ, null_count BIGINT, total_count BIGINT"
FREQ_COUNT_SCHEMA = "dt DATE, class STRING, cnt BIGINT"
RULE_VALUES_SCHEMA = "value STRING"
PREDICTION_SCHEMA = "value STRING, score DOUBLE, _corrupt_record STRING"


def _cells(line: Column, sep: str) -> Column:
    return F.split(line, re.escape(sep), -1)


def _unescape(cell: Column, sep: str) -> Column:
    """Cell text of ``write_delimited``: ``\\N`` alone is NULL; backslash, tab,
    newline, carriage return and the separator are written with a backslash."""
    out = F.regexp_replace(cell, r"\\\\", "\u0001b")             # a pair first, so that it starts no other escape
    marks = (("t", "\t"), ("n", "\n"), ("r", "\r"), ("s", sep), ("1", "\u0001"))
    for mark, _ in marks:
        out = F.regexp_replace(out, r"\\" + mark, "\u0001" + mark)
    for mark, char in (("b", "\\"), *marks):
        out = F.replace(out, F.lit("\u0001" + mark), F.lit(char))
    return F.when(cell != "\\N", out)


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: str | StructType, sep: str = "\t",
                   escaped: bool = True, on_error: str = "raise") -> DataFrame:
    """A1: headerless delimited files (list of paths or globs) with a schema.

    Text cells come back exactly as ``write_delimited`` got them; with
    ``escaped=False`` (files of other writers) they are taken as they stand, and
    an empty cell of a column that is not text is NULL. A line with another
    number of cells, or a cell that is no value of its column's type, ends the
    job; with ``on_error="report"`` its readable cells are kept and the line
    is put into ``_corrupt_record`` (NULL for good lines).
    """
    if on_error not in ("raise", "report"):
        raise ValueError("on_error must be 'raise' or 'report'")
    if escaped:
        check_separator(sep)
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    lines = spark.read.option("lineSep", "\n").text([paths] if isinstance(paths, str) else list(paths))
    rows = lines.select("value", _cells(F.col("value"), sep).alias("cells"))
    bad = F.size("cells") != len(fields)
    out = []
    for i, f in enumerate(fields.fields):
        cell = F.get("cells", F.lit(i))
        text = _unescape(cell, sep) if escaped else cell
        if isinstance(f.dataType, StringType):
            out.append(text.alias(f.name))
            continue
        text = F.when(F.length(F.trim(text)) > 0, F.trim(text))
        typed = text.try_cast(f.dataType)
        bad = bad | F.coalesce(text.isNotNull() & typed.isNull(), F.lit(False))
        out.append(typed.alias(f.name))
    corrupt = F.when(bad, F.col("value"))
    if on_error == "report":
        return rows.select(*out, corrupt.alias("_corrupt_record"))
    check = F.when(bad, F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))))
    return rows.select(*out, check.cast("string").alias("__check")).where(F.col("__check").isNull()).drop("__check")


def read_predictions(spark: SparkSession, paths: str | Sequence[str],
                     schema: str = PREDICTION_SCHEMA) -> DataFrame:
    """A2: JSON lines ``{"value": ..., "score": ...}``; bad lines land in
    ``_corrupt_record`` instead of failing the job (the reference's
    single-quoted, unescaped output turned values holding a quote into such
    lines). Files written with the reference field names ``_0``/``_1`` are
    read with ``schema="_0 STRING, _1 DOUBLE, _corrupt_record STRING"``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(paths))


def read_dated(df: DataFrame, as_of, past_days: int, day: str = "dt", ts: str | None = None) -> DataFrame:
    """A3: days ``as_of - past_days .. as_of`` inclusive (7 -> 8 days).

    On a table partitioned by ``day`` the filter prunes partitions; on a
    timestamp column it becomes a pushed-down range filter on the scan.
    """
    d = as_date(as_of)
    lo = d - _dt.timedelta(days=past_days)
    if ts is not None:
        start = _dt.datetime.combine(lo, _dt.time())
        end = _dt.datetime.combine(d + _dt.timedelta(days=1), _dt.time())
        return df.where((F.col(ts) >= F.expr(f"TIMESTAMP_NTZ'{start:%Y-%m-%d %H:%M:%S}'"))
                        & (F.col(ts) < F.expr(f"TIMESTAMP_NTZ'{end:%Y-%m-%d %H:%M:%S}'")))
    return df.where((F.col(day) >= F.expr(f"DATE'{lo.isoformat()}'")) & (F.col(day) <= F.expr(f"DATE'{d.isoformat()}'")))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(path))
    return found is not None and len(found) > 0


def read_dated_paths(spark: SparkSession, root: str, as_of, past_days: int, kind: str,
                     schema: str | StructType, sep: str = "\t", escaped: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """A3 over the reference folder layout ``root/YYYYMMDD/kind/*``; adds ``dt``.

    With ``keys`` the day folders of many series are read in one scan, from
    ``root/<key>/<key>/YYYYMMDD/kind/*`` with a folder level per key, which become
    columns. A day without a folder has no rows; so does a range without any.
    """
    d = as_date(as_of)
    above = f"{root}/" + "*/" * len(keys)
    days = [f"{above}{(d - _dt.timedelta(days=i)):%Y%m%d}/{kind}/*" for i in range(past_days, -1, -1)]
    paths = [p for p in days if _exists(spark, p)]
    if not paths:
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        empty = spark.createDataFrame([], fields).withColumn("dt", F.lit(None).cast("date"))
        return empty.withColumns({k: F.lit(None).cast("string") for k in keys})
    df = read_delimited(spark, paths, schema, sep, escaped)
    place = F.input_file_name()
    levels = r"([^/]+)/" * len(keys) + r"(\d{8})/[^/]+/[^/]+$"
    named = {k: F.url_decode(F.regexp_extract(place, levels, i + 1)) for i, k in enumerate(keys)}
    return df.withColumns(named | {"dt": F.to_date(F.regexp_extract(place, levels, len(keys) + 1), "yyyyMMdd")})


def read_lines(spark: SparkSession, paths: str | Sequence[str], skip_header: bool = False) -> DataFrame:
    """A4: text lines as ``value``, unchanged; ``skip_header`` drops each file's first line.

    Files are split at line ends, so only the split at offset 0 of a file holds its
    first line: the least row of that split. One line per file is found by an
    aggregate over the rows' places (no text is shuffled or written), and left
    out when the lines are read; files and splits are listed once, so places agree.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths)
    if not skip_header:
        return lines
    place = lines.select("value", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__s"),
                         F.monotonically_increasing_id().alias("__i"))
    first = place.where("__s = 0").groupBy("__f").agg(F.min("__i").alias("__first")).select("__first")
    return place.join(first, F.col("__i") == F.col("__first"), "left_anti").select("value")
