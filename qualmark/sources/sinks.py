"""Writers (A7-A10).

Daily result tables are best kept as Parquet partitioned by ``dt`` and
written with dynamic partition overwrite, so re-running a day replaces that
day instead of appending duplicates (the reference appended to MySQL without
a key). The delimited, JDBC and JSON writers keep the reference's formats.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def check_separator(sep: str) -> str:
    """A separator that escaped cells can hold: one character that no escape is made of."""
    if len(sep) != 1 or sep in "\\\n\r\u0001Ntnr1sb":
        raise ValueError(f"separator {sep!r}: one character that is no line end, backslash or mark of an escape")
    return sep


def _escape(cell: Column, sep: str) -> Column:
    out = F.replace(cell, F.lit("\\"), F.lit("\\\\"))
    for char, mark in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\u0001", "\\1")):
        out = F.replace(out, F.lit(char), F.lit(mark))
    if sep != "\t":
        out = F.replace(out, F.lit(sep), F.lit("\\s"))
    return F.coalesce(out, F.lit("\\N"))


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "overwrite") -> None:
    """Headerless delimited folder (one file per task, written in parallel).

    No value changes on the way: backslash, tab, newline, carriage return and the
    separator are escaped with a backslash, NULL is ``\\N`` and empty text is empty.
    Separators that cannot be escaped are refused.
    """
    cells = [_escape(F.col(f"`{c}`").cast("string"), check_separator(sep)) for c in df.columns]
    df.select(F.concat_ws(sep, *cells).alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("dt",),
                      cluster_by: Sequence[str] | None = None, replace: Sequence = ()) -> None:
    """Parquet partitioned by day; re-running a day overwrites only that day.

    ``cluster_by`` (the series keys) range-partitions the rows on
    ``(partition_by, cluster_by)`` and sorts each file, so a later read finds
    each series in few splits: the map-side partial aggregates of the limits
    then combine a series' emissions before the shuffle, and Parquet min/max
    statistics skip row groups of other series. Range partitioning also splits
    one large day over many tasks, where ``repartition(dt)`` would not.

    ``replace`` names the days (values of the first partition column) that the job
    answers for: one that gets no row this time loses the rows of earlier runs. The
    table's schema is kept beside it, so that ``read_stored`` can read it before any
    row was written.
    """
    spark = df.sparkSession
    fs, _ = _file_system(spark, path)
    _write_text(spark, f"{path}/{SCHEMA_FILE}", df.schema.json())
    days = [f"{path}/{partition_by[0]}={d}" for d in replace]
    before = [(d, _files(spark, d)) for d in days]
    if cluster_by:
        cols = [*partition_by, *cluster_by]
        df = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    for d, old in before:
        for name in old & _files(spark, d):                     # a partition that got rows has new files only
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(name), False)


SCHEMA_FILE = "_schema.json"     # Spark's readers pass over names that begin with an underscore


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _files(spark: SparkSession, path: str) -> set[str]:
    """The data files below a folder (none, if it is not there)."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return set()
    found, out = fs.listFiles(root, True), set()
    while found.hasNext():
        out.add(found.next().getPath().toString())
    return out


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _file_system(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_partitioned`` with the schema it was written with, also if no day
    of it has rows."""
    text = _read_text(spark, f"{path}/{SCHEMA_FILE}")
    reader = spark.read if text is None else spark.read.schema(StructType.fromJson(json.loads(text)))
    return reader.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None) -> None:
    """Append to a JDBC table (one connection per task)."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties or {})


def write_predictions(df: DataFrame, path: str, value: str = "value", score: str = "score",
                      mode: str = "overwrite") -> None:
    """JSON lines ``{"value": ..., "score": ...}`` (valid, escaped JSON)."""
    df.select(F.col(value).cast("string").alias("value"), F.col(score).cast("double").alias("score")) \
        .write.mode(mode).json(path)


def export_sorted_scores(df: DataFrame, path: str, value: str = "value", score: str = "score",
                         sep: str = "\t") -> DataFrame:
    """A10: ``score<TAB>value`` lines in ascending numeric score order.

    ``orderBy`` is a range-partitioned global sort: part files are in order
    and each is sorted, with no single-task merge.
    """
    out = df.select(F.col(score).cast("double").alias("score"), F.col(value).cast("string").alias("value")) \
        .orderBy("score", "value")
    write_delimited(out, path, sep=sep)
    return out
