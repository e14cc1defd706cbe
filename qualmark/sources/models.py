"""Versioned model tables (F7): a model is read only once it is written whole.

A table lies below one folder as ``version=V/model_dt=D/...`` (Parquet, any model
columns), with a marker ``_committed/V`` that is written after the data of version
V. A run that ends halfway leaves no marker, so its rows are never read; the next
run takes a number of its own. A version may hold any number of model days; for each
day the newest committed version that has it counts. Versions are chosen from the
folder's listing, before any row is read, and only the chosen partitions are scanned.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .sinks import _file_system, _read_text, _write_text

MARKERS = "_committed"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _numbers(names: Iterable[str], prefix: str) -> set[int]:
    return {int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit()}


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that are written whole, ascending."""
    return sorted(_numbers(_names(spark, f"{path}/{MARKERS}"), ""))


def write_models(models: DataFrame, path: str, model_day: str = "model_dt") -> int:
    """Store ``models`` as a new version and commit it; returns its number."""
    spark = models.sparkSession
    taken = _numbers(_names(spark, path), "version=") | set(committed_versions(spark, path))
    version = max(taken, default=0) + 1
    stage_models(models, path, version, model_day)
    _write_text(spark, f"{path}/{MARKERS}/{version}", models.drop(model_day).schema.json())
    return version


def stage_models(models: DataFrame, path: str, version: int, model_day: str = "model_dt") -> None:
    """Write a version's rows without the marker that makes them count."""
    models.write.mode("errorifexists").partitionBy(model_day).parquet(f"{path}/version={version}")


def model_days(spark: SparkSession, path: str, model_day: str = "model_dt") -> dict[_dt.date, int]:
    """For each stored model day the newest committed version that has it."""
    newest: dict[_dt.date, int] = {}
    for v in committed_versions(spark, path):
        for name in _names(spark, f"{path}/version={v}"):
            if name.startswith(f"{model_day}="):
                newest[_dt.date.fromisoformat(name.split("=", 1)[1])] = v
    return newest


def read_models(spark: SparkSession, path: str, days: Iterable[_dt.date] | None = None, model_day: str = "model_dt") -> DataFrame:
    """The newest committed models (of ``days`` only, if given), with ``model_day``."""
    newest = model_days(spark, path, model_day)
    if not newest:
        raise FileNotFoundError(f"no committed model in {path}")
    wanted = {d: v for d, v in newest.items() if days is None or d in set(days)}
    out = None
    for v in sorted(set(wanted.values()) or {max(newest.values())}):      # one scan per version that still has a newest day
        schema = StructType.fromJson(json.loads(_read_text(spark, f"{path}/{MARKERS}/{v}"))).add(model_day, "date")
        parts = [f"{path}/version={v}/{model_day}={d}" for d, own in wanted.items() if own == v]
        part = spark.read.option("basePath", f"{path}/version={v}").schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
        out = part if out is None else out.unionByName(part)
    return out
