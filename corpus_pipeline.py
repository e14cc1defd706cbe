"""Training-data pipeline over ``documents``: five stages of the ``llm`` operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared folder and rereads it as the next one's
input. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualmark.llm import fm_decon, langid, line_dedup, mixing, ngram_join
from qualmark.session import materialize

ORACLE_SQL = None       # a trained network decides the first stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text; a document left without text goes."""
    return docs.where(F.length(F.trim("text")) > 0).withColumn("n_chars", F.length("text").cast("long"))


def _free_name(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    while name in docs.columns:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those with a score, or with byte pairs, that
    hardly any labelled document of their length has; a missing ``lang`` is filled with the
    prediction. Model, byte pairs and limits come from all labelled documents, whole texts.
    Without labelled documents only the letter counts."""
    model, scores, fits = langid.learn(docs)
    if model is None:
        return docs.where(langid.has_letter())
    names = tuple(_free_name(docs, c) for c in ("__language", "__score", "__fit"))
    out = langid.predict(docs, model, docs.columns, names)
    language, score, fit = map(F.col, names)
    kept = out.where((language != langid.UND) & (score >= langid.by_length(scores)) & (fit >= langid.by_length(fits)))
    return kept.withColumn("lang", F.coalesce("lang", language)).select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later occurrences of three-line windows."""
    return _with_text(line_dedup.line_dedup(docs).drop("line_dedup"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every class of near duplicates."""
    return ngram_join.keep_first(docs)


def remove_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of the text."""
    return _with_text(fm_decon.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mixture: a row per draw, every source drawn at least once."""
    counted = docs.withColumn("n_tokens", mixing.token_count(F.col("text")))
    return mixing.schedule(mixing.mix(counted, budget=None))


STAGES = [
    ("language id", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram join", dedup_documents),
    ("decontamination", remove_contamination),
    ("source mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
