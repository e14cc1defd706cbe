import os
import subprocess
import sys

import pytest
from helpers import docs_frame, rng, words
from pyspark.sql import functions as F

import corpus_pipeline as cp
from qualmark.llm import queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def small_world(spark, tmp_path):
    r = rng(7)
    en = ["the", "and", "that", "with", "house", "thing", "over", "water", "light", "where"]
    de = ["der", "und", "nicht", "über", "haus", "ding", "schön", "wasser", "licht", "wohin"]
    text = lambda v, n: " ".join(r.choice(v) + str(r.randint(0, 99)) if r.random() < 0.5 else r.choice(v) for _ in range(n))
    passage = text(en, 30)
    rows = [(i, text(de if i % 3 == 0 else en, 60), "de" if i % 3 == 0 else "en", "hot" if i % 2 else f"s{i % 4}") for i in range(80)]
    near = rows[5][1].split()
    near[7] = "changed"
    shared = "\n".join(text(en, 8) for _ in range(4))
    rows += [(100, rows[4][1], "en", "hot"), (101, " ".join(near), "en", "s0"), (102, text(en, 40) + " " + passage + " " + text(en, 40), "en", "hot"),
             (103, None, None, "hot"), (104, "1234 !!", "en", "s0"), (105, shared + "\n" + text(en, 50), "en", "hot"),
             (106, text(en, 50) + "\n" + shared, None, None), (107, passage, "en", "hot")]
    src = str(tmp_path / "w")
    spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{src}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{src}/benchmark.parquet")
    return src, rows, passage, shared


def test_stages_decide(spark, tmp_path):
    src, rows, passage, shared = small_world(spark, tmp_path)
    docs, seen = spark.read.parquet(f"{src}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, src)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == cp.COLUMNS
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    ids = lambda name: set(seen[name])
    assert ids("language id") == {r[0] for r in rows} - {103, 104}
    assert seen["line dedup"][105].startswith(shared) and shared not in seen["line dedup"][106]
    assert ids("line dedup") == ids("language id")
    assert ids("n-gram join") == ids("line dedup") - {100, 101}
    assert ids("decontamination") == ids("n-gram join") - {107}
    assert passage not in seen["decontamination"][102] and len(words(seen["decontamination"][102])) >= 80
    assert ids("source mixing") == ids("decontamination")
    clean = set(range(80)) - {4, 5}
    assert all(seen["decontamination"][i] == rows[i][1] for i in clean)


def test_run_equals_the_stages(spark, tmp_path):
    src, *_ = small_world(spark, tmp_path)
    docs = spark.read.parquet(f"{src}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, src)
    order = lambda df: sorted(map(str, df.collect()))
    assert order(cp.run(spark, src)) == order(docs)


def test_stages_take_nulls_and_no_rows(spark, tmp_path):
    src, *_ = small_world(spark, tmp_path)
    odd = docs_frame(spark, [(None, None), (None, "text without a number"), (1, ""), (1, "")]).withColumn("source", F.lit(None).cast("string"))
    for df in (odd, odd.limit(0)):
        for _, stage in cp.STAGES:
            stage(spark, df, src).collect()


def test_stages_take_clashing_columns(spark, tmp_path):
    src, *_ = small_world(spark, tmp_path)
    docs = spark.read.parquet(f"{src}/documents.parquet")
    for name in ("score", "__language", "__score", "lang_pred", "row", "key", "batch", "hash", "first", "spans", "items", "starts", "tokens", "s", "end"):
        docs = docs.withColumn(name, F.lit(name))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, src)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select("score", "row", "batch", "end").distinct().collect()} == {("score", "row", "batch", "end")}
    assert set(docs.columns) <= set(cp.STAGES[-1][1](spark, docs, src).columns)
    assert cp.STAGES[-1][1](spark, docs.withColumn("mix", F.lit(1)).withColumn("n_tokens", F.lit("x")), src).count() > 0


@pytest.mark.parametrize("left_out", ["en", "es", "de", "fr"])
def test_language_score_decides(spark, left_out):
    """Learned languages stay, one that no label names goes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(*cp.COLUMNS)
    known = docs.where(F.col("lang") != left_out)
    other = docs.where(F.col("lang") == left_out).withColumn("lang", F.lit(None).cast("string"))
    kept = {r.doc_id for r in cp.identify_language(spark, known.unionByName(other), "").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert len(ids(known) & kept) > 0.97 * known.count()
    assert len(ids(other) & kept) < 0.2 * other.count()


def test_documents_stay_without_a_language_model(spark):
    docs = docs_frame(spark, [(1, "some text"), (2, "12"), (3, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert [(r.doc_id, r.lang) for r in cp.identify_language(spark, docs, "").collect()] == [(1, None)]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [s[0] for s in cp.STAGES] == ["language id", "line dedup", "n-gram join", "decontamination", "source mixing"]


def test_entry_without_the_subpackage(tmp_path):
    for name in ("qualmark", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", os.path.join(ROOT, name), str(tmp_path)], check=True)
    (tmp_path / "qualmark" / "llm").rename(tmp_path / "gone")
    code = "import __spark_entry__ as e; n = e.queries(); print(len(n), any(x.startswith('op') for x in n), 'pipeline' in n)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0 and out.stdout.split()[1:] == ["False", "False"], out.stderr


def test_language_id_learns_from_every_row(spark):
    """Texts of a kind that no sampled row has are labelled, so they are learned and set the limits."""
    r = rng(3)
    ids = [x.id for x in spark.range(700).orderBy(F.xxhash64("id"), "id").collect()]     # the first 300 of a language were the sample
    text = lambda v: " ".join(r.choice(v) for _ in range(40))
    en, de, odd = ["the", "and", "that", "with", "house"], ["der", "und", "nicht", "haus", "wohin"], ["qxj", "zvk", "xqz", "kjv", "vzx"]
    rows = [(i, text(odd), "en") for i in ids[-60:]] + [(i, text(en), "en") for i in ids[:400]] + [(i, text(de), "de") for i in ids[400:640]]
    docs = spark.createDataFrame([(*x, "s", len(x[1])) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {x.doc_id for x in cp.identify_language(spark, docs, "").collect()}
    assert len(kept & set(ids[-60:])) >= 58 and len(kept) >= 690
