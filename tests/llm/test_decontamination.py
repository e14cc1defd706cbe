import hashlib

import numpy as np
import pyarrow as pa
from helpers import docs_frame, rand_text, rng, words
from hypothesis import given, settings
from hypothesis import strategies as st

from qualmark.llm import fm_decon as fm


def brute(docs, bench, k=10):
    wins = {}
    for item, text in bench:
        w = words(text)
        n = min(k, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for win, ids in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    items |= ids
        listed = ",".join(sorted(map(str, items - {None})))
        out.append((doc_id, len(w), len(hit), len(items - {None}), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def some(seed):
    r = rng(seed)
    vocab = ["a", "B", "é", "xx", "9", "Ä", "q", "zz", "the"]
    bench = [(i, rand_text(r, r.choice([1, 3, 9, 10, 11, 15, 40]), vocab)) for i in range(6)]
    bench += [(90, None), (91, ""), (92, "..."), (93, bench[0][1]), (None, bench[1][1])]
    docs = [(i, r.choice(["", rand_text(r, r.randint(1, 60), vocab), rand_text(r, 30, vocab) + " " + r.choice(bench[:6])[1]]))
            for i in range(40)]
    docs += [(50, None), (51, rand_text(r, 3000, vocab)), (52, "x"), (3, docs[3][1])]
    return docs, bench


def test_report_equals_brute_force(spark):
    docs, bench = some(1)
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = sorted(tuple(x) for x in fm.contamination_report(docs_frame(spark, docs), b).collect())
    assert got == sorted(brute(docs, bench))
    assert any(x[5] for x in got) and not all(x[5] for x in got)


def test_blocks_of_phrases_add_up(spark):
    docs, bench = some(2)
    b = spark.createDataFrame(bench, "item_id long, text string")
    one = fm.contamination_spans(docs_frame(spark, docs, 1), b)
    many = fm.contamination_spans(docs_frame(spark, docs, 1), b, block_bytes=60)
    cols = ["doc_id", "n_words", "spans", "byte_spans", "items"]
    assert sorted(map(str, one.select(*cols).collect())) == sorted(map(str, many.select(*cols).collect()))


def test_decontaminate_keeps_columns_and_clean_text(spark):
    clean = "ordinary words that no item holds at all"
    passage = "one two three four five six seven eight nine ten eleven"
    docs = docs_frame(spark, [(1, clean), (2, f"Start. {passage.upper()}! End."), (3, None), (4, passage)]) \
        .withColumnRenamed("lang", "row").withColumnRenamed("source", "items")
    out = fm.decontaminate(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: clean, 2: "Start. ! End.", 3: None, 4: ""}


def test_empty_tables(spark):
    docs, items = docs_frame(spark, [(1, "a b")]), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert fm.contamination_report(docs.limit(0), items).count() == 0
    assert [tuple(r)[1:4] for r in fm.contamination_report(docs, items.limit(0)).collect()] == [(2, 0, 0)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 9))
def test_index_finds_every_occurrence(seq, sample):
    s = np.array([0, *seq, 0])
    index = fm.FMIndex(s, 3, sample)
    for n in (1, 2, 3):
        pats = sorted({tuple(seq[i:i + n]) for i in range(len(seq) - n + 1) if 0 not in seq[i:i + n]} | {(1,) * n, (3,) * n})
        lo, hi = index.search(np.array(pats), np.full(len(pats), n))
        for p, a, b in zip(pats, lo, hi):
            where = sorted(index.locate(np.arange(a, b)).tolist())
            assert where == [i for i in range(len(s) - n + 1) if tuple(s[i:i + n]) == p]


def test_slices_cover_every_row():
    from qualmark.llm.textops import slices
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 100, 3, 3)])], names=["text"])
    parts = [p.num_rows for p in slices(batch, "text", 10)]
    assert sum(parts) == 5 and max(parts) <= 3
