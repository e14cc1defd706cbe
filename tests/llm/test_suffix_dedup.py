import numpy as np
from helpers import docs_frame, rng
from hypothesis import given, settings
from hypothesis import strategies as st

from qualmark.llm import suffix_dedup as sd


def brute(docs, length=sd.LENGTH):
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(b[i:i + length])
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((doc_id, len(b), int(gone.sum()), int((edge == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def corpus(seed):
    r = rng(seed)
    rand = lambda n: "".join(r.choice("abcdefgh é\n") for _ in range(n))
    passages = [rand(r.randint(80, 400)) for _ in range(6)]
    docs = []
    for i in range(120):
        t = "".join(r.choice([rand(r.randint(0, 150)), r.choice(passages), r.choice(passages)[r.randint(0, 60):]])
                    for _ in range(r.randint(0, 5)))
        if i % 17 == 0:
            t = r.choice([None, "", "a" * r.choice([50, 99, 100, 101, 700]), "ab" * 300, rand(30) * 9])
        if i % 9 == 0 and docs:
            t = docs[r.randrange(len(docs))][1]
        docs.append((i * 3 % 121, t))
    return docs


def results(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def test_equals_brute_force_over_ranges_and_groups(spark):
    docs = corpus(3)
    got = results(sd.suffix_dedup(docs_frame(spark, docs), fan_in=2, range_suffixes=200, batch_bytes=4000))
    assert got == sorted(brute(docs))
    assert any(r[2] for r in got)


def edges_of_a_passage(seed):
    """Every document holds parts of one passage between other texts, so suffixes near
    its ends have another context in every document."""
    r = rng(seed)
    rand = lambda n: "".join(r.choice("abcdefgh é\n") for _ in range(n))
    passage = rand(260)
    docs = [(i, rand(r.randint(60, 90)) + passage[r.choice([0, 0, 30]):r.choice([260, 260, 190])] + rand(r.randint(60, 90))) for i in range(150)]
    return docs + [(i, docs[3][1]) for i in (7, 900)] + [(901, "a" * 600), (902, "b" + "a" * 400), (903, None)]


def test_edges_of_a_passage_in_many_documents(spark):
    docs = edges_of_a_passage(8)
    df = docs_frame(spark, docs)
    got = results(sd.suffix_dedup(df, fan_in=2, range_suffixes=40, batch_bytes=4000))
    texts = sorted(docs, key=lambda d: (d[0], d[1] or ""))
    whole = [x for x in brute(texts) if x[0] != 7]
    assert [x for x in got if x[0] != 7] == sorted(whole)        # id 7 has two texts, ordered by their hash
    assert sum(x[2] > 150 for x in got) > 130


def test_no_range_holds_all_edges_of_a_passage(spark):
    packed = sd.pack_documents(docs_frame(spark, edges_of_a_passage(9)), "test_sd", 4000)

    def largest(most, range_suffixes):
        src, leads = sd.repeated_suffixes(packed, most)
        hits = sum(r.hits for r in leads.collect())
        rows, _ = sd.cut_suffixes(src.where("hits > 0").drop("hits", "dealt"), hits, packed.count(), range_suffixes)
        n = {}
        for x in rows.where("names is not null").collect():
            n[x.range] = n.get(x.range, 0) + len(sd.Suffixes.decode(x[1:]).pos)
        return max(n.values(), default=0), sum(r.dealt for r in leads.collect())

    size, dealt = largest(10**9, 40)                              # nothing dealt: a boundary cannot part them
    assert size > 100 and dealt == 0
    size, dealt = largest(40, 40)
    assert size <= 120 and dealt > 100


def test_edges(spark):
    r = rng(5)
    long = "".join(r.choice("abcde ") for _ in range(700_000))
    docs = [(0, long), (1, "x" * 300_000), (2, None), (3, ""), (4, long[1000:1099]), (5, long[1000:1100]), (6, "y" + long[:250] + "z")]
    df = docs_frame(spark, docs).withColumnRenamed("source", "batch").withColumnRenamed("lang", "found")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in sd.suffix_dedup(df).collect()}
    assert got == {0: (700_000, 0, 0), 1: (300_000, 299_999, 1), 2: (0, 0, 0), 3: (0, 0, 0), 4: (99, 0, 0), 5: (100, 100, 1),
                   6: (252, 250, 1)}
    assert sd.suffix_dedup(df.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    r = rng(6)
    t = "".join(r.choice("abcde ") for _ in range(150))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in sd.suffix_dedup(
        docs_frame(spark, [(1, t), (1, t), (2, t), (None, "q" + t)])).collect())
    assert got == [(False, 1, 150), (False, 1, 150), (False, 2, 150), (True, 0, 0)]     # the null id comes first


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=9), min_size=1, max_size=30))
def test_multikey_sort(rows):
    m = np.zeros((len(rows), 16), np.uint8)
    for i, b in enumerate(rows):
        m[i, :len(b)] = list(b)
    order, new = sd.multikey_sort(m.view(">u8").astype(np.uint64))
    s = [m[i].tobytes() for i in order]
    assert s == sorted(s)
    assert list(new) == [i == 0 or s[i] != s[i - 1] for i in range(len(s))]


def test_equal_windows_choose_the_same_suffix():
    r = np.random.default_rng(1)
    core = r.integers(97, 101, 400).astype(np.uint8)
    a = np.concatenate([r.integers(97, 123, 50).astype(np.uint8), core])
    b = np.concatenate([r.integers(97, 123, 77).astype(np.uint8), core, r.integers(97, 123, 30).astype(np.uint8)])

    def offsets(buf, lead):
        at, lo, hi, _, _ = sd.choose_suffixes(buf, np.array([0, len(buf)]))
        return {s - lead: p - s for p, x, y in zip(at, lo, hi) for s in range(x, y + 1) if lead <= s <= lead + 300}

    assert offsets(a, 50) == offsets(b, 77) and len(offsets(a, 50)) == 301
