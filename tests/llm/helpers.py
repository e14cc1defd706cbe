"""Brute-force versions and small inputs shared by the tests of the llm operators."""

import random
import re

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def spans_of(flags):
    """Number of maximal runs of true values."""
    return sum(1 for i, f in enumerate(flags) if f and not (i and flags[i - 1]))


def rand_text(rng, n, vocab):
    return "".join(rng.choice(vocab) + rng.choice([" ", " ", ". ", "\n", "-"]) for _ in range(n))


def docs_frame(spark, rows, parts=3):
    """``documents`` rows from (doc_id, text) pairs."""
    full = [(i, t, "en", f"s{(i or 0) % 3}", len(t) if t is not None else None) for i, t in rows]
    return spark.createDataFrame(full, DOC).repartition(parts)


def rng(seed=1):
    return random.Random(seed)
SF_ORACLE = "/root/testdata/sf0.01"
