"""Phrase collocation mining with Rabin-Karp fingerprints.

Words are hashed by prefix polynomials over a batch's bytes, and every n-gram of
words by prefix polynomials over the word hashes, all in numpy. The n-grams are
counted in rounds (words, pairs, three words, then four and five), each by a shuffle
that adds up fingerprints, each with the place of one occurrence. An n-gram is
looked at only if its parts were frequent in the round before; the frequent
fingerprints travel as a bit table of fixed size, whose false hits only cost counting.

Two n-grams are taken for one only if a fingerprint of 64 bits and a check of 32
bits from another polynomial agree. Phrases are then read from the text at their
places, the frequent ones alone, and a place counts only if the text that stands
there has both numbers: so colliding fingerprints are told apart, and a place
that several documents share (its document is named by 27 bits) finds its own.

Scale: a task adds its counts up before it sends them, so a common phrase is a few
rows a task, whatever its share of the corpus. The place kept is the least, so few
documents are read again. Nothing is broadcast but bit tables of ``FILTER_BITS`` and
document keys of a checked size; a corpus with more frequent phrases than the table
tells apart is counted with less pruning and the same result.

Cases: null text is empty, null language is ``und``; an empty text has no word; very
long texts are cut out of their batch alone; repeated rows each count; ties go by
count, then phrase in UTF-8 order; null ids are ids; other columns are not read; no
rows, or no frequent phrase, give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textops import U64, column_bytes, mix, slices, small_batches, tidy

LEAST = 100                      # occurrences of a frequent phrase
MOST_WORDS = 5
TOP = 2000                       # phrases reported per language
FILTER_BITS = 25                 # log2 of the bits of a table of frequent fingerprints
SLICE_BYTES = 500_000            # text hashed at once
HELD = 1 << 20                   # fingerprints a task holds before it sends their counts
BROADCAST_BYTES = 16 << 20       # document keys are broadcast up to this size, else joined by shuffle
RANK_PARTS = 32

_BASE = (U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93))          # odd, so they have inverses modulo 2^64
_BREAK, _BLANK = 1, 2


def _byte_kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[[ord(c) for c in ".,;:!?\n\v\f\r"]] = _BREAK
    kind[[0x20, 0x09]] = _BLANK
    return kind


def _lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    return t


KIND, LOWER = _byte_kinds(), _lower()
_BYTE = [mix(np.arange(256, dtype=np.uint64), 61 + stream) for stream in range(2)]       # a byte's value in the polynomial


@lru_cache(maxsize=8)
def _power_pair(stream: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASE[stream]
    inverse = U64(pow(int(base), -1, 1 << 64))
    out = []
    for b in (base, inverse):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _powers(stream: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a stream's base, and of its inverse, for at least ``size`` places."""
    if size > 1 << 21:
        return _power_pair.__wrapped__(stream, size)       # a very long text: not kept
    return _power_pair(stream, 1 << max(10, (size - 1).bit_length()))


def prefix_polynomial(values: np.ndarray, stream: int) -> np.ndarray:
    """``P[i]``: sum of ``values[j] * base^j`` for ``j < i``, modulo 2^64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(stream, len(values) + 1)[0][:len(values)], dtype=np.uint64, out=out[1:])
    return out


def between(prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray, stream: int) -> np.ndarray:
    """Polynomial hash of the values ``lo[i]:hi[i]``, alike wherever they stand."""
    return (prefix[hi] - prefix[lo]) * _powers(stream, len(prefix))[1][lo]


class Pieces:
    """Words of a batch: byte bounds, row, and ``run``: how many words of the same
    piece begin at each one, itself among them, at most MOST_WORDS."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        kind = KIND[buf]
        word = np.zeros(len(buf) + 2, bool)
        word[1:-1] = kind == 0
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True                                    # a word never crosses rows
        self.start = np.flatnonzero(word[1:] & (~word[:-1] | edge))
        self.end = np.flatnonzero(word[:-1] & (~word[1:] | edge))
        self.row = np.searchsorted(off, self.start, side="right") - 1
        breaks = np.concatenate([[0], np.cumsum(kind == _BREAK)])
        piece = breaks[self.start] + self.row               # both only grow: equal in the same piece of the same row
        self.run = np.ones(len(piece), np.int8)
        for m in range(1, MOST_WORDS):
            self.run[:-m] += piece[m:] == piece[:-m]
        self.low = LOWER[buf]

    def fingerprints(self, stream: int, seed: np.ndarray, sizes, bits: int = 64) -> dict[int, np.ndarray]:
        """Of the ``m`` words from each word on, for each ``m`` of ``sizes`` (0 where the piece
        ends before); ``seed`` sets languages apart. ``bits`` below 64 weakens them (tests)."""
        over = prefix_polynomial(_BYTE[stream][self.low], stream)
        words = mix(between(over, self.start, self.end, stream) + (self.end - self.start).astype(np.uint64), stream + 2)
        over, out = prefix_polynomial(words, stream), {}
        own = seed[self.row] if len(self.row) else np.zeros(0, np.uint64)
        for m in sizes:
            at = np.flatnonzero(self.run >= m)
            out[m] = np.zeros(len(self.start), np.uint64)
            out[m][at] = mix(between(over, at, at + m, stream) ^ own[at], 4 + m) >> U64(64 - bits)
        return out


# ---------------------------------------------------------- frequent fingerprints
def _probes(fp: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(fp, 51 + s) >> U64(64 - bits) for s in range(2)]


def passes(table: np.ndarray | None, fp: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    """Which fingerprints the bit table has (all, without a table)."""
    ok = np.ones(len(fp), bool)
    for p in _probes(fp, bits) if table is not None else []:
        ok &= (table[p >> U64(6)] >> (p & U64(63))) & U64(1) == 1
    return ok


def bit_table(frequent: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The fingerprints ``fp`` of a table as 2^bits bits: tasks make words of 64 bits,
    a shuffle joins them, and at most 2^bits / 64 words come to the driver."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.concatenate(_probes(np.asarray(b.column(0)).view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array((p >> U64(6)).astype(np.int32)), pa.array((U64(1) << (p & U64(63))).view(np.int64))], names=["word", "bits"])

    out = np.zeros(1 << max(0, bits - 6), np.uint64)
    rows = frequent.select("fp").mapInArrow(words, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[np.asarray(rows["word"])] = np.asarray(rows["bits"]).view(np.uint64)
    return out


# ------------------------------------------------------------------ text passes
def _read(docs: DataFrame) -> DataFrame:
    """``doc`` (27 bits), ``lang``, its hash ``seed`` and ``text``."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(F.shiftrightunsigned(F.xxhash64("doc_id", "text", lang), 37).alias("doc"), lang.alias("lang"),
                       F.xxhash64(lang).alias("seed"), "text")


def _place(doc: np.ndarray, lo: np.ndarray, m: int) -> np.ndarray:
    """A document, a byte of its text and a number of words, in 27, 33 and 3 bits."""
    return (doc << 36) | (lo << 3) | m


def _candidates(p: Pieces, fps: dict[int, np.ndarray], table: tuple[int, np.ndarray] | None, sizes, bits: int) -> dict[int, np.ndarray]:
    """Places of the n-grams of each size whose parts, of as many words as the table's, may all be frequent."""
    if table is not None:
        at = np.flatnonzero(p.run >= table[0])
        maybe = np.zeros(len(p.run), bool)
        maybe[at] = passes(table[1], fps[table[0]][at], bits)
    out = {}
    for m in sizes:
        at = np.flatnonzero(p.run >= m)
        for j in range(m - table[0] + 1) if table is not None else ():
            at = at[maybe[at + j]]
        out[m] = at
    return out


def _sum_places(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """Rows ``fp, check, n, place`` with counts added up and the least place of equal ones."""
    fp, check, n, place = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(fp)
    if len(fp) and not (check[order][1:] == check[order][:-1])[fp[order][1:] == fp[order][:-1]].all():
        order = np.lexsort([check, fp])                    # one fingerprint, different phrases
    fp, check, n, place = fp[order], check[order], n[order], place[order]
    new = np.ones(len(fp), bool)
    new[1:] = (fp[1:] != fp[:-1]) | (check[1:] != check[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return fp, check, n, place
    return fp[at], check[at], np.add.reduceat(n, at), np.minimum.reduceat(place, at)


def counts(docs: DataFrame, sizes: tuple[int, ...], table: tuple[int, np.ndarray] | None = None, fp_bits: int = 64, bits: int = FILTER_BITS,
           held: int = HELD) -> DataFrame:
    """``fp, check, n, place`` of the n-grams of ``sizes`` words (0, with ``check`` -1: all words of a
    language), added up within a task, which sends them when it holds too many different ones, and
    then over tasks; ``place`` is that of one occurrence. ``table``: a number of words, and the bit
    table of the frequent n-grams of so many."""
    shipped, grams = docs.sparkSession.sparkContext.broadcast(table), [m for m in sizes if m]

    def count(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        buf, off = column_bytes(part.column(3))
        p, seed, doc = Pieces(buf, off), np.asarray(part.column(2)).view(np.uint64), np.asarray(part.column(0))
        known = shipped.value
        fps, checks = p.fingerprints(0, seed, {*grams, *([known[0]] if known else [])}, fp_bits), p.fingerprints(1, seed, grams)
        found = []
        for m, at in _candidates(p, fps, known, grams, bits).items():
            row = p.row[at]
            found.append((fps[m][at], (checks[m][at] >> U64(32)).astype(np.int64), np.ones(len(at), np.int64), _place(doc[row], p.start[at] - off[row], m)))
        if 0 in sizes:
            row, n = np.unique(p.row, return_counts=True)
            found.append((seed[row], np.full(len(row), -1), n, _place(doc[row], np.zeros(len(row), np.int64), 0)))
        return _sum_places(found)

    def send(*cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(cols[0]), 1 << 15):
            yield pa.RecordBatch.from_arrays([pa.array(c[a:a + (1 << 15)].view(np.int64)) for c in cols], names=_COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                kept.append(count(part))
                if sum(len(x[0]) for x in kept) > 2 * held:
                    kept = [_sum_places(kept)]
                    if len(kept[0][0]) > held:
                        yield from send(*kept[0])
                        kept = []
        if kept:
            yield from send(*_sum_places(kept))

    small_batches(docs.sparkSession)
    return _read(docs).mapInArrow(tidy(run), ", ".join(f"{c} long" for c in _COUNTED)).groupBy("fp", "check") \
        .agg(F.sum("n").alias("n"), F.min("place").alias("place"))


_COUNTED = ["fp", "check", "n", "place"]
ROUNDS = ((0, 1), (2,), (3,), (4, 5))


def frequent_places(docs: DataFrame, least: int = LEAST, fp_bits: int = 64, bits: int = FILTER_BITS) -> DataFrame:
    """Phrases of 1 to MOST_WORDS words with ``n`` occurrences in a language, at least
    ``least``, each with one place; 0 words: all words of a language."""
    table, out = None, None
    for sizes in ROUNDS:
        found = counts(docs, sizes, table, fp_bits, bits).where((F.col("n") >= least) | (F.col("check") < 0))
        found = materialize(found, "col_frequent")
        if sizes != ROUNDS[-1]:
            table = sizes[-1], bit_table(found, bits)
        out = found if out is None else out.unionByName(found)
    return out


def _next_words(raw: bytes, lo: int, m: int) -> bytes:
    """``m`` words from byte ``lo`` on, joined by a space, as they are written."""
    found = _WORD.finditer(raw, lo)
    return b" ".join(x[0] for x in islice(found, m))


_WORD = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]+")


def read_phrases(docs: DataFrame, places: DataFrame, fp_bits: int = 64) -> DataFrame:
    """``lang, words, n, phrase`` (words joined by a space): each place is read from its text,
    and counts only if what stands there has both its numbers."""
    wanted = places.groupBy(F.shiftrightunsigned("place", 36).alias("d")).agg(F.collect_list(F.struct(*_COUNTED)).alias("want"))
    wanted = materialize(wanted, "col_places")
    texts = _read(docs)
    if wanted.count() * 16 <= BROADCAST_BYTES:             # of the texts that hold no place, only the key is looked at
        texts = texts.join(F.broadcast(wanted.select("d")), F.col("doc") == F.col("d"), "left_semi")
    met = texts.join(wanted.hint("merge"), F.col("doc") == F.col("d")).select("lang", "seed", "text", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", SLICE_BYTES):
                row, said, want = [], [], []
                for i in range(b.num_rows):
                    raw = (b.column(2)[i].as_py() or "").encode()
                    for w in b.column(3)[i].as_py():
                        row.append(i)
                        want.append((w["fp"], w["check"], w["n"], w["place"] & 7))
                        said.append(_next_words(raw, (w["place"] >> 3) & ((1 << 33) - 1), w["place"] & 7))
                if not row:
                    continue
                row, (fp, check, n, words) = np.array(row), (np.array(c) for c in zip(*want))
                buf, off = column_bytes(pa.array(said, pa.binary()))
                p, seed = Pieces(buf, off), np.asarray(b.column(1)).view(np.uint64)[row]
                lead = np.searchsorted(p.row, np.arange(len(row)))
                right = np.bincount(p.row, minlength=len(row)) == words
                own, other = p.fingerprints(0, seed, range(1, MOST_WORDS + 1), fp_bits), p.fingerprints(1, seed, range(1, MOST_WORDS + 1))
                for m in range(1, MOST_WORDS + 1):
                    at = np.flatnonzero(right & (words == m))
                    right[at] = (own[m][lead[at]] == fp[at].view(np.uint64)) & ((other[m][lead[at]] >> U64(32)).astype(np.int64) == check[at])
                zero = words == 0                          # of a language: the document must have it
                right[zero] = seed[zero] == fp[zero].view(np.uint64)
                keep = np.flatnonzero(right)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row[keep])), pa.array(words[keep].astype(np.int32)), pa.array(n[keep]),
                     pa.array([LOWER[np.frombuffer(said[i], np.uint8)].tobytes().decode() for i in keep], pa.string())],
                    names=["lang", "words", "n", "phrase"])

    return met.mapInArrow(tidy(run), "lang string, words int, n long, phrase string").dropDuplicates(["lang", "phrase"])


# ------------------------------------------------------------------ collocations
def best_cuts(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of the phrases of two words or more, by the cut
    that scores least (ties: the earliest)."""
    part = F.split("phrase", " ")
    cut = phrases.where("words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))) \
        .select("lang", "phrase", "words", F.col("n").alias("a"), "k", F.array_join(F.slice(part, 1, F.col("k")), " ").alias("left"),
                F.array_join(F.slice(part, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    one = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))     # noqa: E731
    whole = lambda c: F.col(c).cast("decimal(18,0)")                                                             # noqa: E731
    met = cut.join(one("left", "l"), ["lang", "left"]).join(one("right", "r"), ["lang", "right"]).join(totals, "lang")
    score = F.call_function("div", whole("a") * whole("n") * F.lit(1000).cast("decimal(4,0)"), whole("l") * whole("r"))
    return met.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x")) \
        .select("lang", "phrase", "words", "a", "n", "x.l", "x.r", "x.score")


def without_fragments(scored: DataFrame) -> DataFrame:
    """``scored`` without phrases that lie inside a longer one that occurs as often."""
    part, size = F.split("phrase", " "), F.col("words")
    inner = scored.where("words > 2").select("lang", "a", "words", part.alias("part")) \
        .withColumn("k", F.explode(F.sequence(F.lit(2), size - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), size - F.col("k") + 1))) \
        .select("lang", F.array_join(F.slice("part", F.col("at"), F.col("k")), " ").alias("phrase"), F.col("a").alias("longer"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return scored.join(most, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, fp_bits: int = 64, bits: int = FILTER_BITS) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    read = materialize(read_phrases(docs, frequent_places(docs, least, fp_bits, bits), fp_bits), "col_phrases")
    phrases, totals = read.where("words > 0"), read.where("words = 0").select("lang", "n")
    kept = without_fragments(materialize(best_cuts(phrases, totals), "col_scored"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))      # a language's phrases are ranked in parts first
    few = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
        .where(F.col("rank") <= top).drop("part", "rank")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
