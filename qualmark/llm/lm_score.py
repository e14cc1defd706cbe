"""Cross-entropy difference of two n-gram models with one vocabulary.

A target model (documents marked as target) and a background model (all
documents) are bigram models over the same vocabulary, every distinct word of
the corpus. Both use additive smoothing; the target's smoothing mass is scaled
by the models' token counts, so that both are smoothed alike:

    p(w | v) = (c(v, w) + a) / (c(v) + a V),   a = alpha * N_model / N_background

A document's score is its mean loss per token under the target model less that
under the background model: the lower, the more it reads like the target.

Both counts of a gram and of a history are needed for every token, and neither
table has a bound, so nothing is broadcast. Documents are packed once into
compressed batches. A batch asks for its distinct grams, sorted and packed by
hash range; each range adds up all batches' counts and answers every batch in
the order of its question; a batch then scores its documents. A gram that
occurs everywhere costs one entry per batch, on either way.

Cases: null or wordless text has 0 tokens and null losses; a document without
label is background only; with no target at all the target model is uniform;
repeated rows each count and are each scored; a repeated target id counts
once; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .packing import batch_text, expand, pack_documents, rows_of, squeeze
from .textops import U64, Words, mix

ALPHA = 0.01
RANGE_GRAMS = 750_000           # gram entries per hash range, about
START = U64(0x5851F42D4C957F2D)  # history of a document's first word
KEY_BITS = 56                   # grams are told apart by 56 bits of hash


class Grams:
    """Distinct histories and pairs of a batch in key order; ``hist`` and ``pair``
    give, per token, the place of its history and of its gram.

    A document's last word is listed as a history that follows nothing, so that
    the histories, less the start mark, are the vocabulary.
    """

    def __init__(self, lens: bytes, text: bytes):
        w = Words(*batch_text(lens, text))
        self.rows, self.count = np.repeat(np.arange(len(w.count)), w.count), w.count
        hist = np.empty_like(w.hash)
        hist[1:] = w.hash[:-1]
        hist[w.first[:-1][w.count > 0]] = START
        last = w.hash[w.first[1:][w.count > 0] - 1]
        pair = mix(hist * U64(0x9E3779B97F4A7C15) + w.hash, 3) >> U64(64 - KEY_BITS)
        every = np.concatenate([_history_key(hist), pair & ~U64(1), _history_key(last)])
        self.keys, at = np.unique(every, return_inverse=True)
        t = len(w.hash)
        self.hist, self.pair = at[:t], at[t:2 * t]

    def counts(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Background and target counts of every key; ``target`` marks documents."""
        n = len(self.keys)
        at = np.concatenate([self.hist, self.pair])
        bg = np.bincount(at, minlength=n)
        mark = target[self.rows]
        return bg, np.bincount(at[np.tile(mark, 2)], minlength=n)


def _history_key(h: np.ndarray) -> np.ndarray:
    """Key of a history: odd (a pair's is even)."""
    return (mix(h, 2) >> U64(64 - KEY_BITS)) | U64(1)


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Bounds of ``n`` equal hash ranges in sorted keys."""
    edge = [(i << KEY_BITS) // n for i in range(1, n)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edge, np.uint64)), [len(keys)]]).astype(np.int64)


def _questions(packed: DataFrame, marks: DataFrame, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lens, text, name, target = (batch.column(c)[i].as_py() for c in range(4))
                g = Grams(lens, text)
                mark = np.zeros(len(g.count), bool)
                mark[np.array(target or [], np.int64)] = True
                bg, tg = g.counts(mark)
                at = _ranges(g.keys, ranges)
                rows = []
                for r in range(ranges):
                    a, b = at[r], at[r + 1]
                    if b > a:
                        step = np.diff(g.keys[a:b], prepend=U64(0))
                        rows.append((r, name, int(b - a), squeeze(step), squeeze(bg[a:b].astype(np.uint32)),
                                     squeeze(tg[a:b].astype(np.uint32))))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*rows), _QTYPES)], names=_QNAMES)

    return packed.select("lens", "text", "batch").join(marks, "batch", "left").select("lens", "text", "batch", "target") \
        .mapInArrow(run, "range int, batch string, n int, steps binary, bg binary, tg binary")


_QNAMES = ["range", "batch", "n", "steps", "bg", "tg"]
_QTYPES = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
ANSWER = "range int, batch string, bg binary, tg binary, words long, tokens long, target_tokens long"
_ATYPES = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _answers(questions: DataFrame, ranges: int) -> DataFrame:
    """Add up a range's counts over all batches, and answer each batch. One row
    per range (batch null) also reports its distinct words and their tokens."""

    def answer(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([np.cumsum(expand(r[3], np.uint64), dtype=np.uint64) for r in rows])
        own, at = np.unique(keys, return_inverse=True)
        del keys
        bg = np.bincount(at, weights=np.concatenate([expand(r[4], np.uint32) for r in rows]), minlength=len(own))
        tg = np.bincount(at, weights=np.concatenate([expand(r[5], np.uint32) for r in rows]), minlength=len(own))
        bg, tg = bg.astype(np.int64), tg.astype(np.int64)
        hist = (own & U64(1)) == 1
        words = int(hist.sum()) - int((own == _history_key(np.array([START]))).sum())
        start = 0
        for r in rows:
            mine = at[start:start + r[2]]
            start += r[2]
            yield _answer_batch([(r[0], r[1], squeeze(bg[mine]), squeeze(tg[mine]), None, None, None)])
        yield _answer_batch([(rows[0][0], None, None, None, words, int(bg[hist].sum()), int(tg[hist].sum()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []                      # rows arrive sorted by range: one range is held at a time
        for batch in batches:
            for row in rows_of(batch):
                if held and held[0][0] != row[0]:
                    yield from answer(held)
                    held = []
                held.append(row)
        if held:
            yield from answer(held)

    return questions.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(run, ANSWER)


def _answer_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _ATYPES)],
                                      names=[x.split()[0] for x in ANSWER.split(", ")])


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, alpha: float = ALPHA,
                             range_grams: int = RANGE_GRAMS) -> DataFrame:
    """``doc_id, n_tokens, loss_target, loss_background, score`` per row of ``docs``.

    ``target_ids``: ``doc_id`` of the documents that train the target model.
    """
    packed = pack_documents(docs, "lm_docs")
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, -(-total // (6 * range_grams)))              # about a word each 6 bytes; grams repeat within a batch
    marks = packed.select("batch", F.posexplode("doc_ids").alias("pos", "doc_id")) \
        .join(target_ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct(), "doc_id") \
        .groupBy("batch").agg(F.collect_list("pos").alias("target"))
    answers = materialize(_answers(_questions(packed, marks, ranges), ranges), "lm_counts")
    words, n_bg, n_tg = answers.where(F.col("batch").isNull()) \
        .agg(F.sum("words"), F.sum("tokens"), F.sum("target_tokens")).first()
    v, n_bg, n_tg = words or 1, n_bg or 0, n_tg or 0
    a_bg, a_tg = alpha, alpha * n_tg / n_bg if n_tg and n_bg else alpha

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lens, text, ids, got = (batch.column(c)[i].as_py() for c in range(4))
                g = Grams(lens, text)
                loss, n = [], g.count
                got = sorted(got or [], key=lambda x: x["range"])
                for side, a in (("tg", a_tg), ("bg", a_bg)):
                    c = np.concatenate([expand(x[side], np.int64) for x in got]) if got else np.zeros(0, np.int64)
                    per = np.log(c[g.hist] + a * v) - np.log(c[g.pair] + a)
                    loss.append(np.bincount(g.rows, weights=per, minlength=len(n)) / np.maximum(n, 1))
                none = n == 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n.astype(np.int64)), pa.array(loss[0], mask=none),
                     pa.array(loss[1], mask=none), pa.array(loss[0] - loss[1], mask=none)],
                    names=["doc_id", "n_tokens", "loss_target", "loss_background", "score"])

    mine = answers.where(F.col("batch").isNotNull()).groupBy("batch") \
        .agg(F.collect_list(F.struct("range", "bg", "tg")).alias("got"))
    return packed.select("lens", "text", "doc_ids", "batch").join(mine, "batch", "left") \
        .select("lens", "text", "doc_ids", "got") \
        .mapInArrow(score, "doc_id long, n_tokens long, loss_target double, loss_background double, score double")
