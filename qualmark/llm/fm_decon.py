"""Benchmark decontamination with one FM-index per training shard.

A shard is a bounded run of documents inside a task. Its words are mapped to
the benchmark's vocabulary; every run of words outside it becomes one
separator, since no phrase can cross it. Over that symbol sequence the shard
builds a suffix array, the Burrows-Wheeler transform, a wavelet tree for rank
and sampled suffix positions. All phrases are then searched backward together,
located by stepping to a sampled position, and their word spans merged.

Nothing is shuffled: phrases travel to the shards in blocks of bounded size,
and documents stay in their partition. Cases:

* null, empty or wordless text: 0 words, no hits; a wordless item has no window
* an item of fewer than ``window`` words is one window of all its words
* repeated documents or items are each reported; items of equal text all count
* null ``item_id``: its windows hit, but it has no id to list (it is not counted)
* extra columns are carried by the caller's join, never read here
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textops import Words, column_bytes, merge_spans, repeat_ranges, slices, small_batches, tidy

WINDOW = 10
SHARD_BYTES = 3 << 20            # text per shard
PHRASE_BLOCK_BYTES = 8 << 20     # benchmark text searched in one pass
SAMPLE = 8                       # every 8th suffix position is kept


# ------------------------------------------------------------------ phrases
class Phrases:
    """Windows of one block of benchmark items, over that block's vocabulary."""

    def __init__(self, item_ids: list, texts: list, window: int = WINDOW):
        w = Words(*column_bytes(pa.array([t or "" for t in texts], type=pa.string())))
        self.vocab, sym = np.unique(w.hash, return_inverse=True)
        rows, length = [], []
        for i in range(len(texts)):
            lo, n = w.first[i], w.count[i]
            if n == 0:
                continue
            k = min(window, n)
            for s in range(n - k + 1):
                row = np.full(window, -1, dtype=np.int32)
                row[:k] = sym[lo + s:lo + s + k]
                rows.append(row)
                length.append((k, i))
        self.window = window
        m = np.array(rows, dtype=np.int32).reshape(-1, window)
        own = np.array([x[1] for x in length], dtype=np.int64)
        self.rows, self.of_row = np.unique(m, axis=0, return_inverse=True) if len(m) else (m, own)
        self.of_row = np.asarray(self.of_row).reshape(-1)
        self.length = (self.rows >= 0).sum(axis=1)
        order = np.argsort(self.of_row, kind="stable")
        self.item_of = own[order]                                    # items of each distinct window
        self.item_at = np.searchsorted(self.of_row[order], np.arange(len(self.rows) + 1))
        self.item_ids = list(item_ids)


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = PHRASE_BLOCK_BYTES) -> Iterator[Phrases]:
    """Benchmark items in blocks of about ``block_bytes``, streamed through the driver."""
    ids, texts, size = [], [], 0
    for r in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).toLocalIterator():
        ids.append(r.item_id)
        texts.append(r.text)
        size += 4 * len(r.text)
        if size >= block_bytes:
            yield Phrases(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield Phrases(ids, texts, window)


# ----------------------------------------------------------------- FM-index
def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; only suffixes still tied are sorted again.

    ``rank`` holds non-negative symbols; a suffix that ends sorts first.
    """
    n = len(rank)
    if n == 0:
        return np.zeros(0, np.int64)
    sa = np.argsort(rank, kind="stable")
    s = rank[sa]
    new = np.ones(n, dtype=bool)
    new[1:] = s[1:] != s[:-1]
    cls = np.empty(n, dtype=np.int64)
    cls[sa] = np.flatnonzero(new)[np.cumsum(new) - 1]                 # class = first slot of its group
    k = 1
    while True:
        tied = ~new | np.append(~new[1:], False)
        slots = np.flatnonzero(tied)
        if not len(slots):
            return sa
        suf = sa[slots]
        nxt = np.where(suf + k < n, cls[np.minimum(suf + k, n - 1)], -1)
        order = np.lexsort((nxt, cls[suf]))
        suf, nxt = suf[order], nxt[order]
        sa[slots] = suf
        own = cls[suf]
        new[slots[1:]] |= (own[1:] == own[:-1]) & (nxt[1:] != nxt[:-1])
        group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        cls[sa[slots]] = group[slots]
        k *= 2


class WaveletTree:
    """Rank over a symbol sequence: one stably partitioned bit level per bit."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        cur = seq.astype(np.int64)
        for b in range(bits - 1, -1, -1):
            bit = (cur >> b) & 1
            ones = np.zeros(len(cur) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = len(cur) - int(ones[-1])
            self.levels.append((b, ones, zeros))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])      # wavelet matrix layout

    def rank(self, sym: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Number of ``sym[i]`` in the first ``pos[i]`` symbols."""
        lo, hi = np.zeros_like(pos), pos
        for b, ones, zeros in self.levels:
            one = ((sym >> b) & 1).astype(bool)
            l1, h1 = ones[lo], ones[hi]
            lo = np.where(one, zeros + l1, lo - l1)
            hi = np.where(one, zeros + h1, hi - h1)
        return hi - lo

    def access(self, pos: np.ndarray) -> np.ndarray:
        sym = np.zeros_like(pos)
        cur = pos
        for b, ones, zeros in self.levels:
            one = (ones[cur + 1] - ones[cur]).astype(bool)
            sym |= np.where(one, 1 << b, 0)
            cur = np.where(one, zeros + ones[cur], cur - ones[cur])
        return sym


class FMIndex:
    """Index of a sequence with symbols ``1..size`` and 0 for separators."""

    def __init__(self, seq: np.ndarray, size: int, sample: int = SAMPLE):
        n = len(seq)
        sep = seq == 0
        distinct = np.cumsum(sep) - 1                                 # separators differ, so ties end there
        sa = suffix_array(np.where(sep, distinct, seq + int(sep.sum())))
        self.n, self.sa_n = n, n
        self.wave = WaveletTree(seq[sa - 1], max(1, int(size).bit_length()))   # sa == 0 wraps to the last separator
        self.start = np.zeros(size + 2, dtype=np.int64)
        np.cumsum(np.bincount(seq, minlength=size + 1), out=self.start[1:])
        run_start = np.zeros(n, dtype=bool)
        run_start[0] = True
        run_start[1:] = sep[:-1]                                      # stepping back never crosses a separator
        keep = (sa % sample == 0) | run_start[sa]
        self.kept = keep
        self.kept_rank = np.concatenate([[0], np.cumsum(keep)])
        self.kept_pos = sa[keep]

    def search(self, rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of each phrase: read the phrase from its last word to its first."""
        lo = np.zeros(len(rows), dtype=np.int64)
        hi = np.full(len(rows), self.n, dtype=np.int64)
        for step in range(rows.shape[1]):
            live = np.flatnonzero((length > step) & (hi > lo))
            if not len(live):
                break
            c = rows[live, length[live] - 1 - step].astype(np.int64)
            ok = c > 0
            base = self.start[np.where(ok, c, 0)]
            lo[live] = np.where(ok, base + self.wave.rank(c, lo[live]), 0)
            hi[live] = np.where(ok, base + self.wave.rank(c, hi[live]), 0)
        return lo, hi

    def locate(self, slot: np.ndarray) -> np.ndarray:
        """Sequence positions of suffix slots: step back until a sampled slot."""
        out = np.zeros(len(slot), dtype=np.int64)
        todo, cur, back = np.arange(len(slot)), slot.astype(np.int64), 0
        while len(todo):
            hit = self.kept[cur]
            out[todo[hit]] = self.kept_pos[self.kept_rank[cur[hit]]] + back
            todo, cur = todo[~hit], cur[~hit]
            if len(cur):
                c = self.wave.access(cur)
                cur = self.start[c] + self.wave.rank(c, cur)
                back += 1
        return out


def find_in_shard(words: Words, ph: Phrases, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in a shard: (phrase, first word, word count), words numbered over the shard."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(words.hash) or not len(ph.rows):
        return none
    at = np.searchsorted(ph.vocab, words.hash)
    at[at == len(ph.vocab)] = 0
    known = ph.vocab[at] == words.hash
    row = np.repeat(np.arange(len(words.count)), words.count)
    pos = np.flatnonzero(known)
    gap = np.ones(len(pos), dtype=bool)                               # a separator stands before this word
    gap[1:] = (pos[1:] != pos[:-1] + 1) | (row[pos[1:]] != row[pos[:-1]])
    run = np.cumsum(gap) - 1
    long_enough = (np.bincount(run) >= ph.length.min())[run] if len(pos) else gap
    pos, gap = pos[long_enough], gap[long_enough]                     # a shorter run holds no phrase
    if not len(pos):
        return none
    to = np.arange(len(pos)) + np.cumsum(gap)                         # place in the sequence
    seq = np.zeros(int(to[-1]) + 2, dtype=np.int64)
    seq[to] = at[pos] + 1
    src = np.zeros(len(seq), dtype=np.int64)
    src[to] = pos
    fm = FMIndex(seq, len(ph.vocab), sample)
    lo, hi = fm.search(ph.rows + 1, ph.length)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    word = src[fm.locate(repeat_ranges(lo, n))]
    return which, word, ph.length[which]


# ------------------------------------------------------------------- Spark
_SPAN = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
_TYPES = [pa.int64(), _SPAN, _SPAN, pa.list_(pa.int64())]


def _spans(lo: np.ndarray, hi: np.ndarray) -> list[dict]:
    lo, hi = merge_spans(lo, hi)
    return [{"lo": int(x), "hi": int(y)} for x, y in zip(lo, hi)]


def _search_shard(part: pa.RecordBatch, ph: Phrases, sample: int) -> list[tuple]:
    """Per document of the shard: n_words, word spans, byte spans, item ids."""
    buf, off = column_bytes(part.column(1))
    w = Words(buf, off)
    which, word, length = find_in_shard(w, ph, sample)
    row = np.searchsorted(w.first, word, side="right") - 1
    order = np.argsort(row, kind="stable")
    which, word, length, row = which[order], word[order], length[order], row[order]
    at = np.searchsorted(row, np.arange(part.num_rows + 1))
    out = []
    for i in range(part.num_rows):
        a, b = at[i], at[i + 1]
        if a == b:
            out.append((int(w.count[i]), [], [], []))
            continue
        lo, hi = word[a:b], word[a:b] + length[a:b]
        hit = np.unique(which[a:b])
        own = ph.item_of[repeat_ranges(ph.item_at[hit], ph.item_at[hit + 1] - ph.item_at[hit])]
        items = {ph.item_ids[j] for j in np.unique(own)}
        out.append((int(w.count[i]), _spans(lo - w.first[i], hi - w.first[i]),
                    _spans(w.start[lo] - off[i], w.end[hi - 1] - off[i]), sorted(items - {None})))
    return out


def _union(a: list[dict], b: list[dict]) -> list[dict]:
    both = a + b
    return _spans(np.array([s["lo"] for s in both], np.int64), np.array([s["hi"] for s in both], np.int64))


def _search(rows: DataFrame, ph: Phrases, sample: int, cut: bool = False) -> DataFrame:
    """One pass: build each shard's index, search one block of phrases, and add
    the result to what earlier blocks found. ``cut``: take the spans out of the
    texts in the same pass, so that a task needs one Python worker."""
    shipped = rows.sparkSession.sparkContext.broadcast(ph)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                old = zip(*(part.column(i).to_pylist() for i in (3, 4, 5)))
                found = [(n, _union(a, s), _union(b, t), sorted({*c, *u})) if a else (n, s, t, u)
                         for (n, s, t, u), (a, b, c) in zip(_search_shard(part, shipped.value, sample), old)]
                cols = [pa.array(list(c), type=t) for c, t in zip(zip(*found), _TYPES)]
                text = part.column(1)
                if cut and any(x[2] for x in found):
                    text = pa.array([cut_spans(t, x[2]) if x[2] else t for t, x in zip(text.to_pylist(), found)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), text, *cols, part.column(6)], names=part.schema.names)

    return rows.mapInArrow(tidy(run), rows.schema)


def contamination_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, sample: int = SAMPLE,
                        block_bytes: int = PHRASE_BLOCK_BYTES, carry: list[str] | None = None, cut: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text, n_words``, merged hit ``spans`` (words),
    ``byte_spans`` (of the UTF-8 text), ``items`` with an occurring window, and
    ``row``, a struct of the columns named in ``carry``. With ``cut``, ``text`` comes
    without the spans.

    The benchmark streams through the driver one block at a time. A benchmark
    of several blocks takes one pass each, written to the shared folder between.
    """
    small_batches(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    no_span = F.expr("cast(array() as array<struct<lo:int,hi:int>>)")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"),
                      no_span.alias("spans"), no_span.alias("byte_spans"),
                      F.expr("cast(array() as array<bigint>)").alias("items"), row.alias("row"))
    last = None
    for ph in phrase_blocks(benchmark, window, block_bytes):
        if last is not None:
            out = materialize(_search(out, last, sample), "fm_block")
        last = ph
    return _search(out, last or Phrases([], [], window), sample, cut)


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    s = contamination_spans(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["hi"] - x["lo"])
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return s.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(listed.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def cut_spans(text: str, spans: list[dict]) -> str:
    """``text`` without the given byte spans of its UTF-8 form."""
    raw, kept, at = text.encode(), [], 0
    for s in spans:
        kept.append(raw[at:s["lo"]])
        at = s["hi"]
    return b"".join([*kept, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every hit span cut out of ``text``; same columns, same rows.

    A span reaches from its first word's first byte to its last word's last;
    text without hits is unchanged (null stays null).
    """
    found = contamination_spans(docs, benchmark, window, carry=[c for c in docs.columns if c != "text"] or ["text"], cut=True)
    return found.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
