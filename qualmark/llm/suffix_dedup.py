"""Exact substring deduplication by sorting suffixes.

A byte goes when a string of ``LENGTH`` bytes covers it that also starts
earlier in the corpus (a smaller document, or the same one further left).

Suffixes. Sorting a suffix for every byte would move a hundred times the text.
Of every window of ``LENGTH`` bytes it is enough to sort one suffix, if equal
windows choose it at the same place: the one whose first ``LEAD`` bytes hash
least, leftmost in ties (1 byte in about 32 is chosen). Each chosen suffix
stands for the run of windows that chose it.

1. Every batch of documents asks whether the leading bytes of its suffixes occur
   elsewhere; only repeated suffixes go on.
2. Splitters are sampled from the suffixes' leading bytes, more for more ranges.
   Each batch cuts its repeated suffixes into ranges; equal suffixes of a batch
   travel once.
3. A range sorts its suffixes by multikey quicksort, eight bytes a step. In the
   sorted order, common prefixes of neighbours give the classes of equal
   windows; all but the earliest are repeats. Splitters compare the ``LEAD``
   bytes that all equal windows share, so no class of equal windows lies on
   both sides of a boundary. Ranges of many batches are first combined in groups
   of batches, so equal suffixes found in a third of all documents never meet
   in one task.
4. Leading bytes with more different contexts than a range holds (near either end
   of a passage found in very many documents, every document has another context)
   cannot be cut by splitters and do not shrink. Their windows are dealt to
   tasks by a 128-bit hash of their bytes instead, once a piece of a batch, with the
   earliest place there; the answer tells the batch which of them come later.
5. The repeated windows return to their batch, which merges and cuts them.

Cases: null text is empty; documents shorter than ``LENGTH`` bytes keep all;
matches never cross documents; documents are ordered by ``doc_id`` (null
first), then text hash, and rows equal in both are one document, each row
getting its result; a text of one repeated byte chooses every suffix and is
handled in bounded pieces; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .packing import BATCH_BYTES, batch_text, expand, expand_bytes, pack_documents, rows_of, squeeze, squeeze_bytes
from .textops import U64, few_rows, merge_spans, mix, powers

LENGTH = 100
LEAD = 37                        # bytes hashed to choose a suffix, and compared by splitters
SPAN = LENGTH - LEAD + 1         # suffixes a window chooses from (a power of two)
LEFT = SPAN - 1                  # bytes before the suffix that its windows can reach
CONTEXT = LEFT + LENGTH
PAD = 0xFF                       # no UTF-8 text holds this byte
PIECE = 1 << 18                  # windows examined at once
ROWS = 1 << 14                   # contexts built or compared at once
RANGE_SUFFIXES = 60_000          # suffixes per range, about; leading bytes with more contexts are dealt
SAMPLE_BATCHES, SAMPLE_SUFFIXES = 32, 256
RANGE_SAMPLE = 16                # sampled suffixes per range, at least
FAN_IN = 4096                    # batches whose suffixes meet in one task
ANCHOR_RANGE = 500_000           # leading-byte hashes counted per task, about
DEALT_WINDOWS = 500_000          # dealt windows compared per task, about
_BYTE_KEYS = mix(np.arange(256, dtype=np.uint64), 11)    # byte values of the second window hash


# ------------------------------------------------------------ choose suffixes
def rolling_hash(buf: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``buf[i : i + width]`` for every i, by doubling."""
    p = powers(width + 1)
    part, size = buf.astype(np.uint64) + U64(1), 1
    out, done, rest = None, 0, width
    while rest:
        if rest & 1:
            out = part if out is None else out[:len(part) - done] + p[done] * part[done:done + len(out)] \
                if len(part) > done else out[:0]
            done += size
        rest >>= 1
        if rest:
            part = part[:-size] + p[size] * part[size:] if len(part) > size else part[:0]
            size *= 2
    n = max(0, len(buf) - width + 1)
    return mix(out[:n])


def choose_suffixes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Chosen suffixes of a batch: position, least and greatest window start that
    chose it, document number, and hash of the leading bytes."""
    found = []
    end = off[1:]
    for a in range(0, max(len(buf) - LENGTH + 1, 0), PIECE):
        piece = buf[a:a + PIECE + LENGTH - 1]
        h = rolling_hash(piece, LEAD)
        n = len(piece) - LENGTH + 1
        low = (h & ~U64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step < SPAN:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        at = (low[:n] & U64((1 << 24) - 1)).astype(np.int64)
        start = np.arange(n)
        doc = np.searchsorted(end, start + a, side="right")
        ok = start + a + LENGTH <= end[np.minimum(doc, len(end) - 1)]
        start, at, doc = start[ok], at[ok], doc[ok]
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        found.append((at[first] + a, start[first] + a, start[last] + a, doc[first], h[at[first]]))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def contexts(buf: np.ndarray, off: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The bytes that a suffix's windows can reach; beyond the document: PAD."""
    idx = at[:, None] + np.arange(-LEFT, LENGTH)
    ok = (idx >= off[doc][:, None]) & (idx < off[doc + 1][:, None])
    return np.where(ok, buf[np.clip(idx, 0, len(buf) - 1)], np.uint8(PAD))


# ------------------------------------------------------------- sort, compare
def sort_words(ctx: np.ndarray) -> np.ndarray:
    """Sort keys of contexts as rows of big-endian 8-byte characters: the suffix,
    then what stands before it, read backwards."""
    n = len(ctx)
    text = np.concatenate([ctx[:, LEFT:], ctx[:, LEFT - 1::-1] if LEFT else ctx[:, :0]], axis=1)
    wide = -(-text.shape[1] // 8) * 8
    pad = np.zeros((n, wide), np.uint8)
    pad[:, :text.shape[1]] = text
    return pad.view(">u8").astype(np.uint64)


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and whether each sorted row differs from the one before.

    Multikey quicksort over 8-byte characters: rows are parted by one character,
    and only parts of equal rows go on to the next.
    """
    n = len(words)
    order = np.arange(n)
    new = np.zeros(n, bool)
    new[:1] = True
    for c in range(words.shape[1]):
        tied = ~new | np.append(~new[1:], False)
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        part = np.cumsum(new)[slots]
        rows = order[slots]
        by = np.lexsort((words[rows, c], part))
        rows = rows[by]
        order[slots] = rows
        w = words[rows, c]
        # slots of one part are adjacent, so a change of character starts a new part
        new[slots[1:]] |= (part[1:] == part[:-1]) & (w[1:] != w[:-1])
    return order, new


def earliest(doc: np.ndarray, th: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Rank of each (document, text hash, position); equal places share a rank."""
    by = np.lexsort((pos, th, doc))
    d, t, p = doc[by], th[by], pos[by]
    new = np.ones(len(by), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1])
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(new)
    return rank


class Suffixes:
    """Suffixes with their contexts, places and the batches they came from."""

    COLS = ("doc", "th", "idx", "pos", "lo", "hi", "src")   # idx: row in the batch; lo, hi: window offsets before pos

    def __init__(self, ctx: np.ndarray, names: list[str], **cols: np.ndarray):
        self.ctx, self.names = ctx, names
        for c in self.COLS:
            setattr(self, c, cols[c])

    def take(self, at: np.ndarray) -> "Suffixes":
        return Suffixes(self.ctx[at], self.names, **{c: getattr(self, c)[at] for c in self.COLS})

    @staticmethod
    def join(parts: list["Suffixes"]) -> "Suffixes":
        names: list[str] = []
        src = []
        for p in parts:
            src.append(p.src + len(names))
            names += p.names
        cols = {c: np.concatenate([getattr(p, c) for p in parts]) for c in Suffixes.COLS if c != "src"}
        return Suffixes(np.concatenate([p.ctx for p in parts]), names, src=np.concatenate(src), **cols)

    def encode(self) -> tuple:
        return (self.names, squeeze_bytes(self.ctx), *(squeeze(getattr(self, c)) for c in self.COLS))

    @staticmethod
    def decode(row: tuple) -> "Suffixes":
        cols = {c: expand(b, np.int64) for c, b in zip(Suffixes.COLS, row[2:])}
        return Suffixes(expand_bytes(row[1]).reshape(-1, CONTEXT), list(row[0]), **cols)

    def windows(self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """Batch, row, and least and greatest start of windows at offsets lo..hi."""
        return self.src[at], self.idx[at], self.pos[at] - hi, self.pos[at] - lo


def combine(s: Suffixes) -> tuple[Suffixes, tuple[np.ndarray, ...]]:
    """Keep the earliest of equal suffixes (equal context and windows); the
    windows of the others are repeats."""
    order, new = multikey_sort(np.concatenate(
        [sort_words(s.ctx), ((s.lo << 8) | s.hi).astype(np.uint64)[:, None]], axis=1))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    rank = earliest(s.doc, s.th, s.pos)
    least = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, rank)
    later = np.flatnonzero(rank > least[group])
    keep = np.flatnonzero(rank == least[group])       # more than one only for rows equal in id and text
    return s.take(keep), s.windows(later, s.lo[later], s.hi[later])


def compare(s: Suffixes) -> tuple[np.ndarray, ...]:
    """Windows of combined suffixes that start earlier in another one.

    In suffix order, windows at offset o are equal where neighbours share at
    least LENGTH - o bytes and the o bytes before the suffix agree.
    """
    out = []
    order, _ = multikey_sort(sort_words(s.ctx))
    s = s.take(order)
    n = len(order)
    common = np.zeros(n, np.int64)                    # shared suffix bytes with the row before
    for a in range(1, n, ROWS):
        b = min(n, a + ROWS)
        differ = s.ctx[a:b, LEFT:] != s.ctx[a - 1:b - 1, LEFT:]
        common[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    rank = earliest(s.doc, s.th, s.pos)
    group = np.cumsum(common < LEAD)
    size = np.bincount(group)
    live = np.flatnonzero(size[group] > 1)
    at = 0
    while at < len(live):                             # whole groups, about ROWS rows at a time
        stop = min(len(live), at + ROWS)
        while stop < len(live) and group[live[stop]] == group[live[stop - 1]]:
            stop += 1
        out.append(_compare_rows(s, live[at:stop], common, rank))
        at = stop
    empty = (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out)) if out else empty


def _compare_rows(s: Suffixes, rows: np.ndarray, common: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    repeat = np.zeros((len(rows), LEFT + 1), bool)
    share, rk = common[rows], rank[rows]
    before = np.zeros(len(rows), np.uint64)           # hash of the bytes before the suffix, one more per offset
    p = powers(LEFT + 1)
    for o in range(LEFT + 1):
        if o:
            before = before + (s.ctx[rows, LEFT - o].astype(np.uint64) + U64(1)) * p[o]
        has = np.flatnonzero((s.lo[rows] <= o) & (o <= s.hi[rows]))
        if not len(has):
            continue
        run = np.cumsum(share < LENGTH - o).astype(np.uint64)
        key = mix(before + mix(run, 5))[has]
        by = np.lexsort((rk[has], key))
        k = key[by]
        first = np.ones(len(by), bool)
        first[1:] = k[1:] != k[:-1]
        least = rk[has][by][np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))]
        repeat[has[by], o] = rk[has][by] > least
    edge = np.diff(np.pad(repeat, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    r, lo = np.nonzero(edge == 1)
    _, hi = np.nonzero(edge == -1)
    return s.windows(rows[r], lo, hi - 1)


# ------------------------------------------------------------------- Spark
SUFFIX_ROW = "range int, names array<string>, ctx binary, " + ", ".join(f"{c} binary" for c in Suffixes.COLS)
_SUFFIX_TYPES = [pa.int32(), pa.list_(pa.string()), pa.binary()] + [pa.binary()] * len(Suffixes.COLS)
WINDOW_ROW = "batch string, n int, idx binary, lo binary, hi binary"
_WINDOW_TYPES = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
BOTH = SUFFIX_ROW + ", " + WINDOW_ROW.replace("idx", "w_idx").replace("lo ", "w_lo ").replace("hi ", "w_hi ")
_BOTH_NAMES = [x.split()[0] for x in BOTH.split(", ")]


def _suffix_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        cols = [pa.array([v], t) for v, t in zip(row, _SUFFIX_TYPES)]
        yield pa.RecordBatch.from_arrays([*cols, *(pa.nulls(1, t) for t in _WINDOW_TYPES)], names=_BOTH_NAMES)


def _window_rows(names: list[str], found: tuple[np.ndarray, ...], r: int = 0) -> Iterator[pa.RecordBatch]:
    """Found windows by batch; they take the way of range ``r`` and pass it untouched."""
    src, idx, lo, hi = found
    by = np.argsort(src, kind="stable")
    src, idx, lo, hi = src[by], idx[by], lo[by], hi[by]
    edge = np.flatnonzero(np.diff(src, prepend=-1))
    for a, b in zip(edge, np.append(edge[1:], len(src))):
        row = (names[src[a]], int(b - a), squeeze(idx[a:b]), squeeze(lo[a:b]), squeeze(hi[a:b]))
        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *(pa.nulls(1, t) for t in _SUFFIX_TYPES[1:]),
                                          *(pa.array([v], t) for v, t in zip(row, _WINDOW_TYPES))], names=_BOTH_NAMES)


def _lead_counts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The batch's leading-byte hashes in order, with the number of different
    suffixes (context and windows) of each, and whether it has more than one suffix."""
    at, first, last, doc, key = choose_suffixes(buf, off)
    keys, group, count = np.unique(key, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(count[group] > 1)
    h = np.zeros(len(rows), np.uint64)
    for a in range(0, len(rows), ROWS):
        r = rows[a:a + ROWS]
        words = sort_words(contexts(buf, off, at[r], doc[r]))
        reach = ((at[r] - last[r]) << 8 | (at[r] - first[r])).astype(np.uint64)
        h[a:a + ROWS] = mix((words * powers(words.shape[1] + 1)[1:]).sum(axis=1, dtype=np.uint64) + mix(reach, 3))
    by = np.lexsort((h, group[rows]))
    g, h = group[rows][by], h[by]
    again = np.bincount(g[1:][(g[1:] == g[:-1]) & (h[1:] != h[:-1])], minlength=len(keys))
    return keys, 1 + again, count > 1


def _repeated_leads(packed: DataFrame, ranges: int, most: int) -> DataFrame:
    """``batch, got, hits, dealt``: per hash range, a bit for each distinct leading-byte
    hash of the batch (in hash order) that occurs more than once in the corpus, and
    one if batches send more than ``most`` suffixes with it; numbers of suffixes
    with only the first bit, and with both."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lens, text, name in rows_of(batch):
                keys, count, many = _lead_counts(*batch_text(lens, text))
                edge = np.searchsorted(keys, np.array([(i << 64) // ranges for i in range(ranges)], np.uint64))
                for r, (a, b) in enumerate(zip(edge, np.append(edge[1:], len(keys)))):
                    if b > a:
                        row = (r, name, int(b - a), squeeze(np.diff(keys[a:b], prepend=U64(0))),
                               squeeze(count[a:b] << 1 | many[a:b]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()))],
                            names=["range", "batch", "n", "steps", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush():
            keys = np.concatenate([np.cumsum(expand(r[3], np.uint64), dtype=np.uint64) for r in held])
            count = np.concatenate([expand(r[4], np.int64) for r in held])
            own, at = np.unique(keys, return_inverse=True)
            hit = (np.bincount(at, weights=1 + (count & 1), minlength=len(own)) > 1)[at]
            count >>= 1
            over = (np.bincount(at, weights=count, minlength=len(own)) > most)[at] & hit
            start = 0
            for r in held:
                mine = slice(start, start + r[2])
                start += r[2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0]], pa.int32()), pa.array([r[1]]), pa.array([r[2]], pa.int32()),
                     pa.array([np.packbits(hit[mine]).tobytes()], pa.binary()), pa.array([np.packbits(over[mine]).tobytes()], pa.binary()),
                     pa.array([int(count[mine][hit[mine] & ~over[mine]].sum())]), pa.array([int(count[mine][over[mine]].sum())])],
                    names=["range", "batch", "n", "bits", "over", "hits", "dealt"])

        for batch in batches:
            for row in rows_of(batch):
                if held and held[0][0] != row[0]:
                    yield from flush()
                    held = []
                held.append(row)
        if held:
            yield from flush()

    asked = packed.select("lens", "text", "batch").mapInArrow(ask, "range int, batch string, n int, steps binary, counts binary")
    return asked.repartition(ranges, "range").sortWithinPartitions("range") \
        .mapInArrow(answer, "range int, batch string, n int, bits binary, over binary, hits long, dealt long") \
        .groupBy("batch").agg(F.collect_list(F.struct("range", "n", "bits", "over")).alias("got"),
                              F.sum("hits").alias("hits"), F.sum("dealt").alias("dealt"))


def _answered(got: list, bits: str) -> np.ndarray:
    """The bits of all ranges' answers to one question, in the order they were asked."""
    parts = [np.unpackbits(np.frombuffer(g[bits], np.uint8), count=g["n"]) for g in sorted(got, key=lambda g: g["range"])]
    return np.concatenate(parts).astype(bool)


# ----------------------------------------------------------- dealt windows
def _dealt_pieces(lens: bytes, text: bytes, got: list, ids: list, hashes: list) -> Iterator[tuple]:
    """Windows of a batch's suffixes whose leading bytes are dealt, ``PIECE`` starts at
    a time: piece, batch row, start in the row, class in the piece, whether it starts
    later than the earliest of its class, and of each class (in hash order) both
    hashes and the earliest place."""
    buf, off = batch_text(lens, text)
    _, first, last, doc, key = choose_suffixes(buf, off)
    over = np.flatnonzero(_answered(got, "over")[np.searchsorted(np.unique(key), key)])
    first, last, doc = first[over], last[over], doc[over]
    none = np.iinfo(np.int64).min
    ids = np.array([none if i is None else i for i in ids], np.int64)
    hashes = np.array(hashes, np.int64)
    for piece, a in enumerate(range(0, max(len(buf) - LENGTH + 1, 0), PIECE)):
        here = slice(*np.searchsorted(first // PIECE, [piece, piece + 1]))      # a run of windows lies in one piece
        if here.start == here.stop:
            continue
        size = last[here] - first[here] + 1
        at = np.repeat(first[here] - np.cumsum(size) + size, size) + np.arange(size.sum())
        d = np.repeat(doc[here], size)
        part = buf[a:a + PIECE + LENGTH - 1]
        one, two = rolling_hash(part, LENGTH)[at - a], rolling_hash(_BYTE_KEYS[part], LENGTH)[at - a]
        pos = at - off[d]
        rank = earliest(ids[d], hashes[d], pos)
        by = np.lexsort((rank, two, one))
        new = np.ones(len(by), bool)
        new[1:] = (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])
        group = np.empty(len(by), np.int64)
        group[by] = np.cumsum(new) - 1
        e = by[new]
        yield piece, d, pos, group, rank > rank[e][group], one[e], two[e], ids[d[e]], hashes[d[e]], pos[e]


def _dealt_windows(src: DataFrame, ranges: int) -> DataFrame:
    """Repeated windows (``WINDOW_ROW``) among those whose leading bytes are dealt."""
    question = "range int, batch string, piece int, n int, " + ", ".join(f"{c} binary" for c in ("one", "two", "doc", "th", "pos"))
    asks = [pa.int32(), pa.string(), pa.int32(), pa.int32()] + [pa.binary()] * 5

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lens, text, got, name, ids, hashes in rows_of(b):
                for piece, *_, one, two, doc, th, pos in _dealt_pieces(lens, text, got, ids, hashes):
                    edge = np.searchsorted(one, np.array([(i << 64) // ranges for i in range(ranges)], np.uint64))
                    for r, (x, y) in enumerate(zip(edge, np.append(edge[1:], len(one)))):
                        if y > x:
                            row = (r, name, piece, int(y - x), squeeze(np.diff(one[x:y], prepend=U64(0))),
                                   *(squeeze(c[x:y]) for c in (two, doc, th, pos)))
                            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, asks)],
                                                             names=[c.split()[0] for c in question.split(", ")])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush():
            one = np.concatenate([np.cumsum(expand(r[4], np.uint64), dtype=np.uint64) for r in held])
            two = np.concatenate([expand(r[5], np.uint64) for r in held])
            rank = earliest(*(np.concatenate([expand(r[c], np.int64) for r in held]) for c in (6, 7, 8)))
            by = np.lexsort((rank, two, one))
            new = np.ones(len(by), bool)
            new[1:] = (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])
            later = np.empty(len(by), bool)
            later[by] = rank[by] > rank[by][new][np.cumsum(new) - 1]
            start = 0
            for r in held:
                mine, start = later[start:start + r[3]], start + r[3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0]], pa.int32()), pa.array([r[1]]), pa.array([r[2]], pa.int32()), pa.array([r[3]], pa.int32()),
                     pa.array([np.packbits(mine).tobytes()], pa.binary())], names=["range", "batch", "piece", "n", "later"])

        for b in batches:
            for row in rows_of(b):
                if held and held[0][0] != row[0]:
                    yield from flush()
                    held = []
                held.append(row)
        if held:
            yield from flush()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lens, text, got, name, ids, hashes, answers in rows_of(b):
                by_piece: dict[int, list] = {}
                for g in answers:
                    by_piece.setdefault(g["piece"], []).append(g)
                for piece, row, start, group, later, *_ in _dealt_pieces(lens, text, got, ids, hashes):
                    at = np.flatnonzero(later | _answered(by_piece[piece], "later")[group])
                    row, start = row[at], start[at]
                    new = np.ones(len(at), bool)
                    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
                    lo = np.flatnonzero(new)
                    hi = np.append(lo[1:], len(at))[:len(lo)] - 1
                    out = (name, len(lo), squeeze(row[lo]), squeeze(start[lo]), squeeze(start[hi]))
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, _WINDOW_TYPES)],
                                                     names=[c.split()[0] for c in WINDOW_ROW.split(", ")])

    answers = src.mapInArrow(ask, question).repartition(ranges, "range").sortWithinPartitions("range") \
        .mapInArrow(answer, "range int, batch string, piece int, n int, later binary") \
        .groupBy("batch").agg(F.collect_list(F.struct("range", "piece", "n", "later")).alias("answers"))
    return src.join(answers, "batch").select("lens", "text", "got", "batch", "doc_ids", "hashes", "answers").mapInArrow(apply, WINDOW_ROW)


def _repeated_suffixes(lens: bytes, text: bytes, got: list, name: str, ids: list, hashes: list) -> Iterator[Suffixes]:
    """A batch's suffixes whose leading bytes are repeated and not dealt, ROWS at a time."""
    buf, off = batch_text(lens, text)
    at, first, last, doc, key = choose_suffixes(buf, off)
    hit = _answered(got, "bits") & ~_answered(got, "over")
    rows = np.flatnonzero(hit[np.searchsorted(np.unique(key), key)])
    none = np.iinfo(np.int64).min
    ids = np.array([none if i is None else i for i in ids], np.int64)
    hashes = np.array(hashes, np.int64)
    for a in range(0, len(rows), ROWS):
        r = rows[a:a + ROWS]
        d = doc[r]
        yield Suffixes(contexts(buf, off, at[r], d), [name], doc=ids[d], th=hashes[d], idx=d, pos=at[r] - off[d],
                       lo=at[r] - last[r], hi=at[r] - first[r], src=np.zeros(len(r), np.int64))


def _lead(ctx: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(ctx[:, LEFT:LEFT + LEAD]).view(f"S{LEAD}").reshape(-1)


def _combine_all(parts: Iterator[Suffixes], most: int = 4 * ROWS) -> Iterator[tuple[Suffixes | None, list[str], tuple]]:
    """Combine a stream of suffixes in bounded memory: yields the repeats found on
    the way, and the suffixes that are left (at the end, or whenever ``most`` are)."""
    held: Suffixes | None = None
    for p in parts:
        held = p if held is None else Suffixes.join([held, p])
        held, found = combine(held)
        yield None, held.names, found
        if len(held.pos) > most:
            yield held, held.names, None
            held = None
    if held is not None:
        yield held, held.names, None


def cut_suffixes(src: DataFrame, hits: int, batches: int, range_suffixes: int) -> tuple[DataFrame, int]:
    """``BOTH`` rows of the batches' repeated suffixes, cut into ranges, and the number of ranges.
    ``hits``: suffixes in all ``batches`` of ``src``."""
    # splitters: quantiles of the leading bytes of some batches' suffixes
    ranges = max(1, -(-hits // range_suffixes))

    def sample(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_:
            for row in rows_of(b):
                # a batch's equal suffixes travel once, so they count once
                lead = np.sort(np.concatenate([_lead(left.ctx) for left, _, found in _combine_all(_repeated_suffixes(*row))
                                               if found is None]))
                pick = np.unique(np.linspace(0, len(lead) - 1, min(len(lead), SAMPLE_SUFFIXES)).astype(int))
                yield pa.RecordBatch.from_arrays([pa.array([x.ljust(LEAD, b"\0") for x in lead[pick].tolist()], pa.binary())],
                                                 names=["lead"])

    splitters = np.zeros(0, f"S{LEAD}")
    if ranges > 1:
        some = max(SAMPLE_BATCHES, -(-ranges * RANGE_SAMPLE // SAMPLE_SUFFIXES))
        names = [r.batch for r in few_rows(src.select("batch"), "batch", some, batches).collect()]
        got = sorted(bytes(r.lead) for r in src.where(F.col("batch").isin(names)).mapInArrow(sample, "lead binary").collect())
        pick = np.linspace(0, len(got), ranges, endpoint=False).astype(int)[1:] if got else []
        splitters = np.unique(np.array([got[i] for i in pick], f"S{LEAD}"))
    shipped = src.sparkSession.sparkContext.broadcast(splitters)

    def cut(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_:
            for row in rows_of(b):
                for left, names_, found in _combine_all(_repeated_suffixes(*row)):
                    if left is None:
                        yield from _window_rows(names_, found, int(names_[0][:8], 16) % (len(shipped.value) + 1))
                        continue
                    to = np.searchsorted(shipped.value, _lead(left.ctx), side="right")
                    for r in np.unique(to):
                        yield from _suffix_rows([(int(r), *left.take(np.flatnonzero(to == r)).encode())])

    return src.mapInArrow(cut, BOTH), len(splitters) + 1


def repeated_suffixes(packed: DataFrame, range_suffixes: int = RANGE_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """Batches with repeated suffixes (and the answers to their questions), and per batch its numbers of them."""
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    leads = materialize(_repeated_leads(packed, max(1, -(-total // (32 * ANCHOR_RANGE))), range_suffixes), "sd_leads")
    src = packed.join(leads, "batch").select("lens", "text", "got", "batch", "doc_ids", "hashes", "hits", "dealt")
    return src, leads


def repeated_windows(packed: DataFrame, fan_in: int = FAN_IN, range_suffixes: int = RANGE_SUFFIXES) -> DataFrame:
    """``batch, n, idx, lo, hi``: starts lo..hi of repeated windows of a batch's rows."""
    batches = packed.count()
    src, leads = repeated_suffixes(packed, range_suffixes)
    hits, dealt, asking = leads.agg(F.sum("hits"), F.sum("dealt"), F.count_if(F.col("hits") > 0)).first()
    rows, n_ranges = cut_suffixes(src.where("hits > 0").drop("hits", "dealt"), hits or 0, asking, range_suffixes)

    def meet(batches_: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        """Combine (and at last compare) the suffixes of one (range, salt) after the other."""
        held: list[Suffixes] = []
        where = None

        def done() -> Iterator[pa.RecordBatch]:
            left, found = combine(Suffixes.join(held))
            yield from _window_rows(left.names, found, where[0])
            if last:
                yield from _window_rows(left.names, compare(left), where[0])
            else:
                yield from _suffix_rows([(where[0], *left.encode())])

        for b in batches_:
            for row in rows_of(b):
                if row[1] is None:                     # windows found earlier
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _SUFFIX_TYPES + _WINDOW_TYPES)],
                                                     names=_BOTH_NAMES)
                    continue
                if held and (row[0], row[-1]) != where:
                    yield from done()
                    held.clear()
                where = row[0], row[-1]
                held.append(Suffixes.decode(row[1:len(_SUFFIX_TYPES)]))
        if held:
            yield from done()

    groups = max(1, -(-batches // fan_in))
    while True:                                        # groups of batches first, then groups of groups
        salt = F.pmod(F.xxhash64(F.coalesce(F.col("names")[0], "batch")), F.lit(groups)).cast("int")
        rows = rows.withColumn("salt", salt).repartition(n_ranges * groups, "range", "salt") \
            .sortWithinPartitions("range", "salt").mapInArrow(lambda b, last=groups == 1: meet(b, last), BOTH)
        if groups == 1:
            break
        groups = -(-groups // fan_in) if groups > fan_in else 1
    rows = rows.select("batch", "n", F.col("w_idx").alias("idx"), F.col("w_lo").alias("lo"), F.col("w_hi").alias("hi"))
    if dealt:
        rows = rows.unionByName(_dealt_windows(src.where("dealt > 0").drop("hits", "dealt"), -(-dealt * SPAN // DEALT_WINDOWS)))
    return rows


def removed_spans(idx: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merged removed spans (row, from, to) of a batch's repeated windows."""
    by = np.lexsort((lo, idx))
    idx, lo, hi = idx[by], lo[by], hi[by] + LENGTH
    base = idx * (int(hi.max(initial=0)) + 1)          # rows apart, so spans of two rows never touch
    a, b = merge_spans(lo + base, hi + base)
    row = idx[np.searchsorted(lo + base, a)]
    shift = row * (int(hi.max(initial=0)) + 1)
    return row, a - shift, b - shift


def suffix_dedup(docs: DataFrame, fan_in: int = FAN_IN, range_suffixes: int = RANGE_SUFFIXES,
                 batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` (the remaining bytes) per row of ``docs``."""
    packed = pack_documents(docs, "sd_docs", batch_bytes)
    w = repeated_windows(packed, fan_in, range_suffixes).groupBy("batch") \
        .agg(F.collect_list(F.struct("idx", "lo", "hi")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lens, text, ids, found in rows_of(b):
                buf, off = batch_text(lens, text)
                idx, lo, hi = (np.concatenate([expand(f[c], np.int64) for f in found or []] + [np.zeros(0, np.int64)])
                               for c in ("idx", "lo", "hi"))
                row, a, e = removed_spans(idx, lo, hi)
                edge = np.searchsorted(row, np.arange(len(ids) + 1))
                raw, out, size = buf.tobytes(), [], 0
                for i, doc_id in enumerate(ids):
                    s, x, y = int(off[i]), a[edge[i]:edge[i + 1]], e[edge[i]:edge[i + 1]]
                    keep, at = [], 0
                    for f, t in zip(x.tolist(), y.tolist()):
                        keep.append(raw[s + at:s + f])
                        at = t
                    keep.append(raw[s + at:int(off[i + 1])])
                    spans = [{"lo": f, "hi": t} for f, t in zip(x.tolist(), y.tolist())]
                    out.append((doc_id, int(off[i + 1]) - s, int((y - x).sum()), len(x), spans, b"".join(keep)))
                    size += len(out[-1][-1])
                    if size > 4 << 20:
                        yield _result(out)
                        out, size = [], 0
                if out:
                    yield _result(out)

    return packed.select("lens", "text", "doc_ids", "batch").join(w, "batch", "left") \
        .select("lens", "text", "doc_ids", "found").mapInArrow(cut, RESULT)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<lo:long,hi:long>>, kept binary"


def _result(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                      names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])


