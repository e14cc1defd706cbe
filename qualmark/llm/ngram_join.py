"""N-gram Jaccard join by chosen paths.

Documents are sets of word shingles. Equal sets are one class. For a run, a
hash picks the same shared shingle of similar sets; sets fall into buckets by
the chosen shingle, and a bucket that is too large splits again on the next
chosen shingle, unless nearly all of it stays together (then it is dense, and
splitting only loses pairs). Runs are repeated until a pair at the threshold
has met in some bucket with the target recall.

Buckets are brute-forced in two steps, so that a pair that meets in many runs
is not verified, shuffled or counted many times. First, every pair of a bucket
is compared by short signatures, which joins sets into candidate groups. Then
every candidate group is verified
once and exactly, in tiles of blocks of members, with each set written as its
difference from one set of its group.

No pair is emitted: a tile reports each member's number of links and a forest
of its links. Classes are the forest's components. The exact number of links
of a group of different near copies needs their pairs to be compared, spread
over tiles; exact copies count by weight.

Cases: a text of 1 to 4 words is one shingle of all its words; null or
wordless text links to nothing and is its own class; repeated rows are copies;
a null id can be linked but gives a class its name only if all its ids are
null; null texts share a hash, so of null texts under one id one is kept; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .packing import batch_text, expand_bytes, pack_documents, rows_of, squeeze_bytes
from .textops import U64, Words, mix, pack, repeat_ranges, tidy, unpack

WORDS = 5                        # words per shingle
THRESHOLD = Fraction(4, 5)
DEPTH = 2                        # choices along a path
RECALL = 0.9999                  # for a pair at the threshold whose paths split DEPTH times
SIGNATURE = 64                   # chosen shingles of a signature, a byte of each
BUCKET = 1024                    # sets brute-forced together
DENSE = 0.5                      # a bucket with more than this in one part is not split
ALIKE = 0.5                      # signature agreement of candidates: six deviations below what the threshold gives
BLOCK = 512                      # members of a tile's side


def runs_for(recall: float = RECALL, threshold: Fraction = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - float(threshold) ** depth))


# ---------------------------------------------------------------- sets, choices
def shingle_sets(w: Words, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and the rows' bounds."""
    n = np.where(w.count >= width, w.count - width + 1, np.minimum(w.count, 1))
    row = np.repeat(np.arange(len(n)), n)
    at = repeat_ranges(w.first[:-1], n)
    size = np.minimum(w.count, width)[row]
    h = size.astype(np.uint64)
    for j in range(width):
        has = j < size
        h = np.where(has, mix(h * U64(0x9E3779B97F4A7C15) + w.hash[np.minimum(at + j, max(len(w.hash) - 1, 0))], j), h) \
            if len(at) else h
    by = np.lexsort((h, row))
    h, row = h[by], row[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(n) + 1))


def set_keys(h: np.ndarray, edge: np.ndarray) -> list[bytes | None]:
    """128-bit key of each row's set (None: empty)."""
    a = np.concatenate([[U64(0)], np.cumsum(mix(h, 21), dtype=np.uint64)])
    b = np.concatenate([[U64(0)], np.cumsum(mix(h, 22), dtype=np.uint64)])
    size = np.diff(edge)
    both = np.stack([a[edge[1:]] - a[edge[:-1]] + size.astype(np.uint64), b[edge[1:]] - b[edge[:-1]]], axis=1)
    raw = both.astype(">u8").tobytes()
    return [raw[16 * i:16 * i + 16] if s else None for i, s in enumerate(size)]


def chosen(h: np.ndarray, edge: np.ndarray, choices: int) -> np.ndarray:
    """The shingle each of ``choices`` hash functions picks from each row's set (0: empty)."""
    out = np.zeros((len(edge) - 1, choices), np.uint64)
    full = np.flatnonzero(np.diff(edge) > 0)
    if len(full):
        for c in range(choices):
            seed = int(mix(np.array([c], np.uint64), 31)[0])
            v = (h ^ U64(seed)) * U64(0xBF58476D1CE4E5B9 + 2 * c)
            v = (v ^ (v >> U64(29))) * U64(0x94D049BB133111EB)
            out[full, c] = np.minimum.reduceat(v, edge[full])
    return out


def sketches(packed: DataFrame, runs: int) -> DataFrame:
    """Per document: ``doc_id, hash, batch, idx, key, size``, the path choices and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lens, text, name, ids, hashes in rows_of(b):
                h, edge = shingle_sets(Words(*batch_text(lens, text)))
                pick = chosen(h, edge, max(SIGNATURE, runs * DEPTH))
                path = np.ascontiguousarray(pick[:, :runs * DEPTH]).view(np.int64)
                sig = (mix(pick[:, :SIGNATURE], 41) >> U64(56)).astype(np.uint8)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array([name] * n), pa.array(np.arange(n, dtype=np.int32)),
                     pa.array(set_keys(h, edge), pa.binary()), pa.array(np.diff(edge).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * path.shape[1]), pa.array(path.reshape(-1))),
                     pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["doc_id", "hash", "batch", "idx", "key", "size", "path", "sig"])

    return packed.select("lens", "text", "batch", "doc_ids", "hashes").mapInArrow(
        tidy(run), "doc_id long, hash long, batch string, idx int, key binary, size long, path array<long>, sig binary")


# ----------------------------------------------------------------------- paths
def chosen_paths(classes: DataFrame, runs: int, bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """``leaf, n, cid``: the buckets of two or more classes at the paths' ends, ``n`` classes each."""
    nodes = classes.select("cid", F.explode(F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.struct(
        F.xxhash64(r, F.element_at("path", r * depth + 1)).alias("leaf"),
        F.slice("path", r * depth + 2, depth - 1).alias("rest")))).alias("x")).select("cid", "x.leaf", "x.rest")
    done = None
    for level in range(depth):
        size = nodes.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
        if level == depth - 1:
            leaves = nodes.join(size, "leaf").select("leaf", "n", "cid")
            return leaves if done is None else done.unionByName(leaves)
        child = F.xxhash64("leaf", F.element_at("rest", level + 1))
        part = nodes.groupBy("leaf", child.alias("child")).agg(F.count("*").alias("n")) \
            .groupBy("leaf").agg(F.sum("n").alias("n"), F.max("n").alias("most")).where("n > 1") \
            .select("leaf", "n", ((F.col("n") > bucket) & (F.col("most") <= DENSE * F.col("n"))).alias("split"))
        met = materialize(nodes.join(part, "leaf"), "nj_nodes")
        leaves = met.where(~F.col("split")).select("leaf", "n", "cid")
        done = leaves if done is None else done.unionByName(leaves)
        nodes = met.where("split").select("cid", child.alias("leaf"), "rest")
    return done


def _blocked(rows: DataFrame, group: str, size: str, block: int, cols: list[str]) -> DataFrame:
    """Members of large groups dealt to blocks; a row per tile (pair of blocks) of each member."""
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    return rows.withColumn("blocks", n).withColumn("mine", mine) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select(F.xxhash64(F.col(group), F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"),
                (F.col("mine") > F.col("other")).alias("second"), (F.col("mine") == F.col("other")).alias("own"), *cols)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Groups of rows of one tile (rows arrive sorted by it)."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def candidate_groups(sig: np.ndarray) -> np.ndarray:
    """For each set of a bucket the first set of its group: sets whose signatures
    agree in a share of at least ALIKE are in one group, directly or over others."""
    group = np.arange(len(sig))
    for i in range(len(sig)):
        met = np.unique(group[(sig == sig[i]).mean(axis=1) >= ALIKE])
        if len(met) > 1:
            group[np.isin(group, met)] = met[0]
    return group


def candidate_links(leaves: DataFrame, classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    rows = leaves.join(classes.select("cid", "sig"), "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            cid = np.array([r[1] for r in tile], np.int64)
            sig = np.frombuffer(b"".join(r[2] for r in tile), np.uint8).reshape(len(tile), SIGNATURE)
            by = np.argsort(cid, kind="stable")
            cid, group = cid[by], candidate_groups(sig[by])
            yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(cid[group])], names=["a", "b"])

    return _blocked(rows, "leaf", "n", bucket, ["cid", "sig"]).select("tile", "cid", "sig") \
        .repartition("tile").sortWithinPartitions("tile").mapInArrow(tidy(run), "a long, b long") \
        .where(F.col("a") != F.col("b")).distinct()


# ---------------------------------------------------------------- verification
def group_sets(packed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid, set`` (sorted shingles) of ``wanted`` (``cid, batch, idx``)."""
    by_batch = wanted.groupBy("batch").agg(F.collect_list(F.struct("idx", "cid")).alias("want"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lens, text, want in rows_of(b):
                h, edge = shingle_sets(Words(*batch_text(lens, text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["cid"] for x in want], pa.int64()),
                     pa.array([squeeze_bytes(h[edge[x["idx"]]:edge[x["idx"] + 1]], 1) for x in want], pa.binary())],
                    names=["cid", "set"])

    # merge join at any size: the wanted sets grow with the corpus, so they are not to be broadcast
    return packed.select("lens", "text", "batch").join(by_batch.hint("merge"), "batch").select("lens", "text", "want") \
        .mapInArrow(tidy(run), "cid long, set binary")


def _set(b: bytes) -> np.ndarray:
    return expand_bytes(b).view(np.uint64)


def overlap(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of two lists of sets."""
    out = np.zeros((len(a), len(b)), np.float32)
    ra, rb = (np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (a, b))
    va, vb = (np.concatenate([*s, np.zeros(0, np.uint64)]) for s in (a, b))
    shared = np.intersect1d(va, vb)
    ka, kb = np.isin(va, shared), np.isin(vb, shared)
    ca, cb = np.searchsorted(shared, va[ka]), np.searchsorted(shared, vb[kb])
    ra, rb = ra[ka], rb[kb]
    for c in range(0, len(shared), 2048):
        ma, mb = np.zeros((len(a), 2048), np.float32), np.zeros((len(b), 2048), np.float32)
        ia, ib = (ca >= c) & (ca < c + 2048), (cb >= c) & (cb < c + 2048)
        ma[ra[ia], ca[ia] - c] = 1
        mb[rb[ib], cb[ib] - c] = 1
        out += ma @ mb.T
    return out


def tile_links(base: int, a: list[tuple], b: list[tuple] | None, threshold: Fraction) -> np.ndarray:
    """Which members of two sides (or of one) are similar. A member is
    (cid, weight, size, minus, plus): its set lacks ``minus`` of the base and has ``plus`` beside it."""
    c = a if b is None else b
    less_a, less_c = (np.array([len(m[3]) for m in s], np.float32) for s in (a, c))
    both = base - less_a[:, None] - less_c[None] + overlap([m[3] for m in a], [m[3] for m in c]) \
        + overlap([m[4] for m in a], [m[4] for m in c])
    size = np.array([m[2] for m in a], float)[:, None] + np.array([m[2] for m in c], float)[None]
    p, q = threshold.numerator, threshold.denominator
    link = (p + q) * both.astype(np.int64) >= p * size.astype(np.int64)
    if b is None:
        np.fill_diagonal(link, False)
    return link


def forest(link: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least linked id reached by each member: labels spread until they rest."""
    big = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    same = a is b
    while True:
        na = np.minimum(la, np.where(link, lb[None], big).min(axis=1, initial=big))
        nb = na if same else np.minimum(lb, np.where(link, na[:, None], big).min(axis=0, initial=big))
        if (na == la).all() and (nb == lb).all():
            return na, nb
        la, lb = na, nb


def verified_links(members: DataFrame, threshold: Fraction = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Exact links inside candidate groups: ``kind`` 0 rows give a member's
    (``a``) links by weight (``b``); kind 1 rows are links ``a, b`` of a forest."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            out = []
            for cid, root, n, weight, own, base in zip(*cols):
                s, p = _set(own), _set(base)
                out.append((cid, root, n, weight, len(s), len(p), np.setdiff1d(p, s, assume_unique=True).tobytes(),
                            np.setdiff1d(s, p, assume_unique=True).tobytes()))
            types = [pa.int64()] * 6 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)] if out else
                                             [pa.array([], t) for t in types], names=_MEMBER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            sides: tuple[list, list] = ([], [])
            for _, second, own, cid, weight, size, base, minus, plus in tile:
                sides[second].append((cid, weight, size, np.frombuffer(minus, np.uint64), np.frombuffer(plus, np.uint64)))
            a, b, one = *sides, tile[0][2]
            if not a or not (one or b):
                continue
            link = tile_links(tile[0][6], a, None if one else b, threshold)
            ida = np.array([m[0] for m in a], np.int64)
            idb = ida if one else np.array([m[0] for m in b], np.int64)
            wa, wb = (np.array([m[1] for m in s], np.int64) for s in (a, a if one else b))
            deg = [(ida, link @ wb)] + ([] if one else [(idb, wa @ link)])
            la, lb = forest(link, ida, idb)
            edge = [(ida, la)] + ([] if one else [(idb, lb)])
            kind, x, y = [], [], []
            for k, pairs in ((0, deg), (1, edge)):
                for ids, v in pairs:
                    keep = v > 0 if k == 0 else v != ids
                    kind.append(np.full(int(keep.sum()), k, np.int32))
                    x.append(ids[keep])
                    y.append(v[keep].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (kind, x, y)], names=["kind", "a", "b"])

    bases = members.where(F.col("cid") == F.col("root")).select("root", F.col("set").alias("base"))
    coded = members.select("cid", "root", "n", "weight", "set").join(bases, "root") \
        .select("cid", "root", "n", "weight", "set", "base") \
        .mapInArrow(tidy(differ), "cid long, root long, n long, weight long, size long, base long, minus binary, plus binary")
    return _blocked(coded, "root", "n", block, ["cid", "weight", "size", "base", "minus", "plus"]) \
        .repartition("tile").sortWithinPartitions("tile").mapInArrow(tidy(run), "kind int, a long, b long")


_MEMBER = ["cid", "root", "n", "weight", "size", "base", "minus", "plus"]


def classes_of(docs: DataFrame, threshold: Fraction = THRESHOLD, recall: float = RECALL,
               bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: ``doc_id, hash`` (of the text), ``first`` (the class's
    first document: ``none`` if it has no id, ``doc_id, hash``) and ``n_links``."""
    runs = runs_for(recall, threshold)
    packed = pack_documents(docs, "nj_docs")
    sk = materialize(sketches(packed, runs), "nj_sketches")
    classes = materialize(sk.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min(_place()).alias("rep"), F.count("*").alias("weight"), F.min(F.struct("batch", "idx")).alias("at"),
        F.first("path").alias("path"), F.first("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()), "nj_classes")
    leaves = chosen_paths(classes, runs, bucket)
    groups = materialize(components(candidate_links(leaves, classes, bucket)), "nj_groups")
    size = groups.groupBy("root").agg(F.count("*").alias("n"))
    wanted = groups.join(size, "root").join(classes.select(F.col("cid").alias("node"), "weight", "at"), "node") \
        .select(F.col("node").alias("cid"), "root", "n", "weight", "at.batch", "at.idx")
    wanted = materialize(wanted, "nj_wanted")
    sets = materialize(group_sets(packed, wanted.select("cid", "batch", "idx")), "nj_sets")
    found = materialize(verified_links(wanted.select("cid", "root", "n", "weight").join(sets, "cid"), threshold, block), "nj_links")
    degree = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("links"))
    comp = components(found.where("kind = 1").select("a", "b")).select(F.col("node").alias("cid"), "root")
    linked = classes.select("cid", "key", "rep", "weight").join(comp, "cid", "left").join(degree, "cid", "left")
    linked = materialize(linked.select("key", "rep", "root", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")),
                         "nj_linked")
    names = linked.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("rep").alias("name"))
    per_key = linked.join(names, "root", "left").select("key", F.coalesce("name", "rep").alias("first"), "n_links")
    return sk.select("doc_id", "hash", "key").join(per_key, "key", "left").select(
        "doc_id", "hash", F.coalesce("first", _place()).alias("first"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _place() -> "F.Column":
    """Order of documents: those with an id first, by id, then by text hash."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")


def jaccard_join(docs: DataFrame, **params) -> DataFrame:
    """Per row of ``docs``: ``doc_id, class_id, n_links``.

    ``class_id`` is the least doc_id among the documents that are linked to it,
    directly or over others; ``n_links`` the number of other documents whose
    shingle sets have Jaccard similarity of at least ``threshold``.
    """
    return classes_of(docs, **params).select("doc_id", F.col("first.doc_id").alias("class_id"), "n_links")


def keep_first(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with the first document of every class; of rows equal in id and
    text one stays."""
    first = classes_of(docs, **params).select("first").distinct() \
        .select(F.col("first.doc_id").alias("__first_id"), F.col("first.hash").alias("__first_hash"))
    key = docs.select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__hash"), "text",
                      pack(docs).alias("row"))
    kept = key.join(first, F.col("__id").eqNullSafe(F.col("__first_id")) & (F.col("__hash") == F.col("__first_hash")),
                    "left_semi").dropDuplicates(["__id", "__hash"])
    return kept.select(*unpack(docs))
