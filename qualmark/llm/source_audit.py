"""Divergence of sources within a language, from term counts of whole texts.

Inside ``mapInArrow`` an Arrow compute pipeline (``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``) turns batches
into partial counts. They meet by (language, term), where terms of too few
documents go. The kept counts are read again as columnar shards, sorted by
language, tile of sources and term; a shard adds up the divergences of all pairs
of a tile's sources.

Smoothed shares are exact integers: ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``
and a divergence is ``floor((p - q)^2 / (p + q))`` a term.

Scale: a task's counts are added up before the shuffle, so a common term is a few
rows a task; a term has at most one merged row per source. Sources are dealt to
tiles of ``TILE`` on each side, so no task holds all pairs of a language with very
many sources. Terms that no source of a tile has are not sent: they add a constant.

Cases: null text, language or source is read as ''; an empty text, or a language
without kept terms, still has its groups (pair values 0); very long texts are cut
out of their batch alone; repeated rows are documents of their own; ties go to the
smaller item in UTF-8 order; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize
from .textops import slices, small_batches, tidy

MIN_DOCS = 10                    # documents of its language that a kept term is in, at least
TERMS = 10                       # terms reported per group
TILE = 128                       # sources on a tile's side
SLICE_BYTES = 1 << 20            # text counted at once
HELD_ROWS = 200_000              # partial counts a task holds before it sends them
SHARDS = 64                      # shards of a language's terms per tile
RUN_ROWS = 1 << 16               # counts of a shard turned into a matrix at once
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

_KEYS = ["lang", "source", "term"]


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """``lang, source, term, n`` (occurrences) and ``docs`` (rows with it) of a batch
    of ``lang, source, text``."""
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column(2)), pattern=NOT_TERM)
    row, term = pc.list_parent_indices(words), pc.list_flatten(words)
    some = pc.not_equal(term, "")
    row, term = row.filter(some), term.filter(some).dictionary_encode()
    per_doc = pa.table({"row": row, "code": term.indices}).group_by(["row", "code"]).aggregate([("code", "count")])
    at = per_doc["row"]
    wide = pa.table({"lang": batch.column(0).dictionary_encode().indices.take(at),
                     "source": batch.column(1).dictionary_encode().indices.take(at), "term": per_doc["code"],
                     "n": per_doc["code_count"]})
    sums = wide.group_by(_KEYS).aggregate([("n", "sum"), ("n", "count")])
    names = [batch.column(0).dictionary_encode().dictionary, batch.column(1).dictionary_encode().dictionary, term.dictionary]
    return pa.table({**{k: d.take(sums[k]) for k, d in zip(_KEYS, names)}, "n": sums["n_sum"], "docs": sums["n_count"]})


def _merged(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table({**{k: out[k] for k in _KEYS}, "n": out["n_sum"], "docs": out["docs_sum"]})


def partial_counts(docs: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """``lang, source, term, n, docs`` summed over the batches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                held.append(term_counts(part))
                if sum(t.num_rows for t in held) > 2 * held_rows:
                    held = [_merged(held)]
                    if held[0].num_rows > held_rows:
                        yield from held[0].to_batches(max_chunksize=10_000)
                        held = []
        if held:
            yield from _merged(held).to_batches(max_chunksize=10_000)

    small_batches(docs.sparkSession)
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return read.mapInArrow(tidy(run), "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, total`` (of the language) and ``head`` (true once a
    term and language) of the terms in at least ``min_docs`` documents of a language."""
    by_term = Window.partitionBy("lang", "term")
    merged = partial_counts(docs).repartition("lang", "term").groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return merged.withColumn("in_docs", F.sum("docs").over(by_term)).where(F.col("in_docs") >= min_docs) \
        .select(*_KEYS, "n", F.sum("n").over(by_term).alias("total"),
                (F.row_number().over(by_term.orderBy("source")) == 1).alias("head"))


# ---------------------------------------------------------------- arithmetic
def shares(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``1 + floor(10^9 (count + 2) / size)`` in exact integers: long division, three
    decimal digits at a time (``size`` is at least ``count + 2``)."""
    if len(size) and int(np.max(size)) >= 1 << 53:
        raise OverflowError("more than 2^53 terms in a group")
    rest, p = count + 2, np.zeros_like(count)
    for _ in range(3):
        p, rest = p * 1000 + rest * 1000 // size, rest * 1000 % size
    return 1 + p


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def share_column(count: Column, size: Column) -> Column:
    """``shares`` as a SQL expression."""
    scaled = (count + 2).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.call_function("div", scaled, size.cast("decimal(20,0)")) + 1


def divergence_column(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


# -------------------------------------------------------------------- shards
_SEGMENT = ["lang", "x", "y", "shard"]


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The sorted rows of a shard in runs of about ``rows`` that end between terms."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) < rows:
            continue
        t = pa.Table.from_batches(held)
        same = np.ones(t.num_rows, bool)                       # rows of the last term, which may go on
        for c in [*_SEGMENT, "term"]:
            v = t[c].combine_chunks()
            same &= np.asarray(pc.fill_null(pc.equal(v, v[-1]), v[-1].as_py() is None)) if v[-1].as_py() is not None \
                else np.asarray(pc.is_null(v))
        cut = int(np.argmax(same))
        if cut:
            yield t.slice(0, cut)
            held = t.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


class Segment:
    """Pair sums of one (language, tile, shard), fed run by run."""

    def __init__(self, key: tuple, tile: int):
        self.key, self.tile = key, tile
        self.size = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.value, self.terms = None, 0

    def sources(self, at: np.ndarray, size: np.ndarray) -> None:
        """The sizes of all sources of both sides (rows without a term, which come first)."""
        for side, block in enumerate(self.key[1:3]):
            own = np.unique(at[at // self.tile == block], return_index=True)[1]
            self.size[side] = size[at // self.tile == block][own]
        self.value = np.zeros((len(self.size[0]), len(self.size[1])), np.int64)

    def add(self, term: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        row = np.concatenate([[0], np.cumsum(np.diff(term) != 0)])
        p = []
        for size, block in zip(self.size, self.key[1:3]):
            own = at // self.tile == block
            count = np.zeros((row[-1] + 1, len(size)), np.int64)
            count[row[own], at[own] % self.tile] = n[own]
            p.append(shares(count, size))
        for i in range(p[0].shape[1]):
            self.value[i] += divergence(p[0][:, i:i + 1], p[1]).sum(axis=0)
        self.terms += int(row[-1]) + 1

    def rows(self) -> pa.RecordBatch:
        lang, x, y, _ = self.key
        i, j = np.indices(self.value.shape)
        i, j = i + x * self.tile, j + y * self.tile
        once = i < j
        k = int(once.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * k, pa.string()), pa.array(i[once].astype(np.int32)), pa.array(j[once].astype(np.int32)),
             pa.array(self.value[once]), pa.array(np.full(k, self.terms, np.int64))], names=["lang", "i", "j", "value", "terms"])


def segments(batches: Iterator[pa.RecordBatch], tile: int, rows: int) -> Iterator[pa.RecordBatch]:
    now: Segment | None = None
    for t in _runs(batches, rows):
        lang, term = (t[c].combine_chunks().dictionary_encode() for c in ("lang", "term"))
        code = np.asarray(pc.fill_null(term.indices, -1))
        num = {c: np.asarray(t[c].combine_chunks()) for c in ("x", "y", "shard", "at", "n", "size")}
        marks = [np.asarray(lang.indices), num["x"], num["y"], num["shard"]]
        new = np.any([np.diff(m) != 0 for m in marks], axis=0)
        edge = np.concatenate([[0], np.flatnonzero(new) + 1, [len(code)]])
        for a, b in zip(edge[:-1], edge[1:]):
            key = (lang[int(a)].as_py(), *(int(m[a]) for m in marks[1:]))
            if now is None or now.key != key:
                if now is not None:
                    yield now.rows()
                now = Segment(key, tile)
            plain = a + int((code[a:b] < 0).sum())             # rows without a term come first
            if plain > a:
                now.sources(num["at"][a:plain], num["size"][a:plain])
            if b > plain:
                now.add(code[plain:b], num["at"][plain:b], num["n"][plain:b])
    if now is not None:
        yield now.rows()


def pair_sums(kept: DataFrame, groups: DataFrame, tile: int = TILE, shards: int = SHARDS, rows: int = RUN_ROWS) -> DataFrame:
    """``lang, i, j, value, terms`` for the pairs ``i`` before ``j`` of a language's sources:
    the divergence over the ``terms`` that a source of the pair's tile has."""
    mine, blocks = F.floor(F.col("at") / F.lit(tile)).cast("int"), F.ceil(F.col("sources") / F.lit(tile)).cast("int")

    def tiles(df: DataFrame, shard: Column, term: Column, n: Column) -> DataFrame:
        return df.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
            "lang", F.least(mine, "other").alias("x"), F.greatest(mine, "other").alias("y"), shard.alias("shard"),
            term.alias("term"), "at", n.alias("n"), "size")

    small, big = broadcast_if_small(groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "at", "sources", "size"), kept, 100)
    counts = tiles(big.join(small, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s"))),
                   F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"), F.col("term"), F.col("n"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    sizes = tiles(groups.withColumn("every", every), F.col("every"), F.lit(None).cast("string"), F.lit(0).cast("long"))
    sums = counts.unionByName(sizes).repartition(*_SEGMENT).sortWithinPartitions(*_SEGMENT, F.col("term").asc_nulls_first()) \
        .mapInArrow(tidy(lambda batches: segments(batches, tile, rows)), "lang string, i int, j int, value long, terms long")
    return sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


# ------------------------------------------------------------------- reports
class Audit:
    """Written tables of an audit: ``kept`` counts, ``groups`` (``lang, source, at, sources,
    size``) and ``langs`` (``lang, kept_terms, size``); ``size`` is N + 2 V."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        self.kept = materialize(kept_counts(docs, min_docs), "audit_counts")
        langs = self.kept.groupBy("lang").agg(F.count_if("head").alias("kept_terms"), F.sum("n").alias("total"))
        per_group = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("count"))
        named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
        self.langs = materialize(langs.select("lang", "kept_terms", (F.col("total") + 2 * F.col("kept_terms")).alias("size")), "audit_langs")
        count, terms = (F.coalesce(c, F.lit(0)) for c in ("count", "kept_terms"))
        of_lang = Window.partitionBy("lang")
        self.groups = materialize(
            named.join(per_group, ["lang", "source"], "left").join(self.langs.drop("size"), "lang", "left")
            .select("lang", "source", (F.row_number().over(of_lang.orderBy("source")) - 1).alias("at"),
                    F.count("*").over(of_lang).alias("sources"), (count + 2 * terms).alias("size"), terms.alias("kept_terms")), "audit_groups")

    def pairs(self, tile: int = TILE, shards: int = SHARDS, rows: int = RUN_ROWS) -> DataFrame:
        """``lang, source, item`` (each other source of the language) ``, value``."""
        end = lambda side: self.groups.select("lang", F.col("at").alias(side), F.col("source").alias(f"{side}_source"),
                                              F.col("size").alias(f"{side}_size"), *(["kept_terms"] if side == "i" else []))
        sums = pair_sums(self.kept, self.groups, tile, shards, rows).join(end("i"), ["lang", "i"]).join(end("j"), ["lang", "j"])
        none = [share_column(F.lit(0).cast("long"), F.col(f"{s}_size")) for s in "ij"]
        absent = F.col("kept_terms") - F.col("terms")            # terms that neither of the pair has
        value = F.col("value") + F.when(absent > 0, absent * divergence_column(*none)).otherwise(F.lit(0))
        both = sums.select("lang", "i_source", "j_source", value.alias("value"))
        return both.select("lang", F.explode(F.array(
            F.struct(F.col("i_source").alias("source"), F.col("j_source").alias("item")),
            F.struct(F.col("j_source").alias("source"), F.col("i_source").alias("item")))).alias("o"), "value") \
            .select("lang", "o.source", "o.item", "value")

    def terms(self) -> DataFrame:
        """``lang, source, item`` (a term more common there than in the language) ``, value``."""
        small, big = broadcast_if_small(self.groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "size"), self.kept, 100)
        sized = big.join(small, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s"))) \
            .join(self.langs.select("lang", F.col("size").alias("lang_size")), "lang")
        shared = sized.select("lang", "source", F.col("term").alias("item"), share_column(F.col("n"), F.col("size")).alias("p"),
                              share_column(F.col("total"), F.col("lang_size")).alias("q")).where(F.col("p") > F.col("q"))
        return shared.select("lang", "source", "item", divergence_column(F.col("p"), F.col("q")).alias("value"))


def divergence_report(docs: DataFrame, min_docs: int = MIN_DOCS, terms: int = TERMS, **params) -> DataFrame:
    """``lang, source, part, item, value, rank``: ``pair`` rows for each other source of the
    language, ``term`` rows for the ``terms`` terms that set the source apart the most."""
    audit = Audit(docs, min_docs)
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
              for part, rows in (("pair", audit.pairs(**params)), ("term", audit.terms()))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= terms))
