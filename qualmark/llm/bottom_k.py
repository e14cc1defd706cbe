"""Document fingerprints: bottom-k sketches of shingle hashes, in SQL functions alone.

A text's words are cut into shingles of five words, each shingle is hashed to 48
bits (the upper ones of its xxHash64), and the ``k`` smallest distinct hashes are the
sketch. The sketch of a union is made from the sketches of its parts, so parts may
lie anywhere. From sketches follow the resemblance (Jaccard similarity) of two
sets, the containment of one in the other, and the number of distinct shingles;
they are exact for sets of fewer than ``k`` shingles.

Scale: a text is sketched where it is read, in one expression. Merging sends at
most ``k`` hashes a key and task, since a window limit cuts them before the shuffle.
``with_next`` pairs every row with the next by id: rows are dealt to ranges by
splitters of a bounded sample, and each range gets a copy of the row after its last.

Cases: a word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the lower-cased text; a
text of 1 to 4 words is one shingle of all its words; a text without words is one
shingle of itself, so only the empty text (null is empty) has no shingle; two empty
sets are alike (1), an empty and another set are not (0); very long texts are
sketched whole; repeated rows have equal sketches, and follow one another; rows of one
id are ordered by their text's hash and lie in one range; null ids come last; other
columns are kept whatever their names; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

K = 256                          # hashes of a sketch
WORDS = 5                        # words of a shingle
BITS = 48                        # bits of a hash
RANGE_ROWS = 2000                # rows of a range of ids, about, until there are RANGES
RANGES = 1 << 16
SPLIT_SAMPLE = 32                # ids sampled per range, about

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - BITS)


def shingles(text: Column, width: int = WORDS) -> Column:
    """Hashes of a text's shingles, one for each place (null text: none)."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(F.lower(text), NOT_WORD), "")

    def cut(h: Column) -> Column:
        n = F.size(h)
        each = F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda i: _hash(*[F.get(h, i + j) for j in range(width)]))
        return F.when(n > 0, each).when(F.length(text) > 0, F.array(_hash(text))).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), cut)


def sketch(hashes: Column, k: int = K) -> Column:
    """The ``k`` smallest distinct hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def union(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return sketch(F.concat(a, b), k)


def merge(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from those of any number of parts (a null sketch adds nothing)."""
    names = [F.col(f"`{c}`") for c in keys]
    hashes = sketches.select(F.struct(*names, F.lit(0).alias("__k")).alias("key"), F.explode_outer(column).alias("hash")).distinct()
    order = Window.partitionBy("key").orderBy(F.col("hash").asc_nulls_last())
    few = hashes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return few.groupBy("key").agg(F.sort_array(F.collect_list("hash")).alias("made")) \
        .select(*[F.col(f"key.`{c}`").alias(c) for c in keys], F.col("made").alias(column))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct hashes of the sketched set (exact below ``k``)."""
    last = (F.element_at(s, -1) + 1) / F.lit(float(1 << BITS))
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / last)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sketched sets."""
    def share(u: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(a, b), u))
        return F.when(F.size(u) > 0, both / F.size(u)).otherwise(F.lit(1.0))
    return _let(union(a, b, k), share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s hashes that ``b`` has (1 if ``a`` has none)."""
    both = resemblance(a, b, k) * distinct_shingles(union(a, b, k), k)
    return F.when(F.size(a) > 0, F.least(F.lit(1.0), both / distinct_shingles(a, k))).otherwise(F.lit(1.0))


def to_text(s: Column) -> Column:
    """A sketch as one string: the hashes one after the other, twelve hexadecimal digits each."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), BITS // 4, "0")), "")


def from_text(t: Column) -> Column:
    size = BITS // 4
    each = F.transform(F.sequence(F.lit(0), F.floor(F.length(t) / size).cast("int") - 1),
                       lambda i: F.conv(t.substr(i * size + 1, F.lit(size)), 16, 10).cast("long"))
    return F.when(F.length(t) > 0, each).otherwise(F.array().cast("array<bigint>"))


def fingerprint(docs: DataFrame, column: str = "fingerprint", k: int = K) -> DataFrame:
    """``docs`` with the sketch of ``text`` in ``column`` (it replaces a column so named)."""
    return docs.withColumn(column, sketch(shingles(F.col("text")), k))


# ------------------------------------------------------------------ next document
def splitters(ids: DataFrame, range_rows: int = RANGE_ROWS) -> list[int]:
    """Ids that cut the rows into ranges of about ``range_rows`` (at most RANGES ranges)."""
    rows = ids.count()
    ranges = max(1, min(RANGES, rows // range_rows))
    if ranges == 1:
        return []
    few = ids.where(F.rand(7) < SPLIT_SAMPLE * ranges / rows)
    found = few.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], F.lit(max(10_000, 8 * ranges)))).first()[0]
    return sorted(set(found or []))


def range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` an id reaches, by binary search; null ids: -1."""
    place = F.lit(0)
    if cuts:
        table = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
        steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
        place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
            F.coalesce(F.get(table, at + step - 1) <= doc_id, F.lit(False)), at + step).otherwise(at))
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(place)


def with_next(docs: DataFrame, made: dict[str, Column] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text`` and others): ``row`` (a struct of its columns but
    ``text``), ``text``, the columns ``made`` from ``text``, and ``next``, a struct of ``text``
    and the ``made`` columns of the next row by descending id (for the last, of the first)."""
    made = made or {}
    key = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], F.lit(0).alias("__row")).alias("row"))
    placed = key.withColumn("part", range_of(F.col("id"), splitters(key.select("id"), range_rows))).withColumn("th", F.xxhash64("text"))
    # the first row of each range is the next of the range's that lies before it in the order
    first = placed.groupBy("part").agg(F.max(F.struct("id", F.bitwise_not("th").alias("less"))).alias("x"))
    before = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy(F.lit(0))))
    heads = materialize(first.select(F.col("x.id").alias("i"), F.bitwise_not("x.less").alias("t"), before.alias("to")), "next_heads")
    ghosts = placed.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t"))) \
        .dropDuplicates(["to"]).select("id", "text", F.lit(None).cast(key.schema["row"].dataType).alias("row"), F.col("to").alias("part"), "th")
    dealt = placed.withColumn("ghost", F.lit(False)).unionByName(ghosts.withColumn("ghost", F.lit(True))).repartition("part")
    order = Window.partitionBy("part").orderBy("ghost", F.col("id").desc_nulls_last(), "th")
    return dealt.withColumns(made).withColumn("next", F.lead(F.struct("text", *made)).over(order)).where(~F.col("ghost")) \
        .select("row", "text", *made, "next")
