"""Temperature mixing of sources to target weights.

A source's weight is its token share raised to an exponent and normalised.
The exponent lies on a grid of ``STEPS`` steps between 0 (uniform) and 1
(natural) and is found by bisection: the largest at which the weights'
entropy reaches a target share of its maximum, raised if needed to the
smallest that repeats no source more often than a limit.

The weights become documents through block permutations. A source's stream is
one epoch after the other; each epoch is a permutation of the source's
``BLOCKS`` hash blocks, a block's documents follow in hash order, and the stream
ends before the first document that would exceed the source's token budget.

Scale: sources are pre-aggregated; the bisection evaluates 16 exponents in one
small aggregate per round, so any number of sources works. A source, however
hot, is cut as ``BLOCKS`` block sums; the one block that the cut falls into
is refined by its next hash digits until it is small.

Cases: a null source is a source; documents without tokens cost nothing and are
drawn in full epochs and by position like others; a source without tokens has
weight 0 and is not drawn; documents of equal id and token count are
interchangeable; other columns are kept whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize

STEPS = 1_000_000        # resolution of the exponent
BLOCKS = 256             # blocks per source: the first two hex digits of a document's hash
REFINE_ROWS = 100_000    # a cut block with more documents is split by its next two digits
ENTROPY = 0.9            # target entropy, as a share of ln(number of sources)
MAX_EPOCHS = 4.0         # repetition limit


def token_count(text: Column) -> Column:
    """Runs of characters other than white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def _search(ok_at, rounds_of: int = 16) -> int:
    """Smallest grid step below STEPS at which the monotone test holds, else
    STEPS; ``ok_at`` tests several steps in one pass."""
    lo, hi = 0, STEPS                       # the answer lies in [lo, hi]
    while lo < hi:
        steps = sorted({lo + (hi - lo) * i // rounds_of for i in range(rounds_of)})
        for s, ok in zip(steps, ok_at(steps)):
            if ok:
                hi = s
                break
            lo = s + 1
    return lo


def find_exponent(totals: DataFrame, budget: float | None, entropy: float | None = ENTROPY,
                  max_epochs: float | None = MAX_EPOCHS) -> float:
    """The exponent for materialised ``source, tokens``; see the module text.
    ``budget`` None: the least that draws every source once."""
    live = totals.where("tokens > 0")
    n, total = live.agg(F.count("*"), F.sum("tokens")).first()
    if not n:
        return 1.0
    p = F.col("tokens") / F.lit(float(total))

    def stats(steps: list[int]) -> list[tuple[float, float]]:
        """Entropy, and the most epochs of any source, at each exponent."""
        cols = []
        for i, s in enumerate(steps):
            raw = F.pow(p, F.lit(s / STEPS))
            cols += [F.sum(raw).alias(f"z{i}"), F.sum(raw * F.log(p)).alias(f"l{i}"),
                     F.max(raw / F.col("tokens")).alias(f"e{i}"), F.max(F.col("tokens") / raw).alias(f"b{i}")]
        r = live.agg(*cols).first()
        return [(math.log(r[f"z{i}"]) - s / STEPS * r[f"l{i}"] / r[f"z{i}"],
                 r[f"e{i}"] * (r[f"b{i}"] if budget is None else budget / r[f"z{i}"])) for i, s in enumerate(steps)]

    best = STEPS if max_epochs is None else 0          # without targets: natural shares
    if entropy is not None:                  # entropy falls as the exponent grows: last step that reaches it
        goal = entropy * math.log(n) - 1e-9
        best = max(0, _search(lambda steps: [h < goal for h, _ in stats(steps)]) - 1)
        if best == STEPS - 1 and stats([STEPS])[0][0] >= goal:
            best = STEPS
    if max_epochs is not None:               # the most epochs fall as the exponent grows
        best = max(best, _search(lambda steps: [e <= max_epochs for _, e in stats(steps)]))
    return best / STEPS


def source_budgets(totals: DataFrame, exponent: float, budget: float | None) -> DataFrame:
    """``source, tokens, weight, epochs, rest``: full epochs and left-over tokens."""
    live = totals.where("tokens > 0")
    total = live.agg(F.sum("tokens")).first()[0] or 1
    raw = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent))
    z, most = live.agg(F.sum(raw), F.max(F.col("tokens") / raw)).first()
    least, budget = budget is None, (most or 0.0) * (z or 1.0) if budget is None else budget
    weight = raw / F.lit(z or 1.0)
    # the small addend keeps a budget of whole epochs from falling just below them
    due = F.floor(weight * F.lit(float(budget)) + F.lit(1e-6)).cast("long")
    if least:                                # rounding of large counts must not cost a source its last document
        due = F.greatest(due, F.col("tokens").cast("long"))
    epochs = F.floor(due / F.col("tokens")).cast("long")
    return live.select("source", "tokens", weight.alias("weight"), epochs.alias("epochs"),
                       (due - epochs * F.col("tokens")).alias("rest"))


def block_hash(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def block_order(source: Column, epoch: Column, block: Column, seed: str) -> Column:
    """Sort key of a block in an epoch's permutation of its source's blocks."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(source.cast("string"), F.lit("null")),
                             epoch.cast("string"), block).cast("binary"))


def _first_over(pieces: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """Per source the first piece, in stream order, whose running token sum
    exceeds ``left``; ``left`` becomes what remains before that piece."""
    w = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = pieces.withColumn("upto", F.sum("tokens").over(w)).where(F.col("upto") > F.col("left")) \
        .withColumn("left", F.col("left") - F.col("upto") + F.col("tokens"))
    return over.groupBy("source").agg(F.min_by(F.struct("left", *keep), F.struct("upto", *order)).alias("x")) \
        .select("source", "x.*")


def stream_ends(slim: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Per source the document at which the partial epoch ends (it is not drawn):
    ``source, end`` with ``end`` its place (order, hash, doc_id, tokens)."""
    piece, depth = plan.select("source", "epochs", F.col("rest").alias("left"), F.lit("").alias("prefix")), 0
    while True:
        small, big = broadcast_if_small(piece.withColumnRenamed("source", "s"), slim, 200)
        inside = big.join(small, F.col("source").eqNullSafe(F.col("s")) & F.col("hash").startswith(F.col("prefix"))).drop("s")
        if depth and (depth == 32 or (piece.agg(F.max("n")).first()[0] or 0) <= REFINE_ROWS):
            break
        parts = inside.groupBy("source", "epochs", "left", F.substring("hash", 1, depth + 2).alias("block")) \
            .agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
        order = ["block"] if depth else ["order", "block"]
        if not depth:
            parts = parts.withColumn("order", block_order(F.col("source"), F.col("epochs"), F.col("block"), seed))
        piece = materialize(_first_over(parts, order, ["epochs", F.col("block").alias("prefix"), "n"]), "mix_piece")
        depth += 2
    docs = inside.withColumn("order", block_order(F.col("source"), F.col("epochs"), F.substring("hash", 1, 2), seed))
    place = ["order", "hash", "doc_id", "tokens"]
    return _first_over(docs.select("source", "left", *place), place[1:], [F.struct(*place).alias("end")]).drop("left")


def mix(docs: DataFrame, budget: float | None = -1.0, entropy: float | None = ENTROPY,
        max_epochs: float | None = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """Per row of ``docs`` (``doc_id, source, n_tokens`` and any others): its
    columns and a struct ``mix`` of ``repeats`` (how often it is drawn),
    ``epochs`` (full epochs of its source), ``hash`` and ``weight``.

    ``budget``: tokens to draw; -1 for as many as there are; None for the
    least that draws every source once.
    """
    docs = docs.drop("mix")                  # the result replaces a column so named
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").cast("long").alias("doc_id"), "source",
                        F.coalesce("n_tokens", F.lit(0)).cast("long").alias("tokens"),
                        block_hash(F.col("doc_id"), seed).alias("hash"))
    slim = materialize(keyed.drop("row"), "mix_docs")
    totals = materialize(slim.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix_sources")
    if budget == -1.0:
        budget = float(totals.agg(F.sum("tokens")).first()[0] or 0)
    exponent = find_exponent(totals, budget, entropy, max_epochs)
    plan = materialize(source_budgets(totals, exponent, budget), "mix_plan")
    ends = materialize(plan.join(stream_ends(slim, plan, seed).withColumnRenamed("source", "s"),
                                 F.col("source").eqNullSafe(F.col("s")), "left")
                       .select(F.col("source").alias("s"), "weight", "epochs", "end"), "mix_ends")
    small, big = broadcast_if_small(ends, keyed, 400)
    order = block_order(F.col("source"), F.col("epochs"), F.substring("hash", 1, 2), seed)
    here = F.struct(order.alias("order"), "hash", "doc_id", "tokens")
    drawn = F.col("epochs") + F.when(F.coalesce(here < F.col("end"), F.lit(False)), 1).otherwise(0)
    return big.join(small, F.col("source").eqNullSafe(F.col("s")), "left").select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns],
        F.struct(F.coalesce(drawn, F.lit(0)).cast("long").alias("repeats"), F.coalesce("epochs", F.lit(0)).alias("epochs"),
                 "hash", F.coalesce("weight", F.lit(0.0)).alias("weight")).alias("mix"))


def schedule(mixed: DataFrame, seed: str = "mix") -> DataFrame:
    """One row per draw: the columns of ``mixed`` without ``mix``, plus ``mix_epoch``
    and ``mix_order``; sorting a source by (epoch, order) gives its stream."""
    rows = mixed.where(F.col("mix.repeats") > 0) \
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix.repeats") - 1)))
    block = block_order(F.col("source"), F.col("mix_epoch"), F.substring("mix.hash", 1, 2), seed)
    return rows.withColumn("mix_order", F.concat(block, F.col("mix.hash"))).drop("mix")
