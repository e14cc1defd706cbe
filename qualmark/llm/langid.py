"""Language identification with a byte convolutional network.

Bytes are embedded, filters of widths 2, 3 and 4 slide over fixed-length
windows, each filter keeps its maximum over the window, and a softmax layer
gives the language. Training is plain numpy (Adam, gradients through the
maxima): ``fit`` takes a bounded sample of labelled rows, ``learn`` all windows of
all of them, dealt to shards whose parameters are averaged. Prediction cuts every
whole text into windows and averages the windows' probabilities, weighted by their bytes.

A softmax only compares the learned languages. So the model also has the byte pairs
of each (of the rows it learned from), and a text can be asked how likely its own are in
the language it was given: text of no learned language has unlikely ones.

For prediction the embedding and filters collapse into two tables indexed by a
pair of bytes, so a window position costs two row gathers.

Cases: null text or text without a letter is ``und`` with score 0; with no
usable training row every document is ``und``; very long texts are windowed
in chunks; ties go to the alphabetically first language; repeated rows are
each predicted; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import materialize
from .textops import column_bytes, slices, small_batches, tidy

UND = "und"
WIDTHS = (2, 3, 4)
WINDOW_BYTES = 128
DOCS_PER_LANG = 300              # training sample: this many rows per language, smallest hash first
WINDOWS_PER_DOC = 8              # evenly spaced windows of each sampled text
CHUNK = 1 << 16                  # bytes scored at once
SHARD_WINDOWS = 1 << 15          # windows of labelled text, about, that one shard of ``learn`` trains on
PASS_WINDOWS = 60_000            # fewer labelled windows are passed over up to six times
SCALE = 1 << 20                  # parameters are averaged, and
FINE = 1 << 32                   # limits found, as whole numbers of such parts: in any order the same
LENGTH_CLASSES = (1, 2, 4, 8)    # windows of a text, at least: score limits are set by class
LIMIT_SHARE = 0.004              # labelled rows below one of a class's limits, about
LIMIT_ROWS = 30                  # labelled rows a class needs for a limit of its own
STEP_ROWS = 1024                 # window positions summed at once: they stay in the processor's cache
STRIDE = 16                      # positions of a training batch summed at once, likewise
SHARD_RATE = 0.003               # step size of the shards that go on from the first one's parameters


@dataclass
class Model:
    langs: list[str]
    emb: np.ndarray              # 256 x E
    kern: dict[int, np.ndarray]  # width -> width x E x F
    bias: np.ndarray             # filters of all widths
    out: np.ndarray              # filters x languages
    out_bias: np.ndarray
    pairs: np.ndarray | None = None      # languages x 65536: log share of a byte after another

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Sums of bytes (i, i+1) for all widths, and of (i+2, i+3) for widths over 2."""
        f = self.kern[2].shape[2]
        t = {(w, j): self.emb @ self.kern[w][j] for w in WIDTHS for j in range(w)}
        first = np.concatenate([t[w, 0][:, None] + t[w, 1][None] for w in WIDTHS], axis=2).reshape(65536, 3 * f)
        second = np.concatenate([np.broadcast_to(t[3, 2][:, None], (256, 256, f)),
                                 t[4, 2][:, None] + t[4, 3][None]], axis=2).reshape(65536, 2 * f)
        return np.ascontiguousarray(first, np.float32), np.ascontiguousarray(second, np.float32)

    def window_probs(self, win: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Language probabilities of windows (rows of bytes; 3 zero bytes follow each)."""
        n, size = win.shape
        f = self.kern[2].shape[2]
        x = np.zeros((size + 3, n), dtype=np.intp)
        x[:size] = win.T
        pair = x[:-1] * 256 + x[1:]
        step = max(1, STEP_ROWS // max(n, 1))
        sums, more = np.empty((step, n, 3 * f), np.float32), np.empty((step, n, 2 * f), np.float32)
        best = np.full((n, 3 * f), -np.inf, np.float32)
        for a in range(0, size, step):
            b = min(a + step, size)
            h = tables[0].take(pair[a:b], axis=0, out=sums[:b - a], mode="clip")
            h[:, :, f:] += tables[1].take(pair[a + 2:b + 2], axis=0, out=more[:b - a], mode="clip")
            np.maximum(best, h.max(axis=0), out=best)
        h = np.maximum(best + self.bias, 0)
        z = h @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, buf: np.ndarray, off: np.ndarray, tables, size: int = WINDOW_BYTES) -> np.ndarray:
        """Mean language probabilities per row of a byte column (rows without bytes: 0)."""
        n = np.diff(off)
        per = -(-n // size)
        row = np.repeat(np.arange(len(n)), per)
        at = off[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)) * size
        stop = off[1:][row]
        total = np.zeros((len(n), len(self.langs)))
        step = max(1, CHUNK // size)
        for a in range(0, len(row), step):
            idx = at[a:a + step, None] + np.arange(size)
            ok = idx < stop[a:a + step, None]
            win = np.where(ok, buf[np.minimum(idx, len(buf) - 1)], 0)
            p = self.window_probs(win, tables) * ok.sum(axis=1)[:, None]
            np.add.at(total, row[a:a + step], p)
        return total / np.maximum(n, 1)[:, None]


def pair_shares(windows: np.ndarray, labels: np.ndarray, k: int, extra: float = 0.02) -> np.ndarray:
    """Log share of each byte after each other, per language, from zero-padded windows."""
    pair = windows[:, :-1].astype(np.int64) * 256 + windows[:, 1:]
    real = windows[:, 1:] > 0
    n = np.bincount((labels[:, None] * 65536 + pair)[real], minlength=k * 65536).reshape(k, 256, 256) + extra
    return np.log(n / n.sum(axis=2, keepdims=True)).reshape(k, 65536).astype(np.float32)


def pair_fit(pairs: np.ndarray, buf: np.ndarray, off: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Mean log share of each row's byte pairs in the row's language (0: fewer than two bytes)."""
    n = np.diff(off)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    inside = row[1:] == row[:-1]
    pair = (buf[:-1].astype(np.int32) * 256 + buf[1:])[inside]
    own = row[:-1][inside]
    return np.bincount(own, weights=pairs[lang[own], pair], minlength=len(n)) / np.maximum(n - 1, 1)


def first_parameters(k: int, embed: int = 8, filters: int = 16, seed: int = 7) -> tuple[dict, np.random.Generator]:
    """Random parameters for ``k`` languages, and the generator they came from."""
    rng = np.random.default_rng(seed)
    par = {"emb": rng.normal(0, 0.5, (256, embed)), "out": rng.normal(0, 0.1, (3 * filters, k)),
           "bias": np.zeros(3 * filters), "out_bias": np.zeros(k)}
    par |= {w: rng.normal(0, 0.5 / np.sqrt(w), (w, embed, filters)) for w in WIDTHS}
    return {n: v.astype(np.float32) for n, v in par.items()}, rng


def as_model(par: dict, langs: list[str]) -> Model:
    return Model(langs, par["emb"], {w: par[w] for w in WIDTHS}, par["bias"], par["out"], par["out_bias"])


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], embed: int = 8, filters: int = 16,
          epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Model:
    """Fit the network on byte windows (rows) and language numbers."""
    par, rng = first_parameters(len(langs), embed, filters, seed)
    descend(par, windows, labels, rng, epochs, batch, rate)
    return as_model(par, langs)


def descend(par: dict, windows: np.ndarray, labels: np.ndarray, rng: np.random.Generator,
            epochs: int = 6, batch: int = 64, rate: float = 0.01) -> None:
    """Adam steps from ``par``, changed in place, over the windows in random order."""
    _, embed, filters = par[2].shape
    flat = np.concatenate([v.ravel() for v in par.values()])             # ``now``, ``grad``: views by name
    slope, m, s = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    now, grad = _views(flat, par), _views(slope, par)
    size, t = windows.shape[1], 0
    x_all = np.concatenate([windows, np.zeros((len(windows), 3), windows.dtype)], axis=1)
    most = min(batch, len(windows))
    strongest = Maxima(most, size, len(WIDTHS) * filters)
    tables = np.zeros((max(WIDTHS), 256, len(WIDTHS) * filters), np.float32)
    taps = [(w, j) for w in WIDTHS for j in range(w)]                    # a filter of width w has w taps
    own = np.concatenate([np.arange(filters) + WIDTHS.index(w) * filters for w, _ in taps])
    ahead = np.arange(most)[:, None] * (size + 3) + np.repeat([j for _, j in taps], filters)

    def by_tap(v: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(v.reshape(len(v), len(taps), filters).transpose(1, 0, 2))

    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), batch):
            pick = order[a:a + batch]
            x, y = x_all[pick].astype(np.intp), labels[pick]
            n = len(y)
            for i, w in enumerate(WIDTHS):
                tables[:w, :, i * filters:(i + 1) * filters] = now["emb"] @ now[w]
            best, where = strongest(tables, np.ascontiguousarray(x.T))
            pre = best + now["bias"]
            h = np.maximum(pre, 0)
            z = h @ now["out"] + now["out_bias"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            p = z / z.sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            grad["out"][:], grad["out_bias"][:] = h.T @ p, p.sum(axis=0)
            g = (p @ now["out"].T) * (pre > 0)
            grad["bias"][:] = g.sum(axis=0)
            g = g.take(own, axis=1)                                      # rows x taps
            byte = x.ravel().take(where.take(own, axis=1) + ahead[:n], mode="clip")
            tap_byte, tap_g = by_tap(byte).ravel(), by_tap(g)
            kern = np.stack([now[w][j] for w, j in taps], axis=1)[:, :, None]
            slopes = np.empty((embed, len(own)), np.float32)
            for i, emb in enumerate(now["emb"].T.copy()):
                slopes[i] = (emb.take(byte) * g).sum(axis=0)
                lane = np.zeros(256, np.float32)
                np.add.at(lane, tap_byte, (tap_g * kern[i]).ravel())     # tap by tap, row by row
                grad["emb"][:, i] = lane
            for i, (w, j) in enumerate(taps):
                grad[w][j] = slopes[:, i * filters:(i + 1) * filters]
            t += 1
            m += 0.1 * (slope - m)
            s += 0.001 * (slope ** 2 - s)
            flat -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    for n, v in par.items():
        v[:] = now[n]


class Maxima:
    """Each filter's maximum over the positions of a batch's windows, and the first position that
    has it. ``STRIDE`` positions are summed at a time, in buffers kept from batch to batch."""

    def __init__(self, rows: int, size: int, filters: int):
        self.size, self.strides = size, -(-size // STRIDE)
        self.sums, self.tops = (np.empty(self.strides * k * rows * filters, np.float32) for k in (STRIDE, 1))
        self.more = np.empty(STRIDE * rows * filters, np.float32)

    def __call__(self, tables: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``tables``: what each byte adds to each filter, by distance (0: beyond its width);
        ``x``: bytes, positions (3 zeros last) x rows."""
        n, filters = x.shape[1], tables.shape[2]
        lanes = n * filters
        sums = self.sums[:self.strides * STRIDE * lanes].reshape(-1, n, filters)
        tops = self.tops[:self.strides * lanes].reshape(-1, lanes)
        sums[self.size:] = -np.inf
        for i, a in enumerate(range(0, self.size, STRIDE)):
            b = min(a + STRIDE, self.size)
            h, g = sums[a:b], self.more[:(b - a) * lanes].reshape(-1, n, filters)
            tables[0].take(x[a:b], axis=0, out=h, mode="clip")
            for j in range(1, len(tables)):
                h += tables[j].take(x[a + j:b + j], axis=0, out=g, mode="clip")
            h.reshape(-1, lanes).max(axis=0, out=tops[i])
        best = tops.max(axis=0)
        stride = first_equal(tops, best)
        near = (stride * (STRIDE * lanes) + np.arange(lanes)) + np.arange(STRIDE)[:, None] * lanes
        near = sums.reshape(-1).take(near, mode="clip")
        where = stride * STRIDE + first_equal(near, best)
        return best.reshape(n, filters), where.reshape(n, filters)


def first_equal(rows: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Per column the first row that equals ``value``."""
    down = np.arange(len(rows), 0, -1, dtype=np.min_scalar_type(len(rows)))[:, None]
    return len(rows) - ((rows == value) * down).max(axis=0).astype(np.intp)


def text_windows(text: str, most: int = WINDOWS_PER_DOC, size: int = WINDOW_BYTES) -> np.ndarray:
    """Up to ``most`` evenly spaced windows over the whole text, zero-padded."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = -(-len(raw) // size)
    out = np.zeros((min(n, most), size), np.uint8)
    for i, w in enumerate(np.unique(np.linspace(0, n - 1, min(n, most)).astype(int))):
        piece = raw[w * size:(w + 1) * size]
        out[i, :len(piece)] = piece
    return out


def sample_rows(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> list:
    """``doc_id, lang, windows`` of at most ``docs_per_lang`` different rows per language
    of ``(doc_id, text, lang)`` that have a letter, chosen by the smallest hash of
    doc_id (then of text), so the same at any size of the cluster.

    Rows are ranked without their texts (narrow columns are shuffled), equal ones
    once, and only those whose hash is among the least of their language, about
    ``4 docs_per_lang``; only the chosen rows' windows come to the driver.
    """
    small_batches(labelled.sparkSession)
    usable = labelled.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & has_letter()) \
        .select("doc_id", "lang", F.xxhash64("text").alias("th"), "text")
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "th")
    # smallest hashes first: a language of n ids has about 4 docs_per_lang of them below this (a row per
    # language; as a sort-merge join it would deal all rows by language before they are cut)
    share = F.least(F.lit(4.0 * docs_per_lang) / F.col("n"), F.lit(1.0))
    size = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).select(
        F.col("lang").alias("l"), F.when(share < 1, ((share - 0.5) * float(1 << 64)).cast("long")).alias("below"))
    few = usable.drop("text").join(F.broadcast(size), F.col("lang") == F.col("l")).where(F.col("below").isNull() | (F.xxhash64("doc_id") < F.col("below")))
    narrow = few.select("doc_id", "lang", "th").distinct()
    chosen = narrow.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= docs_per_lang).drop("rank").collect()
    if not chosen:
        return []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()                         # of the chosen rows: a task sends each once
        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in range(3))))
            at = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
            part = b.take(pa.array(at, pa.int64()))
            win = [text_windows(t).tobytes() for t in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(win, pa.binary())],
                                             names=["doc_id", "lang", "th", "windows"])

    wanted = F.broadcast(labelled.sparkSession.createDataFrame(chosen, narrow.schema))
    rows = usable.join(wanted, ["doc_id", "lang", "th"], "left_semi").mapInArrow(
        tidy(cut), StructType(list(narrow.schema)).add("windows", "binary")).dropDuplicates(["doc_id", "lang", "th"]).collect()
    return sorted(rows, key=lambda r: (r.doc_id, r.lang, r.windows))


def fit_rows(rows: list, size: int = WINDOW_BYTES) -> Model | None:
    if not rows:
        return None
    langs = sorted({r.lang for r in rows})
    wins = [np.frombuffer(r.windows, np.uint8).reshape(-1, size) for r in rows]
    y = np.repeat([langs.index(r.lang) for r in rows], [len(w) for w in wins])
    model = train(np.concatenate(wins), y, langs)
    model.pairs = pair_shares(np.concatenate(wins), y, len(langs))
    return model


def fit(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG, size: int = WINDOW_BYTES) -> Model | None:
    """Train on ``sample_rows``. None if no row has a language and a letter."""
    return fit_rows(sample_rows(labelled, docs_per_lang), size)


def learn(labelled: DataFrame) -> tuple[Model | None, list[float], list[float]]:
    """The model of all rows of ``(doc_id, text, lang)`` with a language and a letter (None,
    if there are none), whole texts, and per length class the limits of score and byte pair
    fit that all but about ``LIMIT_SHARE`` of these rows reach when a model judges them that has not
    seen them. The rows are halved by a hash of their text, each half is judged by
    the model of the other. Languages of one half only set no limits, and there are
    none (minus infinity) if fewer than two languages are left."""
    rows = labelled.where(F.col("lang").isNotNull() & has_letter()).select(
        "lang", "text", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"), F.xxhash64("doc_id", "text").alias("order"),
        F.ceil(F.octet_length("text") / F.lit(WINDOW_BYTES)).alias("windows"))
    size = {(r.lang, r.half): r.n for r in rows.groupBy("lang", "half").agg(F.sum("windows").alias("n")).collect()}
    none = [float("-inf")] * len(LENGTH_CLASSES)
    if not size:
        return None, none, none
    langs = {2: sorted({lang for lang, _ in size})} | {h: sorted(lang for lang, half in size if half == h) for h in (0, 1)}
    both = sorted(set(langs[0]) & set(langs[1]))
    if len(both) < 2:
        langs = {2: langs[2]}
    total = {m: sum(n for (_, half), n in size.items() if m in (2, half)) for m in langs}
    models = {m: as_model(par, langs[m]) for m, par in train_shards(rows, langs, total).items()}
    pairs = pair_counts(rows)
    for m, model in models.items():
        model.pairs = pair_logs(pairs, langs[m], (0, 1) if m == 2 else (m,))
    if len(both) < 2:
        return models[2], none, none
    least = [F.octet_length("text") > (c - 1) * WINDOW_BYTES for c in LENGTH_CLASSES[1:]]
    kind = sum((x.cast("int") for x in least), F.lit(0)).alias("kind")
    judged = [predict(rows.where((F.col("half") == 1 - h) & F.col("lang").isin(both)).select(kind, "text"),
                      models[h], ["kind"], ("language", "score", "fit")).select("kind", "score", "fit") for h in (0, 1)]
    judged = materialize(judged[0].unionByName(judged[1]), "language_limits")
    return models[2], quantiles_by_kind(judged, "score"), quantiles_by_kind(judged, "fit")


def train_shards(rows: DataFrame, langs: dict[int, list[str]], total: dict[int, int]) -> dict[int, dict]:
    """Parameters of each model in ``langs`` (0 and 1: rows of that half, 2: all rows) from every
    window of its rows.

    Rows are dealt to shards by a hash, about ``SHARD_WINDOWS`` windows each. The first shard trains
    from random parameters; the others go on from what it found, each apart, and their
    parameters, weighted by windows, are averaged. Shards and the order in them depend on
    the rows alone, and sums are of whole numbers, so any cluster finds the same.
    """
    small_batches(rows.sparkSession)
    shards = {m: -(-n // SHARD_WINDOWS) for m, n in total.items()}
    passes = {m: max(1, min(6, -(-PASS_WINDOWS // n))) for m, n in total.items()}
    start = {m: first_parameters(len(k))[0] for m, k in langs.items()}
    count = F.create_map(*[F.lit(x) for m, n in shards.items() for x in (m, n)])
    model = F.explode(F.array(F.col("half"), F.lit(2)) if len(langs) > 1 else F.array(F.lit(2)))
    dealt = rows.select(model.alias("model"), "order", "lang", "text") \
        .withColumn("shard", F.pmod(F.hash("order", F.lit(1)), F.element_at(count, F.col("model"))).cast("int"))
    for first in (True, False):
        many = len(shards) if first else sum(n - 1 for n in shards.values())
        if not many:
            break
        ahead = {m: sum(1 if first else n - 1 for k, n in shards.items() if k < m) - (not first) for m in shards}
        place = F.element_at(F.create_map(*[F.lit(x) for item in ahead.items() for x in item]), F.col("model")) + F.col("shard")
        part = dealt.where((F.col("shard") == 0) == F.lit(first)).repartitionById(many, place) \
            .sortWithinPartitions("model", "shard", "order", "lang").select("model", "shard", "lang", "text")
        found = part.mapInArrow(tidy(_shard_trainer(start, langs, passes, 0.01 if first else SHARD_RATE)),
                                "model int, at int, windows long, value long")
        n = F.col("windows").cast("decimal(18,0)")
        mean = found.groupBy("model", "at").agg((F.sum(n * F.col("value")).cast("double") / F.sum(n).cast("double") / SCALE).alias("value"))
        got = mean.orderBy("model", "at").toArrow()
        which, value = np.asarray(got["model"]), np.asarray(got["value"])
        for m in np.unique(which).tolist():
            start[m] = _unflat(value[which == m], start[m])
    return start


def _views(flat: np.ndarray, like: dict) -> dict:
    ends = np.cumsum([v.size for v in like.values()])[:-1]
    return {n: x.reshape(v.shape) for (n, v), x in zip(like.items(), np.split(flat, ends))}


def _unflat(flat: np.ndarray, like: dict) -> dict:
    return {n: v.astype(np.float32) for n, v in _views(flat, like).items()}


def _shard_trainer(start: dict[int, dict], langs: dict[int, list[str]], passes: dict[int, int], rate: float):
    """Arrow function over ``model, shard, lang, text``, sorted: a row per shard and parameter. Windows
    are held until there are ``2 SHARD_WINDOWS``, so a shard of any size takes little memory."""
    numbers = {m: {lang: i for i, lang in enumerate(k)} for m, k in langs.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, par, rng, held, seen = None, None, None, [], 0

        def step():
            if held:
                win, y = (np.concatenate(x) for x in zip(*held))
                held.clear()
                descend(par, win, y, rng, passes[now[0]], rate=rate)

        def done():
            step()
            flat = np.concatenate([v.ravel() for v in par.values()]).astype(np.float64)
            n = len(flat)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, now[0], np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                                               pa.array(np.full(n, seen)), pa.array(np.rint(flat * SCALE).astype(np.int64))],
                                              names=["model", "at", "windows", "value"])

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                model, shard = part.column(0).to_numpy(), part.column(1).to_numpy()
                cut = np.flatnonzero((np.diff(model) != 0) | (np.diff(shard) != 0)) + 1
                for a, b in zip([0, *cut], [*cut, part.num_rows]):
                    key = int(model[a]), int(shard[a])
                    if key != now:
                        if now:
                            yield done()
                        now, seen, rng = key, 0, np.random.default_rng(key)
                        par = {n: v.copy() for n, v in start[key[0]].items()}
                    y = np.array([numbers[key[0]][x] for x in part.column(2).slice(a, b - a).to_pylist()])
                    for row, win in whole_windows(*column_bytes(part.column(3).slice(a, b - a))):
                        held.append((win, y[row]))
                        seen += len(win)
                        if sum(len(w) for w, _ in held) >= 2 * SHARD_WINDOWS:
                            step()
        if now:
            yield done()
    return run


def whole_windows(buf: np.ndarray, off: np.ndarray, size: int = WINDOW_BYTES,
                  most: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and zero-padded windows of the whole rows of a byte column, ``most`` at a time."""
    per = -(-np.diff(off) // size)
    row = np.repeat(np.arange(len(per)), per)
    at = off[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)) * size
    for a in range(0, len(row), most):
        own = row[a:a + most]
        idx = at[a:a + most, None] + np.arange(size)
        yield own, np.where(idx < off[1:][own][:, None], buf[np.minimum(idx, len(buf) - 1)], 0).astype(np.uint8)


def pair_counts(rows: DataFrame) -> pa.Table:
    """How often each byte follows another in all texts, by language and half."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 22):
                coded = part.column(0).dictionary_encode()
                words, half = coded.dictionary.to_pylist(), part.column(1).to_numpy()
                group = np.asarray(coded.indices) * 2 + half
                for g in np.unique(group):
                    buf, off = column_bytes(part.column(2).filter(pa.array(group == g)))
                    n = np.zeros(65536, np.int64)
                    for a in range(0, len(buf), 1 << 20):
                        x = buf[a:a + (1 << 20) + 1]
                        n += np.bincount(x[:-1].astype(np.int64) * 256 + x[1:], minlength=65536)
                    last = off[1:-1]                 # not from one row to the next
                    last = last[(last > 0) & (last < len(buf))]
                    np.subtract.at(n, buf[last - 1].astype(np.int64) * 256 + buf[last], 1)
                    pair = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([words[g // 2]] * len(pair), pa.string()), pa.array(np.full(len(pair), g % 2, np.int32)),
                         pa.array(pair.astype(np.int32)), pa.array(n[pair])], names=["lang", "half", "pair", "n"])

    return rows.select("lang", "half", "text").mapInArrow(tidy(run), "lang string, half int, pair int, n long") \
        .groupBy("lang", "half", "pair").agg(F.sum("n").alias("n")).toArrow()


def pair_logs(counts: pa.Table, langs: list[str], halves: tuple[int, ...], extra: float = 0.02) -> np.ndarray:
    """Log share of each byte after each other, per language, from ``pair_counts`` of the halves."""
    half, pair, n = (np.asarray(counts[c]) for c in ("half", "pair", "n"))
    coded = counts["lang"].combine_chunks().dictionary_encode()
    number = np.array([langs.index(x) if x in langs else -1 for x in coded.dictionary.to_pylist()], np.int64)
    lang = number[np.asarray(coded.indices)]
    out = np.full((len(langs), 256, 256), extra)
    ok = np.isin(half, halves) & (lang >= 0)
    np.add.at(out.reshape(len(langs), 65536), (lang[ok], pair[ok]), n[ok])
    return np.log(out / out.sum(axis=2, keepdims=True)).reshape(len(langs), 65536).astype(np.float32)


def quantiles_by_kind(judged: DataFrame, name: str, share: float = LIMIT_SHARE) -> list[float]:
    """Per length class the value of ``name`` that all but ``share`` of its rows reach (rounded down to
    parts of ``FINE``). A class of few rows takes the limits of the next shorter one with enough
    (none, if there is none). Three counts of ever finer steps find the row's place, no sort."""
    value = F.floor(F.col(name) * FINE).cast("long")
    place, rank = {}, {}
    for shift in (26, 13, 0):
        step = F.shiftright(value, shift)
        known = F.lit(True) if not place else F.coalesce(F.element_at(
            F.create_map(*[F.lit(x) for kind, at in place.items() for x in (kind, at)]), F.col("kind")) == F.shiftright(value, shift + 13), F.lit(False))
        steps = judged.where(known).groupBy("kind", step.alias("at")).count().orderBy("kind", "at").collect()
        if not rank:
            many = {}
            for r in steps:
                many[r.kind] = many.get(r.kind, 0) + r["count"]
            rank = {kind: int((n - 1) * share) for kind, n in many.items() if n >= LIMIT_ROWS}
            if not rank:
                break
        place = {}
        for r in steps:
            if r.kind in rank and r.kind not in place:
                if rank[r.kind] < r["count"]:
                    place[r.kind] = r["at"]
                else:
                    rank[r.kind] -= r["count"]
    out = []
    for c in range(len(LENGTH_CLASSES)):
        out.append(place[c] / FINE if c in place else out[-1] if out else float("-inf"))
    return out


def by_length(limits: list[float], text: str = "text", size: int = WINDOW_BYTES) -> "F.Column":
    """The limit of a text's length class."""
    out = F.lit(limits[0])
    for least, limit in list(zip(LENGTH_CLASSES, limits))[1:]:
        out = F.when(F.octet_length(text) > (least - 1) * size, limit).otherwise(out)
    return out


def has_letter() -> "F.Column":
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None, keep: list[str],
            names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus the predicted language, its score and, if a third
    name is given, the fit of its byte pairs, under ``names`` (they replace kept columns
    so named); only ``text`` reaches the network."""
    small_batches(docs.sparkSession)
    keep = [c for c in keep if c not in names]
    row = F.struct(F.lit(0).alias("__row"), *[F.col(f"`{c}`") for c in keep if c != "text"]).alias("row")
    src = docs.select(row, "text", has_letter().alias("known"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    back = "text" in keep
    schema = StructType([src.schema["row"]] + [src.schema["text"]] * back
                        + [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
                        + [StructField("fit", DoubleType())] * (len(names) > 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        tables = m.tables() if m else None
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                n, known = part.num_rows, np.asarray(part.column(2).to_numpy(zero_copy_only=False), bool)
                lang, score, fits = [UND] * n, np.zeros(n), np.zeros(n)
                if m is not None:
                    buf, off = column_bytes(part.column(1))
                    p = m.predict(buf, off, tables)
                    top = p.argmax(axis=1)
                    if len(names) > 2:
                        fits = pair_fit(m.pairs, buf, off, top)
                    score = np.where(known, np.minimum(p[np.arange(n), top], 1.0), 0.0)
                    lang = [m.langs[t] if k else UND for t, k in zip(top, known)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[part.column(1)] * back, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     *[pa.array(fits)] * (len(names) > 2)], names=schema.names)

    return src.mapInArrow(tidy(run), schema).select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in keep],
                                              *[F.col(c).alias(n) for c, n in zip(("lang_pred", "score", "fit"), names)])


def held_out(doc_id: str = "doc_id") -> "F.Column":
    """Fold of a row: crc32 of the id's text modulo 4 is 2 (null ids are never learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))
