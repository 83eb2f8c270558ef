"""Quality classifier by co-training of a content view and a metadata view."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.rows import column
from shopmarts.llm.storage import written
from shopmarts.llm.whitening import _merged, _part
from shopmarts.llm.wordblocks import hashed_blocks

N_PAIRS = 256       # hash buckets of byte pairs
CHUNK = 256         # rows whose features are in memory at once
N_SHAPE = 8
N_TEXT = 128 + N_PAIRS + N_SHAPE
N_SOURCE, N_LANG, N_LENGTH = 64, 16, 32
N_META = N_SOURCE + N_LANG + N_LENGTH
N_CODES = N_SOURCE * N_LANG * N_LENGTH
BINS = 2560         # steps of the log-odds in which the pool is counted
META = ("source", "lang", "n_chars")


def text_features(texts: list[str | None]) -> np.ndarray:
    """Rows of content features: byte and byte-pair shares (square roots), and
    shape: length, word length, distinct words, repeated lines, capitals."""
    n = len(texts)
    ones, pairs = np.zeros((n, 128)), np.zeros((n, N_PAIRS))
    size, upper, n_words, word_bytes = (np.zeros(n) for _ in range(4))
    for piece_text, word_text, w in hashed_blocks(texts, lower=False):
        d = w.data
        # every byte of a text, but not the breaks that stand between texts
        own = np.ones(len(d), bool)
        own[w.piece_ends[:-1] - 1] = False
        of = np.repeat(piece_text, np.diff(np.concatenate([[0], w.piece_ends])))[:len(d)]
        low = np.minimum(d, 127).astype(np.int64)
        ones += np.bincount(of[own] * 128 + low[own], minlength=n * 128).reshape(n, 128)
        pair = (d[:-1].astype(np.int64) * 31 + d[1:]) % N_PAIRS
        both = own[:-1] & own[1:]
        pairs += np.bincount(of[:-1][both] * N_PAIRS + pair[both], minlength=n * N_PAIRS).reshape(n, N_PAIRS)
        size += np.bincount(of[own], minlength=n)
        upper += np.bincount(of, weights=(d >= 65) & (d <= 90), minlength=n)
        n_words += np.bincount(word_text, minlength=n)
        word_bytes += np.bincount(word_text, weights=w.end - w.start, minlength=n)
    lines = np.array([_repeated_lines(t) for t in texts]).reshape(n, 1) if n else np.zeros((0, 1))
    some = np.maximum(size, 1)[:, None]
    mean = word_bytes / np.maximum(n_words, 1)
    shape = np.column_stack([np.log1p(size) / 10, np.log1p(n_words) / 10, np.log1p(mean) / 2,
                             np.minimum(mean, 30) ** 2 / 200, upper / some[:, 0], lines[:, 0],
                             size == 0, np.ones(n)])
    return np.hstack([3 * np.sqrt(ones / some), 3 * np.sqrt(pairs / some), shape]).astype(np.float32)


def _repeated_lines(text: str | None) -> float:
    lines = [x for x in (text or "").split("\n") if x]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


def meta_codes(source: list, lang: list, n_chars: list) -> np.ndarray:
    """One number a row for its hashed source, hashed language and length band.
    A null has a slot of its own in each."""
    out = np.empty(len(source), np.int32)
    for k, (s, g, c) in enumerate(zip(source, lang, n_chars)):
        s = 0 if s is None else 1 + zlib.crc32(str(s).encode()) % (N_SOURCE - 1)
        g = 0 if g is None else 1 + zlib.crc32(str(g).encode()) % (N_LANG - 1)
        band = 0 if c is None or c < 0 else 1 + min(N_LENGTH - 2, int(2 * math.log2(1 + c)) // 2)
        out[k] = (s * N_LANG + g) * N_LENGTH + band
    return out


def meta_features(codes: np.ndarray) -> np.ndarray:
    """Rows of one-hot features of the three parts of a code."""
    out, rows = np.zeros((len(codes), N_META), np.float32), np.arange(len(codes))
    out[rows, codes // (N_LANG * N_LENGTH)] = 1
    out[rows, N_SOURCE + codes // N_LENGTH % N_LANG] = 1
    out[rows, N_SOURCE + N_LANG + codes % N_LENGTH] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _ridge(size: int, l2: float) -> np.ndarray:
    return np.append(np.full(size - 1, l2), 1e-3)


def _sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the weighted logistic loss over rows ending in a 1."""
    p = _sigmoid(x @ w)
    return x.T @ (weight * (p - y)), (x.T * (weight * np.maximum(p * (1 - p), 1e-4))) @ x


def _moved(w: np.ndarray, g: np.ndarray, h: np.ndarray, ridge: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``w`` after a Newton step, no row of ``x`` moving by more than 5 nats."""
    step = np.linalg.solve(h + np.diag(ridge), g + ridge * w)
    return w - step * min(1.0, 5 / max(1e-9, np.abs(x @ step).max()))


def _ones(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))]).astype(np.float64)


def _fit(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 12,
         weight: np.ndarray | None = None) -> np.ndarray:
    """L2-regularised logistic regression by damped Newton steps."""
    x, weight = _ones(x), np.ones(len(x)) if weight is None else weight
    w, ridge = np.zeros(x.shape[1]), _ridge(x.shape[1], l2)
    for _ in range(steps):
        w = _moved(w, *_sums(x, y, weight, w), ridge, x)
    return w


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class CoTrained:
    """Both views' weights and the calibration that combines them."""

    text: np.ndarray | None
    meta: np.ndarray | None
    blend: np.ndarray
    prior: float

    def scores(self, texts: list, meta: tuple[list, list, list]) -> tuple[np.ndarray, ...]:
        """Probability of good quality by content, by metadata (each view's own) and,
        calibrated, by both.  Features are made for ``CHUNK`` rows at a time."""
        n = len(texts)
        if self.text is None:
            p = np.full(n, self.prior)
            return p, p, p
        t, m = np.empty(n), np.empty(n)
        for s in range(0, n, CHUNK):
            some = slice(s, s + CHUNK)
            t[some] = _logit(text_features(texts[some]), self.text)
            m[some] = _logit(meta_features(meta_codes(*(c[some] for c in meta))), self.meta)
        both = _sigmoid(self.blend[0] * t + self.blend[1] * m + self.blend[2])
        return _sigmoid(t), _sigmoid(m), both

    def kept(self, score: np.ndarray, threshold: float) -> np.ndarray:
        """Scores that reach the threshold; all where nothing was learned."""
        return (score >= threshold) | (self.text is None)


def _bins(z: np.ndarray) -> np.ndarray:
    """Log-odds in ``BINS`` steps of equal width, from -20 to 20."""
    return np.clip(np.floor((z + 20) * (BINS / 40)), 0, BINS - 1).astype(np.int64)


def _cuts(counts: np.ndarray, share: float, confident: float) -> tuple[float, float]:
    """Log-odds from which, and up to which, a row is surely good or bad: those of the
    most confident ``share`` at either end, ties included, not below ``confident``."""
    sure, most = math.log(confident / (1 - confident)), share * counts.sum()
    top = BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), most))
    low = int(np.searchsorted(np.cumsum(counts), most))
    return max(top * 40 / BINS - 20, sure), min((low + 1) * 40 / BINS - 20, -sure)


def _given(z: np.ndarray, cuts: tuple[float, float]) -> np.ndarray:
    """1, 0 or, where the view is not sure, -1."""
    return np.where(z >= cuts[0], 1, np.where(z <= cuts[1], 0, -1))


def _first(labels: list[np.ndarray]) -> np.ndarray:
    """Each row's earliest label that is not -1."""
    out = labels[0]
    for later in labels[1:]:
        out = np.where(out >= 0, out, later)
    return out


class Pool:
    """The unlabelled rows (``code, t``), all of them, as sums made in Spark.

    Only results of a fixed size reach the driver: counts by metadata code, by step
    of the log-odds, and one gradient with its Hessian.
    """

    def __init__(self, rows: DataFrame):
        self.rows = rows
        found = rows.groupBy("code").count().collect()         # at most N_CODES
        self.counts = np.zeros(N_CODES)
        for r in found:
            self.counts[r["code"]] = r["count"]

    def _each(self, run: Callable[[np.ndarray, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from run((b.column(0).to_numpy()[s:s + 1024], unpacked(b.column(1).slice(s, 1024)))
                           for b in it for s in range(0, b.num_rows, 1024))
        return self.rows.select("code", "t").mapInArrow(batches, schema)

    def steps(self, w: np.ndarray) -> np.ndarray:
        """How many rows the text view puts in each step of the log-odds."""
        def run(blocks):
            n = sum((np.bincount(_bins(_logit(x, w)), minlength=BINS) for _, x in blocks),
                    np.zeros(BINS, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(n)], ["bin", "n"])
        rows = self._each(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
        out = np.zeros(BINS)
        for r in rows:
            out[r["bin"]] = r["n"]
        return out

    def by_code(self, history: list[tuple[np.ndarray, tuple[float, float]]]) -> np.ndarray:
        """Rows by code and the label that the text view gave them first."""
        def run(blocks):
            n = np.zeros((N_CODES, 2), np.int64)
            for code, x in blocks:
                y = _first([_given(_logit(x, w), cuts) for w, cuts in history])
                np.add.at(n, (code[y >= 0], y[y >= 0]), 1)
            at = np.argwhere(n)
            yield pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(n[n > 0])],
                                             ["code", "y", "n"])
        out = np.zeros((N_CODES, 2))
        for r in (self._each(run, "code long, y long, n long").groupBy("code", "y")
                  .agg(F.sum("n").alias("n")).collect()):
            out[r["code"], r["y"]] = r["n"]
        return out

    def sums(self, w: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the text view over the rows whose code has a
        ``label`` of 0 or 1, each class with its ``weight``; merged in a tree."""
        size = len(w)
        upper = np.triu_indices(size)

        def packed(g: np.ndarray, h: np.ndarray) -> bytes:
            return g.astype(np.float64).tobytes() + h.astype(np.float32).tobytes()

        def opened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
            return (np.frombuffer(data, np.float64, size),
                    np.frombuffer(data, np.float32, offset=8 * size).astype(np.float64))

        def run(blocks):
            g, h = np.zeros(size), np.zeros((size, size))
            for code, x in blocks:
                y = label[code]
                if (y >= 0).any():
                    more = _sums(_ones(x[y >= 0]), y[y >= 0], weight[y[y >= 0]], w)
                    g, h = g + more[0], h + more[1]
            yield _part(packed(g, h[upper]))

        def merge(parts: list[bytes]) -> bytes:
            g, h = zip(*map(opened, parts))
            return packed(sum(g), sum(h))

        g, flat = opened(_merged(self._each(run, "part long, data binary"), merge, "quality_sums"))
        h = np.zeros((size, size))
        h[upper] = flat
        return g, h + np.triu(h, 1).T


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, pool: Pool, rounds: int = 4,
             share: float = 0.08, confident: float = 0.97, steps: int = 2) -> CoTrained:
    """Fit on labelled rows (``text`` features, ``meta`` codes, ``label`` 0 or 1) and
    the whole unlabelled pool.

    A fifth of the labelled rows is set aside.  In each round either view scores
    the pool and hands its most confident rows (``share`` of the pool per class in
    the first round, twice that in the second, and so on; none below ``confident``)
    as pseudo-labels to the *other* view, which refits on them and the true labels.
    A row keeps its first pseudo-label.  A class's pseudo-labels together weigh at
    most as much as its true ones, so the exchange works alike at every size.
    The metadata view refits on counts by code, the text view by ``steps`` Newton
    steps whose sums over the pool are made in Spark.  The set-aside rows then
    calibrate: a logistic blend of the two views' log-odds.  A class of fewer than
    5 rows serves for both.  Without a row of either class there is nothing to
    learn: every score is the labelled share of good rows (0.5 without labels),
    and all documents are kept.
    """
    prior = float(label.mean()) if len(label) else 0.5
    if not ((label == 1).any() and (label == 0).any()):
        return CoTrained(None, None, np.zeros(3), prior)
    aside, twice = np.zeros(len(label), bool), np.zeros(len(label), bool)
    for c in (0, 1):                       # the aside fold holds both classes
        rows = np.flatnonzero(label == c)
        (aside if len(rows) >= 5 else twice)[rows[::5] if len(rows) >= 5 else rows] = True
    x, m, y = _ones(text[~aside]), meta_features(meta[~aside]), label[~aside]
    true = np.bincount(y, minlength=2)
    every = meta_features(np.arange(N_CODES))
    w_text, w_meta = _fit(x[:, :-1], y), _fit(m, y)
    by_text, by_meta = [], []              # what each view has handed over, by round
    for r in range(rounds if pool.counts.any() else 0):
        z = _logit(every, w_meta)
        steps_meta = np.bincount(_bins(z), weights=pool.counts, minlength=BINS)
        by_meta.append(_given(z, _cuts(steps_meta, share * (r + 1), confident)))
        by_text.append((w_text, _cuts(pool.steps(w_text), share * (r + 1), confident)))
        got = pool.by_code(by_text)
        light = np.minimum(1, true / np.maximum(got.sum(axis=0), 1))
        code, c = np.nonzero(got)
        w_meta = _fit(np.vstack([m, every[code]]), np.append(y, c),
                      weight=np.append(np.ones(len(y)), got[code, c] * light[c]))
        to_text = _first(by_meta)
        sizes = np.array([pool.counts[to_text == c].sum() for c in (0, 1)])
        light = np.minimum(1, true / np.maximum(sizes, 1))
        for _ in range(steps):
            g, h = _sums(x, y, np.ones(len(y)), w_text)
            if sizes.any():
                more = pool.sums(w_text, to_text, light)
                g, h = g + more[0], h + more[1]
            w_text = _moved(w_text, g, h, _ridge(len(w_text), 1.0), x)
    held = np.flatnonzero(aside | twice)
    z = np.column_stack([_logit(text[held], w_text), _logit(meta_features(meta[held]), w_meta)])
    return CoTrained(w_text, w_meta, _fit(z, label[held], l2=0.5), prior)


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns that are read; a missing metadata column counts as null."""
    pick = [F.col(id_col), F.col(text_col).cast("string").alias("_text")]
    for c, kind in zip(META, ("string", "string", "long")):
        pick.append((F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(f"_{c}"))
    return docs.select(*pick)


def unpacked(t: pa.Array) -> np.ndarray:
    """Rows of features from their bytes."""
    return np.frombuffer(b"".join(t.to_pylist()), np.float16).reshape(-1, N_TEXT).astype(np.float64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in range(0, b.num_rows, CHUNK):
            c = b.slice(s, CHUNK)
            t = text_features(c.column(1).to_pylist()).astype(np.float16)
            code = meta_codes(*(c.column(k).to_pylist() for k in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays(
                [c.column(0), pa.array([x.tobytes() for x in t], pa.binary()), pa.array(code)],
                ["id", "t", "code"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                label_col: str = "quality", max_labelled: int = 5000,
                text_col: str = "text", rounds: int = 4) -> CoTrained:
    """Co-train on at most ``max_labelled`` labelled documents, chosen by a hash of
    their id (alike on every run), and on all documents without a label.

    Features are made once for each document, in one pass over the texts, and
    written; only the chosen labelled rows' features reach the driver.  Null labels
    and ids with contradicting labels are not used; documents with a null id have
    no label and belong to the pool, repeated rows as often as they occur.
    """
    one = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
           .groupBy(id_col).agg(F.min(label_col).alias("_y"), F.max(label_col).alias("_z"))
           .filter("_y = _z").select(F.col(id_col).alias("id"), F.col("_y").cast("int")))
    ids = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    # a stated number of rows, so it is safe to broadcast
    known = ids.join(one, "id").orderBy(F.xxhash64("id", F.lit(17)), "id").limit(max_labelled)
    marks = (labels.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
             .join(F.broadcast(known), "id", "left").select("id", F.coalesce("_y", F.lit(-2)).alias("y")))
    x = _inputs(docs, id_col, text_col)
    kind = x.schema[0].dataType.simpleString()
    rows = written(x.mapInArrow(_features, f"id {kind}, t binary, code int")
                   .join(marks, "id", "left").withColumn("y", F.coalesce("y", F.lit(-1))),
                   "quality_features")
    found = rows.filter("y >= 0").toPandas()
    found["k"] = [zlib.crc32(str(i).encode()) for i in found["id"]]
    found = found.sort_values(["k", "id", "t", "code"]).drop_duplicates("id")
    return co_train(unpacked(pa.array(found["t"], pa.binary())), found["code"].to_numpy(int),
                    found["y"].to_numpy(int), Pool(rows.filter("y = -1")), rounds)


def quality_scores(docs: DataFrame, model: CoTrained, threshold: float = 0.5,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, p_text, p_meta, score, kept`` of every row of ``docs``.

    One pass without a shuffle.  Null and empty texts are scored like any other
    (all shares zero); null or missing metadata has a feature of its own;
    repeated rows come back as often; an empty table gives an empty result.
    """
    x = _inputs(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.scores(b.column(1).to_pylist(),
                             tuple(b.column(k).to_pylist() for k in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(v.astype(np.float64)) for v in p),
                 pa.array(model.kept(p[2], threshold))], ["id", "p_text", "p_meta", "score", "kept"])

    kind = x.schema[0].dataType.simpleString()
    out = x.mapInArrow(run, f"id {kind}, p_text double, p_meta double, score double, kept boolean")
    return out.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: CoTrained, threshold: float = 0.5,
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns.

    Only the text and the metadata go to Python; the other columns stay where they
    are, whatever they are called.  Null and empty texts, null ids and repeated
    rows are judged like any other; an empty table stays empty.
    """
    text, *meta = (column(c).cast(kind) if c in docs.columns else F.lit(None).cast(kind)
                   for c, kind in zip((text_col, *META), ("string", "string", "string", "long")))

    @F.arrow_udf("boolean")
    def kept(t: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        p = model.scores(t.to_pylist(), (source.to_pylist(), lang.to_pylist(), n_chars.to_pylist()))
        return pa.array(model.kept(p[2], threshold))

    return docs.filter(kept(text, *meta))
