"""Embedding whitening from a distributed QR and a bidiagonal qd solver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.bidiagonal import EPS, principal_directions
from shopmarts.llm.storage import written

SCALE, ZERO = 1024, 100_000
MOST = 1 << 31          # larger entries count as this, so sums and products fit a long
FAN = 64                # partial results that one task merges
ROWS = 4096


@dataclass
class Whitening:
    """What whitening needs of the fit list: its rows, per-dimension sums, the
    components as columns, their eigenvalues and the covariance's trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.zeros_like(self.values)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact."""
        return x * self.n - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of projections over the root of the eigenvalue; zero along a direction
        without any spread."""
        root = np.sqrt(self.values)
        spread = root > 8 * self.dims * EPS * root.max(initial=0)
        return (self.centred(x) / self.n @ self.components) * (spread / np.where(spread, root, 1))


def _vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return embeddings.select(F.col(id_col).alias("id"),
                             F.col(vector_col).cast("array<double>").alias("v"))


def _longs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``places, x`` for each vector length in a batch: the rows whose vector has
    finite entries only, and their entries as longs."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    for d in np.unique(size[size > 0]):
        at = np.flatnonzero(size == d)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)   # null: NaN
        v = flat.astype(np.float64).reshape(-1, d)
        good = np.isfinite(v).all(axis=1)
        if good.any():
            x = np.clip(np.floor(v[good] * SCALE), -MOST, MOST)
            yield at[good], x.astype(np.int64) + ZERO


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums = {}, {}
    for b in batches:
        for _, x in _longs(b.column(0)):
            d = x.shape[1]
            n[d] = n.get(d, 0) + len(x)
            sums[d] = sums.get(d, 0) + x.sum(axis=0)
    for d in n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)),
             pa.array(np.full(d, n[d], np.int64)), pa.array(sums[d])], ["dims", "at", "n", "s"])


def _merged(parts: DataFrame, merge: Callable[[list[bytes]], bytes], label: str) -> bytes | None:
    """One result from rows of ``part, data``, merged in groups of ``FAN`` by level, so
    that neither a task nor the driver ever holds more than that many."""
    def level(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        return pa.table([pa.array([group["to"][0].as_py()], pa.int64()),
                         pa.array([merge(group["data"].to_pylist())], pa.binary())], ["part", "data"])

    parts = written(parts, label)
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:
        to = F.floor(F.col("part") / FAN).alias("to")
        parts = written(parts.select("part", "data", to).groupBy("to").applyInArrow(
            level, "part long, data binary"), label)
    last = parts.first()
    return last["data"] if last else None


def _part(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                       pa.array([data], pa.binary())], ["part", "data"])


def _triangle(rows: list[np.ndarray], d: int) -> np.ndarray:
    """R of the rows one above the other, with ``d`` rows."""
    r = np.linalg.qr(np.vstack(rows), mode="r")
    return r if len(r) == d else np.vstack([r, np.zeros((d - len(r), d))])


def fit(embeddings: DataFrame, components: int = 8, id_col: str = "vec_id",
        vector_col: str = "embedding") -> Whitening | None:
    """Principal directions of all vectors; None where there is no vector.

    Vectors that are null, empty or hold null or non-finite entries take no part.
    All others have one length, the commonest (of several, the longest); other
    lengths take no part either.  Entries become ``floor(1024 * c) + 100000``.
    Each task reduces its rows, centred exactly, block by block to a triangular
    factor; factors are merged in a tree, and the driver gets the last one, of the
    dimensions' square.  Its bidiagonal form, dqds values and twisted vectors are
    the covariance's, without the covariance ever being formed.
    """
    vectors = _vectors(embeddings, id_col, vector_col).select("v")
    by_dim = written(
        vectors.mapInArrow(_sums, "dims int, at int, n long, s long").groupBy("dims", "at").agg(
            F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")), "whitening_sums")
    top = by_dim.filter("at = 0").orderBy(F.desc("n"), F.desc("dims")).first()
    if top is None:
        return None
    d, n = top["dims"], top["n"]
    rows = by_dim.filter(F.col("dims") == d).orderBy("at").collect()     # one row a dimension
    model = Whitening(n, np.array([int(r["s"]) for r in rows], np.int64), np.zeros((d, 0)),
                      np.zeros(0), 0.0)

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for b in batches:
            for _, x in _longs(b.column(0)):
                for s in range(0, len(x) if x.shape[1] == d else 0, ROWS):
                    r = _triangle([r, model.centred(x[s:s + ROWS]) / n], d)
        if len(r):
            yield _part(r.tobytes())

    def merge(parts: list[bytes]) -> bytes:
        return _triangle([np.frombuffer(p).reshape(d, d) for p in parts], d).tobytes()

    r = _merged(vectors.mapInArrow(factor, "part long, data binary"), merge, "whitening_qr")
    singular, model.components = principal_directions(np.frombuffer(r).reshape(d, d), components)
    values = singular ** 2 / n
    model.values, model.trace = values[:model.components.shape[1]], float(values.sum())
    return model


def identity_error(embeddings: DataFrame, model: Whitening, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity.

    Means and centred products are made in each task and merged pairwise, so they
    are centred before they are multiplied."""
    k = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            for _, x in _longs(b.column(0)):
                for s in range(0, len(x) if x.shape[1] == model.dims else 0, ROWS):
                    w = model.whitened(x[s:s + ROWS])
                    mean = w.mean(axis=0)
                    held = _add(held, (float(len(w)), mean, (w - mean).T @ (w - mean)))
        if held:
            yield _part(np.concatenate([[held[0]], held[1], held[2].ravel()]).tobytes())

    def merge(parts: list[bytes]) -> bytes:
        held = None
        for p in parts:
            v = np.frombuffer(p)
            held = _add(held, (v[0], v[1:k + 1], v[k + 1:].reshape(k, k)))
        return np.concatenate([[held[0]], held[1], held[2].ravel()]).tobytes()

    v = np.frombuffer(_merged(_vectors(embeddings, id_col, vector_col).select("v").mapInArrow(
        moments, "part long, data binary"), merge, "whitening_moments"))
    return float(np.abs(v[k + 1:].reshape(k, k) / v[0] - np.eye(k)).max())


def _add(a: tuple | None, b: tuple) -> tuple:
    """Count, mean and centred products of two sets of rows together."""
    if a is None:
        return b
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def _deviation(c: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null where one does not fit a long."""
    if not c.size or float(np.abs(c).max()) ** 2 * c.shape[1] < 2.0 ** 62:
        return (c * c).sum(axis=1).tolist()
    sums = (sum(x * x for x in row) for row in c.tolist())
    return [s if s < 1 << 63 else None for s in sums]


def whiten(embeddings: DataFrame, model: Whitening | None, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``id_col, component, deviation, whitened, explained`` for every vector that took
    part in the fit (see ``fit``) and every component, numbered from 1.

    ``deviation`` is the exact sum over dimensions of ``(n * x - sums)**2``, null
    where that does not fit a long.  Along a direction in which all vectors agree
    ``whitened`` is zero.  Without a model the result is empty.  Repeated rows
    and null ids come back as they are; other columns are not read.
    """
    rows = _vectors(embeddings, id_col, vector_col)
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = 0 if model is None else len(model.values)
        for b in batches if k else ():
            for at, x in _longs(b.column(1)):
                for s in range(0, len(x) if x.shape[1] == model.dims else 0, ROWS):
                    w = model.whitened(x[s:s + ROWS])
                    n = len(w)
                    off = np.repeat(_array(_deviation(model.centred(x[s:s + ROWS]))), k)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(np.repeat(at[s:s + n], k))),
                         pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                         pa.array(off, pa.int64()), pa.array(w.ravel()),
                         pa.array(np.tile(model.explained(), n))],
                        ["id", "component", "deviation", "whitened", "explained"])

    out = rows.mapInArrow(run, f"id {kind}, component int, deviation long, whitened double, "
                               "explained double")
    return out.withColumnRenamed("id", id_col)


def _array(values: list) -> np.ndarray:
    return np.array(values, object if None in values else np.int64)
