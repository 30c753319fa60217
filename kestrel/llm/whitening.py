"""Embedding whitening from exact integer cross-products by bit-sliced scatter.

Entries become integers. A first pass finds each dimension's least and largest integer and sum. In the second
every task shifts each dimension by its least value, packs the shifted numbers' bit planes across rows into
64-bit words, and gets the cross-products as popcounts of planes ANDed with one another, weighted by powers
of two. Spark adds the exact numbers of all tasks up; they are centred as integers, and only the covariance,
whose size is the square of the dimension, goes to the driver for its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries whose planes are packed at a time.
CELLS = 1 << 20
#: Integers beyond which an entry is cut off: 2^62, so that a long holds it.
_FAR = float(1 << 62)


def integers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows whose vector is whole, and their integers, one row each."""
    lists = batch.column(batch.schema.get_field_index("v"))
    size, values = np.diff(lists.offsets.to_numpy()), lists.values
    first = int(lists.offsets[0].as_py()) if len(lists) else 0
    values = values.slice(first, int(size.sum())).cast(pa.float64())
    number = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lists)), size)
    good = lists.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(owner, ~np.isfinite(number), len(lists)) == 0)
    good &= size > 0
    found = np.flatnonzero(good)
    widths = np.unique(size[found])
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {widths[:5].tolist()}")
    x = number[good[owner]].reshape(len(found), int(widths[0]) if len(widths) else 0)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(64 * x), -_FAR, _FAR - 2**21)
    return found, scaled.astype(np.int64) + 1_000_000


def _vectors(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.select(F.col(vector_col).alias("v"))


def _wide(values: Iterator[int]) -> pa.Array:
    return pa.array([str(v) for v in values], pa.string())


@dataclass
class Fit:
    """n vectors of integers with sums; components in rows, eigenvalues, and the share of each in the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @property
    def scale(self) -> np.ndarray:
        """1 / sqrt(e); 0 where the data have no extent."""
        return np.divide(1.0, np.sqrt(self.values), out=np.zeros(len(self.values)), where=self.values > 0)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as longs where these hold it, else as Python's integers."""
        reach = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, self.sums), default=0)
        kind = np.int64 if reach < 2**62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def whiten(self, deviations: np.ndarray) -> np.ndarray:
        """x - S/n on the components, over the roots of the eigenvalues."""
        return (deviations.astype(np.float64) / self.n) @ self.components.T * self.scale


def extents(vectors: DataFrame, vector_col: str = "embedding") -> list[tuple[int, int, int, int]]:
    """(number of vectors, least, largest, sum) of each dimension's integers; an empty list without vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, x = integers(batch)
            if len(found):
                d = x.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, len(found)), pa.int64()), pa.array(x.min(axis=0)),
                     pa.array(x.max(axis=0)), _wide(sum(map(int, c)) for c in x.T) if np.abs(x).max() > 2**40 else _wide(map(int, x.sum(axis=0)))],
                    names=["dim", "n", "least", "most", "total"])

    parts = _vectors(vectors, vector_col).mapInArrow(run, "dim int, n long, least long, most long, total string")
    rows = (parts.groupBy("dim").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                                     F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect())
    if len({r["n"] for r in rows}) > 1:
        raise ValueError("vectors of different lengths")
    return [(r["n"], r["least"], r["most"], int(r["total"])) for r in rows]


def planes(shifted: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bit planes of all dimensions, low bit first, each packed across rows into 64-bit words."""
    pad = -len(shifted) % 64
    rows = np.concatenate([shifted, np.zeros((pad, shifted.shape[1]), dtype=shifted.dtype)])
    packed = [np.packbits(((rows[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
              for d, many in enumerate(bits) for b in range(many)]
    return np.stack(packed).view(np.uint64) if packed else np.empty((0, len(rows) // 64), dtype=np.uint64)


def scatter(x: np.ndarray, least: list[int], bits: list[int]) -> list[list[int]]:
    """The sums of products of the shifted dimensions over the rows of ``x``, exact."""
    shifted = (x - np.array(least, dtype=np.int64)).view(np.uint64)
    sliced, d = planes(shifted, bits), len(bits)
    edge = np.concatenate([[0], np.cumsum(bits)]).astype(int)
    out = [[0] * d for _ in range(d)]
    weight = np.concatenate([np.arange(b) for b in bits]) if sum(bits) else np.empty(0, dtype=int)
    most = max(bits, default=0)
    exact = np.int64 if 2 * most + len(x).bit_length() < 62 else object
    power = np.array([1 << k for k in range(2 * most + 1)], dtype=object).astype(exact)
    for i in range(d):
        lo, hi = edge[i], edge[i + 1]
        total = np.zeros(len(sliced) - lo, dtype=exact)
        for p in range(lo, hi):  # the planes of this dimension against those from it on
            count = np.bitwise_count(sliced[lo:] & sliced[p]).sum(axis=1, dtype=np.int64)
            total += count.astype(exact) * power[weight[p] + weight[lo:]]
        for j in range(i, d):
            out[i][j] = out[j][i] = int(total[edge[j] - lo:edge[j + 1] - lo].sum()) if edge[j + 1] > edge[j] else 0
    return out


def covariance(vectors: DataFrame, vector_col: str = "embedding") -> tuple[list[tuple[int, int, int, int]], np.ndarray]:
    """``extents`` and the covariance of the integers: exact sums, centred as integers, divided once."""
    shape = extents(vectors, vector_col)
    d = len(shape)
    least, bits = [s[1] for s in shape], [int(s[2] - s[1]).bit_length() for s in shape]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size, block = [[0] * d for _ in range(d)], [], 0, max(64, CELLS // d)

        def add() -> None:
            found = scatter(np.concatenate(held), least, bits)
            for row, new in zip(total, found):
                row[:] = [a + b for a, b in zip(row, new)]

        for batch in batches:
            _, x = integers(batch)
            for at in range(0, len(x), block):
                held.append(x[at:at + block])
                size += len(held[-1])
                if size >= block:
                    add()
                    held, size = [], 0
        if size:
            add()
        flat = [v for i, row in enumerate(total) for v in row[i:]]
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _wide(flat)], names=["i", "j", "total"])

    v = np.zeros((d, d))
    if d:
        n = shape[0][0]
        shifted = [s[3] - n * s[1] for s in shape]
        parts = _vectors(vectors, vector_col).mapInArrow(run, "i int, j int, total string")
        for r in parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
            i, j = r["i"], r["j"]
            v[i, j] = v[j, i] = (n * int(r["total"]) - shifted[i] * shifted[j]) / (n * n)
    return shape, v


def fit(vectors: DataFrame, vector_col: str = "embedding", most: int = 32) -> Fit:
    """The components of the vectors' integers, ``most`` at most, by falling eigenvalue."""
    shape, v = covariance(vectors, vector_col)
    if not shape:
        return Fit(0, [], np.empty((0, 0)), np.empty(0), np.empty(0))
    e, vec = np.linalg.eigh(v)
    e, vec = e[::-1], vec[:, ::-1]
    trace = float(np.trace(v))
    e = np.where(e > max(trace, 0) * len(e) * np.finfo(float).eps, e, 0.0)[:most]
    share = e / trace if trace > 0 else np.zeros(len(e))
    return Fit(shape[0][0], [s[3] for s in shape], np.ascontiguousarray(vec.T[:most]), e, share)


def identity_error(vectors: DataFrame, how: Fit, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity.

    Each batch gives its sums and its products centred by its own mean; Spark adds up what the batches' means
    add to them. A component without extent is left out: its whitened values are all 0.
    """
    k = len(how.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, inner = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            found, x = integers(batch)
            if not len(found):
                continue
            w = how.whiten(how.deviations(x))
            m = w.mean(axis=0)
            step, both = m - mean, n + len(w)
            inner += (w - m).T @ (w - m) + np.outer(step, step) * (n * len(w) / both)
            mean, n = mean + step * (len(w) / both), both
        if n:
            i, j = np.indices((k, k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array((inner + n * np.outer(mean, mean)).ravel()),
                 pa.array((n * np.broadcast_to(mean[:, None], (k, k))).ravel())], names=["i", "j", "product", "total"])

    if not how.n or not k:
        return 0.0
    parts = _vectors(vectors, vector_col).mapInArrow(run, "i int, j int, product double, total double")
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in parts.groupBy("i", "j").agg(F.sum("product").alias("product"), F.sum("total").alias("total")).collect():
        cov[r["i"], r["j"]] = r["product"] / how.n
        mean[r["i"]] = r["total"] / how.n
    off = np.abs(cov - np.outer(mean, mean) - np.eye(k))
    some = how.values > 0
    return float(off[np.ix_(some, some)].max(initial=0.0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    A vector that is null or empty, or holds a null or an entry that is not finite, is left out of the fit and
    of the result. The others must have one length, else a ValueError says so. ``deviation`` is decimal, for at
    large n a long doesn't hold it. Where a component has no extent (one vector, or equal ones) its whitened
    values are 0. Entries from 2^56 on count as that. Repeated rows count as often as they come, null ids stay
    as they are, and other columns play no part. Without vectors the result is empty.
    """
    how = fit(vectors, vector_col, most)
    error = identity_error(vectors, how, vector_col)
    k = len(how.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                found, x = integers(batch)
                if not len(found):
                    continue
                away = how.deviations(x)
                whitened = how.whiten(away)
                far = float(np.abs(away).max(initial=0)) ** 2 * away.shape[1] >= 2**62
                total = [sum(int(a) ** 2 for a in row) for row in away] if far else (away * away).sum(axis=1)
                row = pa.array(np.repeat(np.arange(len(found)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(found)).take(row), pa.array(np.tile(np.arange(1, k + 1), len(found)), pa.int32()),
                     _wide(total).take(row), pa.array(whitened.ravel()), pa.array(np.tile(how.explained, len(found)))],
                    names=["id", "component", "deviation", "whitened", "explained"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, component int, deviation string, whitened double, explained double")
    return out.select("id", "component", F.lit(how.n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
                      "whitened", "explained", F.lit(error).alias("identity_error"))
