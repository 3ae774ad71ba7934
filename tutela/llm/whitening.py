"""Whitening of embeddings by exact covariances from bit-sliced scatter.

Entries are whole numbers (``scaled``). Less the smallest one of their dimension they are small and
not negative; bit plane k of a dimension is bit k of its entries across a block of rows, packed
into 64-bit words. The sum of products of two dimensions is the sum over their planes of
2**(k + l) * popcount(plane k AND plane l): exact, with no multiplication of entries. Sums and
cross products are whole numbers up to the centred n * Q - S S', which only then becomes floating
for the eigenvectors. What reaches the driver are tables of the square of the dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.session import keep

SCALE = 64
SHIFT = 1_000_000
MOST = 16             # components
BLOCK_ROWS = 1 << 15  # rows whose planes are held at once
LIMIT = 1 << 44       # entries beyond it in absolute value have no exact place
RANK = 1e-12          # of the largest eigenvalue: smaller ones are zero


def scaled(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries as floor(SCALE * c) + SHIFT, a row for each usable vector, and which are usable:
    of ``width`` entries, none null, not finite or out of reach."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    holes = np.zeros(len(flat) + 1, np.int64)
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        product = np.floor(values * SCALE)
        holes[1:] = np.cumsum(~(np.abs(product) < LIMIT))
    ends = np.cumsum(np.maximum(sizes, 0))
    begin = ends - np.maximum(sizes, 0)
    good = (sizes == width) & (holes[ends] == holes[begin])
    at = begin[good][:, None] + np.arange(width)
    return product[at].astype(np.int64) + SHIFT, good


def bit_planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of the planes of non-negative columns that hold a set bit."""
    words, dimension, bit = [], [], []
    room = -len(x) % 64
    for k in range(int(x.max(initial=0)).bit_length()):
        plane = (x >> k & 1).astype(bool)
        some = np.flatnonzero(plane.any(axis=0))
        packed = np.packbits(np.pad(plane[:, some], ((0, room), (0, 0))), axis=0)
        words.append(np.ascontiguousarray(packed.T).view(np.uint64))
        dimension.append(some)
        bit.append(np.full(len(some), k))
    if not words:
        return np.zeros((0, 0), np.uint64), *(np.zeros(0, np.int64) for _ in range(2))
    return np.concatenate(words), np.concatenate(dimension), np.concatenate(bit)


def cross_products(x: np.ndarray) -> np.ndarray:
    """Q[i, j] = sum over rows of x_i * x_j, as Python integers (upper triangle, i <= j)."""
    width = x.shape[1]
    planes, dimension, bit = bit_planes(x)
    total = np.zeros((width, width), object)
    for p in range(len(planes)):
        # each unordered pair of planes once; two planes of one dimension count twice
        counts = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
        i, j = np.minimum(dimension[p], dimension[p:]), np.maximum(dimension[p], dimension[p:])
        twice = (dimension[p:] == dimension[p]) & (np.arange(len(counts)) > 0)
        for power in np.unique(bit[p:]):
            some = bit[p:] == power
            part = np.zeros((width, width), np.int64)
            np.add.at(part, (i[some], j[some]), counts[some] << twice[some])
            at = np.nonzero(part)
            total[at] += part[at].astype(object) * (1 << int(bit[p] + power))
    return total


_INT, _BIG = pa.int64(), pa.decimal128(38, 0)


def _packed(width: int, least: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = scaled(batch.column("embedding"), width)
            rows = (x - least).astype(kind)
            size = width * rows.dtype.itemsize
            raw = rows.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(pa.array(good)),
                 pa.array([raw[a:a + size] for a in range(0, len(raw), size)], pa.binary())],
                names=["vec_id", "x"])
    return run


def _unpack(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.int64)


def _ranges(width: int):
    """Least and largest entry of each dimension of a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(width, np.iinfo(np.int64).max), np.full(width, np.iinfo(np.int64).min)
        for batch in batches:
            x = scaled(batch.column("embedding"), width)[0]
            if len(x):
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if (low <= high).all():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array(low), pa.array(high)],
                names=["dimension", "low", "high"])
    return run


def _scatter(width: int, kind: str):
    """Sums (j is -1) and cross products of a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(width, object), np.zeros((width, width), object)
        held, waiting = [], 0

        def take() -> None:
            nonlocal n, sums, total, held, waiting
            x = np.concatenate(held) if held else np.zeros((0, width), np.int64)
            for at in range(0, len(x), BLOCK_ROWS):
                some = x[at:at + BLOCK_ROWS]
                n, sums = n + len(some), sums + some.sum(axis=0).astype(object)
                total = total + cross_products(some)
            held, waiting = [], 0

        for batch in batches:
            held.append(_unpack(batch.column("x"), width, kind))
            waiting += batch.num_rows
            if waiting >= BLOCK_ROWS:
                take()
        take()
        if n:
            i, j = np.triu_indices(width)
            values = [n, *sums, *total[i, j]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(width), *i.tolist()], _INT),
                 pa.array([-1] * (width + 1) + j.tolist(), _INT),
                 pa.array([Decimal(int(v)) for v in values], _BIG)], names=["i", "j", "value"])
    return run


class Whitening:
    """What whitening vectors takes: n, sums and eigenvectors of the fit list."""

    def __init__(self, n: int, sums: list[int], products: dict[tuple[int, int], int], most: int):
        width = len(sums)
        centred = [[n * products[min(i, j), max(i, j)] - sums[i] * sums[j]
                    for j in range(width)] for i in range(width)]
        self.n, self.sums = n, np.array(sums, np.int64)
        self.covariance = np.array([[value / (n * n) for value in row] for row in centred])
        values, vectors = np.linalg.eigh(self.covariance)
        order = np.argsort(-values, kind="stable")[:most]
        self.values, self.vectors = values[order], vectors[:, order]
        trace = sum(centred[i][i] for i in range(width)) / (n * n)
        self.explained = self.values / trace if trace else np.full(len(order), np.nan)
        # a dimension less than the rows span has no variance to divide by
        self.root = np.sqrt(np.where(self.values > RANK * max(values.max(), 0), self.values,
                                     np.nan))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S."""
        return self.n * x - self.sums

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x).astype(np.float64) / self.n @ self.vectors / self.root

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n * x - S; None where it is no long."""
        d = self.centred(x)
        if float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2.0 ** 62:
            return (d * d).sum(axis=1).tolist()
        big = d.astype(object)
        return [v if v < 1 << 63 else None for v in (big * big).sum(axis=1)]


def _moments(fit: Whitening, kind: str):
    """Sums and cross products of a task's whitened rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.values)
        sums, total = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = fit.project(_unpack(batch.column("x"), len(fit.sums), kind))
            sums, total = sums + w.sum(axis=0), total + w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1] * k + i.tolist(), _INT), pa.array([*range(k), *j.tolist()], _INT),
             pa.array([*sums, *total[i, j]], pa.float64())], names=["i", "j", "value"])
    return run


def identity_error(fit: Whitening, moments: dict[tuple[int, int], float]) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over the
    components that have a variance."""
    mean = {j: v / fit.n for (i, j), v in moments.items() if i < 0}
    off = [abs(v / fit.n - mean[i] * mean[j] - (i == j)) for (i, j), v in moments.items()
           if i >= 0 and not np.isnan(fit.root[[i, j]]).any()]
    return max(off, default=None)


_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")


def _whitened(fit: Whitening, error: float | None, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.values)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _unpack(part.column("x"), len(fit.sums), kind)
                rows = np.repeat(np.arange(len(x)), k)
                far = pa.array(fit.deviations(x), _INT).take(pa.array(rows))
                white = fit.project(x).ravel()
                share = np.tile(fit.explained, len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(rows)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(rows), fit.n)), far,
                     pa.array(white, mask=np.isnan(white)), pa.array(share, mask=np.isnan(share)),
                     pa.array([error] * len(rows), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])
    return run


def whiten(vectors: DataFrame, most: int = MOST) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) for each usable
    row of (vec_id, embedding, ...) and each of its first ``most`` components.

    Rows whose vector is null, or holds null or non-finite entries or ones beyond 2**44 / 64, have
    no place; nor have vectors of another length than most rows have (of equally frequent lengths
    the longer one). The fit list is every distinct vector of whole numbers once, so repeated rows
    do not weigh; each of them comes back. Components without variance (all vectors alike,
    fewer vectors than dimensions) have null ``whitened``; ``explained`` is null if there is no
    variance at all, and a ``deviation`` that is no long is null. A null vec_id comes back as
    such. An empty table, or one without a usable row, gives none. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    usual = rows.filter(F.size("embedding") > 0).groupBy(F.size("embedding").alias("width")).agg(
        F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    none = spark.createDataFrame([], _OUT)
    if usual is None:
        return none
    width = usual["width"]
    found = rows.mapInArrow(_ranges(width), "dimension long, low long, high long") \
        .groupBy("dimension").agg(F.min("low").alias("low"), F.max("high").alias("high")) \
        .orderBy("dimension").collect()  # a row for each dimension
    if not found:
        return none
    least = np.array([r["low"] for r in found])
    span = max(r["high"] - r["low"] for r in found)
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if span <= np.iinfo(k).max)
    packed = keep(rows.mapInArrow(_packed(width, least, kind), "vec_id long, x binary"), "packed")
    fit_list = keep(packed.select("x").distinct(), "fit-list")
    sums = fit_list.mapInArrow(_scatter(width, kind), "i long, j long, value decimal(38,0)") \
        .groupBy("i", "j").agg(F.sum("value").alias("value")).collect()  # dimension squared
    exact = {(r["i"], r["j"]): int(r["value"]) for r in sums}
    fit = Whitening(exact.pop((-1, -1)), [exact.pop((i, -1)) for i in range(width)], exact, most)
    moments = fit_list.mapInArrow(_moments(fit, kind), "i long, j long, value double") \
        .groupBy("i", "j").agg(F.sum("value").alias("value")).collect()  # components squared
    error = identity_error(fit, {(r["i"], r["j"]): r["value"] for r in moments})
    return packed.mapInArrow(_whitened(fit, error, kind), _OUT)
