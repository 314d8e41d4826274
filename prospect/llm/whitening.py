"""Embedding whitening by a bit-sliced scatter matrix.

An entry c becomes the integer f = floor(scale * c). In blocks of rows every dimension is shifted to start at
zero and cut into bit planes; a plane's bits across the rows are packed into 64-bit words. The number of
ones that two planes share (AND, then popcount), weighted by the powers of two of both, adds up to the
exact sum of products of two dimensions; the shifts are added back in integers. Tasks report their sums as
30-bit limbs that Spark adds, so the scatter of all rows is exact whatever their number. It is centred
in integers (n * sum f_i f_j - S_i * S_j), and only the result, one row and column a dimension, is turned
into doubles for the eigenvectors. Rows are never collected; the driver holds dimensions x dimensions.

Rows whose vector is null or holds a null or non-finite entry are left out, and so are vectors whose
length isn't the most frequent one (of equally frequent ones the longest) as well as empty vectors.
Entries beyond 2**62 / scale are taken as that. Repeated rows, repeated and null ids are rows of their own.
Components whose eigenvalue is not above 1e-11 of the largest can't be whitened and aren't returned: an
empty table, one row, or equal rows give no rows. Equal eigenvalues may come in either order, the same for
all rows. A deviation beyond a long is null. Columns other than the two named play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.llm.common import col, ship, table

SCALE = 64
MOST = 32
#: Rows whose bit planes are formed at a time, and rows that are given out at a time.
BLOCK = 8192
OUT_BLOCK = 2048
LEAST_SHARE = 1e-11
TOP = 2.0 ** 62
LIMB = 30


# ---- one block, in numpy ---------------------------------------------------------------------

def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * c) as int64, within +/- 2**62."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * float(scale)), -TOP, TOP).astype(np.int64)


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(planes, dim, bit)`` of a (rows, dims) uint64 block: the planes that hold a one, as words."""
    rows, dims = shifted.shape
    words = -(-rows // 64)
    planes, dim, bit = [], [], []
    for b in range(int(shifted.max(initial=0)).bit_length()):
        ones = (shifted >> np.uint64(b) & np.uint64(1)).astype(bool)
        some = np.flatnonzero(ones.any(axis=0))
        packed = np.zeros((len(some), words * 8), np.uint8)
        packed[:, :-(-rows // 8)] = np.packbits(ones[:, some], axis=0).T
        planes.append(packed.view(np.uint64))
        dim.append(some)
        bit.append(np.full(len(some), b))
    if not planes:
        return np.zeros((0, words), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(planes), np.concatenate(dim), np.concatenate(bit)


def shared_ones(planes: np.ndarray) -> np.ndarray:
    """How many ones each two planes share."""
    m = len(planes)
    out = np.zeros((m, m), np.int64)
    for p in range(m):
        out[p, p:] = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
    return out + np.triu(out, 1).T


def block_sums(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(S, C)``: exact sums and sums of products of the columns, as Python integers."""
    rows, dims = f.shape
    low = f.min(axis=0)
    planes, dim, bit = bit_planes((f - low).astype(np.uint64))
    ones = shared_ones(planes)
    small = not len(bit) or 2 * (int(bit.max()) + 1) + rows.bit_length() < 62
    weight = np.zeros((len(bit), dims), np.int64 if small else object)
    weight[np.arange(len(bit)), dim] = 1 << bit if small else [1 << b for b in bit.tolist()]
    if small:
        s, c = np.diag(ones) @ weight, weight.T @ (ones @ weight)
    else:
        s, c = np.diag(ones).astype(object) @ weight, weight.T @ (ones.astype(object) @ weight)
    s, c, low = s.astype(object), c.astype(object), low.astype(object)
    return s + rows * low, c + np.outer(low, s) + np.outer(s, low) + rows * np.outer(low, low)


def limbs(value: int) -> list[int]:
    """``value`` as digits of ``LIMB`` bits, the last one signed."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*out, value]


def _rows(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the fit rows of a batch and their vectors as doubles."""
    v = batch.column("v")
    at = np.flatnonzero(np.nan_to_num(v.value_lengths().to_numpy(zero_copy_only=False), nan=-1) == dim)
    x = v.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dim)
    good = np.isfinite(x).all(axis=1)
    return at[good], x[good]


# ---- the operator ----------------------------------------------------------------------------

class Whitening(NamedTuple):
    dim: int
    n: int
    sums: list[int]
    #: Eigenvalues of the covariance of the whole numbers, falling, the unit vectors as columns, the trace.
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int


def fit_whitening(df: DataFrame, vec_col: str, scale: int = SCALE, most: int = MOST) -> Whitening | None:
    """Components of all fit vectors; None where there are none."""
    ship(df.sparkSession)
    rows = df.select(col(vec_col).alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    lengths = rows.where("size(v) > 0").where(~bad).groupBy(F.size("v").alias("dim")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    if found is None:
        return None
    dim = found["dim"]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, c = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            f = whole(_rows(batch, dim)[1], scale)
            for i in range(0, len(f), BLOCK):
                bs, bc = block_sums(f[i:i + BLOCK])
                s, c = s + bs, c + bc
            n += len(f)
        if not n:
            return
        sums = [(-1, -1, n), *[(i, -1, int(x)) for i, x in enumerate(s)],
                *[(i, j, int(c[i, j])) for i in range(dim) for j in range(i, dim)]]
        out = [(i, j, k, x) for i, j, v in sums for k, x in enumerate(limbs(v))]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(),) * 3 + (pa.int64(),), strict=True)],
                                         ["i", "j", "limb", "total"])

    totals: dict[tuple[int, int], int] = {}
    for r in (rows.mapInArrow(scatter, "i int, j int, limb int, total long")
              .groupBy("i", "j", "limb").agg(F.sum("total").alias("total")).collect()):
        totals[r["i"], r["j"]] = totals.get((r["i"], r["j"]), 0) + (r["total"] << LIMB * r["limb"])
    n = totals[-1, -1]
    sums = [totals[i, -1] for i in range(dim)]
    v = np.empty((dim, dim))
    trace = 0
    for i in range(dim):
        for j in range(i, dim):
            centred = n * totals[i, j] - sums[i] * sums[j]
            v[i, j] = v[j, i] = centred / n ** 2
            trace += centred * (i == j)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = int((values[:most] > max(0.0, values[0] * LEAST_SHARE)).sum())
    if not keep:
        return None
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)
    return Whitening(dim, n, sums, values[:keep].copy(), vectors[:, :keep].copy(), trace / n ** 2, scale)


def _centred(x: np.ndarray, m: Whitening) -> tuple[np.ndarray, bool]:
    """n * f - S, in int64 where squares and their sum fit, otherwise as Python integers."""
    f = whole(x, m.scale)
    most = m.n * int(np.abs(f).max(initial=0)) + max(map(abs, m.sums))
    small = m.dim * most * most < 1 << 63
    kind = np.int64 if small else object
    return f.astype(kind) * m.n - np.array(m.sums, dtype=kind), small


def _white(y: np.ndarray, m: Whitening) -> np.ndarray:
    return (y / m.n).astype(np.float64) @ (m.vectors / np.sqrt(m.values))


def identity_error(df: DataFrame, vec_col: str, m: Whitening) -> float:
    """The largest entry of the whitened rows' covariance less the identity, measured on all rows."""
    ship(df.sparkSession)
    k = len(m.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            x = _rows(batch, m.dim)[1]
            for i in range(0, len(x), BLOCK):
                w = _white(_centred(x[i:i + BLOCK], m)[0], m)
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "total"])

    got = np.zeros((k + 1, k))
    for r in (df.select(col(vec_col).alias("v")).mapInArrow(moments, "i int, j int, total double")
              .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()):
        got[r["i"], r["j"]] = r["total"]
    mean = got[k] / m.n
    return float(np.abs(got[:k] / m.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str, vec_col: str, m: Whitening) -> DataFrame:
    """``(id_col, component, deviation, whitened, explained)`` of every fit row and component."""
    ship(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), col(vec_col).alias("v"))
    id_type = rows.schema["id"].dataType.simpleString()
    k = len(m.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, share = np.arange(1, k + 1, dtype=np.int32), m.values / m.trace
        for batch in batches:
            at, x = _rows(batch, m.dim)
            for i in range(0, len(at), OUT_BLOCK):
                y, small = _centred(x[i:i + OUT_BLOCK], m)
                rows = len(y)
                if small:
                    deviation = pa.array((y * y).sum(axis=1))
                else:
                    deviation = pa.array([d if (d := int(sum(v * v for v in row))) < 1 << 63 else None for row in y], pa.int64())
                again = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at[i:i + OUT_BLOCK])).take(again), pa.array(np.tile(number, rows)),
                     deviation.take(again), pa.array(_white(y, m).ravel()), pa.array(np.tile(share, rows))],
                    ["id", "component", "deviation", "whitened", "explained"])

    return rows.mapInArrow(project, f"id {id_type}, component int, deviation long, whitened double, explained double").withColumnRenamed("id", id_col)


def op12_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    m = fit_whitening(rows, "embedding")
    if m is None:
        return rows.select("vec_id").where("false").selectExpr(
            "vec_id", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error")
    out = whiten(rows, "vec_id", "embedding", m)
    return out.select("vec_id", "component", F.lit(m.n).cast("long").alias("n"), "deviation", "whitened", "explained",
                      F.lit(identity_error(rows, "embedding", m)).alias("identity_error"))
