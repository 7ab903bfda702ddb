"""Whitening of embeddings, with eigenvectors refined from float32 to double precision.

Every entry ``c`` becomes the whole number ``floor(64 * c) + 1000000``.  Counts, sums and
the products of centred vectors are whole numbers, added up exactly in every partition
and then in a few steps of wider and wider groups, so the covariance does not depend
on how the rows lie.  Vectors are centred at the rounded mean before they are multiplied;
the rest of the centring is a fraction below one that is taken out exactly.

The eigenvectors of the covariance start as those of its float32 copy.  Iterations of
matrix products in extended precision correct them (Ogita and Aishima 2018): with
``R = I - X'X`` and ``S = X'AX`` the correction of a pair of columns is
``(S_ij + l_j R_ij) / (l_j - l_i)``, and the error is squared each time.  Pairs whose
eigenvalues are closer than what the residuals can tell apart are only made orthogonal;
such clusters are solved by themselves, as a small problem shifted to its centre and
scaled to its own spread, again in float32, and the iterations go on from there.

Only matrices of the dimension of the vectors reach the driver.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries, or
entries of ``2 ** 55`` and more, are left out; so are vectors of another length than
the most frequent one (of equal ones, the longest).  Repeated rows count and are
returned each.  Components without variance (constant or dependent entries, a single
vector) have the value 0 and no part in the identity error.  ``deviation`` is null where
it leaves the range of a long.  An empty table gives an empty result.  Further
columns stay, except that those with the name of an added one (in any case) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, output_names, prepare, quoted

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries from here on have no exact arithmetic.
LARGEST = 1 << 55
#: Sums travel as three numbers of this many bits.
LIMB = 48
ROUNDS = 40
WIDE = np.longdouble


@dataclass
class Whitening:
    """A fitted model: ``n`` vectors, the rounded mean, the sums beyond it, and the
    components in columns with their eigenvalues, of a covariance with this trace."""

    n: int
    mean: np.ndarray
    rest: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers, projected on the components, over their deviations."""
        centred = (x - self.mean) - np.array([float(WIDE(r) / WIDE(self.n)) for r in self.rest])
        return centred @ self.axes()

    def axes(self) -> np.ndarray:
        some = self.values > 0
        return (np.where(some, self.vectors, 0) / np.sqrt(np.where(some, self.values, 1))).astype(np.float64)


# --- exact sums over partitions -------------------------------------------------------


def to_limbs(whole: np.ndarray) -> np.ndarray:
    mask = (1 << LIMB) - 1
    return np.array([[v & mask, v >> LIMB & mask, v >> 2 * LIMB] for v in map(int, whole.ravel())], np.int64)


def from_limbs(limbs: np.ndarray) -> list[int]:
    return [a + (b << LIMB) + (c << 2 * LIMB) for a, b, c in limbs.reshape(-1, 3).tolist()]


def exact_product(x: np.ndarray) -> np.ndarray:
    """``x'x`` of whole numbers: in float64 where that is exact."""
    if not x.size:
        return np.zeros((x.shape[1],) * 2, object)
    top = int(np.abs(x).max())
    if top * top * len(x) < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T @ y


def exact_sum(x: np.ndarray) -> np.ndarray:
    if x.size and int(np.abs(x).max()) * len(x) < 1 << 62:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def added_up(vectors: DataFrame, size: int, make) -> tuple[int, list[int]]:
    """Rows and the sum of the whole numbers that ``make`` gives for matrices of rows."""
    schema = "n bigint, limbs array<bigint>"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                own = make(matrix(batch.column(0), size))
                total = own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([to_limbs(total).ravel()], pa.list_(pa.int64()))], names=["n", "limbs"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            n += sum(batch.column(0).to_pylist())
            for limbs in batch.column(1):
                own = np.array(from_limbs(limbs.values.to_numpy()), object)
                total = own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([to_limbs(total).ravel()], pa.list_(pa.int64()))], names=["n", "limbs"])

    sums = vectors.mapInArrow(parts, schema)
    for width in (256, 16, 1):
        sums = sums.repartition(width).mapInArrow(add, schema)
    row = sums.first()
    return (row.n, from_limbs(np.array(row.limbs, np.int64))) if row else (0, [])


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Whole numbers of a column of lists of doubles, one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(-1, size)


# --- eigenvectors ---------------------------------------------------------------------


def start_vectors(a: np.ndarray) -> np.ndarray:
    """Eigenvectors of a symmetric matrix, scaled to its own size, in float32."""
    top = np.abs(a).max() if a.size else 0
    if not top:
        return np.eye(len(a), dtype=WIDE)
    x = np.linalg.eigh((a / top).astype(np.float32))[1].astype(WIDE)
    for _ in range(3):  # orthogonal beyond float32, too
        x = x + x @ (np.eye(len(a), dtype=WIDE) - x.T @ x) / 2
    return x


def eigen(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and eigenvectors in columns."""
    size = len(a)
    a = a.astype(WIDE)
    scale = np.abs(a).max() if size else WIDE(0)
    if not scale:
        return np.zeros(size, WIDE), np.eye(size, dtype=WIDE)
    a = a / scale
    x = start_vectors(a)
    noise = 8 * size * np.finfo(WIDE).eps
    left, still = np.inf, 0
    for _ in range(rounds):
        r = np.eye(size, dtype=WIDE) - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        bound = 2 * (np.linalg.norm((s - np.diag(values)).astype(np.float64)) + np.linalg.norm(r.astype(np.float64))) + noise
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > bound
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        np.fill_diagonal(step, np.diag(r) / 2)
        x = x + x @ step
        by = np.argsort(-values)
        x, values = x[:, by], values[by]
        groups = np.split(np.arange(size), np.flatnonzero(values[:-1] - values[1:] > bound) + 1)
        near = [g for g in groups if len(g) > 1]
        done = float(np.abs(step).max())
        if not near and done < np.finfo(np.float64).eps / 64:
            break
        # what no longer halves cannot be told apart in this arithmetic
        still = still + 1 if float(bound) + done > left / 2 else 0
        left = min(left, float(bound) + done)
        if still == 3:
            break
        for g in near:  # a problem of its own, shifted to its centre
            own = x[:, g].T @ (a @ x[:, g])
            own = (own + own.T) / 2 - np.eye(len(g), dtype=WIDE) * values[g].mean()
            x[:, g] = x[:, g] @ start_vectors(own)
    x = x + x @ (np.eye(size, dtype=WIDE) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    by = np.argsort(-values, kind="stable")
    return values[by] * scale, x[:, by] / np.sqrt(np.einsum("ij,ij->j", x, x))[by]


# --- model and result -----------------------------------------------------------------


def usable(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows that count, packed in ``row``, with their vector as ``v``, and its length."""
    v = F.col(quoted(vector)).cast("array<double>")
    rows = vectors.select(F.struct("*").alias("row"), v.alias("v"))
    rows = rows.where("size(v) > 0").where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float(LARGEST))))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max(F.struct("n", "size")).alias("top")).first().top
    size = top.size if top else 0
    return rows.where(F.size("v") == size), size


def fit(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """The model of the vectors ``v`` of ``rows``, in two passes of exact sums."""
    plain = rows.select("v")
    n, sums = added_up(plain, size, exact_sum)
    mean = [s // n for s in sums] if n else []
    rest = [s - n * m for s, m in zip(sums, mean)]
    centre = np.array(mean, np.int64)
    _, products = added_up(plain, size, lambda x: exact_product(x - centre))
    square = n * n
    cov = np.zeros((size, size), WIDE)
    for i in range(size):
        for j in range(size):
            whole, part = divmod(n * products[i * size + j] - rest[i] * rest[j], square)
            cov[i, j] = WIDE(whole) + WIDE(part) / WIDE(square)
    values, vectors = eigen(cov)
    floor = values[0] * size * np.finfo(np.float64).eps if size else 0
    values = np.where(values > floor, values, 0)[:components]
    trace = np.trace(cov)
    explained = (values / trace if trace else values * 0).astype(np.float64)
    return Whitening(n, centre, rest, vectors[:, :components], values, explained)


def identity_error(rows: DataFrame, size: int, model: Whitening) -> float:
    """The largest entry by which the covariance of all whitened vectors misses the identity."""
    some = np.flatnonzero(np.asarray(model.values > 0))
    kind = "limbs array<double>"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(some), len(some)))
        for batch in batches:
            z = model.whiten(matrix(batch.column(0), size))[:, some]
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["limbs"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(some) ** 2)
        for batch in batches:
            for limbs in batch.column(0):
                total += limbs.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["limbs"])

    if not len(some):
        return 0.0
    sums = rows.select("v").mapInArrow(parts, kind)
    for width in (256, 16, 1):
        sums = sums.repartition(width).mapInArrow(add, kind)
    cov = np.array(sums.first().limbs).reshape(len(some), len(some)) / model.n
    return float(np.abs(cov - np.eye(len(some))).max())


def whitened(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The rows of ``vectors`` that count, with ``n``, ``deviation``, ``whitened`` and
    ``explained`` (one entry for each component) and ``identity_error``."""
    prepare(vectors.sparkSession)
    rows, size = usable(vectors, vector)
    names = ["n", "deviation", "whitened", "explained", "identity_error"]
    if not size:
        none = rows.select("row", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"), F.col("v").alias("whitened"), F.col("v").alias("explained"), F.lit(0.0).alias("identity_error"))
        return output_names(none, vectors, names)
    model = fit(rows, size, components)
    error = identity_error(rows, size, model)
    share = model.explained.tolist()

    def make():
        rest, n = np.array(model.rest, np.int64), model.n

        def work(column):
            x = matrix(column, size)
            away = x - model.mean
            top = n * (int(np.abs(away).max()) + 1) if len(x) else 0
            if top * top * size < 1 << 63:
                deviation = ((n * away - rest) ** 2).sum(axis=1).tolist()
            else:
                exact = ((n * away.astype(object) - np.array(model.rest, object)) ** 2).sum(axis=1).tolist()
                deviation = [d if d < 1 << 63 else None for d in exact]
            return [deviation, model.whiten(x).tolist()]

        return work

    done = add_columns(rows, "v", "deviation bigint, whitened array<double>", make)
    done = done.select(
        "row", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.lit(share).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error")
    )
    return output_names(done, vectors, names)
