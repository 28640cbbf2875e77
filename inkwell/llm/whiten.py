"""Whitening of embeddings: a covariance in double-double, and a divide-and-conquer eigen-solver.

Vectors become whole numbers, each distinct one counts once. Sums are exact; centred outer products are split without error into a
high and a low part (``two_sum``, ``two_prod``), added up pair by pair in each task, and the tasks' parts are merged
in further tasks. Only sums of the vectors' dimension come to the driver, which
solves the eigenproblem: Householder's reduction to a tridiagonal matrix, which is torn in halves whose solutions
are put together by the roots of the secular equation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch
from inkwell.llm.words import give_back

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
#: An entry is at most so large in x, beside the shift; a larger one is cut to it. Products of vectors worked on at once. Tasks that merge the others' sums.
LARGEST, PRODUCTS, MERGERS = 1 << 40, 1 << 18, 64
SPLIT = float((1 << 27) + 1)
EPS = np.finfo(np.float64).eps
SUMS = "n long, sums array<decimal(38,0)>"
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
PARTS = "n long, high array<double>, low array<double>"
PARTS_ARROW = pa.schema([("n", pa.int64()), ("high", pa.list_(pa.float64())), ("low", pa.list_(pa.float64()))])


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a + b, rounded, and what rounding lost."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def quick_two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``two_sum``, where |a| >= |b|."""
    s = a + b
    return s, b - (s - a)


def _halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = SPLIT * a
    high = t - (t - a)
    return high, a - high


def two_prod(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a * b, rounded, and what rounding lost."""
    p = a * b
    (ah, al), (bh, bl) = _halves(a), _halves(b)
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def dd_add(ah: np.ndarray, al: np.ndarray, bh: np.ndarray, bl: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, e = two_sum(ah, bh)
    t, f = two_sum(al, bl)
    s, e = quick_two_sum(s, e + t)
    return quick_two_sum(s, e + f)


def dd_mul(ah: np.ndarray, al: np.ndarray, bh: np.ndarray, bl: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p, e = two_prod(ah, bh)
    return quick_two_sum(p, e + (ah * bl + al * bh))


def dd_total(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the first axis, by halves."""
    while len(high) > 1:
        half = len(high) // 2
        h, l = dd_add(high[:half], low[:half], high[half : 2 * half], low[half : 2 * half])  # noqa: E741
        high, low = (np.concatenate([h, high[2 * half :]]), np.concatenate([l, low[2 * half :]]))
    return high[0], low[0]


def outer_sums(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The upper triangle of the summed outer products of rows given in two parts."""
    i, j = np.triu_indices(high.shape[1])
    total = np.zeros(len(i)), np.zeros(len(i))
    step = max(1, PRODUCTS // max(len(i), 1))
    for at in range(0, len(high), step):
        h, l = high[at : at + step], low[at : at + step]  # noqa: E741
        total = dd_add(*total, *dd_total(*dd_mul(h[:, i], l[:, i], h[:, j], l[:, j])))
    return total


@dataclass
class Centre:
    """The mean of the fit list: n, exact sums, and sums / n in two parts."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        whole = [divmod(s, self.n) for s in self.sums]
        self.high = np.array([float(q) for q, _ in whole])
        rest = np.array([r / self.n for _, r in whole])
        self.high, self.low = two_sum(self.high, rest)

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - mean, in two parts."""
        s, e = two_sum(x.astype(np.float64), -self.high)
        return quick_two_sum(s, e - self.low)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - sum)^2, exact; null where no long holds it."""
        rough = (self.of(x)[0].astype(np.float64) ** 2).sum(1) * float(self.n) ** 2
        if not x.size or rough.max() < 2.0**60 and self.n * int(np.abs(x).max()) < 2**61:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


# Eigen-solver


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: diagonal d, subdiagonal e and orthogonal q with q^T a q tridiagonal."""
    a, m = a.copy(), len(a)
    q = np.eye(m)
    for k in range(m - 2):
        v = a[k + 1 :, k].copy()
        if not (norm := np.linalg.norm(v[1:])):
            continue
        v[0] += np.copysign(np.hypot(v[0], norm), v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho * sum(z_i^2 / (d_i - x)), rho > 0, d rising: for each the pole it is nearest to, and its distance from that pole.

    A root lies in each gap between poles and one beyond the last. Halving the gap (from the nearer pole on, so that the
    distance keeps all its digits) ends when the interval holds no further number.
    """
    m, w = len(d), rho * z * z
    ends = np.append(d[1:], d[-1] + w.sum())
    middle = (d + ends) / 2
    at_middle = 1 + (w[None, :] / (d[None, :] - middle[:, None])).sum(1)
    lower = (at_middle > 0) | (np.arange(m) == m - 1)  # the function rises within a gap: the root lies below the middle
    pole = np.where(lower, np.arange(m), np.minimum(np.arange(m) + 1, m - 1))
    from_pole = d[None, :] - d[pole][:, None]
    lo = np.where(lower, 0.0, -(ends - d) / 2)
    hi = np.where(lower, np.where(np.arange(m) == m - 1, ends - d, (ends - d) / 2), 0.0)
    for _ in range(1100):  # halvings from the largest to the smallest double
        x = (lo + hi) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            f = 1 + (w[None, :] / (from_pole - x[:, None])).sum(1)
        f = np.where(x == 0, np.where(lower, -np.inf, np.inf), f)
        up = f < 0
        stuck = (x == lo) | (x == hi)
        lo, hi = np.where(up & ~stuck, x, lo), np.where(up | stuck, hi, x)
        if stuck.all():
            break
    return pole, np.where(lower, hi, lo)


def joined(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of diag(d) + rho z z^T."""
    if rho < 0:
        values, vectors = joined(-d[::-1], z[::-1], -rho)
        return -values[::-1], vectors[::-1, ::-1]
    order = np.argsort(d, kind="stable")
    d, z = d[order], z[order].copy()
    m = len(d)
    turn = np.eye(m)
    tiny = 8 * EPS * max(np.abs(d).max(), abs(rho) * (z @ z), np.finfo(float).tiny)
    alive: list[int] = []
    for k in range(m):  # deflation: an entry that hardly counts, or one of two poles that hardly differ, turned away
        if rho * abs(z[k]) * np.linalg.norm(z) <= tiny:
            continue
        if alive and d[k] - d[(p := alive[-1])] <= tiny:
            r = np.hypot(z[p], z[k])
            c, s = z[k] / r, z[p] / r
            z[k], z[p] = r, 0.0
            turn[:, [p, k]] = np.stack([c * turn[:, p] - s * turn[:, k], s * turn[:, p] + c * turn[:, k]], 1)
            alive.pop()
        alive.append(k)
    values, vectors = d.copy(), np.eye(m)
    if alive:
        own = np.array(alive)
        da, za = d[own], z[own]
        pole, x = secular_roots(da, za, rho)
        gap = (da[None, :] - da[pole][:, None]) - x[:, None]  # d_i - root_k, at [k, i]
        # z anew from the roots, so that the vectors are orthogonal however close the roots
        ratio = -gap / np.where(np.eye(len(own), dtype=bool), 1.0, da[None, :] - da[:, None])
        zz = np.sqrt(np.abs(np.prod(ratio, axis=0)))
        v = (np.copysign(zz, za)[None, :] / gap).T
        values[own] = da[pole] + x
        vectors[np.ix_(own, own)] = v / np.linalg.norm(v, axis=0)
    vectors = turn @ vectors
    back = np.empty_like(vectors)
    back[order] = vectors
    rising = np.argsort(values, kind="stable")
    return values[rising], back[:, rising]


def divide(d: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and vectors of a tridiagonal matrix: torn in the middle by a rank-one term, halves solved, joined."""
    m = len(d)
    if m == 1:
        return d.copy(), np.ones((1, 1))
    k = m // 2
    d, b = d.copy(), e[k - 1]
    if not b:
        (v1, q1), (v2, q2), z = divide(d[:k], e[: k - 1]), divide(d[k:], e[k:]), None
    else:
        d[k - 1] -= b
        d[k] -= b
        (v1, q1), (v2, q2) = divide(d[:k], e[: k - 1]), divide(d[k:], e[k:])
        z = np.concatenate([q1[-1], q2[0]])
    q = np.zeros((m, m))
    q[:k, :k], q[k:, k:] = q1, q2
    values = np.concatenate([v1, v2])
    if z is None:
        order = np.argsort(values, kind="stable")
        return values[order], q[:, order]
    values, u = joined(values, z, float(b))
    return values, q @ u


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit vectors as columns."""
    if not len(a):
        return np.zeros(0), np.zeros((0, 0))
    scale = np.abs(a).max() or 1.0
    d, e, q = tridiagonal(a / scale)
    values, v = divide(d, e)
    v = q @ v
    return values[::-1] * scale, (v / np.linalg.norm(v, axis=0))[:, ::-1]


# On Spark


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            own = _matrix(batch.column("x")).sum(0, dtype=np.int64).astype(object)  # a batch's sums are far below 2^63
            n, total = n + batch.num_rows, own if total is None else total + own
    if n:
        from decimal import Decimal

        sums = pa.array([[Decimal(int(v)) for v in total]], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array([n]), sums], names=["n", "sums"])


def _part(n: int, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n]), pa.array([high.tolist()], pa.list_(pa.float64())), pa.array([low.tolist()], pa.list_(pa.float64()))], schema=PARTS_ARROW)


def _products(values):
    """``values``: a batch's x to rows in two parts. A row per task: how many, and their summed outer products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                own = outer_sums(*values(_matrix(batch.column("x"))))
                n, total = n + batch.num_rows, own if total is None else dd_add(*total, *own)
        if n:
            yield _part(n, *total)
        give_back()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        for k in range(batch.num_rows):
            own = tuple(np.array(batch.column(c)[k].values) for c in ("high", "low"))
            n, total = n + batch.column("n")[k].as_py(), own if total is None else dd_add(*total, *own)
    if n:
        yield _part(n, *total)


def covariance(fit: DataFrame, dims: int, values) -> np.ndarray:
    """The covariance of what ``values`` makes of the fit list's x, divisor n. Tasks' parts, a row each, meet in ``MERGERS`` tasks, and theirs in one."""
    parts = fit.mapInArrow(_products(values), PARTS)
    row = parts.repartition(MERGERS).mapInArrow(_merge, PARTS).repartition(1).mapInArrow(_merge, PARTS).first()
    out = np.zeros((dims, dims))
    if row:
        i, j = np.triu_indices(dims)
        out[i, j] = out[j, i] = (np.array(row.high) + np.array(row.low)) / row.n
    return out


def whole_numbers(embedding: Column) -> Column:
    """floor(64 * entry) + 1000000 of each entry as a long; entries beyond +-2^40 are cut to that. Null where the vector or an entry is null or not finite."""
    sound = embedding.isNotNull() & ~F.coalesce(F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))
    x = F.transform(embedding, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("long") + SHIFT)
    return F.when(sound, x)


@dataclass
class Whitening:
    """A fitted model: the fit list's centre, components as columns with their eigenvalues (falling), the trace, and the error of the identity."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def sound(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        return self.values > 64 * EPS * self.trace

    def apply(self, x: np.ndarray) -> np.ndarray:
        high, low = self.centre.of(x)
        with np.errstate(divide="ignore", invalid="ignore"):
            return (high @ self.vectors + low @ self.vectors) / np.sqrt(np.where(self.sound, self.values, np.nan))


def _rows(model: Whitening):
    k, error = model.vectors.shape[1], model.identity_error
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch.column("x"))
            w = np.concatenate([model.apply(x[i : i + 1024]) for i in range(0, m, 1024)]).ravel()
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.centre.n)),
                    pa.array(model.centre.deviation(x), pa.int64()).take(pa.array(each)), pa.array(w, mask=np.isnan(w)), pa.array(np.tile(explained, m)), pa.array([error] * (m * k), pa.float64()),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )
        give_back()

    return run


def fit(x: DataFrame, scratch: Scratch, most: int = COMPONENTS) -> Whitening | None:
    """From ``x`` (arrays of one length), each distinct array once. None without rows."""
    listed = scratch.save(x.select("x").distinct(), "fit")
    sums = listed.mapInArrow(_sums, SUMS).select("n", F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    if not sums:
        return None
    centre = Centre(sums[0].n, [int(r.s) for r in sums])
    v = covariance(listed, len(centre.sums), centre.of)
    values, vectors = eigen(v)
    model = Whitening(centre, values[:most], np.ascontiguousarray(vectors[:, :most]), float(np.trace(v)))
    if k := int(model.sound.sum()):
        identity = covariance(listed, k, lambda x: (w := model.apply(x)[:, :k], np.zeros_like(w)))
        model.identity_error = float(np.abs(identity - np.eye(k)).max())
    return model


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each sound vector and component: vec_id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error.

    Left out are vectors that are null or hold a null or an entry that is not finite, and vectors of another length than most have
    (of lengths equally common, the greater counts). Repeated rows and rows without id each come back; the fit counts equal vectors once.
    ``deviation`` is null where no long holds it. A component whose variance is rounding alone has ``whitened`` null, and does not
    count in ``identity_error``, which is null if there is no other. An empty table, or one of empty vectors, gives no
    rows. Only id and vector are read, whatever other columns are named.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vec_col)).alias("x")).filter("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("held")).orderBy(F.desc("held"), F.desc("dims")).first()
    none = vectors.sparkSession.createDataFrame([], OUT)
    if not lengths or not lengths.dims:
        return none
    rows = rows.filter(F.size("x") == lengths.dims)
    with Scratch(vectors.sparkSession, "whiten") as scratch:
        model = fit(rows, scratch, most)
    return rows.mapInArrow(_rows(model), OUT)
