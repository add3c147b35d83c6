"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows of a distributed matrix.

With X the centred rows, each step takes X v for a right vector v, removes its parts along all left vectors, and takes the transposed product
for the next right vector, which is made orthogonal to all right vectors. The steps give an upper bidiagonal B with X V = U B; its small
singular value decomposition gives the components (V times its right vectors) and their variances (squared singular values over n).

Left vectors are as long as the table, so they are not stored: each lies in the range of X, u = X g, and only the short g is kept. A step is
one pass over the rows: with q the short vector of X v less its known parts along U, it takes p = X q, its inner products with every u, its norm,
and the transposed product of p. What is left along U is then removed from p, and by linearity from the transposed product, without
another pass. All that the driver keeps are vectors as long as a row; the rows lie in a checkpoint, so a lost executor repeats one pass.

Rows are whole numbers. Sums are exact, and rows are centred on the rounded mean, less its exact rest, so that a large common offset costs no digits.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence_spark.session import cut

#: Rows of a stored block.
BLOCK = 4096
#: Entries are held to this size; larger ones count as it.
LARGEST = 1 << 50


@dataclass
class Whitening:
    """A fit: the rows behind it, their sums, unit components as columns, their variances, the whole variance, and the largest error of the whitened covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The rounded mean and n times what is left of the mean beside it, both whole."""
        middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(middle, np.int64), np.array([s - self.n * m for s, m in zip(self.sums, middle, strict=True)], np.int64)


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    """floor(scale * c) + shift of every entry, as longs; entries beyond LARGEST count as LARGEST. Null for vectors that are null, empty or hold null or non-finite entries."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    entry = lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))) + shift
    return F.when(finite & (F.size(wide) > 0), F.transform(wide, entry))


def _matrix(column) -> np.ndarray:
    """The rows of an Arrow list column, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def blocks(rows: DataFrame) -> DataFrame:
    """(dim, n, kind, data) from rows (dim, x), whose tasks each hold rows of any lengths: matrices of at most BLOCK rows in the smallest integers that hold them."""
    def run(frames):
        import pyarrow as pa
        import pyarrow.compute as pc

        for frame in frames:
            for dim in pc.unique(frame.column("dim")).to_pylist():
                part = frame.filter(pc.equal(frame.column("dim"), dim))
                for at in range(0, part.num_rows, BLOCK):
                    x = _matrix(part.slice(at, BLOCK).column("x"))
                    kind = next((k for k in ("<i2", "<i4") if np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max), "<i8")
                    yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "n": pa.array([len(x)], pa.int64()), "kind": [kind], "data": pa.array([x.astype(kind).tobytes()], pa.binary())})

    return rows.select("dim", "x").mapInArrow(run, "dim int, n long, kind string, data binary")


def _passes(stored: DataFrame, dim: int, fold) -> list:
    """What ``fold`` makes of the matrices of each task: one text per task, with no more tasks than cores, whatever the size of the table."""
    def run(frames):
        import pyarrow as pa

        def matrices():
            for frame in frames:
                for n, kind, data in zip(frame.column("n").to_pylist(), frame.column("kind").to_pylist(), frame.column("data"), strict=True):
                    yield np.frombuffer(data.as_buffer(), kind).reshape(n, dim).astype(np.int64)

        yield pa.RecordBatch.from_pydict({"part": [fold(matrices())]})

    cores = stored.sparkSession.sparkContext.defaultParallelism
    rows = stored.where(F.col("dim") == dim).select("n", "kind", "data").coalesce(cores).mapInArrow(run, "part string").collect()
    return sorted(r.part for r in rows)


def _sums(stored: DataFrame, dim: int) -> tuple[int, list[int]]:
    def fold(matrices) -> str:
        n, total = 0, [0] * dim
        for x in matrices:
            n, total = n + len(x), [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
        return json.dumps([n, total])

    parts = [json.loads(p) for p in _passes(stored, dim, fold)]
    return sum(n for n, _ in parts), [sum(t) for t in zip(*(t for _, t in parts), strict=True)]


def _added(stored: DataFrame, dim: int, centre, fold) -> np.ndarray:
    """The sum of the float vectors that ``fold`` makes of each centred matrix."""
    middle, rest = centre

    def one(matrices) -> str:
        total = None
        for x in matrices:
            found = fold((x - middle) - rest)
            total = found if total is None else total + found
        return "" if total is None else total.tobytes().hex()

    parts = [np.frombuffer(bytes.fromhex(p), float) for p in _passes(stored, dim, one) if p]
    return np.sum(parts, axis=0)


def bidiagonalise(products, dim: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Singular values (falling) and right singular vectors (columns) of X, given ``products(q, G)``.

    ``products`` returns |X|^2, |p|^2, U^T p and X^T p for p = X q and U = X G. Up to four times the wanted number of columns all steps are
    taken; beyond that they end when the wanted values and vectors have converged. A step without a remainder goes on with a new
    orthogonal vector, so repeated and zero singular values are found too.
    """
    rng = np.random.default_rng(seed)
    right, short, back = np.empty((dim, 0)), np.empty((dim, 0)), np.empty((dim, 0))
    alphas, betas = [], []

    def orthogonal(w):
        return w - right @ (right.T @ w)

    v = rng.normal(size=dim)
    v /= np.linalg.norm(v)
    while True:
        q = v - short @ (back.T @ v)
        for _ in range(3):
            whole, square, along, transposed = products(q, short)
            q, transposed = q - short @ along, transposed - back @ along
            left = square - along @ along
            if along @ along <= 1e-20 * square:
                break
        alpha = np.sqrt(max(left, 0.0))
        alpha = alpha if alpha > 1e-12 * np.sqrt(whole) * np.linalg.norm(q) else 0.0  # p is rounding alone
        g, r = (q / alpha, transposed / alpha) if alpha else (np.zeros(dim), np.zeros(dim))
        right, short, back = np.column_stack([right, v]), np.column_stack([short, g]), np.column_stack([back, r])
        alphas.append(alpha)
        if len(alphas) == dim:
            break
        w = orthogonal(orthogonal(r - alpha * v))
        beta = float(np.linalg.norm(w))
        if beta <= 1e-13 * np.sqrt(whole):
            beta, w = 0.0, orthogonal(rng.normal(size=dim))
        elif dim > 4 * wanted and len(alphas) > wanted:
            p, s, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            gaps = np.abs(np.diff(s[: wanted + 1] ** 2))
            gap = np.minimum(gaps, np.append(np.inf, gaps[:-1]))
            if (beta * np.abs(p[-1, :wanted]) * s[:wanted] <= 1e-13 * gap).all():
                break
        betas.append(beta)
        v = orthogonal(w / np.linalg.norm(w))  # a short remainder is not yet orthogonal to rounding
        v = orthogonal(v / np.linalg.norm(v))
        v /= np.linalg.norm(v)
    _, s, turned = np.linalg.svd(np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1))
    return s, right @ turned.T


def fit(rows: DataFrame, components: int = 16) -> dict[int, Whitening]:
    """A whitening of the distinct ``x`` (arrays of longs) for each of their lengths, with at most ``components`` components of positive variance.

    Null x take no part. Lengths are few (a fit of its own each); an empty table gives no fit, equal rows give one without components.
    """
    distinct = rows.select("x").where("x is not null").distinct().select(F.size("x").alias("dim"), "x")
    stored = cut(blocks(distinct))
    out = {}
    for dim in sorted(r.dim for r in stored.select("dim").distinct().collect()):
        model = Whitening(*_sums(stored, dim), np.empty((dim, 0)), np.empty(0), 0.0, 0.0)
        out[dim] = model
        middle, rest = model.centre()
        centre = middle, rest / model.n

        def products(q, short):
            def fold(x):
                p, u = x @ q, x @ short
                return np.concatenate([[(x * x).sum(), p @ p], u.T @ p, x.T @ p])

            found = _added(stored, dim, centre, fold)  # noqa: B023 - used within the turn
            model.total = found[0] / model.n  # noqa: B023
            return found[0], found[1], found[2: 2 + short.shape[1]], found[2 + short.shape[1]:]

        if model.n < 2:
            continue
        values, vectors = bidiagonalise(products, dim, components)
        k = int((values[:components] > 1e-12 * values[0]).sum()) if values[0] > 0 else 0
        model.components, model.variances = vectors[:, :k], values[:k] ** 2 / model.n
        if k:
            turn = model.components / np.sqrt(model.variances)
            found = _added(stored, dim, centre, lambda x: np.concatenate([(y := x @ turn).sum(axis=0), (y.T @ y).ravel()]))  # noqa: B023
            mean, second = found[:k] / model.n, found[k:].reshape(k, k) / model.n
            model.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return out


def whitened(rows: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """A row per row of ``rows`` (vec_id, x) and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is the sum over dimensions of (n x - sums)^2, exact; null if it leaves the range of a long. Null x give no rows, repeated rows a
    row each; a row of a length without components gives none. Other columns are not read.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(models)  # short vectors, whatever the data

    def run(frames):
        import pyarrow as pa
        import pyarrow.compute as pc

        for frame in frames:
            sizes = pc.list_value_length(frame.column("x"))
            for dim, model in shared.value.items():
                part, k = frame.filter(pc.equal(sizes, dim)), len(model.variances)
                if not k or not part.num_rows:
                    continue
                middle, rest = model.centre()
                turn = model.components / np.sqrt(model.variances)
                for at in range(0, part.num_rows, BLOCK):
                    few = part.slice(at, BLOCK)
                    x = _matrix(few.column("x")) - middle
                    y = (x - rest / model.n) @ turn
                    fits = ((x.astype(float) * model.n - rest) ** 2).sum(axis=1) < 9.2e18
                    apart = np.where(fits[:, None], x, 0) * model.n - rest
                    m = len(x)
                    yield pa.RecordBatch.from_arrays([
                        few.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                        pa.array(np.repeat((apart * apart).sum(axis=1), k), mask=np.repeat(~fits, k)), pa.array(y.ravel()), pa.array(np.tile(model.variances / model.total, m)),
                        pa.array(np.full(m * k, model.identity_error))], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("vec_id", "x").where("x is not null").mapInArrow(run, schema)
