"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of the fit list is never formed: a pass over the list gives V Q for a thin matrix Q, each task
sending the sum of its rows. A sweep runs the Chebyshev recurrence on the block of vectors that have not
converged, so that the spectrum between 0 and the smallest Ritz value is damped and the rest is amplified; then
come QR and Rayleigh-Ritz. Converged leading vectors are locked and projected out, so that they cannot swamp the
others. Sweeps end when every wanted pair is certified: ``|V q - e q| <= TOLERANCE * e1``, or the residuals have
stopped falling at rounding level (``ROUNDING``).

The driver holds matrices of dimension x block, never rows. Cost of a pass: rows x dimension x block products.

Defined cases: vectors that are null or hold null or non-finite components get no rows; repeated vectors count
once in the fit list; null and repeated ids are kept, a row each. Shorter vectors count as followed by zeros,
huge components stand at 2**52 (:mod:`orevein.llm.dense`). Directions without variance (below ``RANK`` of the
largest) cannot be whitened, so there are as many components as the list has directions; a list of one vector,
or an empty table, gives no rows. Equal eigenvalues get any orthonormal basis. ``deviation`` is null where it
does not fit a long. Other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from orevein.llm import dense
from orevein.plans.tables import table
from orevein.session import Scratch

GUARD = 16  # vectors carried beyond the wanted ones
DEGREES = (2, 48)  # least and largest degree of the polynomial
GAIN = 1e8  # the degree is chosen so that no direction grows by more than this
TOLERANCE = 2e-14  # residual of a certified pair, as a share of the largest eigenvalue
ROUNDING = 1e-11  # residual that is accepted when sweeps no longer lower it
RANK = 1e-11  # eigenvalues below this share of the largest count as zero
MOST_SWEEPS = 300
SAFE = 2**62


class Whitening(NamedTuple):
    """A fit: list size, sums, rounded-down mean and remainder, eigenpairs, trace, work done."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int
    residual: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.base, self.rest / max(self.n, 1))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _centred(x: np.ndarray, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """``x - mean``: the integer part of the mean is taken off exactly first."""
    return (x - base).astype(np.float64) - rest


def _sums(rows: DataFrame, width: int) -> list[int]:
    """Exact sums per dimension; halves of 26 bits keep every partial sum inside a long."""
    halves = dense.summed(rows, "x", width, lambda x: np.stack([(x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0)]))
    return [(int(high) << 26) + int(low) for high, low in zip(*halves)]


def chebyshev(apply, block, product, values, cut, locked):
    """The block after the scaled recurrence that damps ``[0, cut]``; ``product`` is V block, already known.

    Returns the block and the number of passes. ``locked`` is projected out at every step.
    """
    top = values.max()
    growth = np.arccosh(max((2 * top - cut) / cut, 1 + 1e-9))
    degree = int(np.clip(np.log(2 * GAIN) / growth, *DEGREES))

    def free(y):
        return y - locked @ (locked.T @ y)

    half = cut / 2
    sigma = half / (top - half)
    tau = 2 / sigma
    old, new = block, free((product - half * block) * (sigma / half))
    for _ in range(degree - 1):
        step = 1 / (tau - sigma)
        old, new = new, free((apply(new) - half * new) * (2 * step / half) - sigma * step * old)
        sigma = step
    return new, degree - 1


def leading_pairs(apply, width: int, wanted: int) -> tuple[np.ndarray, np.ndarray, int, float]:
    """Largest eigenvalues of the operator ``apply``, falling, with their vectors; passes and residual.

    ``apply(Q)`` is V Q for a symmetric V without negative eigenvalues.
    """
    size = min(width, wanted + GUARD)
    start = np.random.default_rng(11).standard_normal((width, size))
    block, passes, locked, last = start, 0, 0, np.inf
    for _ in range(MOST_SWEEPS):
        basis, _ = np.linalg.qr(block)
        product, passes = apply(basis), passes + 1
        values, turn = np.linalg.eigh((basis.T @ product + product.T @ basis) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, product = basis @ turn, product @ turn
        top = max(values[0], 0.0)
        if top == 0:
            return values[:0], basis[:, :0], passes, 0.0
        residual = np.linalg.norm(product - basis * values, axis=0) / top
        worst = residual[:min(wanted, size)].max()
        if worst <= TOLERANCE or (worst <= ROUNDING and worst > last / 2):
            keep = (values > RANK * top)[:wanted]
            return values[:wanted][keep], basis[:, :wanted][:, keep], passes, float(worst)
        last = worst
        good = residual <= TOLERANCE
        locked = min(int(np.argmin(good)) if not good.all() else size, size - 1)
        done, free = basis[:, :locked], slice(locked, None)
        cut = max(values[-1], RANK * values[locked])
        if size == width or cut >= values[locked]:  # nothing to damp: a plain step
            block = np.hstack([done, product[:, free]])
            continue
        filtered, more = chebyshev(apply, basis[:, free], product[:, free], values[free], cut, done)
        block, passes = np.hstack([done, filtered / np.linalg.norm(filtered, axis=0)]), passes + more
    raise RuntimeError(f"subspace iteration is not certified after {MOST_SWEEPS} sweeps: residual {worst}")


def fit(rows: DataFrame, width: int, components: int) -> Whitening:
    """Leading eigenpairs of the covariance of the vectors ``x`` (each row counts), by passes over them."""
    n = rows.count()
    sums = _sums(rows, width) if n else [0] * width
    base = np.array([s // max(n, 1) for s in sums], dtype=np.int64)
    rest = np.array([s % max(n, 1) for s in sums], dtype=np.float64)
    if not n or not width:
        return Whitening(n, base, rest, np.zeros(0), np.zeros((width, 0)), 0.0, 0, 0.0)
    mean = rest / n
    # Scaled to variance about 1, so that no product leaves the range of doubles.
    unit = dense.summed(rows, "x", width, lambda x: (_centred(x, base, mean) ** 2).sum(axis=0)).sum() / n
    if unit == 0:
        return Whitening(n, base, rest, np.zeros(0), np.zeros((width, 0)), 0.0, 0, 0.0)

    def apply(q: np.ndarray) -> np.ndarray:
        def part(x):
            c = _centred(x, base, mean)
            return c.T @ (c @ q)
        return dense.summed(rows, "x", width, part) / (n * unit)

    values, vectors, passes, residual = leading_pairs(apply, width, components)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return Whitening(n, base, rest, values * unit, vectors * signs, float(unit), passes, residual)


def identity_error(rows: DataFrame, width: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened list's covariance minus the identity, by one more pass."""
    size = len(model.values)
    if not size:
        return 0.0

    def part(x):
        y = np.hstack([model.scores(x), np.ones((len(x), 1))])
        return y.T @ y

    moments = dense.summed(rows, "x", width, part) / model.n
    mean = moments[:size, size]
    return float(np.abs(moments[:size, :size] - np.outer(mean, mean) - np.eye(size)).max())


def _deviations(x: np.ndarray, n: int, base: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Exact ``sum((n x - S)**2)`` per row."""
    if not len(x):
        return []
    far = int(np.abs(x - base).max()) + 1
    if (n * far) ** 2 * max(x.shape[1], 1) < SAFE:
        apart = n * (x - base) - rest.astype(np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [int(r) for r in rest]
    sums = (sum((n * v - r) ** 2 for v, r in zip(row, exact)) for row in (x - base).tolist())
    return [s if s < 2**63 else None for s in sums]


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
    scale: int = 64, shift: int = 1_000_000,
) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``: a row per usable vector and component.

    Vectors are taken as whole numbers ``x = floor(scale * c) + shift``; the fit list holds each different x once.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    usable = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = usable.filter(dense.finite(F.col("vector")))
    width = dense.longest(usable, "vector")
    rows = usable.select("id", dense.whole_numbers(F.col("vector"), scale, shift, width).alias("x"))
    listed = scratch.table(rows.select("x").distinct(), "list")
    model = fit(listed, width, components)
    error = identity_error(listed, width, model)
    scratch.drop(listed)
    size = len(model.values)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, dense.ROWS):
                part = batch.slice(start, dense.ROWS)
                x = dense.matrix(part.column(1), width)
                if not len(x) or not size:
                    continue
                deviation = pa.array(_deviations(x, model.n, model.base, model.rest), pa.int64())
                each = pa.array(np.repeat(np.arange(len(x)), size))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                    deviation.take(each),
                    pa.array(model.scores(x).ravel()),
                ], ["id", "component", "deviation", "whitened"])

    kind = usable.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, component int, deviation bigint, whitened double")
    explained = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.values] or [F.lit(0.0)]), F.col("component"))
    return found.select(
        "id", "component", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"),
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES = {"op11_embedding_whitening": op11_embedding_whitening}
ORACLES = {}  # eigenvectors are not SQL; tests compare with a dense solver on exact integers
