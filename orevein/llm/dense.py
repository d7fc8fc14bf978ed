"""Dense vectors as integer rows, and sums over all of them, a few numbers per task.

Defined cases: a vector is usable if it is not null and holds only finite components; an empty one is. Scaled
components beyond 2**52 stand at 2**52, so that they stay exact as doubles. Vectors shorter than the longest
count as if zeros followed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

LIMIT = float(2**52)
ROWS = 4096  # rows that a task turns into floating point at once


def finite(vector: Column) -> Column:
    """True for vectors without null, NaN or infinite components."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)), F.lit(False))


def longest(vectors: DataFrame, column: str) -> int:
    """Number of components of the longest vector, 0 without vectors."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def whole_numbers(vector: Column, scale: int, shift: int, width: int) -> Column:
    """``floor(scale * x) + shift`` of every component x as double, for ``width`` components."""
    full = F.concat(vector, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(vector)))

    def scaled(x: Column) -> Column:
        product = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.lit(float(scale)) * x))
        return F.floor(product).cast("bigint") + F.lit(shift).cast("bigint")

    return F.transform(full, scaled)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls as one row per vector."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def summed(rows: DataFrame, column: str, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``part(block)`` over blocks of all vectors: every task sends one number per cell, added up by cell.

    Whole numbers are added exactly (as decimals) and come back as Python integers.
    """
    shape = part(np.zeros((0, width), np.int64)).shape
    exact = np.issubdtype(part(np.zeros((0, width), np.int64)).dtype, np.integer)

    def run(batches):
        total = 0
        for batch in batches:
            block = matrix(batch.column(0), width)
            for start in range(0, len(block), ROWS):
                total = total + part(block[start:start + ROWS])
        if np.ndim(total):
            value = np.ascontiguousarray(total).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value), dtype=np.int64)), pa.array(value)], ["cell", "value"])

    kind = "bigint" if exact else "double"
    cells = rows.select(column).mapInArrow(run, f"cell bigint, value {kind}")
    value = F.sum(F.col("value").cast("decimal(38,0)") if exact else F.col("value")).alias("value")
    out = np.zeros(int(np.prod(shape)), dtype=object if exact else np.float64)
    for row in cells.groupBy("cell").agg(value).collect():
        out[row["cell"]] = int(row["value"]) if exact else row["value"]
    return out.reshape(shape)
