"""Vectors as exact integers: which rows are kept, and how a batch becomes a matrix.

A component x becomes floor(scale * x). Matrices are int64 where every component allows it and Python integers where
one doesn't, so no value is ever rounded.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Doubles up to here are scaled and floored without rounding, and their integers fit a long.
PLAIN = 2.0**50
MOST_LONG = 2**63 - 1


def finite(column: Column) -> Column:
    """True for a vector without null or non-finite components; false for a null one."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return column.isNotNull() & F.coalesce(good, F.lit(False))


def doubles(name: str) -> Column:
    return F.col(f"`{name}`").cast("array<double>")


def integers(column: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """A row for each vector of the column, all of which have width finite components. int64, or Python integers."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    if not x.size or np.abs(x).max() < PLAIN:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[math.floor(Fraction(v) * scale) for v in row] for row in x.tolist()], dtype=object).reshape(len(column), width)


def magnitude(x: np.ndarray) -> int:
    """The largest absolute value, as a Python integer."""
    return int(np.abs(x).max()) if x.size else 0


def as_exact(x: np.ndarray) -> np.ndarray:
    """int64 if every value fits well, else Python integers."""
    return x.astype(np.int64) if magnitude(x) < 2**61 else x.astype(object)


def long_column(values: np.ndarray) -> pa.Array:
    """Values beyond a long become the largest long."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([min(int(v), MOST_LONG) for v in values], pa.int64())
