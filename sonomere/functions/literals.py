"""Plan constants, checks inside a plan, and arrays to explode."""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_literal(values: Sequence[float] | np.ndarray) -> Column:
    """A constant ARRAY<DOUBLE>.

    One text literal that Catalyst folds to one array constant: a 48 000-point taper stays a
    single node in the plan instead of 48 000 literal children in generated code.
    """
    vector = np.asarray(values, dtype=np.float64)
    if not np.all(np.isfinite(vector)):
        raise ValueError("vector literals must be finite")
    return F.from_json(F.lit(repr(vector.tolist())), "array<double>")


def check(condition: Column, message: Column, value: Column) -> Column:
    """``value`` where ``condition`` holds (or is unknown), else an error raised by the task."""
    return F.when(~condition, F.raise_error(message)).otherwise(value)


def elements(vector: Column | str) -> Column:
    """An array to be exploded.

    For a bare column the optimizer adds a filter on its size and moves that filter below the
    projection that computes the column; a Python kernel would then run twice per record.
    """
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce(column, F.array())
