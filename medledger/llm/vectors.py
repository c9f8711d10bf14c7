"""Rows of embedding tables as matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for a vector that is not null and has no null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors without nulls as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def vectors(table: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """(id, v as array of double, more, dim) of the finite vectors."""
    v = table[vector_col].cast("array<double>")
    return (
        table.select(table[id_col].cast("long").alias("id"), v.alias("v"), *more)
        .filter(finite(F.col("v")))
        .withColumn("dim", F.size("v"))
    )
