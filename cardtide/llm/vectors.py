"""Vectors as whole numbers, packed in slabs for numpy; shared by the operators on embeddings.

A component ``c`` becomes ``floor(scale * c)`` with ``c`` as a double, held as a long (numbers beyond
its range become the nearest long). A vector that is null or holds a null or non-finite component is
left out. Vectors of fewer components than the longest are continued by zeros.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Vectors in a slab: with 1,000 components of eight bytes a slab takes 32 MB.
SLAB_ROWS = 4096
SLAB = "slab string, rows int, dims int, kind string, ids binary, no_id binary, data binary"
SLAB_COLUMNS = [column.split()[0] for column in SLAB.split(", ")]


def whole_vectors(df: DataFrame, scale: int = 256, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that take part; ``x`` is an array of longs."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    doubles = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return doubles.where(F.col("v").isNotNull() & F.forall("v", finite)).select(
        "vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("x"))


def longest(vectors: DataFrame) -> int:
    """Components of the longest vector; 0 for an empty table."""
    return vectors.agg(F.max(F.size("x"))).first()[0] or 0


def matrix(arrays, dims: int) -> np.ndarray:
    """Rows of longs, continued by zeros."""
    arrays = list(arrays)
    if arrays and all(len(a) == dims for a in arrays):
        return np.stack(arrays).astype(np.int64, copy=False).reshape(len(arrays), dims)
    out = np.zeros((len(arrays), dims), dtype=np.int64)
    for row, a in zip(out, arrays):
        row[:len(a)] = a
    return out


def smallest_kind(x: np.ndarray) -> str:
    """The narrowest whole-number type that holds all of ``x``."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return next(kind for kind in ("i1", "i2", "i4", "i8") if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max)


def packed(vectors: DataFrame, dims: int, by_column: bool, rows: int = SLAB_ROWS) -> DataFrame:
    """Slabs of up to ``rows`` vectors, stored component by component or vector by vector."""
    def pack(part: pd.DataFrame, name: str) -> tuple:
        x = matrix(part["x"], dims)
        kind = smallest_kind(x)
        stored = np.ascontiguousarray((x.T if by_column else x).astype(f"<{kind}"))
        return (name, len(x), dims, kind, part["id"].to_numpy(dtype=np.int64).tobytes(), part["no_id"].to_numpy(dtype=bool).tobytes(), stored.tobytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, n, made, task = [], 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            while n >= rows:
                whole = pd.concat(waiting, ignore_index=True)
                yield pd.DataFrame([pack(whole.iloc[:rows], f"{task}-{made}")], columns=SLAB_COLUMNS)
                waiting, n, made = [whole.iloc[rows:]], n - rows, made + 1
        if n:
            yield pd.DataFrame([pack(pd.concat(waiting, ignore_index=True), f"{task}-{made}")], columns=SLAB_COLUMNS)
    # pandas has no nulls among longs, so a missing id is told apart by a flag.
    return vectors.select(F.coalesce("vec_id", F.lit(0)).alias("id"), F.col("vec_id").isNull().alias("no_id"), "x").mapInPandas(run, SLAB)


class Slab:
    """One slab read back: ``ids`` (0 where ``no_id``) and ``x`` as stored."""

    def __init__(self, row, by_column: bool) -> None:
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        self.no_id = np.frombuffer(row.no_id, dtype=bool)
        shape = (row.dims, row.rows) if by_column else (row.rows, row.dims)
        self.x = np.frombuffer(row.data, dtype=f"<{row.kind}").reshape(shape)
