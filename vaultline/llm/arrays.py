"""Sums of fixed-size arrays that tasks gather, added up by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def array_rows(total: np.ndarray) -> pa.RecordBatch:
    """One row per first index of a float64 array: ``(part int, sums binary)``."""
    return pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()),
                                       pa.array([r.tobytes() for r in total], pa.binary())], ["part", "sums"])


def summed(rows: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of all tasks' arrays; only ``shape`` float64 values reach the driver."""
    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape[1:])
        for b in batches:
            for s in b.column("sums").to_pylist():
                total += np.frombuffer(s).reshape(shape[1:])
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["part", "sums"])

    out = np.zeros(shape)
    for r in rows.groupBy("part").applyInArrow(add, "part int, sums binary").collect():
        out[r.part] = np.frombuffer(bytes(r.sums)).reshape(shape[1:])
    return out
