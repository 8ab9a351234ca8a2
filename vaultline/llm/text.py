"""Word splitting, stable word names and batch slicing shared by the operators.

Words are maximal runs outside space and U+0009..U+000D, the bytes ``bytes.split()``
splits on; ``bytes.lower()`` changes A-Z only. Both work on UTF-8 bytes, so texts
reach Python as Arrow binary and are never decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

# Texts handled at once inside a task (bytes); a longer single text is its own slice.
SLICE_BYTES = 4 << 20
# Words whose names a worker remembers before it starts over.
MEMO_WORDS = 200_000
# Rows of an Arrow batch: texts are large, and a batch is held on both sides of a worker's pipe.
BATCH_ROWS = "1000"


def texts_frame(df: DataFrame) -> DataFrame:
    """The frame, in a session whose Arrow batches hold ``BATCH_ROWS`` rows at most."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= int(BATCH_ROWS):
        df.sparkSession.conf.set(key, BATCH_ROWS)
    return df


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes (one row at least)."""
    col = batch.column(column).cast(pa.binary())
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes per row; null counts as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


class Names(dict):
    """word (bytes) -> 64-bit name, remembered per worker within a fixed size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        name = self[word] = xxhash.xxh3_64_intdigest(word)
        return name

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit name for the ordered pair (a, b)."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
    return x


def int_range(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, ... concatenated."""
    total = int(n.sum())
    ends = np.cumsum(n)
    return np.arange(total) - np.repeat(ends - n, n)
