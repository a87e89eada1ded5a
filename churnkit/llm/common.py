"""Chunk keys, packed numbers and other small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.sources import Workspace  # noqa: F401


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Freed arrays of a megabyte and more go back to the system at once; by default a Python worker, which lives on between
# tasks, keeps what its largest task needed.
_LEAN = {
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def lean_workers(spark: SparkSession) -> None:
    """Python workers of operators made from now on hold no memory that they don't use; what the caller has set stays."""
    for name, value in _LEAN.items():
        spark.sparkContext.environment.setdefault(name, value)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one column scan, one number."""
    return df.agg(F.sum(F.octet_length(text)).alias("n")).first().n or 0


def parts_for(size: int, each: int) -> int:
    """How many parts of about ``each`` a total of ``size`` makes; never fewer than one."""
    return max(1, -(-size // each))


def chunk_of(chunks: int, *key: str) -> Column:
    """A row's chunk: a function of these columns alone, so that every pass and every retry forms the same chunks."""
    return F.pmod(F.xxhash64(*key), F.lit(chunks)).cast("long")


def by_text(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[slice]:
    """Slices of a batch with at most about ``limit`` bytes of text each; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings; a null text is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    """Columns (arrays, or anything that makes one) as a batch of this schema; arrays of another type are cast."""
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def pack(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers as differences, byte plane by byte plane; planes of zeros cost nothing."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = max(1, int(np.flatnonzero(planes.any(axis=1)).max(initial=0)) + 1)
    return bytes([used]) + planes[:used].tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    used = blob[0]
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(used, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :used] = planes.T
    return np.cumsum(full.view("<u8").ravel(), dtype=np.uint64)
