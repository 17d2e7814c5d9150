"""Arrow batches in slices of bounded size, and lists built from flat buffers."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 8 << 20
# Of the GNU C library only.
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each, one row at least.

    After each batch the worker gives back the memory that it no longer uses.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(offsets(batch.column(column)))
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, stop - start)
        give_back()


def give_back() -> None:
    """Hand memory that is free back to the system.

    Spark keeps its Python workers for later tasks. Without this Arrow's allocator and the C
    library's would keep some tens of MB in each for good.
    """
    pa.default_memory_pool().release_unused()
    if TRIM is not None:
        TRIM(0)


def offsets(values: pa.Array) -> np.ndarray:
    """The n + 1 offsets of a string, binary or list array, as it is sliced."""
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    kind = np.int64 if wide or pa.types.is_large_list(values.type) else np.int32
    buffer = np.frombuffer(values.buffers()[1], kind)
    return buffer[values.offset : values.offset + len(values) + 1].astype(np.int64)


def content(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array in one buffer, and the n + 1 offsets into it."""
    at = offsets(values)
    data = values.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def lists(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Lists of the given lengths over one flat array."""
    at = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, kind))
