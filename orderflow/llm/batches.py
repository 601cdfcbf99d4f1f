"""Helpers for functions over Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about this many bytes, which bounds memory
#: whatever the size of a batch; a longer text is a slice of its own.
SLICE_BYTES = 2_000_000


def slices(
    batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batch with the values of one text column, of ``most`` bytes or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        limit = most + (ends[start - 1] if start else 0)
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        part = batch.slice(start, stop - start)
        yield part, part.column(column).to_pylist()
        start = stop


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] - 1 of all i, in order."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def offsets(lengths: np.ndarray) -> np.ndarray:
    """0 and the running sum."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
