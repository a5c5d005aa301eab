"""Vectors as Arrow list columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All components, the offsets of the rows, and which rows are whole (no null vector or component, all finite)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values
    bad = np.zeros(len(values) + 1, bool)
    if values.null_count:
        bad[:-1] = ~values.is_valid().to_numpy(zero_copy_only=False)
        values = values.fill_null(0)
    flat = values.to_numpy(zero_copy_only=False)
    bad[:-1] |= ~np.isfinite(flat)
    counts = np.concatenate([[0], np.cumsum(bad[:-1])])
    whole = counts[offsets[1:]] == counts[offsets[:-1]]
    if column.null_count:
        whole &= column.is_valid().to_numpy(zero_copy_only=False)
    return flat, offsets, whole


def matrix(rows: list[np.ndarray], kind=np.float64) -> np.ndarray:
    """Rows of different lengths as one matrix; shorter ones end in zeros."""
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), kind)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out
