"""Vectors of an embedding column as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def usable(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """(rows, raw 32-bit vectors) of the vectors that are not null, empty or zero and hold no
    null or non-finite component."""
    rows, out = [], []
    values = column.values  # of every row, null ones included
    data = values.to_numpy(zero_copy_only=False).astype("<f4")  # nulls become NaN
    at = column.offsets.to_numpy()
    good = np.isfinite(data)
    bad_before = np.concatenate([[0], np.cumsum(~good)])
    some_before = np.concatenate([[0], np.cumsum(good & (data != 0))])
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    a, b = at[:-1], at[1:]
    ok = valid & (b > a) & (bad_before[b] == bad_before[a]) & (some_before[b] > some_before[a])
    for i in np.flatnonzero(ok):
        rows.append(i)
        out.append(data[a[i] : b[i]].tobytes())
    return np.array(rows, np.int64), out


def matrix(raw: list[bytes], dim: int) -> np.ndarray:
    """Rows in double precision."""
    return np.frombuffer(b"".join(raw), "<f4").reshape(len(raw), dim).astype(np.float64)
