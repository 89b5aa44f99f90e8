"""Compact bytes for arrays of whole numbers."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(arrays: list[np.ndarray], sorted_first: bool = True) -> bytes:
    """Whole numbers by byte planes; the first array is sorted and kept as differences."""
    n, out = len(arrays[0]), [np.uint32(len(arrays[0])).tobytes()]
    for i, x in enumerate(arrays):
        x = np.ascontiguousarray(x).view(np.uint64) if x.dtype.itemsize == 8 else x.astype(np.uint64)
        if sorted_first and i == 0:
            x = np.diff(x, prepend=np.uint64(0))
        out.append(x.view(np.uint8).reshape(n, 8).T.tobytes())
    return zstandard.compress(b"".join(out), 1)


def unpack(data: bytes, sorted_first: bool = True) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    planes = np.frombuffer(raw, np.uint8, offset=4).reshape(-1, 8, n) if n else np.zeros((4, 8, 0), np.uint8)
    out = [np.ascontiguousarray(p.T).reshape(-1).view(np.uint64) for p in planes]
    if sorted_first and len(out):
        out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out
