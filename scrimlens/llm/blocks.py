"""Sorted hashes in blocks: what a task has gathered goes to each range of hashes as one packed row instead of a row a hash."""

from __future__ import annotations

import numpy as np

_U = np.uint64
HASH_BITS = 48


def packed(sorted_hashes: np.ndarray) -> tuple[int, bytes]:
    """First hash and differences; four bytes each where they fit, else eight."""
    steps = np.diff(sorted_hashes)
    narrow = not len(steps) or int(steps.max()) < 1 << 32
    return int(sorted_hashes[0]), steps.astype(np.uint32 if narrow else _U).tobytes()


def unpacked(first: int, steps: bytes, n: int) -> np.ndarray:
    wide = len(steps) != 4 * (n - 1)
    out = np.empty(n, _U)
    out[0] = first
    out[1:] = np.frombuffer(steps, _U if wide else np.uint32)
    return np.cumsum(out, dtype=_U)


def range_cuts(sorted_hashes: np.ndarray, ranges: int, bits: int = HASH_BITS) -> np.ndarray:
    """Where each of `ranges` equal parts of the hash space begins in the sorted hashes; ranges + 1 places."""
    borders = [-(-(i << bits) // ranges) for i in range(ranges)]
    return np.concatenate([np.searchsorted(sorted_hashes, np.array(borders, _U)), [len(sorted_hashes)]])
