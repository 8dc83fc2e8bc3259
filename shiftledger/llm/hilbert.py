"""Hilbert keys of points, as integers of at most 62 bits."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of ``cells`` (n x d, values below ``2 ** bits``) on the curve.

    Skilling's transform from axes to transposed key, on all points at once.
    """
    axes = cells.astype(np.int64).T.copy()
    d = len(axes)
    if d * bits > 62:
        raise ValueError("a key has at most 62 bits")
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in axes:
            far = (axis >> level) & 1 == 1
            swapped = np.where(far, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(far, low, swapped)
            if axis is not axes[0]:
                axis ^= swapped
    for i in range(1, d):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    axes ^= turn
    keys = np.zeros(axes.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << 1) | ((axis >> level) & 1)
    return keys
