"""Order of points along a Hilbert curve."""

from __future__ import annotations

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of every row of ``points`` (integers below ``2 ** bits``) on the curve.

    Rows have at most 63 bits in all. Each bit plane, from the highest, is turned and reflected so that
    the sub-cube is entered where the one before is left; the planes are then read as a Gray code.
    """
    axes = points.T.astype(np.int64).copy()
    count = len(axes)
    if not count:
        return np.zeros(len(points), np.int64)
    for bit in range(bits - 1, 0, -1):
        half, below = 1 << bit, (1 << bit) - 1
        for k in range(count):
            is_set = (axes[k] & half) > 0
            swap = np.where(is_set, 0, (axes[0] ^ axes[k]) & below)
            axes[0] = np.where(is_set, axes[0] ^ below, axes[0]) ^ swap
            axes[k] ^= swap
    for k in range(1, count):
        axes[k] ^= axes[k - 1]
    turn = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn = np.where(axes[-1] & (1 << bit), turn ^ ((1 << bit) - 1), turn)
    axes ^= turn
    keys = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(count):
            keys = keys << 1 | axes[k] >> bit & 1
    return keys
