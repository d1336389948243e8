"""Index of grid points along the Hilbert curve, many points at once (Skilling 2004)."""

from __future__ import annotations

import numpy as np


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """``points``: one row per point, coordinates in [0, 2**bits); at most 62 bits in all."""
    n_dims = points.shape[1]
    if n_dims * bits > 62:
        raise ValueError("dimensions x bits must not exceed 62")
    axes = points.astype(np.int64).T.copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n_dims):
            high = (axes[i] & bit) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(high, low, swap)
            if i:
                axes[i] ^= swap
        bit >>= 1
    for i in range(1, n_dims):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(axes[-1] & bit, bit - 1, 0)
        bit >>= 1
    axes ^= turn
    index = np.zeros(axes.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n_dims):
            index = (index << 1) | ((axes[i] >> level) & 1)
    return index
