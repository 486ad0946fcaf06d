"""Union of links inside one task."""

from __future__ import annotations

import numpy as np


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest member of each of `size` nodes' component under the links a[i] - b[i]."""
    root = np.arange(size)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        if not len(a):
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root
