"""Rolling order statistics of a series from sorted blocks: no row carries its window."""

from __future__ import annotations

import numpy as np

#: Values in a sorted block.
BLOCK = 64


def counts_in_window(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each value how many of the last ``n`` values (itself included) are less, equal, and present; NaN is missing.

    Blocks that lie in a window whole are searched by bisection, for all windows that hold them at once; at either end of a
    window less than a block of values is compared one by one. So a row costs n / BLOCK bisections and at most two blocks.
    """
    m, n = len(x), max(int(n), 1)
    less, same = np.zeros(m, np.int64), np.zeros(m, np.int64)
    there = ~np.isnan(x)
    upto = np.r_[0, np.cumsum(there)]
    first = np.maximum(np.arange(m) - n + 1, 0)
    present = upto[1:] - upto[first]
    filled = np.where(there, x, np.inf)  # sorts last, equals no value that is there
    whole = 0
    for lo in range(0, m - BLOCK + 1, BLOCK):
        # Rows from the end of the block to the last one whose window starts at or before it.
        rows = slice(lo + BLOCK - 1, min(lo + n, m))
        if rows.start < rows.stop:
            block = np.sort(filled[lo : lo + BLOCK])
            left = np.searchsorted(block, x[rows], side="left")
            less[rows] += left
            same[rows] += np.searchsorted(block, x[rows], side="right") - left
            whole += 1
    row = np.arange(m)
    # Values between the start of a window and its first whole block, and between its last whole block and its end.
    head_end = np.minimum(-(-first // BLOCK) * BLOCK, row + 1)
    tail = np.maximum((row + 1) // BLOCK * BLOCK, head_end)
    for start, end in ((first, head_end), (tail, row + 1)):
        for k in range(int((end - start).max(initial=0))):
            at = start + k
            use = at < end
            v, own = filled[np.minimum(at, m - 1)], x
            less += use & (v < own)
            same += use & (v == own)
    return less, same, present


def rank_in_window(x: np.ndarray, n: int, least: int) -> np.ndarray:
    """Average rank (from 1) of each value among those of its window, where it holds enough of them."""
    less, same, present = counts_in_window(x, n)
    return np.where(~np.isnan(x) & (present >= least), less + (same + 1) / 2, np.nan)


def share_at_least(x: np.ndarray, n: int, least: int) -> np.ndarray:
    """Share of the values of the window that are at least as large as its last one."""
    less, _, present = counts_in_window(x, n)
    return np.where(~np.isnan(x) & (present >= least), (present - less) / np.maximum(present, 1), np.nan)
