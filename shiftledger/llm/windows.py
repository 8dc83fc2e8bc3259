"""Windows of a sequence, and the runs of windows that share an anchor.

The anchor of a window is the smallest hash of the k-grams in it.  It depends on
the window's content alone, so equal windows have equal anchors wherever they
are.  Neighbouring windows mostly share theirs; a run of them is kept as one row.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: An odd multiplier and what undoes it, modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)


#: Up to this many powers are kept.
_KEPT = 1 << 16


def _computed(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _kept(base: int, n: int) -> np.ndarray:
    out = _computed(base, n)
    out.flags.writeable = False
    return out


def _powers(base: int, n: int) -> np.ndarray:
    if n > _KEPT:
        return _computed(base, n)
    return _kept(base, 1 << max(12, n.bit_length()))[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """For ``span_hashes``: sums of values times powers of the base."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, undo: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hashes of the values from ``low`` to before ``high``, equal for equal values."""
    return mixed((sums[high] - sums[low]) * undo[low])


def undo_powers(n: int) -> np.ndarray:
    return _powers(_UNDO, n)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


class Windows:
    """Windows of ``length`` values, with ``gram`` values to a k-gram."""

    def __init__(self, values: np.ndarray, length: int, gram: int) -> None:
        self.length = length
        self.count = max(0, len(values) - length + 1)
        if not self.count:
            return
        self._sums, self._undo = prefix_sums(values), undo_powers(len(values))
        at = np.arange(len(values) - gram + 1)
        grams = span_hashes(self._sums, self._undo, at, at + gram)
        self.anchors = sliding_least(grams, length - gram + 1)

    def hashes(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """Hashes of windows ``low`` to before ``high``."""
        at = np.arange(low, self.count if high is None else high)
        return span_hashes(self._sums, self._undo, at, at + self.length)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, content hash, first window and number of windows of each run."""
        start = np.flatnonzero(np.concatenate([[True], self.anchors[1:] != self.anchors[:-1]]))
        size = np.diff(np.append(start, self.count))
        content = span_hashes(self._sums, self._undo, start, start + size + self.length - 1)
        return self.anchors[start], content, start, size

    def repeated(self) -> np.ndarray:
        """Whether each window occurs more than once in this sequence."""
        hashes = self.hashes()
        order = np.argsort(hashes)
        same = hashes[order][1:] == hashes[order][:-1]
        out = np.zeros(self.count, bool)
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
        return out


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and number of each maximal run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - edges[::2]


def covered(length: int, starts: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Which of ``length`` values the windows from ``starts`` on cover; ``sizes`` counts windows."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + sizes + window - 1, -1)
    return np.cumsum(change[:-1]) > 0
