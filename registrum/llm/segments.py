"""Segments of a text: runs of windows of one length that share a minimizer."""

from __future__ import annotations

import numpy as np

_random = np.random.default_rng(8)
BASE, MIX = (int(_random.integers(1, 1 << 63)) * 2 + 1 for _ in range(2))
POSITION = (1 << 24) - 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, "u8")
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


class Segmenter:
    """Cuts byte strings into segments.

    The minimizer of a window of `window` bytes is its `gram`-byte substring of the least hash, the first of equal
    ones. It depends on the window's bytes alone, so equal windows have equal minimizers in equal places, and
    windows whose minimizer is found once are found once.
    """

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram
        self.up = powers(BASE, 1 << 16)
        self.down = powers(pow(BASE, -1, 1 << 64), 1 << 16)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]

    def __call__(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of documents laid end to end in data, the ends given: first windows, numbers of windows, minimizers' places and hashes, and hashes
        of the bytes, of the segments. All places are in data, which has at most 2 ** 24 bytes."""
        n, w, g = len(data), self.window, self.gram
        none = np.zeros(0, "i8")
        if n < w:
            return none, none, none, np.zeros(0, "u8"), np.zeros(0, "u8")
        up, down = self._powers(n + 1)
        total = np.zeros(n + 1, "u8")
        np.cumsum((data.astype("u8") + np.uint64(1)) * up[:n], out=total[1:])
        h = (total[g:] - total[:-g]) * down[: n - g + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(MIX)
        h ^= h >> np.uint64(29)
        key = (h & ~np.uint64(POSITION)) | np.arange(len(h), dtype="u8")
        span, width = w - g + 1, 1
        low = key
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        at = (low & np.uint64(POSITION)).astype("i8")  # the minimizer of each window
        starts = np.concatenate([[0], ends[:-1]])
        bounds = np.zeros(n + 1, "i4")  # +1 where a document's windows begin, -1 after the last
        long = ends - starts >= w
        np.add.at(bounds, starts[long], 1)
        np.add.at(bounds, ends[long] - w + 1, -1)
        valid = np.cumsum(bounds[: len(at)]) > 0
        new = np.empty(len(at), bool)
        new[0] = True
        np.not_equal(at[1:], at[:-1], out=new[1:])
        new[1:] |= ~valid[:-1]
        new[starts[long]] = True
        first = np.flatnonzero(new & valid)
        stop = np.flatnonzero(valid & np.concatenate([(new | ~valid)[1:], [True]]))
        prints = (total[stop + w] - total[first]) * down[first]
        prints ^= prints >> np.uint64(31)
        prints *= np.uint64(MIX)
        return first, stop - first + 1, at[first], h[at[first]], prints ^ prints >> np.uint64(29)
