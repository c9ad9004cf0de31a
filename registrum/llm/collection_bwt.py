"""The Burrows-Wheeler transform of a collection of strings and its common prefixes, built column by column."""

from __future__ import annotations

import os
import tempfile

import numpy as np


class Columns:
    """The arrays that a round reads and the next one replaces. Above `limit` bytes they are files, written and read from front to back."""

    def __init__(self, limit: int):
        self.limit, self.files = limit, []
        self.folder: tempfile.TemporaryDirectory | None = None

    def hold(self, x: np.ndarray) -> np.ndarray:
        if x.nbytes < self.limit:
            return x
        self.folder = self.folder or tempfile.TemporaryDirectory()
        at = os.path.join(self.folder.name, str(len(self.files)))
        x.tofile(at)
        self.files.append(at)
        return np.memmap(at, x.dtype, "r")

    def drop(self, *old: np.ndarray) -> None:
        for x in old:
            if isinstance(x, np.memmap):
                os.unlink(x.filename)

    def close(self) -> None:
        if self.folder:
            self.folder.cleanup()


def least_between(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(x[low + 1 .. high]) for each pair."""
    order = np.argsort(-low, kind="stable")
    at = np.stack([low[order] + 1, high[order] + 1], 1).ravel()
    got = np.minimum.reduceat(np.append(x, x.dtype.type(0)), at)[::2]
    out = np.empty(len(low), x.dtype)
    out[order] = got
    return out


def build(strings: list[bytes], limit: int = 64 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(transform, prefixes, owners, lengths) of all suffixes of strings, in order; symbols count from 1 and 0 is the end.

    Every round inserts one suffix per string, longer by one symbol than the last. A suffix goes
    behind those that begin with a lesser symbol and those of its symbol that extend a lesser suffix: its place is the rank of its symbol's
    occurrence in the transform so far. Its common prefix with the one before is one more than the least of the common prefixes
    between the two extended suffixes. Equal strings are in the order given.
    """
    m = len(strings)
    sizes = np.array([len(s) for s in strings], "i4")
    flat = np.frombuffer(b"".join(strings), "u1")
    ends = np.cumsum(sizes)
    store = Columns(limit)

    kind = "u1" if not len(flat) or flat.max() < 255 else "u2"  # a byte is sorted in one pass
    coded = flat.astype(kind) + np.dtype(kind).type(1)

    def symbols(who: np.ndarray, length: int) -> np.ndarray:
        """The symbol before the suffix of the length."""
        out = np.zeros(len(who), kind)
        left = sizes[who] > length
        out[left] = coded[ends[who[left]] - 1 - length]
        return out

    who = np.arange(m, dtype="i8") << 32  # with the suffix's length in the low half
    lcp = np.zeros(m, "i4")
    bwt = symbols(who >> 32, 0)
    at = np.flatnonzero(bwt)  # the last inserted suffixes that go on
    n, length = m, 0
    while len(at):
        length += 1
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(n, "i4")
        rank[order] = np.arange(n, dtype="i4")
        ended = n - np.count_nonzero(bwt)
        mine = rank[at]
        new = m + mine - ended
        owner = who[at] >> 32
        # Common prefixes with the neighbours that have the same symbol.
        before = order[np.maximum(mine - 1, 0)]
        same = (mine > 0) & (bwt[before] == bwt[at])
        own = np.zeros(len(at), "i4")
        own[same] = least_between(lcp, before[same], at[same]) + 1
        after = order[np.minimum(mine + 1, n - 1)]
        follows = (mine + 1 < n) & (bwt[after] == bwt[at])
        next_lcp = least_between(lcp, at[follows], after[follows]) + 1
        total = n + len(at)
        old = np.ones(total, bool)
        old[new] = False
        by_place = np.argsort(new, kind="stable")
        place = new[by_place]

        def merged(values: np.ndarray, added: np.ndarray, total=total, old=old, place=place) -> np.ndarray:
            out = np.empty(total, values.dtype)
            out[old] = values
            out[place] = added
            return out

        held = bwt, lcp, who
        lcp2 = merged(lcp, own[by_place])
        lcp2[new[follows] + 1] = next_lcp
        ends_next = (new + 1 < total) & ~follows
        lcp2[new[ends_next] + 1] = 0
        bwt, lcp, who = (store.hold(x) for x in (merged(bwt, symbols(owner[by_place], length)), lcp2, merged(who, owner[by_place] << 32 | length)))
        store.drop(*held)
        at = place[np.asarray(bwt)[place] > 0]
        n = total
    out = np.array(bwt), np.array(lcp), np.asarray(who) >> 32, np.asarray(who) & (1 << 32) - 1
    store.close()
    return out
