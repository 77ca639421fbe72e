"""Signature trees over sets: which pairs of a group can overlap enough.

A set's signature is a bitmap with the bit of every member set. Of two sets x and y, the bits of x that y lacks
each stand for a member y lacks, so |x & y| <= |x| - bits(x) + bits(x & y); the gap |x| - bits(x) is the set's
slack. A tree node holds the OR of its sets' bitmaps, their range of sizes, their greatest slack and the range of
their components; the same bound with these values holds for every pair of sets below two nodes. Traversal starts
with the pair (root, root) and goes down in pairs, dropping those whose largest possible overlap is too small for
the smallest sets below, whose sizes are too far apart, or whose sets are all in one component already.

The bitmaps have one width, so that they can be combined, and are full for large sets. Large sets therefore carry
counts, too: their members by hash bucket, as many buckets as their size asks for, each count modulo 16. Of two sets
the counts of a bucket differ by no less than they do modulo 16, and what they differ by is in one set alone; so
pairs of leaves that the bitmaps cannot tell apart are bounded once more by the sum of these differences.
"""

from __future__ import annotations

import numpy as np

BITS = 1024
COUNTED = 768  # members from which a set carries counts
FANOUT = 8
LEAF = 8


def signature(members: np.ndarray, width: int = BITS) -> bytes:
    """The bitmap of hashed members as width / 8 bytes."""
    bits = np.zeros(width, np.uint8)
    bits[(members >> np.uint64(11)).astype(np.int64) % width] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _buckets(n: int, percent: int) -> int:
    """A power of two: buckets of so few members that unrelated sets of n differ by more than linked ones may."""
    apart = 1 - 2 * percent / (100 + percent)
    return 1 << max(0, int(np.ceil(np.log2(n * max(apart, 0.01) / 1.4))))


def counts(members: np.ndarray, percent: int) -> bytes:
    """The members of a large set by bucket, modulo 16, two to a byte; nothing for other sets."""
    if len(members) < COUNTED:
        return b""
    size = max(2, _buckets(len(members), percent))
    bucket = ((members * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) & np.uint64(size - 1)
    nibbles = np.bincount(bucket.astype(np.int64), minlength=size).astype(np.uint8) & 15
    return (nibbles[0::2] | nibbles[1::2] << 4).tobytes()


def may_count(packed: list[bytes], sizes: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Pair by pair, whether the counts leave it. A set of more buckets is folded to those of the other."""
    keep = np.ones(len(i), bool)
    held = np.array([2 * len(p) for p in packed])
    both = np.minimum(held[i], held[j])
    for size in np.unique(both[both > 0]).tolist():
        at = np.flatnonzero(both == size)
        used = np.unique(np.r_[i[at], j[at]])
        rows = np.empty((len(used), size), np.uint8)
        for row, k in enumerate(used.tolist()):
            pairs = np.frombuffer(packed[k], np.uint8)
            rows[row] = np.stack([pairs & 15, pairs >> 4], 1).reshape(-1, size).sum(0, dtype=np.int64) & 15
        x, y = np.searchsorted(used, i[at]), np.searchsorted(used, j[at])
        step = max(1, (8 << 20) // size)
        for a in range(0, len(at), step):
            apart = (rows[x[a : a + step]] - rows[y[a : a + step]]) & 15
            differ = np.minimum(apart, 16 - apart).sum(1, dtype=np.int64)
            total = sizes[i[at[a : a + step]]] + sizes[j[at[a : a + step]]]
            # overlap <= (x + y - differ) / 2
            keep[at[a : a + step]] = (100 + percent) * (total - differ) >= 2 * percent * total
    return keep


def bitmaps(signatures: list[bytes], width: int = BITS) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), "<u8").reshape(len(signatures), width // 64)


def may_overlap(x: np.ndarray, y: np.ndarray, x_size: np.ndarray, y_size: np.ndarray, percent: int) -> np.ndarray:
    """Row by row, whether sets with these bitmaps and sizes can be similar enough."""
    count = lambda bits: np.bitwise_count(bits).sum(1, dtype=np.int64)
    overlap = np.minimum(x_size - count(x & ~y), y_size - count(y & ~x))
    return (100 + percent) * overlap >= percent * (x_size + y_size)


class Level:
    """The nodes of one level, as arrays. `reach` is the largest size of a set that a pair may have."""

    def __init__(self, bits, low, high, slack, comp_low, comp_high, sides):
        self.bits, self.low, self.high, self.slack, self.comp_low, self.comp_high, self.sides = bits, low, high, slack, comp_low, comp_high, sides

    def above(self, fanout: int) -> "Level":
        at = np.arange(0, len(self.low), fanout)
        return Level(
            np.bitwise_or.reduceat(self.bits, at), np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at), np.maximum.reduceat(self.slack, at),
            np.minimum.reduceat(self.comp_low, at), np.maximum.reduceat(self.comp_high, at), np.bitwise_or.reduceat(self.sides, at),
        )

    def possible(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether nodes i and j can hold a pair with 100 * overlap >= percent * union."""
        keep = (100 * np.minimum(self.high[i], self.high[j]) >= percent * np.maximum(self.low[i], self.low[j]))
        keep &= ~((self.comp_low[i] == self.comp_high[i]) & (self.comp_low[j] == self.comp_high[j]) & (self.comp_low[i] == self.comp_low[j]))
        keep &= ((self.sides[i] | self.sides[j]) & 3 == 3) | (self.sides[i] & self.sides[j] & 4 > 0)
        at = np.flatnonzero(keep)
        a, b = i[at], j[at]
        shared = np.bitwise_count(self.bits[a] & self.bits[b]).sum(1, dtype=np.int64)
        overlap = np.minimum(np.minimum(self.slack[a], self.slack[b]) + shared, np.minimum(self.high[a], self.high[b]))
        # 100 o >= p (x + y - o)  <=>  (100 + p) o >= p (x + y)
        keep[at] = (100 + percent) * overlap >= percent * (self.low[a] + self.low[b])
        return keep


def overlapping_pairs(bits: np.ndarray, sizes: np.ndarray, comps: np.ndarray, sides: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j in the order given) that the bounds leave. sides: 1 and 2 pair with each other only, 4 with 4."""
    order = np.lexsort((bits[:, 0], comps, sizes))
    leaf = bits[order]
    counts = np.bitwise_count(leaf).sum(1, dtype=np.int64)
    levels = [Level(leaf, sizes[order], sizes[order], sizes[order] - counts, comps[order], comps[order], sides[order])]
    while len(levels[-1].low) > LEAF:
        levels.append(levels[-1].above(FANOUT))
    n = len(levels[-1].low)
    i, j = np.triu_indices(n)
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        keep = np.concatenate([level.possible(i[a : a + 100_000], j[a : a + 100_000], percent) for a in range(0, len(i), 100_000)] or [np.zeros(0, bool)])
        i, j = i[keep], j[keep]
        if depth:
            below = len(levels[depth - 1].low)
            ci = (i[:, None] * FANOUT + np.arange(FANOUT)[None, :])[:, :, None]
            cj = (j[:, None] * FANOUT + np.arange(FANOUT)[None, :])[:, None, :]
            ci, cj = (x.reshape(-1) for x in np.broadcast_arrays(ci, cj))
            ok = (ci <= cj) & (cj < below) & (ci < below)
            i, j = ci[ok], cj[ok]
    distinct = i < j
    a, b = order[i[distinct]], order[j[distinct]]
    return np.minimum(a, b), np.maximum(a, b)
