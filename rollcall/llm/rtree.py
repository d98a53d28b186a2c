"""A packed R-tree over count vectors, for joining points by an upper bound of set overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 64
#: Groups that shingles are hashed to: a power of two, so that finer vectors fold to coarser ones. Chance alone brings sets of many shingles a group close to the bound.
GROUPS, MOST_GROUPS, PER_GROUP = 128, 8192, 8
#: Counts that one matrix of vectors may hold; vectors are folded until it does.
MATRIX = 1 << 23
#: Types of counts, by their bytes.
COUNTS = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def groups_of(size: int) -> int:
    """Groups for a set of ``size`` shingles: PER_GROUP of them in each, or fewer."""
    return min(MOST_GROUPS, max(GROUPS, 1 << int(max(size - 1, 0) // PER_GROUP).bit_length()))


def count_vector(hashes: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Exact group counts, two bytes a count where all fit."""
    counts = np.bincount((hashes >> np.uint64(32)).astype(np.int64) % groups, minlength=groups)
    return counts.astype(np.uint16 if counts.max(initial=0) < 1 << 16 else np.uint32)


def packed_counts(counts: np.ndarray) -> bytes:
    """A count vector as bytes, one byte a count where all fit, after the number of these bytes."""
    counts = counts.astype(np.uint8) if counts.max(initial=0) < 256 else counts
    return bytes([counts.itemsize]) + counts.tobytes()


def packed_groups(vectors) -> np.ndarray:
    """The numbers of groups of packed vectors."""
    return np.array([(len(v) - 1) // v[0] for v in vectors], int)


def unpacked_counts(vectors, groups: int | None = None) -> np.ndarray:
    """Packed vectors as rows of one matrix, folded to ``groups`` groups, or to those of the coarsest."""
    own = packed_groups(vectors)
    groups = groups or int(own.min(initial=MOST_GROUPS if len(own) else GROUPS))
    width = np.array([v[0] for v in vectors], int)
    out = np.empty((len(own), groups), np.uint32)
    for w, g in {*zip(width.tolist(), own.tolist())}:
        these = (width == w) & (own == g)
        counts = np.frombuffer(b"".join(v[1:] for v, x in zip(vectors, these) if x), COUNTS[w])
        out[these] = counts.reshape(-1, g) if g == groups else counts.reshape(-1, g // groups, groups).sum(1)
    return out


def overlaps(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sum of coordinate minima of each row of ``left`` with each of ``right``."""
    step = max(1, LEAF * LEAF * GROUPS // right.size)
    return np.concatenate([np.minimum(left[k : k + step, None, :], right[None, :, :]).sum(2) for k in range(0, len(left), step)])


class Sets:
    """Count vectors of shingle sets (with the sets, if pairs are to be verified), and the classes that links have made of them."""

    def __init__(self, sizes: np.ndarray, counts: np.ndarray, classes: np.ndarray, num: int, den: int, sets: list[np.ndarray] | None = None) -> None:
        self.sets, self.num, self.den = sets, num, den
        self.sizes, self.counts = sizes, counts.astype(np.int32)
        self.parent = np.asarray(classes).copy()  # by class number; numbers are at most len(sizes) - 1

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def linked(self, i: int, j: int) -> bool:
        if self.sets is None:  # no sets to verify with: the bound decides
            return True
        both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        return self.den * both >= self.num * (self.sizes[i] + self.sizes[j] - both)


class Tree:
    """Leaves of LEAF points, sorted by size and tiled by the coordinate that varies most; a level of boxes above."""

    def __init__(self, data: Sets, points: np.ndarray) -> None:
        order = points[np.argsort(data.sizes[points], kind="stable")]
        slab = LEAF * max(1, int(np.sqrt(len(order) / LEAF)))
        tiles = []
        for a in range(0, len(order), slab):
            part = order[a : a + slab]
            axis = int(np.argmax(data.counts[part].var(0)))
            tiles.append(part[np.argsort(data.counts[part, axis], kind="stable")])
        order = np.concatenate(tiles)
        self.leaves = [order[a : a + LEAF] for a in range(0, len(order), LEAF)]
        self.high = np.stack([data.counts[x].max(0) for x in self.leaves])
        self.least = np.array([data.sizes[x].min() for x in self.leaves])
        self.most = np.array([data.sizes[x].max() for x in self.leaves])


def enough(data: Sets, bound, small, large):
    """Whether an overlap of ``bound`` at most can link sets of these sizes or larger ones."""
    return bound * (data.num + data.den) >= data.num * (small + large)


def join(data: Sets, left: Tree, right: Tree) -> Iterator[tuple[int, int]]:
    """Links that join classes (verified), until all linked points of the two trees are of one class.

    Boxes and then points are bounded by the sum of coordinate minima; pairs of one class are passed over, whole leaves at once.
    """
    same = left is right
    for x, a in enumerate(left.leaves):
        bound = np.minimum(left.high[x], right.high).sum(1)
        near = enough(data, bound, left.least[x], right.least)
        near &= (data.den * left.most[x] >= data.num * right.least) & (data.den * right.most >= data.num * left.least[x])
        for y in np.flatnonzero(near):
            if same and y < x:
                continue
            b = right.leaves[y]
            ra, rb = np.array([data.root(i) for i in a]), np.array([data.root(i) for i in b])
            if ra[0] == rb[0] and (ra == ra[0]).all() and (rb == rb[0]).all():
                continue
            hit = enough(data, overlaps(data.counts[a], data.counts[b]), data.sizes[a][:, None], data.sizes[b][None, :]) & (ra[:, None] != rb[None, :])
            for i, j in zip(*np.nonzero(hit)):
                i, j = a[i], b[j]
                ri, rj = data.root(i), data.root(j)
                if ri != rj and data.linked(i, j):
                    data.parent[max(ri, rj)] = min(ri, rj)
                    yield int(i), int(j)
