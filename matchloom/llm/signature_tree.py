"""Signature trees over sets of 64-bit hashes, joined by dual traversal.

A leaf holds a few sets; a node holds the OR of its sets' token bitmaps, its range of set sizes
and the most tokens by which a set exceeds its bitmap. For a pair of nodes, no two sets can share
more than min(excess) + popcount(OR & OR) tokens; where that, or the size ranges, can't reach the
threshold the pair is pruned. Sets already known to be connected aren't compared again.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
LEAF = 8


class SignatureTree:
    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        first = np.array([s[0] if len(s) else 0 for s in sets], U)
        self.order = np.lexsort((first, self.sizes))
        self.sets = [sets[i] for i in self.order]
        self.sizes = self.sizes[self.order]
        self.maps = np.zeros((len(sets), bits // 64), U)
        shift = U(64 - (bits.bit_length() - 1))
        for i, s in enumerate(self.sets):
            b = (s >> shift).astype(np.int64)
            np.bitwise_or.at(self.maps[i], b >> 6, U(1) << (b & 63).astype(U))
        self.excess = self.sizes - np.bitwise_count(self.maps).sum(1, dtype=np.int64)
        #: levels[0] are leaves; each node: first and last set, OR, smallest and largest size, excess
        self.levels: list[list[tuple[int, int, np.ndarray, int, int, int]]] = []
        spans = [(i, min(i + LEAF, len(sets))) for i in range(0, len(sets), LEAF)]
        while spans:
            self.levels.append([(a, b, np.bitwise_or.reduce(self.maps[a:b], 0), int(self.sizes[a:b].min()), int(self.sizes[a:b].max()), int(self.excess[a:b].max())) for a, b in spans])
            if len(spans) == 1:
                break
            spans = [(spans[i][0], spans[min(i + 3, len(spans) - 1)][1]) for i in range(0, len(spans), 4)]

    def children(self, level: int, i: int) -> range:
        return range(4 * i, min(4 * i + 4, len(self.levels[level - 1])))


def _bits_for(sets: list[np.ndarray]) -> int:
    """Eight bits a token of the largest set, within 32 MB for all bitmaps."""
    want = 1 << (8 * max((len(s) for s in sets), default=1) - 1).bit_length()
    room = 1 << ((1 << 28) // max(1, len(sets))).bit_length() - 1
    return max(256, min(1 << 16, want, room))


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * |a & b| >= num * |a | b|, for sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or den * len(a) < num * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return den * both >= num * (len(a) + len(b) - both)


def tree_links(left: list[np.ndarray], labels: np.ndarray, num: int, den: int, right: list[np.ndarray] | None = None, right_labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what isn't connected yet; indices into left, and left or right.

    ``labels`` name the known components (equal label: connected). The links, with the labels,
    have the same components as all links would.
    """
    own = right is None
    bits = _bits_for(left if own else [*left, *right])
    x = SignatureTree(left, bits)
    y = x if own else SignatureTree(right, bits)
    names, dense = np.unique(labels if own else np.concatenate([labels, right_labels]), return_inverse=True)
    lx = dense[: len(left)][x.order]
    ly = lx if own else dense[len(left) :][y.order]
    found: list[tuple[int, int]] = []
    top = (len(x.levels) - 1, 0, len(y.levels) - 1, 0)
    stack = [top] if x.levels and y.levels else []
    while stack:
        p, i, q, j = stack.pop()
        a, b, ora, mina, maxa, exa = x.levels[p][i]
        c, d, orb, minb, maxb, exb = y.levels[q][j]
        if den * maxa < num * minb or den * maxb < num * mina:
            continue
        la, lb = lx[a:b], ly[c:d]
        if la[0] == lb[0] and (la == la[0]).all() and (lb == lb[0]).all():
            continue
        same = own and p == q and i == j
        if not same:
            need = -(-num * (mina + minb) // (num + den))
            if min(exa, exb) + int(np.bitwise_count(ora & orb).sum()) < need:
                continue
        if p or q:
            if p >= q and p:
                kids = [(p - 1, k, q, j) for k in x.children(p, i)]
            else:
                kids = [(p, i, q - 1, k) for k in y.children(q, j)]
            if same:
                kids = [(p - 1, k, p - 1, m) for k in x.children(p, i) for m in x.children(p, i) if k <= m]
                kids.sort(key=lambda t: t[3] - t[1], reverse=True)
            elif own and p != q:
                kids = [t for t in kids if _before(x, t)]
            stack.extend(kids)
            continue
        for s in range(a, b):
            for t in range(max(c, s + 1) if own else c, d):
                if lx[s] == ly[t]:
                    continue
                na, nb = int(x.sizes[s]), int(y.sizes[t])
                need = -(-num * (na + nb) // (num + den))
                if na - int(np.bitwise_count(x.maps[s] & ~y.maps[t]).sum()) < need:
                    continue
                if linked(x.sets[s], y.sets[t], num, den):
                    found.append((int(x.order[s]), int(y.order[t])))
                    old, new = ly[t], lx[s]
                    lx[lx == old] = new
                    if not own:
                        ly[ly == old] = new
    return found


def _before(tree: SignatureTree, t: tuple[int, int, int, int]) -> bool:
    """Of a tree with itself: the pair isn't wholly below the diagonal."""
    return tree.levels[t[0]][t[1]][0] < tree.levels[t[2]][t[3]][1]
