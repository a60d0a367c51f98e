"""The E8 lattice: nearest points and neighbouring cells, for many points at once."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np

from stockflow.llm.words import mix


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: where a cell's neighbours lie."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


ROOTS = _roots()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum: the coordinate that rounds worst gives way if the sum is odd."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the better one of D8 and of D8 moved by a half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def names(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name of each lattice point."""
    h = np.full(len(points), salt, np.uint64)
    for column in (2 * points).astype(np.int64).T:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return h.view(np.int64)


def cells(x: np.ndarray, probes: int, salt: int) -> np.ndarray:
    """Names of each row's own cell and of its `probes` nearest neighbouring cells, own cell first."""
    home = nearest(x)
    order = np.argpartition(-((x - home) @ ROOTS.T), probes, axis=1)[:, :probes] if probes else np.zeros((len(x), 0), int)
    return np.stack([names(home, salt), *[names(home + ROOTS[order[:, k]], salt) for k in range(probes)]], axis=1)
