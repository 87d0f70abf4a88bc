"""Whole groups of sorted Arrow batches, and components, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def group_starts(columns: list[pa.Array]) -> np.ndarray:
    """Whether each row differs from the one before it in any column; null equals null."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = False
        for c in columns:
            a, b = c.slice(0, n - 1), c.slice(1)
            differ = pc.fill_null(pc.not_equal(a, b), False)
            new[1:] |= np.asarray(pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False), bool)
    return new


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 100_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted batches put together so that no group of equal ``keys`` is cut, each with its groups' numbers.

    A batch has ``least`` rows or more, and no more than that, one incoming
    batch and one group together.
    """
    held: list[pa.RecordBatch] = []
    n, enough = 0, least

    def joined() -> tuple[pa.RecordBatch, np.ndarray]:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return batch, group_starts([batch.column(k) for k in keys])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        every, new = joined()
        cut = int(np.flatnonzero(new)[-1])
        if cut:
            yield every.slice(0, cut), np.cumsum(new[:cut]) - 1
        held, n = [every.slice(cut)], n - cut
        # a group without an end is put together anew only when it has doubled
        enough = max(least, 2 * n)
    if n:
        every, new = joined()
        yield every, np.cumsum(new) - 1


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes hangs together with by edges ``u``-``v``.

    Roots hook to the smallest root that an edge brings, and paths are cut short
    after each round, so long chains take few rounds.
    """
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            return label
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            short = label[label]
            if (short == label).all():
                break
            label = short


def near_points(group: np.ndarray, x: np.ndarray, y: np.ndarray, gap: float, most: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Links that join just those points of a group which chains of points less than ``gap`` apart join.

    Points are put into cells whose diagonal is less than ``gap``: a cell is a
    star around its first point, and two cells up to two steps apart need one
    near pair between them.  Work grows with the points of neighbouring cells,
    and at most about ``most`` pairs are in memory at once.
    """
    u, v = [], []
    fine = np.isfinite(x) & np.isfinite(y)
    side = gap / np.sqrt(2) * (1 - 1e-9)
    at = np.flatnonzero(fine)
    if not len(at) or gap <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cx, cy = np.floor(x[at] / side), np.floor(y[at] / side)
    ux, ix = np.unique(cx, return_inverse=True)
    uy, iy = np.unique(cy, return_inverse=True)
    key = (group[at].astype(np.int64) * len(ux) + ix) * len(uy) + iy
    # equal points of a cell count once in the tests between cells
    order = np.lexsort((y[at], x[at], key))
    at, key = at[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    cells = key[first]
    size = np.diff(np.append(first, len(key)))
    u.append(at)
    v.append(np.repeat(at[first], size))
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (x[at][1:] != x[at][:-1]) | (y[at][1:] != y[at][:-1])])
    at, key = at[fresh], key[fresh]
    first = np.searchsorted(key, cells)
    size = np.diff(np.append(first, len(key)))
    px, py = x[at], y[at]
    col, row = cells // len(uy) % len(ux), cells % len(uy)
    page = cells // (len(ux) * len(uy))
    for dx in range(3):
        for dy in range(-2, 3):
            if dx == 0 and dy <= 0:
                continue
            tx, ty = np.searchsorted(ux, ux[col] + dx), np.searchsorted(uy, uy[row] + dy)
            ok = (tx < len(ux)) & (ty < len(uy))
            ok[ok] = (ux[tx[ok]] == ux[col[ok]] + dx) & (uy[ty[ok]] == uy[row[ok]] + dy)
            want = (page * len(ux) + tx) * len(uy) + ty
            there = np.searchsorted(cells, want)
            ok &= there < len(cells)
            ok[ok] = cells[there[ok]] == want[ok]
            a, b = np.flatnonzero(ok), there[ok]
            pairs = size[a] * size[b]
            lo = 0
            upto = np.cumsum(pairs)
            while lo < len(a):
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, "right")))
                p, q = _first_near(a[lo:hi], b[lo:hi], first, size, px, py, gap, most)
                u.append(at[p])
                v.append(at[q])
                lo = hi
    return np.concatenate(u), np.concatenate(v)


def _first_near(a: np.ndarray, b: np.ndarray, first: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray, gap: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A near pair of points for each pair of cells that has one."""
    if len(a) == 1 and size[a[0]] * size[b[0]] > most:
        # a crowded pair of cells: only points near the other cell, the nearest first, a strip at a time
        own, other = (np.arange(first[c[0]], first[c[0]] + size[c[0]]) for c in (a, b))

        def beside(mine: np.ndarray, its: np.ndarray) -> np.ndarray:
            away = np.hypot(*(np.maximum(0, np.maximum(z[its].min() - z[mine], z[mine] - z[its].max())) for z in (x, y)))
            order = np.argsort(away, kind="stable")
            return mine[order][away[order] < gap]

        own, other = beside(own, other), beside(other, own)
        step = max(1, most // max(1, len(other)))
        for lo in range(0, len(own), step):
            part = own[lo : lo + step]
            i, j = np.nonzero(np.hypot(x[part, None] - x[None, other], y[part, None] - y[None, other]) < gap)
            if len(i):
                return part[i[:1]], other[j[:1]]
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = size[a] * size[b]
    which = np.repeat(np.arange(len(a)), pairs)
    k = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    p, q = first[a][which] + k // size[b][which], first[b][which] + k % size[b][which]
    hit = np.flatnonzero(np.hypot(x[p] - x[q], y[p] - y[q]) < gap)
    _, one = np.unique(which[hit], return_index=True)
    return p[hit[one]], q[hit[one]]
