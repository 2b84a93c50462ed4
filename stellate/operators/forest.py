"""Spanning forests of edge sets inside tasks, as Arrow functions.

A task that holds a bounded number of edges can say at once which of them
matter for the components: a spanning forest (n vertices need at most n - 1
edges).  Moving forests instead of edges is what keeps the iterative jobs
small.  The functions are shipped by value: executors need no copy of this
package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ArrowFn = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


# ---------------------------------------------------------- unweighted edges
def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every vertex that is not the least of its component, with the least
    one; a vertex alone (self-loops only) with itself.  Labels travel along
    the edges and jump over their own labels until nothing changes."""
    ids, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    # Places are 32 bits wide, which halves what a task holds.
    at = at.astype(np.int32)
    a, b = at[:len(u)], at[len(u):]
    p = np.arange(len(ids), dtype=np.int32)
    while True:
        x, y = p[a], p[b]
        low = np.minimum(x, y)
        q = p.copy()
        np.minimum.at(q, x, low)
        np.minimum.at(q, y, low)
        while True:
            r = q[q]
            if (r == q).all():
                break
            q = r
        if (q == p).all():
            break
        p = q
        live = p[a] != p[b]  # ends that have met stay together
        a, b = a[live], b[live]
    rows = (p != np.arange(len(ids))) | (np.bincount(p, minlength=len(ids)) == 1)
    return ids[rows], ids[p[rows]]


def star_forest(limit: int = 1 << 19) -> ArrowFn:
    """Rows ``(u, v)`` of a partition -> stars with the same components.

    Edges are taken together up to ``limit`` rows; the stars found so far go
    on into the next lot as long as they fill at most half of it, so a
    partition whose vertices fit gives each vertex once.
    """
    def out(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us: list[np.ndarray] = []
        vs: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for at in range(0, len(batch), limit):
                part = batch.slice(at, limit)
                us.append(part.column(0).to_numpy())
                vs.append(part.column(1).to_numpy())
                held += len(part)
                if held < limit:
                    continue
                u, v = _stars(np.concatenate(us), np.concatenate(vs))
                us, vs, held = [u], [v], len(u)
                if held > limit // 2:
                    yield out(u, v)
                    us, vs, held = [], [], 0
        if held:
            yield out(*_stars(np.concatenate(us), np.concatenate(vs)))

    return run


# ------------------------------------------------------------ weighted edges
class _Merging:
    """Union-find over vertices that come one by one."""

    def __init__(self) -> None:
        self.at: dict[int, int] = {}
        self.parent: list[int] = []
        self.changed = True
        self.ids = self.labels = np.zeros(0, np.int64)

    def find(self, v: int) -> int:
        i = self.at.get(v)
        if i is None:
            i = self.at[v] = len(self.parent)
            self.parent.append(i)
            self.changed = True
        p = self.parent
        while p[i] != i:
            p[i] = i = p[p[i]]
        return i

    def link(self, u: int, v: int) -> bool:
        """Whether the edge joins two components (a forest edge)."""
        a, b = self.find(u), self.find(v)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.changed = True
        return True

    def labelled(self) -> tuple[np.ndarray, np.ndarray]:
        """All vertices so far and the least vertex of each one's component."""
        if self.changed:
            self.ids = np.fromiter(self.at, np.int64, len(self.at))
            p = np.array(self.parent, np.int64)
            while True:
                r = p[p]
                if (r == p).all():
                    break
                p = r
            low = np.full(len(p), np.iinfo(np.int64).max)
            np.minimum.at(low, p, self.ids)
            self.labels, self.changed = low[p], False
        return self.ids, self.labels


def weighted_forest() -> ArrowFn:
    """Rows ``(group, chunk, w, u, v)``, sorted by these -> the rows of a
    minimum spanning forest of every (group, chunk)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, merging = None, _Merging()
        for batch in batches:
            group, chunk, w, u, v = (c.to_pylist() for c in batch.columns)
            keep = []
            for i, k in enumerate(zip(group, chunk)):
                if k != key:
                    key, merging = k, _Merging()
                if merging.link(u[i], v[i]) or u[i] == v[i]:
                    keep.append(i)
            if keep:
                yield pa.RecordBatch.from_arrays([c.take(pa.array(keep)) for c in batch.columns],
                                                 names=["group", "chunk", "w", "u", "v"])

    return run


def snapshot_labels(rows_out: int = 1 << 16) -> ArrowFn:
    """Rows ``(group, slice, w, u, v, snapshot)``, sorted by group, slice, w
    and edges (``snapshot`` null) before snapshots -> ``(group, snapshot, id,
    cmp)``: for every snapshot the components of the edges before it."""
    names = ["group", "snapshot", "id", "cmp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, merging = None, _Merging()
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            groups, snaps, ids, labels = zip(*out)
            n = [len(x) for x in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(c, np.int64), n)) for c in (groups, snaps)]
                + [pa.array(np.concatenate(c)) for c in (ids, labels)], names=names)

        for batch in batches:
            for g, part, _, u, v, snap in zip(*(c.to_pylist() for c in batch.columns)):
                if (g, part) != key:
                    key, merging = (g, part), _Merging()
                if snap is None:
                    merging.link(u, v)
                    continue
                ids, labels = merging.labelled()
                for at in range(0, len(ids), rows_out):
                    out.append((g, snap, ids[at:at + rows_out], labels[at:at + rows_out]))
                    held += len(out[-1][2])
                    if held >= rows_out:
                        yield flush()
                        out, held = [], 0
        if out:
            yield flush()

    return run
