"""Space cut into regions of about equally many vectors, for use inside tasks."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Tasks get this code with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Entries beyond this count as this when the spread of a sample is measured.
_FAR = 1e100
# Room for the rounding of a squared distance, as a share of it.
_ROUNDING = 1e-9


class Regions:
    """Halves of a sample by the entry that spreads most, again and again, down to ``rows`` vectors of the sample.

    Equal vectors are always in one region, however many they are. Nodes of the tree are
    numbered before their halves, regions in the order of their nodes.
    """

    def __init__(self, sample: np.ndarray, rows: int):
        # Per node: the entry it is cut by, where, the nodes of the halves, and the region of one that is not cut.
        self.entry, self.at, self.halves, self.region = [], [], [], []
        self.width, self.n_regions = sample.shape[1], 0
        waiting = [(np.arange(len(sample)), None)]
        while waiting:
            own, parent = waiting.pop()
            node, cut = len(self.entry), _cut(sample[own], rows)
            if parent is not None:
                self.halves[parent[0]][parent[1]] = node
            entry, at = cut or (-1, 0.0)
            self.entry.append(entry)
            self.at.append(at)
            self.halves.append([-1, -1])
            self.region.append(-1 if cut else self.n_regions)
            if cut:
                low = sample[own, entry] <= at
                waiting += [(own[~low], (node, 1)), (own[low], (node, 0))]
            else:
                self.n_regions += 1
        self.low = self.high = None

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The region of every vector."""
        if len(vectors) and vectors.shape[1] != self.width:
            raise ValueError("vectors must be of one length")
        found, waiting = np.empty(len(vectors), np.int32), [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            if self.entry[node] < 0:
                found[rows] = self.region[node]
                continue
            low = vectors[rows, self.entry[node]] <= self.at[node]
            waiting += [(half, part) for half, part in zip(self.halves[node], (rows[low], rows[~low]))]
        return found

    def set_boxes(self, low: np.ndarray, high: np.ndarray) -> None:
        """Smallest and largest entries of the members of every region, and of the regions below each node."""
        nodes = len(self.entry)
        self.low, self.high = np.full((nodes, self.width), np.inf), np.full((nodes, self.width), -np.inf)
        for node in reversed(range(nodes)):
            if self.entry[node] < 0:
                self.low[node], self.high[node] = low[self.region[node]], high[self.region[node]]
            else:
                one, two = self.halves[node]
                self.low[node] = np.minimum(self.low[one], self.low[two])
                self.high[node] = np.maximum(self.high[one], self.high[two])

    def visits(self, vectors: np.ndarray, own: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and regions, in the order of the rows: those other than its own that may have members within a vector's bound."""
        with np.errstate(over="ignore"):
            most = bound**2 * (1 + _ROUNDING)
        at, found, waiting = [], [], [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            part = vectors[rows]
            with np.errstate(invalid="ignore", over="ignore"):
                gap = np.maximum(0.0, np.maximum(self.low[node] - part, part - self.high[node]))
                rows = rows[~((gap**2).sum(axis=1) > most[rows])]
            if self.entry[node] < 0:
                rows = rows[own[rows] != self.region[node]]
                at.append(rows)
                found.append(np.full(len(rows), self.region[node], np.int32))
            elif len(rows):
                waiting += [(half, rows) for half in self.halves[node]]
        at, found = (np.concatenate(x) if x else np.empty(0, np.int32) for x in (at, found))
        order = np.argsort(at, kind="stable")
        return at[order], found[order]


def _cut(part: np.ndarray, rows: int) -> tuple[int, float] | None:
    """The entry that spreads most, and the value up to which vectors are in the first half; None for few or equal vectors."""
    if len(part) <= rows:
        return None
    spread = np.where(part.max(axis=0) > part.min(axis=0), np.clip(part, -_FAR, _FAR).std(axis=0) + np.finfo(float).tiny, 0.0)
    if not spread.any():
        return None
    entry = int(np.argmax(spread))
    values, half = part[:, entry], len(part) // 2
    middle = np.partition(values, half)[half]
    upto, below = np.count_nonzero(values <= middle), np.count_nonzero(values < middle)
    # Values as the middle one are many in a row of zeros: they go where the halves are more even.
    if upto < len(part) and (not below or abs(upto - half) <= abs(below - half)):
        return entry, float(middle)
    return entry, float(values[values < middle].max())


def boxes(vectors: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The regions that have some of the vectors; how many, their smallest and their largest entries."""
    order = np.argsort(region, kind="stable")
    found, starts = np.unique(region[order], return_index=True)
    if not len(found):
        return found, starts, vectors, vectors
    part = vectors[order]
    counts = np.diff([*starts, len(order)])
    return found, counts, np.minimum.reduceat(part, starts, axis=0), np.maximum.reduceat(part, starts, axis=0)
