"""k nearest vectors inside one task."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Tasks get this code with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOUND = pa.schema([("query_id", pa.int64()), ("neighbor_id", pa.int64()), ("dist", pa.float64())])

# Rows of the distance table held at once: queries x members.
QUERY_ROWS, MEMBER_ROWS = 256, 512
# Squared lengths that single precision can hold, and the share of a block's pairs that it may leave.
MAX_SINGLE, MAX_LEFT = 1e30, 0.1
# Pairs that wait to be ranked together, as a share of those a run of queries keeps.
WAITING = 0.5


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional float64 array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if not rows:
        return np.empty((0, 0))
    lengths = column.value_lengths()
    if column.null_count or len(lengths.unique()) != 1:
        raise ValueError("vectors must be there and of one length")
    values = column.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    if values.null_count or np.isnan(flat).any():
        raise ValueError("vectors must not have missing or NaN entries")
    return flat.reshape(rows, -1)


def id_array(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def near_together(vectors: np.ndarray, rows: int) -> np.ndarray:
    """An order in which runs of ``rows`` vectors lie close together: halves by the widest entry, again and again."""
    out, waiting = [], [np.arange(len(vectors))]
    while waiting:
        own = waiting.pop()
        if len(own) <= rows:
            out.append(own)
            continue
        part = vectors[own]
        wide = part[:, np.argmax(part.max(axis=0) - part.min(axis=0))] if part.shape[1] else np.zeros(len(own))
        # Whole runs to either side. Of many equal entries in the middle, as of zeros, nearly all go to one side.
        half, runs = len(own) // 2, -(-len(own) // rows)
        middle = np.partition(wide, half)[half]
        ends = np.count_nonzero(wide < middle), np.count_nonzero(wide <= middle)
        half = rows * (runs // 2)
        if ends[0] < half - rows and ends[1] > half + rows and ends != (0, len(own)):
            half = rows * min(max(1, round(min((e for e in ends if 0 < e < len(own)), key=lambda e: abs(e - half)) / rows)), runs - 1)
        cut = np.argpartition(wide, half)
        waiting += [own[cut[half:]], own[cut[:half]]]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _boxes(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest entry of every run of rows."""
    return np.minimum.reduceat(values, starts, axis=0), np.maximum.reduceat(values, starts, axis=0)


class Nearest:
    """Keeps the ``k`` nearest members of each query while members stream by.

    Order: distance (rounded to ``digits`` if given), then id. With codes, a member
    counts only for queries that share the code of at least one hash table; queries may
    have several codes in each.

    Queries and members meet in cells of ``query_rows`` times ``member_rows`` that lie close
    together. The boxes around the two sides tell how near they can be: a cell's queries take
    the nearest boxes first, and none that is farther than all their last neighbours.

    With ``bound``, a distance per query, members farther than that are left out.
    """

    def __init__(self, ids, vectors, k, digits=None, codes=None, query_rows=QUERY_ROWS, member_rows=MEMBER_ROWS, bound=None):
        self.rows, self.member_rows = query_rows, member_rows
        order = near_together(vectors, query_rows)
        self.ids, self.vectors = ids[order], vectors[order]
        # By row, table and probe.
        codes = codes[:, :, None] if codes is not None and codes.ndim == 2 else codes
        self.codes = None if codes is None else codes[order]
        self.k, self.digits = k, digits
        self.squares = (self.vectors**2).sum(axis=1)
        # One product of [q, 1] and [-2m, m.m] gives the squared distance less q.q.
        self.left = np.hstack([self.vectors, np.ones((len(ids), 1))])
        # In single precision it tells which pairs are worth the exact distance.
        with np.errstate(over="ignore"):
            self.single = self.left.astype(np.float32)
        self.starts = np.arange(0, len(ids), query_rows)
        if len(ids):
            self.box = _boxes(self.vectors, self.starts)
            self.largest = np.maximum.reduceat(self.squares, self.starts)
            if codes is not None:
                self.code_box = _boxes(self.codes.min(axis=2), self.starts)[0], _boxes(self.codes.max(axis=2), self.starts)[1]
                self.own_box = _boxes(self.codes[:, :, 0], self.starts)
        # Per run of queries: query, member and distance of what is kept.
        none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.best = [none] * len(self.starts)
        # Pairs of the run at work that are not ranked yet.
        self.waiting, self.n_waiting = [], 0
        # Distance a member has to beat, per query.
        self.bound = np.full(len(ids), np.inf) if bound is None else np.array(bound, np.float64)[order]

    def add(self, ids, vectors, codes=None):
        if len(ids) and vectors.shape[1] != self.vectors.shape[1]:
            raise ValueError("vectors must be of one length")
        if codes is not None:
            # Members that share no bucket with any query are not compared at all.
            reach = np.zeros(len(ids), bool)
            for t in range(codes.shape[1]):
                reach |= np.isin(codes[:, t], self.codes[:, t])
            ids, vectors, codes = ids[reach], vectors[reach], codes[reach]
        if not len(ids) or not len(self.ids):
            return
        few = self._few_copies(ids, vectors)
        ids, vectors = ids[few], vectors[few]
        order = near_together(vectors, self.member_rows)
        codes = None if codes is None else codes[few][order]
        ids, vectors = ids[order], vectors[order]
        squares = (vectors**2).sum(axis=1)
        right = np.hstack([-2.0 * vectors, squares[:, None]])
        with np.errstate(over="ignore"):
            single = right.astype(np.float32)
        starts = np.arange(0, len(ids), self.member_rows)
        low, high = _boxes(vectors, starts)
        largest = np.maximum.reduceat(squares, starts)
        code_box = None if codes is None else _boxes(codes, starts)
        room = 0.0 if self.digits is None else 10.0**-self.digits
        for c, first in enumerate(self.starts):
            rows = slice(first, min(first + self.rows, len(self.ids)))
            gap = np.maximum(0.0, np.maximum(low - self.box[1][c], self.box[0][c] - high))
            apart = (gap**2).sum(axis=1)
            error = 1e-12 * (self.largest[c] + largest + 1.0)
            able, alike = np.ones(len(starts), bool), np.zeros(len(starts), bool)
            if codes is not None:
                least, most = self.code_box[0][c], self.code_box[1][c]
                able = ((code_box[0] <= most) & (code_box[1] >= least)).any(axis=1)
                # All of one bucket of a table: every pair of the cell shares it.
                own = self.own_box[0][c]
                alike = ((own == self.own_box[1][c]) & (code_box[0] == own) & (code_box[1] == own)).any(axis=1)
            for m in np.argsort(apart, kind="stable"):
                limit = self.bound[rows].max()
                if apart[m] > (limit + room) ** 2 + error.max():
                    break
                if able[m] and apart[m] <= (limit + room) ** 2 + error[m]:
                    block = slice(starts[m], min(starts[m] + self.member_rows, len(ids)))
                    self._add_block(
                        c, rows, ids[block], vectors[block], single[block].T, right[block].T, largest[m],
                        None if codes is None or alike[m] else codes[block],
                    )
            self._rank_waiting(c, rows)

    def _few_copies(self, ids, vectors):
        """Rows to look at: of equal members the k + 1 with the smallest ids, as no query can use more."""
        row = np.dtype((np.void, vectors.itemsize * vectors.shape[1]))
        kinds, kind = np.unique(np.ascontiguousarray(vectors).view(row).ravel(), return_inverse=True)
        if len(kinds) == len(ids):
            return slice(None)
        order = np.lexsort((ids, kind))
        kind = kind[order]
        place = np.arange(len(kind)) - np.searchsorted(kind, kind, side="left")
        return order[place <= self.k]

    def _add_block(self, c, rows, ids, vectors, single, right, largest, codes):
        own = self.squares[rows]
        # Queries without k neighbours yet: what they may take is told first, of the others' pairs only the near ones.
        taking = np.flatnonzero(np.isinf(self.bound[rows]))
        shared = None
        if codes is not None and len(taking):
            mine = self.codes[rows][taking]
            shared = np.zeros((len(taking), len(ids)), bool)
            for t in range(codes.shape[1]):
                for p in range(mine.shape[2]):
                    shared |= mine[:, t, p][:, None] == codes[:, t][None, :]
        near = None
        if own.max() + largest < MAX_SINGLE:
            error = (vectors.shape[1] + 4) * 1.2e-7 * (own + largest) + 1e-36
            near = self._near(self.single[rows] @ single, rows, own, error, taking, shared)
        if near is None or len(near) > MAX_LEFT * len(own) * len(ids):
            near = self._near(self.left[rows] @ right, rows, own, 1e-12 * (own + largest + 1.0), taking, shared)
        near_q, near_m = np.divmod(near, len(ids))
        query = near_q + rows.start
        other = self.ids[query] != ids[near_m]
        if codes is not None:
            told = np.zeros(len(own), bool)
            told[taking] = True
            open_pairs = np.flatnonzero(other & ~told[near_q])
            for start in range(0, len(open_pairs), 8192):
                piece = open_pairs[start : start + 8192]
                other[piece] = (self.codes[query[piece]] == codes[near_m[piece]][:, :, None]).any(axis=(1, 2))
        query, near_m = query[other], near_m[other]
        if not len(query):
            return
        for start in range(0, len(query), 65536):
            piece = slice(start, start + 65536)
            gap = self.vectors[query[piece]] - vectors[near_m[piece]]
            dist = np.sqrt((gap**2).sum(axis=1))
            if self.digits is not None:
                dist = np.round(dist, self.digits)
            kept = dist <= self.bound[query[piece]]
            self.waiting.append((query[piece][kept], ids[near_m[piece]][kept], dist[kept]))
            self.n_waiting += np.count_nonzero(kept)
        # Ranking few pairs costs as much as ranking many: those of queries with a bound wait for others.
        if len(taking) or self.n_waiting > WAITING * self.k * len(own):
            self._rank_waiting(c, rows)

    def _rank_waiting(self, c, rows):
        if self.n_waiting:
            self._keep_best(c, [np.concatenate(x) for x in zip(*self.waiting)], rows)
        self.waiting, self.n_waiting = [], 0

    def _near(self, score, rows, own, error, taking, shared):
        """Places of the pairs that may be nearer than the last neighbour so far; ``error`` is that of a score."""
        limit = self.bound[rows].copy()
        if len(taking):
            some = score[taking]
            if shared is not None:
                some[~shared] = np.inf
            if score.shape[1] > self.k:
                # One place more than k, as the query itself may be among the members.
                best = np.partition(some, self.k, axis=1)[:, self.k].astype(np.float64)
                limit[taking] = np.sqrt(np.maximum(best + own[taking] + error[taking], 0.0))
        # Room for rounding and for the error of the expanded square.
        room = 0.0 if self.digits is None else 10.0**-self.digits
        with np.errstate(over="ignore"):
            most = ((limit + room) ** 2 + error - own).astype(score.dtype)
        near = score <= np.nextafter(most, score.dtype.type(np.inf))[:, None]
        if shared is not None:
            near[taking] &= shared
        return np.flatnonzero(near)

    def _keep_best(self, c, new, rows):
        """Ranks what the queries with new members have; of the others nothing changes."""
        touched = np.zeros(rows.stop - rows.start, bool)
        touched[new[0] - rows.start] = True
        again = touched[self.best[c][0] - rows.start]
        query, member, dist = (np.concatenate([old[again], more]) for old, more in zip(self.best[c], new))
        order = np.lexsort((member, dist, query))
        in_order = query[order]
        place = np.arange(len(order)) - np.searchsorted(in_order, in_order, side="left")
        kept = order[place < self.k]
        full = order[place == self.k - 1]
        self.bound[query[full]] = dist[full]
        self.best[c] = [np.concatenate([old[~again], more[kept]]) for old, more in zip(self.best[c], (query, member, dist))]

    def result(self) -> list[pa.Array]:
        """The columns of :data:`FOUND`."""
        query, member, dist = (np.concatenate(c) for c in zip(*self.best)) if self.best else (np.empty(0, np.int64),) * 3
        return [
            pa.array(self.ids[query], pa.int64()),
            pa.array(member, pa.int64()),
            pa.array(dist, pa.float64()),
        ]
