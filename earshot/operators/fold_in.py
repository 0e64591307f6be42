"""Vectors for users the model does not know, from their own plays and the trained item vectors.

A user's vector minimises a least-squares problem of its own under the item vectors; the
part of it that all users share, the items' Gram matrix, is summed once. The result is the
vector that a last half-step of the training would have given the user.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.nearest import matrix
from earshot.operators import skew

# Ratings of one user that a single task is given.
ROWS_PER_TASK = 50_000
# Numbers of all products held at once, and the longest vectors whose products are formed row by row.
PRODUCTS, MAX_WIDTH = 1 << 21, 24
_PART = "id long, features array<float>, n long, sums binary"


def gram(items: DataFrame) -> np.ndarray:
    """Sum over all items of the products of the entries of ``features``: partitions add up their own, a number per pair of entries comes back."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = matrix(batch.column(0))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"]
            )

    def added(table: pa.Table) -> pa.Table:
        total = matrix(table["sums"]).sum(axis=0)
        return pa.table({"i": table["i"][:1], "sums": pa.array([total], pa.list_(pa.float64()))})

    kind = "i int, sums array<double>"
    rows = items.filter("features is not null").select("features").mapInArrow(run, kind).groupBy("i").applyInArrow(added, kind)
    found = sorted(rows.collect(), key=lambda r: r.i)
    return np.array([r.sums for r in found]) if found else np.zeros((0, 0))


def non_negative(a: np.ndarray, b: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The ``x`` without a negative entry that minimises x'ax/2 - b'x, for a positive definite ``a``."""
    return non_negative_each(a[None], b[None], rounds)[0]


def non_negative_each(a: np.ndarray, b: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The same for many problems side by side.

    Entries are split into free ones and those at zero; all that are on the wrong side change
    sides at once, and one at a time when that stops helping.
    """
    n, rank = b.shape
    free, x = np.ones((n, rank), bool), np.zeros((n, rank))
    fewest, tries = np.full(n, rank + 1), np.full(n, 3)
    room = 1e-10 * (1 + np.abs(b).max(axis=1, initial=0))
    own = np.arange(n)
    for _ in range(rounds):
        f, left, right = free[own], a[own], b[own]
        # The entries at zero become equations of their own.
        held = left * (f[:, :, None] & f[:, None, :])
        held[:, np.arange(rank), np.arange(rank)] += ~f
        x[own] = found = np.where(f, np.linalg.solve(held, np.where(f, right, 0.0)[:, :, None])[:, :, 0], 0.0)
        slope = np.einsum("nij,nj->ni", left, found) - right
        wrong = np.where(f, found < -1e-12, slope < -room[own][:, None])
        amount = wrong.sum(axis=1)
        better = amount < fewest[own]
        last = ~better & (tries[own] == 0)
        fewest[own] = np.where(better, amount, fewest[own])
        tries[own] = np.where(better, 3, np.maximum(tries[own] - 1, 0))
        only = rank - 1 - np.argmax(wrong[:, ::-1], axis=1)
        wrong &= ~last[:, None] | (np.arange(rank) == only[:, None])
        free[own] = f ^ wrong
        own = own[amount > 0]
        if not len(own):
            break
    return np.maximum(x, 0)


def fold_in(
    ratings: DataFrame,
    items: DataFrame,
    *,
    reg: float = 0.1,
    alpha: float = 1.0,
    nonnegative: bool = True,
    user: str = "user_id",
    item: str = "song_id",
    rating: str = "rating_log",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``id``, ``features`` (array<float>) of the users in ``ratings`` who rated an item of ``items``.

    ``items`` has ``id`` and ``features``, as trained with the same ``reg`` and ``alpha``.
    Repeated rows count as often as they occur, as in training; rows with a missing id or
    rating and ratings of other items are left out, and so is a user with no row left. The
    rows of a user with more than ``rows_per_task`` are summed in slices; the users of a task
    pass in order of their ids, and are summed and solved many at a time. Runs a job for the
    Gram matrix and one for the counts.
    """
    shared = gram(items)
    rank = len(shared)
    vectors = items.filter("features is not null").select(F.col("id").cast("long").alias("_item"), "features")
    rated = ratings.select(
        F.col(user).cast("long").alias("id"), F.col(item).cast("long").alias("_item"), F.col(rating).cast("double").alias("rating")
    ).filter("id is not null and rating is not null")
    rows = rated.join(vectors, "_item")
    hot = skew.hot_keys(rated.groupBy("id").agg(F.count("*").alias("_n")), ["id"], "_n", rows_per_task)
    cut = F.pmod(F.xxhash64("_item", "rating", F.spark_partition_id()), F.col("_slices")).cast("int")
    dealt = rows.join(hot, "id", "left").select(
        "id", "rating", "features", F.coalesce("_slices", F.lit(1)).alias("slices"), F.coalesce(cut, F.lit(0)).alias("slice")
    )

    def solved(n: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Row per user, in single precision."""
        out = np.zeros((len(n), rank), np.float32)
        step = max(1, PRODUCTS // max(1, rank * rank))
        # A user without a positive rating prefers nothing.
        some = np.flatnonzero(n)
        for at in range(0, len(some), step):
            own = some[at : at + step]
            a = shared + sums[own, :, :-1] + reg * n[own][:, None, None] * np.eye(rank)
            b = sums[own, :, -1]
            out[own] = non_negative_each(a, b) if nonnegative else np.linalg.solve(a, b[:, :, None])[:, :, 0]
        return out

    def told(ids, features, n, sums) -> pa.RecordBatch:
        values = [ids, features, n, sums]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _TYPES)], names=["id", "features", "n", "sums"])

    def summed(y: np.ndarray, r: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Liked rows and sums of products of every run of rows."""
        weight, liked = alpha * np.abs(r), r > 0
        n = np.add.reduceat(liked.astype(np.int64), starts)
        right = np.where(liked, 1 + weight, 0.0)
        if rank <= MAX_WIDTH:
            both = np.concatenate([weight[:, None] * y, right[:, None]], axis=1)
            return n, np.add.reduceat(y[:, :, None] * both[:, None, :], starts, axis=0)
        ends = np.append(starts[1:], len(r))
        return n, np.stack([
            np.column_stack([(y[i:j] * weight[i:j, None]).T @ y[i:j], y[i:j].T @ right[i:j]]) for i, j in zip(starts, ends)
        ])

    def parts_of(batches):
        """Rows in order of ``id`` and ``slice``: the last user of a piece waits for the next piece."""

        def finished(ids, slices, n, sums):
            alone = slices == 1
            if alone.any():
                yield told(ids[alone], list(solved(n[alone], sums[alone])), n[alone], [None] * int(alone.sum()))
            if not alone.all():
                some = np.flatnonzero(~alone)
                yield told(ids[some], [None] * len(some), n[some], [sums[i].tobytes() for i in some])

        def alone(one):
            (user_id, _), cut_into, liked, total = one
            return np.array([user_id]), np.array([cut_into]), np.array([liked]), total[None]

        step, waiting = max(1, PRODUCTS // max(1, rank * (rank + 1))), None
        for batch in batches:
            for pos in range(0, batch.num_rows, step):
                piece = batch.slice(pos, step)
                user_id, slice_, cut_into = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("id", "slice", "slices"))
                starts = np.flatnonzero(np.append(True, (user_id[1:] != user_id[:-1]) | (slice_[1:] != slice_[:-1])))
                new_n, new_sums = summed(matrix(piece.column("features")), piece.column("rating").to_numpy(zero_copy_only=False), starts)
                keys, new_slices = list(zip(user_id[starts], slice_[starts])), cut_into[starts]
                if waiting is not None and waiting[0] == keys[0]:
                    new_n[0] += waiting[2]
                    new_sums[0] += waiting[3]
                elif waiting is not None:
                    yield from finished(*alone(waiting))
                done = slice(0, len(keys) - 1)
                yield from finished(user_id[starts][done], new_slices[done], new_n[done], new_sums[done])
                waiting = keys[-1], new_slices[-1], new_n[-1], new_sums[-1].copy()
        if waiting is not None:
            yield from finished(*alone(waiting))

    def whole(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(s).reshape(rank, rank + 1) for s in table["sums"].to_pylist())
        n = np.array([sum(table["n"].to_pylist())])
        return pa.Table.from_batches([told(table["id"].to_pylist()[:1], list(solved(n, sums[None])), n, [None])])

    parts = dealt.repartition("id", "slice").sortWithinPartitions("id", "slice").mapInArrow(parts_of, _PART)
    if not hot.head(1):
        return parts.select("id", "features")
    joined = parts.filter("features is null").groupBy("id").applyInArrow(whole, _PART)
    return parts.filter("features is not null").unionByName(joined).select("id", "features")


_TYPES = [pa.int64(), pa.list_(pa.float32()), pa.int64(), pa.binary()]
