"""Best items per user by factor products, without those the user has seen, in blocks that prune.

Items are dealt into blocks by descending length of their vectors. A product is at most the
product of the two lengths, so once a user has ``k`` scores, every block whose longest vector
cannot beat the last of them is skipped. The blocks are taken in waves that double in size:
each wave's scores tighten the bound for the next, and a user goes only to the blocks that
can still change the answer. In a wave users and blocks move once per group, in which a task
takes the user through runs of items that lie close together, those that promise most first,
and tightens the bound as it goes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.nearest import id_array, matrix, near_together
from earshot.sources import storage

# Items of a block.
ROWS_PER_BLOCK = 4096
# Vectors of either side that meet in one group of blocks, in bytes, and groups per core.
MAX_GROUP_BYTES, GROUPS_PER_CORE = 8 << 20, 4
# Items of a run with a box around it; bounds held at once, of so many users at least and at most; and items they have seen.
RUN_ROWS = 128
SCORES, MIN_USER_ROWS, MAX_USER_ROWS = 1 << 20, 256, 2048
MAX_SEEN = 1 << 22
# The first wave has this share of the blocks.
FIRST_WAVE = 16
# Bits of a word of a bitmap.
WORD = 64
# Room for rounding when lengths are compared with scores, as a share of them and for scores next to 0.
ROOM, TINY = 1e-5, 1e-30

_FOUND = "user_id long, item_id long, score float"
FOUND = pa.schema([("user_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float32())])


@dataclass(frozen=True)
class Search:
    """``best``: ``user_id``, ``rank``, ``item_id``, ``score`` (float). ``asked``: ``id`` of all users searched for.

    ``report``: a row per wave with ``blocks``, and of the (user, block) ``pairs`` those
    ``searched``.
    """

    best: DataFrame
    asked: DataFrame
    report: DataFrame


def _length(features: str):
    square = F.aggregate(F.transform(features, lambda x: x.cast("double") * x), F.lit(0.0), lambda t, v: t + v)
    return F.sqrt(square)


def item_blocks(items: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``id``, ``features``, ``length``, ``block`` (longest vectors first) and ``slot``, the place in the block. Written.

    The cuts are by length and id, so items of one length fill as many blocks as they need.
    """
    rows = items.filter("features is not null").select(
        F.col("id").cast("long").alias("id"), "features", _length("features").alias("length")
    )
    blocks = max(1, math.ceil(rows.count() / rows_per_block))
    order = [F.desc("length"), F.asc("id")]
    placed = rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    # The number of the partition, and of the row within it.
    number = F.monotonically_increasing_id()
    return storage.written(
        placed.withColumn("_number", number).select(
            "id", "features", "length", F.shiftright("_number", 33).cast("int").alias("block"),
            F.col("_number").bitwiseAND(F.lit((1 << 33) - 1)).cast("int").alias("slot"),
        ),
        "item-blocks",
    )


def seen_bitmaps(seen: DataFrame, blocks: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """``id``, ``block``, ``seen``: the words of the bitmap of the slots that a user has seen, those without a bit left out.

    Bits are joined word by word before anything meets, so rows repeated any number of times,
    and a user with any number of rows, are a few words per task.
    """
    places = blocks.select(F.col("id").alias("_item"), "block", "slot")
    rows = seen.select(F.col(user).cast("long").alias("id"), F.col(item).cast("long").alias("_item")).join(places, "_item")
    words = rows.groupBy("id", "block", F.floor(F.col("slot") / WORD).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot") % WORD)).alias("bits")
    )
    return words.groupBy("id", "block").agg(F.collect_list(F.struct("word", "bits")).alias("seen"))


def _seen_places(seen: pa.Array, positions: np.ndarray) -> tuple[np.ndarray, ...]:
    """``user`` (by place in the cell), ``block``, ``word`` and ``bits`` of all bitmaps, users in the order of ``positions``."""
    per_user = seen.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    place = np.empty(len(seen), np.int64)
    place[positions] = np.arange(len(seen))
    lists = seen.flatten()
    words = lists.field("seen")
    n_words = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = words.flatten()
    return (
        np.repeat(np.repeat(place, per_user), n_words),
        np.repeat(lists.field("block").to_numpy(zero_copy_only=False), n_words),
        flat.field("word").to_numpy(zero_copy_only=False),
        flat.field("bits").to_numpy(zero_copy_only=False).view(np.uint64),
    )


def _chunks(n: int, rows: int, seen: np.ndarray | None) -> list[slice]:
    """Runs of at most ``rows`` users, shorter where their users have seen much; ``seen`` counts the items per user."""
    if seen is None:
        return [slice(at, min(at + rows, n)) for at in range(0, n, rows)]
    total, out, at = np.concatenate([[0], np.cumsum(seen)]), [], 0
    while at < n:
        until = int(np.searchsorted(total, total[at] + MAX_SEEN, side="right")) - 1
        out.append(slice(at, max(at + 1, min(at + rows, until, n))))
        at = out[-1].stop
    return out


def _best_of_group(asking: pa.Table, offering: pa.Table, k: int) -> pa.Table:
    """The ``k`` best unseen items of some blocks for each user, of those not below the user's last score so far.

    Users and items lie in runs close together. The box around a run of items says how much a
    product with one of them can be: a run of users takes the most promising boxes first, and a
    user none that cannot beat the last score.
    """
    if not asking.num_rows or not offering.num_rows:
        return FOUND.empty_table()
    vectors = matrix(offering["features"])
    order = near_together(vectors, RUN_ROWS)
    items, vectors = id_array(offering["id"])[order], vectors[order]
    starts = np.arange(0, len(items), RUN_ROWS)
    single = vectors.astype(np.float32)
    low, high = np.minimum.reduceat(single, starts, axis=0), np.maximum.reduceat(single, starts, axis=0)
    lengths = np.maximum.reduceat(np.sqrt((vectors**2).sum(axis=1)), starts)
    corners = np.sqrt((np.maximum(np.abs(low), np.abs(high)).astype(np.float64) ** 2).sum(axis=1))
    asking = asking.combine_chunks()
    own = matrix(asking["features"])
    step = min(MAX_USER_ROWS, max(MIN_USER_ROWS, SCORES // len(starts)))
    by_user = near_together(own, step)
    users, own, last = id_array(asking["id"])[by_user], own[by_user], id_array(asking["last"])[by_user]
    size, own_single = np.sqrt((own**2).sum(axis=1)), own.astype(np.float32)
    # Room for the error of a product in single precision.
    part = (own.shape[1] + 4) * 1.2e-7
    n_seen = None
    if "seen" in asking.column_names:
        who, where, word, bits = _seen_places(asking["seen"].combine_chunks(), by_user)
        sorted_by = np.argsort(who, kind="stable")
        who, where, word, bits = (x[sorted_by] for x in (who, where, word, bits))
        n_seen = np.bincount(who, np.bitwise_count(bits), len(users)).astype(np.int64)
        # Where the item of a block and slot has come to lie.
        block, slot = id_array(offering["block"])[order], id_array(offering["slot"])[order]
        blocks, block_at = np.unique(block, return_inverse=True)
        lies = np.full((len(blocks), int(slot.max()) // WORD * WORD + WORD), -1)
        lies[block_at, slot] = np.arange(len(items))
    out = []
    for rows in _chunks(len(users), step, n_seen):
        n, mine = rows.stop - rows.start, own_single[rows]
        # By run and user: what a product can be at most.
        most = high @ np.maximum(mine, 0).T + low @ np.minimum(mine, 0).T
        most += (part * corners)[:, None].astype(np.float32) * size[rows][None, :].astype(np.float32) + np.float32(1e-30)
        np.minimum(most, (lengths * (1 + ROOM))[:, None].astype(np.float32) * size[rows][None, :].astype(np.float32) + np.float32(1e-30), out=most)
        bound = last[rows].copy()
        best, best_item = np.full((n, k), -np.inf, np.float32), np.full((n, k), np.iinfo(np.int64).max)
        if n_seen is not None:
            inside = slice(*np.searchsorted(who, [rows.start, rows.stop]))
            entry, bit = np.nonzero(np.unpackbits(np.ascontiguousarray(bits[inside]).view(np.uint8).reshape(-1, WORD // 8), axis=1, bitorder="little"))
            hidden_row = who[inside][entry] - rows.start
            hidden = lies[np.searchsorted(blocks, where[inside][entry]), word[inside][entry].astype(np.int64) * WORD + bit]
            by_run = np.argsort(hidden, kind="stable")
            hidden_row, hidden = hidden_row[by_run], hidden[by_run]
        for r in np.argsort(-most.sum(axis=1), kind="stable"):
            able = np.flatnonzero(most[r] >= bound)
            if not len(able):
                continue
            start, end = starts[r], min(starts[r] + RUN_ROWS, len(items))
            scores = mine[able] @ single[start:end].T
            error = part * lengths[r] * size[rows][able] + 1e-30
            if n_seen is not None:
                inside = slice(*np.searchsorted(hidden, [start, end]))
                place = np.full(n, -1)
                place[able] = np.arange(len(able))
                row = place[hidden_row[inside]]
                scores[row[row >= 0], (hidden[inside] - start)[row >= 0]] = -np.inf
            limit = bound[able]
            if end - start > k and np.isinf(limit).any():
                limit = np.maximum(limit, np.partition(scores, end - start - k, axis=1)[:, end - start - k] - error)
            near = scores >= np.nextafter((limit - error).astype(np.float32), np.float32(-np.inf))[:, None]
            if n_seen is not None:
                near &= scores > -np.inf
            row, column = np.divmod(np.flatnonzero(near), end - start)
            if not len(row):
                continue
            row, column = able[row], start + column
            # To single precision, as the factors are: equal products are equal whatever else is in the group.
            score = np.einsum("ij,ij->i", own[rows][row], vectors[column]).astype(np.float32)
            item = items[column]
            # Of equal scores the smaller ids, so that any number of them is few that are sorted.
            tail = best[row, -1]
            better = (score >= bound[row]) & ((score > tail) | ((score == tail) & (item < best_item[row, -1])))
            row, item, score = row[better], item[better], score[better]
            if not len(row):
                continue
            touched, row = np.unique(row, return_inverse=True)
            row = np.concatenate([np.repeat(np.arange(len(touched)), k), row])
            score, item = np.concatenate([best[touched].ravel(), score]), np.concatenate([best_item[touched].ravel(), item])
            ranked = np.lexsort((item, -score, row))
            row = row[ranked]
            ranked = ranked[np.arange(len(row)) - np.searchsorted(row, row, side="left") < k]
            best[touched], best_item[touched] = score[ranked].reshape(-1, k), item[ranked].reshape(-1, k)
            bound[touched] = np.maximum(bound[touched], best[touched, -1])
        there = best > -np.inf
        out.append((np.repeat(users[rows], there.sum(axis=1)), best_item[there], best[there]))
    columns = [np.concatenate(c) for c in zip(*out)]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, FOUND.types)], schema=FOUND)


def _groups(users: int, items: int, n_blocks: int, groups: float, rows_per_group: int) -> tuple[int, int]:
    """Into how many groups the users and the blocks of a wave are dealt: those that fit, and move the fewest rows."""
    item_groups = max(1, int(math.sqrt(groups * items / max(1, users))), math.ceil(items / rows_per_group))
    item_groups = min(n_blocks, item_groups)
    return max(1, math.ceil(groups / item_groups), math.ceil(users / rows_per_group)), item_groups


def waves(blocks: int) -> list[tuple[int, int]]:
    """Ranges of blocks, each twice as long as the one before; the first has a sixteenth, as every wave moves the users again."""
    out, at, step = [], 0, max(1, blocks // FIRST_WAVE)
    while at < blocks:
        out.append((at, min(blocks, at + step)))
        at, step = at + step, 2 * step
    return out


def search(
    user_vectors: DataFrame, item_vectors: DataFrame, k: int = 10, users: DataFrame | None = None,
    seen: DataFrame | None = None, rows_per_block: int = ROWS_PER_BLOCK,
) -> Search:
    """The ``k`` items with the largest products for every user; equal ones by item id.

    Every pair that is not computed has a bound below the user's last score.

    ``user_vectors`` and ``item_vectors`` have ``id`` and ``features``; ``users`` a column
    ``user_id`` (all when left out); ``seen`` ``user_id`` and ``song_id``, pairs that are no
    answer. Rows without a vector neither ask nor are answers. A few jobs a wave; what comes
    to the driver is a row per block.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = user_vectors.sparkSession
    asked = user_vectors.filter("features is not null").select(
        F.col("id").cast("long").alias("id"), "features", _length("features").alias("length")
    )
    if users is not None:
        asked = asked.join(users.select(F.col("user_id").cast("long").alias("id")), "id", "left_semi")
    asked = storage.written(asked, "asked")
    n_users, width = asked.agg(F.count("*"), F.max(F.size("features"))).head()
    blocks = item_blocks(item_vectors, rows_per_block)
    longest = [r["longest"] for r in blocks.groupBy("block").agg(F.max("length").alias("longest")).orderBy("block").collect()]
    bitmaps = None if seen is None else storage.written(seen_bitmaps(seen, blocks), "seen")
    rows_per_group = max(1, MAX_GROUP_BYTES // (8 * ((width or 0) + 4)))
    groups = GROUPS_PER_CORE * spark.sparkContext.defaultParallelism
    kinds = dict(asked.dtypes)
    limited = f"id long, features {kinds['features']}, length double, last double, reach int"

    best, report = spark.createDataFrame([], _FOUND + ", rank int"), []
    for first, until in waves(len(longest)):
        # The last score of each user who has k; the others take any.
        last = best.filter(F.col("rank") == k).select(F.col("user_id").alias("id"), F.col("score").cast("double").alias("_last"))
        limits = asked.join(last, "id", "left").select("id", "features", "length", F.coalesce("_last", F.lit(-math.inf)).alias("last"))
        lengths = np.array(longest[first:until])

        def reached(batches, lengths=lengths, first=first):
            for batch in batches:
                size, last = id_array(batch.column("length")), id_array(batch.column("last"))
                # Lengths that fall: the blocks a user must look at are the first ones.
                shortest = (last * (1 - ROOM) - TINY) / np.maximum(size * (1 + ROOM), 1e-300)
                n = np.searchsorted(-lengths, -shortest * (1 - 1e-12) + 1e-300, side="right")
                n[last <= TINY] = len(lengths)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first + n, pa.int32())], names=[*batch.schema.names, "reach"])

        asking = storage.written(limits.mapInArrow(reached, limited).filter(F.col("reach") > first), "asking")
        searched, n_asking = asking.agg(F.coalesce(F.sum(F.col("reach") - first), F.lit(0)), F.count("*")).head()
        report.append((len(report), until - first, n_users * (until - first), searched))
        if not searched:
            break  # later blocks are shorter still
        n_blocks = until - first
        user_groups, item_groups = _groups(n_asking, n_blocks * rows_per_block, n_blocks, groups, rows_per_group)
        # Blocks are dealt in turn, so the first groups have those that a user with a short reach needs.
        left = asking.withColumn("user_group", F.pmod(F.xxhash64("id"), F.lit(user_groups)).cast("int")).withColumn(
            "item_group", F.explode(F.sequence(F.lit(0), F.least(F.col("reach") - first, F.lit(item_groups)) - 1))
        )
        group_of = F.pmod(F.col("block") - first, F.lit(item_groups)).cast("int").alias("item_group")
        inside = F.col("block").between(first, until - 1)
        if bitmaps is not None:
            words = bitmaps.filter(inside).select("id", group_of, F.struct("block", "seen").alias("seen"))
            left = left.join(words.groupBy("id", "item_group").agg(F.collect_list("seen").alias("seen")), ["id", "item_group"], "left")
        right = blocks.filter(inside).select(
            "block", "slot", "id", "features", "length", group_of, F.explode(F.sequence(F.lit(0), F.lit(user_groups - 1))).alias("user_group")
        )
        # Few groups get more partitions than there are groups, as hashing would put several of them into one.
        n_groups = user_groups * item_groups
        parts = max(1, min(4 * n_groups, max(math.ceil(4 * groups), n_groups)))
        group = ["user_group", "item_group"]
        left, right = (df.repartition(parts, *group) for df in (left, right.toDF(*right.columns)))
        found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(lambda a, b: _best_of_group(a, b, k), _FOUND)
        order = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
        merged = best.drop("rank").unionByName(found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        best = storage.written(merged, "best")
    return Search(
        best.select("user_id", "rank", "item_id", "score"), asked.select("id"),
        spark.createDataFrame(report, "wave int, blocks int, pairs long, searched long"),
    )
