"""Shards of nearly equal bytes from indivisible groups, by Karmarkar-Karp differencing.

A partial partition is a tuple of as many bins as there are shards. Every group starts as
one, alone in its largest bin. The two with the largest spread are combined, the largest
bins of one with the smallest of the other, until one is left.

One queue for all groups would be one task. Groups are dealt by hash into blocks; each
block is differenced in a task and leaves one partial partition, whose spread is far below
that of its groups. The blocks' partial partitions are differenced in the same way, block
by block, until one is left: few levels, as each is a block's size smaller. Going back
down, the order of the last one gives every bin of every level its shard.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import MAX_BROADCAST_ROWS, prefix_sums, text_of
from earshot.sources import storage

SHARDS = 24
# Partial partitions that one task combines.
BLOCK = 4096
# Bytes that a document takes besides its text.
OVERHEAD = 8
# Rows numbered by one task.
SLOT_ROWS = 1_000_000


def difference(parts: list[tuple], shards: int) -> tuple[list[int], list[list[int]]]:
    """Combines partial partitions, each a tuple of bin sums in descending order.

    Returns the sums of the last one, in descending order, and for every given one the bin
    of the last into which each of its own bins went. Ties go to the earlier one.
    """
    # Of each node: the two it was made of, and where their bins went.
    made: list[tuple | None] = [None] * len(parts)
    queue = [(bins[-1] - bins[0], n, bins) for n, bins in enumerate(parts)]
    heapq.heapify(queue)
    while len(queue) > 1:
        _, a, large = heapq.heappop(queue)
        _, b, other = heapq.heappop(queue)
        sums = [x + y for x, y in zip(large, reversed(other))]
        order = sorted(range(shards), key=lambda i: (-sums[i], i))
        place = [0] * shards
        for new, old in enumerate(order):
            place[old] = new
        bins = tuple(sums[i] for i in order)
        # Bin i of the first and bin shards - 1 - i of the second.
        made.append((a, b, place))
        heapq.heappush(queue, (bins[-1] - bins[0], len(made) - 1, bins))
    _, root, bins = queue[0]
    went: dict[int, list[int]] = {root: list(range(shards))}
    for node in range(len(made) - 1, len(parts) - 1, -1):
        a, b, place = made[node]
        up = went.pop(node)
        went[a] = [up[place[i]] for i in range(shards)]
        went[b] = [up[place[shards - 1 - i]] for i in range(shards)]
    return list(bins), [went[n] for n in range(len(parts))]


def _combine(parts: DataFrame, shards: int, block: int) -> DataFrame:
    """One level: ``block``, ``id``, ``bins`` to one row per part (``went``), and one per block (``id`` null, ``bins``)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        bins, went = difference([tuple(b) for b in table["bins"].to_pylist()], shards)
        number = table["block"][0].as_py()
        n = table.num_rows
        return pa.table({
            "block": pa.array([number] * (n + 1), pa.int64()),
            "id": pa.array([*table["id"].to_pylist(), None], pa.int64()),
            "bins": pa.array([None] * n + [bins], pa.list_(pa.int64())),
            "went": pa.array([*went, None], pa.list_(pa.int32())),
        })

    return parts.groupBy("block").applyInArrow(run, "block long, id long, bins array<long>, went array<int>")


def assign(groups: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """``key`` and ``shard`` (int) for groups given by ``key`` (long, once each) and ``size`` (long, not negative).

    Runs a job per level and writes each to the shared folder.
    """
    if shards < 1 or block < 2:
        raise ValueError("there must be a shard, and two parts to a block at least")
    alone = F.concat(F.array(F.col("size")), F.array_repeat(F.lit(0).cast("long"), shards - 1))
    parts = groups.select(F.col("key").alias("id"), alone.alias("bins"))
    parts, levels = storage.written(parts, "parts"), []
    while True:
        # A block too large for its task has no place in a hash: counts come first.
        n = parts.count()
        blocks = max(1, -(-n // block))
        # The first level deals by hash, the others in runs of numbers; both are even.
        dealt = F.pmod(F.xxhash64("id"), F.lit(blocks)) if not levels else F.pmod(F.col("id"), F.lit(blocks))
        level = storage.written(_combine(parts.withColumn("block", dealt.cast("long")), shards, block), "level")
        levels.append(level)
        if blocks == 1:
            break
        parts = level.filter("id is null").select(F.col("block").alias("id"), "bins")
    # From the top down: the shard of each bin of each part.
    bins = levels[-1].filter("id is not null").select("id", F.col("went").alias("shards"))
    for level in reversed(levels[:-1]):
        above = bins.select(F.col("id").alias("block"), F.col("shards").alias("_above"))
        below = level.filter("id is not null").select("block", "id", "went")
        bins = below.join(above, "block").select(
            "id", F.transform("went", lambda b: F.get("_above", b)).alias("shards")
        )
    # A group lies in the first bin of its part.
    return bins.select(F.col("id").alias("key"), F.col("shards")[0].cast("int").alias("shard"))


def shard(docs: DataFrame, shards: int = SHARDS, block: int = BLOCK, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` (long), ``law``, ``shard`` (int), ``slot`` (long), ``grown_shard`` (null).

    Equal texts form a group and share a shard; a missing text is an empty one. The law is
    ``bytes``: the shards' sizes are as near to each other as the largest groups allow.
    Slots count from 0 in every shard without a gap. Repeated rows get slots of their own;
    a missing id gets one like any other.
    """
    text = text_of()
    rows = storage.written(
        docs.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "sized",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    # The number a group goes by has 64 of the digest's bits; equal ones would share a shard.
    numbered = storage.written(
        groups.groupBy(F.xxhash64("digest").alias("key")).agg(F.sum("size").alias("size")), "groups"
    )
    shares = assign(numbered, shards, block)
    placed = rows.withColumn("key", F.xxhash64("digest")).join(shares, "key")
    # Two-step numbering: rows within slices, slices within their shard.
    n_slices = max(1, -(-rows.count() // slot_rows)) * 8
    sliced = storage.written(
        placed.select(
            "doc_id", "size", "text_crc32", "shard",
            F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_slices)).cast("long").alias("slice"),
        ),
        "placed",
    )
    counts = sliced.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    first = prefix_sums(counts, ["shard"], "slice", "n", "first").select("shard", "slice", "first")
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "size", "text_crc32")
    numbers = sliced.withColumn("_turn", F.row_number().over(within) - 1)
    small = n_slices * shards <= MAX_BROADCAST_ROWS
    return numbers.join(F.broadcast(first) if small else first, ["shard", "slice"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("_turn")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
