"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.sources import storage

# Rows of one key that a single task is given.
ROWS_PER_SLICE = 2_000_000
# Keys of a count table that is broadcast whole, about 100 MB in memory.
MAX_BROADCAST_KEYS = 2_000_000
# Rows with texts that are broadcast, if they have no more than so many bytes either.
MAX_BROADCAST_NAMES, MAX_BROADCAST_BYTES = 500_000, storage.MAX_BROADCAST_BYTES


def slices_of(rows: Column, rows_per_slice: int) -> Column:
    return F.ceil(rows / F.lit(rows_per_slice)).cast("int")


def hot_keys(
    counts: DataFrame,
    keys: Sequence[str],
    rows: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    slices: str = "_slices",
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """All keys with more than ``rows_per_slice`` rows and the slices each is cut into.

    There is at most one for every ``rows_per_slice`` rows. The table is written and
    counted, and marked for broadcast if it is small enough; a larger one is joined, and
    adaptive execution splits what is too large for a task of that join.
    """
    hot = storage.written(
        counts.filter(F.col(rows) > rows_per_slice).select(*keys, slices_of(F.col(rows), rows_per_slice).alias(slices)),
        "hot-keys",
    )
    return F.broadcast(hot) if hot.count() <= max_broadcast_keys else hot


def attach_counts(
    df: DataFrame,
    counts: DataFrame,
    key: str,
    rows: str,
    n_keys: int,
    rows_per_slice: int = ROWS_PER_SLICE,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Inner join of ``df`` with its own row counts per ``key``.

    ``counts`` has ``n_keys`` rows; it is read several times and should be a written
    table. Up to ``max_broadcast_keys`` it is broadcast and the rows stay where they are.

    Beyond that both sides are shuffled. The rows of a hot key are then cut into
    slices, and its count row is repeated once per slice (at most
    keys + rows / rows_per_slice count rows in all). The slice depends on the row and
    on the partition it sits in, so copies of one row spread out too, and a task that
    runs again after a lost executor cuts the same way.
    """
    known = df.filter(F.col(key).isNotNull())
    if n_keys <= max_broadcast_keys:
        return known.join(F.broadcast(counts), key)
    hot = hot_keys(counts, [key], rows, rows_per_slice, max_broadcast_keys=max(max_broadcast_keys, 1))
    cut = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.col("_slices"))
    left = (
        known.join(hot, key, "left")
        .withColumn("_slice", F.when(F.col("_slices").isNull(), F.lit(0)).otherwise(cut.cast("int")))
        .drop("_slices")
    )
    right = counts.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), slices_of(F.col(rows), rows_per_slice) - 1))
    )
    return left.join(right, [key, "_slice"]).drop("_slice")


def lookup(
    facts: DataFrame, dimension: DataFrame, key: str, max_broadcast_names: int = MAX_BROADCAST_NAMES,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left join with a dimension of one row per key.

    The dimension's rows and bytes are counted: a small one is broadcast. A larger one is shuffled with the
    facts, each once and for this join alone, which is what lets adaptive execution cut
    the facts of a frequent key into as many pieces as they need.
    """
    if storage.is_small(dimension, max_broadcast_names, max_broadcast_bytes):
        return facts.join(F.broadcast(dimension), key, "left")
    return facts.join(dimension.hint("merge"), key, "left")


# Of a Bloom filter in blocks: bits of a block, bits set per key, bits per key, and the bytes it may have.
BLOCK_BITS, BITS_SET, BITS_PER_KEY, MAX_FILTER_BYTES = 4096, 4, 12, 48 << 20
_WORD = 64


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and its bits in the block."""
    bits = [F.pmod(F.xxhash64(F.lit(i), key), F.lit(BLOCK_BITS)).cast("int") for i in range(1, BITS_SET + 1)]
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(blocks)), bits


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place % _WORD)


def pre_filtered(df: DataFrame, keys: DataFrame, key: str, n_keys: int, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``df`` without most of the rows whose key is not in ``keys``, and with all of the others; no row moves.

    ``keys`` has ``n_keys`` rows. They set bits of a filter whose size is known beforehand;
    with twelve bits a key about one other row in a hundred passes. All bits of a key are
    in one block, so a row looks up one block of the broadcast filter. Where the filter
    would be too large for a use, ``df`` comes back as it is.
    """
    bits = min(BITS_PER_KEY, max_bytes * 8 // max(1, n_keys))
    if bits < BITS_SET:
        return df
    blocks = max(1, -(-n_keys * bits // BLOCK_BITS))
    block, places = _places(F.col("_key"), blocks)
    # The value alone: a key is told by its text where the two sides have it in different types.
    told = keys.select(F.col(key).cast("string").alias("_key"))
    words = (
        told.select(block.alias("_block"), F.explode(F.array(*places)).alias("_place"))
        .groupBy("_block", F.floor(F.col("_place") / _WORD).cast("int").alias("_at")).agg(F.bit_or(_bit(F.col("_place"))).alias("_bits"))
    )
    entries = F.map_from_entries(F.collect_list(F.struct("_at", "_bits")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // _WORD - 1)), lambda i: F.coalesce(F.col("_words")[i], F.lit(0).cast("long")))
    table = words.groupBy("_block").agg(entries.alias("_words")).select("_block", dense.alias("_words"))
    # The whole row in one column, so that none of its names can clash.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{key}`").cast("string").alias("_key"))
    holds = F.lit(True)
    for place in places:
        word = F.get("_words", F.floor(place / _WORD).cast("int"))
        holds = holds & (word.bitwiseAND(_bit(place)) != 0)
    return rows.withColumn("_block", block).join(F.broadcast(table), "_block").filter(holds).select("row.*")
