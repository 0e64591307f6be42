"""Implicit-feedback matrix factorisation."""

from __future__ import annotations

import math

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.sources import schemas, storage

# Ratings a block should hold at most, at the default rank, and at least.
MAX_RATINGS_PER_BLOCK, MIN_RATINGS_PER_BLOCK = 2_000_000, 25_000
DEFAULT_RANK = 150
# Bytes in a task, about so many: of a rating while it is sorted into its block, and of each entry of the vector sent for it.
_RATING_BYTES, _ENTRY_BYTES = 60, 4


def block_count(ratings: int, parallelism: int, rank: int = DEFAULT_RANK) -> int:
    """Blocks on either side: one per core, fewer for little data, more for much.

    An iteration sends a vector to every block with a rating of its user or item, so the
    messages grow with the blocks too. Vectors shorter than those of the default rank leave
    room for more ratings in a block, in as many bytes.
    """
    spread = min(parallelism, math.ceil(ratings / MIN_RATINGS_PER_BLOCK))
    bytes_at_most = MAX_RATINGS_PER_BLOCK * (_RATING_BYTES + _ENTRY_BYTES * DEFAULT_RANK)
    most = max(MAX_RATINGS_PER_BLOCK, bytes_at_most // (_RATING_BYTES + _ENTRY_BYTES * rank))
    return max(1, spread, math.ceil(ratings / most))


def train(
    ratings: DataFrame,
    *,
    seed: int,
    rank: int = DEFAULT_RANK,
    iterations: int = 20,
    reg: float = 0.1,
    alpha: float = 1.0,
    user: str = "user_id",
    item: str = "song_id",
    rating: str = "rating_log",
    nonnegative: bool = True,
    blocks: int | None = None,
    block_size: int = 4096,
    checkpoint_interval: int = 5,
    checked_rows: int | None = None,
) -> ALSModel:
    """Fit on (user, item, rating) rows; repeated pairs count as separate rows.

    The rows are checked and counted first; ``checked_rows`` is the count of rows that
    :func:`schemas.require_trainable` has passed already.

    The start of the search depends on ``seed`` and ``blocks``: fix both to get the
    same factors from clusters of different size.
    """
    spark = ratings.sparkSession
    storage.ensure_checkpoint_dir(spark)
    rows = ratings.select(user, item, rating)
    n = schemas.require_trainable(rows, user, item, rating) if checked_rows is None else checked_rows
    blocks = blocks or block_count(n, spark.sparkContext.defaultParallelism, rank)
    return ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        alpha=alpha,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        implicitPrefs=True,
        nonnegative=nonnegative,
        coldStartStrategy="drop",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        blockSize=block_size,
        # A checkpoint after the last iteration would cut no lineage.
        checkpointInterval=checkpoint_interval if iterations > checkpoint_interval else -1,
        seed=seed,
    ).fit(rows)


def user_vectors(model: ALSModel) -> DataFrame:
    """``id``, ``features`` of the trained users."""
    return model.userFactors.select("id", "features")


def item_vectors(model: ALSModel) -> DataFrame:
    return model.itemFactors.select("id", "features")


def vector_entries(vectors: DataFrame) -> DataFrame:
    """One row per vector entry: ``id``, ``position``, ``value``."""
    return vectors.select("id", F.posexplode("features").alias("position", "value"))
