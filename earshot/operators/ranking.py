"""Positions of a user's rows by play count, largest first, ties by song."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.operators import skew
from earshot.sources import storage


# Rows that one task sorts by a window, about so many.
ROWS_PER_PARTITION = 250_000


def _order(df: DataFrame, item: str, plays: str) -> list[Column]:
    """Plays descending (missing last), song ascending (missing first), then whatever else the row holds."""
    return [F.col(plays).desc(), F.col(item).asc(), F.xxhash64(*df.columns).asc()]


def top_n(df: DataFrame, user: str, item: str, plays: str, n: int) -> DataFrame:
    """Adds ``rank`` and keeps ``rank <= n``; all other columns stay.

    Spark drops rows beyond ``n`` in each partition before the shuffle, up to a threshold
    on ``n``; beyond it every row is ranked, hot users apart.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        return rank_all(df, user, item, plays).filter(F.col("rank") <= n)
    known = df.filter(F.col(user).isNotNull())
    return _by_window(known, user, item, plays).filter(F.col("rank") <= n)


def _by_window(df: DataFrame, user: str, item: str, plays: str) -> DataFrame:
    order = Window.partitionBy(user).orderBy(*_order(df, item, plays))
    return df.withColumn("rank", F.row_number().over(order).cast("long"))


def rank_all(
    df: DataFrame,
    user: str,
    item: str,
    plays: str,
    rows_per_task: int = skew.ROWS_PER_SLICE,
) -> DataFrame:
    """Adds ``rank`` to every row with a user, without ever sorting one hot user in one task.

    Runs a count when called: the users with more than ``rows_per_task`` rows are ranked
    by ranges, the others by a window. Both give the same ranks. Where the session's shuffle
    partitions would have more than :data:`ROWS_PER_PARTITION` rows each, there are more of them.
    """
    rows = df.filter(F.col(user).isNotNull())
    counts = storage.written(rows.groupBy(user).agg(F.count("*").alias("_n")), "user-counts")
    parts = math.ceil((counts.agg(F.sum("_n")).head()[0] or 0) / ROWS_PER_PARTITION)
    if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        parts = None
    hot = skew.hot_keys(counts, [user], "_n", rows_per_task).select(user)
    if hot.isEmpty():
        return _by_window(_spread(rows, user, parts), user, item, plays)
    light = _by_window(_spread(rows.join(hot, user, "left_anti"), user, parts), user, item, plays)
    heavy = _by_ranges(rows.join(hot, user, "left_semi"), user, item, plays)
    return light.unionByName(heavy)


def _spread(df: DataFrame, user: str, parts: int | None) -> DataFrame:
    return df if parts is None else df.repartition(parts, user)


def _by_ranges(df: DataFrame, user: str, item: str, plays: str) -> DataFrame:
    """Rank as the place in a sorted range plus the user's rows in the ranges before.

    The rows are dealt out by ranges of the whole order, which any number of tasks sort
    side by side; copies of one row are told apart by where they were read. The sorted
    rows are written, as their numbers must not change when a task runs again.
    """
    copy = df.withColumn("_copy", F.monotonically_increasing_id())
    order = [F.col(user).asc(), *_order(df, item, plays), F.col("_copy").asc()]
    placed = copy.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    placed = storage.written(placed.drop("_copy"), "ranges")
    # Few rows: one per user and range.
    shares = placed.groupBy(user, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(user).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = shares.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    ranked = placed.join(starts, [user, "_range"]).withColumn(
        "rank", F.col("_at") - F.col("_first") + F.col("_before") + 1
    )
    return ranked.select(*df.columns, "rank")
