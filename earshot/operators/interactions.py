"""Cleaning of the interaction table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import columns
from earshot.operators import skew
from earshot.sources import storage


def support_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows (not distinct partners) per key, NULL keys left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))


def support_filter(
    df: DataFrame,
    min_user: int = 5,
    min_item: int = 5,
    user: str = "user_id",
    item: str = "song_id",
    **join_limits,
) -> DataFrame:
    """Rows whose user and song both have enough rows in the table as given.

    One pass: both counts come from ``df`` itself, not from a table already
    filtered by the other. Adds ``user_n`` and ``song_n``.

    Both counts are taken in one pass, run at once, and written to the shared folder;
    their real sizes then decide how they are joined (see :func:`skew.attach_counts`,
    which takes ``join_limits``). Keys that are too rare are left out of that join.
    """
    ids = df.select(user, item).unpivot([], [user, item], "_key", "_id").filter(F.col("_id").isNotNull())
    least = F.when(F.col("_key") == user, F.lit(min_user)).otherwise(F.lit(min_item))
    counts = ids.groupBy("_key", "_id").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least)
    counts = storage.written(counts, "support", "_key")
    sizes = {row["_key"]: row["count"] for row in counts.groupBy("_key").count().collect()}
    kept = df
    for key, name in ((user, "user_n"), (item, "song_n")):
        own = counts.filter(F.col("_key") == key).select(
            F.col("_id").cast(df.schema[key].dataType).alias(key), F.col("_n").alias(name)
        )
        kept = skew.attach_counts(kept, own, key, name, sizes.get(key, 0), **join_limits)
    return kept.select(*df.columns, "user_n", "song_n")


def log_rating(df: DataFrame, plays: str = "play_count", name: str = "rating_log") -> DataFrame:
    return df.withColumn(name, columns.log_rating(plays))


def clean(
    df: DataFrame,
    min_user: int = 5,
    min_item: int = 5,
    user: str = "user_id",
    item: str = "song_id",
    plays: str = "play_count",
    **join_limits,
) -> DataFrame:
    """Support filter and log rating."""
    return log_rating(support_filter(df, min_user, min_item, user, item, **join_limits), plays)


def cleaning_report(raw: DataFrame, tagged: DataFrame, user: str = "user_id") -> DataFrame:
    """One row of counts; ``tagged`` is the cleaned table with its ``is_train`` flag.

    Each table is read once, and only single-row results meet.
    """
    zero = F.lit(0).cast("long")
    before = raw.agg(F.count("*").alias("rows_before")).select(
        "rows_before", zero.alias("rows_after"), zero.alias("train_rows"),
        zero.alias("test_rows"), zero.alias("test_users"),
    )
    held_out = ~F.col("is_train")
    after = tagged.agg(
        F.count("*").alias("rows_after"),
        F.count_if("is_train").alias("train_rows"),
        F.count_if(held_out).alias("test_rows"),
        F.countDistinct(F.when(held_out, F.col(user))).alias("test_users"),
    ).select(zero.alias("rows_before"), "rows_after", "train_rows", "test_rows", "test_users")
    return before.unionByName(after).agg(*[F.sum(c).alias(c) for c in before.columns])


# Rows of a bucket of a table that is kept by user: a task may hold all of them, its distinct pairs too.
ROWS_PER_BUCKET = 500_000


def by_user(
    df: DataFrame, user: str = "user_id", item: str = "song_id", buckets: int | None = None, rows_per_slice: int = skew.ROWS_PER_SLICE,
) -> DataFrame:
    """``df`` written by user, so that counts, totals and histories per user need no shuffle.

    Counts the rows per user when called. Where one user has more than ``rows_per_slice``,
    a task could not read all of a bucket's rows in due time: the table is then written as
    it is, and what reads it shuffles, with the rows of that user cut into slices.
    """
    n, largest = df.groupBy(user).count().agg(F.sum("count"), F.max("count")).head()
    if (largest or 0) > rows_per_slice:
        return storage.written(df, "by-user")
    cores = df.sparkSession.sparkContext.defaultParallelism
    return storage.bucketed(df, "by-user", user, buckets or max(cores, math.ceil((n or 0) / ROWS_PER_BUCKET)), item)
