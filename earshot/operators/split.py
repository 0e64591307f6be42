"""Training and test rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import columns

# Copies of one row dealt out in one go, and the numbers a draw has.
COPIES_PER_STEP = 100_000
DRAWS = 1 << 40


def random_tag(df: DataFrame, seed: int, train_share: float = 0.8, partitions: int | None = None) -> DataFrame:
    """Adds ``is_train``, drawn row by row: repeated (user, song) rows may land on both sides.

    The draw is a hash of the row, of which of its copies it is, and of the seed: the same
    rows and seed give the same split, however the rows are stored and whatever the
    cluster. Copies are counted, with partial counts before the shuffle, and dealt out again.
    With ``partitions``, the rows are dealt into so many first, where the session has too few
    shuffle partitions for them; the split is the same.
    """
    if partitions is not None:
        df = df.repartition(partitions, *df.columns)
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    # Two steps, so that no row of many copies becomes one long array.
    starts = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES_PER_STEP).cast("long"))
    steps = copies.select("*", F.explode(starts).alias("_start"))
    last = F.least(F.col("_start") + COPIES_PER_STEP, F.col("_copies")) - 1
    rows = steps.select(*df.columns, F.explode(F.sequence("_start", last)).alias("_copy"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "_copy", *df.columns), F.lit(DRAWS))
    return rows.withColumn("is_train", draw < F.lit(round(train_share * DRAWS))).select(*df.columns, "is_train")


def hash_tag(
    df: DataFrame, train_tenths: int = 8, user: str = "user_id", item: str = "song_id"
) -> DataFrame:
    """Adds ``is_train``, decided by the pair alone: equal pairs stay on one side."""
    return df.withColumn("is_train", columns.pair_bucket(user, item) < train_tenths)


def halves(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows and test rows of a tagged table."""
    return (
        tagged.filter("is_train").drop("is_train"),
        tagged.filter("NOT is_train").drop("is_train"),
    )


def random_split(df: DataFrame, seed: int, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    return halves(random_tag(df, seed, train_share))


def hash_split(
    df: DataFrame, train_tenths: int = 8, user: str = "user_id", item: str = "song_id"
) -> tuple[DataFrame, DataFrame]:
    return halves(hash_tag(df, train_tenths, user, item))
