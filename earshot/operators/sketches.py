"""Distinct counts that can be merged: one small sketch per user and period instead of all its pairs.

The exact count in :func:`earshot.operators.profiles.user_stats` shuffles every (user, song)
pair, and has to be taken again over all rows when a day is added. A sketch is a few bytes
per user for few songs and at most 2^bits of them for many; those of days are merged to
weeks, months and all time without reading a row again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A sketch of so many bits has 2^bits registers.
BITS = 12


def relative_error(bits: int = BITS) -> float:
    """Standard error of an estimate, as a share of the count."""
    return 1.04 / 2 ** (bits / 2)


def sketched(df: DataFrame, *by: str, item: str = "song_id", bits: int = BITS) -> DataFrame:
    """A row per combination of ``by``: ``sketch`` of its different items, none of which is missing.

    Every partition sketches its own rows first, so a key of any size is a row per partition.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(item, bits).alias("sketch"))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of one width put together by ``by``, a part of what they were taken by."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, name: str = "distinct_songs") -> DataFrame:
    """``sketches`` with the estimate (long) in place of the sketch."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch").cast("long")).drop("sketch")
